import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohortscore.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests")


@pytest.fixture(scope="session")
def small():
    if not Path(SMALL).exists():
        pytest.skip("benchmark tables are not here")
    return SMALL
