"""Each registered query against its SQL check, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohortscore.catalog import registered  # noqa: E402
from cohortscore.catalog.inputs import TABLES  # noqa: E402
from tools.check_queries import canon  # noqa: E402

QUERIES, CHECKS = registered()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_its_check(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(CHECKS[name])
    assert got == canon([c[0] for c in cur.description], cur.fetchall())


# Fits whose rows have no counterpart in SQL.
FAST_FITS = [
    "M4_forest_importance", "T5_keep_by_forest", "M5_aic_elimination", "M6_bic_elimination", "M7_pca_scores",
    "M7_pca_scores_scaled", "M1_gain_importance", "M2_gain_importance_cv", "M8_prefix_areas", "M9_tune_trees", "L4_score_holdout",
]


@pytest.mark.parametrize("name", FAST_FITS)
def test_fit_gives_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_names_are_unique_and_checked():
    assert set(CHECKS) <= set(QUERIES)
    assert set(FAST_FITS) <= set(QUERIES) - set(CHECKS)


def test_entry_has_a_stable_schema(spark, small):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.count() > 0 and "net_per_patient_savings" in df.columns
    assert contract.queries().keys() >= contract.oracle_sql().keys()
