"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_test_folders: dict[str, str] = {}
_scopes: list[list[str]] = []

#: Bytes of a generated method that the JVM soon compiles; it never does above 8,000, and late below.
METHOD_BYTES = 4000
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_compiled_lock = threading.Lock()
#: By application, how many ``compiled`` blocks are open and the limit before the first.
_compiled: dict[str, tuple[int, str | None]] = {}


def local_session(cpus: int | str = 8, name: str = "cohortscore") -> SparkSession:
    """A session for tests and benches. A cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        # Generated methods above 8,000 bytes are never compiled by the JVM;
        # wide recode and dummy projections are better off without fusion then.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only when no ``spark.checkpoint.dir`` is set (tests on one machine) a
    temporary folder takes its place; a job on a cluster without that setting
    is refused, because a machine-local folder would lose data there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _test_folders:
        _test_folders[app] = tempfile.mkdtemp(prefix="cohortscore-")
    return _test_folders[app]


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for one run's files."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Run folders made inside are removed at the end, so write results before."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a run folder that nothing will read any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside do without generated methods that are too long for the JVM to compile.

    By default a projection of very many columns becomes one such method, which
    is interpreted; inside, it runs operator by operator in short methods.
    Afterwards the session has its own limit again; a lower one stays in force.
    """
    app = spark.sparkContext.applicationId
    with _compiled_lock:
        depth, before = _compiled.get(app, (0, None))
        if not depth:
            before = spark.conf.get(_METHOD_LIMIT)
            spark.conf.set(_METHOD_LIMIT, str(min(int(before), METHOD_BYTES)))
        _compiled[app] = depth + 1, before
    try:
        yield
    finally:
        with _compiled_lock:
            depth, before = _compiled.pop(app)
            if depth > 1:
                _compiled[app] = depth - 1, before
            else:
                spark.conf.set(_METHOD_LIMIT, before)


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder.

    Written as Parquet, so later stages read it back column by column and a
    lost executor costs a re-read instead of a recomputation.
    """
    path = run_folder(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
