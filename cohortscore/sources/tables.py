"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortscore.functions.numeric import quoted, text_to_double
from cohortscore.operators.columns import id_columns, require_columns
from cohortscore.operators.keys import lookup_join
from cohortscore.operators.models import feature_vector
from cohortscore.session import settle

# Text that stands for a missing value in a CSV file.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]
NONE_TOKEN = "None"
# The columns of a raw encounter in order.
COUNT_COLUMNS = [
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
]
RARE_MEDICATIONS = [
    "repaglinide", "nateglinide", "chlorpropamide", "glimepiride", "acetohexamide",
    "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose", "miglitol", "troglitazone",
    "tolazamide", "examide", "citoglipton", "glyburide.metformin", "glipizide.metformin",
    "glimepiride.pioglitazone", "metformin.rosiglitazone", "metformin.pioglitazone",
]
UNUSED_COLUMNS = ["encounter_id", "patient_nbr", "weight", "payer_code", "medical_specialty"]
MEDICATIONS = ["metformin", "glipizide", "glyburide", "insulin"]
DIAGNOSES = ["diag_1", "diag_2", "diag_3"]
ADMISSION_COLUMNS = ["admission_type_id", "discharge_disposition_id", "admission_source_id"]
TEXT_COLUMNS = ["race", "gender", "A1Cresult", "max_glu_serum"]
LONG_IDS = ("encounter_id", "patient_nbr")


def encounter_schema() -> T.StructType:
    names = [
        *COUNT_COLUMNS, *RARE_MEDICATIONS, *UNUSED_COLUMNS, "readmitted", *MEDICATIONS,
        "change", "diabetesMed", *DIAGNOSES, "age", *ADMISSION_COLUMNS, *TEXT_COLUMNS,
    ]
    whole = {*COUNT_COLUMNS, *ADMISSION_COLUMNS}

    def kind(name):
        if name in LONG_IDS:
            return T.LongType()
        return T.IntegerType() if name in whole else T.StringType()

    return T.StructType([T.StructField(c, kind(c)) for c in names])


def read_text_table(spark: SparkSession, path, none_as_null: bool = False) -> DataFrame:
    """A CSV file with header, every column as text, missing tokens as NULL."""
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    tokens = [*MISSING_TOKENS, *([NONE_TOKEN] if none_as_null else [])]
    return raw.select(*[F.when(~quoted(c).isin(tokens), quoted(c)).alias(c) for c in raw.columns])


def read_encounters(spark: SparkSession, path, none_as_null: bool = False) -> DataFrame:
    """Raw encounters by column name: extra columns are dropped, absent ones NULL."""
    raw = read_text_table(spark, path, none_as_null)
    present = set(raw.columns)
    out = []
    for f in encounter_schema().fields:
        if f.name not in present:
            value = F.lit(None)
        elif isinstance(f.dataType, T.StringType):
            value = quoted(f.name)
        else:
            value = text_to_double(quoted(f.name)).try_cast(f.dataType)
        out.append(value.cast(f.dataType).alias(f.name))
    return raw.select(*out)


def read_table_any(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A table at any path Spark can reach, its format told by the name.

    A CSV file is read once with a ``schema``, and twice to find one without.
    """
    ending = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if ending == "csv" and schema is not None:
        return spark.read.option("header", True).schema(schema).csv(path)
    if ending == "csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.format(ending if ending in ("json", "orc") else "parquet").load(path)


def _lines(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Lines that are not blank, with the file and their place in the scan."""
    lines = spark.read.option("pathGlobFilter", pattern).text(folder)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    ).where(F.trim("value") != "")


def _fields(line: Column, width: int) -> Column:
    """The first ``width`` fields of a CSV line as an array."""
    names = [f"c{i}" for i in range(width)]
    parsed = F.from_csv(line, ", ".join(f"{n} string" for n in names))
    return F.array(*[parsed[n] for n in names])


def read_many(spark: SparkSession, folder: str, same_header: bool = False) -> DataFrame:
    """All ``*.csv`` files of a folder as one table of text columns.

    Headers are a table with a row per file: its first line that is not blank,
    cut into names, and where each column of the result stands in the file.
    Every line meets its file's header and is parsed with it, so the number of
    jobs depends neither on the files nor on their headers, and the driver
    learns the columns only. Columns come in the order of the files by path,
    then of their headers; those that a file lacks are NULL there, of a name
    that a header has twice the first counts. Files without a line have no
    rows; one that cannot be read stops the job. ``same_header=True`` skips
    looking at the headers.
    """
    pattern = "*.csv"
    if same_header:
        return spark.read.option("header", True).option("pathGlobFilter", pattern).csv(folder)
    lines = _lines(spark, folder, pattern)
    first = lines.where("block = 0").groupBy("file").agg(F.min(F.struct("at", "value")).alias("h"))
    headers = settle(first.select("file", F.col("h.at").alias("header_at"), F.col("h.value").alias("header")))
    width = headers.agg(F.max(F.regexp_count("header", F.lit(",")) + 1)).first()[0]
    if width is None:
        raise FileNotFoundError(f"no CSV files with a header in {folder}")
    named = headers.select("file", "header_at", F.filter(_fields(F.col("header"), width), lambda name: name.isNotNull()).alias("names"))
    order = named.select("file", F.posexplode("names").alias("pos", "name")).groupBy("name").agg(F.min(F.struct("file", "pos")).alias("o"))
    columns = [r["name"] for r in order.orderBy("o").collect()]  # the columns of the result
    places = F.array(*[F.array_position("names", c).cast("int") for c in columns])
    table = settle(named.select("file", "header_at", places.alias("places")))
    rows = lookup_join(lines, table, ["file"]).where("at <> header_at").select("places", _fields(F.col("value"), width).alias("f"))
    found = [F.when(F.col("places")[i] > 0, F.get("f", F.col("places")[i] - 1)).alias(c) for i, c in enumerate(columns)]
    return rows.select(*found)


def write_table(df: DataFrame, path: str, header: bool = True) -> str:
    """CSV with header where the name says so, else Parquet."""
    writer = df.write.mode("overwrite")
    if path.rstrip("/").lower().endswith(".csv"):
        writer.option("header", header).csv(path)
    else:
        writer.parquet(path)
    return path


def write_label_first(df: DataFrame, label: str, path: str, features: Sequence[str] | None = None) -> str:
    """CSV without header, the label in the first column."""
    features = features or [c for c in df.columns if c != label]
    require_columns(df, [label, *features])
    ordered = df.select(quoted(label), *[quoted(c) for c in features])
    ordered.write.mode("overwrite").option("header", False).csv(path)
    return path


def write_folds(folded: DataFrame, path: str, header: bool = True) -> str:
    """One CSV table partitioned by fold: fold k validates, the rest train."""
    folded.write.mode("overwrite").option("header", header).partitionBy("fold").csv(path)
    return path


def fold_pair(folded: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(train, validation) of fold k; a filter on the partition column."""
    return folded.where(F.col("fold") != k).drop("fold"), folded.where(F.col("fold") == k).drop("fold")


def write_vectors(df: DataFrame, label: str, features: Sequence[str], path: str, form: str = "parquet") -> str:
    """(label, features) with a vector column, as Parquet or libsvm text."""
    rows = df.select(
        quoted(label).cast("double").alias("label"), feature_vector(df, features).alias("features")
    )
    if form == "libsvm":
        rows.write.mode("overwrite").option("numFeatures", len(features)).format("libsvm").save(path)
    else:
        rows.write.mode("overwrite").format(form).save(path)
    return path


def compact_predictions(scored: DataFrame) -> DataFrame:
    """Id columns and probability columns only."""
    probabilities = [c for c in scored.columns if c.endswith("_prob")]
    return scored.select(*[quoted(c) for c in [*id_columns(scored), *probabilities]])


def with_predictions(scored: DataFrame, models: Sequence[str] = ("xgb", "nn")) -> DataFrame:
    """All input columns and one probability column per model, NULL if not run."""
    for m in models:
        if f"{m}_prob" not in scored.columns:
            scored = scored.withColumn(f"{m}_prob", F.lit(None).cast("double"))
    return scored


def predictions_name(input_name: str) -> str:
    base = input_name.rstrip("/").rsplit("/", 1)[-1]
    return (base[:-4] if base.lower().endswith(".csv") else base) + "_with_predictions.csv"


def write_with_predictions(scored: DataFrame, label: str, folder: str, input_name: str) -> str | None:
    """Write the full scored table, but only where the label is known."""
    if label not in scored.columns:
        return None
    return write_table(with_predictions(scored), f"{folder.rstrip('/')}/{predictions_name(input_name)}")
