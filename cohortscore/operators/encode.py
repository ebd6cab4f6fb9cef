"""One-hot encoding.

``OneHot`` turns categories into columns, fitted once and applied in one
projection. ``CategoryTable`` is for categories of any number: the dictionary
is a table with an index per category and rows get the indices of theirs, as a
sparse vector of ones.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscore.functions.numeric import quoted
from cohortscore.operators.keys import SMALL_ROWS, lookup_join, prefix_sums
from cohortscore.operators.profile import profile_counts
from cohortscore.session import settle

#: Categories that may become columns; see ``CategoryTable`` for more.
MAX_CATEGORIES = 10_000


def dummy_name(prefix: str, value: str) -> str:
    return f"{prefix}_{value}"


@dataclass
class OneHot:
    """Fitted encoder: each category gets a column, all but the most frequent.

    ``combined`` maps a prefix to columns encoded together (a category counts
    if any of them holds it, none is dropped).
    """

    categories: dict[str, list[str]] = field(default_factory=dict)
    dropped: dict[str, str] = field(default_factory=dict)
    combined: dict[str, list[str]] = field(default_factory=dict)
    combined_categories: dict[str, list[str]] = field(default_factory=dict)

    def columns(self) -> list[str]:
        together = [dummy_name(p, v) for p, vs in self.combined_categories.items() for v in vs]
        single = [
            dummy_name(c, v) for c, vs in self.categories.items() for v in vs if v != self.dropped.get(c)
        ]
        return together + single

    def transform(self, df: DataFrame) -> DataFrame:
        """Other columns first, then the dummies; missing values are 0 everywhere."""
        encoded = set(self.categories) | {c for cs in self.combined.values() for c in cs}
        rest = [quoted(c) for c in df.columns if c not in encoded]
        dummies = []
        for prefix, sources in self.combined.items():
            for v in self.combined_categories[prefix]:
                hit = F.lit(False)
                for c in sources:
                    hit = hit | quoted(c).cast("string").eqNullSafe(F.lit(v))
                dummies.append(hit.cast("int").alias(dummy_name(prefix, v)))
        for c, values in self.categories.items():
            for v in values:
                if v != self.dropped.get(c):
                    hit = quoted(c).cast("string").eqNullSafe(F.lit(v))
                    dummies.append(hit.cast("int").alias(dummy_name(c, v)))
        return df.select(*rest, *dummies)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> OneHot:
        return OneHot(**json.loads(text))


def fit_one_hot(
    df: DataFrame,
    columns: Sequence[str] = (),
    combined: dict[str, Sequence[str]] | None = None,
    drop_mode: bool = True,
    max_categories: int = MAX_CATEGORIES,
) -> OneHot:
    """Learn the categories of all columns.

    One grouped count covers every column. Only distinct categories reach the
    driver, and more than ``max_categories`` of them are refused: they become
    columns of the result.
    """
    model = OneHot(combined={p: list(cs) for p, cs in (combined or {}).items()})
    together = [c for cs in model.combined.values() for c in cs]
    every = list(dict.fromkeys([*columns, *together]))
    counts = profile_counts(df, every).where(F.col("value").isNotNull())
    seen: dict[str, dict[str, int]] = {c: {} for c in every}
    for row in _bounded(counts, max_categories):
        seen[row["column"]][row["value"]] = row["n"]
    for c in columns:
        model.categories[c] = sorted(seen[c])
        if drop_mode and seen[c]:
            model.dropped[c] = min(seen[c], key=lambda v: (-seen[c][v], v))
    for prefix, sources in model.combined.items():
        model.combined_categories[prefix] = sorted({v for c in sources for v in seen[c]})
    return model


@dataclass
class CategoryTable:
    """Categories of any number: ``table`` has prefix, value, n, index; the index is missing where it is dropped.

    ``sources`` maps a prefix to its columns. Indices count all kept categories
    in order of prefix and value, from 0 to ``size`` - 1.
    """

    sources: dict[str, list[str]]
    table: DataFrame
    size: int
    small_rows: int = SMALL_ROWS

    def encode(self, df: DataFrame, indices: str = "indices") -> DataFrame:
        """Other columns, and the ascending ``indices`` of each row's categories.

        Each column's values meet the dictionary in a join, where frequent
        categories are broadcast and so never meet in one task. Missing,
        dropped and unknown categories have no index. A category that several
        columns of one prefix hold counts once.
        """
        encoded = {c for cs in self.sources.values() for c in cs}
        rows = settle(df.select("*", F.monotonically_increasing_id().alias("__row")))
        held = [
            F.struct(F.lit(p).alias("prefix"), quoted(c).cast("string").alias("value")) for p, cs in self.sources.items() for c in cs
        ]
        values = rows.select("__row", F.explode(F.array(*held)).alias("v")).select("__row", "v.prefix", "v.value")
        known = self.table.where(F.col("index").isNotNull()).select("prefix", "value", "index")
        found = lookup_join(values.where(F.col("value").isNotNull()), settle(known), ["prefix", "value"], self.small_rows)
        lists = found.groupBy("__row").agg(F.array_sort(F.collect_set("index")).alias("__found"))
        rest = [quoted(c) for c in df.columns if c not in encoded]
        empty = F.array().cast("array<long>")
        return rows.join(lists, "__row", "left").select(*rest, F.coalesce("__found", empty).alias(indices))


def fit_category_table(
    df: DataFrame,
    columns: Sequence[str] = (),
    combined: dict[str, Sequence[str]] | None = None,
    drop_mode: bool = True,
    small_rows: int = SMALL_ROWS,
) -> CategoryTable:
    """The dictionary of ``columns`` (each but its most frequent category) and of ``combined`` ones (all).

    The same categories, in the same order, as the columns of ``fit_one_hot``
    have, with nothing but counts on the driver: values are counted in one
    pass, and ranked by sums over range partitions. Of equally frequent
    categories the first is dropped.
    """
    combined = {p: list(cs) for p, cs in (combined or {}).items()}
    sources = combined | {c: [c] for c in columns}
    place = F.create_map(*[F.lit(x) for p, k in zip(sources, range(len(sources))) for x in (p, k)])
    owners = [F.struct(F.lit(p).alias("prefix"), F.lit(c).alias("column")) for p, cs in sources.items() for c in cs]
    counts = profile_counts(df, list(dict.fromkeys(c for cs in sources.values() for c in cs))).where(F.col("value").isNotNull())
    owned = counts.select("*", F.explode(F.filter(F.array(*owners), lambda o: o["column"] == F.col("column"))).alias("o"))
    table = settle(owned.groupBy(F.col("o.prefix").alias("prefix"), "value").agg(F.sum("n").alias("n")))
    modes = table.where(F.col("prefix").isin(list(columns) if drop_mode else [])).groupBy("prefix").agg(
        F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("m")
    )
    # A row per column at most.
    tagged = table.join(F.broadcast(modes.select("prefix", F.col("m.value").alias("mode"))), "prefix", "left")
    kept = settle(tagged.select("prefix", "value", "n", (~F.col("value").eqNullSafe(F.col("mode"))).alias("kept")))
    ordered = prefix_sums(kept, [place[F.col("prefix")], F.col("value")], F.col("kept").cast("long"), "before", small_rows)
    ranked = settle(ordered.select("prefix", "value", "n", F.when(F.col("kept"), F.col("before")).alias("index")))
    return CategoryTable(sources, ranked, ranked.where("index IS NOT NULL").count(), small_rows)


def _bounded(df: DataFrame, limit: int) -> list:
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} categories; they cannot become columns")
    return rows


def cast_all_int(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every column but ``keep`` as int; text that is no integer becomes NULL."""
    return df.select(
        *[quoted(c) if c in keep else quoted(c).try_cast("int").alias(c) for c in df.columns]
    )


def int_residue(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(column, residue): values an integer cast would lose or miss."""
    names = [c for c in df.columns if c not in keep]
    parts = [
        F.struct(F.lit(c).alias("column"), F.count_if(quoted(c).try_cast("int").isNull()).alias("residue"))
        for c in names
    ]
    return df.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def require_int(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    bad = [tuple(r) for r in int_residue(df, keep).where("residue > 0").collect()]
    if bad:
        raise ValueError(f"columns with values that are no integers: {bad[:10]}")
    return cast_all_int(df, keep)
