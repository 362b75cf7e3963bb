"""Small conversions of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Kinds of work in the order of their codes, from 0.
WORK_TYPES = (
    None, "journal-article", "unknown", "book-chapter", "proceedings-article", "dissertation", "book", "posted-content", "report", "dataset",
    "monograph", "other", "component", "reference-entry", "peer-review", "reference-book", "journal-issue", "journal", "standard", "report-series",
    "proceedings", "book-part", "book-section", "book-series", "proceedings-series", "journal-volume", "book-set", "grant", "book-track",
)


def to_bool(c: Column, default: bool = False) -> Column:
    return F.coalesce(c.try_cast("boolean"), F.lit(default))


def to_time(c: Column) -> Column:
    """Null for what is not a date or time."""
    return c.try_cast("timestamp")


def to_day(c: Column) -> Column:
    return c.try_cast("date")


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def position_initial(c: Column) -> Column:
    return F.upper(F.substring(c, 1, 1))


def score3(c: Column) -> Column:
    return F.bround(c, 3)


def pair_weight(m: Column, n: Column) -> Column:
    """1 / (m * n), null if either is 0 or null."""
    return F.when((m > 0) & (n > 0), 1 / (m * n))


def jaccard(sets: Column) -> Column:
    """Intersection over union of an array of arrays, which count as sets; no members at all give 0."""
    first, rest = F.get(sets, F.lit(0)), F.slice(sets, F.lit(2), F.greatest(F.size(sets), F.lit(1)))
    common = F.aggregate(rest, F.array_distinct(first), lambda a, b: F.array_intersect(a, b))
    return F.size(common) / F.greatest(F.lit(1), F.size(F.array_distinct(F.flatten(sets))))


def work_types(spark: SparkSession) -> DataFrame:
    """(work_type, code), with null as a kind of its own."""
    return spark.createDataFrame(list(zip(WORK_TYPES, range(len(WORK_TYPES)), strict=True)), "work_type string, code int")


def encode_types(df: DataFrame, col: str, code: str = "code") -> DataFrame:
    """df with the code of its work type; null for a kind that is not in the table."""
    types = F.broadcast(work_types(df.sparkSession).toDF("_type", code))  # 29 rows
    return df.join(types, df[col].eqNullSafe(types["_type"]), "left").drop("_type")


def decode_types(df: DataFrame, code: str, col: str = "work_type") -> DataFrame:
    types = F.broadcast(work_types(df.sparkSession).toDF(col, "_code"))
    return df.join(types, df[code] == types["_code"], "left").drop("_code")


def smallest_types(df: DataFrame, cols: list[str]) -> DataFrame:
    """Integer columns cast to the smallest type that holds their range, in one pass over the table."""
    low_high = df.agg(*[f(c).alias(f"{k}_{c}") for c in cols for k, f in (("lo", F.min), ("hi", F.max))]).first()

    def kind(c: str) -> str:
        lo, hi = low_high[f"lo_{c}"], low_high[f"hi_{c}"]
        sizes = (("tinyint", 7), ("smallint", 15), ("int", 31))
        return next((t for t, b in sizes if lo is not None and -(1 << b) <= lo and hi < (1 << b)), "bigint")

    return df.withColumns({c: F.col(c).cast(kind(c)) for c in cols})
