"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import broadcast_below, written

#: Ranges of the sampling key within a source, or a multiple for many documents; only the one that holds the budget's end is sorted.
BUCKETS = 1024
#: Copies that one task makes of a row.
COPIES = 4096
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def word_length_weight(text: Column) -> Column:
    """Quality weight from 0.2 to 1: how near the mean word length is to six characters."""
    mean = F.length(text) / F.greatest(word_count(text), F.lit(1))
    return F.coalesce(F.greatest(F.lit(0.2), 1 / (1 + F.abs(mean - 6) / 4)), F.lit(0.2))


def targets(sources: DataFrame, limit: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size) with weight, target, epochs and budget. Weights go round in code-point order, null last.

    All sizes are shared by weight; no target is above limit times its source's size, and what one
    leaves goes to the others by weight. With sources in the order of limit * size / weight those
    at their limit come first, so the level of the others is found in one pass. One row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    given = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    given = given.withColumn("cap", F.col("source_size") * limit).withColumn("ratio", F.col("cap") / F.col("weight"))
    w = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(w.rowsBetween(0, Window.unboundedFollowing))
    given = given.withColumn("level", (F.sum("source_size").over(Window.partitionBy()) - before) / rest)
    free = F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", "level"))).over(Window.partitionBy())["level"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(free * F.col("weight"), F.col("cap").cast("double")))
    given = given.withColumn("target", target)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return given.withColumn("epochs", epochs).withColumn("budget", F.col("target") - epochs * F.col("source_size")).select("source", "source_size", "target", "epochs", "budget")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight: Column | None = None, seed: int = 7) -> DataFrame:
    """(doc_id, size, source_size, target, times, taken, rid): one row per input row; taken is size * times.

    Each source is taken in whole epochs as often as its target allows; for the rest its documents
    are ordered by -ln(u) / weight, u a hash of id, source, text and number of the copy, and taken while the middle of the next
    one is within the budget, so the total is off by at most half a document. A null source is a
    source of its own, a null text has size 0, a null id is hashed like a value; repeated rows are
    sampled as rows, equal keys stand in the order of id and size; an empty table gives no rows.
    rid is a hash of id, source and text, the same for repeated rows.
    """
    text = F.col(text_col).cast("string")
    rid = F.xxhash64(F.col(id_col), F.col(source_col), text, F.lit(seed))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text).alias("size"), (weight if weight is not None else word_length_weight(text)).cast("double").alias("w"), rid.alias("rid"))
    # repeated rows are counted before the shuffle and numbered after it, so each has a chance of its own
    base = repeated(base.groupBy("doc_id", "source", "size", "w", "rid").agg(F.count("*").alias("copies")), "copies", "copy")
    chance = (F.shiftrightunsigned(F.xxhash64("rid", "copy", F.lit(seed)), 11).cast("double") + 0.5) / F.lit(2.0**53)
    base = written(base.withColumn("key", -F.log(chance) / F.greatest("w", F.lit(1e-6))), "sizes")
    sources = written(base.groupBy("source").agg(F.sum("size").alias("source_size"), F.avg("w").alias("mean")), "sources")
    plan = targets(sources.drop("mean")).join(sources.select(F.col("source").alias("s"), "mean"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    plan = written(plan, "plan")

    def planned(rows: DataFrame, with_plan: DataFrame) -> DataFrame:
        return rows.join(with_plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")

    buckets = BUCKETS * max(1, base.count() // (BUCKETS * 100_000))
    bucket = F.least(F.lit(buckets - 1), F.floor(buckets * (1 - F.exp(-F.col("key") * F.col("mean"))))).cast("int")
    dealt = planned(base, plan).withColumn("bucket", bucket)
    totals = dealt.groupBy("source", "bucket", "budget").agg(F.sum("size").alias("in_bucket"))
    up_to = Window.partitionBy("source").orderBy("bucket")
    totals = totals.withColumn("through", F.sum("in_bucket").over(up_to))
    ends = totals.where("through >= budget").groupBy("source").agg(F.min(F.struct("bucket", F.col("through") - F.col("in_bucket"))).alias("end"))
    ends = plan.join(ends.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(plan["*"], F.col("end.bucket").alias("last"), F.col("end.col2").alias("before"))
    ends = written(ends, "ends")
    rows = planned(base, ends).withColumn("bucket", bucket)
    at_end = rows.where("bucket = last")
    run = Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_last(), "rid", "copy").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("before") + F.sum("size").over(run) - F.col("size") / 2
    chosen = at_end.withColumn("more", (middle <= F.col("budget")).cast("long")).unionByName(rows.where("last IS NULL OR bucket <> last").withColumn("more", F.coalesce(F.col("bucket") < F.col("last"), F.lit(True)).cast("long")))
    times = F.when(F.col("size") > 0, F.col("epochs") + F.col("more")).otherwise(F.col("epochs"))
    return chosen.select("doc_id", "size", "source_size", "target", times.alias("times"), (F.col("size") * times).alias("taken"), "rid")


def repeated(df: DataFrame, n: str, number: str) -> DataFrame:
    """Each row as many times as column n says, without n, numbered from 1. Large numbers are dealt out first."""
    few, many = df.where(F.col(n) <= COPIES), df.where(F.col(n) > COPIES)
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / COPIES)))
    many = many.select("*", chunk.alias("_chunk")).repartition("_chunk")
    made = many.select(*df.columns, F.explode(F.sequence(F.col("_chunk") * COPIES + 1, F.least(F.col(n), (F.col("_chunk") + 1) * COPIES))).alias(number))
    return few.where(F.col(n) > 0).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col(n).cast("long"))).alias(number)).unionByName(made).drop(n)


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7) -> DataFrame:
    """The documents of the mix, each as many times as it is taken, with all columns of docs.

    Rows alike in id, source and text are copies of one document: they are taken together as often as
    mix() takes them, with the other columns of one of them. Texts are not shuffled but for these
    copies, where the list of taken rows is small enough to be broadcast. Nulls, empty texts and
    tables as in mix().
    """
    rid = F.xxhash64(F.col(id_col), F.col(source_col), F.col(text_col).cast("string"), F.lit(seed))
    times = mix(docs, id_col, text_col, source_col, seed=seed).groupBy(F.col("rid").alias("_rid")).agg(F.sum("times").alias("_times"), F.count("*").alias("_copies"))
    times = broadcast_below(written(times.where("_times > 0"), "times"), 2_000_000)
    joined = docs.select(F.struct("*").alias("_row"), rid.alias("_rid")).join(times, "_rid")
    once = joined.where("_copies = 1")
    if not times.where("_copies > 1").isEmpty():
        once = once.unionByName(joined.where("_copies > 1").dropDuplicates(["_rid"]))
    return repeated(once.select("_row", "_times"), "_times", "_number").select("_row.*")
