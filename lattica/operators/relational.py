"""Selections, joins, aggregates, windows and reports. Column names are parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import jaccard
from ..runtime import broadcast_below, written
from ..sources.sinks import write_parquet


# selections
def in_years(df: DataFrame, year: str | Column, first: int = 2012, last: int = 2022) -> DataFrame:
    return df.where((F.col(year) if isinstance(year, str) else year).between(first, last))


def of_type(df: DataFrame, types: list[str], *cols: str) -> DataFrame:
    """Rows whose type is in the list, by any of the columns."""
    test = F.lit(False)
    for c in cols:
        test = test | F.coalesce(F.col(c).isin(types), F.lit(False))
    return df.where(test)


def not_flagged(df: DataFrame, *flags: str) -> DataFrame:
    """Rows of which no flag is true; null counts as false."""
    for f in flags:
        df = df.where(~F.coalesce(F.col(f).cast("boolean"), F.lit(False)))
    return df


def with_id(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull() & (F.trim(F.col(key).cast("string")) != ""))


def named(df: DataFrame, col: str, names: list[str]) -> DataFrame:
    return df.where(F.lower(col).isin([n.lower() for n in names]))


def above(df: DataFrame, col: str, least: float = 0) -> DataFrame:
    return df.where(F.col(col) > least)


def with_null(df: DataFrame) -> DataFrame:
    """Rows with a null in any column."""
    test = F.lit(False)
    for c in df.columns:
        test = test | F.col(c).isNull()
    return df.where(test)


def level_zero(df: DataFrame, level: str = "level") -> DataFrame:
    return df.where(F.col(level) == 0)


def small_groups(df: DataFrame, key: str, most: int = 50) -> DataFrame:
    """Rows of keys with at most so many rows; null keys have no group and stay."""
    large = df.groupBy(F.col(key).alias("_k")).count().where(F.col("count") > most)
    return df.join(large, df[key] == large["_k"], "left_anti")


# joins
def without_ids(df: DataFrame, key: str, skip: DataFrame) -> DataFrame:
    ids = skip.toDF("_id")
    return df.join(ids, df[key] == ids["_id"], "left_anti")


def with_ids(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    ids = ids.toDF("_id")
    return df.join(ids, df[key] == ids["_id"], "left_semi")


def induced_edges(edges: DataFrame, vertices: DataFrame, src: str, dst: str, dst_vertices: DataFrame | None = None) -> DataFrame:
    """Edges of which both ends are selected."""
    return with_ids(with_ids(edges, src, vertices), dst, dst_vertices if dst_vertices is not None else vertices)


def works_in_venues(works: DataFrame, host: DataFrame, alternate: DataFrame, venues: DataFrame, work: str = "work_id", venue: str = "venue_id") -> DataFrame:
    """Works with their host or an alternate venue among the venues (one column of ids)."""
    both = host.select(work, venue).unionByName(alternate.select(work, venue))
    return with_ids(works, work, with_ids(both, venue, venues).select(work).distinct())


def looked_up(df: DataFrame, key: str, dim: DataFrame, dim_key: str, *attributes: str) -> DataFrame:
    """Attributes of a dimension, null on a miss; one row of dim per key."""
    d = dim.select(F.col(dim_key).alias("_k"), *attributes)
    return df.join(d, df[key] == d["_k"], "left").drop("_k")


def counts_on_edges(edges: DataFrame, counts: DataFrame, src: str, dst: str, key: str, count: str) -> DataFrame:
    """edges with src_count and dst_count; 0 where an end is unknown."""
    out = edges
    for end, name in ((src, "src_count"), (dst, "dst_count")):
        c = counts.select(F.col(key).alias("_k"), F.col(count).alias("_n"))
        out = out.join(c, out[end] == c["_k"], "left").withColumn(name, F.coalesce("_n", F.lit(0))).drop("_k", "_n")
    return out


def concept_neighbourhood(concept_works: DataFrame, authorship: DataFrame, concepts: DataFrame, concept: str = "concept_id", work: str = "work_id", author: str = "author_id") -> DataFrame:
    """All works of all authors of the works of the concepts: (author, work), distinct."""
    tagged = with_ids(concept_works, concept, concepts).select(work).distinct()
    authors = with_ids(authorship, work, tagged).select(author).distinct()
    return with_ids(authorship, author, authors).select(author, work).distinct()


# aggregates
def per_key(df: DataFrame, key: str, counted: str, name: str = "n") -> DataFrame:
    """Non-null values per key."""
    return df.groupBy(key).agg(F.count(counted).alias(name))


def frequencies(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(col)


def sets_per_key(df: DataFrame, key: str, value: str, name: str = "members") -> DataFrame:
    return df.groupBy(key).agg(F.sort_array(F.collect_set(value)).alias(name))


def crosstab(df: DataFrame, a: str, b: str, values: list) -> DataFrame:
    """Counts of the values of b by a, one column each; the long form is per_key on both."""
    return df.groupBy(a).pivot(b, values).count().na.fill(0)


def keep_first(df: DataFrame, keys: list[str], *order) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def completed(log: DataFrame, n_tables: int, recompute: list[str] | None = None) -> DataFrame:
    """(path) of inputs with a log row for each of n_tables tables. Of repeated rows the last counts; tables to recompute count as absent."""
    rows = log.where(~F.col("table").isin(recompute)) if recompute else log
    last = keep_first(rows, ["path", "table"], F.desc("timestamp"), F.desc_nulls_last("records"))
    return last.groupBy("path").agg(F.count("records").alias("n")).where(F.col("n") == n_tables).select("path")


def cardinality(df: DataFrame, cols: list[str], threshold: float = 0.05, most: float = 0.1, exact: bool = True) -> DataFrame:
    """(column, distinct, rows, ratio, categorise), one row per column; ratios above `most` are shown as that.
    exact=False estimates in one pass without a shuffle of values."""
    count = F.count_distinct if exact else F.approx_count_distinct
    one = df.agg(F.count("*").alias("rows"), *[count(c).alias(f"d_{i}") for i, c in enumerate(cols)])
    items = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"d_{i}").alias("distinct")) for i, c in enumerate(cols)]))
    rows = one.select("rows", items.alias("x")).select("x.column", "x.distinct", "rows")
    ratio = F.col("distinct") / F.col("rows")
    return rows.withColumn("ratio", F.least(ratio, F.lit(most))).withColumn("categorise", ratio < threshold)


def cardinality_in_two_phases(df: DataFrame, cols: list[str], threshold: float = 0.05, most: float = 0.1, detail: int = 14) -> DataFrame:
    """cardinality() for wide tables: distinct is null for columns that are past `most` for certain.

    One pass keeps a mergeable sketch of 2 ** detail cells for each column; a column whose estimate less five standard errors is
    above `most` of the rows is left out. Exact counts are taken of the others only, whose values are few, so tasks send few of
    them. A column that the sketch leaves open is counted exactly. Nulls are no value; a table without rows has ratios of null.
    """
    sketches = [F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(detail))).alias(f"d_{i}") for i, c in enumerate(cols)]
    seen = df.agg(F.count("*").alias("rows"), *sketches).first()
    sure = 1 - 5 * 1.04 / 2 ** (detail / 2)
    kept = [c for i, c in enumerate(cols) if (seen[f"d_{i}"] or 0) * sure <= most * seen["rows"]]
    counted = df.agg(*[F.count_distinct(c).alias(f"n_{i}") for i, c in enumerate(kept)]).first() if kept else ()
    exact = dict(zip(kept, counted, strict=True))
    rows = [(c, exact.get(c), seen["rows"]) for c in cols]  # one row for each column
    out = df.sparkSession.createDataFrame(rows, "column string, distinct bigint, rows bigint")
    ratio = F.when(F.col("rows") > 0, F.least(F.coalesce(F.col("distinct") / F.col("rows"), F.lit(most)), F.lit(most)))
    return out.withColumn("ratio", ratio).withColumn("categorise", ratio < threshold)


def estimate(df: DataFrame, key: str, value: str, of: str = "mean", error: str = "se", level: float | None = None, distances: bool = False, replicates: int = 1000, seed: int = 1, most: int = 100_000) -> DataFrame:
    """(key, n, y, ymin, ymax) per group: mean or median with an error bar, nulls left out.

    error: sd or se times level (1), pi the percentiles of the level (95), ci those of `replicates`
    bootstrap estimates, for which each row has Poisson(1) weights made from a hash of group, value,
    number among equal values, seed and replicate. Groups of one value have no bar. distances gives lengths in place of bounds.
    Percentiles are exact_percentiles(), so no task holds more than `most` values of a group.
    """
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(F.col(key).alias("k"), F.col(value).cast("double").alias("v"))
    tail = (1 - (level or 95) / 100) / 2
    middle = F.avg("v")
    if error in ("sd", "se"):
        half = F.stddev_samp("v") * (level or 1) / (1 if error == "sd" else F.sqrt(F.count("v")))
        out = rows.groupBy("k").agg(F.count("v").alias("n"), middle.alias("y"), half.alias("h"))
        if of == "median":
            found = exact_percentiles(rows, ["k"], [0.5], most)
            out = out.drop("y").join(found, out["k"].eqNullSafe(found["k"]), "left").drop(found["k"]).withColumn("y", F.col("p")[0])
        out = out.select("k", "n", "y", (F.col("y") - F.col("h")).alias("ymin"), (F.col("y") + F.col("h")).alias("ymax"))
    else:
        shares = [tail, 1 - tail, *([0.5] if of == "median" else [])]
        if error == "ci":
            shares = shares[2:]
        out = rows.groupBy("k").agg(F.count("v").alias("n"), *([middle.alias("y")] if of == "mean" else []))
        found = exact_percentiles(rows, ["k"], shares, most) if shares else None
        if error == "ci":
            found = found.withColumnRenamed("p", "m") if found is not None else None
            bars = exact_percentiles(_bootstrap(rows, of, replicates, seed, most), ["k"], [tail, 1 - tail], most)
            out = out.join(bars, out["k"].eqNullSafe(bars["k"]), "left").drop(bars["k"])
            if found is not None:
                out = out.join(found, out["k"].eqNullSafe(found["k"]), "left").drop(found["k"]).withColumn("y", F.col("m")[0])
        else:
            out = out.join(found, out["k"].eqNullSafe(found["k"]), "left").drop(found["k"])
            out = out.withColumn("y", F.col("p")[2]) if of == "median" else out
        out = out.select("k", "n", "y", F.col("p")[0].alias("ymin"), F.col("p")[1].alias("ymax"))
    out = out.withColumns({c: F.when(F.col("n") > 1, F.col(c)) for c in ("ymin", "ymax")})
    if distances:
        out = out.withColumns({"ymin": F.col("y") - F.col("ymin"), "ymax": F.col("ymax") - F.col("y")})
    return out.withColumnRenamed("k", key)


def exact_percentiles(rows: DataFrame, keys: list[str], shares: list[float], most: int = 100_000, weight: str | None = None, value: str = "v", ranges: int = 1024) -> DataFrame:
    """(keys, p): of each group the percentiles at the shares (0 to 1), interpolated between neighbours, as an array in their order.

    Groups of at most `most` rows go the plain way. Of larger ones only counts are taken: the values between a low and a
    high bound fall into equal ranges, the one that holds the wanted rank is the next pair of bounds, and once at most
    `most` rows, or equal values, lie between them, these are sorted. Counts are added up before the exchange, so a group
    of any size is spread over all tasks; a pass divides typical values by hundreds. weight: a column of how often a row
    counts (a whole number; rows without are left out). Null and NaN values are no values; null keys are a group; an empty table gives no rows.
    """
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    used = rows.select(*keys, F.col(value).cast("double").alias("v"), w.alias("w")).where("v IS NOT NULL AND NOT isnan(v) AND w > 0")
    keyed = used.select(F.struct(*keys).alias("k"), "v", "w")
    sizes = written(keyed.groupBy("k").agg(F.count("*").alias("held"), F.sum("w").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")), "sizes")
    large = sizes.where(F.col("held") > most)
    few = keyed.join(broadcast_below(large.select("k"), 100_000), "k", "left_anti") if not large.isEmpty() else keyed
    plain = few.groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, shares)), F.col("w")).alias("p"))
    if large.isEmpty():
        return plain.select("k.*", "p")
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(q) * (F.col("n") - 1)).alias("x")) for i, q in enumerate(shares)]))
    wanted = large.select("k", at.alias("q"), "held", "low", "high")
    ends = F.explode(F.array(F.floor("q.x"), F.ceil("q.x"))).alias("rank")
    now = written(wanted.select("k", ends, F.lit(0).cast("bigint").alias("before"), "held", "low", "high").distinct(), "ranks")
    open_ = (F.col("held") > most) & (F.col("low") < F.col("high"))
    while not (cut := now.where(open_)).isEmpty():
        span = F.col("high") / 2 - F.col("low") / 2  # halves: the difference of two doubles may be none
        part = F.coalesce(F.floor((F.col("v") / 2 - F.col("low") / 2) / span * (ranges - 1)), F.lit(0))
        slot = F.when(F.col("v") >= F.col("high"), ranges - 1).otherwise(F.least(F.greatest(part, F.lit(0)), F.lit(ranges - 2)))
        met = keyed.join(broadcast_below(cut.select("k", "rank", "low", "high"), 100_000), "k").where("v BETWEEN low AND high")
        counts = met.groupBy("k", "rank", slot.alias("slot")).agg(F.sum("w").alias("c"), F.count("*").alias("held"), F.min("v").alias("low"), F.max("v").alias("high"))
        upto = F.sum("c").over(Window.partitionBy("k", "rank").orderBy("slot"))  # `ranges` rows at most
        placed = counts.withColumn("upto", upto).join(cut.select("k", "rank", "before"), ["k", "rank"])
        inside = (F.col("rank") >= F.col("before") + F.col("upto") - F.col("c")) & (F.col("rank") < F.col("before") + F.col("upto"))
        after = placed.where(inside).select("k", "rank", (F.col("before") + F.col("upto") - F.col("c")).alias("before"), "held", "low", "high")
        now = written(now.where(~open_).unionByName(after), "ranks")
    near = keyed.join(broadcast_below(now.where("low < high"), 100_000), "k").where("v BETWEEN low AND high").groupBy("k", "rank", "before", "v").agg(F.sum("w").alias("c"))
    upto = F.sum("c").over(Window.partitionBy("k", "rank").orderBy("v"))
    sorted_ = near.withColumn("upto", upto).where((F.col("rank") - F.col("before") >= F.col("upto") - F.col("c")) & (F.col("rank") - F.col("before") < F.col("upto")))
    values = sorted_.select("k", "rank", "v").unionByName(now.where("low = high").select("k", "rank", F.col("low").alias("v")))
    lower, upper = (values.select("k", F.col("rank").alias(r), F.col("v").alias(v)) for r, v in (("r0", "v0"), ("r1", "v1")))
    both = wanted.select("k", "q", F.floor("q.x").alias("r0"), F.ceil("q.x").alias("r1")).join(lower, ["k", "r0"]).join(upper, ["k", "r1"])
    share = F.col("q.x") - F.col("r0")
    one = F.when(F.col("r0") == F.col("r1"), F.col("v0")).otherwise(F.col("v0") * (1 - share) + F.col("v1") * share)
    spread = both.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("q.i", one.alias("v")))), lambda x: x["v"]).alias("p"))
    return plain.unionByName(spread).select("k.*", "p")


def _bootstrap(rows: DataFrame, of: str, replicates: int, seed: int, most: int) -> DataFrame:
    """(k, v): estimates by replicate. Rows are multiplied by replicates in the map side of one aggregate."""
    numbered = rows.groupBy("k", "v").agg(F.count("*").alias("copies")).select("k", "v", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("i")).select("k", "v", "i", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("r"))
    u = (F.shiftrightunsigned(F.xxhash64("k", "v", "i", "r", F.lit(seed)), 11).cast("double") + 0.5) / F.lit(2.0**53)
    chances, total, p = [], 0.0, 0.36787944117144233
    for k in range(1, 9):  # Poisson(1): the weight is the number of thresholds passed
        total += p
        chances.append(total)
        p /= k
    weighed = numbered.withColumn("w", sum(((u > c).cast("int") for c in chances), F.lit(0))).where("w > 0")
    if of == "median":
        return exact_percentiles(weighed, ["k", "r"], [0.5], most, "w").select("k", F.col("p")[0].alias("v"))
    return weighed.groupBy("k", "r").agg((F.sum(F.col("v") * F.col("w")) / F.sum("w")).alias("v"))


# windows
def companions(rows: DataFrame, work: str, author: str, date: str) -> DataFrame:
    """(author, work, date, others): the other authors of each work, as a sorted set. One row per author and work."""
    one = rows.select(work, author, date).where(F.col(author).isNotNull()).dropDuplicates([work, author])
    all_of = one.groupBy(work).agg(F.collect_set(author).alias("all"))
    return one.join(all_of, work).select(author, work, date, F.sort_array(F.array_remove("all", F.col(author))).alias("others"))


def running_sums(df: DataFrame, key: str, order: list[str], values: list[str], most: int = 1_000_000, previous: dict[str, str] | None = None) -> DataFrame:
    """df with each of the values replaced by its sum up to the row, over the rows of the key in the given order (rows that are equal in it
    in any order, so let it be complete); null values count as 0, null keys are one key. df should be cheap to read several times.

    previous: new columns with the value of another one, which must not fall along the order, in the row before; null in a key's first row.
    Keys of at most `most` rows are summed by a window. Rows of larger ones are dealt out by ranges of key and order, so that they are spread
    over many tasks. Each range is summed by itself; what its first key carries from earlier ranges is one row for a range at most, which is broadcast.
    """
    large = written(df.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("n")).where(F.col("n") > most).select("_k"), "large")
    previous = previous or {}
    upto = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    plain = {p: F.lag(c).over(Window.partitionBy(key).orderBy(*order)) for p, c in previous.items()} | {v: F.coalesce(F.sum(v).over(upto), F.lit(0)) for v in values}
    if large.isEmpty():
        return df.withColumns(plain)
    hot = broadcast_below(large, 100_000)
    few = df.join(hot, F.col(key).eqNullSafe(F.col("_k")), "left_anti").withColumns(plain)
    many = df.join(hot, F.col(key).eqNullSafe(F.col("_k")), "left_semi")
    ranged = written(many.repartitionByRange(F.col(key), *map(F.col, order)).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy(F.col(key).alias("_k"), F.col("_range").alias("_r")).agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(f"_c_{v}") for v in values], *[F.max(c).alias(f"_p_{p}") for p, c in previous.items()])
    before = Window.partitionBy("_k").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("_k", "_r", *[F.sum(f"_c_{v}").over(before).alias(f"_c_{v}") for v in values], *[F.max(f"_p_{p}").over(before).alias(f"_p_{p}") for p in previous]).where(F.col(f"_c_{values[0]}").isNotNull())  # none for a key's first range
    within = Window.partitionBy(key, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    last = {p: F.lag(c).over(Window.partitionBy(key, "_range").orderBy(*order)) for p, c in previous.items()}
    own = ranged.withColumns(last | {v: F.coalesce(F.sum(v).over(within), F.lit(0)) for v in values})
    out = own.join(F.broadcast(carried), F.col(key).eqNullSafe(F.col("_k")) & (F.col("_range") == F.col("_r")), "left")
    out = out.withColumns({v: F.col(v) + F.coalesce(f"_c_{v}", F.lit(0)) for v in values} | {p: F.coalesce(p, f"_p_{p}") for p in previous})
    return few.unionByName(out.select(*df.columns, *previous))


#: Works of a span by number up to which a row holds their sets.
FEW_SETS = 32


def rolling_overlap(rows: DataFrame, author: str, work: str, date: str, members: str = "others", last: int = 5) -> DataFrame:
    """rows with rolling_jaccard over the sets of the author's last works, by date then work; fewer at the start.
    A row holds the sets of a few works; longer spans are counted as in rolling_overlap_days()."""
    if last > FEW_SETS:
        return _overlap(rows, author, work, F.col(date), members, last, by_number=True)
    w = Window.partitionBy(author).orderBy(date, work).rowsBetween(-(last - 1), 0)
    return rows.withColumn("rolling_jaccard", jaccard(F.collect_list(members).over(w)))


def rolling_overlap_days(rows: DataFrame, author: str, work: str, date: str, members: str = "others", days: int = 365) -> DataFrame:
    """The same over the works of the days that end with the row's time, the left end open; of works at the same time, those up to it in the order of work."""
    time = F.coalesce(F.unix_micros(F.col(date).cast("timestamp")), F.lit(-(1 << 61)))  # works without a date come first, together
    return _overlap(rows, author, work, time, members, days * 86_400_000_000)


def _overlap(rows: DataFrame, author: str, work: str, time: Column, members: str, span: int, by_number: bool = False, most: int = 1_000_000) -> DataFrame:
    """Intersection of the sets of a span's works by their union, from running counts; a span holds the works less than `span` before the row,
    in time or, by_number, in the author's works.

    No row holds the sets of its span, and no event is made for a member of one work only. The union is the sum of the sizes of the span's sets, less
    one for each member that was in the span already: -1 where it comes again, +1 where the earlier work leaves. A member is in all works of the
    span while it is in each work since the one that left the span last: for each stretch of two or more consecutive works with the member, +1
    once the work before the stretch has left, and -1 after its last work; a work that is alone in its span has its own set. Both are running
    sums over an author's events: two for a work, and those of members that come again within the span. Null sets count as empty.
    """
    held = written(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    bare = held.select(F.col(author).alias("a"), time.alias("t"), F.col(work).alias("w"), "_row", F.array_distinct(members).alias("m"), F.lit(1).cast("bigint").alias("n"))
    numbered = running_sums(bare, "a", ["t", "w", "_row"], ["n"], most, {"before": "t"})
    if by_number:
        numbered = numbered.withColumns({"t": F.col("n"), "before": F.when(F.col("n") > 1, F.col("n") - 1)})
    numbered = written(numbered.select("a", "t", "n", "_row", "before", "m", F.greatest(F.coalesce(F.size("m"), F.lit(0)), F.lit(0)).cast("bigint").alias("size")), "numbered")
    w = Window.partitionBy("a", "m").orderBy("n")
    met = numbered.select("a", "t", "n", "before", F.explode("m").alias("m")).withColumns({"pn": F.lag("n").over(w), "pt": F.lag("t").over(w), "nn": F.lead("n").over(w), "stretch": F.col("n") - F.row_number().over(w)})
    again, follows = F.coalesce(F.col("t") < F.col("pt") + span, F.lit(False)), F.coalesce(F.col("pn") == F.col("n") - 1, F.lit(False))
    met = met.withColumns({"again": again, "run": follows | F.coalesce(F.col("nn") == F.col("n") + 1, F.lit(False))}).where("again OR run")
    met = written(met, "met")
    event = lambda at, phase, n, sub, union, common: F.struct(at.alias("t"), F.lit(phase).alias("phase"), n.cast("bigint").alias("n"), F.lit(sub).alias("sub"), union.cast("bigint").alias("union"), F.lit(common).cast("bigint").alias("common"))
    none, gone = F.lit(0), F.lit(None).cast("bigint").alias("_row")
    union = met.where("again").select("a", F.explode(F.array(event(F.col("t"), 1, F.col("n"), 0, F.lit(-1), 0), event(F.col("pt") + span, 0, none, 0, F.lit(1), 0))).alias("e"))
    runs = met.where("run").groupBy("a", "m", "stretch").agg(F.min("n").alias("s"), F.max("n").alias("e"), F.min("t").alias("ts"), F.max("t").alias("te"), F.min_by("before", "n").alias("before"))
    alone = F.col("before") + span  # when the work before the stretch leaves
    runs = runs.where(F.col("before").isNull() | (F.col("te") >= alone))
    starts = F.when(F.col("before").isNull() | (F.col("ts") >= alone), event(F.col("ts"), 1, F.col("s"), 0, none, 1)).otherwise(event(alone, 0, none, 0, none, 1))
    common = runs.select("a", F.explode(F.array(starts, event(F.col("te"), 1, F.col("e"), 2, none, -1))).alias("e"))
    leaves = numbered.where("size > 0").select("a", event(F.col("t") + span, 0, none, 0, -F.col("size"), 0).alias("e"))
    events = reduce(DataFrame.unionByName, (union, common, leaves)).select("a", "e.*", gone, gone.alias("own"))
    only = F.when(F.col("before").isNull() | (F.col("t") >= F.col("before") + span), F.col("size"))
    marks = numbered.select("a", event(F.col("t"), 1, F.col("n"), 1, F.col("size"), 0).alias("e"), "_row", only.alias("own")).select("a", "e.*", "_row", "own")
    events = written(events.unionByName(marks), "events")
    sums = running_sums(events, "a", ["t", "phase", "n", "sub"], ["union", "common"], most).where("_row IS NOT NULL")
    found = sums.select("_row", (F.coalesce("own", "common") / F.greatest(F.lit(1), F.col("union"))).alias("rolling_jaccard"))
    return held.join(found, "_row").drop("_row")


def added_authors(done: DataFrame, rows: DataFrame, author: str, compute) -> DataFrame:
    """done with compute(rows) of the authors that it does not have yet."""
    return done.unionByName(compute(without_ids(rows, author, done.select(author).distinct())))


# reports
def missing_tables(parents: DataFrame, children: DataFrame, tables: list[str]) -> DataFrame:
    """(source_file, missing): tables without rows of a source file of the parent; children is (source_file, table)."""
    names = F.explode(F.array(*map(F.lit, tables))).alias("table")
    every = parents.select("source_file").distinct().select("source_file", names)
    return every.join(children.select("source_file", "table").distinct(), ["source_file", "table"], "left_anti").groupBy("source_file").agg(F.sort_array(F.collect_list("table")).alias("missing"))


def validated(manifest: DataFrame, counts: DataFrame, tolerance: int = 5) -> DataFrame:
    """(filename, expected, actual, difference) of the files whose row counts are off by more than the tolerance."""
    joined = manifest.select("filename", F.col("records").alias("expected")).join(counts.select("filename", F.col("n").alias("actual")), "filename", "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
    return joined.withColumn("difference", F.col("expected") - F.col("actual")).where(F.abs("difference") > tolerance)


def inconsistent_keys(df: DataFrame, key: str, inner: str) -> DataFrame:
    """(key, problem): keys that are null, differ from the one inside the document, or occur more than once."""
    problem = F.when(F.col(key).isNull(), "null").when(~F.col(key).eqNullSafe(F.col(inner)), "differs")
    one = df.select(F.col(key).alias("key"), problem.alias("problem")).where("problem IS NOT NULL")
    twice = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).count().where("count > 1").select("key", F.lit("repeated").alias("problem"))
    return one.unionByName(twice)


def repaired_keys(df: DataFrame, key: str, inner: str) -> DataFrame:
    """Rows under the key inside the document: a key that is null or differs is replaced by it, rows without an inner
    key go, and of rows that repeat a key one stays, that whose key was right before, then the first by a hash of the row."""
    was = F.col(key).eqNullSafe(F.col(inner))
    rows = df.where(F.col(inner).isNotNull()).withColumns({"_was": was, "_order": F.xxhash64(*df.columns), key: F.col(inner)})
    return keep_first(rows, [key], F.desc("_was"), "_order").drop("_was", "_order")


def required(df: DataFrame, what: str) -> DataFrame:
    """df, or an error if it has no rows."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def write_slice(works: DataFrame, children: dict[str, DataFrame], target: str, work: str = "work_id", key: str = "work_id", edge: tuple[str, str, str] | None = None) -> dict[str, DataFrame]:
    """The whole slice job: works to target/works, then each child table (its work in column key) cut to them. Returns what was written."""
    write_parquet(works, f"{target}/works")
    spark = works.sparkSession
    ids = spark.read.parquet(f"{target}/works").select(F.col(work).alias(key))
    for name, df in slice_tables(ids, children, key, edge).items():
        write_parquet(df, f"{target}/{name}")
    return {name: spark.read.parquet(f"{target}/{name}") for name in ("works", *children)}


def slice_tables(works: DataFrame, children: dict[str, DataFrame], work: str = "work_id", edge: tuple[str, str, str] | None = None) -> dict[str, DataFrame]:
    """Child tables cut to the works; edge (table, src, dst) keeps edges with both ends. Ids stay on the cluster."""
    ids = works.select(work)
    out = {}
    for name, df in children.items():
        out[name] = induced_edges(df, ids, edge[1], edge[2]) if edge and name == edge[0] else with_ids(df, work, ids)
    return out
