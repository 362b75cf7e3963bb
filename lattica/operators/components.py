"""Connected components by alternating star contraction, or in one task where edges are few."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import dropped, spread, written

#: Edges up to which one task joins them.
FEW = 200_000
#: Vertices of which a task keeps a forest at a time.
HELD = 2_000_000


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, component) of edges (u, v), by union-find with the smallest vertex on top."""
    parent: dict = {}

    def top(x):
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    kind = None
    for b in batches:
        kind = b.schema.field(0).type
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            low, high = sorted((top(u), top(v)))
            parent[high] = low
    if kind is not None:
        ids = list(parent)
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(map(top, ids), kind)], names=["id", "component"])


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) from each vertex of a task to the smallest one that the task's edges join it to: as few as its vertices.
    A task with more vertices than HELD gives a forest for each part of its edges."""
    parent: dict = {}
    kind = None

    def top(x):
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    def forest() -> pa.RecordBatch:
        inner = {p for x, p in parent.items() if p != x}
        ids = [x for x, p in parent.items() if p != x or x not in inner]  # a vertex by itself stays as a loop
        tops = list(map(top, ids))
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(tops, kind)], names=["u", "v"])

    for b in batches:
        kind = b.schema.field(0).type
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            x, y = top(u), top(v)
            if x < y:
                parent[y] = x
            elif y < x:
                parent[x] = y
        if len(parent) > HELD:
            yield forest()
            parent.clear()
    if parent:
        yield forest()


def contracted(pairs: DataFrame, fan_in: int = 4, width: int = 2_000_000, enough: int = 0) -> DataFrame:
    """Edges (u, v) with the same components, fewer of them: each task keeps a spanning forest of its edges, then the forests of
    fan_in tasks meet in one, as long as there are more than `enough`, and that leaves at most `width` edges to a task and takes away a tenth of all."""
    kind = pairs.schema["u"].dataType.simpleString()
    now = written(pairs.mapInArrow(_forests, f"u {kind}, v {kind}"), "forest")
    n = now.count()
    while n > enough and (tasks := len(now.inputFiles())) > 1:
        fewer = max(1, tasks // fan_in, -(-n // width))
        if fewer >= tasks:
            break
        after = written(now.coalesce(fewer).mapInArrow(_forests, f"u {kind}, v {kind}"), "forest")
        dropped(now)
        now, before = after, n
        n = now.count()
        if n > 0.9 * before:
            break
    return now


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", few: int = FEW, local: bool = True) -> DataFrame:
    """(id, component) for each vertex of the undirected graph; component is its smallest vertex.

    First each task reduces its own edges to a spanning forest, without a shuffle (contracted(); local=False leaves that out). If at
    most `few` edges are left, one task joins them. Else come rounds: each points every larger neighbour of a vertex to the smallest
    one around it (large star), then every smaller one (small star); a round roughly halves the depth, so rounds grow with the
    logarithm of the diameter. Minima are aggregated before the shuffle and written as a table, so a hub's edges meet them in a join
    that AQE can split. Self loops give a vertex of its own; rows with a null end are ignored; repeated edges count once; an empty
    input gives no rows. Vertices are integers or binary; text orders by its bytes.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    dealt = spread(pairs, pairs.count(), "u", "v")  # repeated edges meet, and a hub's are spread
    once = contracted(dealt, enough=few) if local else written(dealt.distinct(), "edges")
    n = once.count()
    if n <= few:
        kind = once.schema["u"].dataType.simpleString()
        return written(once.coalesce(1).mapInArrow(_joined, f"id {kind}, component {kind}"), "components")
    alone = once.where("u = v").select("u", "v").distinct()
    distinct = lambda df: spread(df, n, "u", "v").distinct()
    salt = F.pmod(F.xxhash64("v"), F.lit(8))  # parts of a hub's edges give their minima first
    least = lambda df, rows: spread(df, rows, "u", salt).groupBy("u").agg(F.min("v").alias("m"))
    now = written(distinct(once.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "edges")
    before = None
    while (state := now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()) != before:
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(least(both, 2 * n).select("u", F.least("u", "m").alias("m")), "low")
        large = written(distinct(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")), "large")
        dropped(low)
        low = written(least(large, n), "low")
        met = large.join(low, "u")
        small = met.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v")))
        after = written(distinct(small), "edges")
        for old in (low, large, now):
            dropped(old)
        now = after
    tops = now.select(F.col("v").alias("id"), F.col("v").alias("component"))  # as often as they have vertices under them
    every = now.toDF("id", "component").unionByName(tops.distinct()).unionByName(alone.toDF("id", "component"))
    return spread(every, n, "id").groupBy("id").agg(F.min("component").alias("component"))
