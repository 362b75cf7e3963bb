"""Percentiles, running sums, overlaps, pairs and components whose tasks stay small, against plain versions."""

import itertools
import os
import random
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lattica.operators import components, graph
from lattica.operators import relational as r


def percentile(values, share):
    at = share * (len(values) - 1)
    low, high = int(np.floor(at)), int(np.ceil(at))
    return values[low] if low == high else values[low] * (1 - (at - low)) + values[high] * (at - low)


@pytest.mark.parametrize("most,weight", [(100_000, None), (60, "w")])
def test_exact_percentiles(spark, most, weight):
    rng = np.random.default_rng(1)
    rows = [(1, float(x), int(w)) for x, w in zip(rng.lognormal(0, 2, 1500), rng.integers(0, 4, 1500), strict=True)]
    rows += [(2, 5.0, 1)] * 300 + [(3, float(x), 1) for x in rng.integers(0, 3, 300)] + [(None, float(x), 2) for x in range(200)]
    rows += [(4, 1.0, 1), (5, None, 1), (5, float("nan"), 1), (6, float("inf"), 1), (6, float("-inf"), 1), *[(6, float(x), 1) for x in range(100)], (7, 1e308, 1), (7, -1e308, 1), *[(7, x * 1e306, 1) for x in range(90)]]
    shares = [0.025, 0.5, 0.75]
    frame = spark.createDataFrame(rows, "k int, v double, w int").repartition(4)
    got = {x["k"]: x["p"] for x in r.exact_percentiles(frame, ["k"], shares, most, weight, ranges=64).collect()}
    assert set(got) == {1, 2, 3, None, 4, 6, 7}
    for k, p in got.items():
        values = sorted(v for a, v, w in rows if a == k and v is not None for _ in range(w if weight else 1))
        assert p == pytest.approx([percentile(values, q) for q in shares], rel=1e-12)


def test_percentiles_of_one_group_hold_few_values(spark):
    frame = spark.range(300_000).select(F.lit("one").alias("g"), F.xxhash64("id").cast("double").alias("x"), (F.col("id") % 7).alias("y"))
    bars = r.estimate(frame, "g", "x", of="median", error="pi", most=1000)
    values = np.sort([row[0] for row in frame.select("x").collect()])
    got = bars.first()
    assert (got["n"], got["y"], got["ymin"], got["ymax"]) == (300_000, *(pytest.approx(percentile(values, q)) for q in (0.5, 0.025, 0.975)))
    ties = r.estimate(frame, "g", "y", of="median", error="pi", most=1000).first()
    assert (ties["y"], ties["ymin"], ties["ymax"]) == (3.0, 0.0, 6.0)
    boot = r.estimate(frame.where("id % 3000 = 0"), "g", "y", of="median", error="ci", replicates=20, most=10).first()
    assert boot["ymin"] <= boot["y"] <= boot["ymax"]


@pytest.mark.parametrize("most", [1_000_000, 10])
def test_running_sums(spark, most):
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), i, rng.randrange(9) if rng.random() < 0.9 else None, rng.randrange(5)) for i in range(600)]
    frame = spark.createDataFrame(rows, "k int, at int, a int, b int").repartition(5)
    got = {x["at"]: (x["k"], x["a"], x["b"]) for x in r.running_sums(frame, "k", ["at"], ["a", "b"], most).collect()}
    sums = {}
    for k, at, a, b in rows:
        x, y = sums.get(k, (0, 0))
        sums[k] = x + (a or 0), y + b
        assert got[at] == (k, *sums[k])
    assert len(got) == len(rows) and r.running_sums(frame.limit(0), "k", ["at"], ["a"]).count() == 0


@pytest.mark.parametrize("most", [1_000_000, 50])
def test_overlap_of_spans(spark, most):
    rng = random.Random(3)
    start, rows = datetime(2020, 1, 1), []
    for author, n in ((1, 120), (2, 40), (None, 10), (3, 1)):
        for k in range(n):
            date = None if rng.random() < 0.05 else start + timedelta(days=rng.randrange(200))
            members = None if rng.random() < 0.05 else [rng.choice("abcdef") for _ in range(rng.choice([0, 1, 3, 8]))]
            rows.append((author, rng.randrange(10_000) * 10 + k % 10, date, members, "kept", 5))
    frame = spark.createDataFrame(rows, "author int, work int, date timestamp, others array<string>, n string, t int").repartition(3)
    early = datetime(1, 1, 1)
    for by_number, span in ((False, 30), (True, 4)):
        want = Counter()
        for author in {x[0] for x in rows}:
            mine = sorted((x for x in rows if x[0] == author), key=lambda x: (x[2] or early, x[1]))
            for i, x in enumerate(mine):
                held = mine[max(0, i - span + 1) : i + 1] if by_number else [y for y in mine[: i + 1] if (y[2] or early) > (x[2] or early) - timedelta(days=span if x[2] else 0) or y[2] == x[2]]
                sets = [set(y[3] or []) for y in held]
                want[author, x[1], round(len(set.intersection(*sets)) / max(1, len(set.union(*sets))), 9)] += 1
        time = F.coalesce(F.unix_micros("date"), F.lit(-(1 << 61)))
        got = r._overlap(frame, "author", "work", F.col("date") if by_number else time, "others", span if by_number else span * 86_400_000_000, by_number, most)
        assert got.columns == [*frame.columns, "rolling_jaccard"]
        assert Counter((x["author"], x["work"], round(x["rolling_jaccard"], 9)) for x in got.collect()) == want


def test_pairs_of_a_large_work_in_small_groups(spark):
    members = spark.range(20_000).select(F.col("id").alias("l"), F.lit(7).alias("r")).unionByName(spark.createDataFrame([(1, 8), (2, 8)], "l long, r int"))
    first, second = graph.dealt_pairs(members, 500)
    for side in (first, second):
        assert side.groupBy("r", "i", "j").count().agg(F.max("count")).first()[0] < 1000  # a task gets blocks, never the work
    assert first.where("r = 8").count() == 2


def test_pairs_by_brute_force(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(90), rng.choice([0, 0, 0, 1, 2])) for _ in range(900)] + [(None, 1), (1, None)]
    want = Counter()
    for r_ in (0, 1, 2):
        want.update(itertools.combinations(sorted({x for x, y in rows if y == r_ and x is not None}), 2))
    frame = spark.createDataFrame(rows, "a int, r int")
    for block in (1000, 7):
        assert {(x["a"], x["b"]): x["weight"] for x in graph.projection(frame, "a", "r", block=block).collect()} == want


@pytest.mark.parametrize("few,held", [(200_000, 2_000_000), (0, 2_000_000), (0, 5)])
def test_components_by_forests(spark, few, held, monkeypatch):
    monkeypatch.setattr(components, "HELD", held)
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(7, 7), (999, 999), (None, 3)] + [(1000 + k, 1001 + k) for k in range(60)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None:
            low, high = sorted((top(u), top(v)))
            parent[high] = low
    frame = spark.createDataFrame(edges + edges[:20], "src int, dst int").repartition(12)
    got = components.connected_components(frame, few=few)
    assert {x["id"]: x["component"] for x in got.collect()} == {x: top(x) for x in parent} and got.count() == len(parent)
    assert components.connected_components(frame.limit(0), few=few).count() == 0


def test_forests_write_less_than_the_edges(spark):
    """Within a task a forest has fewer edges than vertices, and every further table is smaller than the one before."""
    edges = spark.range(200_000).select((F.col("id") % 5000).alias("src"), (F.xxhash64("id") % 3000 + 10_000).alias("dst")).repartition(16).toDF("u", "v")
    size = lambda df: sum(os.path.getsize(f.removeprefix("file://")) for f in df.inputFiles())
    whole, forest = components.written(edges, "edges"), components.contracted(edges)
    assert forest.count() < 0.1 * edges.count() and size(forest) < 0.25 * size(whole)
    assert components.connected_components(edges, "u", "v").select("component").distinct().count() == components.connected_components(edges, "u", "v", few=0, local=False).select("component").distinct().count()


def test_pairs_of_equal_sets_are_counted_by_classes(spark):
    rng = random.Random(7)
    sets = [(1, 2, 3), (2, 4), (5,), (1, 2, 3, 4)]
    rows = [(x, y) for x in range(120) for y in rng.choice(sets)] + [(None, 1), (1, None)]
    want = Counter()
    for r_ in range(1, 6):
        want.update(itertools.combinations(sorted({x for x, y in rows if y == r_ and x is not None}), 2))
    frame = spark.createDataFrame(rows + rows[:30], "a int, r int").repartition(3)
    pairs, held = graph.class_projection(frame, "a", "r", block=2)
    assert held.count() == 120 and pairs.count() <= 15  # five sets at most, whatever the members
    found = graph.members_of_pairs(pairs, held, block=7).collect()
    assert {(x["a"], x["b"]): x["weight"] for x in found} == want and len(found) == len(want)
    found = graph.projection(frame, "a", "r", block=7).collect()
    assert {(x["a"], x["b"]): x["weight"] for x in found} == want and len(found) == len(want)


def test_spread_tasks_hold_few_rows(spark):
    """Partitions are as many as the rows need, however few bytes they have, and stay so under AQE; one key's edges are spread."""
    rows = spark.range(100_000).select((F.col("id") % 1).alias("u"), F.col("id").alias("v"))
    parts = components.spread(rows, 100_000, "u", "v", each=5000).distinct().groupBy(F.spark_partition_id()).count().toDF("p", "n").collect()
    assert len(parts) == 20 and max(x["n"] for x in parts) < 10_000


def test_overlap_makes_no_events_for_members_of_one_work(spark, monkeypatch):
    """Two events for a work, and more only for members that come again within the span, however large the sets are."""
    rows = [(1, k, datetime(2020, 1, 1) + timedelta(days=k), [100 * k + i for i in range(50)]) for k in range(200)]
    rows[7] = (*rows[7][:3], rows[6][3])
    frame = spark.createDataFrame(rows, "author int, work int, date timestamp, others array<int>")
    made, keep = {}, r.written
    monkeypatch.setattr(r, "written", lambda df, name: made.setdefault(name, keep(df, name)))
    got = {x["work"]: x["rolling_jaccard"] for x in r.rolling_overlap_days(frame, "author", "work", "date", days=2).collect()}
    assert got[7] == 1.0 and got[0] == 1.0 and sum(got.values()) == 2.0
    assert made["events"].count() <= 2 * 200 + 4 * 50
