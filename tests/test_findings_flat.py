"""Skipped ids meet the rows of a flat table without a shuffle of these rows."""

import pytest
from pyspark.sql import functions as F

from lattica.operators import flatten as fl
from lattica.plans import entities

NAMED = ["works_mesh", "works_biblio", "works_open_access", "works_abstracts", "works_host_venues", "works_concepts", "works_alternate_host_venues"]


@pytest.fixture
def no_broadcast(spark):
    """Only what is broadcast by a hint."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def orders(spark, at):
    """4,000 orders in the form of the driver's, of which a tenth is skipped."""
    rows = spark.range(4000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 77).alias("o_custkey"), F.element_at(F.array(*map(F.lit, "FOP")), (F.col("id") % 3 + 1).cast("int")).alias("o_orderstatus"), F.lit("1-URGENT").alias("o_orderpriority"), F.lit("1995-01-01").cast("timestamp").alias("o_orderdate"))
    rows.write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame([(0, "AFRICA")], "r_regionkey bigint, r_name string").write.parquet(f"{at}/region.parquet")


@pytest.mark.parametrize("name", NAMED)
def test_no_works_are_shuffled_to_meet_skipped_ones(spark, tmp_path, no_broadcast, name):
    orders(spark, tmp_path)
    rows = entities.QUERIES[f"flat_{name}"](spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and plan.count("BroadcastHashJoin") == 1
    assert {r["work_id"] % 10 for r in rows.select("work_id").collect()} == set(range(10)) - {3}


@pytest.mark.parametrize("max_bytes", [128 << 20, 0])
def test_bits_hold_just_the_ids(spark, max_bytes):
    """Ends of words and blocks, both signs, far apart, repeated, null; in rows of 64 words and of one."""
    some = [0, 1, 62, 63, 64, 4095, 4096, -1, -64, -65, -4096, 4285719527, 2**63 - 1, -(2**63), 5, 5, None]
    held = fl.id_bits(spark.createDataFrame([(x,) for x in some], "id bigint"), max_bytes)
    assert held[1] == (12 if max_bytes else 6)
    asked = sorted({min(max(x + d, -(2**63)), 2**63 - 1) for x in some if x is not None for d in (-4096, -64, -1, 0, 1, 64, 4096)})
    rows = spark.createDataFrame([(x,) for x in [*asked, None, None]], "k bigint")
    left = [r["k"] for r in fl.without(rows, "k", held).collect()]
    assert sorted(x for x in left if x is not None) == [x for x in asked if x not in some] and left.count(None) == 2


@pytest.mark.parametrize("name", sorted(fl.DEPENDS.keys() - {"works", "works_authorships", "works_referenced_works"}))
def test_rows_that_name_skipped_ids_go_without_a_shuffle(spark, tmp_path, no_broadcast, monkeypatch, name):
    orders(spark, tmp_path)
    works = entities.work_records(spark.read.parquet(f"{tmp_path}/orders.parquet"))
    skip = {"works": spark.range(3, 5000, 10), "sources": spark.range(4, 50, 10)}
    made, keep = [], fl.written
    monkeypatch.setattr(fl, "written", lambda df, what: made.append(df.columns) or keep(df, what))
    rows = fl.flatten_works(works, skip, only=[name])[name]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    assert made and all(c == ["word", "bits"] for c in made)
    monkeypatch.undo()
    every = fl.flatten_works(works, skip)[name]
    mixed = fl.flatten_works(works, skip, only=["works", name])[name]
    assert sorted(map(str, rows.collect())) == sorted(map(str, every.collect())) == sorted(map(str, mixed.collect())) and rows.count() > 1000
