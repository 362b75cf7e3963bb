"""What writers leave in the files, what scans read of them, and how reports are planned."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lattica.operators import flatten as fl
from lattica.operators import relational as r
from lattica.sources import scans, sinks


def test_two_phases(spark):
    frame = spark.range(20_000).select("id", (F.col("id") % 7).cast("int").alias("few"), (F.col("id") % 1990).alias("near"), F.lit(None).cast("string").alias("none"), (F.col("id") % 3 == 0).alias("flag"))
    cols = ["id", "few", "near", "none", "flag"]
    got = {x["column"]: (x["distinct"], x["rows"], x["ratio"], x["categorise"]) for x in r.cardinality_in_two_phases(frame, cols).collect()}
    assert got["id"] == (None, 20_000, 0.1, False)
    assert got["few"] == (7, 20_000, 7 / 20_000, True) and got["none"] == (0, 20_000, 0, True) and got["flag"] == (2, 20_000, 2 / 20_000, True)
    assert got["near"] == (1990, 20_000, 0.0995, False)  # too near the bound to be told by a sketch
    assert [x["ratio"] for x in r.cardinality_in_two_phases(frame.limit(0), cols).collect()] == [None] * 5


def test_sketches_need_no_expand(spark, monkeypatch):
    """The first pass has one aggregate over the rows as they are; the second counts only the columns that are left."""
    frame, plans = spark.range(5000).select("id", (F.col("id") % 7).alias("few")), []
    keep = type(frame).first
    monkeypatch.setattr(type(frame), "first", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    r.cardinality_in_two_phases(frame, ["id", "few"])
    assert len(plans) == 2 and not any("Expand" in p for p in plans) and "hll" in plans[0] and "hll" not in plans[1]


def test_encodings_follow_the_report(spark, tmp_path):
    frame = spark.range(30_000).select("id", (F.col("id") % 7).cast("string").alias("few"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    report = r.cardinality_in_two_phases(frame, frame.columns)
    options = sinks.rewrite_by_report(frame, str(tmp_path / "t"), report, ["id"])
    assert options["parquet.enable.dictionary#few"] == "true" and options["parquet.enable.dictionary#text"] == "false"
    for file in glob.glob(f"{tmp_path}/t/*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        encodings = {group.column(i).path_in_schema: set(group.column(i).encodings) for i in range(3)}
        assert {name for name, e in encodings.items() if e & {"PLAIN_DICTIONARY", "RLE_DICTIONARY"}} == {"few"}
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.exceptAll(frame).count() == 0 == frame.exceptAll(back).count()


def rows_scanned(df):
    """Rows that the scan of the table gives, from the metrics of the plan that ran."""
    df.collect()
    found = [x.metrics().get("numOutputRows").get().value() for x in leaves(df._jdf.queryExecution().executedPlan()) if "parquet" in x.nodeName()]
    return found[0]


def leaves(plan):
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        plan = plan.plan()
    children = plan.children()
    return [plan] if not children.size() else [x for i in range(children.size()) for x in leaves(children.apply(i))]


def test_a_lookup_reads_its_buckets_only(spark, tmp_path):
    n = 200_000
    frame = spark.range(n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), "id", F.lit("x").alias("_v"))
    sinks.lookup_table(frame, str(tmp_path / "t"), "key", 200, values_per_file=n // 200)
    table = scans.read_table(spark, str(tmp_path / "t"))
    some = [k for f in sorted(glob.glob(f"{tmp_path}/t/_bucket=1*/*.parquet"))[:20] for k in pq.ParquetFile(f).read(columns=["key"]).column(0).to_pylist()]
    found = scans.lookup(table, "key", [*some, some[0], None, "no such key"], 200)
    assert sorted(r["key"] for r in found.collect()) == sorted(some) and len(some) > 10_000
    assert rows_scanned(found) < 0.15 * n and found.columns == ["key", "id", "_v"]
    one = scans.row_of(table, "key", some[0])  # by the bloom filters alone
    assert one.count() == 1 and rows_scanned(one) < 0.2 * n


@pytest.mark.parametrize("strings", [False, True])
def test_ids_as_numbers_or_urls(spark, strings):
    rows = [(" https://example.org/A7 ", "name", 1), ("https://example.org/A7", "name", 1), ("https://example.org/Axx", "odd", 1), ("https://example.org/Ayy", "odd", 1), ("", "none", 1)]
    base = spark.createDataFrame(rows, "id string, display_name string, works_count long")
    nested = base.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in scans.nested_schema("authors") if f.name not in base.columns])
    got = {x["author_id"] for x in fl.flatten("authors", nested, string_ids=strings)["authors"].collect()}
    assert got == ({"https://example.org/A7", "https://example.org/Axx", "https://example.org/Ayy"} if strings else {7})
