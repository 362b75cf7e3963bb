"""Windows, graphs, reports, sources, sinks and ingest."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from lattica.operators import graph as g
from lattica.operators import relational as r
from lattica.operators.components import connected_components
from lattica.sources import scans, sinks
from lattica.streaming.ingest import absent_tables, current_rows, ingest, pending, recompute_missing, save_batch


def test_rolling(spark):
    rows = spark.createDataFrame([(1, w, f"2020-01-0{w}", m) for w, m in ((1, ["b", "c"]), (2, ["b"]), (3, []), (4, ["d"]))], "author int, work int, day string, others array<string>")
    out = r.rolling_overlap(rows, "author", "work", "day", last=2).orderBy("work").collect()
    assert [x.rolling_jaccard for x in out] == [1.0, 0.5, 0.0, 0.0]
    days = r.rolling_overlap_days(rows, "author", "work", "day", days=2).orderBy("work").collect()
    assert [x.rolling_jaccard for x in days] == [1.0, 0.5, 0.0, 0.0]


def test_log(spark):
    log = spark.createDataFrame([(f"2020-01-0{i}", p, t, 1) for i, (p, t) in enumerate((("p1", "works"), ("p1", "ids"), ("p2", "works"), ("p1", "works")), 1)], "timestamp string, path string, table string, records long")
    assert [x.path for x in r.completed(log, 2).collect()] == ["p1"]
    entries = spark.createDataFrame([("p1",), ("p2",)], "filename string")
    assert [x.filename for x in pending(entries, log, 2).collect()] == ["p2"]


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7), (200, 200)]
    edges = spark.createDataFrame(chain, "src long, dst long")
    for few in (0, 1000):
        found = {x.id: x.component for x in connected_components(edges, few=few).collect()}
        assert {found[i] for i in range(1, 41)} == {1} and found[101] == 100 and found[200] == 200 and len(found) == 43
        assert connected_components(edges.where("src < 0"), few=few).count() == 0
    wide = edges.selectExpr("cast(cast(src AS string) AS binary) AS a", "cast(cast(dst AS string) AS binary) AS b")
    one, other = ({bytes(x.id): bytes(x.component) for x in connected_components(wide, "a", "b", few=few).collect()} for few in (0, 1000))
    assert one == other
    odd = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src long, dst long")
    assert g.is_bipartite(odd).first().bipartite is False and g.is_bipartite(edges.where("src <> dst")).first().bipartite is True


def test_weights_and_estimates(spark):
    edges = spark.createDataFrame([(1, 2), (1, 3)], "src long, dst long")
    counts = spark.createDataFrame([(1, 2), (2, 3)], "work long, n long")
    assert [(x.dst, x.weight) for x in g.citation_weights(edges, counts, "work", "n").collect()] == [(2, 1 / 6)]
    rows = spark.createDataFrame([("a", float(v)) for v in range(20)] + [("b", 1.0), ("b", None)], "k string, v double")
    for of in ("mean", "median"):
        out = {x.k: x for x in r.estimate(rows, "k", "v", of=of, error="ci", replicates=300).collect()}
        assert out["a"].ymin < 9.5 < out["a"].ymax and out["b"].ymin is None and out["b"].n == 1
    assert r.missing_tables(spark.createDataFrame([("f",)], "source_file string"), spark.createDataFrame([("f", "x")], "source_file string, table string"), ["x", "y"]).first().missing == ["y"]
    with pytest.raises(ValueError):
        r.required(rows.where("false"), "rows")


def test_sources_and_sinks(spark, tmp_path):
    with gzip.open(tmp_path / "a.gz", "wt") as f:
        f.write('{"id":"https://example.org/A1","display_name":"x"}\n\nnot json\n')
    good, bad = scans.read_entity_tolerant(spark, "authors", str(tmp_path / "a.gz"))
    assert good.count() == 1 and bad.first().line == "not json"
    (tmp_path / "manifest").write_text(json.dumps({"entries": [{"url": "s3://bucket/data/b", "meta": {"record_count": 5}}, {"url": "s3://bucket/data/a", "meta": {"record_count": 2}}, {"url": "c", "meta": {"record_count": 0}}], "meta": {"record_count": 7}}, indent=1))
    assert [(x.filename, x.records, x.total) for x in scans.read_manifest(spark, str(tmp_path / "manifest"), "s3://bucket/data/").collect()] == [("a", 2, 7), ("b", 5, 7)]
    df = spark.createDataFrame([(1, "a", 0.5), (2, "b", None)], "work_id long, name string, score double")
    sinks.write_csv(df, str(tmp_path / "csv"), ["work_id", "name"])
    assert scans.read_csvs(spark, str(tmp_path / "csv"), {"id": "cast(work_id AS int)"}).count() == 2
    with pytest.raises(ValueError):
        sinks.write_csv(df, str(tmp_path / "csv"), ["work_id"], strict=True)
    sinks.write_parquet(df, str(tmp_path / "p"), ["work_id", "score", "year"])
    assert dict(scans.read_table(spark, str(tmp_path / "p")).dtypes) == {"work_id": "bigint", "score": "float", "year": "smallint"}
    facts, rows = scans.peek(scans.read_table(spark, str(tmp_path / "p")))
    assert facts.first().rows == 2 and rows.count() >= 1
    assert scans.rows_in(df, "work_id", [1]).count() == 1 == scans.rows_in(df, "work_id", spark.createDataFrame([(1,)], "x long")).count()
    (tmp_path / "t.csv").write_text("work_id,is_oa,n,title\n1,true,3,x\n")
    assert [f.dataType.simpleString() for f in scans.named_types(spark, str(tmp_path / "t.csv"))] == ["string", "boolean", "bigint", "string"]


def test_ingest(spark, tmp_path):
    source = tmp_path / "in"
    os.makedirs(source)
    (source / "f1.json").write_text('{"id":"https://example.org/A1","display_name":"x"}\nbad\n')
    run = lambda: ingest(spark, "authors", str(source), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    run()
    (source / "f2.json").write_text('{"id":"https://example.org/A2","display_name":"y"}\n')
    run()
    rows = spark.read.parquet(str(tmp_path / "out/authors"))
    assert sorted(x.author_id for x in rows.collect()) == [1, 2]
    assert {x.source_file.rsplit("/", 1)[-1] for x in rows.collect()} == {"f1.json", "f2.json"}
    log = spark.read.parquet(str(tmp_path / "out/_log"))
    assert log.where(F.col("table") == "authors").count() == 2
    assert {(x.table, x.records) for x in log.where("path LIKE '%f1.json'").collect()} == {("authors", 1), ("authors_hints", 1), *((f"authors_{k}", 0) for k in ("ids", "counts_by_year", "concepts", "concepts_zero"))}
    assert absent_tables(spark, "authors", str(tmp_path / "out")).count() == 0
    log.where("NOT (table = 'authors_hints' AND path LIKE '%f2.json')").drop("batch").write.parquet(str(tmp_path / "log2"))
    spark.read.parquet(str(tmp_path / "log2")).write.mode("overwrite").parquet(str(tmp_path / "out/_log"))
    assert [x.missing for x in absent_tables(spark, "authors", str(tmp_path / "out")).collect()] == [["authors_hints"]]
    assert recompute_missing(spark, "authors", str(tmp_path / "out"), "again") == ["authors_hints"]
    assert [x.author_id for x in spark.read.parquet(str(tmp_path / "out/authors_hints/batch=again-0")).collect()] == [2]
    (source / "f3.json").write_text('{"id":"https://example.org/A1","display_name":"newer"}\n')
    os.makedirs(tmp_path / "later")
    save_batch(spark.read.text(str(source / "f3.json")).select("value", F.lit("f3").alias("source_file")), "7", "authors", str(tmp_path / "out"))
    assert sorted((x.author_id, x.author_name) for x in current_rows(spark, "authors", str(tmp_path / "out"), "authors", "author_id").collect()) == [(1, "newer"), (2, "y")]
