"""The ingest moves no whole works: neither where ids are skipped, nor where tables are read back."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lattica.operators import flatten as fl
from lattica.streaming import ingest as ing

SITE = "https://example.org/"


def work(n, refs=(), source=None):
    place = {"source": {"id": f"{SITE}S{source}"}} if source is not None else None
    return {"id": f"{SITE}W{n}", "title": f"work {n}", "referenced_works": [f"{SITE}W{r}" for r in refs], "locations": [place] if place else None}


def drop(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in records)


@pytest.fixture
def no_broadcast(spark):
    """Only what is broadcast by a hint."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_whole_works_are_neither_written_twice_nor_shuffled(spark, tmp_path, monkeypatch, no_broadcast):
    drop(tmp_path / "in", "a", [work(1, [2, 3, 103], 4), work(3, [1]), work(103), work(5, [5, 6], 7), work(7, [], 4)])
    gone = {"works": spark.range(3, 20_000, 100), "sources": spark.createDataFrame([(4,), (4,), (None,)], "id bigint")}
    made, parents, keep, keep_parents = [], [], fl.written, ing.work_parents
    monkeypatch.setattr(fl, "written", lambda df, name: made.append(name) or keep(df, name))
    monkeypatch.setattr(ing, "work_parents", lambda *a, **k: parents.append(keep_parents(*a, **k)) or parents[-1])
    lines = spark.read.text(str(tmp_path / "in")).select("value", F.col("_metadata.file_path").alias("source_file"))
    ing.save_batch(lines, "0", "works", str(tmp_path / "out"), gone)
    assert made == ["skipped"]
    assert "Exchange hash" not in plan(parents[0]) and "SortMergeJoin" not in plan(parents[0])

    def read(name, column):
        return sorted((r["work_id"], r[column]) for r in ing.current_rows(spark, "works", str(tmp_path / "out"), name, "work_id").collect())

    assert read("works", "num_references") == [(1, 1), (5, 2), (7, 0)]
    assert read("works", "num_locations") == [(1, 0), (5, 1), (7, 0)]
    assert read("works_referenced_works", "referenced_work_id") == [(1, 2), (5, 5), (5, 6)] and read("works_locations", "source_id") == [(5, 7)]


def test_rows_are_read_back_without_a_shuffle(spark, tmp_path, monkeypatch, no_broadcast):
    monkeypatch.setattr(ing, "BATCH_BYTES", 1, raising=False)
    at = str(tmp_path)
    for i in range(3):  # a file of its own and so a batch of its own
        drop(f"{at}/in", f"f{i}", [work(0, [i]), work(10 + i, [20, 21])])
        os.utime(f"{at}/in/f{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    ing.ingest(spark, "works", f"{at}/in", f"{at}/out", f"{at}/state").awaitTermination()
    assert ing.current_files(spark, f"{at}/out").select("batch").distinct().count() == 3
    for name, want in (("works", [(0, 1), (10, 2), (11, 2), (12, 2)]), ("works_referenced_works", [(0, 2), *[(w, r) for w in (10, 11, 12) for r in (20, 21)]])):
        rows = ing.current_rows(spark, "works", f"{at}/out", name, "work_id")
        column = "num_references" if name == "works" else "referenced_work_id"
        assert sorted((r["work_id"], r[column]) for r in rows.collect()) == want
        scan = plan(rows).split("BroadcastHashJoin")[0]
        assert "SortMergeJoin" not in scan and "Exchange hash" not in scan


def test_a_table_of_another_batch_than_its_parents(spark, tmp_path):
    out = str(tmp_path / "out")
    drop(tmp_path / "in", "a", [work(1, [5]), work(2, [6])])
    drop(tmp_path / "in", "b", [work(2, [7]), work(3, [8])])
    lines = lambda *names: spark.read.text([str(tmp_path / f"in/{n}.json") for n in names]).select("value", F.col("_metadata.file_path").alias("source_file"))
    ing.save_batch(lines("a"), "0", "works", out)
    ing.save_batch(lines("b"), "1", "works", out)
    drop(tmp_path / "in", "b", [work(2, [9]), work(4, [8])])  # 4 has no parent row
    ing.save_batch(lines("b"), "2", "works", out, only=["works_referenced_works"])
    rows = ing.current_rows(spark, "works", out, "works_referenced_works", "work_id")
    assert sorted((r["work_id"], r["referenced_work_id"]) for r in rows.collect()) == [(1, 5), (2, 9)]
