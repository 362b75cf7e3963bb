"""The ingest's log: generations, removal, replacement, failures half-way."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lattica.operators.relational import repaired_keys
from lattica.streaming import ingest as ing


def lines(spark, path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in records)
    return spark.read.text(str(path)).select("value", F.col("_metadata.file_path").alias("source_file"))


def author(n, name, concepts=()):
    return {"id": f"https://example.org/A{n}", "display_name": name, "x_concepts": [{"id": f"https://example.org/C{c}", "level": 0} for c in concepts]}


def names(spark, out, table="authors"):
    return sorted((r["author_id"], r["author_name"]) for r in ing.current_rows(spark, "authors", out, table, "author_id").collect())


def test_generations_replace_and_remove(spark, tmp_path):
    out = str(tmp_path / "out")
    a, b = str(tmp_path / "in/a.json"), str(tmp_path / "in/b.json")
    first = lines(spark, a, [author(1, "one", [5, 6]), author(2, "two")])
    ing.save_batch(first, "9", "authors", out)
    ing.save_batch(lines(spark, b, [author(2, "second"), author(3, "three", [7])]), "10", "authors", out)
    assert names(spark, out) == [(1, "one"), (2, "second"), (3, "three")]  # 10 comes after 9
    assert names(spark, out, "authors_concepts") == [(1, "one"), (1, "one"), (3, "three")]
    ing.save_batch(first, "9", "authors", out)  # run again: same rows, same place in the order
    assert names(spark, out) == [(1, "one"), (2, "second"), (3, "three")]
    assert ing.log_rows(spark, out).agg(F.max("generation")).first()[0] == 1
    lines(spark, a, [author(1, "new", [8])])
    ing.replace_files(spark, ["file://" + a], "again", "authors", out)
    assert names(spark, out) == [(1, "new"), (2, "second"), (3, "three")]
    assert [r["concept_id"] for r in ing.current_rows(spark, "authors", out, "authors_concepts", "author_id").where("author_id = 1").collect()] == [8]
    manifest = spark.createDataFrame([(r["source_file"], 1) for r in ing.current_files(spark, out).select("source_file").distinct().collect()], "filename string, records long")
    wrong = ing.wrong_files(spark, "authors", out, manifest)
    assert [(r["filename"].rsplit("/", 1)[1], r["actual"]) for r in wrong.collect()] == [("b.json", 2)]
    ing.remove_files(wrong, "gone", "authors", out)
    ing.remove_files(wrong, "gone", "authors", out)
    assert names(spark, out) == [(1, "new")] and names(spark, out, "authors_concepts") == [(1, "new")]
    assert ing.absent_tables(spark, "authors", out).count() == 0
    deleted = ing.clean_up(spark, "authors", out)
    assert {p.rsplit("=", 1)[1] for p in deleted} == {"9", "10"} and names(spark, out) == [(1, "new")]
    ing.save_batch(lines(spark, b, [author(3, "back")]), "11", "authors", out)
    assert names(spark, out) == [(1, "new"), (3, "back")]


def test_a_write_that_fails_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    out, a = str(tmp_path / "out"), str(tmp_path / "in/a.json")
    ing.save_batch(lines(spark, a, [author(1, "old", [1])]), "0", "authors", out)
    changed = lines(spark, a, [author(1, "new", [2])])

    def failed(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(ing, "_log", failed)
        with pytest.raises(OSError, match="lost"):
            ing.save_batch(changed, "1", "authors", out)
    assert names(spark, out) == [(1, "old")] and names(spark, out, "authors_concepts") == [(1, "old")]
    ing.save_batch(changed, "1", "authors", out)
    assert names(spark, out) == [(1, "new")]


def test_recomputed_rows_are_read(spark, tmp_path):
    out, a = str(tmp_path / "out"), str(tmp_path / "in/a.json")
    ing.save_batch(lines(spark, a, [author(1, "x", [1, 2])]), "0", "authors", out, only=[t for t in ing.table_names("authors") if t != "authors_concepts"])
    assert [r["missing"] for r in ing.absent_tables(spark, "authors", out).collect()] == [["authors_concepts"]]
    assert ing.recompute_missing(spark, "authors", out, "again") == ["authors_concepts"]
    assert names(spark, out, "authors_concepts") == [(1, "x"), (1, "x")] and names(spark, out) == [(1, "x")]
    assert ing.recompute_missing(spark, "authors", out, "never") == []


def test_works_have_all_tables_without_dimensions(spark, tmp_path):
    out, a = str(tmp_path / "out"), str(tmp_path / "in/a.json")
    work = {"id": "https://example.org/W1", "topics": [{"id": "https://example.org/T3", "score": 0.5}]}
    ing.save_batch(lines(spark, a, [work, {"id": "https://example.org/Wxx"}, {"id": None}]), "0", "works", out)
    assert [(r["topic_id"], r["topic_name"]) for r in ing.current_rows(spark, "works", out, "works_topics", "work_id").collect()] == [(3, None)]
    assert [r["work_id"] for r in ing.current_rows(spark, "works", out, "works", "work_id").collect()] == [1]
    assert ing.absent_tables(spark, "works", out).count() == 0


def test_repaired_keys(spark):
    rows = [(1, 1, "right"), (2, 1, "wrong key"), (None, 4, "no key"), (5, None, "no inner"), (6, 6, "same"), (6, 6, "same")]
    got = repaired_keys(spark.createDataFrame(rows, "key int, inner int, text string"), "key", "inner")
    assert sorted((r["key"], r["text"]) for r in got.collect()) == [(1, "right"), (4, "no key"), (6, "same")]
    assert repaired_keys(spark.createDataFrame([], "key int, inner int"), "key", "inner").count() == 0
