"""Flattening against hand-made records."""

import json

import pytest
from pyspark.sql import functions as F

from lattica.operators import flatten as fl
from lattica.schemas import NESTED, nested_schema

OA = "https://example.org/"


def inst(i, country, lineage):
    return {"id": f"{OA}I{i}", "display_name": f"inst {i}", "country_code": country, "lineage": [f"{OA}I{x}" for x in lineage]}


def author(i, *institutions, **more):
    return {"author": {"id": f"{OA}A{i}", "display_name": f"author {i}"}, "institutions": list(institutions), **more}


WORK = {
    "id": f"{OA}W10", "doi": "https://doi.org/10.1/x", "title": "A\\nB", "publication_year": 2020, "is_retracted": "True", "is_paratext": None,
    "authorships": [author(1, inst(1, "US", [1, 9]), raw_affiliation_strings=["x", "y"]), author(2), author(3, inst(1, "US", [1])), author(4, inst(2, None, [2]), inst(3, "US", [3])), author(5, inst(8, "US", [8]))],
    "referenced_works": [f"{OA}W5", f"{OA}W6", None], "related_works": [f"{OA}W5"], "keywords": [{"display_name": "k", "score": 0.5}], "grants": [{"funder": f"{OA}F7", "funder_display_name": "", "award_id": "z"}],
    "primary_location": {"source": {"id": f"{OA}S4", "display_name": "s"}, "is_oa": "true"}, "locations": [{"source": {"id": f"{OA}S4"}}, {"source": {"id": f"{OA}S9"}}, {"source": None}],
    "abstract_inverted_index": json.dumps({"hello": [0, 2], "world": [1]}), "topics": [{"id": f"{OA}T1", "score": 0.9}, {"id": f"{OA}T2", "score": 0.1}],
}


@pytest.fixture(scope="module")
def nested(spark):
    from pyspark.sql.types import StructType

    lines = spark.createDataFrame([(json.dumps(x),) for x in (WORK, {"id": None}, {"id": f"{OA}W5"})], "value string")
    from pyspark.sql import functions as F

    return lines.select(F.from_json("value", StructType.fromDDL(NESTED["works"])).alias("w")).select("w.*")


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id bigint")


def skips(spark):
    return {"works": ids(spark, 5), "authors": ids(spark, 3), "institutions": ids(spark, 8), "sources": ids(spark, 9)}


def authorship_rows(df):
    return sorted((r.author_id, r.institution_lineage_level, r.institution_id or -1, r.assigned_institution) for r in df.collect())


def test_authorships(spark, nested):
    dim = spark.createDataFrame([(i, f"n{i}", "US") for i in (1, 2, 3, 9)], "institution_id bigint, institution_name string, country_code string")
    works = fl.work_parents(nested, skips(spark))
    rows = fl.authorships(works, dim)
    assert authorship_rows(rows) == [(1, 0, 1, True), (1, 1, 9, False), (2, 0, -1, False), (4, 0, 2, True), (4, 0, 3, True), (5, 0, -1, False)]
    assert {r.raw_affiliation_string for r in rows.where("author_id = 1").collect()} == {"x;y"}
    assert authorship_rows(fl.authorships(works, dim, compat=True)) == [(1, 0, 1, True), (1, 1, 9, False), (2, 0, -1, True), (4, 0, 2, True), (5, 0, -1, True)]


def test_skipped_lineage_member_keeps_levels(spark, nested):
    works = fl.work_parents(nested, {"institutions": ids(spark, 8, 9)})
    assert (1, 1, 9, False) not in authorship_rows(fl.authorships(works))


def test_works(spark, nested):
    t = fl.flatten_works(nested, skips(spark), topics=spark.createDataFrame([(1, "one", 1, "s", 1, "f", 1, "d")], "topic_id bigint, topic_name string, subfield_id bigint, subfield_name string, field_id bigint, field_name string, domain_id bigint, domain_name string"))
    w = t["works"].collect()
    assert len(w) == 1
    w = w[0]
    assert (w.work_id, w.doi, w.title, w.num_authors, w.num_references, w.num_locations) == (10, "10.1/x", "A B", 4, 1, 1)
    assert (w.is_retracted, w.is_paratext, w.has_keywords, w.has_grant_info, w.has_complete_institution_info) == (True, False, True, True, False)
    assert [r.referenced_work_id for r in t["works_referenced_works"].collect()] == [6]
    assert t["works_related_works"].count() == 0
    assert [(r.funder_id, r.funder_name) for r in t["works_grants"].collect()] == [(7, None)]
    assert [r.source_id for r in t["works_locations"].collect()] == [4] and t["works_primary_location"].count() == 1
    assert t["works_abstracts"].first().abstract == "hello world hello"
    assert {(r.topic_id, r.is_primary_topic, r.topic_name) for r in t["works_topics"].collect()} == {(1, True, "one"), (2, False, None)}
    filled = {"works", "works_keywords", "works_grants", "works_primary_location", "works_locations", "works_referenced_works", "works_authorships", "works_abstracts", "works_topics"}
    assert {name for name, df in t.items() if not df.isEmpty()} == filled


@pytest.mark.parametrize("entity", sorted(fl.ENTITIES))
def test_entities(spark, entity):
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType

    record = {"id": f"{OA}{entity[0].upper()}7" if entity != "topics" else f"{OA}T7", "display_name": "name", "counts_by_year": [{"year": 2020, "works_count": 1}], "ids": {"own_id": "x", "wikidata": "q"}, "x_concepts": [{"id": f"{OA}C1", "level": 0, "score": 0.5}, {"id": f"{OA}C2", "level": 1}], "ancestors": [{"id": f"{OA}C3"}, {"id": None}], "roles": [{"role": "funder", "id": f"{OA}F1", "works_count": 2}], "keywords": ["k"], "associated_insitutions": [{"id": f"{OA}I2", "relationship": "child"}], "issn": ["1"]}
    rows = spark.createDataFrame([(json.dumps(x),) for x in (record, record, {"id": ""}, {"id": f"{OA}X8", "display_name": "skipped"})], "v string")
    nested = rows.select(F.from_json("v", StructType.fromDDL(NESTED[entity])).alias("r")).select("r.*")
    tables = fl.flatten(entity, nested, ids(spark, 8))
    parent = tables[entity].collect()
    assert len(parent) == 1 and parent[0][fl.ENTITIES[entity].id] == 7
    several = {"authors_concepts": 2}
    none = {"funders_alternate_titles", "funders_summary_stats", "institutions_geo", "concepts_related_concepts", "topics_siblings"}
    for name, df in tables.items():
        assert df.count() == (0 if name in none else several.get(name, 1)), name


def test_skip_ids(spark):
    merged = fl.merged_ids(spark.createDataFrame([("W5", "W6"), ("W5", "W6")], "id string, merge_into_id string"))
    assert {r.id for r in fl.skip_ids(merged, "works", spark).collect()} == {5, 4285719527}


def test_named_tables_write_no_works(spark, nested, monkeypatch):
    """Each table by itself is as among all, and no table of whole works is written for it."""
    topics = spark.createDataFrame([], fl.TOPIC_COLUMNS)
    every = {name: sorted(map(repr, df.collect())) for name, df in fl.flatten_works(nested, skips(spark), topics).items()}
    names = []
    monkeypatch.setattr(fl, "written", lambda df, name, keep=fl.written: names.append(name) or keep(df, name))
    for name, rows in every.items():
        assert sorted(map(repr, fl.flatten_works(nested, skips(spark), topics, only=[name])[name].collect())) == rows
    assert set(names) == {"skipped"}


def test_authorships_are_made_distinct_in_small_tasks(spark, monkeypatch):
    monkeypatch.setattr(fl, "AUTHORS", 50)
    author = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.struct(F.struct(F.concat(F.lit("https://example.org/A"), (F.col("k") * 10 + i).cast("string")).alias("id")).alias("author")))
    schema = nested_schema("works")
    url = F.concat(F.lit("https://example.org/W"), F.col("k").cast("string"))
    known = {"id": url, "authorships": F.from_json(F.to_json(author), schema["authorships"].dataType)}
    works = spark.range(200).toDF("k").select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
    rows = fl.flatten_works(works.unionByName(works), only=["works_authorships"])["works_authorships"]
    held = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert rows.count() == 1000 and len(held) > 30 and max(x["count"] for x in held) < 100
