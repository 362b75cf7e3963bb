"""Queries over the ingest: driver tables written as JSON-lines files, ingested in several drops, and read back from its tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import repaired_keys
from ..runtime import shared_dir, table, written
from ..streaming import ingest as ing
from .entities import BASE, SITE, SQL, WORK_BASE, WORK_SQL, records, work_records

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
#: Lines of a gzipped file of a snapshot: a file is read by one task, and a batch takes 256 MB of files, so few large ones would leave tasks idle.
FILE_LINES = 25_000


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def _folder(s: SparkSession, name: str) -> str:
    return f"{shared_dir(s)}/{name}-{uuid.uuid4().hex}"


def _drop(rows: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines, gzipped, FILE_LINES to a file at most; one folder for each value of a column."""
    line = F.to_json(F.struct(*[c for c in rows.columns if c != by])).alias("value")
    out = rows.select(line, *([by] if by else []))
    (out.repartition(by).write.partitionBy(by) if by else out.write).option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES).mode("append").text(path)


def _run(stream) -> None:
    stream.awaitTermination()


def _url(letter: str, x) -> F.Column:
    return F.concat(F.lit(SITE + letter), x.cast("string"))


def whole_works(s: SparkSession, d: str, wanted: str = "true") -> DataFrame:
    """work_records() with authors, a supplier for each line, and references, its parts; o_orderkey stays as k. wanted: a condition on k.
    Orders and lines meet as they are; records are made of them after the shuffle."""
    people = table(s, d, "supplier").join(table(s, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", "n_nationkey", "n_regionkey")
    lines = table(s, d, "lineitem").withColumn("k", F.col("l_orderkey")).where(wanted).join(people, F.col("l_suppkey") == F.col("s_suppkey"))
    held = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey", "s_name", "n_nationkey", "n_regionkey"))).alias("x"))
    orders = table(s, d, "orders").withColumn("k", F.col("o_orderkey")).where(wanted).join(held, F.col("k") == F.col("l_orderkey"), "left")

    def author(x):
        person = F.struct(_url("A", x["l_suppkey"]).alias("id"), x["s_name"].alias("display_name"))
        place = F.struct(_url("I", x["n_nationkey"]).alias("id"), F.lit("as in the record").alias("display_name"), F.lit("--").alias("country_code"), F.array(_url("I", x["n_nationkey"]), _url("I", x["n_regionkey"] + 1000)).alias("lineage"))
        return F.struct(person.alias("author"), F.concat(F.lit("line "), x["l_linenumber"].cast("string")).alias("author_position"), F.lit(False).alias("is_corresponding"), F.array(place).alias("institutions"))

    works = work_records(orders, "k", "x").drop("authorships", "referenced_works")
    return works.withColumns({"authorships": F.transform("x", author), "referenced_works": F.transform("x", lambda x: _url("W", x["l_partkey"]))}).drop("x")


NO = "CAST(NULL AS VARCHAR)"
INGESTED = {
    **WORK_SQL,
    "works": f"""SELECT k AS work_id, '10.1/' || k AS doi, 'Order ' || p AS title, y AS publication_year, {NO} AS publication_date, {NO} AS type, {NO} AS type_crossref, {NO} AS cited_by_count, (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = k) AS num_authors,
        (t <> 'P' AND c % 50 % 10 <> 4)::INT + (k % 50 % 10 <> 4)::INT AS num_locations, (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = k AND l.l_partkey % 10 <> 3) AS num_references, {NO} AS language,
        k IN (SELECT l_orderkey FROM lineitem) AS has_complete_institution_info, t <> 'P' AS has_grant_info, p[1] IN ('1', '2') AS has_keywords, false AS is_retracted, false AS is_paratext, {NO} AS created_date FROM o""",
    "works_authorships": f"""SELECT DISTINCT k AS work_id, 'line ' || l_linenumber AS author_position, l_suppkey AS author_id, s_name AS author_name, {NO} AS raw_author_name, level AS institution_lineage_level, level = 0 AS assigned_institution,
        CASE level WHEN 0 THEN n_nationkey ELSE n_regionkey + 1000 END AS institution_id, {NO} AS raw_affiliation_string, y AS publication_year, false AS is_corresponding, CASE level WHEN 0 THEN n_name ELSE r_name END AS institution_name,
        CASE level WHEN 0 THEN left(n_name, 2) END AS country_code FROM o JOIN lineitem ON l_orderkey = k JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey CROSS JOIN (VALUES (0), (1)) AS v(level)""",
    "works_referenced_works": "SELECT k AS work_id, l_partkey AS referenced_work_id FROM o JOIN lineitem ON l_orderkey = k WHERE l_partkey % 10 <> 3",
}


def _names(sql: str) -> list[str]:
    """Columns of a SELECT, without the key."""
    return sorted(set(re.findall(r"(?:AS |\.)(\w+)(?=,|\s+FROM)", sql)) - {"work_id"})


def _one_text(sql: str, name: str) -> str:
    shown = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in _names(sql))
    return f"SELECT '{name}' AS name, work_id, concat_ws('|', {shown}) AS row FROM ({WORK_BASE}{sql})"


@query(" UNION ALL ".join(_one_text(sql, name) for name, sql in INGESTED.items()))
def stream_ingest_works(s, d):
    """Works in two drops through the stream, topics and institutions through their own: every table, read back as text.
    Some works of the first drop come again in the second, topics and institutions of the first have names that the second mends."""
    topics, places, works = (_folder(s, x) for x in ("topics", "places", "works"))
    region = table(s, d, "region")
    named = lambda kind: F.struct(_url(kind + "/", F.col("r_regionkey")).alias("id"), F.col("r_name").alias("display_name"))
    all_topics = region.select(_url("T", F.col("r_regionkey")).alias("id"), F.col("r_name").alias("display_name"), *[named(x + "s").alias(x) for x in ("subfield", "field", "domain")])
    nations = table(s, d, "nation").select(_url("I", F.col("n_nationkey")).alias("id"), F.col("n_name").alias("display_name"), F.left("n_name", F.lit(2)).alias("country_code"))
    all_places = nations.unionByName(region.select(_url("I", F.col("r_regionkey") + 1000).alias("id"), F.col("r_name").alias("display_name")), allowMissingColumns=True)
    for kind, rows, at in (("topics", all_topics, topics), ("institutions", all_places, places)):
        for drop in (rows.withColumn("display_name", F.lit("old")), rows):
            _drop(drop, f"{at}/in")
            _run(ing.ingest(s, kind, f"{at}/in", f"{at}/out", f"{at}/state"))
    orders = table(s, d, "orders")
    gone = orders.select(F.explode(F.array(F.col("o_orderkey"), F.col("o_orderkey") + 1, F.col("o_orderkey") % 100)).alias("id")).unionByName(table(s, d, "lineitem").select(F.col("l_partkey").alias("id")))
    skip = {"works": written(gone.where("id % 10 = 3").distinct(), "gone"), "sources": s.range(50).where("id % 10 = 4")}
    again = F.col("k") % 50 == 0
    for drop in (whole_works(s, d, "k % 2 = 0").withColumn("title", F.when(again, "old").otherwise(F.col("title"))), whole_works(s, d, "k % 2 = 1 OR k % 50 = 0")):
        _drop(drop.drop("k"), f"{works}/in")
        _run(ing.ingest(s, "works", f"{works}/in", f"{works}/out", f"{works}/state", skip, dimensions=ing.ingested_dimensions(f"{topics}/out", f"{places}/out")))
    out, repeated = None, ing.repeated_keys(s, "works", f"{works}/out", "work_id")
    for name in INGESTED:
        columns = _names(INGESTED[name])
        found = ing.current_rows(s, "works", f"{works}/out", name, "work_id", repeated).drop("source_file", "batch")
        if sorted(set(found.columns) - {"work_id"}) != columns:
            raise ValueError(f"{name} has columns {found.columns}")
        one = found.select(F.lit(name).alias("name"), "work_id", F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]).alias("row"))
        out = one if out is None else out.unionByName(one)
    return out


def _authors(s: SparkSession, d: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(records of authors with their number k, what is skipped)."""
    gone = {"authors": table(s, d, "customer").where("c_custkey % 10 = 3").select(F.col("c_custkey").alias("id"))}
    return records(s, d, "authors").withColumn("k", F.substring_index("id", "A", -1).try_cast("bigint")), gone


@query(BASE + SQL["authors_concepts"])
def recompute_then_read(s, d):
    """Batch 9 was written without one table, batch 10 brings some of its authors again: after the missing table is
    computed, each author's rows are those of its last batch, by the order of writing and not of names."""
    at = _folder(s, "authors")
    rows, skip = _authors(s, d)
    again = F.col("k") % 6 == 0
    older = F.transform("x_concepts", lambda e: e.withField("display_name", F.lit("old")))
    others = [t for t in ing.table_names("authors") if t != "authors_concepts"]
    for batch, drop, only in (("9", rows.where("k % 2 = 0").withColumn("x_concepts", F.when(again, older).otherwise(F.col("x_concepts"))), others), ("10", rows.where((F.col("k") % 2 == 1) | again), None)):
        _drop(drop.drop("k"), f"{at}/{batch}")
        lines = s.read.text(f"{at}/{batch}").select("value", F.col("_metadata.file_path").alias("source_file"))
        ing.save_batch(lines, batch, "authors", f"{at}/out", skip, only)
    ing.recompute_missing(s, "authors", f"{at}/out", "again", skip)
    return ing.current_rows(s, "authors", f"{at}/out", "authors_concepts", "author_id").drop("source_file", "batch").withColumn("score", F.col("score").cast("double"))


@query(f"""SELECT 'authors' AS name, author_id, author_name, CAST(NULL AS BIGINT) AS year FROM ({BASE}{SQL["authors"]}) WHERE author_id % 5 <> 3
    UNION ALL SELECT 'authors_counts_by_year', author_id, author_name, year FROM ({BASE}{SQL["authors_counts_by_year"]}) WHERE author_id % 5 <> 3""")
def delete_and_repair(s, d):
    """Two files were ingested with half of their lines. Validation against the manifest finds them; one is read again, the rows
    of the other are removed from all tables, and batches that nothing refers to are deleted."""
    at = _folder(s, "authors")
    rows, skip = _authors(s, d)
    _drop(rows.where("k IS NOT NULL").withColumn("part", F.col("k") % 5).drop("k"), f"{at}/in", "part")
    lines = s.read.text(f"{at}/in").select("value", F.col("_metadata.file_path").alias("source_file"), "part")
    ing.save_batch(lines.where("part < 2").drop("part"), "0", "authors", f"{at}/out", skip)
    ing.save_batch(lines.where("part = 4 OR (part IN (2, 3) AND xxhash64(value) % 2 = 0)").drop("part"), "1", "authors", f"{at}/out", skip)
    number = F.get_json_object("value", "$.id")
    kept = lines.withColumn("k", F.substring_index(number, "A", -1).try_cast("bigint")).where("k % 10 <> 3")
    manifest = kept.groupBy(F.col("source_file").alias("filename")).agg(F.count_distinct("k").alias("records"))
    wrong = ing.wrong_files(s, "authors", f"{at}/out", manifest).select("filename")
    third = wrong.where(F.col("filename").contains("part=3"))
    ing.remove_files(third, "removed", "authors", f"{at}/out")
    again = [r["filename"] for r in wrong.where(~F.col("filename").contains("part=3")).collect()]  # names of files
    ing.replace_files(s, again, "mended", "authors", f"{at}/out", skip)
    ing.clean_up(s, "authors", f"{at}/out")
    parents = ing.current_rows(s, "authors", f"{at}/out", "authors", "author_id").select(F.lit("authors").alias("name"), "author_id", "author_name", F.lit(None).cast("bigint").alias("year"))
    years = ing.current_rows(s, "authors", f"{at}/out", "authors_counts_by_year", "author_id")
    return parents.unionByName(years.select(F.lit("authors_counts_by_year").alias("name"), "author_id", "author_name", F.col("year").cast("bigint").alias("year")))


@query("""SELECT DISTINCT ON (c_custkey) c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer WHERE c_custkey % 7 <> 0""")
def repaired_index(s, d):
    """An index of documents by key: wrong keys are set to the one inside the document, repeated ones lose all rows but one, those without any go."""
    customer = table(s, d, "customer")
    document = F.struct(F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey")).alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    key = F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") + 1).when(F.col("c_custkey") % 3 == 1, F.col("c_custkey"))
    index = customer.select(F.when(F.col("c_custkey") % 7 != 0, key).alias("key"), document.alias("document"))
    twice = index.unionByName(index.where("key % 4 = 0"))
    return repaired_keys(twice, "key", "document.id").select("key", "document.name", "document.segment")
