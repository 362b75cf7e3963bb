"""Queries over readers and writers: driver tables written in the forms that snapshots have and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text, values
from ..operators import flatten as fl
from ..operators import relational as r
from ..runtime import table
from ..sources import scans, sinks
from .entities import BASE, SITE, records
from .ingests import _folder

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def _customer_line():
    """A customer as a record of an author."""
    return F.to_json(F.struct(F.concat(F.lit(SITE + "A"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("display_name")))


@query("""
    SELECT 'good' AS kind, c_custkey AS k, CAST(NULL AS VARCHAR) AS line FROM customer WHERE c_custkey % 5 > 1
    UNION ALL SELECT 'bad', NULL, 'no record: ' || c_name FROM customer WHERE c_custkey % 5 = 0""")
def tolerant_lines(s, d):
    """A fifth of the lines are no JSON, another fifth blank."""
    path = _folder(s, "lines")
    line = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("no record: "), "c_name")).when(F.col("c_custkey") % 5 == 1, F.lit("  ")).otherwise(_customer_line())
    table(s, d, "customer").select(line).write.option("compression", "gzip").text(path)
    good, bad = scans.read_entity_tolerant(s, "authors", path)
    key = F.substring_index("id", "A", -1).cast("bigint")
    return good.select(F.lit("good").alias("kind"), key.alias("k"), F.lit(None).cast("string").alias("line")).unionByName(bad.select(F.lit("bad").alias("kind"), F.lit(None).cast("bigint").alias("k"), "line"))


@query("SELECT c_custkey AS author_id FROM customer WHERE c_custkey % 4 < 2")
def capped_files(s, d):
    """The first two of four files."""
    path = _folder(s, "files")
    table(s, d, "customer").select(_customer_line().alias("value"), (F.col("c_custkey") % 4).alias("part")).repartition("part").write.partitionBy("part").text(path)
    rows = scans.read_entity(s, "authors", [f"{path}/part={k}" for k in range(4)], max_files=2)
    return rows.select(F.substring_index("id", "A", -1).cast("bigint").alias("author_id"))


@query("SELECT c_nationkey % 2 = 0 AS even, 'part=' || (c_custkey % 4) AS folder, count(*) AS n FROM customer GROUP BY ALL")
def provenance(s, d):
    """Rows by the file that they come from."""
    path = _folder(s, "origin")
    one = table(s, d, "customer").select(F.concat(_customer_line(), F.when(F.col("c_nationkey") % 2 == 0, " ").otherwise("")).alias("value"), (F.col("c_custkey") % 4).alias("part"))
    one.repartition("part").write.partitionBy("part").text(path)
    lines = s.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    good, _ = scans.parsed_lines(lines, "authors")
    names = table(s, d, "customer").select(F.col("c_name").alias("display_name"), (F.col("c_nationkey") % 2 == 0).alias("even"))
    return good.join(names, "display_name").groupBy("even", F.element_at(F.split("source_file", "/"), -2).alias("folder")).agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, n_name, left(n_name, 2) AS code FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 3) ON s_nationkey = n_nationkey")
def small_dimension(s, d):
    """A dimension in a CSV file, read by its name, one row for each key, looked up."""
    folder = _folder(s, "small")
    nation = table(s, d, "nation").where("n_nationkey <> 3")
    rows = nation.select("n_nationkey", "n_name", F.left("n_name", F.lit(2)).alias("code"))
    sinks.write_csv(rows.unionByName(rows), f"{folder}/institutions.csv.gz", ["n_nationkey", "n_name", "code"])
    dim = scans.dimension(scans.read_small(s, folder, "institutions"), "n_nationkey", ["n_name", "code"])
    keyed = table(s, d, "supplier").withColumn("nation", F.col("s_nationkey").cast("string"))
    return r.looked_up(keyed, "nation", dim, "n_nationkey", "n_name", "code").select("s_suppkey", "n_name", "code")


@query("SELECT 5 AS files, count(*) AS rows, 3 AS columns, 'struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>' AS schema, 4 AS shown FROM orders")
def peeked(s, d):
    path = _folder(s, "peek")
    table(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").repartition(5, "o_orderkey").write.parquet(path)
    facts, rows = scans.peek(scans.read_table(s, path), 4)
    return facts.select("files", "rows", "columns", "schema", F.lit(rows.count()).alias("shown"))


@query("SELECT cast(o_orderkey AS VARCHAR) AS order_id, o_totalprice AS price, o_orderstatus = 'F' AS is_filled, o_custkey AS customer, o_orderpriority AS priority FROM orders")
def typed_by_name(s, d):
    """A CSV file read with types by the names of its columns."""
    path = _folder(s, "csv")
    rows = table(s, d, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"), (F.col("o_orderstatus") == "F").alias("is_filled"), F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("priority"))
    rows.coalesce(1).write.option("header", True).csv(path)
    return s.read.schema(scans.named_types(s, path)).csv(path, header=True)


@query("SELECT p_partkey, p_name FROM part")
def strict_csv(s, d):
    """A writer that takes exactly the table's columns; the wider table is an error."""
    path = _folder(s, "strict")
    part = table(s, d, "part")
    try:
        sinks.write_csv(part, path, ["p_partkey", "p_name"], strict=True)
    except ValueError:
        sinks.write_csv(part.select("p_partkey", "p_name"), path, ["p_partkey", "p_name"], strict=True)
    return scans.read_csvs(s, path, {"p_partkey": "cast(p_partkey AS bigint)", "p_name": "p_name"})


@query("SELECT DISTINCT o_orderkey AS id, o_custkey AS merge_into_id FROM orders WHERE o_orderkey % 3 = 0")
def merged_ids(s, d):
    """All files of merged ids of a kind, letters taken off, each pair once."""
    path = _folder(s, "merged")
    pairs = table(s, d, "orders").where("o_orderkey % 3 = 0").select(F.concat(F.lit("W"), F.col("o_orderkey").cast("string")).alias("id"), F.concat(F.lit("W"), F.col("o_custkey").cast("string")).alias("merge_into_id"))
    sinks.write_csv(pairs.unionByName(pairs), path, ["id", "merge_into_id"])
    return fl.merged_ids(scans.read_csvs(s, path))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END AS time, CASE WHEN o_orderkey % 3 <> 2 THEN o_orderdate::DATE END AS day FROM orders")
def dates(s, d):
    """Times, days, and what is neither."""
    given = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate").cast("string")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("no date")
    rows = table(s, d, "orders").select("o_orderkey", given.alias("given"))
    return rows.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, values.to_time(F.col("given"))).alias("time"), values.to_day(F.col("given")).alias("day"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name || ';' || c_mktsegment WHEN 1 THEN c_mktsegment END AS affiliation FROM customer""")
def raw_affiliations(s, d):
    """Lists, else single values, else nothing."""
    k = F.col("c_custkey") % 4
    many = F.when(k == 0, F.array("c_name", "c_mktsegment")).when(k == 1, F.array().cast("array<string>"))
    return table(s, d, "customer").select("c_custkey", text.affiliation_text(many, F.when(k < 2, F.col("c_mktsegment")).when(k == 2, F.lit(""))).alias("affiliation"))


@query("""SELECT n_nationkey, lower(n_name[1]) || 'zhurnal' || n_nationkey || 'grosselodzsmph' AS key, ' ' || n_nationkey || ' EeA  ' AS plain FROM nation""")
def three_scripts(s, d):
    """Keys of titles in Cyrillic, Latin and Greek letters, and their ASCII forms, in which other letters are spaces."""
    k = F.col("n_nationkey").cast("string")
    title = F.concat(F.left("n_name", F.lit(1)), F.lit(" <i>Журнал</i> "), k, F.lit(" and the Größe, Łódź: Σμφ!"))
    return table(s, d, "nation").select("n_nationkey", text.dedup_key(title).alias("key"), text.ascii_clean(F.concat(F.lit("Ж"), k, F.lit(" ÉèÀ中ф"))).alias("plain"))


def _string_ids(entity: str, name: str):
    def run(s, d):
        gone = table(s, d, "customer").where("c_custkey % 10 = 3").select(F.concat(F.lit(SITE + entity[0].upper()), F.col("c_custkey").cast("string")).alias("id"))
        return fl.flatten(entity, records(s, d, entity), gone, string_ids=True)[name]

    return run


#: Older tables, whose ids are the records' URLs.
STRINGS = {
    "authors": f"SELECT '{SITE}A' || k AS author_id, '00-' || k AS orcid, n AS author_name, l AS display_name_alternatives, w AS works_count, g AS cited_by_count, '{SITE}I' || g AS last_known_institution, '2024' AS updated_date FROM c",
    "authors_concepts": f"SELECT '{SITE}A' || k AS author_id, n AS author_name, w AS works_count, g AS cited_by_count, '{SITE}C' || g AS concept_id, s AS concept_name, g % 2 AS level, k / 4.0::DOUBLE AS score FROM c WHERE k % 3 = 2",
    "institutions_ids": f"SELECT '{SITE}I' || k AS institution_id, n AS institution_name, 'x' || k AS own_id, 'x' || k AS ror, 'x' || k AS grid, 'x' || k AS wikipedia, 'x' || k AS wikidata, 'x' || k AS mag FROM c WHERE k % 7 <> 0",
    "institutions_associated_institutions": f"SELECT '{SITE}I' || k AS institution_id, '{SITE}I' || g AS associated_institution_id, s AS relationship FROM c WHERE k % 3 = 2",
    "concepts_ancestors": f"SELECT '{SITE}C' || k AS concept_id, '{SITE}C' || g AS ancestor_id FROM c WHERE k % 3 = 2",
    "concepts_related_concepts": f"SELECT '{SITE}C' || k AS concept_id, '{SITE}C' || g AS related_concept_id, k / 4.0::DOUBLE AS score FROM c WHERE k % 3 = 2",
}
QUERIES |= {f"string_{name}": _string_ids(name.split("_")[0], name) for name in STRINGS}
ORACLE_SQL |= {f"string_{name}": BASE + sql for name, sql in STRINGS.items()}

PROFILED = ("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus")


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", CASE WHEN count(DISTINCT {c}) <= 0.1 * count(*) THEN count(DISTINCT {c}) END AS \"distinct\", count(*) AS rows, least(count(DISTINCT {c})::DOUBLE / count(*), 0.1) AS ratio, count(DISTINCT {c})::DOUBLE / count(*) < 0.05 AS categorise FROM lineitem" for c in PROFILED))
def cardinality_two_phases(s, d):
    return r.cardinality_in_two_phases(table(s, d, "lineitem"), list(PROFILED))


@query("SELECT l_orderkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus FROM lineitem")
def rewrite_by_report(s, d):
    """Profiled, written with the encodings that the profile calls for and in smaller types, read back."""
    path = _folder(s, "encoded")
    rows = table(s, d, "lineitem").select(*PROFILED)
    report = r.cardinality_in_two_phases(rows, list(PROFILED))
    small = values.smallest_types(rows, ["l_orderkey", "l_suppkey"])
    sinks.rewrite_by_report(small, path, report, ["l_orderkey"])
    back = scans.read_table(s, path)
    return back.select(*[F.col(c).cast("bigint").alias(c) if c in ("l_orderkey", "l_suppkey") else F.col(c) for c in PROFILED])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def many_lookups(s, d):
    """Orders of many customers, from a table that is in no order of them."""
    path = _folder(s, "lookup")
    sinks.lookup_table(table(s, d, "orders").select("o_orderkey", "o_custkey"), path, "o_custkey", 64)
    wanted = table(s, d, "customer").where("c_acctbal > 5000").select("c_custkey")
    return scans.lookup(scans.read_table(s, path), "o_custkey", wanted, 64)
