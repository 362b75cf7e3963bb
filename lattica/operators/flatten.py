"""Nested entities to flat tables.

Each table is a list of SQL expressions over the parent row (id and name already made) and, for a
child table, over the element `e` of one of its arrays; an empty or null array gives no rows. All
tables come from one parsed DataFrame. Ids that were merged or deleted are attached to the works
that name them, as arrays: these works' ids alone are joined back, by broadcast while they are few. Works that are skipped
themselves go by broadcast bits of their ids. The source is read once.
Where the parsed rows have a source_file, so has each row of each table.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import DOI, ORCID, entity_id, topic_id
from ..functions.text import abstract_text, affiliation_text, clean_title, index_of
from ..functions.values import to_bool
from ..runtime import broadcast_below, spread, written

#: Placeholder ids of deleted entities.
DELETED = {"works": 4285719527, "authors": 5317838346, "institutions": 4389424196, "sources": 4317411217}


def oid(path: str) -> str:
    return f"try_cast(substring(substring_index(trim({path}), '/', -1), 2) AS BIGINT)"


def tid(path: str) -> str:
    return f"try_cast(regexp_extract(substring_index(trim({path}), '/', -1), '^[A-Za-z]?([0-9]+)$', 1) AS BIGINT)"


def boolean(path: str) -> str:
    return f"coalesce(try_cast({path} AS BOOLEAN), false)"


def text(path: str) -> str:
    return f"coalesce(to_json({path}), 'null')"


@dataclass(frozen=True)
class Table:
    columns: str
    each: str | None = None
    where: str | None = None


@dataclass(frozen=True)
class Entity:
    id: str
    name: str
    tables: dict[str, Table] = field(default_factory=dict)
    key: str = oid("id")


def _years(name: str) -> Table:
    return Table(f"{name}_id, {name}_name, e.year, e.works_count, e.oa_works_count, e.cited_by_count", "counts_by_year")


def _ids(name: str, columns: str) -> Table:
    return Table(f"{name}_id, {name}_name, {columns}", where="ids IS NOT NULL")


_TOTALS = "works_count, cited_by_count"
ENTITIES = {
    "funders": Entity("funder_id", "funder_name", {
        "funders": Table(f"funder_id, funder_name, country_code, description, homepage_url, grants_count, {_TOTALS}"),
        "funders_alternate_titles": Table("funder_id, funder_name, e AS alternate_title", "alternate_titles"),
        "funders_ids": _ids("funder", "ids.*"),
        "funders_counts_by_year": _years("funder"),
        "funders_roles": Table(f"funder_id, funder_name, e.role AS role_type, {oid('e.id')} AS role_id, e.works_count", "roles"),
        "funders_summary_stats": Table("funder_id, funder_name, summary_stats.*", where="summary_stats IS NOT NULL"),
    }),
    "publishers": Entity("publisher_id", "publisher_name", {
        "publishers": Table(f"publisher_id, publisher_name, {text('alternate_titles')} AS alternate_titles, {text('country_codes')} AS country_codes, hierarchy_level, parent_publisher, {_TOTALS}, sources_api_url, updated_date"),
        "publishers_ids": _ids("publisher", "ids.*"),
        "publishers_counts_by_year": _years("publisher"),
    }),
    "sources": Entity("source_id", "source_name", {
        "sources": Table(f"source_id, source_name, issn_l, {text('issn')} AS issn, publisher, {_TOTALS}, {boolean('is_oa')} AS is_oa, {boolean('is_in_doaj')} AS is_in_doaj, homepage_url, works_api_url, updated_date"),
        "sources_ids": _ids("source", f"ids.own_id, ids.issn_l, {text('ids.issn')} AS issn, ids.mag, ids.wikidata, ids.fatcat"),
        "sources_counts_by_year": _years("source"),
    }),
    "venues": Entity("venue_id", "venue_name", {
        "venues": Table(f"venue_id, issn_l, {text('issn')} AS issn, venue_name, type, publisher, {_TOTALS}, {boolean('is_oa')} AS is_oa, {boolean('is_in_doaj')} AS is_in_doaj, homepage_url, updated_date"),
        "venues_ids": _ids("venue", f"ids.own_id, ids.issn_l, {text('ids.issn')} AS issn, ids.mag"),
        "venues_counts_by_year": Table("venue_id, venue_name, e.year, e.works_count, e.cited_by_count", "counts_by_year"),
    }),
    "topics": Entity("topic_id", "topic_name", {
        "topics": Table("topic_id, topic_name, description, works_count AS num_works, cited_by_count, " + ", ".join(f"{tid(g + '.id')} AS {g}_id, {g}.display_name AS {g}_name" for g in ("subfield", "field", "domain"))),
        "topics_keywords": Table("topic_id, topic_name, e AS keyword", "keywords"),
        "topics_siblings": Table(f"topic_id, topic_name, {tid('e.id')} AS sibling_topic_id, e.display_name AS sibling_topic_name", "siblings"),
    }, tid("id")),
    "concepts": Entity("concept_id", "concept_name", {
        "concepts": Table(f"concept_id, concept_name, wikidata, level, description, {_TOTALS}, updated_date"),
        "concepts_ids": _ids("concept", f"ids.own_id, ids.wikidata, ids.wikipedia, {text('ids.umls_aui')} AS umls_aui, {text('ids.umls_cui')} AS umls_cui, ids.mag"),
        "concepts_ancestors": Table(f"concept_id, {oid('e.id')} AS ancestor_id", "ancestors", "e.id IS NOT NULL"),
        "concepts_counts_by_year": _years("concept"),
        "concepts_related_concepts": Table(f"concept_id, {oid('e.id')} AS related_concept_id, e.score", "related_concepts", "e.id IS NOT NULL"),
    }),
    "institutions": Entity("institution_id", "institution_name", {
        "institutions": Table(f"institution_id, institution_name, ror, country_code, type, homepage_url, {text('coalesce(display_name_acronyms, display_name_acroynyms)')} AS display_name_acroynyms, {text('display_name_alternatives')} AS display_name_alternatives, {_TOTALS}, updated_date"),
        "institutions_ids": _ids("institution", "ids.*"),
        "institutions_geo": Table("institution_id, institution_name, geo.*", where="geo IS NOT NULL"),
        "institutions_associated_institutions": Table(f"institution_id, {oid('e.id')} AS associated_institution_id, e.relationship", "coalesce(associated_institutions, associated_insitutions)", "e.id IS NOT NULL"),
        "institutions_counts_by_year": _years("institution"),
    }),
    "authors": Entity("author_id", "author_name", {
        "authors": Table(f"author_id, replace(orcid, '{ORCID}', '') AS orcid, author_name, {text('display_name_alternatives')} AS display_name_alternatives, {_TOTALS}, {oid('last_known_institution.id')} AS last_known_institution, updated_date"),
        "authors_ids": _ids("author", "ids.*"),
        "authors_counts_by_year": Table("author_id, author_name, e.year, e.works_count, e.cited_by_count", "counts_by_year"),
        "authors_concepts": Table(f"author_id, author_name, {_TOTALS}, {oid('e.id')} AS concept_id, e.display_name AS concept_name, e.level, e.score", "x_concepts"),
        "authors_concepts_zero": Table(f"author_id, author_name, {_TOTALS}, {oid('e.id')} AS concept_id, e.display_name AS concept_name, e.level, e.score", "x_concepts", "e.level = 0"),
        "authors_hints": Table("author_id, author_name, coalesce(works_count, 0) AS works_count, coalesce(cited_by_count, 0) AS cited_by_count, coalesce(most_cited_work, '') AS most_cited_work"),
    }),
}


def skip_ids(merged: DataFrame | None, kind: str, spark) -> DataFrame:
    """(id): merged ids, as integers, and the placeholder of the kind."""
    gone = spark.createDataFrame([(DELETED[kind],)] if kind in DELETED else [], "id bigint")
    return gone if merged is None else merged.select("id").unionByName(gone).distinct()


def id_bits(ids: DataFrame, max_bytes: int = 128 << 20) -> tuple[DataFrame, int]:
    """(_at, _bits), distinct ids (id) as words of 64 bits, and a shift: _bits are the words of the ids that shifted by so much are _at.
    They are broadcast, 64 words to a row, in up to max_bytes: so many ids that lie close together need no shuffle of what meets them,
    however many rows that is. Beyond, a row has one word."""
    bit = F.expr("bit_or(shiftleft(1L, CAST(id & 63 AS INT)))")
    words = written(ids.select(F.col("id").cast("bigint")).where("id IS NOT NULL").groupBy(F.shiftright("id", 6).alias("word")).agg(bit.alias("bits")), "skipped")
    if 64 * 8 * words.select(F.shiftright("word", 6)).distinct().count() > max_bytes:
        return words.select(F.col("word").alias("_at"), F.array("bits").alias("_bits")), 6
    held = words.groupBy(F.shiftright("word", 6).alias("_at")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("word").bitwiseAND(63), "bits"))).alias("x"))
    return F.broadcast(held.select("_at", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.element_at("x", i.cast("bigint")), F.lit(0).cast("bigint"))).alias("_bits"))), 12


def without(rows: DataFrame, key: str, held: tuple[DataFrame, int], how: str = "left_anti") -> DataFrame:
    """rows but those whose key is one of the ids of id_bits(); by left_semi just those."""
    bits, shift = held
    word = F.get("_bits", F.shiftright(key, 6).bitwiseAND((1 << shift - 6) - 1).cast("int"))
    return rows.join(bits, (F.shiftright(key, shift) == F.col("_at")) & (F.getbit(word, F.col(key).bitwiseAND(63).cast("int")) == 1), how)


def merged_ids(rows: DataFrame) -> DataFrame:
    """(id, merge_into_id) as distinct integers, from the CSV files of a kind."""
    return rows.select(entity_id(F.col("id")).alias("id"), entity_id(F.col("merge_into_id")).alias("merge_into_id")).distinct()


def first_rows(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per key, the first in the given order."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def parents(entity: str, nested: DataFrame, skip: DataFrame | None = None, distinct: bool = True, string_ids: bool = False) -> DataFrame:
    """nested with integer id and name, without rows that have no id, none that is a number, or a skipped one. distinct keeps one row per id: the latest."""
    spec = ENTITIES[entity]
    rows = nested.where("id IS NOT NULL AND trim(id) <> ''").withColumn(spec.id, F.trim("id") if string_ids else F.expr(spec.key)).where(F.col(spec.id).isNotNull()).withColumn(spec.name, F.col("display_name"))
    if skip is not None:
        rows = rows.join(skip.select(F.col("id").alias("_skip")), F.col(spec.id) == F.col("_skip"), "left_anti")
    return first_rows(rows, spec.id, F.desc_nulls_last("updated_date"), F.xxhash64("display_name", "id")) if distinct else rows


def flatten(entity: str, nested: DataFrame, skip: DataFrame | None = None, distinct: bool = True, string_ids: bool = False) -> dict[str, DataFrame]:
    """Table name to rows, for every entity but works. string_ids leaves all ids as the URLs that the records have, as older
    tables do; skip then holds such URLs."""
    base = parents(entity, nested, skip, distinct, string_ids)
    out = {}
    for name, table in ENTITIES[entity].tables.items():
        columns = _as_urls(table.columns) if string_ids else table.columns
        rows = base.withColumn("e", F.explode(F.expr(table.each))) if table.each else base
        out[name] = (rows.where(table.where) if table.where else rows).selectExpr(*_split(columns), *_origin(base))
    return out


def _as_urls(columns: str) -> str:
    """The column list with the paths of ids in place of their conversions."""
    for conversion in (oid("@"), tid("@")):
        columns = re.sub(re.escape(conversion).replace("@", r"([\w.]+)"), r"trim(\1)", columns)
    return columns


def _origin(rows: DataFrame) -> list[str]:
    return ["source_file"] if "source_file" in rows.columns else []


def _split(columns: str) -> list[str]:
    """At commas outside brackets and quotes."""
    parts, depth, quoted, last = [], 0, False, 0
    for i, c in enumerate(columns):
        quoted ^= c == "'"
        if not quoted:
            depth += (c == "(") - (c == ")")
            if c == "," and not depth:
                parts.append(columns[last:i])
                last = i + 1
    return [p.strip() for p in [*parts, columns[last:]]]


#: Skipped ids of a kind that are constants of the plan; works that name skipped ids, broadcast to the works of a batch.
FEW, BROADCAST = 100, 1_500_000


def _with_skipped(rows: DataFrame, key: str, ids: dict[str, Column], skip: dict[str, DataFrame]) -> DataFrame:
    """rows with those of their ids of each kind that are skipped, as arrays _no_<kind>; null or empty where there is none."""
    kinds = [k for k in ids if k in skip]
    if not kinds:
        return rows.withColumns({f"_no_{k}": F.lit(None).cast("array<bigint>") for k in ids})

    def marked(i: int) -> Column:
        return F.transform(F.coalesce(ids[kinds[i]], F.array().cast("array<bigint>")), lambda x: F.struct(F.lit(i).alias("kind"), x.alias("id")))

    gone = [skip[k].select(F.lit(i).alias("kind"), "id") for i, k in enumerate(kinds)]
    named = rows.select(F.col(key).alias("_key"), F.explode(F.concat(*map(marked, range(len(kinds))))).alias("x")).select("_key", "x.*")
    met = named.join(reduce(DataFrame.unionByName, gone), ["kind", "id"], "left_semi").groupBy("_key")
    met = written(met.agg(*[F.collect_set(F.when(F.col("kind") == i, F.col("id"))).alias(f"_no_{k}") for i, k in enumerate(kinds)]), "skipped")
    out = rows.join(broadcast_below(met, 200_000), F.col(key) == F.col("_key"), "left").drop("_key")
    return out.withColumns({f"_no_{k}": F.lit(None).cast("array<bigint>") for k in ids if k not in kinds})


@dataclass(frozen=True)
class Skipped:
    """What is skipped, in a form that many tables of the same written works share: all ids of kinds with few, id_bits() of the others and of works."""

    few: dict[str, list[int]]
    bits: dict[str, tuple[DataFrame, int]]

    def named(self, name: str) -> bool:
        """Whether the rows of a table depend on what their whole work names, so that it must be attached."""
        return name not in NAMES and bool(self.bits.keys() & set(DEPENDS.get(name, ())))


def skipped(skip: dict[str, DataFrame] | None, hold: Callable[[DataFrame, str], DataFrame] = written) -> Skipped:
    """hold: what writes the bits that are broadcast, so that no table makes them again."""
    found = {k: [r["id"] for r in ids.select("id").distinct().limit(FEW + 1).collect()] for k, ids in (skip or {}).items() if k != "works"}
    few = {k: sorted(x for x in ids if x is not None) for k, ids in found.items() if len(ids) <= FEW}
    held = {k: id_bits(ids) for k, ids in (skip or {}).items() if k not in few}
    return Skipped(few, {k: (F.broadcast(hold(bits, "bits")), shift) if shift > 6 else (bits, shift) for k, (bits, shift) in held.items()})


def _with_ids(nested: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """Works with an integer id, and with _refs and _related as integers; and the ids of each kind that they name."""
    rows = nested.where("id IS NOT NULL AND trim(id) <> ''").withColumn("work_id", entity_id(F.col("id"))).where("work_id IS NOT NULL")
    ints = lambda c: F.filter(F.transform(c, entity_id), lambda x: x.isNotNull())
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("_refs", F.coalesce(ints("referenced_works"), none)).withColumn("_related", F.coalesce(ints("related_works"), none))
    lineages = F.flatten(F.transform("authorships", lambda a: F.flatten(F.transform(a["institutions"], lambda i: F.concat(F.array(i["id"]), F.coalesce(i["lineage"], F.array().cast("array<string>")))))))
    places = F.concat(F.coalesce("locations", F.array().cast(nested.schema["locations"].dataType)), F.array("primary_location", "best_oa_location"))
    return rows, {
        "works": F.concat("_refs", "_related"), "authors": ints(F.transform("authorships", lambda a: a["author"]["id"])), "institutions": ints(lineages),
        "sources": ints(F.transform(places, lambda p: p["source"]["id"])),
    }


def named_skipped(nested: DataFrame, of: Skipped) -> DataFrame | None:
    """(_key, _no_<kind>): works that name ids of kinds with bits, with these ids. Only the ids that are met are exchanged."""
    rows, ids = _with_ids(nested)
    kinds = [k for k in ids if k in of.bits]
    met = [without(rows.select(F.col("work_id").alias("_key"), F.explode(ids[k]).alias("id")), "id", of.bits[k], "left_semi").select("_key", F.lit(k).alias("kind"), "id") for k in kinds]
    return reduce(DataFrame.unionByName, met).groupBy("_key").agg(*[F.collect_set(F.when(F.col("kind") == k, F.col("id"))).alias(f"_no_{k}") for k in kinds]) if met else None


def _kept(x: Column, skipped: str) -> Column:
    return ~F.coalesce(F.array_contains(F.col(skipped), x), F.lit(False))


def work_parents(nested: DataFrame, skip: dict[str, DataFrame] | None = None, latest_only: bool = False, only: list[str] | None = None, gone: tuple[DataFrame, int] | None = None, of: Skipped | None = None, named: DataFrame | None = None) -> DataFrame:
    """works with integer ids in place of URLs, skipped ids removed from the arrays, and the derived counts and flags.
    only: the tables that are wanted. The rows then are not written: their skipped ids, of the kinds that these tables depend on, come from
    a second look at the source, and each look and each join takes only the columns that it needs.
    gone: the id_bits() of skipped works, where they are made already. of: what is skipped, in place of skip, for works that are a written table:
    nothing is written, and ids that are not few go from arrays only where named, the named_skipped() of these works, is given."""
    skip = skip or {}
    rows, named_ids = _with_ids(nested)
    gone = of.bits.get("works") if of else gone or (id_bits(skip["works"]) if "works" in skip else None)
    if gone:
        rows = without(rows, "work_id", gone)
    if latest_only:
        rows = first_rows(rows, "work_id", F.desc_nulls_last("created_date"), F.xxhash64("title", "id"))
    if only is not None:
        needed = {k for name in only for k in DEPENDS.get(name, ())}
        skip = {k: df for k, df in skip.items() if k in needed}
    elif any(k in skip for k in named_ids):
        rows = written(rows, "works")  # the source is read once: the skipped ids come from narrow columns of this table
    if of:
        if named is not None:
            rows = rows.join(named, F.col("work_id") == F.col("_key"), "left").drop("_key")
        all_of = lambda k: F.array(*map(F.lit, of.few[k])) if k in of.few else F.lit(None)
        rows = rows.withColumns({f"_no_{k}": all_of(k).cast("array<bigint>") for k in named_ids if f"_no_{k}" not in rows.columns})
    else:
        rows = _with_skipped(rows, "work_id", named_ids, skip)

    authors = F.filter("authorships", lambda a: entity_id(a["author"]["id"]).isNotNull() & _kept(entity_id(a["author"]["id"]), "_no_authors"))
    named = lambda a: F.filter(a["institutions"], lambda i: entity_id(i["id"]).isNotNull() & _kept(entity_id(i["id"]), "_no_institutions"))
    located = F.filter("locations", lambda p: entity_id(p["source"]["id"]).isNotNull() & _kept(entity_id(p["source"]["id"]), "_no_sources"))
    refs_kept = lambda c: F.filter(c, lambda x: _kept(x, "_no_works"))
    rows = rows.withColumns({"authors_kept": F.coalesce(authors, F.array().cast(nested.schema["authorships"].dataType)), "locations_kept": located, "refs_kept": refs_kept("_refs"), "related_kept": refs_kept("_related")})
    return rows.withColumns({
        "doi": F.replace("doi", F.lit(DOI), F.lit("")),
        "title": clean_title(F.col("title")),
        "is_retracted": to_bool(F.col("is_retracted")),
        "is_paratext": to_bool(F.col("is_paratext")),
        "num_authors": F.size("authors_kept"),
        "num_locations": F.when(F.col("locations_kept").isNull(), 0).otherwise(F.size("locations_kept")),
        "num_references": F.size("refs_kept"),
        "has_complete_institution_info": (F.size("authors_kept") > 0) & F.forall("authors_kept", lambda a: F.coalesce(F.size(named(a)), F.lit(0)) > 0),
        "has_grant_info": F.coalesce(F.size("grants"), F.lit(0)) > 0,
        "has_keywords": F.coalesce(F.size("keywords"), F.lit(0)) > 0,
    }).drop("authorships", "locations", "referenced_works", "related_works", "_refs", "_related")


def authorships(works: DataFrame, institutions: DataFrame | None = None, compat: bool = False) -> DataFrame:
    """Author x institution x member of its lineage, from work_parents().

    One row with a null institution, level 0, for an author without (kept) institutions. Members
    that are skipped go, and later ones keep their level. institutions (institution_id,
    institution_name, country_code) gives names and countries of members by a left join, null on
    a miss. compat zips ids and lineages after each lost its nulls, cut to the shortest of the
    institutions' ids, names, countries and lineages, and calls a null institution assigned.
    """
    one = F.posexplode("authors_kept").alias("author_no", "a")
    rows = works.select("work_id", "publication_year", "_no_institutions", *_origin(works), one)
    kept = F.filter(F.col("a.institutions"), lambda i: entity_id(i["id"]).isNotNull() & _kept(entity_id(i["id"]), "_no_institutions"))
    lineage = lambda i: F.coalesce(F.transform(i["lineage"], entity_id), F.array(F.lit(None).cast("bigint")))
    pairs = F.transform(kept, lambda i: F.struct(entity_id(i["id"]).alias("own"), lineage(i).alias("lineage")))
    if compat:
        present = lambda f: F.filter(F.transform(kept, lambda i: i[f]), lambda x: x.isNotNull())
        n = F.least(F.size(pairs), F.size(present("display_name")), F.size(present("country_code")), F.size(present("lineage")))
        lineages = F.transform(present("lineage"), lambda x: F.transform(x, entity_id))
        cut = F.slice(F.zip_with(pairs, lineages, lambda p, x: F.struct(p["own"].alias("own"), x.alias("lineage"))), F.lit(1), F.greatest(n, F.lit(0)))
        pairs = F.when(F.size(kept) > 0, cut)
    empty = F.array(F.struct(F.lit(None).cast("bigint").alias("own"), F.array(F.lit(None).cast("bigint")).alias("lineage")))
    rows = rows.withColumn("p", F.explode(F.when(F.coalesce(F.size(kept), F.lit(0)) > 0, pairs).otherwise(empty)))
    rows = rows.select("*", F.posexplode("p.lineage").alias("institution_lineage_level", "institution_id"))
    rows = rows.where(F.col("institution_id").isNull() | _kept(F.col("institution_id"), "_no_institutions"))
    same = F.col("p.own").eqNullSafe(F.col("institution_id")) if compat else F.coalesce(F.col("p.own") == F.col("institution_id"), F.lit(False))
    out = rows.select(
        "work_id", F.col("a.author_position").alias("author_position"), entity_id(F.col("a.author.id")).alias("author_id"), F.col("a.author.display_name").alias("author_name"),
        F.col("a.raw_author_name").alias("raw_author_name"), "institution_lineage_level", same.alias("assigned_institution"), "institution_id",
        affiliation_text(F.col("a.raw_affiliation_strings"), F.col("a.raw_affiliation_string")).alias("raw_affiliation_string"), "publication_year", F.col("a.is_corresponding").alias("is_corresponding"), *_origin(works),
    )
    if institutions is None:
        return out.withColumns({"institution_name": F.lit(None).cast("string"), "country_code": F.lit(None).cast("string")})
    return out.join(institutions.select("institution_id", "institution_name", "country_code"), "institution_id", "left")


_PLACE = "publication_year, " + oid("{p}.source.id") + " AS source_id, {p}.source.display_name AS source_name, {p}.source.type AS source_type, {p}.version, {p}.license, {p}.landing_page_url, {p}.pdf_url, coalesce(try_cast({p}.is_oa AS BOOLEAN), false) AS is_oa, coalesce(try_cast({p}.is_accepted AS BOOLEAN), false) AS is_accepted, coalesce(try_cast({p}.is_published AS BOOLEAN), false) AS is_published"
_PLACED = oid("{p}.source.id") + " IS NOT NULL AND NOT coalesce(array_contains(_no_sources, " + oid("{p}.source.id") + "), false)"
WORKS = {
    "works": Table("work_id, doi, title, publication_year, publication_date, type, type_crossref, cited_by_count, num_authors, num_locations, num_references, language, has_complete_institution_info, has_grant_info, has_keywords, is_retracted, is_paratext, created_date"),
    "works_indexed_in": Table("work_id, publication_year, e AS indexed_source", "indexed_in"),
    "works_keywords": Table("work_id, publication_year, e.display_name AS keyword, e.score", "keywords"),
    "works_grants": Table(f"work_id, publication_year, {oid('e.funder')} AS funder_id, nullif(e.funder_display_name, '') AS funder_name, e.award_id", "grants"),
    "works_primary_location": Table("work_id, " + _PLACE.format(p="primary_location"), where=_PLACED.format(p="primary_location")),
    "works_locations": Table("work_id, " + _PLACE.format(p="e"), "locations_kept"),
    "works_best_oa_location": Table(f"work_id, best_oa_location.pdf_url, {boolean('best_oa_location.is_oa')} AS is_oa, {boolean('best_oa_location.is_accepted')} AS is_accepted, {boolean('best_oa_location.is_published')} AS is_published, {oid('best_oa_location.source.id')} AS source_id, best_oa_location.source.display_name AS source_name, best_oa_location.source.type AS source_type", where=_PLACED.format(p="best_oa_location")),
    "works_open_access": Table(f"work_id, {boolean('open_access.is_oa')} AS is_oa, open_access.oa_status, open_access.oa_url, {boolean('open_access.any_repository_has_fulltext')} AS any_repository_has_fulltext", where="open_access IS NOT NULL"),
    "works_biblio": Table("work_id, biblio.*", where="biblio IS NOT NULL"),
    "works_concepts": Table(f"work_id, publication_year, {oid('e.id')} AS concept_id, e.display_name AS concept_name, e.level, e.score", "concepts", "e.id IS NOT NULL"),
    "works_ids": Table("work_id, ids.own_id, doi, ids.mag, ids.pmid, ids.pmcid", where="ids IS NOT NULL"),
    "works_mesh": Table("work_id, e.*", "mesh"),
    "works_referenced_works": Table("work_id, e AS referenced_work_id", "refs_kept"),
    "works_related_works": Table("work_id, e AS related_work_id", "related_kept"),
    "works_host_venues": Table(f"work_id, {oid('host_venue.id')} AS venue_id, host_venue.url, {boolean('host_venue.is_oa')} AS is_oa, host_venue.version, host_venue.license", where="host_venue.id IS NOT NULL"),
    "works_alternate_host_venues": Table(f"work_id, {oid('e.id')} AS venue_id, e.url, {boolean('e.is_oa')} AS is_oa, e.version, e.license", "alternate_host_venues", "e.id IS NOT NULL"),
}

#: Kinds of ids whose skipped ones change a table's rows, but for the works themselves.
DEPENDS = {
    "works": ("works", "authors", "institutions", "sources"), "works_authorships": ("authors", "institutions"), "works_locations": ("sources",), "works_primary_location": ("sources",),
    "works_best_oa_location": ("sources",), "works_referenced_works": ("works",), "works_related_works": ("works",),
}
#: Tables whose every row names one id of a kind, and its column: where nothing else needs the kind, rows of skipped ids go by themselves.
NAMES = {
    "works_locations": ("sources", "source_id"), "works_primary_location": ("sources", "source_id"), "works_best_oa_location": ("sources", "source_id"),
    "works_referenced_works": ("works", "referenced_work_id"), "works_related_works": ("works", "related_work_id"),
}


#: Authors whose authorships a task makes distinct.
AUTHORS = 100_000
TOPIC_COLUMNS = "topic_id bigint, topic_name string, subfield_id bigint, subfield_name string, field_id bigint, field_name string, domain_id bigint, domain_name string"


def work_topics(works: DataFrame, topics: DataFrame) -> DataFrame:
    """Topics of works with their hierarchy; the first one is primary. Unknown topics have null names."""
    rows = works.select("work_id", "publication_year", *_origin(works), F.posexplode("topics").alias("pos", "t")).select("work_id", "publication_year", *_origin(works), (F.col("pos") == 0).alias("is_primary_topic"), F.col("t.score").alias("score"), topic_id(F.col("t.id")).alias("topic_id"))
    return rows.join(topics.select("topic_id", "topic_name", *[f"{g}_{x}" for g in ("subfield", "field", "domain") for x in ("id", "name")]), "topic_id", "left")


def work_abstracts(works: DataFrame) -> DataFrame:
    return works.where("abstract_inverted_index IS NOT NULL").select("work_id", "title", "publication_year", abstract_text(index_of(F.col("abstract_inverted_index"))).alias("abstract"), *_origin(works))


def work_tables(base: DataFrame, topics: DataFrame | None = None, institutions: DataFrame | None = None, compat: bool = False, only: list[str] | None = None) -> dict[str, DataFrame]:
    """Table name to rows, of work_parents(). Write base, or what it reads, before writing many of them. only: the tables that are wanted, in case authorships
    are not: their authors are counted first, to make them distinct in tasks of a set number of rows."""
    out = {}
    for name, table in WORKS.items():
        rows = base.withColumn("e", F.explode(table.each)) if table.each else base
        out[name] = (rows.where(table.where) if table.where else rows).selectExpr(*_split(table.columns), *_origin(base))
    if only is None or "works_authorships" in only:
        authors = base.agg(F.coalesce(F.sum(F.size("authors_kept")), F.lit(0))).first()[0]
        out["works_authorships"] = spread(authorships(base, institutions, compat), authors, "work_id", "author_id", "institution_id", each=AUTHORS).distinct()
    out["works_abstracts"] = work_abstracts(base)
    if topics is not None:
        out["works_topics"] = work_topics(base, topics).distinct()
    return out


def written_work_tables(parents: DataFrame, attached: DataFrame, of: Skipped, topics: DataFrame | None = None, institutions: DataFrame | None = None) -> dict[str, DataFrame]:
    """Table name to rows, of works that are a written table, each reading its own columns of it: work_parents(of=of) and, for tables that depend on
    what is skipped of a whole work, attached, the same with these ids. A table whose every row names one id loses skipped ones by its rows."""
    whole = [name for name in (*WORKS, "works_authorships") if of.named(name)]
    out = work_tables(parents, topics, institutions, only=[name for name in ["works_authorships"] if name not in whole])
    out |= {name: df for name, df in work_tables(attached, None, institutions, only=whole).items() if name in whole}
    return {name: without(df, NAMES[name][1], of.bits[NAMES[name][0]]) if name in NAMES and NAMES[name][0] in of.bits else df for name, df in out.items()}


def flatten_works(nested: DataFrame, skip: dict[str, DataFrame] | None = None, topics: DataFrame | None = None, institutions: DataFrame | None = None, latest_only: bool = False, compat: bool = False, only: list[str] | None = None) -> dict[str, DataFrame]:
    """Table name to rows. To write many of them, write work_parents() and take work_tables() of it; for a few, name them in only: no whole works are written or joined."""
    if only is None:
        return work_tables(work_parents(nested, skip, latest_only), topics, institutions, compat)
    skip, whole = skip or {}, [name for name in only if name not in NAMES]
    attached = {k for name in whole for k in DEPENDS.get(name, ())}
    apart = {name: NAMES[name] for name in only if name in NAMES and NAMES[name][0] in skip and NAMES[name][0] not in attached}
    held = {k: id_bits(skip[k]) for k in {"works", *(k for k, _ in apart.values())} if k in skip}
    tables = work_tables(work_parents(nested, skip, latest_only, whole, gone=held.get("works")), topics, institutions, compat, only)
    return {name: without(tables[name], apart[name][1], held[apart[name][0]]) if name in apart else tables[name] for name in only}
