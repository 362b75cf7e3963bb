"""Graphs as a table of vertices and a table of edges (src, dst)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import vertex_name
from ..functions.values import pair_weight
from ..runtime import broadcast_below, written
from .components import connected_components
from .relational import counts_on_edges, induced_edges, keep_first


def vertices_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()


def typed_edges(references: DataFrame, related: DataFrame, authorship: DataFrame, concepts: DataFrame, venues: DataFrame) -> DataFrame:
    """(src, dst, kind, position, score) with vertex names: citations, related works, works and authors, authors and institutions, concepts, venues."""

    def one(df: DataFrame, src: tuple[str, str], dst: tuple[str, str], kind: str, position: str | None = None, score: str | None = None) -> DataFrame:
        rows = df.where(F.col(src[1]).isNotNull() & F.col(dst[1]).isNotNull())
        return rows.select(
            vertex_name(src[0], F.col(src[1])).alias("src"), vertex_name(dst[0], F.col(dst[1])).alias("dst"), F.lit(kind).alias("kind"),
            (F.col(position) if position else F.lit(None)).cast("string").alias("position"), (F.col(score) if score else F.lit(None)).cast("double").alias("score"),
        ).distinct()

    parts = [
        one(references, ("W", "work_id"), ("W", "referenced_work_id"), "cites"),
        one(related, ("W", "work_id"), ("W", "related_work_id"), "related"),
        one(authorship, ("W", "work_id"), ("A", "author_id"), "author", "author_position"),
        one(authorship, ("A", "author_id"), ("I", "institution_id"), "affiliation"),
        one(concepts, ("W", "work_id"), ("C", "concept_id"), "concept", score="score"),
        one(venues, ("W", "work_id"), ("V", "venue_id"), "venue"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def first_vertices(rows: DataFrame, name: str = "name", *order) -> DataFrame:
    """One row of attributes per vertex name, the first in the order."""
    return keep_first(rows, [name], *(order or (F.xxhash64(*rows.columns),)))


def out_neighbours(edges: DataFrame, vertex) -> DataFrame:
    return edges.where(F.col("src") == vertex).select("dst").distinct()


def neighbours(edges: DataFrame) -> DataFrame:
    """(id, kind, other): whom each vertex points to (refs) and who points to it (cites), one row each, so that hubs stay spread."""
    one = edges.select("src", "dst").distinct()
    return one.select(F.col("src").alias("id"), F.lit("refs").alias("kind"), F.col("dst").alias("other")).unionAll(one.select("dst", F.lit("cites"), "src"))


def references_and_citations(edges: DataFrame) -> DataFrame:
    """(id, refs, cites): the same as sorted sets, empty where there is none. A row holds all of a vertex, so take neighbours() where hubs are large."""
    out = edges.groupBy(F.col("src").alias("id")).agg(F.collect_set("dst").alias("refs"))
    back = edges.groupBy(F.col("dst").alias("id")).agg(F.collect_set("src").alias("cites"))
    none = F.array().cast(out.schema["refs"].dataType)
    return out.join(back, "id", "full").select("id", F.sort_array(F.coalesce("refs", none)).alias("refs"), F.sort_array(F.coalesce("cites", none)).alias("cites"))


def ranked(df: DataFrame, key: str, item: str, score: str, most: int | None = None, salts: int = 64) -> DataFrame:
    """(key, item, score, rank): items of each key, highest score first, smaller items first among equals.
    most keeps the first ones only: each part of a key is cut to them before the parts of a large key meet."""
    order = [F.desc("score"), F.asc("item")]
    rows = df.select(key, F.col(item).alias("item"), F.col(score).alias("score"))
    if most is not None:
        part = Window.partitionBy(key, F.pmod(F.xxhash64("item"), F.lit(salts))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= most).drop("rank")
    out = rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return out.where(F.col("rank") <= most) if most is not None else out


def best_first(df: DataFrame, key: str, item: str, score: str) -> DataFrame:
    """(key, items): (score, item) of each key, highest score first, smaller items first among equals. A row
    holds all items of a key, so take ranked() where keys are large."""
    rows = F.sort_array(F.collect_list(F.struct((-F.col(score)).alias("s"), F.col(item).alias("i"))))
    return df.groupBy(key).agg(F.transform(rows, lambda x: F.struct((-x["s"]).alias("score"), x["i"].alias("item"))).alias("items"))


def members(df: DataFrame, key: str, item: str) -> DataFrame:
    """(key, items): distinct items of each key, sorted; for large keys the distinct rows themselves serve."""
    return df.groupBy(key).agg(F.sort_array(F.collect_set(item)).alias("items"))


def work_documents(works: DataFrame, authorship: DataFrame, concepts: DataFrame, venues: DataFrame, references: DataFrame, related: DataFrame) -> DataFrame:
    """works with venue, authors (each with institutions), concepts, references and related works nested."""
    people = authorship.groupBy("work_id", "author_id").agg(F.first("author_name", True).alias("author_name"), F.first("author_position", True).alias("author_position"), F.sort_array(F.collect_set("institution_id")).alias("institutions"))
    parts = [
        people.groupBy("work_id").agg(F.sort_array(F.collect_list(F.struct("author_id", "author_name", "author_position", "institutions"))).alias("authors")),
        concepts.groupBy("work_id").agg(F.sort_array(F.collect_list(F.struct("score", "concept_id")), False).alias("concepts")),
        venues.groupBy("work_id").agg(F.min("venue_id").alias("venue_id")),
        references.groupBy("work_id").agg(F.sort_array(F.collect_set("referenced_work_id")).alias("references")),
        related.groupBy("work_id").agg(F.sort_array(F.collect_set("related_work_id")).alias("related")),
    ]
    out = works
    for p in parts:  # all on work_id: one exchange of works serves every join
        out = out.join(p, "work_id", "left")
    return out


def flat_documents(docs: DataFrame) -> dict[str, DataFrame]:
    """The reverse: flat tables of nested documents."""
    authors = docs.select("work_id", F.explode("authors").alias("a")).select("work_id", "a.author_id", "a.author_name", "a.author_position", F.explode_outer("a.institutions").alias("institution_id"))
    return {
        "works": docs.drop("authors", "concepts", "venue_id", "references", "related", "abstract"),
        "authorships": authors,
        "host_venues": docs.select("work_id", "venue_id"),
        "concepts": docs.select("work_id", F.explode("concepts").alias("c")).select("work_id", "c.concept_id", "c.score"),
        "referenced_works": docs.select("work_id", F.explode("references").alias("referenced_work_id")),
        "related_works": docs.select("work_id", F.explode("related").alias("related_work_id")),
        **({"abstracts": docs.where("abstract IS NOT NULL").select("work_id", "abstract")} if "abstract" in docs.columns else {}),
    }


def one_hop(edges: DataFrame, known: DataFrame) -> DataFrame:
    """(id): neighbours of the known vertices (one column), either way, that are not known yet."""
    k = known.toDF("id")
    out = edges.join(k, edges["src"] == k["id"], "left_semi").select(F.col("dst").alias("id"))
    back = edges.join(k, edges["dst"] == k["id"], "left_semi").select(F.col("src").alias("id"))
    return out.union(back).distinct().join(k, "id", "left_anti")


def degrees(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """(id, in_degree, out_degree, degree), with vertices of degree 0 if vertices (id) are given."""
    ends = edges.select(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionAll(edges.select("dst", F.lit(0), F.lit(1)))
    if vertices is not None:
        ends = ends.unionAll(vertices.select("id", F.lit(0), F.lit(0)))
    return ends.groupBy("id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree")).withColumn("degree", F.col("in_degree") + F.col("out_degree"))


def degree_histogram(edges: DataFrame, which: str = "degree") -> DataFrame:
    return degrees(edges).groupBy(which).agg(F.count("*").alias("n")).orderBy(which)


def component_sizes(edges: DataFrame) -> DataFrame:
    return connected_components(edges).groupBy("component").agg(F.count("*").alias("size"))


def largest_component(edges: DataFrame) -> DataFrame:
    """(id) of the vertices of the largest component, the one with the smallest label among equals."""
    parts = connected_components(edges)
    top = parts.groupBy("component").agg(F.count("*").alias("size")).agg(F.max(F.struct("size", (-F.col("component")).alias("low"))).alias("t")).select((-F.col("t.low")).alias("component"))
    return parts.join(F.broadcast(top), "component", "left_semi").select("id")  # one row


def largest_subgraph(edges: DataFrame) -> DataFrame:
    return induced_edges(edges, largest_component(edges), "src", "dst")


def is_connected(edges: DataFrame) -> DataFrame:
    """One row (connected): whether there is exactly one component."""
    return connected_components(edges).agg((F.count_distinct("component") == 1).alias("connected"))


def is_bipartite(edges: DataFrame) -> DataFrame:
    """One row (bipartite): no vertex meets its double in the graph whose edges join v to the double of w and the double of v to w. Ids are integers."""
    two = lambda c: F.col(c) * 2
    doubled = edges.select(two("src").alias("src"), (two("dst") + 1).alias("dst")).unionAll(edges.select(two("src") + 1, two("dst")))
    sides = connected_components(doubled).select(F.shiftright("id", 1).alias("v"), "component").groupBy("v").agg(F.count_distinct("component").alias("n"))
    return sides.agg(F.coalesce(F.min("n") == 2, F.lit(True)).alias("bipartite"))


def dealt_pairs(one: DataFrame, block: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Both sides (l, r, i, j) of a self join of distinct (l, r) on r, i and j, under which each pair l < m of an r meets once.

    The members of an r with more than `block` of them are dealt into blocks by a hash; each pair of blocks is a key of its own, so
    no key holds more than about two blocks of rows, however large r is. The others have the only key (0, 0).
    """
    sizes = one.groupBy("r").agg(F.count("*").alias("c")).where(F.col("c") > block).select(F.col("r").alias("_r"), F.ceil(F.col("c") / block).cast("int").alias("blocks"))
    large = written(sizes, "large")  # at most a row for `block` rows
    if large.isEmpty():
        alone = one.select("l", "r", F.lit(0).alias("i"), F.lit(0).alias("j"))
        return alone, alone
    placed = one.join(broadcast_below(large, 200_000), F.col("r") == F.col("_r"), "left").select("l", "r", F.coalesce("blocks", F.lit(1)).alias("n"))
    placed = placed.withColumn("b", F.pmod(F.xxhash64("l"), F.col("n")).cast("int"))
    first = placed.select("l", "r", F.col("b").alias("i"), F.explode(F.sequence(F.col("b"), F.col("n") - 1)).alias("j"))
    second = placed.select("l", "r", F.explode(F.sequence(F.lit(0), F.col("b"))).alias("i"), F.col("b").alias("j"))
    return first, second


def class_projection(rows: DataFrame, left: str, right: str, most: int | None = None, block: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(a, b, weight), pairs a <= b of classes and how many of `right` their members share, and (class, l), the members of each class.

    A class holds the `left` with the same set of `right`, told by its size and two 64-bit hash sums, and is named by its smallest member.
    Two members of a class share all of its set: the pair (a, a) says so, of classes of one, too. So the pairs of hubs that have the same
    sets stay few, and nothing is lost: each pair of members has the weight of the pair of their classes. Null ends are left out, repeated rows count once.
    """
    return _class_pairs(*_classes(_shared(rows, left, right, most)), block)


def _shared(rows: DataFrame, left: str, right: str, most: int | None) -> DataFrame:
    one = rows.select(F.col(left).alias("l"), F.col(right).alias("r")).where("l IS NOT NULL AND r IS NOT NULL").distinct()
    if most is not None:
        large = one.groupBy("r").count().where(F.col("count") > most).select("r")
        one = one.join(large, "r", "left_anti")
    return written(one, "shared")


def _classes(one: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one, (class, l)) of distinct (l, r)."""
    total = lambda seed: F.sum(F.xxhash64("r", F.lit(seed)).cast("decimal(20,0)")).alias(f"h{seed}")
    sets = written(one.groupBy("l").agg(F.count("*").alias("n"), total(1), total(2)), "sets")
    names = sets.groupBy("n", "h1", "h2").agg(F.min("l").alias("class"))
    return one, written(sets.join(names, ["n", "h1", "h2"]).select("class", "l"), "classes")


def _class_pairs(one: DataFrame, held: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    first = held.where("class = l").select("l")
    kept = written(one.join(first, "l", "left_semi"), "kept")
    same = kept.groupBy("l").agg(F.count("*").alias("weight")).select(F.col("l").alias("a"), F.col("l").alias("b"), "weight")
    return _pairs(kept, block).unionByName(same), held


def _pairs(one: DataFrame, block: int) -> DataFrame:
    first, second = dealt_pairs(one, block)
    met = first.join(second.withColumnRenamed("l", "m"), ["r", "i", "j"]).where("i < j AND l <> m OR i = j AND l < m")
    return met.groupBy(F.least("l", "m").alias("a"), F.greatest("l", "m").alias("b")).agg(F.count("*").alias("weight"))


def projection(rows: DataFrame, left: str, right: str, most: int | None = None, block: int = 1000) -> DataFrame:
    """(a, b, weight): pairs a < b of `left` and how many of `right` they share. most leaves out members of
    `right` with more of `left` than that, as their pairs grow with the square; without it nothing is left out, and large
    members are joined block by block (dealt_pairs). Weights are added up before the exchange. Null ends are left out, repeated rows count once.

    Where sets repeat so often that there are at most half as many classes (class_projection) as members, pairs are counted between classes,
    and those of their members follow in blocks as each task writes them, without an exchange or a sum of pairs.
    """
    one, held = _classes(_shared(rows, left, right, most))
    if held.where("class = l").count() * 2 > held.count():
        return _pairs(one, block)
    return members_of_pairs(*_class_pairs(one, held, block))


def members_of_pairs(pairs: DataFrame, held: DataFrame, block: int = 2048) -> DataFrame:
    """(a, b, weight) of members for the pairs (a, b, weight) of classes (class, l), a pair of two members of one class once. The members of a
    class are dealt into blocks of about `block`; each pair of blocks is a key of its own, spread over tasks, and no pair of members is exchanged."""
    sizes = written(held.groupBy("class").agg(F.ceil(F.count("*") / block).cast("int").alias("n")), "sizes")
    small = broadcast_below(sizes, 200_000)
    dealt = broadcast_below(written(held.join(small, "class").select("class", "l", F.pmod(F.xxhash64("l"), F.col("n")).cast("int").alias("at")), "dealt"), 500_000)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = pairs.join(small.toDF("a", "n_a"), "a").join(small.toDF("b", "n_b"), "b").withColumn("i", each("n_a")).withColumn("j", each("n_b"))
    keys = written(keys.where("a < b OR i <= j").select("a", "b", "i", "j", "weight"), "keys")
    left = keys.repartition(max(1, min(2000, keys.count())), "a", "b", "i", "j").join(dealt.toDF("a", "l", "i"), ["a", "i"])
    met = left.join(dealt.toDF("b", "m", "j"), ["b", "j"]).where("a < b OR i < j OR l < m")
    return met.select(F.least("l", "m").alias("a"), F.greatest("l", "m").alias("b"), "weight")


def citation_weights(edges: DataFrame, author_counts: DataFrame, key: str, count: str, drop_zero: bool = True) -> DataFrame:
    """edges with weight 1 / (authors of src * authors of dst); an end without authors gives 0, which is dropped."""
    both = counts_on_edges(edges, author_counts, "src", "dst", key, count)
    out = both.withColumn("weight", F.coalesce(pair_weight(F.col("src_count"), F.col("dst_count")), F.lit(0.0)))
    return out.where("weight > 0") if drop_zero else out


def weight_histogram(edges: DataFrame, col: str = "weight", bins: int = 20) -> DataFrame:
    """(bin, low, high, n): equal bins between the least and the greatest value."""
    low, high = edges.agg(F.min(col), F.max(col)).first()
    low, width = (low or 0.0), ((high or 0.0) - (low or 0.0)) / bins
    at = F.least(F.lit(bins - 1), F.floor((F.col(col) - low) / width)).cast("int") if width else F.lit(0)
    counted = edges.where(F.col(col).isNotNull()).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    return counted.select("bin", (low + F.col("bin") * width).alias("low"), (low + (F.col("bin") + 1) * width).alias("high"), "n")


def graph_size(edges: DataFrame) -> DataFrame:
    """One row (vertices, edges)."""
    ones = vertices_of(edges).select(F.lit(1).alias("v"), F.lit(0).alias("e")).unionAll(edges.select(F.lit(0), F.lit(1)))
    return ones.agg(F.coalesce(F.sum("v"), F.lit(0)).alias("vertices"), F.coalesce(F.sum("e"), F.lit(0)).alias("edges"))


def related_concepts(concepts: DataFrame, ancestors: DataFrame, related: DataFrame) -> DataFrame:
    """(concept_id, kind, other_id, other_name, score): ancestors and related concepts with their names."""
    rows = ancestors.select("concept_id", F.lit("ancestor").alias("kind"), F.col("ancestor_id").alias("other_id"), F.lit(None).cast("double").alias("score"))
    rows = rows.unionByName(related.select("concept_id", F.lit("related").alias("kind"), F.col("related_concept_id").alias("other_id"), F.col("score").cast("double")))
    return rows.join(concepts.select(F.col("concept_id").alias("other_id"), F.col("concept_name").alias("other_name")), "other_id", "left")
