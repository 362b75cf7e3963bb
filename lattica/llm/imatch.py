"""I-Match document fingerprints, in DataFrame functions only.

The lexicon holds the terms within a band of inverse document frequency, each counted by itself over
all documents. A bitmap of bounded size, a constant of the plan, tells which terms of a document are
in it, so no join and no shuffle of words finds them. Random subsets of the lexicon are hashed by
themselves: a document's fingerprint is the list of these hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import broadcast_below, written

#: Terms that the lexicon has at most; of more in the band, those in most documents. Bits of the bitmap for each.
MOST_TERMS, BITS_PER_TERM = 1 << 20, 12
#: A subset takes one of so many terms, for short, usual and long texts; so many subsets of each density.
DENSITIES, SUBSETS = (64, 512, 4096), 64
#: A density speaks for two texts if so many of its subsets are not empty in one of them.
ENOUGH = 12


def _term_hashes(text: Column) -> Column:
    """Distinct hashes of the words, lower case."""
    words = F.split(F.lower(text), r"[\x20\x09-\x0D]+")
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


class Lexicon:
    """Bitmap of the terms in the band: each has two bits of 2**bits, told by hashes of the term's hash.
    A term outside is taken for one inside if other terms set both, about one in forty at the most; it
    is so in every document, so equal texts stay equal."""

    def __init__(self, bits: int, words: dict[int, int]) -> None:
        self.bits = bits
        held = dict.fromkeys(range(1 << (bits - 6)), 0) | words
        self.array = F.split(F.lit(",".join(map(str, held.values()))), ",").cast("array<bigint>")

    def places(self, term: Column) -> list[Column]:
        return [F.shiftrightunsigned(F.xxhash64(term, F.lit(i)), 64 - self.bits) for i in (1, 2)]

    def has(self, term: Column) -> Column:
        def bit(at: Column) -> Column:
            word = F.element_at(self.array, (F.shiftright(at, 6) + 1).cast("int"))
            return F.call_function("shiftrightunsigned", word, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

        first, second = self.places(term)
        return bit(first) & bit(second)


def lexicon_table(docs: DataFrame, text_col: str = "text", band: tuple[float, float] = (0.2, 0.8), most: int = MOST_TERMS) -> DataFrame:
    """(term): hashes of the terms in the band, which is in units of log(number of documents): (0.2, 0.8)
    keeps terms in more than N ** 0.2 and fewer than N ** 0.8 documents. All documents count. If over `most` terms lie in
    it, the band is narrowed from its rare end, by sixteenths of an octave of document frequency, until they fit."""
    n = math.log(max(2, docs.count()))
    terms = docs.select(F.explode(_term_hashes(F.coalesce(F.col(text_col).cast("string"), F.lit("")))).alias("term")).groupBy("term").count()
    level = F.floor(F.log2("count") * 16).cast("int").alias("level")
    held = written(terms.where(F.log("count").between((1 - band[1]) * n, (1 - band[0]) * n)).select("term", level), "lexicon")
    total, least = 0, 0
    for r in sorted(held.groupBy("level").count().collect(), reverse=True):  # at most 16 levels an octave
        total += r["count"]
        if total > most:
            least = r["level"] + 1
            break
    return held.where(F.col("level") >= least).select("term")


def lexicon(docs: DataFrame, text_col: str = "text", band: tuple[float, float] = (0.2, 0.8)) -> Lexicon:
    """The bitmap of lexicon_table(): at most 2 MB are gathered, however large the band's vocabulary is."""
    terms = lexicon_table(docs, text_col, band)
    n = terms.count()
    empty = Lexicon(max(10, (BITS_PER_TERM * n).bit_length()), {})
    at = terms.select(F.explode(F.array(*empty.places(F.col("term")))).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("held")).collect()
    return Lexicon(empty.bits, {r["word"]: r["held"] for r in words})


def lexicon_terms(text: Column, lex: Lexicon) -> Column:
    """The text's distinct terms within the lexicon, as sorted hashes."""
    return F.sort_array(F.filter(_term_hashes(F.coalesce(text, F.lit(""))), lex.has))


def fingerprint_terms(text: Column, lex: Lexicon) -> Column:
    """lexicon_terms(), or all distinct terms of a text without any of them, or the text's own hash where it has no words:
    so texts that are not equal are not alike for want of terms."""
    text = F.coalesce(text, F.lit(""))
    both = F.transform(F.array(_term_hashes(text)), lambda h: F.struct(h.alias("all"), F.filter(h, lex.has).alias("known")))  # hashes are bound once
    return F.transform(both, lambda x: F.sort_array(F.when(F.size(x["known"]) > 0, x["known"]).when(F.size(x["all"]) > 0, x["all"]).otherwise(F.array(F.xxhash64(text)))))[0]


def _bits(term: Column, at: int, mask: int) -> Column:
    return F.shiftright(term, at).bitwiseAND(F.lit(mask))


def subset_hashes(terms: Column) -> Column:
    """A number from 1 to 127 for each of 64 subsets of each density, the hash of the sorted terms in
    it, or 0 if there are none. Subsets are told apart by two octal digits of the term's hash."""
    octal = F.array(*[F.lit(i).cast("long") for i in range(8)])

    def hashes(chosen: Column) -> Column:
        eights = F.transform(octal, lambda i: F.filter(chosen, lambda t: _bits(t, 40, 7) == i))
        return F.flatten(F.transform(eights, lambda part: F.transform(octal, lambda j: F.xxhash64(F.filter(part, lambda t: _bits(t, 43, 7) == j)))))

    def sparser(density: int) -> Column:
        return F.filter(terms, lambda t: _bits(t, 46, density // 64 - 1) == 0) if density > 64 else terms

    parts = [hashes(sparser(d)) for d in DENSITIES]
    none = F.xxhash64(F.array().cast("array<bigint>"))
    return F.transform(F.concat(*parts), lambda h: F.when(h == none, F.lit(0)).otherwise(F.pmod(h, F.lit(127)) + 1).cast("tinyint"))


def as_text(hashes: str) -> Column:
    """Two hexadecimal digits for each subset."""
    return F.lower(F.array_join(F.transform(hashes, lambda x: F.lpad(F.hex(x.cast("int").bitwiseAND(F.lit(255))), 2, "0")), ""))


def likeness(a: str, b: str) -> Column:
    """0 to 1: of the subsets that are not empty in both fingerprints, the share that is equal; the
    largest among the densities with ENOUGH such subsets, or the first density's if none has. Two without any term are alike."""
    shares = []
    for k in range(len(DENSITIES)):
        both = F.zip_with(F.slice(a, SUBSETS * k + 1, SUBSETS), F.slice(b, SUBSETS * k + 1, SUBSETS), lambda x, y: F.when((x == 0) & (y == 0), F.lit(0)).when(x == y, F.lit(65537)).otherwise(F.lit(1)))
        total = F.aggregate(both, F.lit(0), lambda s, x: s + x)
        full, same = total.bitwiseAND(F.lit(65535)), F.shiftright(total, 16)
        shares.append((full, F.when(full > 0, same / full)))
    spoken = F.greatest(*[F.when(full >= ENOUGH, share) for full, share in shares])
    return F.coalesce(spoken, shares[0][1], F.when(F.col(a) == F.col(b), F.lit(1.0)).otherwise(F.lit(0.0)))


def with_next(docs: DataFrame, id_col: str, text_col: str, more: list[str], make: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows (doc_id, text, *more) with those of the next row as next_*: in descending order of the
    id, the first row after the last. Null ids come last; rows of one id stand in the order of a hash
    of the text; rows alike in both are one document and have the same next one.

    Integer ids that lie close are dealt into ranges, and each range gets a ghost of the next range's
    first row, so a window over a range suffices: texts are shuffled once. For other ids the order
    of the ids and hashes alone is made, over ranges that Spark deals, and texts are joined to it.
    make adds the columns `more`, of each row by itself, where they are dear: within ranges once for a row and a ghost.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *([] if make else more)).withColumn("h", F.xxhash64("text"))
    if base.schema["doc_id"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        rank = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)))
        ranked = base.withColumn("rank", rank).withColumn("range", F.shiftright("rank", 9))
        heads = written(ranked.groupBy("range").agg(F.max(F.struct("rank", "h")).alias("head"), F.count("*").alias("rows"), F.count_distinct("rank", "h").alias("keys")), "heads")
        ranges, rows, keys, largest = heads.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("keys"), F.lit(0)), F.coalesce(F.max("rows"), F.lit(0))).first()
        if rows == keys and largest <= 4096 and 8 * ranges <= rows + 64:
            return _next_in_ranges(ranked, heads.select("range", "head"), more, make)
    return _next_by_key(make(base) if make else base, more)


def _next_in_ranges(base: DataFrame, heads: DataFrame, more: list[str], make: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    outer = heads.withColumn("group", F.shiftright("range", 9))
    tops = outer.groupBy("group").agg(F.max(F.struct("range", "head")).alias("top"))
    order = Window.orderBy(F.desc("group"))
    first = F.first("top").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    tops = written(tops.withColumn("below", F.coalesce(F.lead("top").over(order), first)).select("group", F.col("below.head").alias("below")), "tops")
    within = Window.partitionBy("group").orderBy(F.desc("range"))
    follows = outer.withColumn("next", F.lead("head").over(within)).join(tops, "group").select("range", F.coalesce("next", "below").alias("next"))
    follows = broadcast_below(written(follows.select("range", F.col("next.rank").alias("rank"), F.col("next.h").alias("h")), "follows"), 2_000_000)
    ghosts = base.drop("range").join(follows, ["rank", "h"]).select(*base.columns, F.lit(True).alias("ghost"))
    order = Window.partitionBy("range").orderBy("ghost", F.desc("rank"), F.desc("h"))
    led = [F.lead(c).over(order).alias(f"next_{c}") for c in ("text", *more)]
    rows = base.withColumn("ghost", F.lit(False)).unionByName(ghosts)
    return (make(rows) if make else rows).select("doc_id", "text", *more, "ghost", *led).where("NOT ghost").drop("ghost")


def _next_by_key(base: DataFrame, more: list[str]) -> DataFrame:
    order = [F.col("doc_id").desc_nulls_last(), F.desc("h")]
    placed = base.select("doc_id", "h").distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(placed.withColumn("part", F.spark_partition_id()), "placed")
    heads = placed.groupBy("part").agg(F.max(F.struct("doc_id", "h")).alias("head"))  # one row for each partition
    by_part = Window.orderBy("part")
    first = F.first("head").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("part", F.coalesce(F.lead("head").over(by_part), first).alias("below"))
    key = F.struct("doc_id", "h")
    follows = placed.withColumn("next", F.lead(key).over(Window.partitionBy("part").orderBy(*order))).join(heads, "part")
    follows = follows.select(F.col("doc_id").alias("k_id"), F.col("h").alias("k_h"), F.coalesce("next", "below").alias("next"))
    rows = base.join(follows, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("h") == F.col("k_h"))).select("doc_id", "text", *more, "next")
    other = base.dropDuplicates(["doc_id", "h"]).select(F.col("doc_id").alias("n_id"), F.col("h").alias("n_h"), *[F.col(c).alias(f"next_{c}") for c in ("text", *more)])
    return rows.join(other, F.col("next.doc_id").eqNullSafe(F.col("n_id")) & (F.col("next.h") == F.col("n_h"))).drop("n_id", "n_h", "next")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next): one row per input row.

    The edited text has its last third, in code points, replaced by as many first ones of the next
    document, as with_next() has it. Null texts count as empty; texts of any length are read whole; the
    only document of a table is its own next; an empty table gives no rows; other columns are not read.
    """
    lex = lexicon(docs, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    own = lambda df: df.withColumn("terms", fingerprint_terms(F.col("text"), lex)).withColumn("own", subset_hashes(F.col("terms"))).drop("terms")
    rows = with_next(base, "doc_id", "text", ["own"], own)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "own", "next_own", F.concat(F.left("text", n - third), F.left("next_text", third)).alias("edited"))
    rows = rows.select("*", fingerprint_terms(F.col("edited"), lex).alias("terms"))
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", "next_own", subset_hashes(F.col("terms")).alias("changed"))
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text("own").alias("fingerprint"), as_text("changed").alias("edited_fingerprint"), likeness("own", "changed").alias("near_edited"), likeness("own", "next_own").alias("near_next"))
