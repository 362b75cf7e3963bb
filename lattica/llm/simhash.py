"""SimHash near-duplicates: fingerprints, sharded BK-trees, components; an exact join of shingle sets after them.

Fingerprints are compared in shards. Two fingerprints within `radius` bits agree on at least one
choice of blocks, so each is dealt to one shard per choice, and a shard holds those that agree on
its blocks. A shard's BK-tree is built in the task that got the shard: it reaches its queries by
shuffle, as a broadcast of all trees would bring the fingerprints of all documents through the
driver. Shards over `piece` fingerprints become several trees, and each pair of pieces is a group
of its own, so no task ever holds a hot shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..runtime import broadcast_below, written
from .batches import parts

SEED = 42


def simhash(text: str | None, shingle: int) -> int:
    """64-bit fingerprint as an unsigned integer; 0 where the text has no word."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=False) if len(words) >= shingle else [(0, len(joined))]
    of = xxhash.xxh64_intdigest
    return majority(np.array([of(joined[a:b], SEED) for a, b in spans], dtype=np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the 64-bit hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 15):
        counts += np.unpackbits(hashes[k : k + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp) with fp a signed 64-bit fingerprint; null and empty texts get 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            fps = np.array([simhash(t, shingle) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, fp long")


class BKTree:
    """Integers under Hamming distance; children are keyed by their distance to the parent."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while d := (value ^ node[0]).bit_count():
            child = node[1].get(d)
            if child is None:
                node[1][d] = [value, {}]
                return
            node = child

    def within(self, value: int, radius: int) -> list[tuple[int, int]]:
        """(distance, value) of all within the radius; only edges that can lead there are followed."""
        found, todo = [], [self.root] if self.root else []
        while todo:
            held, children = todo.pop()
            d = (value ^ held).bit_count()
            if d <= radius:
                found.append((d, held))
            if children:
                low, high = d - radius, d + radius
                todo += [c for e, c in children.items() if low <= e <= high]
        return found


def _spanning(tree_of: list[int], queries: list[int] | None, radius: int) -> Iterator[tuple[int, int, int]]:
    """Links that connect what is within the radius, at most one fewer than there are values.
    queries None: the links among the tree's own values."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    tree = BKTree()
    if queries is not None:
        for v in tree_of:
            tree.add(v)
    for v in tree_of if queries is None else queries:
        for d, w in sorted(tree.within(v, radius)):
            a, b = top(v), top(w)
            if a != b:
                parent[a] = b
                yield v, w, d
        if queries is None:
            tree.add(v)


def blocks_for(radius: int, n: int) -> tuple[int, int]:
    """Blocks, and how many of them must agree, for n fingerprints. Fingerprints that differ in `radius`
    bits agree on all but `radius` blocks; the more must agree, the longer the key and the smaller its
    shard, but the more shards each fingerprint is dealt to. The key is to have as many bits as n."""
    agree = 1
    while agree < 4 and 64 * agree // (radius + agree) < math.log2(max(n, 2)) - 6:
        agree += 1
    return radius + agree, agree


def simhash_links(fps: DataFrame, radius: int = 3, piece: int = 2048, agree: int | None = None) -> DataFrame:
    """(src, dst, bits) between distinct values of column fp, enough of them to connect all that
    are linked by `radius` or fewer differing bits. agree: blocks that must, by default from the number of fingerprints."""
    n, agree = (radius + agree, agree) if agree else blocks_for(radius, fps.count())
    cuts = [64 * i // n for i in range(n + 1)]
    keys = []
    for k, chosen in enumerate(combinations(range(n), agree)):
        key = F.lit(k).cast("long")
        for i in chosen:
            width = cuts[i + 1] - cuts[i]
            key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned(F.col("fp"), cuts[i]).bitwiseAND(F.lit((1 << width) - 1)))
        keys.append(key)
    dealt = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = written(dealt.groupBy("key").count().where(F.col("count") > piece).select("key", F.ceil(F.col("count") / piece).cast("int").alias("n")), "hot")
    in_hot = dealt.join(hot, "key")
    own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    split = in_hot.select("fp", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    grouped = dealt.join(hot, "key", "left_anti").select("fp", "key", F.lit(0).alias("own"), F.lit(0).alias("other")).unionByName(split)
    grouped = grouped.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(group: list[tuple]) -> Iterator[tuple[int, int, int]]:
            _, i, j, _, _ = group[0]
            mine = [r[4] for r in group if r[3] == i]
            yield from _spanning(mine, None if i == j else [r[4] for r in group if r[3] == j], radius)

        held: list[tuple] = []
        for b in batches:
            out: list[tuple[int, int, int]] = []
            fps = b.column(4).to_numpy().view(np.uint64).tolist()  # XOR of signed integers would miscount
            for row in zip(*(c.to_pylist() for c in b.columns[:4]), fps, strict=True):
                if held and held[0][:3] != row[:3]:
                    if len(held) > 1:
                        out += links(held)
                    held = []
                held.append(row)
            if out:
                yield _link_batch(out)
        if len(held) > 1:
            yield _link_batch(list(links(held)))

    dealt_out = grouped.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")
    return dealt_out.mapInArrow(run, "src long, dst long, bits int").groupBy("src", "dst").agg(F.min("bits").alias("bits"))


def _link_batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    ends = np.array([r[:2] for r in rows], dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1]), pa.array([r[2] for r in rows], pa.int32())], names=["src", "dst", "bits"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): one row per input row.

    component_id is the smallest id among the documents that links of at most `radius` differing
    bits reach. Null, empty and white-space texts share fingerprint 0; texts with fewer words than
    a shingle hash as a whole; equal rows stay, each with the same component; rows with a null id
    stay and take the smallest id of the others (null if there is none); an empty table gives no rows.
    """
    base = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    first = base.groupBy("fp").agg(F.min("doc_id").alias("first"))
    first = written(first, "first")
    found = connected_components(simhash_links(first.select("fp"), radius)).withColumnRenamed("id", "fp")
    linked = written(found.join(first, "fp"), "linked")
    lowest = written(linked.groupBy("component").agg(F.min("first").alias("low")), "lowest")  # a table, so that AQE can split a giant component
    label = linked.join(lowest, "component").select("fp", "low")
    labels = written(first.join(label, "fp", "left").select("fp", F.coalesce("low", "first").alias("component_id")), "labels")
    return base.join(labels, "fp", "left").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, piece: int = 2048, radius: int = 3) -> DataFrame:
    """The rows of docs without near copies: of each group one stays, the one with the smallest id.

    Two documents are linked if their sets of word shingles have a Jaccard similarity of at least
    `similarity`; groups are what links connect. Sets are first met by SimHash: fingerprints of their
    shingles within `radius` bits, by sharded BK-trees (simhash_links()), and checked by the sets. Few
    bits miss most links at such a similarity, so an exact join finds the rest: sets that alike share one of
    their first shingles in any common order (prefix filter), here one that puts shingles frequent
    in a sample last. Within each shingle neighbours by size are checked first. What these checks
    left in different groups is compared within its task by counts of shingles in buckets, which can
    only overrate what sets share; shingles of over `piece` sets in parts. Only pairs that join two
    groups leave the task and are checked by their sets; where one fails, finer counts follow, then all pairs.
    Null and empty texts are equal, so one stays; a row with a null id stays only if its group has
    no other; rows alike in id and text stay or go together.
    """
    text, key = F.col(text_col).cast("string"), F.xxhash64(F.col(text_col).cast("string"))
    narrow = docs.select(F.col(id_col).alias("id"), key.alias("h"), text.alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    order = docs.sparkSession.sparkContext.broadcast(_frequent(narrow, shingle))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = order.value
        for b in parts(batches, 128):  # sets need several times the text's memory
            sets = [shingle_set(t, shingle) for t in b.column(2).to_pylist()]
            firsts = []
            for s in sets:
                at = np.minimum(np.searchsorted(frequent, s), max(0, len(frequent) - 1))
                often = np.where(frequent[at] == s, counts[at], 0) if len(frequent) else np.zeros(len(s), np.int64)
                firsts.append(s[np.lexsort((s, often))][: len(s) - math.ceil(similarity * len(s) - 1e-9) + 1])
            made = [pa.array(map(_set_key, sets), pa.binary()), pa.array([len(s) for s in sets], pa.int32()), pa.array(firsts, pa.list_(pa.int64())), pa.array(map(sketch, sets), pa.binary())]
            fps = np.array([majority(s.view(np.uint64)) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *made, pa.array(fps)], names=["id", "h", "key", "n", "firsts", "sketch", "fp"])

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, 128):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t, shingle) for t in b.column(1).to_pylist()], pa.list_(pa.int64()))], names=["set", "shingles"])

    def fine_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, 128):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fine_sketch(shingle_set(t, shingle)) for t in b.column(1).to_pylist()], pa.binary())], names=["set", "sketch"])

    # equal sets are one, known by a number; the table keeps it
    base = written(narrow.mapInArrow(prefixes, f"id {kind}, h long, key binary, n int, firsts array<long>, sketch binary, fp long"), "prefixes")
    row = F.struct(F.col("id").isNull().alias("no_id"), "id", "h")
    sets = base.groupBy("key").agg(F.min(row).alias("best"), *[F.first(c).alias(c) for c in ("n", "firsts", "sketch", "fp")])
    sets = written(sets.withColumn("set", F.monotonically_increasing_id()), "sets")
    repeats = not base.groupBy("id", "h").count().where("count > 1").isEmpty()

    def texts_of(some: DataFrame) -> DataFrame:
        """(set, text) of some sets, one text each, from the documents again: few sets need theirs."""
        ends = broadcast_below(written(some.join(sets, "set").select("set", F.col("best.id").alias("k_id"), F.col("best.h").alias("k_h")), "ends"), 4_000_000)
        texts = narrow.join(ends, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("h") == F.col("k_h"))).select("set", "text")
        return texts.dropDuplicates(["set"]) if repeats else texts

    def checked(pairs: DataFrame) -> DataFrame:
        """The pairs of sets that are alike: those whose sketches have enough in common are compared shingle by shingle."""

        def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in parts(batches, 4096):
                x, y = b.column(2).to_pylist(), b.column(3).to_pylist()
                enough = [overlap(p, q) >= similarity / (1 + similarity) * n - 1e-6 for p, q, n in zip(x, y, b.column(4).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(b.columns[:2], names=["a", "b"]).filter(pa.array(enough, pa.bool_()))

        pairs = written(pairs, "pairs")
        ends = broadcast_below(written(pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct(), "ends"), 4_000_000)
        held = sets.join(ends, "set", "left_semi")
        side = lambda df, c, what: df.select(F.col("set").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in what])
        both = broadcast_below(pairs, 1_000_000).join(side(held, "a", ["sketch", "n"]), "a").join(side(held, "b", ["sketch", "n"]), "b")
        left = written(both.select("a", "b", "sketch_a", "sketch_b", F.col("n_a") + F.col("n_b")).mapInArrow(possible, "a long, b long"), "possible")
        held = written(texts_of(left.select(F.col("a").alias("set")).union(left.select("b")).distinct()).mapInArrow(shingles, "set long, shingles array<long>"), "shingles")
        both = broadcast_below(left, 1_000_000).join(side(held, "a", ["shingles"]), "a").join(side(held, "b", ["shingles"]), "b")
        common = F.size(F.array_intersect("shingles_a", "shingles_b"))
        return written(both.where(common / (F.size("shingles_a") + F.size("shingles_b") - common) >= similarity).select("a", "b"), "alike")

    def fits(x: str, y: str) -> Column:
        """Whether sets that first meet at this shingle can be alike, from sizes and places."""
        c = lambda side, name: F.col(f"{side}.{name}")
        most = F.least(c(x, "n") - c(x, "pos"), c(y, "n") - c(y, "pos"))
        sizes = F.least(c(x, "n"), c(y, "n")) >= similarity * F.greatest(c(x, "n"), c(y, "n")) - 1e-6
        return sizes & (most >= similarity / (1 + similarity) * (c(x, "n") + c(y, "n")) - 1e-6)

    def grouped(links: DataFrame) -> DataFrame:
        return written(connected_components(links, "a", "b").withColumnRenamed("id", "set"), "groups")

    one = F.struct("set", "n", "pos")
    around = Window.partitionBy("token").orderBy("n", "set")
    firsts = sets.select("set", "n", F.posexplode("firsts").alias("pos", "token"))
    seen = firsts.select("token", one.alias("me"), F.lag(one).over(around).alias("last"), F.first(one).over(around).alias("least"), F.lead("n").over(around).alias("more"))
    met = written(seen.where("last IS NOT NULL OR more IS NOT NULL"), "met")
    near = [met.where("last IS NOT NULL").where(fits("me", other)).select(F.col(f"{other}.set").alias("a"), F.col("me.set").alias("b")) for other in ("last", "least")]
    met_by = near[0].unionByName(near[1]).unionByName(_fingerprint_pairs(sets, radius))
    alike = checked(met_by.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    component = grouped(alike)

    def rest(left: DataFrame, held_by: DataFrame, fine: bool, whole: bool) -> DataFrame:
        """(token, a, b, more): pairs of different groups that can be alike by their sketches, found in the lists
        left (token, set, n, group, k): enough to connect all in a list, or with whole each one. more: whether the list has others."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for held in _runs(batches):
                token, i, j = held[0][:3]
                mine, theirs = ([r[4:] for r in held if r[3] == side] for side in (i, j))
                left_out: list = []
                found = list(sketch_links(mine, None if i == j else theirs, similarity, fine, whole, left_out=left_out))
                if found:
                    made = [pa.array(c, pa.int64()) for c in ([token] * len(found), *zip(*found, strict=True))]
                    yield pa.RecordBatch.from_arrays([*made, pa.array([bool(left_out)] * len(found))], names=["token", "a", "b", "more"])

        own = F.pmod(F.xxhash64("set"), F.col("k")).cast("int").alias("own")
        rows = left.join(held_by, "set").select("*", own, F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
        rows = rows.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "set", "n", "group", "sketch")
        return written(rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "set").mapInArrow(run, "token long, a long, b long, more boolean"), "rest")

    def in_groups(rows: DataFrame) -> DataFrame:
        return rows.join(broadcast_below(component, 1_000_000), "set", "left").withColumn("group", F.coalesce("component", "set")).drop("component")

    lists = in_groups(met.select("token", "me.set", "me.n"))
    facts = lists.groupBy("token").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count("*").alias("sets"), *[F.bit_xor(F.xxhash64("set", F.lit(i))).alias(f"of{i}") for i in (0, 1)])
    # shingles with the same sets are compared once
    mixed = facts.where("low <> high").groupBy("sets", "of0", "of1").agg(F.min("token").alias("token")).select("token", F.ceil(F.col("sets") / piece).cast("int").alias("k"))
    lists = written(lists.join(broadcast_below(written(mixed, "mixed"), 2_000_000), "token"), "lists")
    held_by = sets.select("set", "sketch")
    for fine, whole in ((False, False), (True, False), (True, True)):
        if fine and not whole:
            held_by = written(texts_of(lists.select("set").distinct()).mapInArrow(fine_sketches, "set long, sketch binary"), "fine")
        pairs = rest(lists, held_by, fine, whole)
        more = checked(pairs.select("a", "b").distinct())
        alike = alike.unionByName(more)
        component = grouped(alike)
        # where all that the sketches linked is alike, or nothing was left out, no other pair joins two groups;
        # other lists are compared again, by finer sketches, and if these fail too pair by pair
        failed = written(pairs.where("more").join(more, ["a", "b"], "left_anti").select("token").distinct(), "failed")
        if failed.isEmpty():
            break
        lists = written(in_groups(lists.drop("group")).join(broadcast_below(failed, 2_000_000), "token"), "lists")

    stays = sets.join(component, "set", "left").groupBy(F.coalesce("component", "set").alias("component")).agg(F.min("best").alias("stays"))
    gone = base.select("key", row.alias("row")).join(sets.select("key", "set"), "key").join(component, "set", "left").withColumn("component", F.coalesce("component", "set"))
    gone = gone.join(stays, "component").where(~F.col("row").eqNullSafe(F.col("stays")))
    gone = broadcast_below(written(gone.select(F.col("row.id").alias("gone_id"), F.col("row.h").alias("gone_h")).distinct(), "gone"), 4_000_000)
    whole = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("d_id"), key.alias("d_h"))  # so that no name of docs meets one of these
    return whole.join(gone, F.col("d_id").eqNullSafe(F.col("gone_id")) & (F.col("d_h") == F.col("gone_h")), "left_anti").select("doc.*")


def _fingerprint_pairs(sets: DataFrame, radius: int) -> DataFrame:
    """(a, b): sets (set, fp) that SimHash brings together: each with the first of its fingerprint, and the first ones of fingerprints that are linked."""
    first = written(sets.groupBy("fp").agg(F.min("set").alias("first")), "first")
    one = lambda end, name: first.select(F.col("fp").alias(end), F.col("first").alias(name))
    linked = simhash_links(first.select("fp"), radius).join(one("src", "a"), "src").join(one("dst", "b"), "dst").select("a", "b")
    same = sets.select("set", "fp").join(first, "fp").where(F.col("set") != F.col("first")).select(F.col("first").alias("a"), F.col("set").alias("b"))
    return linked.unionByName(same)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows in runs that agree on the first three columns; runs of one row are left out."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held and held[0][:3] != row[:3]:
                if len(held) > 1:
                    yield held
                held = []
            held.append(row)
    if len(held) > 1:
        yield held


def sketch(shingles: np.ndarray) -> bytes:
    """How many shingles fall in each of half as many buckets, to the next power of two, by the
    last bits; 255 stands for more. The sum of the smaller counts is at least what two sets have in common."""
    buckets = 1 << max(3, (len(shingles) - 1).bit_length() - 1)
    counts = np.bincount((shingles & (buckets - 1)).astype(np.int64), minlength=buckets)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _counts(held: bytes, buckets: int) -> np.ndarray:
    """A sketch's counts, folded to fewer buckets."""
    x = np.frombuffer(held, np.uint8)
    x = np.where(x == 255, 1 << 14, x).astype(np.uint16)
    return np.minimum(x.reshape(-1, buckets).sum(axis=0), 1 << 14).astype(np.uint16)


def overlap(a: bytes, b: bytes) -> int:
    """At least what the sets of two sketches have in common."""
    buckets = min(len(a), len(b))
    return int(np.minimum(_counts(a, buckets), _counts(b, buckets)).sum(dtype=np.int64))


def fine_sketch(shingles: np.ndarray) -> bytes:
    """The last 16 bits of each shingle, sorted: as a multiset it has at least, and seldom more than, what two sets have in common."""
    return np.sort((shingles & 0xFFFF).astype(np.uint16)).tobytes()


class Buckets:
    """Sketches to be compared in so many buckets."""

    def __init__(self, sketches: list[bytes], buckets: int) -> None:
        self.buckets, self.counts = buckets, np.stack([_counts(x, buckets) for x in sketches])

    def common(self, sketch: bytes, at: np.ndarray) -> np.ndarray:
        return np.minimum(self.counts[at], _counts(sketch, self.buckets)).sum(axis=1, dtype=np.int64)


class Postings:
    """Which of some fine sketches hold a value; equal values of a sketch are numbered, so that they count one by one."""

    def __init__(self, sketches: list[bytes]) -> None:
        codes = [self.codes(x) for x in sketches]
        every, of = np.concatenate(codes), np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        order = np.argsort(every, kind="stable")
        self.n, self.of = len(codes), of[order]
        self.keys, self.starts, self.sizes = np.unique(every[order], return_index=True, return_counts=True)

    def common(self, sketch: bytes, at: np.ndarray) -> np.ndarray:
        codes = self.codes(sketch)
        found = np.minimum(np.searchsorted(self.keys, codes), len(self.keys) - 1)
        found = found[self.keys[found] == codes]
        sizes = self.sizes[found]
        ends = np.cumsum(sizes)
        where = np.repeat(self.starts[found] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return np.bincount(self.of[where], minlength=self.n)[at]

    @staticmethod
    def codes(sketch: bytes) -> np.ndarray:
        v = np.frombuffer(sketch, np.uint16).astype(np.int64)
        new = np.flatnonzero(np.diff(v, prepend=-1))
        return v << 32 | np.arange(len(v)) - np.repeat(new, np.diff(np.append(new, len(v))))


def sketch_links(mine: list[tuple], theirs: list[tuple] | None, similarity: float, fine: bool, whole: bool, block: int = 1 << 22, left_out: list | None = None) -> Iterator[tuple[int, int]]:
    """Pairs (set, set) of rows (set, n, group, sketch) in different groups whose sketches, all fine or
    none, have enough in common: within mine, or with theirs between the two. whole: each pair, else
    as many as connect them. Sets are compared with larger ones, in the buckets of the smaller one; at
    most about `block` counts are held at once. left_out gets a mark for each pair that others connect."""
    rows = sorted(((r[1], r[0], r[2], r[3], side) for side, given in enumerate((mine, theirs or [])) for r in given))
    parent = {r[2]: r[2] for r in rows}
    if len(parent) == 1:
        return

    def top(g: int) -> int:
        while parent[g] != g:
            parent[g] = g = parent[parent[g]]
        return g

    groups, n, side = np.array([r[2] for r in rows]), np.array([r[0] for r in rows]), np.array([r[4] for r in rows])
    ends = np.searchsorted(n, n / similarity + 1e-6, side="right")  # no larger set can be alike
    widths = np.array([0 if fine else len(r[3]) for r in rows])
    a = 0
    while a < len(rows):
        b = int(np.searchsorted(widths, widths[a], side="right"))
        last = int(ends[b - 1])
        step = max(1, block // max(len(r[3]) for r in rows[a:last]))
        for c in range(a, last, step):
            d = min(c + step, last)
            held = [r[3] for r in rows[c:d]]
            index = Postings(held) if fine else Buckets(held, int(widths[a]))
            for k in range(a, min(b, d)):
                x, y = max(c, k + 1), min(d, int(ends[k]))
                can = groups[x:y] != groups[k]
                if theirs is not None:
                    can &= side[x:y] != side[k]
                at = np.flatnonzero(can) + x
                if not len(at):
                    continue
                common = index.common(rows[k][3], at - c)
                for m in at[common >= similarity / (1 + similarity) * (n[at] + n[k]) - 1e-6].tolist():
                    g, h = top(rows[k][2]), top(rows[m][2])
                    if whole or g != h:
                        parent[g] = h
                        yield min(rows[k][1], rows[m][1]), max(rows[k][1], rows[m][1])
                    elif left_out is not None and not left_out:
                        left_out.append(True)
        a = b


def _frequent(texts: DataFrame, shingle: int, sample: int = 5_000, at_most: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
    """Shingles found three times or more in about `sample` texts, sorted, and their counts. Only the
    order of the prefix filter depends on them, not its result."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, 128):
            for t in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t, shingle))], names=["token"])

    share = int(min(1.0, sample / max(1, texts.count())) * 1_000_000)
    some = texts.where(F.pmod(F.xxhash64("id", "h"), F.lit(1_000_000)) < share).select("text")
    often = some.mapInArrow(tokens, "token long").groupBy("token").agg(F.count("*").alias("n")).where("n >= 3")
    found = often.orderBy(F.desc("n"), "token").limit(at_most).toArrow()
    token, n = found["token"].to_numpy(), found["n"].to_numpy()
    by = np.argsort(token)
    return token[by], n[by]


def _set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; of the whole text if it is shorter; one for no words."""
    words = (text or "").encode().lower().split()
    of = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([of(b" ".join(words), SEED)], np.uint64).view(np.int64)
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=False)
    return np.unique(np.array([of(joined[a:b], SEED) for a, b in spans], np.uint64).view(np.int64))
