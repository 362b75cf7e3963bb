"""Exact deduplication by an exchange of Golomb-coded fingerprints.

A partition sends each owner of a hash range its sorted distinct hashes, Golomb-Rice coded, with a bitmap of
those that it has several times, and gets back a bitmap of those that occur twice or elsewhere too. So an owner
gets a text's hash once from each partition, however many copies there are. Only rows under a set bit are suspects; only their
texts are shuffled, grouped byte by byte with a partial aggregate before the shuffle, so a group
of copies of any size sends one text from each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import broadcast_below, written

HASH_BITS = 48


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted integers as Rice-coded gaps: a header of count and parameter, the unary parts, the low bits."""
    n = len(values)
    if not n:
        return b""
    gaps = np.diff(values, prepend=0).astype(np.int64)
    k = max(0, int(np.log2(max(1.0, 0.69 * float(gaps.mean())))))
    ends = np.cumsum((gaps >> k) + 1)
    unary = np.ones(int(ends[-1]), dtype=np.uint8)
    unary[ends - 1] = 0
    low = ((gaps[:, None] >> np.arange(k)) & 1).astype(np.uint8)
    return np.array([n, k, len(unary)], dtype="<i8").tobytes() + np.packbits(unary).tobytes() + np.packbits(low).tobytes()


def golomb_decode(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype=np.int64)
    n, k, length = np.frombuffer(data, dtype="<i8", count=3).tolist()
    cut = 24 + (length + 7) // 8
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(data[24:cut], dtype=np.uint8), count=length) == 0)
    high = np.diff(ends, prepend=-1) - 1
    low = np.unpackbits(np.frombuffer(data[cut:], dtype=np.uint8), count=n * k).reshape(n, k).astype(np.int64) @ (1 << np.arange(k, dtype=np.int64)) if k else 0
    return np.cumsum((high.astype(np.int64) << k) + low)


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _hashed(norm: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(norm), 64 - HASH_BITS)


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owners: int | None = None, broadcast_rows: int = 4_000_000) -> DataFrame:
    """(doc_id, sha, keep_id, group_size, kept): one row per input row, texts equal after white-space runs become one space.

    The row with the smallest id stays; among repeats of that id one of them does, and rows with a
    null id stay only if the group has no other. Null and empty texts are equal; an empty table
    gives no rows; other columns are not read. owners: parts of the hash range, by default the
    session's shuffle partitions, or more for so many rows that an owner would get over two million. Hashes of suspects are broadcast up to broadcast_rows (8 bytes
    each) and joined by shuffle beyond.
    """
    spark = docs.sparkSession
    parts = owners or max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // 2_000_000)
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [b for b in batches if b.num_rows]
        if not kept:
            return
        rows, sender = pa.Table.from_batches(kept).combine_chunks(), TaskContext.get().partitionId()
        # a hash is sent once, however many rows of this sender have it, with a bit for those that repeat here
        hashes, of, counts = np.unique(rows["fp"].to_numpy(), return_inverse=True, return_counts=True)
        owner = (hashes.astype(np.float64) * parts / 2**HASH_BITS).astype(np.int64)
        cuts = np.searchsorted(owner, np.arange(parts + 1))
        at = np.arange(len(hashes)) - cuts[owner]
        n = len(of)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, sender)), pa.array(owner[of]), pa.array(at[of]), pa.array(np.arange(n)), rows["doc_id"].combine_chunks(), rows["fp"].combine_chunks(), rows["sha"].combine_chunks(), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
            names=names,
        )
        full = np.flatnonzero(np.diff(cuts))
        coded = [golomb_encode(hashes[cuts[o] : cuts[o + 1]]) for o in full]
        again = [np.packbits(counts[cuts[o] : cuts[o + 1]] > 1).tobytes() for o in full]
        m = len(full)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(m, sender)), pa.array(full), *[pa.nulls(m, pa.int64())] * 2, pa.nulls(m, rows["doc_id"].type), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.array(coded, pa.binary()), pa.array(again, pa.binary())], names=names)

    names = ["sender", "owner", "pos", "row", "doc_id", "fp", "sha", "coded", "again"]
    narrow = texts.select("doc_id", _hashed("norm").alias("fp"), F.unhex(F.sha2("norm", 256)).alias("sha"))
    sent = written(narrow.mapInArrow(send, f"sender long, owner long, pos long, row long, doc_id {kind}, fp long, sha binary, coded binary, again binary"), "sent")
    rows = sent.where("pos IS NOT NULL").drop("coded", "again")

    def answer(lists: pd.DataFrame) -> pd.DataFrame:
        held = [golomb_decode(x) for x in lists["coded"]]
        every = np.concatenate(held)
        _, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
        here = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(h)).astype(bool) for x, h in zip(lists["again"], held, strict=True)]
        twice = (counts[inverse] > 1) | np.concatenate(here)
        out, a = [], 0
        for x in held:
            bits = twice[a : a + len(x)]
            a += len(x)
            out.append(np.packbits(np.pad(bits, (0, -len(bits) % 64)), bitorder="little").view(np.int64))
        return pd.DataFrame({"sender": lists["sender"], "owner": lists["owner"], "bits": out})

    bitmaps = sent.where("coded IS NOT NULL").select("sender", "owner", "coded", "again").groupBy("owner").applyInPandas(answer, "sender long, owner long, bits array<long>")
    bit = F.expr("shiftrightunsigned(element_at(bits, cast(pos div 64 as int) + 1), cast(pos % 64 as int)) & 1")
    suspects = written(rows.join(bitmaps, ["sender", "owner"]).where(bit == 1).select("doc_id", "fp", "sha", "sender", "row"), "suspects")

    doubted = broadcast_below(written(suspects.select("fp").distinct(), "doubted"), broadcast_rows)
    verified = texts.withColumn("fp", _hashed("norm")).join(doubted, "fp", "left_semi").groupBy("norm").agg(F.count("*").alias("group_size"))
    verified = verified.where("group_size > 1").select(F.unhex(F.sha2("norm", 256)).alias("sha"), "group_size")
    first = suspects.groupBy("sha").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sender", "row")).alias("first"))
    groups = written(verified.join(first, "sha"), "groups")
    same = F.struct("sender", "row") == F.struct("first.sender", "first.row")
    return rows.join(groups, "sha", "left").select(
        "doc_id",
        "sha",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("first").isNull() | same).alias("kept"),
    )


def distinct_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 4_000_000) -> DataFrame:
    """The rows of docs that duplicate_groups() keeps, one of each group of equal texts, with all their columns.

    A row is known by its id and its text, so rows of one id with different texts are judged apart,
    rows with a null id too; of rows alike in both one stays. Only members of groups are joined back.
    """
    members = duplicate_groups(docs, id_col, text_col).where("group_size > 1").groupBy("doc_id", "sha")
    members = written(members.agg(F.max("kept").alias("kept"), F.count("*").alias("n")).select(F.col("doc_id").alias("m_id"), F.col("sha").alias("m_sha"), "kept", "n"), "members")
    sha = F.unhex(F.sha2(normalised(F.col(text_col)), 256))
    whole = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("d_id"), sha.alias("d_sha"))  # so that no name of docs meets one of these
    marked = whole.join(broadcast_below(members, broadcast_rows), F.col("d_id").eqNullSafe(F.col("m_id")) & (F.col("d_sha") == F.col("m_sha")), "left")
    alone = marked.where("n IS NULL OR (kept AND n = 1)").select("doc.*")
    if members.where("kept AND n > 1").isEmpty():
        return alone
    return alone.unionByName(marked.where("kept AND n > 1").dropDuplicates(["m_id", "m_sha"]).select("doc.*"))
