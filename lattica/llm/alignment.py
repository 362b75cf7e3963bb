"""Alignment of two tokenizers' tokens by the bytes they cover.

Both sides' tokens tile the same bytes. A pandas merge_asof per batch, on a key of document and first byte,
finds for the start of each token the other side's token that covers it; of two tokens that overlap one starts
within the other, so both directions together give all overlaps. Tokens that end at the same byte close a group.

Neither tokenizer joins a space with what stands before it, unless that is white space, too. A text without such
places is the same as its words, each with a space before it, and words repeat: each worker keeps the ids of those it
met, up to a bound. Words that are new to it are encoded together, as one text.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import broadcast_below, written
from .batches import parts
from .bpe import BYTE_LEVEL_SPLIT, byte_letters

#: Characters of a batch; a longer document is a batch of its own.
BATCH_CHARS = 400_000
#: Pairs of ids up to which their counts are broadcast: 16 bytes each and their hash table.
FEW_PAIRS = 1_500_000
#: Words whose ids a worker keeps, twice.
KEPT_WORDS = 200_000


class Tokenizers:
    """Side A from a byte-level BPE file, side B from a sentencepiece model; neither knows special tokens in a text."""

    def __init__(self, a: str, b: bytes, kept: int = KEPT_WORDS) -> None:
        spec = json.loads(a)
        letters = {c: k for k, c in enumerate(byte_letters())}
        special = {t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if i not in special}
        self.a = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for raw, i in ranks.items():
            self.a_bytes[i] = raw
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.by_word = not any(re.search("[^▁]▁", p) for p in pieces)
        # ids of words, as bytes; None for a word that must be encoded within its text
        self.kept, self.words, self.older = kept, {}, {}
        # what stands for each token in the digest's text: the id and what follows it, by 2 * id + (1 at the end of a group)
        self.shown = np.array([f"{i}{s}" for i in range(len(self.a_bytes)) for s in ",|"] + [f"{i}{s}" for i in range(len(pieces)) for s in ",;"], object)

    def whole(self, text: str) -> tuple[bytes, bytes] | None:
        """Ids of a space and the text on both sides, as little-endian 32-bit integers; None where a side's bytes are not those."""
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text)
        raw = b" " + text.encode()
        if b"".join(map(self.b_bytes.__getitem__, b)) != raw or b"".join(map(self.a_bytes.__getitem__, a)) != raw:
            return None
        return np.array(a, "<i4").tobytes(), np.array(b, "<i4").tobytes()

    def learn(self, new: list[str]) -> None:
        """Keep the ids of these words."""
        fit = [w for w in new if w and not w[0].isspace()]
        self.words.update(dict.fromkeys(new))
        found = self.whole(" ".join(fit)) if fit else None
        if found is None:
            for w in fit:
                self.words[w] = self.whole(w)
            return
        ends = np.cumsum([len(w.encode()) + 1 for w in fit])
        cuts = []
        for ids, sizes in zip(found, (self.a_size, self.b_size), strict=True):
            cuts.append((4 * (np.searchsorted(np.cumsum(sizes[np.frombuffer(ids, "<i4")]), ends) + 1)).tolist())
        last_a = last_b = 0
        for w, to_a, to_b in zip(fit, *cuts, strict=True):
            self.words[w] = found[0][last_a:to_a], found[1][last_b:to_b]
            last_a, last_b = to_a, to_b

    def both(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """The ids of each text on both sides; none where it is empty or a side's bytes are not those of a space and the text."""
        split = [t.split(" ") for t in texts]
        if self.by_word:
            if len(self.words) > self.kept:
                self.words, self.older = {}, self.words
            new = set().union(*split).difference(self.words)
            again = new.intersection(self.older)
            self.words.update((w, self.older[w]) for w in again)
            self.learn(sorted(new - again))
        out = []
        for text, words in zip(texts, split, strict=True):
            found = list(map(self.words.__getitem__, words)) if self.by_word and text else [None]
            if None in found:
                out.append((text and self.whole(text)) or (b"", b""))
            else:
                out.append((b"".join([x[0] for x in found]), b"".join([x[1] for x in found])))
        return out


_sides: dict[bytes, Tokenizers] = {}


def tokenizers(a: str, b: bytes) -> Tokenizers:
    """The worker's tokenizers, kept between tasks."""
    key = hashlib.sha256(a.encode() + b).digest()
    if key not in _sides:
        _sides[key] = Tokenizers(a, b)
    return _sides[key]


class Batch:
    """Tokens of several documents: ids, document, first and last byte of each on both sides, and the links between them."""

    def __init__(self, sides: Tokenizers, texts: list[str]) -> None:
        self.sides = sides
        ids = sides.both(texts)
        self.n_a, self.n_b = (np.array([len(x[k]) // 4 for x in ids], np.int64) for k in (0, 1))
        self.a, self.b = (np.frombuffer(b"".join([x[k] for x in ids]), "<i4").astype(np.int64) for k in (0, 1))
        # the bytes of the batch are numbered on, so a place is a key of document and offset at once
        self.a_end, self.b_end = np.cumsum(sides.a_size[self.a]), np.cumsum(sides.b_size[self.b])
        a_start, b_start = self.a_end - sides.a_size[self.a], self.b_end - sides.b_size[self.b]
        left, right = pd.DataFrame({"at": a_start, "i": np.arange(len(a_start))}), pd.DataFrame({"at": b_start, "j": np.arange(len(b_start))})
        of_a, of_b = pd.merge_asof(left, right, on="at"), pd.merge_asof(right, left, on="at")
        new = a_start[of_b["i"].to_numpy()] != b_start if len(b_start) else np.empty(0, bool)  # those that start together are in both
        self.i, self.j = (np.concatenate([of_a[k].to_numpy(), of_b[k].to_numpy()[new]]) for k in ("i", "j"))
        self.doc = np.repeat(np.arange(len(texts)), self.n_a)  # of the tokens of side A
        closed = self.a_end[self.i] == self.b_end[self.j]
        self.a_closes, self.b_closes = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        self.a_closes[self.i[closed]] = True
        self.b_closes[self.j[closed]] = True

    def per_document(self, marks: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.bincount(of, marks, len(self.n_a)).astype(np.int64)

    @property
    def n_groups(self) -> np.ndarray:
        return self.per_document(self.a_closes, self.doc)

    @property
    def n_links(self) -> np.ndarray:
        return np.bincount(self.doc[self.i], minlength=len(self.n_a))

    def groups_text(self) -> list[str]:
        """Of each document `a1,a2|b1;a3|b2,b3`: the ids of both sides, group by group."""
        ahead_b = np.concatenate([[0], np.flatnonzero(self.b_closes) + 1])  # tokens of B before each group
        upto_a = np.append(np.flatnonzero(self.a_closes) + 1, len(self.a))  # tokens of A up to each group's end
        group_a = np.cumsum(self.a_closes) - self.a_closes
        group_b = np.cumsum(self.b_closes) - self.b_closes
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + ahead_b[group_a]] = 2 * self.a + self.a_closes
        codes[np.arange(len(self.b)) + upto_a[group_b]] = 2 * (self.b + len(self.sides.a_bytes)) + self.b_closes
        shown, out, at = self.sides.shown[codes].tolist(), [], 0
        for n in (self.n_a + self.n_b).tolist():
            out.append("".join(shown[at : at + n])[:-1])
            at += n
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair, links): how many links of each document hold a pair of ids; a pair is a's id times the size of B plus b's id."""
        size = len(self.sides.a_bytes) * len(self.sides.b_bytes)
        key, times = np.unique(self.doc[self.i] * size + self.a[self.i] * len(self.sides.b_bytes) + self.b[self.j], return_counts=True)
        return key // size, key % size, times


def vocabularies(spark: SparkSession, a: str, b: str):
    """Both files as one broadcast variable: vocabularies, so of fixed size."""
    with open(a, encoding="utf-8") as x, open(b, "rb") as y:
        return spark.sparkContext.broadcast((x.read(), base64.b64encode(y.read())))


def _batches(b: pa.RecordBatch, sides: Tokenizers) -> Iterator[tuple[int, int, Batch]]:
    """The rows of an Arrow batch in batches of bounded text."""
    texts, begin, held = b.column(1).to_pylist(), 0, 0
    for k, t in enumerate(texts):
        if k > begin and held + len(t or "") > BATCH_CHARS:
            yield begin, k, Batch(sides, [x or "" for x in texts[begin:k]])
            begin, held = k, 0
        held += len(t or "")
    if begin < len(texts):
        yield begin, len(texts), Batch(sides, [x or "" for x in texts[begin:]])


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows, rows.schema["doc_id"].dataType.simpleString()


def aligned_tokens(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, a_ids, b_ids, groups, links): the ids of both sides, the groups as (n_a, n_b) numbers of tokens in order,
    and the links as (i, j) numbers of tokens within the document, in order.

    a is a byte-level BPE file, b a sentencepiece model that sets a space before the text; side A gets it, too. One row
    per input row, no shuffle. A text that is null or empty, or that a side's bytes do not give back, has empty arrays;
    whole texts of any length; null ids and repeated rows pass through; an empty table gives no rows; other columns are not read.
    """
    files = vocabularies(docs.sparkSession, a, b)
    rows, kind = _narrow(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = tokenizers(files.value[0], base64.b64decode(files.value[1]))
        for part in parts(batches, 128):
            for begin, end, x in _batches(part, sides):
                first_a, first_b = np.cumsum(x.n_a) - x.n_a, np.cumsum(x.n_b) - x.n_b
                order = np.lexsort((x.j, x.i))
                i, j = x.i[order], x.j[order]
                d = x.doc[i]
                sizes = [np.diff(np.concatenate([[0], np.flatnonzero(c) + 1])) for c in (x.a_closes, x.b_closes)]
                groups = pa.StructArray.from_arrays([pa.array(s, pa.int32()) for s in sizes], names=["n_a", "n_b"])
                links = pa.StructArray.from_arrays([pa.array(i - first_a[d], pa.int32()), pa.array(j - first_b[d], pa.int32())], names=["i", "j"])
                offsets = [pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()) for n in (x.n_groups, x.n_links)]
                columns = [part.column(0).slice(begin, end - begin), _lists(x.a, x.n_a, pa.int32()), _lists(x.b, x.n_b, pa.int32()), pa.ListArray.from_arrays(offsets[0], groups), pa.ListArray.from_arrays(offsets[1], links)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "a_ids", "b_ids", "groups", "links"])

    return rows.mapInArrow(run, f"doc_id {kind}, a_ids array<int>, b_ids array<int>, groups array<struct<n_a: int, n_b: int>>, links array<struct<i: int, j: int>>")


def alignment_digest(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text", few: int = FEW_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of aligned_tokens(), digested where they are made.

    A pair of ids counts how many links of all documents hold it. n_best are a document's links whose pair
    counts as much as the best pair of its B id, count_sum adds the counts of its links. A document's links are
    added up by pair before they are written; the counts of at most `few` pairs are broadcast, more are joined by shuffle,
    where AQE splits hot pairs. Rows as in aligned_tokens(); without tokens numbers are 0 and groups_sha256 is ''.
    """
    files = vocabularies(docs.sparkSession, a, b)
    rows, kind = _narrow(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = tokenizers(files.value[0], base64.b64decode(files.value[1]))
        for part in parts(batches, 128):
            for begin, end, x in _batches(part, sides):
                doc, pair, times = x.pairs()
                shas = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in x.groups_text()]
                packed = _lists(pair << 32 | times, np.bincount(doc, minlength=end - begin), pa.int64())  # fewer than 2^31 links to a text
                counts = [pa.array(c, pa.int64()) for c in (x.n_a, x.n_b, x.n_groups, x.n_links)]
                yield pa.RecordBatch.from_arrays([part.column(0).slice(begin, end - begin), *counts, pa.array(shas, pa.string()), packed], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "packed"])

    made = rows.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, packed array<bigint>")
    kept = written(made.withColumn("row", F.monotonically_increasing_id()), "aligned")
    each = kept.select("row", F.explode("packed").alias("x")).select("row", F.shiftright("x", 32).alias("pair"), F.col("x").bitwiseAND(0xFFFFFFFF).alias("times"))
    with open(b, "rb") as f:
        n_b = sentencepiece.SentencePieceProcessor(model_proto=f.read()).get_piece_size()
    counts = written(each.groupBy("pair").agg(F.sum("times").alias("n")), "pairs").withColumn("b", F.col("pair") % n_b)
    best = counts.groupBy("b").agg(F.max("n").alias("most"))
    known = written(counts.join(best, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")
    sums = each.join(broadcast_below(known, few), "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    whole = kept.drop("packed").join(sums, "row", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
