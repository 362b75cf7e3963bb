"""Quality by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .batches import parts
from .labelled import sampled

#: Slots of hashed terms: those of word shapes, then those of words.
SHAPES, WORDS = 2048, 4096
SLOTS = SHAPES + WORDS


def shape(word: str) -> str:
    """The word with runs of letters, digits and signs cut short: 'Then,' is 'Aa,', 'ab%%%' is 'a%%%'."""
    if word.isalpha():
        return "a" if word.islower() else "A" if word.isupper() and len(word) > 1 else "Aa"
    out, last = [], ""
    for c in word:
        k = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c
        if k != last or not k.isalnum():
            out.append(k)
        last = k
    return "".join(out)


class Terms:
    """Hashed terms of a text; what a word gives is kept for the words met most."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int]] = {}

    def slots(self, word: str) -> tuple[int, int]:
        found = self.known.get(word)
        if found is None:
            low = word.lower()
            found = (crc32(shape(word).encode()) % (SHAPES - 128), SHAPES + crc32(low.encode()) % WORDS)
            if len(self.known) < 100_000 and len(word) < 64:
                self.known[word] = found
        return found

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Slots and counts. The last 128 of the shapes hold how varied words and lines are and how long the text is."""
        words = text.split()
        counts: Counter = Counter()
        slots = self.slots
        n = len(words)
        distinct = Counter(words)
        for w, c in distinct.items():
            a, b = slots(w)
            counts[a] += c
            counts[b] += c
        lines = text.split("\n")
        base = SHAPES - 128
        if n:
            counts[base + min(19, int(20 * len(distinct) / n))] += n
            counts[base + 20 + min(19, int(20 * len(set(lines)) / len(lines)))] += n
            counts[base + 40 + min(15, int(math.log2(n)))] += 1 + n // 8
            counts[base + 60 + min(19, int(sum(map(len, words)) / n))] += 1 + n // 8
        else:
            counts[base + 100] += 1
        return np.fromiter(counts.keys(), np.int32, len(counts)), np.fromiter(counts.values(), np.float32, len(counts))


def weighted(slots: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(counts)) * idf[slots]
    return v / (float(np.linalg.norm(v)) or 1.0)


def term_frequencies(docs: DataFrame) -> np.ndarray:
    """In how many of all documents each slot occurs: one count per slot and task is shuffled, SLOTS numbers are gathered."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, df, n = Terms(), np.zeros(SLOTS + 1, dtype=np.int64), 0
        for b in parts(batches):
            for t in b.column(0).to_pylist():
                df[terms(t or "")[0]] += 1
                n += 1
        df[SLOTS] = n
        full = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(df[full])], names=["slot", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n")).collect()
    out = np.zeros(SLOTS + 1, dtype=np.int64)
    for slot, n in rows:
        out[slot] = n
    return out


def latent_vectors(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, dims: int) -> tuple:
    """idf, projection, labelled vectors and their labels, learnt from at most 2 * per_class documents."""
    df = term_frequencies(docs)
    idf = np.log((df[SLOTS] + 1) / (df[:SLOTS] + 1)).astype(np.float32) + 0.05

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for b in parts(batches):
            pairs = [terms(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.list_(pa.int32())), pa.array([p[1] for p in pairs], pa.list_(pa.float32())), b.column(1)], names=["slots", "counts", "label"])

    sample = sampled(docs, labels, label, learn, per_class).select("text", F.col("label").cast("int"))
    rows = sample.mapInArrow(features, "slots array<int>, counts array<float>, label int").collect()
    x = np.zeros((len(rows), SLOTS), dtype=np.float32)
    for i, r in enumerate(rows):
        s = np.array(r.slots, dtype=np.int32)
        x[i, s] = weighted(s, np.array(r.counts, dtype=np.float32), idf)
    if not len(rows):
        return idf, np.zeros((SLOTS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32)
    values, vectors = np.linalg.eigh(x @ x.T)
    keep = np.argsort(values)[::-1][: min(dims, len(rows))]
    keep = keep[values[keep] > 1e-6]
    project = (x.T @ (vectors[:, keep] / np.sqrt(values[keep]))).astype(np.float32)
    z = x @ project
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
    return idf, project, z.astype(np.float32), np.array([r.label for r in rows], dtype=np.float32)


def with_quality(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", per_class: int = 1200, dims: int = 48, neighbours: int = 15, score: str = "score") -> DataFrame:
    """docs with a score from 0 to 1, higher where label 1 is likelier. Rows are not shuffled.

    Document frequencies come from all documents; the latent space and the voters from at most
    per_class labelled documents of each class, the bound that makes them fit for a broadcast.
    Each document is compared with all voters, in blocks, and the nearest ones vote with their
    similarity to the fourth power; of neighbours at equal similarity any may vote, the same for equal
    texts. Null and empty texts get the score that other texts without words would; texts of any
    length are read whole; without any labels every score is 0.5; repeated rows and null ids pass
    through; an empty table gives no rows. Reads doc_id and text; a column with the name of the
    score is replaced.
    """
    docs = docs.drop(score)
    model = docs.sparkSession.sparkContext.broadcast(latent_vectors(docs, labels, label, learn, per_class, dims))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, project, voters, votes = model.value
        terms, k = Terms(), min(neighbours, len(voters))
        for b in parts(batches, 512):
            texts, scores = b.column(at).to_pylist(), np.full(b.num_rows, 0.5)
            if k:
                z = np.zeros((len(texts), project.shape[1]), dtype=np.float32)
                for i, t in enumerate(texts):
                    s, c = terms(t or "")
                    z[i] = weighted(s, c, idf) @ project[s]
                z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
                near = z @ voters.T
                top = np.argpartition(near, -k, axis=1)[:, -k:]
                w = np.maximum(np.take_along_axis(near, top, axis=1), 1e-3) ** 4
                scores = (w * votes[top]).sum(axis=1) / w.sum(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.clip(scores, 0, 1).astype(np.float64))], names=[*b.schema.names, score])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(score, DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column, **options) -> DataFrame:
    """(doc_id, score): with_quality() without the documents' other columns."""
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return with_quality(narrow, labels, learn, **options).select("doc_id", "score")
