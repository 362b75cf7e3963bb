"""Toxicity by class-conditional Kneser-Ney models of expressions.

A word is an expression, spelt by interpolated n-grams of its letters, so that unseen forms of a
known stem count too. Each class has its own long orders; both back off to the same short order,
whose continuation counts (in how many kinds of word a sequence occurs) come from the whole corpus.
Rare expressions thus say nothing unless one class spells them more than the other. A text's
evidence is the sum of its words' differences of log-likelihoods, toxic less ordinary, over its
number of words; differences up to MARGIN are within what the small samples of the classes explain
and count as none, and so do words that are likelier in ordinary texts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import parts
from .labelled import sampled

#: Bytes per sequence of the shared order and of the classes' two.
SHARED, OWN = 4, (6, 9)
#: Weight of the lower order on top of what discounting frees, in counts; the least likelihood of a byte.
SHARED_PRIOR, OWN_PRIOR, FLOOR = 0.5, 80.0, 1 / 256
#: Difference of log-likelihoods that a word must exceed to count.
MARGIN = 2.0
#: Longer words count as overlapping pieces of this size.
MAX_BYTES = 32
SIGNS = "\"'`.,;:!?()[]{}<>*#$%&|/\\-_=+~^@"


def core(word: str) -> str:
    """Lower case, without the signs around it."""
    return word.lower().strip(SIGNS)


def pieces(word: str) -> list[str]:
    """The word itself; one over MAX_BYTES as what lies between its signs, and what is still longer as
    pieces of that many bytes, each half over the one before, so that every sequence and every
    character lies whole in one of them."""
    if len(word.encode()) <= MAX_BYTES:
        return [word]
    out, step = [], MAX_BYTES // 2
    for part in re.split(f"[{re.escape(SIGNS)}]+", word):
        data = part.encode()
        out += [part] if len(data) <= MAX_BYTES else [data[a : a + MAX_BYTES].decode(errors="ignore") for a in range(0, len(data) - step, step)]
    return out


#: Odd factors of the hash, and the first one's inverse: sums of bytes times its powers wrap at 2**64.
FACTOR, SPREAD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
INVERSE = pow(FACTOR, -1, 1 << 64)


def sequences(words: list[str], orders: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of each word's sequences and of their contexts, one row per order, and how many each word has.

    All words are hashed at once: the hash of any stretch of the joined bytes is the difference of
    two prefix sums, shifted to its beginning.
    """
    spelt = [b"^" + w.encode() + b"$" for w in words]
    sizes = np.fromiter(map(len, spelt), np.int64, len(spelt))
    data = np.frombuffer(b"".join(spelt), np.uint8).astype(np.uint64) + np.uint64(1)
    n = len(data)
    powers, inverses = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, f, np.uint64)))) for f in (FACTOR, INVERSE))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(data * inverses[:n])))
    starts = np.cumsum(sizes) - sizes
    first = np.repeat(starts, sizes)
    end = np.arange(1, n + 1)
    inner = end > first + 1  # all but each word's first byte
    end, first = end[inner], first[inner]
    grams, contexts = [], []
    for o in orders:
        a = np.maximum(first, end - o)
        for out, last, salt in ((grams, end, 2 * o), (contexts, end - 1, 2 * o + 1)):
            h = (sums[last] - sums[a]) * powers[a] + np.uint64(salt)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(SPREAD)
            out.append(h ^ (h >> np.uint64(32)))
    return np.stack(grams), np.stack(contexts), sizes - 1


def counted(grams: np.ndarray, contexts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct sequences with their contexts and the sums of n."""
    kinds, first, of = np.unique(grams, return_index=True, return_inverse=True)
    return kinds, contexts[first], np.bincount(of, n, len(kinds))


def discounts(counts: np.ndarray) -> np.ndarray:
    """What is taken off counts of 1, 2, and 3 or more, from how many counts of 1 to 4 there are."""
    n = np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6) + 0.5
    y = n[1] / (n[1] + 2 * n[2])
    return np.array([0.0, *(np.clip(k - (k + 1) * y * n[k + 1] / n[k], 0.3, k) for k in (1, 2, 3))])


class Lookup:
    """Places of hashes among distinct sorted ones: a table gives the first key of a hash's leading bits, the few after it are walked."""

    def __init__(self, keys: np.ndarray) -> None:
        self.n = len(keys)
        self.keys = np.append(keys, np.uint64(2**64 - 1))
        self.shift = np.uint64(64 - max(8, (2 * self.n).bit_length()))
        heads = np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift
        self.first = np.searchsorted(keys, heads).astype(np.int32)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """The place of each, or n."""
        at = self.first[h >> self.shift].astype(np.int64)
        behind = np.flatnonzero(self.keys[at] < h)
        while len(behind):
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < h[behind]]
        return np.where(self.keys[at] == h, at, self.n)

    def __getstate__(self) -> bytes:
        return self.keys[:-1].tobytes()

    def __setstate__(self, state: bytes) -> None:
        self.__init__(np.frombuffer(state, np.uint64))


class Order:
    """One order of the models of one or more classes: discounted counts by sequence, totals and freed
    mass by context. What is in none of the models leaves the lower order's likelihood as it is."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], prior: float) -> None:
        grams, contexts = (np.unique(np.concatenate([c[i] for c in counts])) for i in (0, 1))
        self.grams, self.contexts = Lookup(grams), Lookup(contexts)
        self.kept = np.zeros((len(grams) + 1, len(counts)), np.float32)
        self.total, self.freed = (np.full((len(contexts) + 1, len(counts)), prior, np.float32) for _ in (0, 1))
        for k, (g, c, n) in enumerate(counts):
            off, of = discounts(n)[np.minimum(n, 3).astype(np.int64)], np.searchsorted(contexts, c)
            self.kept[np.searchsorted(grams, g), k] = np.maximum(n - off, 0)
            self.total[:-1, k] += np.bincount(of, n, len(contexts))
            self.freed[:-1, k] += np.bincount(of, off, len(contexts))

    def __call__(self, grams: np.ndarray, contexts: np.ndarray, lower: np.ndarray) -> np.ndarray:
        c = self.contexts(contexts)
        return (self.kept[self.grams(grams)] + self.freed[c] * lower) / self.total[c]

    def __getstate__(self) -> list:
        """A broadcast variable is a file on each executor."""
        return [self.grams, self.contexts, *((x.shape, zlib.compress(x.tobytes(), 1)) for x in (self.kept, self.total, self.freed))]

    def __setstate__(self, state: list) -> None:
        self.grams, self.contexts = state[:2]
        self.kept, self.total, self.freed = (np.frombuffer(zlib.decompress(x), np.float32).reshape(shape) for shape, x in state[2:])


class Model:
    """The shared order, and the long ones that hold both classes, ordinary and toxic."""

    def __init__(self, shared: Order, own: list[Order]) -> None:
        self.shared, self.own = shared, own

    def likelihoods(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Likelihood of each byte after a word's first, by class, and how many each word has."""
        grams, contexts, sizes = sequences(words, (SHARED, *OWN))
        p = self.shared(grams[0], contexts[0], np.full((grams.shape[1], 1), FLOOR, np.float32))
        for i, order in enumerate(self.own, start=1):
            p = order(grams[i], contexts[i], p)
        return p, sizes

    def ratios(self, words: list[str]) -> np.ndarray:
        """Toxic minus ordinary log-likelihood of each word."""
        p, sizes = self.likelihoods(words)
        return np.add.reduceat(np.log(p[:, 1] / p[:, 0]), np.concatenate(([0], np.cumsum(sizes)[:-1])))


class Evidence:
    """Mean over a text's words, long ones counting as their pieces, of what the ratios exceed MARGIN by; words met are kept, up to a number."""

    def __init__(self, model: Model, size: int = 200_000) -> None:
        self.model, self.size, self.known = model, size, {}

    def learn(self, words: list[str]) -> None:
        for b in range(0, len(words), 20_000):
            some = words[b : b + 20_000]
            spelt = [pieces(core(w)) for w in some]
            kinds, over = list(set().union(*spelt)), {}
            for c in range(0, len(kinds), 20_000):
                few = kinds[c : c + 20_000]
                over.update(zip(few, np.maximum(self.model.ratios(few) - MARGIN, 0).tolist(), strict=True))
            self.known.update(zip(some, ((sum(map(over.__getitem__, s)), len(s)) for s in spelt), strict=True))

    def __call__(self, texts: list[str | None]) -> list[float]:
        out, a = [], 0
        while a < len(texts):
            held, chars = [], 0
            while a < len(texts) and chars < 1_000_000:
                held.append((texts[a] or "").split())
                chars += len(texts[a] or "")
                a += 1
            if len(self.known) > self.size:
                self.known.clear()
            self.learn(list(set().union(*held) - self.known.keys()))
            for words in held:
                found = list(map(self.known.__getitem__, words))
                out.append(sum(x for x, _ in found) / max(1, sum(n for _, n in found)))
        return out


def class_counts(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int) -> dict[tuple[int, int], tuple]:
    """(sequences, contexts, counts) by class and order, from at most per_class documents of each class,
    which bounds what is gathered. A word counts once a document; orders below the highest count kinds of words."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for b in parts(batches):
            for t, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                counts[k].update({p for w in t.split() for p in pieces(core(w))})
        for k, c in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(c), pa.int32()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["label", "word", "n"])

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, 20_000):
            label = b.column(0).to_numpy()
            for k in np.unique(label):
                mine = b.filter(pa.array(label == k))
                g, c, sizes = sequences(mine.column(1).to_pylist(), (SHARED, *OWN))
                n = np.repeat(mine.column(2).to_numpy().astype(np.float64), sizes)
                for i in range(len(g)):
                    found = counted(g[i], c[i], n if i == len(OWN) else np.ones(len(n)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found[0]), x, np.int32)) for x in (k, i)] + [pa.array(x.view(np.int64)) for x in found[:2]] + [pa.array(found[2])], names=["label", "rank", "gram", "context", "n"])

    sample = sampled(docs, labels, label, learn, per_class).select("text", F.col("label").cast("int"))
    seen = sample.mapInArrow(words, "label int, word string, n long").groupBy("label", "word").agg(F.sum("n").alias("n"))
    found = seen.mapInArrow(spelt, "label int, rank int, gram long, context long, n double").groupBy("label", "rank", "gram").agg(F.min("context").alias("context"), F.sum("n").alias("n")).toArrow()
    out = {}
    for k in (0, 1):
        for i in range(len(OWN) + 1):
            one = found.filter(pa.compute.and_(pa.compute.equal(found["label"], k), pa.compute.equal(found["rank"], i)))
            out[k, i] = (one["gram"].to_numpy().view(np.uint64), one["context"].to_numpy().view(np.uint64), one["n"].to_numpy())
    return out


def shared_counts(docs: DataFrame, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Continuation counts over the distinct words of all documents, of the sequences that follow the
    given contexts; no others enter a difference. Words are made distinct in each task, then by
    shuffle, and counts are summed by shuffle. What is gathered grows with the documents, up to 256
    sequences a context."""
    wanted = docs.sparkSession.sparkContext.broadcast(Lookup(contexts))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw: set[str] = set()
        for b in parts(batches):
            for t in b.column(0).to_pylist():
                raw.update((t or "").split())
            if len(raw) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(list({p for w in raw for p in pieces(core(w))}))], names=["word"])
                raw = set()
        yield pa.RecordBatch.from_arrays([pa.array(list({p for w in raw for p in pieces(core(w))}), pa.string())], names=["word"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, 20_000):
            g, c, _ = sequences(b.column(0).to_pylist(), (SHARED,))
            met = wanted.value(c[0]) < wanted.value.n
            found = counted(g[0][met], c[0][met], np.ones(int(met.sum())))
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in found[:2]] + [pa.array(found[2])], names=["gram", "context", "n"])

    words = docs.select(F.col("text").cast("string")).mapInArrow(distinct, "word string").distinct()
    found = words.mapInArrow(count, "gram long, context long, n double").groupBy("gram").agg(F.min("context").alias("context"), F.sum("n").alias("n")).toArrow()
    return found["gram"].to_numpy().view(np.uint64), found["context"].to_numpy().view(np.uint64), found["n"].to_numpy()


def fitted(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int) -> Model:
    counts = class_counts(docs, labels, label, learn, per_class)
    shared = shared_counts(docs, np.unique(np.concatenate([counts[k, 0][1] for k in (0, 1)])))
    return Model(Order([shared], SHARED_PRIOR), [Order([counts[k, i] for k in (0, 1)], OWN_PRIOR) for i in range(1, len(OWN) + 1)])


def cut(x: np.ndarray, y: np.ndarray, alarm: float = 4.0) -> tuple[float, float]:
    """The evidence at which the rates of the two kinds of error are least in sum, a false alarm
    weighing `alarm` times a miss, and the scale of the score around it."""
    levels = np.unique(x)
    wrong = [alarm * (x[y == 0] >= t).mean() + (x[y == 1] < t).mean() for t in levels]
    best = float(levels[int(np.argmin(wrong))])
    below = x[x < best]
    return (best + float(below.max()) if len(below) else 2 * best) / 2, max(float(x.std()), 1e-6)


def toxicity_scores(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", per_class: int = 1500) -> DataFrame:
    """(doc_id, score): one row per document, from 0 to 1, higher where label 1 is likelier.

    Shared backoff counts come from all documents; class counts from at most per_class labelled
    documents of each class, and the threshold from as many others. Null and empty texts have no
    evidence and score below 0.5; without labels of both classes every score is 0; texts of any
    length are read whole; equal texts, and so repeated rows, get equal scores; null ids pass
    through; an empty table gives no rows; columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    part = F.crc32(F.concat(F.lit("fit"), F.col("doc_id").cast("string")).cast("binary")) % 5
    model = spark.sparkContext.broadcast(fitted(narrow, labels, label, learn & (part != 0), per_class))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Evidence(model.value)
        for b in parts(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(of(b.column(1).to_pylist()), pa.float64())], names=[b.schema.names[0], "x"])

    held = sampled(narrow, labels, label, learn & (part == 0), per_class).select(F.col("label").cast("int"), "text")
    seen = held.mapInArrow(measured, "label int, x double").toArrow()
    x, y = seen["x"].to_numpy(), seen["label"].to_numpy()
    middle, scale = cut(x, y) if 0 < y.sum() < len(y) else (float("inf"), 1.0)
    scored = narrow.mapInArrow(measured, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, x double")
    return scored.select("doc_id", (1 / (1 + F.exp((F.lit(middle) - F.col("x")) / F.lit(scale)))).alias("score"))
