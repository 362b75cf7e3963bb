"""Periodic runs of words, by the branching-tandem test over an enhanced suffix array.

Suffixes of a batch of documents are sorted by prefix doubling; words of different documents never
compare equal. Of each LCP interval of depth d, the suffixes i of all its children but the largest
ask whether i + d or i - d lies in the interval, too: if so, and if the next words differ, a square
of period d ends there and cannot be rotated to the right. Rotating it to the left as far as its
words agree gives the whole run. Intervals are pairs of bounds in arrays; there are no tree nodes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import parts

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a batch; a longer document is a batch of its own.
BATCH_WORDS = 100_000
_words = re.compile(WORD).findall
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def suffix_array(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, place of each suffix in it); a suffix comes after those it continues."""
    n = len(t)
    sa = np.argsort(t, kind="stable")
    place, rank = np.arange(n), np.empty(n, np.int64)
    idx, key, h = sa, t[sa], 0
    while len(place):
        if h:
            idx = sa[place]
            ahead = idx + h
            key = rank[idx] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
            order = np.argsort(key)
            idx, key = idx[order], key[order]
            sa[place] = idx
        new = np.empty(len(place), bool)
        new[0] = True
        np.not_equal(key[1:], key[:-1], out=new[1:])
        starts = np.flatnonzero(new)
        sizes = np.diff(starts, append=len(place))
        rank[idx] = np.repeat(place[starts], sizes)
        place = place[np.repeat(sizes > 1, sizes)]
        h = 2 * h or 1
    return sa, rank


def _agree(t: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words from i and j on agree, to the right (step 1) or to the left (-1)."""
    found, width = 0, 16
    while True:
        if step == 1:
            width = min(width, len(t) - max(i, j) - found)
            a, b = t[i + found : i + found + width], t[j + found : j + found + width]
        else:
            width = min(width, min(i, j) + 1 - found)
            a, b = t[i - found - width + 1 : i - found + 1][::-1], t[j - found - width + 1 : j - found + 1][::-1]
        if not width:
            return found
        differ = a != b
        first = int(differ.argmax())
        if differ[first]:
            return found + first
        found, width = found + width, 4 * width


def common_prefixes(t: np.ndarray, sa: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Words that each suffix of the order shares with the one before it.

    Words are compared only for suffixes whose word before differs from that of their neighbour: the
    lengths of these add up to n log n at most. Each other suffix shares one word less than the suffix before it in the text.
    """
    n = len(t)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    at = np.arange(n)
    same = (at > 0) & (before > 0) & (t[at - 1] == t[np.maximum(before, 1) - 1])
    i = np.flatnonzero(~same & (before >= 0))
    j, shared = before[i], np.zeros(len(i), np.int64)
    padded, on = np.append(t, -1), np.arange(len(i))
    for step in range(24):
        on = on[padded[i[on] + step] == padded[j[on] + step]]
        if not len(on):
            break
        shared[on] = step + 1
    for k in on:  # long ones, in blocks
        shared[k] += _agree(t, int(i[k] + shared[k]), int(j[k] + shared[k]), 1)
    bound = np.zeros(n, np.int64)
    bound[i] = shared + i
    return (np.maximum(np.maximum.accumulate(bound) - at, 0))[sa]


def _smaller(lcp: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the last one before it and the first one after it with a smaller LCP; the LCP at 0 is 0."""
    n = len(lcp)
    left, right, stack = [0] * n, [n] * n, [0]
    for k in range(1, n):
        v = lcp[k]
        while lcp[top := stack[-1]] > v:
            right[stack.pop()] = k
        left[k] = left[top] if lcp[top] == v else top
        stack.append(k)
    return np.array(left), np.array(right)


def squares(t: np.ndarray, sa: np.ndarray, rank: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end, period) of the squares that cannot be rotated to the right, by end, then period."""
    n = len(t)
    left, right = _smaller(lcp.tolist())
    cut = np.flatnonzero(lcp > 0)
    cut = cut[np.lexsort((cut, left[cut], lcp[cut]))]
    new = np.ones(len(cut), bool)
    new[1:] = (left[cut][1:] != left[cut][:-1]) | (right[cut][1:] != right[cut][:-1]) | (lcp[cut][1:] != lcp[cut][:-1])
    # the children of an interval begin at its left bound and at each of its cuts
    heads = np.flatnonzero(new)
    owner = np.cumsum(new) - 1
    low, high, depth = left[cut[heads]], right[cut[heads]], lcp[cut[heads]]
    begins = np.insert(cut, heads, low)
    owner = np.insert(owner, heads, np.arange(len(heads)))
    ends = np.append(begins[1:], 0)
    last = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))
    ends[last] = high[owner[last]]
    sizes = ends - begins
    firsts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    by_size = np.lexsort((-sizes, owner))
    small = np.ones(len(begins), bool)
    small[by_size[firsts]] = False  # the largest child of each interval
    begins, sizes, owner = begins[small], sizes[small], owner[small]
    total = np.cumsum(sizes)
    if not len(total) or not total[-1]:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.arange(total[-1]) + np.repeat(begins - (total - sizes), sizes)
    of = np.repeat(owner, sizes)
    i, d = sa[at], depth[of]
    padded, found = np.append(t, -1), []
    for start in (i, i - d):
        ahead = start + d
        fits = (start >= 0) & (ahead < n)
        s, e, dd, k = start[fits], ahead[fits], d[fits], of[fits]
        other = rank[np.where(start is i, e, s)]
        inside = (other >= low[k]) & (other < high[k])
        s, e, dd = s[inside], e[inside], dd[inside]
        ends_here = padded[e] != padded[e + dd]
        found.append(np.stack([e[ends_here] + dd[ends_here], dd[ends_here]]))
    end, period = np.unique(np.concatenate(found, axis=1), axis=1)
    return end, period


def runs_of(t: np.ndarray, sa: np.ndarray, rank: np.ndarray, lcp: np.ndarray, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least so many words and two periods, by start, then period."""
    runs, here, at = [], [], -1
    for end, period in zip(*(x.tolist() for x in squares(t, sa, rank, lcp)), strict=True):
        if end != at:
            here, at = [], end
        start = end - 2 * period
        if any(s <= start and period % q == 0 for s, q in here):
            continue  # a power of a shorter period: the same run
        if start:
            start -= _agree(t, start - 1, start + period - 1, -1)
        here.append((start, period))
        if end - start >= max(least, 2 * period):
            runs.append((start, end - start, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of_batch(docs: list[np.ndarray], least: int = 12) -> list[list[tuple[int, int, int]]]:
    """The runs of each document, given as numbers of its words."""
    sizes = np.array([len(d) for d in docs])
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    if not sizes.sum():
        return out
    words = np.concatenate(docs).astype(np.int64)
    t = np.repeat(np.arange(len(docs)), sizes) * (int(words.max()) + 1) + words
    sa, rank = suffix_array(t)
    lcp = common_prefixes(t, sa, rank)
    base = np.cumsum(sizes) - sizes
    some = np.flatnonzero(sizes > 0)
    longest = np.maximum.reduceat(lcp, base[some])
    # in a run of L >= least words with period q <= L / 2, two suffixes share L - q >= least / 2 words
    for k in some[longest >= (least + 1) // 2].tolist():
        a, z = int(base[k]), int(base[k] + sizes[k])
        shared = lcp[a:z].copy()
        shared[0] = 0
        out[k] = runs_of(t[a:z], sa[a:z] - a, rank[a:z] - a, shared, least)
    return out


def _collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    if not runs:
        return " ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return " ".join([w for w, k in zip(words, kept.tolist(), strict=True) if k])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str | Column = "text", least: int = 12) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): of each text, its periodic runs and the text without their repeats.

    A run is a longest stretch of words whose smallest period q fits in it twice and which has at
    least `least` words; runs is an array of (start, length, period) by start, then period. collapsed
    holds the words, joined by one space, that no run contains after its first q words. One row per
    input row, no shuffle; whole texts of any length, one document at most being larger than a batch.
    A null or empty text has no words, no runs and an empty string; null ids and repeated rows pass
    through; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, 128):
            texts, found, kept, sizes = b.column(1).to_pylist(), [], [], []
            numbers: dict[str, int] = {}
            held, waiting = 0, []

            def flush() -> None:
                runs = runs_of_batch([np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in waiting], least)
                found.extend(runs)
                kept.extend(map(_collapsed, waiting, runs))
                waiting.clear()
                numbers.clear()

            for t in texts:
                words = _words(t or "")
                if held and held + len(words) > BATCH_WORDS:
                    flush()
                    held = 0
                for w in words:
                    numbers.setdefault(w, len(numbers))
                waiting.append(words)
                sizes.append(len(words))
                held += len(words)
            flush()
            listed = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(listed, _RUNS), pa.array(kept, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), (F.col(text) if isinstance(text, str) else text).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def tail_repeated(doc_id: Column, text: Column) -> Column:
    """The text, of one in ten ids with a tail that repeats: with h the crc32 of the decimal id, g = h div 10, n words,
    a = g mod n and p = 1 + (n - a) div (3 + g mod 8), each word i >= a becomes word a + (i - a) mod p. Others stay as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))

    def mixed(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.concat(F.slice(w, F.lit(1), a), F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + (i - a) % p)))

    # the words are bound once, as the only element of an array
    joined = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.array_join(mixed(w), " ")).otherwise(F.lit("")))[0]
    return F.when(h % 10 == 0, joined).otherwise(text)


def run_digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of periodic_runs():
    the longest run (of several, that of the smallest start, then period), and digests of all runs and of the kept words."""
    first = F.get(F.array_sort("runs", lambda x, y: F.when(x["length"] > y["length"], -1).when(x["length"] < y["length"], 1).otherwise(0)), F.lit(0))  # a stable sort
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    top = found.withColumn("top", first)
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), F.col("top.length").alias("length"), F.col("top.period").alias("period"),
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
