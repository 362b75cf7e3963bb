"""Byte-pair encoding and decoding with a public vocabulary.

A pre-token is a doubly linked list of symbols; a heap holds the ranks of its adjacent pairs, and
entries whose pair has gone since are skipped. Pre-tokens repeat, so each Python worker keeps the
ids of those it met in a cache of bounded size.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import parts

#: Fixed value: how byte-level files that name no pattern split a text.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: Lower case of letters that Python's tables don't have yet; ranges of the same size.
NEWER_LOWER = ((0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB))
#: Ranges of letters and numbers of Unicode 16, which the library's own-split tables have and Python's may not.
UNICODE_16 = "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D40-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B-1138B 1138E-1138E 11390-113B5 113B7-113B7 113D1-113D1 113D3-113D3 116D0-116E3 11BC0-11BE0 11BF0-11BF9 13460-143FA 16100-1611D 16130-16139 16D40-16D6C 16D70-16D79 18CFF-18CFF 1CCF0-1CCF9 1E5D0-1E5ED 1E5F0-1E5FA"
_lower = {a + k: to + k for a, z, to in NEWER_LOWER for k in range(z - a + 1)}
_to_lower = re.compile("[" + "".join(map(chr, _lower)) + "]")
_beyond = re.compile("[\u0530-\U0010ffff]")
_newer: list = []


def newer_letters() -> re.Pattern:
    """Letters and numbers of the regex engine's tables that are newer than Unicode 16, hence signs for a file's own split."""
    if not _newer:
        known = {c for r in UNICODE_16.split() for c in range(int(r.split("-")[0], 16), int(r.split("-")[1], 16) + 1)}
        unknown = "".join(map(chr, (c for c in range(0x530, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn" and c not in known)))
        found = [ord(c) for c in regex.findall(r"[\p{L}\p{N}]", unknown)]
        starts = [c for k, c in enumerate(found) if not k or found[k - 1] != c - 1]
        ends = [c for k, c in enumerate(found) if k + 1 == len(found) or found[k + 1] != c + 1]
        ranges = "".join(f"{chr(a)}-{chr(z)}" for a, z in zip(starts, ends, strict=True))
        _newer.append(re.compile(f"[{ranges}]" if ranges else "(?!)"))
    return _newer[0]


def ascii_pattern(pattern: str) -> re.Pattern:
    """The same split for texts in ASCII, by the plainer engine."""
    pattern = pattern.replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}")
    for inside, of in ((r"[^\s\p{L}\p{N}]", r"[^\t-\r A-Za-z0-9]"), (r"\p{L}", "[A-Za-z]"), (r"\p{N}", "[0-9]"), (r"\s", r"[\t-\r ]"), (r"\S", r"[^\t-\r ]")):
        pattern = pattern.replace(inside, of)
    return re.compile(pattern)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Cache(dict):
    """What make(key) gives, in two generations: keys not asked for while the young one filled are forgotten."""

    def __init__(self, make, size: int) -> None:
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
            if len(key) > 64:
                return found
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class Bpe:
    """Encoder for a tokenizer file: its normal form and case, its split, its merges. Ids are bytes, four little-endian ones each."""

    def __init__(self, spec: dict, cache: int = 120_000) -> None:
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.tokens = {i: t for t, i in {**self.vocab, **self.special}.items()}
        # symbols are numbers; a pair of them, as one number, gives its rank and what it becomes
        self.numbers = {t: i for i, t in enumerate(self.vocab)}
        self.ids = list(self.vocab.values())
        self.merges: dict[int, int] = {}
        self.made: list[int] = []  # by rank
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.number(a) << 20 | self.number(b)] = rank << 32
            self.made.append(self.number(a + b))
        normal = json.dumps(spec.get("normalizer"))
        self.nfc, self.lower = '"NFC"' in normal, "Lowercase" in normal
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        own = next((s["pattern"]["Regex"] for s in steps if s["type"] == "Split"), None)
        self.split, self.ascii_split = regex.compile(own or BYTE_LEVEL_SPLIT), ascii_pattern(own or BYTE_LEVEL_SPLIT)
        self.newer = newer_letters() if own else None
        self.byte_decoder = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        self.letters = byte_letters()
        self.bytes_of = {c: b for b, c in enumerate(self.letters)}
        self.first = [self.number(c) for c in self.letters]
        self.last = [self.number(c + self.suffix) for c in self.letters]
        self.id_bytes = [i.to_bytes(4, "little") if i >= 0 else b"" for i in self.ids]
        self.cache = Cache(self.piece, cache)
        self.counts = Cache(lambda piece: 1 if piece in self.special else len(self.piece(piece)) // 4, 2 * cache)

    def number(self, symbol: str) -> int:
        """A symbol that is not in the vocabulary gets a number of its own, and no id."""
        found = self.numbers.get(symbol)
        if found is None:
            found = self.numbers[symbol] = len(self.ids)
            self.ids.append(-1)
        return found

    def normalise(self, text: str) -> str:
        """White space stays as it is: the split leaves it out."""
        if self.nfc and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if not self.lower:
            return text
        # letter by letter: no special form of sigma at the end of a word
        low = text.replace("\u03a3", "\u03c3").lower()
        return low if low.isascii() or not _beyond.search(low) or not _to_lower.search(low) else low.translate(_lower)

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text in normal form."""
        if text.isascii():
            return self.ascii_split.findall(text)
        if self.newer is None or not _beyond.search(text) or not self.newer.search(text):
            return self.split.findall(text)
        shown = self.newer.sub("\ufffd", text)  # a sign, as the library sees them
        return [text[m.start() : m.end()] for m in self.split.finditer(shown)]

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge adjacent pairs, lowest rank first and leftmost among equals."""
        n = len(symbols)
        get, made_of, push, pop = self.merges.get, self.made, heapq.heappush, heapq.heappop
        live, heap = [-1] * n, []  # of each place, the entry of the pair that begins there
        for i in range(n - 1):
            m = get(symbols[i] << 20 | symbols[i + 1])
            if m is not None:
                live[i] = m | i
                heap.append(m | i)
        if not heap:
            return symbols
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapq.heapify(heap)
        while heap:
            entry = pop(heap)
            i = entry & 0xFFFFFFFF
            if live[i] != entry:
                continue  # stale: the pair that began here has gone
            j = after[i]
            symbols[i] = made = made_of[entry >> 32]
            symbols[j] = live[j] = live[i] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                m = get(made << 20 | symbols[k])
                if m is not None:
                    live[i] = m | i
                    push(heap, m | i)
            h = before[i]
            if h >= 0:
                live[h] = -1
                m = get(symbols[h] << 20 | made)
                if m is not None:
                    live[h] = m | h
                    push(heap, m | h)
        return [s for s in symbols if s >= 0]

    def piece(self, piece: str) -> bytes:
        raw = piece.encode()
        symbols = list(map(self.first.__getitem__, raw))
        symbols[-1] = self.last[raw[-1]]
        return b"".join(map(self.id_bytes.__getitem__, self.merge(symbols) if len(raw) > 1 else symbols))

    def encode(self, text: str) -> bytes:
        if not any(map(text.__contains__, self.special)):
            return b"".join(map(self.cache.__getitem__, self.pieces(self.normalise(text))))
        parts = self.cut.split(text)
        return b"".join(self.special[p].to_bytes(4, "little") if p in self.special else b"".join(map(self.cache.__getitem__, self.pieces(self.normalise(p)))) for p in parts)

    def decode(self, ids: bytes) -> str:
        """The vocabulary's strings one after the other: as bytes where the file has such a decoder, else with spaces."""
        parts = list(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        if not self.byte_decoder:
            return " ".join(parts)
        raw = b"".join(p.encode() if p in self.special else bytes(map(self.bytes_of.__getitem__, p)) for p in parts)
        return raw.decode("utf-8", "replace")


_encoders: dict[str, Bpe] = {}


def encoder(spec_text: str) -> Bpe:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    key = hashlib.sha256(spec_text.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = Bpe(json.loads(spec_text))
    return _encoders[key]


def vocabulary(spark: SparkSession, path: str):
    """The tokenizer file's text as a broadcast variable: a vocabulary, so of fixed size."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): the token ids of each text and the text that they decode to.

    One row per input row, no shuffle. A null text counts as empty and gives no ids and an empty
    string; special tokens in a text become their ids; a pre-token of any length is merged whole;
    null ids and repeated rows pass through; an empty table gives no rows; other columns are not read.
    """
    spec = vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(spec.value)
        for b in parts(batches, 128):  # ids need several times the text's memory
            ids = [bpe.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.frombuffer(i, "<i4") for i in ids], pa.list_(pa.int32())), pa.array([bpe.decode(i) for i in ids], pa.string())], names=["doc_id", "ids", "decoded"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def encoding_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded()'s rows, digested where they are
    made: ids as little-endian unsigned 32-bit integers, texts in UTF-8."""
    spec = vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(spec.value)
        for b in parts(batches):
            counts, ids_sha, text_sha = [], [], []
            for t in b.column(1).to_pylist():
                ids = bpe.encode(t or "")
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
