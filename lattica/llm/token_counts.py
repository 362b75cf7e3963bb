"""Token counts that follow edits.

A document's pre-tokens stand in leaves under a segment tree of character and token sums. An edit
re-splits the text from the first pre-token that can feel it to the first old boundary that the
new split meets again; only those leaves and the sums above them change.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import parts
from .bpe import Bpe, encoder, vocabulary

LEAF = 256
#: Characters past its end that a match may look at: white space leaves its last one to a word, "'re" is one
#: pre-token. Special tokens, which cut a text before it is split, may reach further: the longest's length counts then.
AHEAD = 2


class TokenTree:
    """Pre-tokens and special tokens of one text. The split must cover the text and look at most AHEAD characters past a match."""

    def __init__(self, text: str, bpe: Bpe) -> None:
        self.bpe, self.encoded = bpe, 0
        self.ahead = max([AHEAD, *map(len, bpe.special)])
        self.build(self.resplit(text))

    def resplit(self, text: str) -> list[str]:
        self.encoded += len(text)
        if not any(map(text.__contains__, self.bpe.special)):
            return self.bpe.pieces(text)
        return [p for part in self.bpe.cut.split(text) for p in ((part,) if part in self.bpe.special else self.bpe.pieces(part))]

    def sums(self, pieces: list[str]) -> tuple[int, int]:
        return sum(map(len, pieces)), sum(map(self.bpe.counts.__getitem__, pieces))

    def build(self, pieces: list[str]) -> None:
        self.leaves = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.tree = [(0, 0)] * self.width + [self.sums(x) for x in self.leaves] + [(0, 0)] * (self.width - len(self.leaves))
        for i in range(self.width - 1, 0, -1):
            self.add(i)

    def add(self, i: int) -> None:
        a, b = self.tree[2 * i], self.tree[2 * i + 1]
        self.tree[i] = (a[0] + b[0], a[1] + b[1])

    @property
    def n_chars(self) -> int:
        return self.tree[1][0]

    @property
    def n_tokens(self) -> int:
        return self.tree[1][1]

    def text(self) -> str:
        return "".join(p for leaf in self.leaves for p in leaf)

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The first leaf that ends at the position or later, and where it starts."""
        i, start = 1, 0
        while i < self.width:
            i *= 2
            if start + self.tree[i][0] < position:
                start += self.tree[i][0]
                i += 1
        return i - self.width, start

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters from start to end; offsets beyond the text are brought within it."""
        start = min(max(start, 0), self.n_chars)
        end = min(max(end, start), self.n_chars)
        leaf, at = self.leaf_at(start - self.ahead + 1)
        index = 0
        for piece in self.leaves[leaf]:
            if at + len(piece) > start - self.ahead:
                break
            at += len(piece)
            index += 1
        first_leaf, first_index, first_at = leaf, index, at
        old: list[str] = []
        ends: dict[int, tuple[int, int]] = {}
        wanted = 8
        while True:
            while at < end or wanted:
                while leaf < len(self.leaves) and index == len(self.leaves[leaf]):
                    leaf, index = leaf + 1, 0
                if leaf == len(self.leaves):
                    break
                piece = self.leaves[leaf][index]
                index += 1
                old.append(piece)
                at += len(piece)
                if at >= end:
                    ends[at - first_at + len(new) - (end - start)] = (leaf, index)
                    wanted -= 1
            whole = leaf == len(self.leaves)
            joined = "".join(old)
            region = joined[: start - first_at] + new + joined[end - first_at :]
            pieces, b = self.resplit(region), 0
            least, met = start - first_at + len(new), None
            for n, piece in enumerate(pieces, start=1):
                b += len(piece)
                if b >= least and b + self.ahead <= len(region) and b in ends:
                    met = (n, ends[b])
                    break
            if met or whole:
                break
            wanted = len(old)
        n, (last_leaf, last_index) = met or (len(pieces), (len(self.leaves) - 1, len(self.leaves[-1])))
        kept = self.leaves[first_leaf][:first_index] + pieces[:n]
        if last_leaf < first_leaf:
            last_leaf, last_index = first_leaf, len(self.leaves[first_leaf])
        rest = self.leaves[last_leaf][last_index:]
        for i in range(first_leaf, last_leaf + 1):
            self.leaves[i] = kept + rest if i == first_leaf else []
        if len(self.leaves[first_leaf]) > 8 * LEAF:
            self.build([p for x in self.leaves for p in x])
            return
        changed = {first_leaf, *range(first_leaf + 1, last_leaf + 1)}
        for i in changed:
            self.tree[self.width + i] = self.sums(self.leaves[i])
        nodes = {(self.width + i) // 2 for i in changed}
        while nodes and max(nodes) > 0:
            for i in nodes:
                self.add(i)
            nodes = {i // 2 for i in nodes} - {0}


def edited_counts(docs: DataFrame, path: str, edits: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, edited_tokens, edited_chars, encoded_chars): one row per input row, no shuffle.

    edits: a column array<struct<start:int,end:int,new:string>>, applied in order, offsets in code points of the text
    as it is then. Special tokens, in the text or made by an edit, count as one. encoded_chars counts the characters that edits
    had re-encoded. A null text counts as empty, null edits as none, a null start as 0, a null end as start, a null new as
    empty; texts of any length are held whole; null ids and repeated rows pass through; an empty table gives no rows;
    other columns are not read.
    """
    spec = vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(spec.value)
        for b in parts(batches):
            out: tuple[list, ...] = ([], [], [], [])
            for text, changes in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                tree = TokenTree(text or "", bpe)
                before, tree.encoded = tree.n_tokens, 0
                for e in changes or ():
                    start = e["start"] or 0
                    tree.edit(start, start if e["end"] is None else e["end"], e["new"] or "")
                for values, v in zip(out, (before, tree.n_tokens, tree.n_chars, tree.encoded), strict=True):
                    values.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, pa.int64()) for v in out)], names=["doc_id", "n_tokens", "edited_tokens", "edited_chars", "encoded_chars"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), edits.alias("edits"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, n_tokens long, edited_tokens long, edited_chars long, encoded_chars long")


def collected_edits(edits: DataFrame, id_col: str = "doc_id", order: str = "seq") -> DataFrame:
    """Edits given as rows (id, seq, start, end, new), one array per document in the order of seq."""
    one = F.struct(order, F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), F.col("new").cast("string").alias("new"))
    held = edits.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.sort_array(F.collect_list(one)).alias("e"))
    return held.select(id_col, F.transform("e", lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["new"].alias("new"))).alias("edits"))


def three_edits(text: Column) -> Column:
    """A deletion in the middle, a copy of the beginning put in at a third, and a new end."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    n = F.length(text)

    def one(start: Column, end: Column, new: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), new.alias("new"))

    return F.array(one(F.floor(n / 2), F.floor(n / 2) + 25, F.lit("")), one(F.floor(n / 3), F.floor(n / 3), F.left(text, F.lit(40))), one(n - 20, n + 40, F.lit(" The end, it's 2 late.  \n")))
