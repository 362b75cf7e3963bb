"""Personal data: base patterns, high-recall generators, boosted trees. DataFrame functions only.

The trees learn from the base spans of the documents themselves, as they are and disguised, against
spoilt ones and against what the generators propose elsewhere; so they select data that is written
otherwise than the patterns expect.

Each pattern is written so that a match never backtracks over a long run (possessive runs, a start
only where the run starts), with the same matches as its plain form.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import written

KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?=[0-9](?:[\x20-]?[0-9]){11})[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: High recall: spelt-out addresses, numbers with brackets, colons or any separators between their groups, telephone
#: numbers without a plus in two forms, with blanks and without. Several may propose the same or overlapping spans.
WIDE = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?[\[(]at[\])]\x20?|\x20at\x20)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(](?:dot|\.)[\])]\x20?|\x20dot\x20)[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9.])[0-9]++(?:(?:[.:]|\x20?[\[(](?:dot|\.)[\])]\x20?)[0-9]++){3,}+"),
    ("card", r"(?<![0-9])[0-9]++(?:[\x20./_-]{1,2}+[0-9]++)*+"),
    ("phone", r"(?<![0-9+])[+(]?[0-9]++(?:[\x20().-]{1,3}+[0-9]++)++"),
    ("phone", r"(?<![0-9+(.-])[+(]?[0-9]++(?:[().-]{1,2}+[0-9]++)++"),
)
#: Digits of what is proposed.
DIGITS = {"email": (0, 1 << 30), "ip": (4, 1 << 30), "card": (12, 19), "phone": (7, 15)}
#: A cheap test that holds wherever the patterns of a kind can match.
HINT = {"email": r"@|[\[(]at[\])]|\x20at\x20", "ip": r"[0-9](?:[.:]|\x20?[\[(])", "card": r"[0-9][\x20./_-]{0,2}[0-9]", "phone": r"\+[0-9]|[0-9][\x20().-]"}
CONTEXT = (r"(?i)\b(?:tel|phone|call|fax|mobile|ring)\b", r"(?i)\b(?:e-?mail|contact|write)\b", r"(?i)\b(?:card|visa|account|pay|payment|credit)\b", r"(?i)\b(?:ip|host|server|address)\b", r"(?i)\b(?:token|key|secret|id|no|version|order)\b")
#: Rows in a block of running().
BLOCK = 256
SPAN = "array<struct<kind:int,start:int,end:int,match:string,before:string,after:string>>"


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check sum of up to 19 digits is right."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.least(F.length(digits), F.lit(19))), F.lit(0), add) % 10 == 0


def octets(match: Column) -> Column:
    return F.forall(F.split(match, "[.:]"), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def valid(kind: str, match: Column) -> Column:
    """What a base match must pass; failing ones are dropped."""
    n = F.length(digits_of(match))
    return {"email": F.lit(True), "ip": octets(match), "card": n.between(12, 19) & F.when(n <= 19, luhn(digits_of(match))).otherwise(False), "phone": n.between(9, 15)}[kind]


def _as(value: Column, f) -> Column:
    """f(value), with value made once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def running(numbers: Column) -> Column:
    """Running sums of an array of integers; by blocks, so that long arrays are not copied for each element."""

    def step(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x)).alias("out"))

    def scan(x: Column) -> Column:
        return F.aggregate(x, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), step, lambda acc: acc["out"])

    def joined(blocks: Column) -> Column:
        last = lambda b: F.get(b, F.size(b) - 1)
        return _as(scan(F.transform(blocks, last)), lambda t: F.flatten(F.transform(blocks, lambda b, i: F.transform(b, lambda v: v + F.get(t, i) - last(b)))))

    def blocks(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int"))), lambda k: scan(F.slice(x, k * BLOCK + 1, F.lit(BLOCK))))

    return _as(numbers, lambda x: _as(blocks(x), joined))


def spans(text: Column, kind: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (kind, start, end, match, before, after); offsets in code points,
    end exclusive. Matches are put between marks and cut out there; text must not hold the mark, U+0001."""
    empty = F.array().cast(SPAN)

    def located(x: Column) -> Column:
        cut, ends = x["cut"], x["ends"]
        one = lambda k: F.struct(F.lit(KINDS.index(kind)).alias("kind"), F.get(ends, k - 1).alias("start"), F.get(ends, k).alias("end"), F.get(cut, k).alias("match"), F.right(F.get(cut, k - 1), F.lit(24)).alias("before"), F.left(F.get(cut, k + 1), F.lit(8)).alias("after"))
        return F.transform(F.sequence(F.lit(1), F.size(cut) - 2, F.lit(2)), one)

    def found(cut: Column) -> Column:
        both = F.struct(cut.alias("cut"), running(F.transform(cut, lambda c: F.length(c))).alias("ends"))
        return F.when(F.size(cut) > 2, _as(both, located)).otherwise(empty)

    return F.when(text.rlike(HINT[kind]), _as(F.split(F.regexp_replace(text, pattern, "\x01$0\x01"), "\x01"), found)).otherwise(empty)


def features(c: Column) -> Column:
    """Format and context of a candidate, as an array of doubles."""
    m = c["match"]

    def of(digits: Column) -> Column:
        n = F.length(digits)
        count = lambda chars: F.length(m) - F.length(F.translate(m, chars, ""))
        numbers = [c["kind"], n, F.length(m), count(" "), count("."), count("-"), count("()[]"), count("/_:"), F.length(F.regexp_extract(m, "[0-9]+", 0)), F.length(F.regexp_extract(m, "[0-9]+$", 0))]
        flags = [
            n.between(12, 19) & F.when(n <= 19, luhn(digits)).otherwise(False), octets(F.regexp_replace(m, r"\x20?[\[(](?:dot|\.)[\])]\x20?", ".")), m.contains("@"), m.startswith("+"),
            m.rlike(r"^\(?0"), m.rlike(r"^(?:19|20)[0-9]{2}[./-]|[./-](?:19|20)[0-9]{2}$"), m.rlike("[A-Za-z]"), c["before"].rlike("[A-Za-z0-9]$"), c["after"].rlike("^[A-Za-z0-9]"), c["before"].rlike(r"[:=]\s*$"),
        ]
        flags += [c["before"].rlike(p) for p in CONTEXT]
        return F.array(*[x.cast("double") for x in numbers + flags])

    return _as(digits_of(m), of)


def tree_score(model, x: Column) -> Column:
    """The boosted trees as one expression: the sum of weighted leaves; above 0 for the label."""

    def walk(node) -> Column:
        if node.numDescendants() == 0:
            return F.lit(float(node.prediction()))
        split = node.split()
        return F.when(x[int(split.featureIndex())] <= float(split.threshold()), walk(node.leftChild())).otherwise(walk(node.rightChild()))

    total = F.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        total = total + walk(tree._java_obj.rootNode()) * float(weight)
    return total


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, base, wide): base spans of all kinds that pass their checks, and what the generators propose. One scan of the texts."""
    text = F.translate(F.col("text"), "\x01", "\x02")

    def passing(k: str) -> Column:
        return F.filter(spans(text, k, BASE[k]), lambda c: valid(k, c["match"]))

    def proposed(k: str, pattern: str) -> Column:
        return F.filter(spans(text, k, pattern), lambda c: F.length(digits_of(c["match"])).between(*DIGITS[k]))

    base, wide = [passing(k) for k in KINDS], [proposed(k, p) for k, p in WIDE]
    return docs.select("doc_id", F.concat(*base).alias("base"), F.concat(*wide).alias("wide"))


def apart(c: Column, others: Column) -> Column:
    return ~F.exists(others, lambda o: (o["start"] < c["end"]) & (c["start"] < o["end"]))


def disguised(kind: Column, match: Column, way: Column) -> Column:
    """A span written as its pattern does not have it: signs spelt out, separators exchanged, no plus or country. Way 0 leaves it as it is."""
    spelt = lambda at, dot: F.replace(F.replace(match, F.lit("@"), F.lit(at)), F.lit("."), F.lit(dot))
    bare = F.regexp_replace(match, r"^\+", "")
    ways = {
        "email": (spelt(" [at] ", " [dot] "), spelt("(at)", "."), spelt(" at ", " dot ")),
        "ip": (F.replace(match, F.lit("."), F.lit("[.]")), F.replace(match, F.lit("."), F.lit("(dot)")), F.replace(match, F.lit("."), F.lit(":"))),
        "card": (F.regexp_replace(match, "[ -]", "."), F.regexp_replace(digits_of(match), "([0-9]{4})(?=[0-9])", "$1_"), F.regexp_replace(digits_of(match), "([0-9]{4})(?=[0-9])", "$1  ")),
        "phone": (bare, F.regexp_replace(bare, r"[\x20().-]+", "."), F.regexp_replace(match, r"^\+[0-9]+[\x20.-]*", "")),
    }
    out = match
    for i, k in enumerate(KINDS):
        for w, made in enumerate(ways[k], start=1):
            out = F.when((kind == i) & (way == w), made).otherwise(out)
    return out


def spoilt(kind: Column, match: Column, way: Column) -> Column:
    """A number of a like form that cannot be data: a card's with another last digit, an address with a first
    part that is too large, a date, decimal or version made of a telephone number's digits. Null for other kinds."""
    last = F.translate(F.right(match, F.lit(1)), "0123456789", "1234567890")
    d = lambda at, n: F.substring(digits_of(match), at, n)
    date = F.concat(F.lit("20"), d(1, 2), F.lit("-0"), d(3, 1), F.lit("-1"), d(4, 1))
    other = F.when(way == 0, date).when(way == 1, F.concat(d(1, 4), F.lit("."), d(5, 4))).otherwise(F.concat_ws(".", d(1, 1), d(2, 1), d(3, 3), d(6, 3)))
    made = {"card": F.concat(F.left(match, F.length(match) - 1), last), "ip": F.concat(F.lit("9"), match), "phone": other}
    out = F.lit(None).cast("string")
    for k, m in made.items():
        out = F.when(kind == KINDS.index(k), m).otherwise(out)
    return out


def examples(found: DataFrame, doubt: float) -> DataFrame:
    """(c, label, weight, order): base spans, as they are and disguised, for label 1; for label 0 spoilt
    ones and, with the weight `doubt` as some may be data, proposals apart from all base spans."""
    seeded = F.xxhash64("doc_id", "c.start", "c.kind")
    way = F.pmod(seeded, F.lit(3)).cast("int")
    renamed = lambda m: F.struct(*[(m if f == "match" else F.col(f"c.{f}")).alias(f) for f in ("kind", "start", "end", "match", "before", "after")]).alias("c")
    given = lambda label, weight, order: [F.lit(label).alias("label"), F.lit(weight).alias("weight"), order.alias("order")]
    known = found.select("doc_id", F.explode("base").alias("c"))
    good = known.select("*", F.explode(F.array(F.lit(0), way + 1)).alias("way")).select(renamed(disguised(F.col("c.kind"), F.col("c.match"), F.col("way"))), *given(1.0, 1.0, F.xxhash64(seeded, "way")))
    bad = known.select(renamed(spoilt(F.col("c.kind"), F.col("c.match"), way)), *given(0.0, 1.0, F.xxhash64(seeded, F.lit(7)))).where("c.match IS NOT NULL")
    other = found.select("doc_id", F.explode(F.filter("wide", lambda c: apart(c, F.col("base")))).alias("c")).select("c", *given(0.0, doubt, seeded))
    return good.unionByName(bad).unionByName(other)


def fit(found: DataFrame, balance: int, precision: float, doubt: float = 0.2, seed: int = 5) -> tuple | None:
    """Boosted trees and a threshold for each kind, from all examples, alike ones as one row with their number. Those of a kind,
    label and weight count together for `balance` at most, each for the less. One in four is left out of the fit; a kind's threshold
    is the least score, 0 or more, from which on these have the precision, doubtful ones left aside. None without examples of both labels."""
    every = examples(found, doubt).select("label", "weight", F.col("c.kind").alias("kind"), features(F.col("c")).alias("x"), (F.pmod(F.xxhash64("order", F.lit(seed)), F.lit(4)) == 0).alias("held"))
    every = written(every.groupBy("kind", "label", "weight", "held", "x").agg(F.count("*").alias("n")), "examples")
    seen = every.groupBy("kind", "label", "weight").agg(F.sum("n").alias("n"), F.count_if(~F.col("held")).alias("rows")).collect()
    if len({r["label"] for r in seen if r["rows"]}) < 2:
        return None
    counts = F.lit(1.0)
    for r in seen:
        counts = F.when((F.col("kind") == r["kind"]) & (F.col("label") == r["label"]) & (F.col("weight") == r["weight"]), F.lit(min(1.0, balance / r["n"]))).otherwise(counts)
    weighed = every.withColumn("counts", F.col("n") * counts)
    rows = sum(r["rows"] for r in seen)
    train = weighed.where("NOT held").select("label", "n", (F.col("weight") * F.col("counts")).alias("weight"), array_to_vector("x").alias("features"))
    bins = max(32, math.isqrt(rows) + 1)  # so many that the trees look for their splits in all rows: up to bins ** 2 they draw none
    model = GBTClassifier(maxIter=10, maxDepth=4, stepSize=0.3, seed=seed, cacheNodeIds=False, weightCol="weight", maxBins=bins).fit(train.coalesce(1 + rows // 50_000))
    scored = weighed.where("held AND (label = 1 OR weight = 1)").select("kind", "label", "counts", tree_score(model, F.col("x")).alias("s"))
    grid = [i / 20 for i in range(0, 30)]
    above = lambda t, value: F.coalesce(F.sum(F.when(F.col("s") >= t, value)), F.lit(0.0))
    sums = scored.groupBy("kind").agg(*[F.struct(above(t, F.col("label") * F.col("counts")), above(t, F.col("counts"))).alias(f"t{i}") for i, t in enumerate(grid)]).collect()
    threshold = {}
    for row in sums:
        for i in reversed(range(len(grid))):
            good, n = row[f"t{i}"]
            if n and good / n < precision:
                break
            if good:
                threshold[row["kind"]] = grid[i]
    return model, threshold


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", balance: int = 1_667, precision: float = 0.95) -> DataFrame:
    """(doc_id, base, spans): arrays of (start, rank, end, kind) in order, one row per input row, no shuffle of rows.

    base holds the matches of the four patterns that pass their checks; spans also has the proposals
    apart from them that the boosted trees score above their kind's threshold, the one at which
    `precision` of the sure examples left out of the fit are data. Of overlapping ones, taken from left to
    right, the one of higher score stays, the earlier one among equals. Trees and
    thresholds come from all examples, those of a kind and label with the weight of `balance` at most. Texts are scanned once, at any length; null and empty ones have no spans;
    without examples of both labels spans are the base ones; null ids and repeated rows pass through;
    an empty table gives no rows; other columns are not read.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = written(candidates(narrow), "spans")
    fitted = fit(found, balance, precision)

    def placed(array: Column) -> Column:
        kind = F.array(*map(F.lit, KINDS))
        return F.transform(array, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("rank"), c["end"].alias("end"), F.get(kind, c["kind"]).alias("kind")))

    base = placed(F.col("base"))
    if fitted is None or not fitted[1]:
        return found.select("doc_id", F.array_sort(base).alias("base"), F.array_sort(base).alias("spans"))
    model, threshold = fitted
    limit = F.array(*[F.lit(threshold.get(i, float("inf"))) for i in range(len(KINDS))])
    shape = "array<struct<start:int,kind:int,end:int,score:double>>"
    scored = F.transform(F.filter("wide", lambda c: apart(c, F.col("base"))), lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), _as(features(c), lambda x: tree_score(model, x)).alias("score")))
    taken = F.array_sort(F.filter(scored, lambda c: c["score"] >= F.get(limit, c["kind"]))).cast(shape)

    def step(acc: Column, c: Column) -> Column:
        clear = (F.size(acc) == 0) | (F.try_element_at(acc, F.lit(-1))["end"] <= c["start"])
        better = c["score"] > F.try_element_at(acc, F.lit(-1))["score"]
        return F.when(clear, F.concat(acc, F.array(c))).when(better, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(c))).otherwise(acc)

    extra = F.aggregate(taken, F.array().cast(shape), step)
    return found.select("doc_id", F.array_sort(base).alias("base"), F.array_sort(F.concat(base, placed(extra))).alias("spans"))


def span_text(array: str) -> Column:
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(array: str, kind: str) -> Column:
    return F.size(F.filter(array, lambda s: s["kind"] == kind)).cast("long")


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with each span replaced by its kind in brackets; spans that overlap go with the first. Ids must be unique."""
    found = personal_data(docs, id_col, text_col).select("doc_id", "spans")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(found, "doc_id")

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        made = F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit("["), s["kind"], F.lit("]")).alias("out"))
        return F.when(s["start"] >= acc["at"], made).otherwise(acc)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return rows.select("doc_id", F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text")))).alias("text"))
