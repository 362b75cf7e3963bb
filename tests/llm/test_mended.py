"""Hot keys, clashing names, texts without blanks or without known terms."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lattica.llm import exact, imatch, simhash, toxicity


def test_an_owner_gets_each_hash_once_from_a_sender(spark, monkeypatch):
    frame = spark.range(40_000, numPartitions=6).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit("one text")).otherwise(F.col("id").cast("string")).alias("text"))
    seen, keep = [], exact.written
    monkeypatch.setattr(exact, "written", lambda df, name: seen.append(keep(df, name)) or seen[-1])
    got = {r["doc_id"]: r for r in exact.duplicate_groups(frame, owners=16).collect()}
    sizes = Counter()
    for r in seen[0].where("coded IS NOT NULL").collect():
        sizes[r["owner"]] += len(exact.golomb_decode(r["coded"]))
    assert len(sizes) == 16 and max(sizes.values()) < 1.3 * np.median(list(sizes.values()))
    assert sum(sizes.values()) == 20_000 + 6
    assert all((got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == ((0, 20_000, i == 0) if i % 2 == 0 else (i, 1, True)) for i in got) and len(got) == 40_000


def test_repeats_within_one_sender(spark):
    rows = [(5, "a b"), (3, "a  b"), (None, "a\tb"), (9, "c"), (9, "c"), (None, "d"), (None, "d"), (1, None), (2, "")]
    got = exact.duplicate_groups(spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)).collect()
    kept = Counter((r["keep_id"], r["group_size"]) for r in got if r["kept"])
    assert kept == {(3, 3): 1, (9, 2): 1, (None, 2): 1, (1, 2): 1} and len(got) == 9


@pytest.mark.parametrize("name", ["n", "kept", "m_id", "m_sha", "d_id", "d_sha", "doc", "sha", "gone_id", "gone_h", "d_h", "set", "row", "key"])
def test_clashing_names(spark, name):
    text = "one two three four five six seven eight nine ten"
    frame = spark.createDataFrame([(1, text, "x"), (2, text, "y"), (3, "other " * 12, "z")], f"doc_id long, text string, {name} string")
    for stage in (exact.distinct_texts, simhash.distinct_documents):
        out = stage(frame)
        assert out.columns == frame.columns and sorted(tuple(r) for r in out.collect()) == [(1, text, "x"), (3, "other " * 12, "z")]


class Spelling:
    """A model whose pieces with an x are toxic."""

    def ratios(self, words):
        return np.array([6.0 if "x" in w else 0.0 for w in words])


def test_toxicity_of_texts_without_blanks():
    of = toxicity.Evidence(Spelling())
    words = [random.Random(k).choice(["river", "stone", "light", "paper"]) for k in range(3000)]
    words[1500] = "axe"
    clean, blanks, joined = of([" ".join(w for w in words if w != "axe"), " ".join(words), "_".join(words)])
    assert clean == 0 and 0 < blanks < 0.01 and 0 < joined < 0.01
    rng = random.Random(1)
    short, long = (of(["".join(rng.choice("abcx") for _ in range(n))])[0] for n in (20, 2000))
    assert long <= toxicity.Evidence(Spelling())(["x"])[0] and long < 2 * max(short, 1.0)


def test_fingerprints_without_common_words(spark):
    texts = [f"w{k}a w{k}b w{k}c w{k}d" for k in range(40)] + ["", " ", None, "w0a w0b w0c w0d"]
    got = imatch.edited_fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    rows = {r["doc_id"]: r for r in got.collect()}
    assert all(rows[k]["near_next"] < 0.2 for k in range(1, 40))
    assert rows[0]["fingerprint"] == rows[43]["fingerprint"] != rows[1]["fingerprint"]
    assert rows[40]["fingerprint"] == rows[42]["fingerprint"] != rows[41]["fingerprint"]


def test_band_is_narrowed_from_its_rare_end(spark):
    docs = spark.createDataFrame([(" ".join(f"t{k}" for k in range(60) if i % (k + 2) == 0),) for i in range(600)], "text string")
    wide, narrow = (imatch.lexicon_table(docs, band=(0.05, 0.95), most=m) for m in (1000, 20))
    assert 0 < narrow.count() <= 20 < wide.count()
    counts = docs.select(F.explode(imatch._term_hashes(F.col("text"))).alias("term")).groupBy("term").count()
    least = counts.join(narrow, "term").agg(F.min("count")).first()[0]
    left_out = counts.join(wide, "term").join(narrow, "term", "left_anti").agg(F.max("count")).first()[0]
    assert left_out < least
