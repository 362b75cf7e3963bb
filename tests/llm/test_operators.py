"""Operators against brute force on small tables with nulls, empty and long texts, ties, repeated rows and extra columns."""

import hashlib
import json
import os
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lattica.llm import bpe, exact, imatch, labelled, licenses, mixing, pii, quality, queries, simhash, token_counts, toxicity

WORDS = "the of and a to in river stone light cold house green walk seven paper window".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, sha string, size int, norm string"


def make(seed, n=60):
    rng = random.Random(seed)
    base = [" ".join(rng.choice(WORDS) for _ in range(rng.choice([3, 20, 80]))) for _ in range(n)]
    texts = base + [base[0], base[0].replace(" ", "\n "), base[1] + " end", None, "", None, " \t", "x", "long " * 5000]
    rows = [(i, t, "en", None if i % 7 == 0 else f"s{i % 5}", len(t or ""), 1, "s", 1, "n") for i, t in enumerate(texts)]
    return [*rows, rows[3], (None, base[2], None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make(1), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def fingerprint(text, k):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, linked):
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {i: top(i) for i in ids}


def test_simhash(spark, docs, none):
    rows = simhash.near_duplicates(docs).withColumn("f", simhash.hex_fingerprint("fp")).collect()
    assert len(rows) == docs.count()
    want = {r.doc_id: fingerprint(r.text, 3) for r in docs.collect() if r.doc_id is not None}
    linked = [(a, b) for a in want for b in want if a < b and (want[a] ^ want[b]).bit_count() <= 3]
    parts = components(want, linked)
    for r in rows:
        if r.doc_id is not None:
            assert (r.f, r.component_id) == (f"{want[r.doc_id]:016x}", parts[r.doc_id])
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("radius,piece,agree", [(3, 2048, None), (3, 8, None), (3, 8, 3), (7, 8, 3), (7, 8, None)])
def test_links_connect_all_within_radius(spark, radius, piece, agree):
    rng = random.Random(radius)
    values = {rng.getrandbits(64) for _ in range(40)}
    for v in list(values)[:20]:
        for _ in range(3):
            values.add(v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius + 2))))
    values |= {(1 << 63) | i for i in range(30)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = [(r.src % 2**64, r.dst % 2**64) for r in simhash.simhash_links(df, radius, piece, agree).collect()]
    assert all((a ^ b).bit_count() <= radius for a, b in found)
    all_links = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= radius]
    assert components(values, found) == components(values, all_links)


def test_distinct_documents(spark, docs, none):
    rng = random.Random(4)
    long = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
    near = long[:200] + ["changed"] + long[201:]
    other = [f"v{rng.randint(0, 10**6)}" for _ in range(400)]
    df = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(near)), (3, " ".join(other)), (4, " ".join(long)), (5, None), (6, "")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.distinct_documents(df).collect()) == [1, 3, 5]
    assert simhash.distinct_documents(none).count() == 0


def jaccard_sets(texts, k=5):
    split = {i: (t or "").encode().lower().split() for i, t in texts.items()}
    return {i: {b" ".join(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} for i, w in split.items()}


def test_distinct_documents_by_brute_force(spark):
    """Copies at similarities from 0.75 to 0.97, hot phrases, short texts."""
    rng = random.Random(11)
    texts, hot = {}, " ".join(f"hot{i}" for i in range(12))
    for g in range(60):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.choice([8, 30, 150]))]
        texts[len(texts)] = " ".join(words)
        for _ in range(3):
            new = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                new[rng.randrange(len(new))] = f"n{rng.randint(0, 10**6)}"
            texts[len(texts)] = " ".join(new) + (" " + hot if g % 3 == 0 else "")
    for i in range(40):
        texts[len(texts)] = hot + " " + " ".join(f"c{rng.randint(0, 3)}" for _ in range(3))
    sets = jaccard_sets(texts)
    linked = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    want = sorted({components(sets, linked)[i] for i in sets})
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.distinct_documents(df).collect()) == want
    assert sorted(r.doc_id for r in simhash.distinct_documents(df, piece=4).collect()) == want


def test_distinct_documents_between_dissimilar_copies(spark):
    """Fingerprints of A and B, C and A are near, only C and B are alike: A must not hide the pair.
    Among equal fingerprints too, copies are found that are unlike the smallest id."""
    rng = random.Random(6)
    common = [f"w{i}" for i in range(300)]
    change = lambda words, n: [f"n{rng.randint(0, 10**6)}" if i in set(rng.sample(range(300), n)) else w for i, w in enumerate(words)]
    base = change(common, 1)
    texts = {1: " ".join(common)}
    for i in range(2, 40):
        texts[i] = " ".join(change(base, 6))
    sets = jaccard_sets(texts)
    linked = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.distinct_documents(df).collect()) == sorted({components(sets, linked)[i] for i in sets})


def test_sketch_links(spark):
    """Pairs in two groups as a plain comparison of multisets finds them, over blocks and between two sides."""
    rng = random.Random(9)
    sets = [simhash.shingle_set(" ".join(rng.choice(WORDS[: 4 + k % 5]) for _ in range(rng.choice([3, 9, 40]))), 2) for k in range(40)]
    rows = [(k, len(s), k % 25, simhash.sketch(s)) for k, s in enumerate(sets)]

    def bound(a, b):
        buckets = min(len(rows[a][3]), len(rows[b][3]))
        x, y = (np.bincount(sets[k] & (buckets - 1), minlength=buckets) for k in (a, b))
        assert np.minimum(x, y).sum() == simhash.overlap(rows[a][3], rows[b][3])
        return np.minimum(x, y).sum()

    sure = {(a, b) for a in range(40) for b in range(a + 1, 40) if a % 25 != b % 25 and len(set(sets[a]) & set(sets[b])) >= 0.5 / 1.5 * (len(sets[a]) + len(sets[b])) - 1e-6}
    alike = {(a, b) for a in range(40) for b in range(a + 1, 40) if a % 25 != b % 25 and min(len(sets[a]), len(sets[b])) >= 0.5 * max(len(sets[a]), len(sets[b])) - 1e-6 and bound(a, b) >= 0.5 / 1.5 * (len(sets[a]) + len(sets[b])) - 1e-6}
    assert sure <= alike
    for fine, block in ((False, 30), (False, 1_000_000), (True, 300), (True, 1_000_000)):
        if fine:
            alike, rows = sure, [(*r[:3], simhash.fine_sketch(sets[r[0]])) for r in rows]
        got = list(simhash.sketch_links(rows, None, 0.5, fine, True, block))
        assert set(got) == alike and len(got) == len(alike)
        got = set(simhash.sketch_links(rows[:15], rows[15:], 0.5, fine, True, block))
        assert got == {(a, b) for a, b in alike if a < 15 <= b}
        spanning = list(simhash.sketch_links(rows, None, 0.5, fine, False, block))
        own = [(k, k % 25) for k in range(40)]
        assert set(spanning) <= alike and components(range(40), spanning + own) == components(range(40), list(alike) + own)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe(spark, docs, none, name):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(name)
    theirs, ours = Tokenizer.from_file(path), bpe.Bpe(json.load(open(path)), cache=50)
    rng = random.Random(2)
    # of the long runs of ideographs, syllables and unassigned code points one in 17
    every = [c for c in range(0x110000) if (c < 0x3400 or 0xA000 <= c < 0xAC00 or 0xF900 <= c < 0x20000 or c % 17 == 0) and not 0xD800 <= c < 0xE000]
    for i in range(0, len(every), 40_000):
        texts = [f"a{chr(c)}b 1{chr(c)}?!{chr(c)} {chr(c)}" for c in every[i : i + 40_000]]
        assert [t for t, e in zip(texts, theirs.encode_batch(texts, add_special_tokens=False), strict=True) if np.frombuffer(ours.encode(t), "<u4").tolist() != e.ids] == []
    letters = [*map(chr, range(0x250)), *(chr(c) for c in (0x558, 0x88F, 0x1C89, 0xA7CB, 0x10D50, 0x16EA0, 0x16EBB, 0x85, 0x2028, 0x1E9E, 0x130)), "Σ", "ς", "İ", "́", " ", "中", "😀", "<|startoftext|>", "<|endoftext|>", "'s", " the", "   ", "\n"]
    for _ in range(3000):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 15)))
        ids = np.frombuffer(ours.encode(t), "<u4").tolist()
        assert ids == theirs.encode(t, add_special_tokens=False).ids
        assert ours.decode(ours.encode(t)) == theirs.decode(ids, skip_special_tokens=False)
    for r in bpe.encoding_digest(docs.where("doc_id IS NOT NULL"), path).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        ids = theirs.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encoded(docs, path).count() == docs.count() and bpe.encoded(none, path).count() == 0


def test_golomb():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 500):
        for top in (1, 10, 1 << 48):
            v = np.sort(rng.integers(0, top, n))
            assert exact.golomb_decode(exact.golomb_encode(v)).tolist() == v.tolist()


def test_exact(spark, docs, none):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for r in docs.collect():
        groups.setdefault(norm(r.text), []).append(r.doc_id)
    rows = exact.duplicate_groups(docs, owners=3).collect()
    assert len(rows) == docs.count()
    by_sha = {hashlib.sha256(t.encode()).digest(): ids for t, ids in groups.items()}
    for r in rows:
        ids = by_sha[bytes(r.sha)]
        assert (r.keep_id, r.group_size) == (min(i for i in ids if i is not None), len(ids))
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in rows) == len(groups)
    assert exact.duplicate_groups(none).count() == 0


def test_exact_dedup_stage_with_repeated_and_null_ids(spark):
    import corpus_pipeline as p

    rows = [(1, "a b"), (1, "a b"), (None, "only here"), (2, "x"), (2, "y"), (None, "a \n b"), (3, "y"), (None, "z"), (None, "z"), (4, None), (5, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in p.keep_one_copy(spark, df, "").collect()), key=str)
    assert got == sorted([(1, "a b"), (None, "only here"), (2, "x"), (2, "y"), (None, "z"), (4, None)], key=str)


def water(sizes):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(sizes), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        out |= {s: 3.0 * sizes[s] for s in full}
        left -= sum(3 * sizes[s] for s in full)
        open_ -= full
    return out


def test_mixing(spark, docs, none):
    rows = mixing.mix(docs).collect()
    assert rows and len(rows) == docs.count()
    given = docs.select("source", mixing.word_count(F.col("text")).alias("n")).collect()
    sizes = {}
    for r in given:
        sizes[r.source] = sizes.get(r.source, 0) + r.n
    want = water(sizes)
    taken, largest = {}, {}
    back = {v: k for k, v in sizes.items()}
    assert len(back) == len(sizes)
    for r in rows:
        s = back[r.source_size]
        assert r.target == pytest.approx(want[s]) and r.taken <= 3 * r.size
        taken[s] = taken.get(s, 0) + r.taken
        largest[s] = max(largest.get(s, 0), r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    more = docs.unionByName(docs.where("doc_id % 3 = 0")).unionByName(docs.where("doc_id = 21").crossJoin(spark.range(9)).drop("id"))
    sums = lambda df, n: {r.k: r.n for r in df.groupBy(F.coalesce("source", F.lit("none")).alias("k")).agg(F.sum(n).alias("n")).collect()}
    whole = mixing.mix(more).join(more.select("doc_id", "source").distinct(), "doc_id")
    assert sums(mixing.mixed_rows(more).where("doc_id IS NOT NULL"), mixing.word_count(F.col("text"))) == {k: v for k, v in sums(whole, "taken").items() if v}
    assert mixing.repeated(spark.createDataFrame([(1, 10000), (2, 3), (3, 0)], "a long, n long"), "n", "k").groupBy("a").agg(F.count("*"), F.max("k")).orderBy("a").collect() == [(1, 10000, 10000), (2, 3, 3)]
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns and mixing.mixed_rows(none).count() == 0 and mixing.mix(none).count() == 0


def test_licenses(spark, none):
    texts = ["a b c " + licenses.TEMPLATES["mit"] + " x y", "Licensed under the apache license version 2 0", licenses.TEMPLATES["bsd-3-clause"].replace("permitted", "allowed") + " more words", "licensed under some other terms", None, "", "w " * 3000 + licenses.TEMPLATES["gpl-3.0"]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.license): r.containment for r in licenses.license_matches(df, similarity=0.6).collect()}
    assert set(found) == {(0, "mit"), (1, "apache-2.0"), (2, "bsd-3-clause"), (6, "gpl-3.0")} and found[(2, "bsd-3-clause")] < 1
    assert {(r.doc_id, r.license) for r in licenses.license_matches(df).collect()} == {(0, "mit"), (1, "apache-2.0"), (6, "gpl-3.0")}
    assert licenses.license_matches(none).count() == 0


def test_licenses_by_brute_force(spark):
    """Edited license texts at any place: what a comparison at every place contains is found, and nothing else."""
    assert licenses.bands_for(0.5, 0.98) == 6 and 1 - 0.5**6 >= 0.98
    rng, texts = random.Random(7), []
    for k in range(150):
        name, text = rng.choice(list(licenses.TEXTS.items()))
        words = text.split()
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8, 14])):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        if k % 5 == 0:
            words = words[: len(words) // 2]
        texts.append(" ".join([*(rng.choice(WORDS) for _ in range(rng.randint(0, 200))), *words, *(rng.choice(WORDS) for _ in range(rng.randint(0, 200)))]))
    rows = [*enumerate(texts), (None, texts[0]), (0, texts[0]), (900, ""), (901, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("x"))
    out = licenses.license_matches(df).collect()
    found = {(r.doc_id, r.license) for r in out if r.doc_id is not None}
    assert sum(r.doc_id == 0 for r in out) == 2 * sum(r.doc_id is None for r in out)

    def grams(t):
        w = [x for x in re.split(r"[^\w]|_", t.lower()) if x]
        return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))]

    want = set()
    for i, t in enumerate(texts):
        g = grams(t)
        for name, template in [*licenses.TEMPLATES.items(), *licenses.TEXTS.items()]:
            kinds, size = set(grams(template)), len(grams(template))
            if len(kinds & set(g)) >= 0.8 * len(kinds) and any(len(kinds & set(g[p : p + size + 8])) >= 0.8 * len(kinds) for p in range(len(g))):
                want.add((i, name))
    print(f"license recall {len(want & found) / len(want):.3f} of {len(want)}, beyond {len(found - want)}")
    assert len(want & found) >= 0.98 * len(want)
    assert all(len(set(grams({**licenses.TEMPLATES, **licenses.TEXTS}[n])) & set(grams(texts[i]))) >= 0.8 * len(set(grams({**licenses.TEMPLATES, **licenses.TEXTS}[n]))) for i, n in found)


def test_imatch(spark, docs, none):
    rows = imatch.edited_fingerprints(docs).collect()
    assert len(rows) == docs.count()
    held = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).orderBy(F.desc("doc_id")).collect()
    some = imatch.edited_fingerprints(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).collect()
    by_id = {r.doc_id: r for r in some}
    for k, r in enumerate(held):
        t, nxt = r.text or "", held[(k + 1) % len(held)].text or ""
        third = len(t) // 3
        assert by_id[r.doc_id].edited_sha256 == hashlib.sha256((t[: len(t) - third] + nxt[:third]).encode()).hexdigest()
        assert by_id[r.doc_id].n_chars == len(t) and 0 <= by_id[r.doc_id].near_edited <= 1
    same = {}
    for r in held:
        same.setdefault(r.text or "", set()).add(by_id[r.doc_id].fingerprint)
    assert all(len(v) == 1 for v in same.values())
    assert imatch.edited_fingerprints(none).count() == 0


def test_next_row(spark):
    dense = [(i, f"t{i}") for i in [*range(-700, 900), 5000]]
    sparse = [(i, f"t{i}") for i in (5, 7, 511, 512, 700000, 700001, 9_000_000_000, -3)]
    for rows, kind in ((dense, "long"), (sparse, "long"), ([(f"id{i}", t) for i, t in sparse], "string")):
        got = {r.doc_id: r.next_text for r in imatch.with_next(spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(5), "doc_id", "text", []).collect()}
        order = sorted(rows, reverse=True)
        assert got == {r[0]: order[(k + 1) % len(order)][1] for k, r in enumerate(order)}
    odd = [(3, "a"), (3, "a"), (3, "b"), (None, "c"), (None, "d"), (None, "d"), (1, "e"), *[(2, f"x{i}") for i in range(50)]]
    out = imatch.with_next(spark.createDataFrame(odd, "doc_id long, text string"), "doc_id", "text", []).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in out) == sorted((i is None, i or 0, t) for i, t in odd)
    link = {(r.doc_id, r.text): r.next_text for r in out}
    assert len({(r.doc_id, r.text, r.next_text) for r in out}) == len(set(odd)) and sorted(link.values()) == sorted(t for _, t in set(odd))
    assert imatch.with_next(spark.createDataFrame([(1, "only")], "doc_id long, text string"), "doc_id", "text", []).first().next_text == "only"


def test_imatch_lexicon_and_likeness(spark):
    """The lexicon has every term of the band by a plain count and few others; likeness is what the fingerprints say."""
    rng = random.Random(4)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6)) % 3000}" for _ in range(80)) for _ in range(400)]
    texts += texts[:3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    count = {}
    for t in texts:
        for w in set(t.split()):
            count[w] = count.get(w, 0) + 1
    low, high = len(texts) ** 0.2, len(texts) ** 0.8
    lex = imatch.lexicon(df)
    words = spark.createDataFrame([(w,) for w in count], "w string")
    inside = {r.w for r in words.where(lex.has(F.xxhash64("w"))).collect()}
    band = {w for w, n in count.items() if low <= n <= high}
    assert band <= inside and len(inside - band) <= 0.05 * len(count)
    rows = {r.doc_id: r for r in imatch.edited_fingerprints(df).collect()}

    def likeness(a, b):
        a, b = (bytes.fromhex(x) for x in (a, b))
        shares = []
        for k in range(0, len(a), imatch.SUBSETS):
            pairs = [(x, y) for x, y in zip(a[k : k + imatch.SUBSETS], b[k : k + imatch.SUBSETS], strict=True) if x or y]
            shares.append((len(pairs), sum(x == y for x, y in pairs) / max(1, len(pairs))))
        spoken = [s for n, s in shares if n >= imatch.ENOUGH]
        return max(spoken) if spoken else shares[0][1] if shares[0][0] else float(a == b)

    for i, r in rows.items():
        assert r.near_edited == pytest.approx(likeness(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(likeness(r.fingerprint, rows[i - 1 if i else len(texts) - 1].fingerprint))
    assert all(rows[i].fingerprint == rows[400 + i].fingerprint for i in range(3))
    both = lambda f: sum(f(r) for r in rows.values()) / len(rows)
    print("mean likeness to the edited text", both(lambda r: r.near_edited), "to the next", both(lambda r: r.near_next))
    assert both(lambda r: r.near_edited) > 2 * both(lambda r: r.near_next)


PLAIN = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(d):
    total = sum((x := int(c) * (1 + i % 2)) - 9 * (x > 9) for i, c in enumerate(reversed(d)))
    return total % 10 == 0


def base_spans(t):
    out = []
    for rank, (kind, p) in enumerate(PLAIN):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def test_pii(spark, docs, none):
    rng = random.Random(8)
    bits = ["a@b.com", "x.y+z@mail-1.example.org", "@", ".", "a@b", "_q@r.st", "1.2.3.4", "256.1.1.1", ".5", "4111 1111 1111 1111", "4111-1111-1111-1112", "9807915762804490", "+1 (017) 555-7713", "+12 3", " ", "é😀", "12 ", "-", "+", "word", "7" * 40, "1 2 " * 30]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(400)] + [None, "", "7" * 30000, "a" * 30000 + "@", "1 " * 8000, "a.b" * 5000 + "@x.y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.personal_data(df).collect():
        want = base_spans(texts[r.doc_id] or "")
        assert [tuple(s) for s in r.base] == want, texts[r.doc_id][:200]
        assert set(want) <= {tuple(s) for s in r.spans}
    assert pii.personal_data(none).count() == 0
    out = pii.redacted(spark.createDataFrame([(1, "mail a@b.com now")], "doc_id long, text string")).first()
    assert out.text == "mail [email] now"


def test_pii_zero_octets_and_hints(spark):
    texts = ["10.0.0.1", "at 127.0.0.1 and 192.168.00.5", "0.0.0.0", "0256.1.1.1", "+15551234567", "+15551234567, x", "+15551234567\nx", "+15551234567x", "4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.personal_data(df).collect():
        assert [tuple(s) for s in r.base] == base_spans(texts[r.doc_id]), texts[r.doc_id]
        assert bool(r.base) == (r.doc_id != 3)


def test_pii_running(spark):
    for n in (0, 1, 255, 256, 257, 1500):
        x = [(7 * i) % 11 for i in range(n)]
        got = spark.createDataFrame([(x,)], "x array<int>").select(pii.running(F.col("x")).alias("y")).first().y
        assert got == np.cumsum(x, dtype=int).tolist()


def test_pii_learns_disguises(spark, none):
    """Planted disguised data among prose, versions and dates: precision and recall of the added spans."""
    rng = random.Random(12)
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card(sep):
        d = num(15)
        d += next(str(x) for x in range(10) if luhn(d + str(x)))
        return sep.join(d[i : i + 4] for i in range(0, 16, 4))

    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    ip = lambda dot: dot.join(str(rng.randint(0, 255)) for _ in range(4))
    plain = (lambda: f"{name()}@{name()}.com", lambda: ip("."), lambda: card(" "), lambda: f"+1 ({num(3)}) {num(3)}-{num(4)}")
    hidden = (lambda: f"{name()} [at] {name()} [dot] com", lambda: ip("[.]"), lambda: card("."), lambda: f"({num(3)}) {num(3)}-{num(4)}")
    clean = (lambda: f"version {rng.randint(0, 9)}.{rng.randint(0, 20)}.{rng.randint(300, 900)}.{rng.randint(300, 999)}", lambda: f"20{num(2)}-0{rng.randint(1, 9)}-1{num(1)}", lambda: f"{num(4)}.{num(4)}", lambda: f"order {num(13)}x")
    texts, planted = [], {}
    for i in range(900):
        text = ""
        for _ in range(4):
            text += " ".join(rng.choice(WORDS) for _ in range(6)) + " "
            made = rng.choice(rng.choice((plain, plain, hidden, clean)))
            what = made()
            if made in hidden:
                planted.setdefault(i, set()).add((len(text), len(text) + len(what)))
            text += what + " "
        texts.append(text)
    df = spark.createDataFrame([*enumerate(texts), (None, "write a [at] b [dot] com"), (None, None), (5000, ""), *list(enumerate(texts))[:2]], "doc_id long, text string").withColumn("kind", F.lit(1)).withColumn("spans", F.lit("x"))
    rows = pii.personal_data(df).collect()
    assert len(rows) == df.count() and pii.personal_data(none).count() == 0
    hits = found = want = 0
    for r in {x.doc_id: x for x in rows if x.doc_id is not None and x.doc_id < 900}.values():
        base = base_spans(texts[r.doc_id])
        assert [tuple(s) for s in r.base] == base
        more = sorted(set(map(tuple, r.spans)) - set(base))
        assert all(not (a[0] < b[2] and b[0] < a[2]) for a in more for b in base) and all(a[2] <= b[0] for a, b in zip(more, more[1:], strict=False))
        got = {(s[0], s[2]) for s in more}
        hits += len(got & planted.get(r.doc_id, set()))
        found += len(got)
        want += len(planted.get(r.doc_id, ()))
    print(f"added spans: precision {hits / max(1, found):.3f}, recall {hits / want:.3f} of {want}")
    assert hits >= 0.9 * found and hits >= 0.7 * want


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_quality_and_toxicity(spark, none):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(400):
        words = [rng.choice(WORDS) for _ in range(60)]
        bad, toxic = i % 4 == 0, i % 5 == 0
        if toxic:
            words[10:10] = [rng.choice(["vilest", "vilely", "vileness"])]
        if bad:
            words = [w + "&&&" for w in words]
        rows.append((i, " ".join(words)))
        marks.append((i, int(not bad), int(toxic)))
    df = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1, 1), (5000, None, None)], "doc_id long, quality int, toxic int")
    for scores, k, n, out in ((quality.quality_scores, 1, 3, 1), (toxicity.toxicity_scores, 2, 5, 0)):
        got = {r.doc_id: r.score for r in scores(df, labels, labelled.fold("doc_id", n) != out).collect()}
        assert len(got) == 403 and all(0 <= s <= 1 for s in got.values())
        held = [m for m in marks if fold(m[0], n) == out]
        assert sum((got[m[0]] >= 0.5) == bool(m[k]) for m in held) >= 0.95 * len(held)
        assert scores(none, labels, labelled.fold("doc_id", n) != out).count() == 0
        assert len(scores(df, labels.where("false"), labelled.fold("doc_id", n) != out).collect()) == 403


def test_quality_clashing_column_and_repeated_rows(spark):
    rows = [(i, "w " * (i + 1) if i % 2 else "@@ && " * (i + 1)) for i in range(20)]
    df = spark.createDataFrame([*rows, rows[3], (3, "other text"), (None, None)], "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(3, 1)], "doc_id long, quality int")
    got = quality.with_quality(df, labels, F.lit(True)).collect()
    assert len(got) == 23 and len({r.score for r in got if r.doc_id == 3 and r.text == rows[3][1]}) == 1 and all(0 <= r.score <= 1 for r in got)
    assert labelled.sampled(df, labels, "quality", F.lit(True), 100).count() == 20
    assert quality.shape("a" * 70 + "!" + "B" * 70) == "a!A"


def test_toxicity_likelihoods():
    """The orders' likelihoods as their formula gives them with plain dictionaries; they sum to 1 over all bytes that follow."""
    rng = random.Random(2)
    words = [sorted({"".join(rng.choice("abé") for _ in range(rng.randint(0, 7))) for _ in range(n)}) for n in (80, 50, 120)]
    times = [{w: rng.randint(1, 4) for w in ws} for ws in words]

    def count(ws, order, weigh):
        total = {}
        for w in ws:
            s = b"^" + w.encode() + b"$"
            for e in range(1, len(s)):
                g = s[max(0, e + 1 - order) : e + 1]
                total[g] = total.get(g, 0) + (ws[w] if weigh else 1)
        return total

    plain = [(count(times[2], toxicity.SHARED, False), toxicity.SHARED_PRIOR, None)]
    for k in (0, 1):
        plain += [(count(times[k], o, i == 1), toxicity.OWN_PRIOR, k) for i, o in enumerate(toxicity.OWN)]

    def likelihood(s, k):
        p = toxicity.FLOOR
        for (counts, prior, of), order in zip(plain, (toxicity.SHARED, *toxicity.OWN, *toxicity.OWN), strict=True):
            if of not in (None, k):
                continue
            off = toxicity.discounts(np.array(list(counts.values()), float))
            g = s[-order:]
            here = [n for x, n in counts.items() if x[:-1] == g[:-1]]
            n = counts.get(g, 0)
            p = (max(n - off[min(n, 3)], 0) + (prior + sum(off[min(x, 3)] for x in here)) * p) / (prior + sum(here))
        return p

    def table(ws, order, i, weigh):
        g, c, sizes = toxicity.sequences(list(ws), (order,))
        return toxicity.counted(g[0], c[0], np.repeat([float(ws[w]) if weigh else 1.0 for w in ws], sizes))

    model = toxicity.Model(toxicity.Order([table(times[2], toxicity.SHARED, 0, False)], toxicity.SHARED_PRIOR), [toxicity.Order([table(times[k], o, i, i == 1) for k in (0, 1)], toxicity.OWN_PRIOR) for i, o in enumerate(toxicity.OWN)])
    for w in (*words[0][:10], *words[1][:10], "zzz", ""):
        p, sizes = model.likelihoods([w])
        s = b"^" + w.encode() + b"$"
        assert sizes.tolist() == [len(s) - 1]
        for e in range(1, len(s)):
            for k in (0, 1):
                assert p[e - 1, k] == pytest.approx(likelihood(s[: e + 1], k), rel=1e-4)
    assert sum(likelihood(b"^ab" + bytes([b]), 1) for b in range(256)) == pytest.approx(1)
    h = np.sort(np.random.default_rng(1).integers(0, 2**64 - 1, 5000, dtype=np.uint64))
    assert (toxicity.Lookup(h)(h) == np.arange(5000)).all() and (toxicity.Lookup(h)(h + np.uint64(1)) == 5000).all() and (toxicity.Lookup(h[:0])(h) == 0).all()


def test_toxicity_reads_long_words_to_the_end(spark):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(400):
        words = [rng.choice(WORDS) for _ in range(60)]
        if i % 5 == 0:
            words[10:10] = [rng.choice(["vilest", "vilely", "vileness"])]
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 5 == 0)))
    clean = "-".join(WORDS)
    more = [(1000, clean), (1001, clean + "-vilest"), (1002, clean + "_vileness_" + clean), (1003, "é" * 40 + "/vilely/" + clean)]
    df, labels = spark.createDataFrame([*rows, *more], "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(df, labels, F.lit(True)).collect()}
    assert [got[i] >= 0.5 for i, _ in more] == [False, True, True, True]
    word = "".join(rng.choice("aé中x") for _ in range(200))
    assert toxicity.pieces("short") == ["short"] and all(any(word[k : k + 3] in p for p in toxicity.pieces(word)) for k in range(197))


def test_token_counts(spark, docs, none):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("byte_bpe_50k.json")
    theirs, ours = Tokenizer.from_file(path), bpe.Bpe(json.load(open(path)))
    rng = random.Random(5)
    for _ in range(60):
        special = rng.random() < 0.4
        t = "".join(rng.choice([*(["<|endoftext|>", "<|end", "oftext|>"] if special else []), "the", "  ", "\n", " a", "it's", " 12", "!!", "é", " ", "x"]) for _ in range(rng.choice([0, 3, 30, 700])))
        tree = token_counts.TokenTree(t, ours)
        for _ in range(20):
            a = rng.randint(0, len(t) + 2)
            b = a + rng.choice([0, 0, 1, 5, 50, 400])
            new = "".join(rng.choice([*(["<|", "|>", "<|endof", "text|>"] if special else []), " ", "the", "\n", "'", "s", "9", "é!"]) for _ in range(rng.choice([0, 1, 4, 40, 300])))
            p = min(a, len(t))
            t = t[:p] + new + t[min(max(b, p), len(t)) :]
            tree.edit(a, b, new)
            assert tree.text() == t and tree.n_tokens == len(theirs.encode(t, add_special_tokens=False).ids)
    assert token_counts.TokenTree("hello <|endoftext|> world", ours).n_tokens == 4
    rows = token_counts.edited_counts(docs, path, token_counts.three_edits(F.col("text"))).collect()
    texts = {r.doc_id: (r.text or "", r.edits) for r in docs.withColumn("edits", token_counts.three_edits(F.col("text"))).collect()}
    for r in rows:
        if r.doc_id is None:
            continue
        t, edits = texts[r.doc_id]
        assert r.n_tokens == len(theirs.encode(t, add_special_tokens=False).ids)
        for e in edits:
            a = min(max(e.start, 0), len(t))
            t = t[:a] + e.new + t[min(max(e.end, a), len(t)) :]
        assert (r.edited_tokens, r.edited_chars) == (len(theirs.encode(t, add_special_tokens=False).ids), len(t))
    assert len(rows) == docs.count() and token_counts.edited_counts(none, path, token_counts.three_edits(F.col("text"))).count() == 0
    edits = spark.createDataFrame([(1, 0, 0, 0, "ab"), (1, 1, 2, None, None)], "doc_id long, seq int, start int, end int, new string")
    assert token_counts.collected_edits(edits).first().edits[0].new == "ab"


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no driver tables here")
def test_pipeline(spark):
    import corpus_pipeline as p

    from lattica.runtime import table, written

    d = "/root/testdata/sf0.001"
    docs = table(spark, d, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in p.STAGES:
        out = written(stage(spark, docs, d), name)
        if name == "exact_dedup":
            norm = [re.sub(r"[\x20\x09-\x0D]+", " ", texts[r.doc_id]) for r in out.collect()]
            assert len(norm) == len(set(norm)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", texts[r.doc_id]) for r in docs.collect()})
        if name == "quality":
            good = {r.doc_id for r in table(spark, d, "labels").where("quality = 1").collect()}
            assert len(good - {r.doc_id for r in out.collect()}) <= 0.02 * len(good)
        if name != "tokens":
            assert out.columns == list(p.COLUMNS)
        docs = out
    assert docs.count() > 0
