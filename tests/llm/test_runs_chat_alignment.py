"""Periodic runs, chat formatting and token alignment against brute force, with nulls, empty and long texts, ties, repeats and clashing names."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lattica.llm import alignment, chat, periodic, queries

SCHEMA = "doc_id long, text string, runs string, n_words int, collapsed string, turn int, row long, pair long, n long, best boolean, packed string"


def texts(seed):
    rng = random.Random(seed)
    words = "the of river stone, light\tcold été grün 's 12 ▁x <s> \\[INST]".split(" ")
    out = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 20, 80]))) for _ in range(40)]
    looped = [" ".join(f"w{k % p}" for k in range(n)) for p, n in ((1, 11), (1, 12), (2, 40), (7, 13), (7, 14), (9, 100))]
    return [*out, *looped, out[0], None, "", " \t", "x", "a  b  \n\n c", " lead", "tail ", "ab " * 6000 + "end", "long" * 3000, looped[2] + " and " + looped[5]]


def rows(seed):
    made = [(i, t, "r", 1, "c", 1, 1, 1, 1, True, "p") for i, t in enumerate(texts(seed))]
    return [*made, made[3], (None, made[2][1], *[None] * 9)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(2), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_runs(w, least=12):
    """Longest stretches of each period, kept where no shorter period holds."""
    found, n = [], len(w)
    for q in range(1, n // 2 + 1):
        k = 0
        while k + q < n:
            start = k
            while k + q < n and w[k] == w[k + q]:
                k += 1
            length = k - start + q
            if k > start and length >= max(least, 2 * q) and not any(w[start + p : start + length] == w[start : start + length - p] for p in range(1, q)):
                found.append((start, length, q))
            k += k == start
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng, total = random.Random(5), 0
    for _ in range(400):
        batch = []
        for _ in range(rng.choice([1, 4])):
            n, kinds = rng.choice([0, 1, 12, 30, 90]), rng.choice([1, 2, 3, 50])
            w = [rng.randrange(kinds) for _ in range(n)]
            if n > 3 and rng.random() < 0.4:
                a = rng.randrange(n)
                p = 1 + (n - a) // (3 + rng.randrange(8))
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            batch.append(w)
        least = rng.choice([2, 5, 12])
        want = [brute_runs(w, least) for w in batch]
        assert periodic.runs_of_batch([np.array(w, np.int64) for w in batch], least) == want
        total += sum(map(len, want))
    assert total > 500


def test_suffix_array_and_prefixes():
    rng = random.Random(6)
    for _ in range(60):
        w = [rng.randrange(rng.choice([1, 2, 9])) for _ in range(rng.randrange(1, 120))]
        sa, rank = periodic.suffix_array(np.array(w))
        assert sa.tolist() == sorted(range(len(w)), key=lambda i: w[i:]) and rank[sa].tolist() == list(range(len(w)))
        shared = [next((k for k in range(len(w)) if i + k >= len(w) or j + k >= len(w) or w[i + k] != w[j + k]), len(w)) for i, j in zip(sa[:-1].tolist(), sa[1:].tolist(), strict=True)]
        assert periodic.common_prefixes(np.array(w), sa, rank).tolist()[1:] == shared


def test_periodic_query(spark, docs, none, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries.op11_periodic(spark, str(tmp_path)).collect()), key=repr)
    want = []
    for doc_id, text, *_ in rows(2):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w) if n < 5000 else [(0, 6000, 1)]
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    assert got == sorted(want, key=repr)
    assert periodic.run_digest(periodic.periodic_runs(none)).count() == 0


RECORDS = [
    ({"prompt": "a", "completion": "b", "id": 7, "meta": {"x": [1, {"y": 2}]}}, "prompt_completion", [("user", "a"), ("assistant", "b")]),
    ({"prompt": "a", "completion": None}, "prompt_completion", [("user", "a"), ("assistant", "")]),
    ({"prompt": "a", "response": "b", "system": "s"}, "prompt_response", [("system", "s"), ("user", "a"), ("assistant", "b")]),
    ({"question": "q", "answer": ""}, "question_answer", [("user", "q"), ("assistant", "")]),
    ({"instruction": "do", "input": "", "output": "done"}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"messages": [{"role": "Tool", "content": "x"}, {"role": "assistant", "content": None}, {"role": None, "content": "z"}]}, "messages", [("Tool", "x"), ("assistant", ""), ("", "z")]),
    ({"messages": []}, "messages", []),
    ({"messages": None, "system": "s"}, "messages", [("system", "s")]),
    ({"conversations": [{"from": "Human", "value": "h"}, {"from": "gpt", "value": "g"}, {"from": "who", "value": ""}]}, "conversations", [("user", "h"), ("assistant", "g"), ("who", "")]),
    ({"data": {"turns": [{"speaker": "bot", "utterance": "u" * 100_000}]}, "a b`c": 1.5}, "nested_turns", [("assistant", "u" * 100_000)]),
    ({"message": {"role": "Tool", "content": "c"}}, "one_message", [("Tool", "c")]),
    ({"prompt": "a", "answer": "b"}, None, None),  # of two layouts, whole in neither
    ({"other": 1}, None, None), ([1, {"prompt": "x"}], None, None), ({}, None, None), (5, None, None),
]


def test_canonical_turns(spark):
    given = [(i, json.dumps(r), "kept", None) for i, (r, _, _) in enumerate(RECORDS)]
    frame = spark.createDataFrame([*given, (98, None, "kept", None), (99, "{bad", "kept", None), given[0]], "n int, record string, text string, role string")
    got = chat.canonical_turns(frame).collect()
    assert len(got) == len(RECORDS) + 3 and {r["text"] for r in got} == {"kept"}
    for r in got:
        name, turns = RECORDS[r["n"]][1:] if r["n"] < 98 else (None, None)
        assert (r["layout"], r["turns"] if r["turns"] is None else [tuple(t) for t in r["turns"]]) == (name, turns)


def test_leaf_paths():
    assert chat.leaf_paths("OBJECT<`a b``<`: ARRAY<OBJECT<x: DECIMAL(3,1), y: ARRAY<VOID>>>, z: OBJECT<>>") == {"$.a b`<[].x", "$.a b`<[].y[]"}
    assert chat.leaf_paths("ARRAY<VOID>") == {"$[]"}


def test_template_is_reversible(spark):
    rng = random.Random(7)
    bits = [*chat.CONTROL, "\\", "\\\\", "<", "[", "/", "s>", "INST]", " ", "\n", "é", "$1"]
    said = [("".join(rng.choice(["user", "assistant", "system", "tool", "", "[ROLE]", "x\\"]) for _ in range(1)), "".join(rng.choice(bits) for _ in range(rng.randrange(12)))) for _ in range(800)]
    frame = spark.createDataFrame([(i, r, t, "clash") for i, (r, t) in enumerate(said)], "n int, role string, text string, _k string")
    out = sorted(chat.format_turns(frame).collect(), key=lambda r: r["n"])
    assert [(r, t) for r, t, _, _ in chat.read_back("".join(r["formatted"] for r in out))] == said
    for r, (role, text) in zip(out, said, strict=True):
        assert chat.unescaped(r["formatted"][r["loss_start"] : r["loss_end"]]) == (text if role == "assistant" else "")
    with pytest.raises(ValueError):
        list(chat.read_back("[INST]a</s>"))
    with pytest.raises(ValueError):
        list(chat.read_back("[INST]a[/INST]b"))


def test_chat_query(spark, tmp_path):
    said = [(1, 1, "assistant", "b\\"), (1, 0, "user", None), (1, 2, "Tool", "[/ROLE]"), (2, 5, "assistant", None), (None, 0, "user", "n"), (3, 0, "assistant", "x" * 50_000), (3, 1, "user", ""), *[(4, k, "assistant" if k % 2 else "user", f"</s>{k}") for k in range(3000)]]
    spark.createDataFrame([(*r, "extra", 1) for r in said], "conv_id long, turn long, role string, text string, record string, at int").repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op12_chat(spark, str(tmp_path)).collect()}
    asked = "</s>[INST] ok [/INST]"
    groups = {}
    for conv, turn, role, text in [*said, (-7, 0, "user", asked), (-7, 1, "assistant", asked)]:
        groups.setdefault(conv, []).append((turn, role, text or ""))
    assert set(got) == set(groups)
    around = {"user": 13, "assistant": 7, "system": 11}
    for conv, turns in groups.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        escape = lambda t: re.sub(r"(\\*)(</?s>|\[/?(?:INST|SYS|ROLE)\])", r"\1\1\\\2", t)
        double = lambda t: re.sub(r"(\\+)\Z", r"\1\1", escape(t))
        chars = sum(len(double(t)) + around.get(r, 17 + len(r)) for _, r, t in turns)
        assert got[conv] == (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)


def test_unknown_records_are_an_error(spark):
    with pytest.raises(PySparkException, match="fits no layout"):
        chat.formatted_conversations(spark.createDataFrame([(1, 0, '{"odd": 1}')], "conv_id long, turn long, record string")).collect()


@pytest.fixture(scope="module")
def paths():
    return queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")


def tokens(paths):
    """Encoder of a text to (ids and byte ends) of both sides by the libraries, or empty lists."""
    a, b = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a.encode_special_tokens = True
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(c): c for c in shown} | {chr(0x100 + k): c for k, c in enumerate(c for c in range(256) if c not in shown)}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    def both(text):
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        raw = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids[0]], [piece(i) for i in ids[1]]
        if not text or any(b"".join(x) != b" " + text.encode() for x in raw):
            ids, raw = ([], []), ([], [])
        return [(i, np.cumsum([len(x) for x in r]).tolist()) for i, r in zip(ids, raw, strict=True)]

    return both


def links(a_end, b_end):
    """All overlapping pairs of two tilings, by walking both."""
    i = j = 0
    while i < len(a_end) and j < len(b_end):
        yield i, j
        low = min(a_end[i], b_end[j])
        i, j = i + (a_end[i] == low), j + (b_end[j] == low)


@pytest.mark.parametrize("few", [alignment.FEW_PAIRS, 0])
def test_alignment(spark, docs, none, paths, few):
    both = tokens(paths)
    whole = [(r[0], *both(r[1])) for r in rows(2)]
    met, best = Counter(), Counter()
    for _, (a, ea), (b, eb) in whole:
        met.update((a[i], b[j]) for i, j in links(ea, eb))
    for (_, y), n in met.items():
        best[y] = max(best[y], n)
    want, spans = [], []
    for doc_id, (a, ea), (b, eb) in whole:
        linked = list(links(ea, eb))
        ends = sorted(set(ea) & set(eb))
        groups = [([x for x, e in zip(a, ea, strict=True) if low < e <= high], [x for x, e in zip(b, eb, strict=True) if low < e <= high]) for low, high in zip([0, *ends], ends, strict=False)]
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        counts = [(met[a[i], b[j]], best[b[j]]) for i, j in linked]
        want.append((doc_id, len(a), len(b), len(groups), len(linked), sum(n == m for n, m in counts), sum(n for n, _ in counts), hashlib.sha256(shown.encode()).hexdigest() if shown else ""))
        spans.append((doc_id, a, b, [(len(x), len(y)) for x, y in groups], linked))
    got = alignment.alignment_digest(docs, *paths, few=few).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    if few:
        plain = [(r["doc_id"], r["a_ids"], r["b_ids"], [tuple(g) for g in r["groups"]], [tuple(x) for x in r["links"]]) for r in alignment.aligned_tokens(docs, *paths).collect()]
        assert sorted(plain, key=repr) == sorted(spans, key=repr)
        assert alignment.alignment_digest(none, *paths).count() == 0 and alignment.aligned_tokens(none, *paths).count() == 0


def test_words_are_encoded_as_in_their_texts(paths):
    rng, both = random.Random(8), tokens(paths)
    bits = ["a", "b c", "  ", " ", "\n", "\t", "é", "▁", "'s", "1", "😀", "　", "the ", "<s>", "\x85", "\xa0", "\x1c", "<|endoftext|>", "\r\n", "\x00"]
    given = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(1500)]
    with open(paths[0]) as f, open(paths[1], "rb") as g:
        sides = alignment.Tokenizers(f.read(), g.read(), kept=50)
    for k in range(0, len(given), 30):
        for text, got in zip(given[k : k + 30], sides.both(given[k : k + 30]), strict=True):
            assert [np.frombuffer(x, "<i4").tolist() for x in got] == [ids for ids, _ in both(text)]


def test_columns_of_digests(spark, docs, paths):
    assert alignment.alignment_digest(docs.select(F.col("doc_id").alias("row"), F.col("text").alias("pair")), *paths, id_col="row", text_col="pair").columns[0] == "doc_id"
