"""Scalar functions against worked examples."""

import unicodedata

from pyspark.sql import functions as F

from lattica.functions import ids, text, values


def one(spark, column, **cells):
    kinds = {k: "string" for k in cells}
    schema = ", ".join(f"{k} {t}" for k, t in kinds.items())
    df = spark.createDataFrame([tuple(cells.values())], schema) if cells else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


def test_ids(spark):
    for given, wanted in (("https://example.org/W12", 12), (" https://example.org/W12 ", 12), (None, None), ("Wxx", None), ("", None)):
        assert one(spark, ids.entity_id(F.col("a")), a=given) == wanted
    for given, wanted in (("https://example.org/T10102", 10102), ("https://example.org/topics/T10102", 10102), ("https://example.org/domains/4", 4), (None, None)):
        assert one(spark, ids.topic_id(F.col("a")), a=given) == wanted
    assert one(spark, ids.first_id(F.col("a")), a="see W12 and A34") == 12
    assert one(spark, ids.id_url("https://example.org/", "W", F.lit(5))) == "https://example.org/W5"


def test_text(spark):
    assert one(spark, text.dedup_key(F.col("a")), a="The <b>Cat</b> and, a Hat") == "cathat"
    assert one(spark, text.dedup_key(F.col("a")), a="Größe Журнал Θεωρία Łódź") == "grossezhurnaltheorialodz"
    assert one(spark, text.strip_accents(F.col("a")), a="Crème Ệ ά й ß ø") == "Creme E α и ß ø"
    assert one(spark, text.dedup_key(F.col("a")), a=None) is None
    assert one(spark, text.dedup_key(F.col("a")), a="") is None
    assert one(spark, text.ascii_clean(F.col("a")), a="Crème brûlée ж") == "Creme brulee  "
    assert one(spark, text.ascii_clean(F.col("a")), a=None) == ""
    assert one(spark, text.clean_title(F.col("a")), a="a\\nb") == "a b"
    assert one(spark, text.without_html(F.col("a")), a="<a\n>x<b>y") == "<a\n>xy"


def test_accents_of_all_code_points(spark):
    """As Python decomposes and drops marks; marks that would be put in another order are few and left out."""
    cs = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    rows = ["a" + "".join(f"{c}b" for c in cs[k : k + 200]) for k in range(0, len(cs), 200)]
    got = [r["x"] for r in spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string").select("i", text.strip_accents(F.col("t")).alias("x")).orderBy("i").collect()]
    assert got == ["".join(c for c in unicodedata.normalize("NFD", r) if unicodedata.category(c) != "Mn") for r in rows]


def test_inverted_indexes(spark):
    rows = [(1, "b a  b c a"), (1, "x"), (2, " "), (3, None), (None, "w " * 5000), (4, "\u00e9 \u00e9\tz")]
    got = text.inverted_indexes(spark.createDataFrame(rows, "k int, t string"), "k", "t").collect()
    assert sorted(((r["k"], r["index"]) for r in got if r["k"]), key=repr) == [(1, {"a": [1, 4], "b": [0, 2], "c": [3]}), (1, {"x": [0]}), (4, {"z": [2], "\u00e9": [0, 1]})]
    assert [r["index"] for r in got if r["k"] is None] == [{"w": list(range(5000))}]


def test_abstracts(spark):
    of = lambda s: one(spark, text.abstract_text(text.index_of(F.col("a"))), a=s)
    assert of('{"hello":[0,2],"world":[1]}') == "hello world hello"
    assert of("{}") is None and of(None) is None
    assert of('{"InvertedIndex":{"a":[0]}}') == "a"
    assert of('{"a":[0],"b":[0]}') == "b"


def test_values(spark):
    assert one(spark, values.to_bool(F.col("a")), a=None) is False
    assert one(spark, values.to_bool(F.col("a")), a="True") is True
    assert one(spark, values.to_day(F.col("a")), a="not a day") is None
    assert one(spark, values.pair_weight(F.lit(2), F.lit(3))) == 1 / 6
    assert one(spark, values.pair_weight(F.lit(0), F.lit(3))) is None
    sets = lambda s: one(spark, values.jaccard(F.from_json(F.col("a"), "array<array<int>>")), a=s)
    assert [sets(x) for x in ("[[1,2]]", "[[]]", "[[1,2],[2]]", "[[1],[2]]")] == [1.0, 0.0, 0.5, 0.0]
    df = spark.createDataFrame([("book",), (None,), ("unheard of",)], "t string")
    assert {(r.t, r.code) for r in values.encode_types(df, "t").collect()} == {("book", 6), (None, 0), ("unheard of", None)}
    assert dict(values.smallest_types(spark.sql("SELECT 5L AS a, 70000L AS b"), ["a", "b"]).dtypes) == {"a": "tinyint", "b": "int"}
