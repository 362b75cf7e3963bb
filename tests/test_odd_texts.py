"""Queries over texts give the same rows as their SQL on texts that the driver's small tables do not have."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lattica.functions import text
from lattica.plans.registry import ORACLE_SQL, QUERIES

ODD = [
    None, "", " ", "\t\n \r", "\x0b", "\x0bfoo\x0b", "\x0b \x0b", "a\x0b b", "\x0c foo \x0c", "  lead  and  trail  ", "foo bar", "InvertedIndex word InvertedIndex", "w" * 60_000 + " x", "a\x00b \x00", "null",
    '"quoted" \\ back\\n', "ΟΔΟΣ Σ aΣ b", "the\x0bcat and\x0bdog", " the\x85an\x85", "\x1cthe\x1dand\x1f", "øthe and", "Журнал Θεωρία Łódź Größe ẞ", "<b>x</b> <a\nb> the <", "The_cat a_the", "İstanbul ı İthe",
    "한국어 the 日本語", "the and an a", "ﬁ ½ ² ١٢ Ⅷ", "a​the", "é a̲nd", "naïve_the l'and the's",
]


@pytest.mark.parametrize("name", ["abstract_roundtrip", "dedup_key"])
def test_odd_texts(spark, tmp_path, name):
    spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(ORACLE_SQL[name]).fetchall()
    assert sorted(tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect()) == sorted(want)


def test_inverted_index_is_a_word_of_an_index(spark):
    of = lambda s: spark.range(1).select(text.abstract_text(text.index_of(F.lit(s)))).first()[0]
    assert of('{"an":[0],"InvertedIndex":[1]}') == "an InvertedIndex"
    assert of('{"IndexLength":2,"InvertedIndex":{"InvertedIndex":[0],"a":[1]}}') == "InvertedIndex a"
