"""From raw documents to token ids in five stages.

Each stage takes the documents that its predecessor kept and returns a DataFrame that is written
as Parquet and read again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm.bpe import encoded
from lattica.llm.exact import distinct_texts
from lattica.llm.labelled import fold
from lattica.llm.mixing import mixed_rows
from lattica.llm.quality import with_quality
from lattica.llm.queries import tokenizer_path
from lattica.llm.simhash import distinct_documents
from lattica.runtime import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts: score of 0.5 or more. Rows stay as they are, null ids and repeated rows, too; a
    null or empty text scores as texts without words do; without labels all stay; an empty table gives no rows."""
    scored = with_quality(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return scored.where("score >= 0.5").select(*COLUMNS)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of texts that are equal but for runs of white space, one row even if it is repeated; null
    and empty texts are equal; a row without an id stays if its group has no other."""
    return distinct_texts(docs).select(*COLUMNS)


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group that links of a similarity of 0.8 or more in shingles of five words connect:
    those that SimHash and its BK-trees meet, checked by the shingles, and by an exact join all that they miss. Null and empty texts are equal; a row without an id stays if its group has no other; rows alike in id and text stay or go together."""
    return distinct_documents(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to three times, hence rows more than once. A null source is one of its own; null texts and
    texts without words have size 0 and no effect on the totals; repeated rows are sampled one by one; reruns agree."""
    return mixed_rows(docs).select(*COLUMNS)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row of the mix; a null or empty text has none; null ids and repeated rows pass through."""
    return encoded(docs, tokenizer_path("word_bpe_49k.json")).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", keep_one_copy),
    ("near_dedup", keep_one_near_copy),
    ("mixing", mix_sources),
    ("tokens", tokenise),
]

#: The classifier and the encoder have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
