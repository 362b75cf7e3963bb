"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

import os
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import table
from .alignment import alignment_digest
from .bpe import encoding_digest
from .chat import conversation_digest, formatted_conversations, turn_records
from .exact import duplicate_groups
from .imatch import edited_fingerprints
from .labelled import fold
from .licenses import license_matches
from .mixing import mix
from .periodic import periodic_runs, run_digest, tail_repeated
from .pii import KINDS, count_of, personal_data, span_text
from .quality import quality_scores
from .simhash import hex_fingerprint, near_duplicates

from .token_counts import edited_counts, three_edits
from .toxicity import toxicity_scores


def tokenizer_path(name: str) -> str:
    """Where the installed package of public vocabularies keeps a file."""
    return os.path.join(os.path.dirname(find_spec("public_tokenizers").origin), name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digest(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), three_edits(F.col("text")))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    counts = [count_of("base", k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(span_text("base"), 256).alias("base_sha256"), span_text("spans").alias("spans"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = duplicate_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return run_digest(periodic_runs(docs, text=tail_repeated(F.col("doc_id"), F.col("text"))))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return conversation_digest(formatted_conversations(turn_records(rows)), "conv_id", "turn", "at", "formatted")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_digest(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_bpe": op2_bpe,
    "op3_licenses": op3_licenses,
    "op4_mixing": op4_mixing,
    "op5_imatch": op5_imatch,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_pii": op9_pii,
    "op10_quality": op10_quality,
    "op11_periodic": op11_periodic,
    "op12_chat": op12_chat,
    "op13_alignment": op13_alignment,
}

SIZE = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"
NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

# RE2 has no look-ahead: backslashes before a control string are doubled with it, those at the end by themselves
CONTROLS = r"</?s>|\[/?(?:INST|SYS|ROLE)\]"
ESCAPED = rf"regexp_replace(regexp_replace({{}}, '(\\*)({CONTROLS})', '\1\1\\\2', 'g'), '(\\+)$', '\1\1')"

ORACLE_SQL = {
    "op6_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {NORM} AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
        FROM d""",
    "op12_chat": rf"""
        WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *, {ESCAPED.format("role")} AS erole, {ESCAPED.format("text")} AS etext FROM r)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length(etext) + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 11 ELSE 17 + length(erole) END) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
}
