"""Folds and bounded samples of labelled documents, shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null ids are in no fold."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def sampled(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int) -> DataFrame:
    """(doc_id, text, label) of at most per_class labelled documents of each class, in the order
    of a hash of the id. Null labels and ids are left out; of several labels of an id the largest
    counts, of several documents the first text."""
    given = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn).groupBy("doc_id").agg(F.max(label).alias("label"))
    order = F.xxhash64("doc_id", F.lit(11))
    parts = [given.where(F.col("label") == k).orderBy(order, "doc_id").limit(per_class) for k in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # at most 2 * per_class rows
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(chosen, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
