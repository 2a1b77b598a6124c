"""Labelled rows for the trained filters: a bounded sample outside the fold
that is held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmflow.llm.common import column

#: Labelled documents that a model is fitted on at most.
MAX_LABELLED = 10_000


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, key: str = "doc_id",
             text: str = "text", at_most: int = MAX_LABELLED) -> DataFrame:
    """(key, text, label) of up to ``at_most`` labelled documents outside the
    held-out fold. A key with several labels takes the largest; rows without
    key or label are left out. The sample is the same in every run."""
    picked = labels.select(column(key).alias("key"), column(label).cast("int").alias("label")).where(
        "key is not null and label is not null").where(fold(F.col("key"), folds) != held_out)
    picked = picked.join(docs.select(column(key).alias("key")).distinct(), "key", "left_semi")
    picked = picked.groupBy("key").agg(F.max("label").alias("label")).orderBy(
        F.xxhash64("key"), "key").limit(at_most)
    given = docs.select(column(key).alias("key"), column(text).cast("string").alias("text"))
    return given.join(F.broadcast(picked), "key")  # at_most small rows
