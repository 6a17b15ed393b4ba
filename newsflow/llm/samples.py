"""Folds and bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents that a classifier is fitted on, at most.
SAMPLE = 20_000


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id is in no fold (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column,
                    size: int = SAMPLE) -> DataFrame:
    """Columns `text` and `y` of at most `size` labelled documents whose id satisfies `train`.

    The sample is the `size` labels with the smallest hash of their id: it does not depend on the
    partitioning. Its ids are broadcast, `size` rows at most.
    """
    chosen = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & train)
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(size))
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("text", "y"))
