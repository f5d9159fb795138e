"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold


def training_labels(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """doc_id, y of the labelled rows outside the held-out fold; one row per id (of several labels
    the largest counts), rows without id or label left out."""
    return (labels.select("doc_id", F.col(label).cast("int").alias("y")).dropna()
                  .filter(fold("doc_id", folds) != held_out).groupBy("doc_id").agg(F.max("y").alias("y")))


def bounded(rows: DataFrame, keep: Column, most: int) -> DataFrame:
    """The ``most`` rows of ``keep`` with the least hash of their id: the same rows in each run."""
    return rows.filter(keep).orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(most)


def class_counts(train: DataFrame) -> dict[int, int]:
    return {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
