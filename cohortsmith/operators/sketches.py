"""Mergeable quantile state for Table 1: KLL sketches per stratum and variable.

A snapshot's sketches are a few kilobytes per group, stored once; summaries of several snapshots
merge them and read no rows.  The exact form is ``describe.table_one_continuous``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .describe import _long

SKETCH_K = 800


def rank_error(k: int = SKETCH_K) -> float:
    """The bound stated for ranks: twice the sketch's normalised rank error at 99 % confidence
    (2.446 / k^0.9433), after any number of merges of sketches of this size."""
    return 2 * 2.446 / k ** 0.9433


def sketch_values(df: DataFrame, variables, strata: str, k: int = SKETCH_K) -> DataFrame:
    """stratum, variable, n, total, sketch of the non-NULL values of each group.

    Tasks sketch what they hold and only sketches are exchanged, so no group meets in one task."""
    long = _long(df, strata, variables, "double").filter(F.col("value").isNotNull())
    return long.groupBy("stratum", "variable").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"),
        F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))


def merge_sketches(*tables: DataFrame) -> DataFrame:
    """One table of sketches for the rows of all tables."""
    rows = reduce(DataFrame.unionByName, tables)
    return rows.groupBy("stratum", "variable").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.kll_merge_agg_double("sketch").alias("sketch"))


def table_one_sketched(sketches: DataFrame) -> DataFrame:
    """stratum, variable, n, mean, p25, median, p75 from sketches; quartiles within ``rank_error``."""
    q = lambda p: F.kll_sketch_get_quantile_double("sketch", F.lit(p))
    return sketches.select("stratum", "variable", "n", (F.col("total") / F.col("n")).alias("mean"),
                           q(0.25).alias("p25"), q(0.5).alias("median"), q(0.75).alias("p75"))


def rank_within(df: DataFrame, variables, strata: str, found: DataFrame, error: float) -> DataFrame:
    """stratum, variable, n and per quartile whether the rank of the value found lies within
    ``error`` of the one asked for, by counting the rows of ``df`` below and up to it."""
    long = _long(df, strata, variables, "double").filter(F.col("value").isNotNull()).join(
        found.select("stratum", "variable", "p25", "median", "p75"), ["stratum", "variable"])
    parts = {"p25": 0.25, "median": 0.5, "p75": 0.75}

    def ok(c: str, p: float) -> Column:
        share = lambda cond: F.avg(cond.cast("double"))
        return (share(F.col("value") < F.col(c)) <= p + error) & (share(F.col("value") <= F.col(c)) >= p - error)
    return long.groupBy("stratum", "variable").agg(F.count(F.lit(1)).alias("n"), *[ok(c, p).alias(f"{c}_within") for c, p in parts.items()])
