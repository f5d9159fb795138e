"""Attrition: rows and patients left after each selection rule, from one pass over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_failed(rules: dict[str, Column]) -> Column:
    """The number (from 1) of the first rule that is not TRUE for the row; one past the last if all
    are.  A NULL condition fails, as it does in a filter."""
    conds = list(rules.values())
    out = F.lit(len(conds) + 1)
    for i in range(len(conds), 0, -1):
        out = F.when(F.coalesce(conds[i - 1], F.lit(False)), out).otherwise(F.lit(i))
    return out


def attrition(df: DataFrame, rules: dict[str, Column], *, key: str = "patid") -> DataFrame:
    """step, rule, n_rows, n_patients left after the rules up to each step (step 0: all rows).

    A row carries the first rule it fails; per patient the furthest step and the rows that reached
    each one are aggregated (combined on the map side), then summed up: one scan, no action per
    step.  An empty input gives zeros."""
    names = ["all", *rules]
    rows = df.select(F.col(key).alias("_key"), first_failed(rules).alias("_far"))
    per = rows.groupBy("_key").agg(F.max("_far").alias("_far"),
                                   *[F.count_if(F.col("_far") > k).alias(f"_r{k}") for k in range(len(names))])
    one = per.agg(*[F.struct(F.lit(k).alias("step"), F.lit(n).alias("rule"), F.coalesce(F.sum(f"_r{k}"), F.lit(0).cast("long")).alias("n_rows"),
                             F.count_if(F.col("_far") > k).alias("n_patients")).alias(f"_s{k}") for k, n in enumerate(names)])
    return one.select(F.inline(F.array(*[F.col(f"_s{k}") for k in range(len(names))])))
