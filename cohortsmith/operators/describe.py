"""Descriptive summaries: percent missing and a stratified 'Table 1' in long form.

Quantiles are exact (R type 7 / linear interpolation) and computed without holding a
stratum in one task: distinct values with counts are range-partitioned, cumulative counts
come from per-partition sums plus partition offsets, and the few needed order statistics
are picked with an equi join on the (small) table of target ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def missingness(df: DataFrame, cols) -> DataFrame:
    """Percent of rows with a NULL, rounded half-to-even; one row per variable."""
    cols = list(cols)
    aggs = [F.bround(F.lit(100.0) * F.avg(F.col(c).isNull().cast("double")), 0).alias(c) for c in cols]
    wide = df.agg(*aggs)
    return wide.unpivot([], cols, "variable", "pct_missing")


def _long(df: DataFrame, strata: str, cols, as_type: str) -> DataFrame:
    x = df.filter(F.col(strata).isNotNull()).select(
        F.col(strata).cast("string").alias("stratum"),
        *[F.col(c).cast(as_type).alias(c) for c in cols])
    return x.unpivot(["stratum"], list(cols), "variable", "value")


def exact_quantiles(long: DataFrame, keys, probs, value: str = "value",
                    num_partitions: int | None = None) -> DataFrame:
    """Exact type-7 quantiles of ``value`` per ``keys`` for each p in ``probs``.

    Output: *keys, p, q.  Work is distributed: no group is ever gathered in one task."""
    keys = list(keys)
    spark = long.sparkSession
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    vc = (long.filter(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c")))
    # range partitions in (keys, value) order; pin the partition ids with a reliable checkpoint
    ranged = vc.repartitionByRange(n_parts, *keys, value).withColumn("_pid", F.spark_partition_id())
    ranged = ranged.checkpoint(eager=True)
    local = ranged.withColumn("_cum", F.sum("_c").over(
        Window.partitionBy("_pid", *keys).orderBy(value)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # partition totals: at most (#partitions + #groups) rows
    tot = ranged.groupBy("_pid", *keys).agg(F.sum("_c").alias("_t"))
    off = tot.withColumn("_off", F.coalesce(F.sum("_t").over(
        Window.partitionBy(*keys).orderBy("_pid")
              .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_t")
    glob = local.join(off, ["_pid", *keys]).select(
        *keys, value, (F.col("_off") + F.col("_cum")).alias("_hi"),
        (F.col("_off") + F.col("_cum") - F.col("_c") + 1).alias("_lo"))
    # target ranks: one row per (group, p, side); group sizes from the stored partition totals
    n = tot.groupBy(*keys).agg(F.sum("_t").alias("_n"))
    h = (F.col("_n") - 1).cast("double") * F.col("p")
    probs_arr = F.array(*[F.lit(float(p)) for p in probs])
    tgt = (n.select(*keys, "_n", F.explode(probs_arr).alias("p"))
            .select(*keys, "p", (F.floor(h) + 1).cast("long").alias("_r0"),
                    F.least(F.floor(h) + 2, F.col("_n")).cast("long").alias("_r1"),
                    (h - F.floor(h)).alias("_frac")))
    ranks = tgt.select(*keys, "p", "_frac", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("_r0").alias("r")),
        F.struct(F.lit(1).alias("side"), F.col("_r1").alias("r")))).alias("t")).select(
        *keys, "p", "_frac", "t.side", "t.r")
    hit = glob.join(ranks, keys).filter(F.col("r").between(F.col("_lo"), F.col("_hi")))
    q = hit.groupBy(*keys, "p").agg(
        F.first("_frac").alias("_frac"),
        F.max(F.when(F.col("side") == 0, F.col(value))).alias("_x0"),
        F.max(F.when(F.col("side") == 1, F.col(value))).alias("_x1"))
    return q.select(*keys, "p", (F.col("_x0") + F.col("_frac") * (F.col("_x1") - F.col("_x0"))).alias("q"))


def table_one_continuous(df: DataFrame, vars_, strata: str, nonnormal=()) -> DataFrame:
    """Per stratum and continuous variable: n (non-missing), mean, sd; median and quartiles
    for the non-normal variables (NULL for the others)."""
    vars_ = list(vars_)
    long = _long(df, strata, vars_, "double")
    stats = long.groupBy("stratum", "variable").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    nn = [v for v in vars_ if v in set(nonnormal)]
    if not nn:
        return stats.select("*", *[F.lit(None).cast("double").alias(c) for c in ("p25", "median", "p75")])
    q = exact_quantiles(long.filter(F.col("variable").isin(nn)), ["stratum", "variable"], [0.25, 0.5, 0.75])
    qw = q.groupBy("stratum", "variable").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("p25"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("p75"))
    return stats.join(qw, ["stratum", "variable"], "left")


def table_one_categorical(df: DataFrame, factors, strata: str) -> DataFrame:
    """Per stratum, factor and level: count and percent of the non-missing values."""
    long = _long(df, strata, list(factors), "string").filter(F.col("value").isNotNull())
    counts = long.groupBy("stratum", "variable", F.col("value").alias("level")).agg(
        F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("stratum", "variable")  # over aggregated counts: a handful of rows
    return counts.withColumn("pct", F.lit(100.0) * F.col("n") / F.sum("n").over(w))


def table_one_n(df: DataFrame, strata: str) -> DataFrame:
    return (df.filter(F.col(strata).isNotNull())
              .groupBy(F.col(strata).cast("string").alias("stratum")).agg(F.count(F.lit(1)).alias("n")))


def table_one(df: DataFrame, vars_, strata: str, *, factors=(), nonnormal=()) -> DataFrame:
    """The three pieces as one long table: part ('n', 'continuous', 'categorical'), stratum,
    variable, level, n, mean, sd, p25, median, p75, pct; what a part has not is NULL."""
    factors = list(factors)
    cols = {"part": "string", "stratum": "string", "variable": "string", "level": "string", "n": "bigint", "mean": "double",
            "sd": "double", "p25": "double", "median": "double", "p75": "double", "pct": "double"}
    parts = {"n": table_one_n(df, strata), "continuous": table_one_continuous(df, [v for v in vars_ if v not in factors], strata, nonnormal),
             "categorical": table_one_categorical(df, factors, strata)}
    out = None
    for name, part in parts.items():
        p = part.withColumn("part", F.lit(name))
        p = p.select(*[(F.col(c) if c in p.columns else F.lit(None)).cast(t).alias(c) for c, t in cols.items()])
        out = p if out is None else out.unionByName(p)
    return out
