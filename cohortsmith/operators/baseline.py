"""Index-date baseline values: nearest value in a day window, post-index mean, second value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import as_date, day_diff, in_window


def nearest_to_index(ev: DataFrame, index_date, *, lo: int = C.BASELINE_LO, hi: int = C.BASELINE_HI,
                     prefer_max=C.PREFER_MAX, one_row_per_day: bool = False) -> DataFrame:
    """Per (patid, concept): the value nearest the index date within [lo, hi] days.

    Ties: smallest |days| -> smallest value (largest for ``prefer_max`` concepts) -> the earlier
    side.  Rows whose nearest value is NULL give no row (a NULL never equals the minimum).
    Output: patid, concept, value, date, datediff.

    By default any number of rows per day is right (one aggregate over an ordering struct).
    ``one_row_per_day=True`` is for input with one row per (patid, concept, day), as the daily
    mean produces, and wrong on other input: the order is
    encoded in two integer keys, ``2|d| + (d > 0)`` (earlier side first) and ``2|d| + (d <= 0)``
    (later side first); ``min`` / ``min_by`` on them are hash aggregates with map-side partial
    aggregation, so a patient or concept holding a large share of rows never lands whole in one
    task.  The two candidates at the minimum distance are then compared on value."""
    if not one_row_per_day:
        return _nearest_struct(ev, index_date, lo=lo, hi=hi, prefer_max=prefer_max)
    dd = day_diff(F.col("date"), index_date)
    dist = F.abs(dd).cast("long") * 2
    k_early = dist + (dd > 0).cast("long")
    k_late = dist + (dd <= 0).cast("long")
    g = (ev.filter(in_window(F.col("date"), index_date, lo, hi))
           .groupBy("patid", "concept").agg(
               F.min(k_early).alias("_ka"), F.min_by("value", k_early).alias("_va"),
               F.min_by("date", k_early).alias("_da"),
               F.min(k_late).alias("_kb"), F.min_by("value", k_late).alias("_vb"),
               F.min_by("date", k_late).alias("_db")))
    flip = F.col("concept").isin(list(prefer_max))
    sa = F.when(flip, -F.col("_va")).otherwise(F.col("_va"))
    sb = F.when(flip, -F.col("_vb")).otherwise(F.col("_vb"))
    take_a = F.col("_va").isNotNull() & (F.col("_vb").isNull() | (sa <= sb))
    half = F.floor(F.col("_ka") / 2).cast("int")
    dd_a = F.when(F.col("_ka") % 2 == 1, half).otherwise(-half)
    half_b = F.floor(F.col("_kb") / 2).cast("int")
    dd_b = F.when(F.col("_kb") % 2 == 0, half_b).otherwise(-half_b)
    out = g.select("patid", "concept",
                   F.when(take_a, F.col("_va")).otherwise(F.col("_vb")).alias("value"),
                   F.when(take_a, F.col("_da")).otherwise(F.col("_db")).alias("date"),
                   F.when(take_a, dd_a).otherwise(dd_b).alias("datediff"))
    return out.filter(F.col("value").isNotNull())


def _nearest_struct(ev: DataFrame, index_date, *, lo: int, hi: int, prefer_max) -> DataFrame:
    """Nearest pick as ``min(struct(|days|, value is NULL, +/-value, days, date, value))``: any
    number of rows per day (sort-based aggregation, still partial before the shuffle)."""
    dd = day_diff(F.col("date"), index_date)
    signed = F.when(F.col("concept").isin(list(prefer_max)), -F.col("value")).otherwise(F.col("value"))
    key = F.struct(F.abs(dd).alias("a"), F.col("value").isNull().alias("n"), signed.alias("s"),
                   dd.alias("d"), F.col("date").alias("date"), F.col("value").alias("v"))
    picked = (ev.filter(in_window(F.col("date"), index_date, lo, hi))
                .groupBy("patid", "concept").agg(F.min(key).alias("k")))
    return (picked.filter(F.col("k.v").isNotNull())
                  .select("patid", "concept", F.col("k.v").alias("value"),
                          F.col("k.date").alias("date"), F.col("k.d").alias("datediff")))


def nearest_to_index_window(ev: DataFrame, index_date, *, lo: int = C.BASELINE_LO,
                            hi: int = C.BASELINE_HI, prefer_max=C.PREFER_MAX) -> DataFrame:
    """The same pick in the original three-step window form (minimum distance, then
    minimum/maximum value, then first by signed difference).  A window group holds at most
    one row per day of the [lo, hi] window, so its size is bounded by the window length."""
    w = Window.partitionBy("patid", "concept")
    x = ev.filter(in_window(F.col("date"), index_date, lo, hi)).withColumn(
        "datediff", day_diff(F.col("date"), index_date))
    x = x.withColumn("_m", F.min(F.abs("datediff")).over(w)).filter(F.abs("datediff") == F.col("_m"))
    best = F.when(F.col("concept").isin(list(prefer_max)), F.max("value").over(w)).otherwise(
        F.min("value").over(w))
    x = x.withColumn("_b", best).filter(F.col("_b") == F.col("value"))
    x = x.withColumn("_r", F.row_number().over(w.orderBy("datediff"))).filter(F.col("_r") == 1)
    return x.select("patid", "concept", "value", "date", "datediff")


def post_index_mean(ev: DataFrame, index_date, *, concept: str = "height", out: str = "height") -> DataFrame:
    """Mean of a concept's values on or after the index date (no upper bound)."""
    return (ev.filter((F.col("concept") == concept) & (F.col("date") >= as_date(index_date)))
              .groupBy("patid").agg(F.avg("value").alias(out)))


def second_value(ev: DataFrame, baseline: DataFrame, *, lo: int = C.BASELINE_LO,
                 hi: int = C.BASELINE_HI, out: str = "preacr_secondvalue") -> DataFrame:
    """Confirmatory second value (dormant option).

    For each patient's baseline date d0, candidate values have ``date - d0`` in [lo, hi] and
    not 0; ordered by that difference (then value), the second row is returned.  Candidate
    groups are bounded by the window length."""
    b = baseline.select("patid", F.col("date").alias("_d0"))
    x = ev.join(b, "patid").withColumn("_dd", F.datediff("date", "_d0"))
    x = x.filter(F.col("_dd").between(lo, hi) & (F.col("_dd") != 0))
    w = Window.partitionBy("patid").orderBy("_dd", "value")
    return (x.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 2)
             .select("patid", F.col("value").alias(out)))
