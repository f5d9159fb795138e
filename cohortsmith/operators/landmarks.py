"""Baseline values at several index dates in one pass: an as-of sweep over events and landmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C


def landmark_rows(spine: DataFrame, dates, concepts) -> DataFrame:
    """patid, concept, landmark: every patient at every date, for each concept.  Built row by row on
    the spine, so its partitioning stays."""
    dated = spine.select("patid", F.explode(F.array(*[F.lit(d) for d in dates])).alias("landmark"))
    return dated.select("patid", F.explode(F.array(*[F.lit(c) for c in concepts])).alias("concept"), "landmark")


def nearest_at_landmarks(ev: DataFrame, marks: DataFrame, *, lo: int = C.BASELINE_LO, hi: int = C.BASELINE_HI,
                         prefer_max=C.PREFER_MAX) -> DataFrame:
    """Per (patid, concept, landmark) the value nearest the landmark within [lo, hi] days.

    ``ev`` (patid, concept, date, value) has one row per day, as daily means do; ``marks`` are rows
    (patid, concept, landmark).  Both are merged in date order; the last event on or before a
    landmark is carried forward to it, the next one after it backward, and of the two within the
    window the nearer is taken (ties: smaller value, larger for ``prefer_max``; then the earlier).
    Each event is read once however many landmarks there are; no event meets a landmark in a join.
    A group holds a patient's days of one concept.  Output: patid, concept, landmark, value, date,
    datediff; landmarks without a value in the window give no row, NULL values are never picked."""
    if not lo <= 0 <= hi:
        raise ValueError("the window must hold the landmark itself")
    seen = F.struct(F.col("date").alias("date"), F.col("value").alias("value"))
    rows = ev.filter(F.col("value").isNotNull()).select(
        "patid", "concept", F.col("date").alias("at"), F.lit(0).alias("is_mark"), seen.alias("event"))
    rows = rows.unionByName(marks.select("patid", "concept", F.col("landmark").alias("at"), F.lit(1).alias("is_mark"),
                                         F.lit(None).cast(rows.schema["event"].dataType).alias("event")))
    group = Window.partitionBy("patid", "concept")
    before = group.orderBy("at", "is_mark").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = group.orderBy(F.desc("at"), F.desc("is_mark")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = rows.withColumns({"p": F.last("event", ignorenulls=True).over(before), "n": F.last("event", ignorenulls=True).over(after)})
    swept = swept.filter(F.col("is_mark") == 1).select("patid", "concept", F.col("at").alias("landmark"), "p", "n")

    def side(c: str) -> dict:
        d = F.datediff(F.col(f"{c}.date"), "landmark")
        near = F.when(d.between(lo, hi), F.col(c))
        return {c: near, f"d{c}": F.when(d.between(lo, hi), F.abs(d))}
    swept = swept.withColumns({**side("p"), **side("n")})
    signed = lambda c: F.when(F.col("concept").isin(list(prefer_max)), -F.col(f"{c}.value")).otherwise(F.col(f"{c}.value"))
    first = F.col("dp").isNotNull() & (F.col("dn").isNull() | (F.col("dp") < F.col("dn"))
                                       | ((F.col("dp") == F.col("dn")) & (signed("p") <= signed("n"))))
    best = F.when(first, F.col("p")).otherwise(F.col("n"))
    return (swept.withColumn("e", best).filter(F.col("e").isNotNull())
                 .select("patid", "concept", "landmark", F.col("e.value").alias("value"), F.col("e.date").alias("date"),
                         F.datediff("e.date", "landmark").alias("datediff")))
