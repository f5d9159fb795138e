"""A patient holding a third of all rows: results stay exact, the hot join partition is split by
AQE (SortMergeJoin(skew=true)), and reductions combine map-side before the shuffle."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortsmith.operators import baseline as B
from cohortsmith.operators import events as E
from cohortsmith.operators import features as FT

SKEW_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    n = 30000
    ev = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("patid"),
        F.lit("x").alias("concept"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("id") % 3000).cast("int")).alias("date"),
        (F.col("id") % 50).cast("double").alias("value"))
    pats = spark.range(997).select(F.col("id").cast("string").alias("patid")).union(
        spark.createDataFrame([("hot",)], "patid string"))
    valid = pats.select("patid", F.lit(dt.date(2001, 1, 1)).alias("min_dob"), F.lit(dt.date(2030, 1, 1)).alias("gp_end_date"))
    yield ev, valid, n
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_patient_join_is_split(skewed):
    ev, valid, n = skewed
    out = E.restrict_to_registration(ev, valid)
    rows = out.collect()
    assert len(rows) == ev.filter(F.col("date") >= dt.date(2001, 1, 1)).count()
    assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()


def test_hot_patient_reductions_exact(skewed):
    ev, _, n = skewed
    idx = dt.date(2004, 1, 1)
    # one value per patient-day first (the operators' contract after the daily mean)
    daily = ev.groupBy("patid", "concept", "date").agg(F.min("value").alias("value"))
    agg = sorted(tuple(r) for r in B.nearest_to_index(daily, idx).collect())
    win = sorted(tuple(r) for r in B.nearest_to_index_window(daily, idx).collect())
    assert agg == win
    hot = {r.patid: r for r in FT.event_dates(daily, idx).collect()}["hot"]
    dates = [r.date for r in daily.filter("patid = 'hot'").collect()]
    assert hot.earliest_pre == min(d for d in dates if d <= idx)
    assert hot.first_post == min(d for d in dates if d > idx)


def _shape(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_dates_are_combined_before_the_registration_join(skewed):
    """Equal rows go before the exchange: the join sees one row per concept and day, so a patient
    with a third of all rows brings no more than its days."""
    ev, valid, n = skewed
    many = ev.filter("patid = 'hot'")
    for _ in range(3):
        many = many.unionByName(many)
    many = many.unionByName(ev).withColumn("late", F.lit(False))
    dates = E.restrict_dates(many, valid.withColumn("gp_ons_end_date", F.col("gp_end_date")))
    rows = dates.collect()
    want = ev.filter(F.col("date") >= dt.date(2001, 1, 1)).select("patid", "concept", "date").distinct()
    assert len(rows) == want.count()
    hot = sum(r.patid == "hot" for r in rows)
    assert hot == want.filter("patid = 'hot'").count() < len(rows) / 4
    plan = _shape(dates)  # the join reads the distinct rows, and they were made in two steps
    assert plan.count("HashAggregate(keys=[patid") >= 2 and plan.index("SortMergeJoin") < plan.index("HashAggregate(keys=[patid")


def test_feature_aggregate_splits_a_hot_patient(skewed):
    ev, valid, n = skewed
    df = FT.event_dates(E.restrict_to_registration(ev, valid), dt.date(2004, 1, 1))
    df.collect()
    assert "skew=true" in _shape(df)
