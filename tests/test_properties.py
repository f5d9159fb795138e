"""Property tests: repartitioning/permutation invariance, aggregate form = window form,
long form = wide form (SURVEY §5.3)."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortsmith import config as C
from cohortsmith.operators import baseline as B
from cohortsmith.operators import features as FT
from cohortsmith.sources.codelists import duplicate_codes

IDX = dt.date(2024, 3, 1)

rows_st = st.lists(
    st.tuples(st.sampled_from(["p1", "p2", "p3"]), st.sampled_from(["sbp", "egfr"]),
              st.integers(-740, 20), st.integers(0, 6).map(float)),
    min_size=1, max_size=40,
    unique_by=lambda r: (r[0], r[1], r[2]))  # one value per patient-concept-day (after daily mean)


def frame(spark, rows):
    return spark.createDataFrame([(p, c, IDX + dt.timedelta(days=d), v) for p, c, d, v in rows],
                                 "patid string, concept string, date date, value double")


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st, parts=st.integers(1, 5))
def test_nearest_forms_agree_and_ignore_partitioning(spark, rows, parts):
    ev = frame(spark, rows)
    agg = as_set(B.nearest_to_index(ev, IDX))
    win = as_set(B.nearest_to_index_window(ev, IDX))
    shuffled = as_set(B.nearest_to_index(frame(spark, list(reversed(rows))).repartition(parts), IDX))
    assert agg == win == shuffled


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st)
def test_long_and_wide_agree(spark, rows):
    ev = frame(spark, rows)
    long = FT.event_dates(ev, IDX)
    wide = FT.to_wide(long, ["sbp", "egfr"], {"earliest_pre": "e_{c}", "latest_pre": "l_{c}", "first_post": "p_{c}"})
    got = set()
    for r in wide.collect():
        for c in ["sbp", "egfr"]:
            if any(r[f"{m}_{c}"] is not None for m in "elp"):
                got.add((r.patid, c, r[f"e_{c}"], r[f"l_{c}"], r[f"p_{c}"]))
    assert got == {tuple(r) for r in long.collect()}


def test_fixture_codelists_have_no_duplicate_codes(spark):
    from cohortsmith.plans import registry
    b = registry.build_for(spark, "/root/testdata/sf0.001")
    assert duplicate_codes(b.wh.codelists).count() == 0


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st)
def test_hash_and_struct_nearest_agree(spark, rows):
    ev = frame(spark, rows)
    assert as_set(B.nearest_to_index(ev, IDX)) == as_set(B.nearest_to_index(ev, IDX, one_row_per_day=False))
