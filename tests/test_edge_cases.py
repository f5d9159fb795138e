"""Hand-made edge rows (tie rules, bounds, NULL semantics) on small literal frames."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortsmith import config as C
from cohortsmith.operators import baseline as B
from cohortsmith.operators import cohort as CO
from cohortsmith.operators import describe as D
from cohortsmith.operators import events as E
from cohortsmith.operators import features as FT
from cohortsmith.operators import measures as M
from cohortsmith.operators.joins import prefix_join

IDX = dt.date(2024, 3, 1)


def d(days):
    return IDX + dt.timedelta(days=days)


def ev(spark, rows):
    return spark.createDataFrame([(p, c, d(x), v) for p, c, x, v in rows],
                                 "patid string, concept string, date date, value double")


def picked(df):
    return {(r.patid, r.concept): (r.value, r.datediff) for r in df.collect()}


@pytest.mark.parametrize("form", [B.nearest_to_index, B.nearest_to_index_window])
def test_nearest_rules(spark, form):
    rows = [
        ("bounds", "sbp", -731, 1.0), ("bounds", "sbp", 8, 2.0), ("bounds", "sbp", -730, 3.0),
        ("eqdiff", "sbp", -3, 5.0), ("eqdiff", "sbp", 3, 4.0),
        ("eqdiff", "egfr", -3, 5.0), ("eqdiff", "egfr", 3, 4.0),
        ("same", "sbp", -3, 5.0), ("same", "sbp", 3, 5.0),
        ("near", "sbp", -1, 9.0), ("near", "sbp", -2, 1.0),
        ("hi", "sbp", 7, 6.0), ("hi", "sbp", -8, 1.0),
    ]
    got = picked(form(ev(spark, rows), IDX))
    assert got[("bounds", "sbp")] == (3.0, -730)
    assert got[("eqdiff", "sbp")] == (4.0, 3)
    assert got[("eqdiff", "egfr")] == (5.0, -3)
    assert got[("same", "sbp")] == (5.0, -3)
    assert got[("near", "sbp")] == (9.0, -1)
    assert got[("hi", "sbp")] == (6.0, 7)


def test_daily_mean_and_units(spark):
    raw = spark.createDataFrame(
        [("p", "potassium", d(0), 4.0, 218), ("p", "potassium", d(0), 6.0, None),
         ("p", "potassium", d(1), 5.0, 7), ("p", "potassium", d(2), 3.0, 425)],
        "patid string, concept string, date date, value double, numunitid int")
    units = spark.createDataFrame([("potassium", u) for u in C.POTASSIUM_UNITS], "concept string, numunitid int")
    out = {r.date: r.value for r in M.daily_mean(M.apply_unit_whitelist(raw, units)).collect()}
    assert out == {d(0): 5.0, d(2): 3.0}


def test_hba1c_conversion_and_year_floor(spark):
    raw = spark.createDataFrame(
        [("p", "hba1c", dt.date(2000, 1, 1), v, 218) for v in (20.0, 20.01, 48.0)]
        + [("p", "hba1c", dt.date(1989, 12, 31), 50.0, 218), ("q", "hba1c", dt.date(1990, 1, 1), 50.0, 218)],
        "patid string, concept string, date date, value double, numunitid int")
    conv = sorted(r.value for r in M.convert_hba1c(raw).filter(F.col("date") == dt.date(2000, 1, 1)).collect())
    assert conv[0] == pytest.approx(20.01) and conv[1] == pytest.approx(48.0)
    assert conv[2] == pytest.approx((20 - 2.152) / 0.09148)
    limits = spark.createDataFrame([("hba1c", 0.0, 1000.0)], "concept string, lo double, hi double")
    units = spark.createDataFrame([("hba1c", 218)], "concept string, numunitid int")
    valid = spark.createDataFrame([(p, dt.date(1900, 1, 1), dt.date(2100, 1, 1)) for p in "pq"],
                                  "patid string, min_dob date, gp_end_date date")
    clean = M.clean_measurements(raw, limits, units, valid)
    assert {(r.patid, r.date) for r in clean.filter(F.col("date") < dt.date(1995, 1, 1)).collect()} == {
        ("q", dt.date(1990, 1, 1))}


def test_zero_denominator_ratio_dropped(spark):
    clean = ev(spark, [("p", "albumin_urine", 0, 3.0), ("p", "creatinine_urine", 0, 0.0),
                       ("q", "albumin_urine", 0, 3.0), ("q", "creatinine_urine", 0, 1.5)])
    limits = spark.createDataFrame([("acr", 0.0, 100.0)], "concept string, lo double, hi double")
    out = M.same_day_ratio(clean, limits).collect()
    assert [(r.patid, r.value) for r in out] == [("q", 2.0)]


def test_registration_bounds(spark):
    e = ev(spark, [("p", "x", -11, 1.0), ("p", "x", -10, 1.0), ("p", "x", 10, 1.0), ("p", "x", 11, 1.0)])
    valid = spark.createDataFrame([("p", d(-10), d(10))], "patid string, min_dob date, gp_end_date date")
    got = sorted(r.date for r in E.restrict_to_registration(e, valid).collect())
    assert got == [d(-10), d(10)]


def test_event_dates_and_flags(spark):
    e = ev(spark, [("p", "af", 0, None), ("p", "af", -5, None), ("p", "af", 4, None), ("q", "af", 2, None)])
    spine = spark.createDataFrame([("p",), ("q",), ("r",)], "patid string")
    out = {r.patid: r for r in FT.event_features(e, spine, IDX, ["af", "copd"], earliest="e_{c}", latest="l_{c}",
                                                  post="p_{c}", flag="f_{c}").collect()}
    assert (out["p"].e_af, out["p"].l_af, out["p"].p_af, out["p"].f_af) == (d(-5), d(0), d(4), True)
    assert (out["q"].e_af, out["q"].f_af, out["q"].p_af) == (None, False, d(2))
    assert out["r"].f_af is False and out["r"].f_copd is False and out["r"].e_copd is None


def test_stage_at_index(spark):
    cols = "patid string, " + ", ".join(f"{s} date" for s in ["stage_1", "stage_2", "stage_3a", "stage_3b", "stage_4", "stage_5"])
    hist = spark.createDataFrame([
        ("milder_later", None, d(-100), None, None, d(-5000), None),
        ("grace_in", None, None, None, None, None, d(7)),
        ("grace_out", d(-1), None, None, None, None, d(8)),
        ("none", None, None, None, None, None, None)], cols)
    spine = spark.createDataFrame([(p,) for p in ["milder_later", "grace_in", "grace_out", "none", "absent"]], "patid string")
    out = {r.patid: (r.preckdstage, r.preckdstagedatediff) for r in FT.stage_at_index(spine, hist, IDX).collect()}
    assert out == {"milder_later": ("stage_4", -5000), "grace_in": ("stage_5", 7), "grace_out": ("stage_1", -1),
                   "none": (None, None), "absent": (None, None)}


@pytest.mark.parametrize("n,cat", [(4, "fit"), (5, "mild"), (8, "mild"), (9, "moderate"), (12, "moderate"), (13, "severe")])
def test_frailty_thresholds(spark, n, cat):
    deficits = [f"efi_{i}" for i in range(20)] + C.EFI_FORCED
    e = ev(spark, [("p", f"efi_{i}", -1, None) for i in range(n - len(C.EFI_FORCED))])
    spine = spark.createDataFrame([("p",)], "patid string")
    r = FT.frailty_index(e, spine, IDX, deficits).collect()[0]
    assert r.efi_n_deficits == n and r.pre_index_date_efi_cat == cat
    assert r.pre_index_date_efi_score == pytest.approx(n / 36)


def test_drug_class_and_subclass(spark):
    lookup = spark.createDataFrame([("1", "glp1", "osema"), ("2", "sglt2", None)],
                                   "prodcodeid string, drug_class_1 string, drug_substance_2 string")
    scripts = spark.createDataFrame([("p", "1", d(0)), ("p", "2", d(1))], "patid string, prodcodeid string, date date")
    got = sorted((r.concept, r.date) for r in E.split_drug_classes(
        scripts, lookup, classes=["glp1", "sglt2"], subclasses=["osema"]).collect())
    assert got == [("glp1", d(0)), ("osema", d(0)), ("sglt2", d(1))]


def test_alive_at_index(spark):
    rows = [(p, d(-999), d(-999), d(5), death, 1) for p, death in [("a", None), ("b", d(0)), ("c", d(-1))]]
    df = spark.createDataFrame(rows, "patid string, dm_diag_date_all date, regstartdate date, gp_record_end date, death_date date, with_hes int")
    assert sorted(r.patid for r in CO.prevalent_cohort(df, IDX).collect()) == ["a", "b"]


def test_null_semantics_in_flags(spark):
    df = spark.createDataFrame([
        ("null_stage", "type 2", 1, False, None, 50.0, 5.0, None, None, False, False, False),
        ("sbp_null_acr_hi", "type 2", 1, False, "stage_3a", 50.0, 5.0, None, None, False, False, False),
        ("sbp_null_acr_lo", "type 2", 1, False, "stage_3a", 50.0, 1.0, None, None, False, False, False)],
        "patid string, diabetes_type string, ncurrtx int, pre_index_date_ckd5_code boolean, preckdstage string, "
        "preegfr double, uacr double, presbp double, prepotassium double, pre_index_date_finerenone boolean, "
        "pre_index_date_ascvd boolean, pre_index_date_heartfailure boolean")
    assert [r.patid for r in CO.restrict_cohort(df).collect()] == ["sbp_null_acr_hi", "sbp_null_acr_lo"]
    el = {r.patid: r for r in CO.eligibility_flags(df).collect()}
    assert el["sbp_null_acr_hi"].eligible_aceorarb is None
    assert el["sbp_null_acr_lo"].eligible_aceorarb is False
    assert el["sbp_null_acr_hi"].prepotassium_noNA == 5.5
    assert el["sbp_null_acr_hi"].eligible_finerenone is False  # 5.5 > 5 and not on the drug


def test_missingness_half_even(spark):
    df = spark.createDataFrame([(None if i == 0 else 1.0,) for i in range(40)], "uacr double")
    assert D.missingness(df, ["uacr"]).collect()[0].pct_missing == 2.0


def test_drop_unknown_column_errors(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b_date int")
    with pytest.raises(ValueError):
        CO.drop_matching(df, exact=["nope"])
    assert CO.drop_matching(df, ends_with=["DATE"]).columns == ["a"]


def test_prefix_join_matches_like(spark):
    hosp = spark.createDataFrame([("p", "I10"), ("p", "I123"), ("p", "I2"), ("p", "J11")], "patid string, ICD string")
    codes = spark.createDataFrame([("x", "I1"), ("y", "I12"), ("z", "I2")], "concept string, prefix string")
    got = sorted((r.ICD, r.concept) for r in prefix_join(hosp, "ICD", codes, "prefix").collect())
    like = sorted((r.ICD, r.concept) for r in hosp.join(codes, F.col("ICD").startswith(F.col("prefix"))).collect())
    assert got == like == [("I10", "x"), ("I123", "x"), ("I123", "y"), ("I2", "z")]


def test_exact_quantiles_type7(spark):
    rng = np.random.default_rng(7)
    rows = [("a" if i % 3 else "b", "v", float(rng.integers(0, 30))) for i in range(301)]
    df = spark.createDataFrame(rows, "stratum string, variable string, value double")
    got = {(r.stratum, r.p): r.q for r in D.exact_quantiles(df, ["stratum", "variable"], [0.25, 0.5, 0.75], num_partitions=5).collect()}
    for s in "ab":
        xs = np.array([v for st, _, v in rows if st == s])
        for p in (0.25, 0.5, 0.75):
            assert got[(s, p)] == pytest.approx(np.quantile(xs, p))  # numpy default = type 7


def test_per_patient_index_date(spark):
    """The index date may be a column (one per patient) instead of a constant."""
    e = spark.createDataFrame(
        [("p", "sbp", dt.date(2020, 1, 10), 1.0, dt.date(2020, 1, 1)),
         ("p", "sbp", dt.date(2019, 12, 30), 2.0, dt.date(2020, 1, 1)),
         ("q", "sbp", dt.date(2010, 1, 3), 3.0, dt.date(2010, 1, 1)),
         ("q", "sbp", dt.date(2010, 1, 20), 4.0, dt.date(2010, 1, 1))],
        "patid string, concept string, date date, value double, index_date date")
    got = picked(B.nearest_to_index(e, F.col("index_date")))
    assert got == {("p", "sbp"): (2.0, -2), ("q", "sbp"): (3.0, 2)}
    long = {r.patid: r for r in FT.event_dates(e, F.col("index_date")).collect()}
    assert long["p"].latest_pre == dt.date(2019, 12, 30) and long["q"].earliest_pre is None


def test_materialize_reads_back_only_committed(spark):
    from cohortsmith.sources import store as S
    df = spark.createDataFrame([(1,)], "x int")
    name = "probe_" + str(abs(hash(str(dt.datetime.now()))))
    assert S.read_stored(spark, "tests", name) is None
    S.materialize(df, name, namespace="tests")
    again = S.materialize(spark.createDataFrame([(2,)], "x int"), name, namespace="tests")
    assert [r.x for r in again.collect()] == [1]  # stored copy, not re-evaluated


def test_materialize_refresh_and_snapshots(spark):
    from cohortsmith.sources import store as S
    name = "probe_refresh_" + str(abs(hash(str(dt.datetime.now()))))
    S.materialize(spark.createDataFrame([(1,)], "x int"), name, namespace="tests")
    again = S.materialize(spark.createDataFrame([(2,)], "x int"), name, namespace="tests", refresh=True)
    assert [r.x for r in again.collect()] == [2]
    S.write_snapshot(spark.createDataFrame([(1,)], "x int"), name, dt.date(2025, 7, 10))
    S.write_snapshot(spark.createDataFrame([(2,)], "x int"), name, dt.date(2025, 7, 11))
    assert [r.x for r in S.read_snapshot(spark, name).collect()] == [2]
    assert [r.x for r in S.read_snapshot(spark, name, dt.date(2025, 7, 10)).collect()] == [1]
