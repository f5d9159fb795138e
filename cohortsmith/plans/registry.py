"""Query registry: one Spark plan and one independent DuckDB query per operator key.

Every Spark query reads the driver's tables through ``Warehouse`` (its work grows with
them).  DOUBLE outputs are rounded to 6 places on both sides so the two engines compare
equal despite last-bit differences in sums and powers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..operators import baseline as B
from ..operators import cohort as CO
from ..operators import describe as D
from ..operators import events as E
from ..operators import features as FT
from ..operators import measures as M
from ..operators import sketches as SK
from ..session import ensure_store
from ..sources import codelists as CL
from ..sources import store as S
from ..sources import tables as TW
from ..sources import fixtures as X
from ..sources.adapter import Warehouse
from . import oracle as O
from .pipeline import CohortBuild

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(F.round(c, places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else c)
    return df.select(*cols)


_BUILDS: dict[tuple[str, str, str], CohortBuild] = {}  # (application, path, data version)


def build_for(spark: SparkSession, sf_dir: str) -> CohortBuild:
    wh = Warehouse(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, wh.version)
    if key not in _BUILDS:
        _BUILDS[key] = CohortBuild(wh, deficits=X.efi_deficits())
    return _BUILDS[key]


def query(key: str, sql_final: str, doubles=()):
    """Register a Spark query (rounded) with its oracle SQL."""
    sql = O.build(f"SELECT {O.rounded(doubles)} FROM ({sql_final}) AS q")

    def deco(fn: Callable[[CohortBuild], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(build_for(spark, sf_dir)))
        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        SQL[key] = sql
        return fn
    return deco


IDX = C.INDEX_DATE
LABEL = C.period_label(IDX)
BIO_VALUES = [f"pre{c}" for c in C.baseline_concepts() + [C.HBA1C]] + ["height"]
XS_DOUBLES = BIO_VALUES + ["index_date_age", "index_date_dm_dur_all"]

# ---------------------------------------------------------------------------------------
# scans, sources, sinks
# ---------------------------------------------------------------------------------------


@query("scan_observation", "SELECT * FROM observation", ["testvalue"])
def _scan_observation(b: CohortBuild) -> DataFrame:
    return b.wh.observation


@query("scan_drug_issue", "SELECT * FROM drug_issue")
def _scan_drug_issue(b):
    return b.wh.drug_issue


@query("spine", "SELECT patid FROM spine")
def _spine(b):
    return b.spine


@query("valid_dates", """SELECT r.* FROM raw_meas r JOIN valid_dates v ON r.patid = v.patid
  WHERE r.date >= v.min_dob AND r.date <= v.gp_end_date""", ["value"])
def _valid_dates(b):
    return E.restrict_to_registration(b.raw_measurements, b.wh.valid_dates)


@query("valid_dates_alt_end", """SELECT r.* FROM raw_meas r JOIN valid_dates v ON r.patid = v.patid
  WHERE r.date >= v.min_dob AND r.date <= v.gp_ons_end_date""", ["value"])
def _valid_dates_alt_end(b):
    return E.restrict_to_registration(b.raw_measurements, b.wh.valid_dates, end_col="gp_ons_end_date")


@query("codelist_version", "SELECT * FROM codes21")
def _codelist_version(b):
    return CL.codelist_version(b.wh.codelists, C.VERSION_2021)


@query("codelist_list", "SELECT concept, version, code_system, count(*) AS n_codes FROM codelists GROUP BY concept, version, code_system")
def _codelist_list(b):
    return CL.codelist_list(b.wh.codelists)


@query("codelist_precedence", f"""SELECT concept, version, code_system, code FROM codelists WHERE concept IN {O._in(C.COMORBIDITIES)}
  AND (version = {O.V21} OR (version = {O.V24} AND concept NOT IN (SELECT concept FROM codelists WHERE version = {O.V21})))""")
def _codelist_precedence(b):
    prec = CL.codelist_precedence(b.wh.codelists, [C.VERSION_2021, C.VERSION_2024])
    return prec.filter(F.col("concept").isin(C.COMORBIDITIES)).select("concept", "version", "code_system", "code")


@query("codelist_prefix", "SELECT concept, code_system, code FROM codes24 WHERE starts_with(concept, 'efi_')")
def _codelist_prefix(b):
    return CL.codelist_prefix(b.codes_2024, C.EFI_PREFIX).select("concept", "code_system", "code")


@query("codelist_tsv", """SELECT o.*, CAST(NULL AS VARCHAR) AS potassium_cat FROM observation o
  JOIN (SELECT code FROM codes24 WHERE concept = 'potassium' AND code_system = 'medcode') c ON o.medcodeid = c.code""",
       ["testvalue"])
def _codelist_tsv(b):
    """Potassium codes written as a tab-separated file, read back with every column as text,
    renamed, narrowed and given an all-NULL column, then joined to the observations."""
    spark = b.wh.spark
    codes = E.select_codes(b.codes_2024, code_system="medcode", concepts=["potassium"])
    tsv = codes.select(F.col("code").alias("MedCodeId"), F.concat(F.lit("potassium code "), "code").alias("Term"))
    path = f"{ensure_store(spark).rstrip('/')}/tsv/potassium_{b.tag}"
    CL.write_codelist_tsv(tsv, path)
    lst = (CL.read_codelist_tsv(spark, path, ["MedCodeId", "Term"])
             .withColumnRenamed("MedCodeId", "medcodeid").select("medcodeid")
             .withColumn("potassium_cat", F.lit(None).cast("string")))
    return b.wh.observation.join(lst, "medcodeid").select(
        "patid", "obsdate", "medcodeid", "testvalue", "numunitid", "potassium_cat")


@query("unit_nullsafe_join", f"""SELECT r.patid, r.obsdate, r.testvalue, r.numunitid FROM observation r
  JOIN (SELECT code FROM codes24 WHERE concept = 'potassium' AND code_system = 'medcode') c ON r.medcodeid = c.code
  JOIN (SELECT CAST(u AS INTEGER) AS numunitid FROM (VALUES (218), (425), (NULL)) AS t(u)) w
    ON r.numunitid IS NOT DISTINCT FROM w.numunitid
  WHERE r.testvalue >= {C.POTASSIUM_LO} AND r.testvalue <= {C.POTASSIUM_HI}""", ["testvalue"])
def _unit_nullsafe_join(b):
    """Potassium: fixed limits, then an inner join to a small inline unit list containing NULL
    with NULL matching NULL."""
    spark = b.wh.spark
    codes = E.select_codes(b.codes_2024, code_system="medcode", concepts=["potassium"]).select("code")
    raw = b.wh.observation.join(codes, F.col("medcodeid") == F.col("code"), "left_semi")
    raw = raw.filter(F.col("testvalue").between(C.POTASSIUM_LO, C.POTASSIUM_HI))
    units = spark.createDataFrame([(u,) for u in C.POTASSIUM_UNITS], "u int")
    j = raw.join(F.broadcast(units), raw["numunitid"].eqNullSafe(units["u"]))  # fixed 3-row table
    return j.select("patid", "obsdate", "testvalue", "numunitid")


@query("materialize_once", "SELECT * FROM raw_meas", ["value"])
def _materialize_once(b):
    """Coded measurements written once under a name; later calls read the stored table."""
    return S.materialize(b.raw_measurements, f"raw_measurements_{S.plan_digest(b.raw_measurements)}", namespace="all_patid")


_KEYED = ["biomarkers", "stage", "comorbidities", "medications", "efi", "cross_section"]
_key_sql = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, "
    f"(SELECT count(DISTINCT patid) FROM {t}) AS n_keys, "
    f"(SELECT count(*) FROM (SELECT patid FROM {t} GROUP BY patid HAVING count(*) > 1)) AS n_dup_keys"
    for t in _KEYED)


@query("unique_key_check", _key_sql)
def _unique_key_check(b):
    tabs = {"biomarkers": b.biomarkers, "stage": b.stage, "comorbidities": b.comorbidities,
            "medications": b.medications, "efi": b.efi, "cross_section": b.cross_section()}
    out = None
    for name, df in tabs.items():
        s = S.key_summary(df.select("patid"), name).withColumnRenamed("table", "table_name")
        out = s if out is None else out.unionByName(s)
    return out


@query("snapshot_roundtrip", "SELECT * FROM stage")
def _snapshot_roundtrip(b):
    """Stage table written as a dated snapshot and read back by picking the latest stamp."""
    name = f"ckd_stage_{b.tag}"
    S.write_snapshot(b.stage, name, IDX - dt.timedelta(days=30))
    S.write_snapshot(b.stage, name, IDX)
    return S.read_snapshot(b.wh.spark, name)


# ---------------------------------------------------------------------------------------
# events: extraction, projection, sources
# ---------------------------------------------------------------------------------------
_all_med = f"""SELECT o.patid, c.concept, o.obsdate AS date, o.medcodeid AS code, o.testvalue AS value, o.numunitid
  FROM observation o JOIN codes24 c ON o.medcodeid = c.code WHERE c.code_system = 'medcode'"""


@query("coded_events", _all_med, ["value"])
def _coded_events(b):
    """Every medcode list of the 2024 catalogue against the observations in one scan."""
    codes = E.select_codes(b.codes_2024, code_system="medcode")
    return E.extract_events(b.wh.observation, codes, code_col="medcodeid", date_col="obsdate",
                            keep=[F.col("medcodeid").alias("code"), F.col("testvalue").alias("value"), "numunitid"])


@query("event_project", "SELECT patid, concept, date, code FROM com_gp")
def _event_project(b):
    return E.extract_events(b.wh.observation, b.comorbidity_codes, code_col="medcodeid",
                            date_col="obsdate", code_alias="code")


_hosp_sql = """SELECT h.patid, replace(c.concept, 'icd10_', '') AS concept, h.epistart AS date, h.ICD AS code,
  c.code AS prefix, h.d_order FROM hospital_diagnosis h JOIN codes24 c
  ON c.code_system = 'icd10' AND h.ICD LIKE c.code || '%' WHERE c.concept <> 'icd10_hypertension'"""
_proc_sql = """SELECT p.patid, replace(c.concept, 'opcs4_', '') AS concept, p.evdate AS date, p.OPCS AS code
  FROM hospital_procedure p JOIN codes24 c ON c.code_system = 'opcs4' AND p.OPCS = c.code"""


def _hosp_dx(b: CohortBuild) -> DataFrame:
    return E.hospital_diagnoses(b.wh.hospital_diagnosis, E.select_codes(b.codes_2024, code_system="icd10"))


def _hosp_proc(b: CohortBuild) -> DataFrame:
    return E.hospital_procedures(b.wh.hospital_procedure, E.select_codes(b.codes_2024, code_system="opcs4"))


@query("hosp_prefix_join", _hosp_sql)
def _hosp_prefix_join(b):
    return _hosp_dx(b)


@query("hosp_procedures", _proc_sql)
def _hosp_procedures(b):
    return _hosp_proc(b)


@query("hosp_primary_cause", f"SELECT patid, 'primary_hhf' AS concept, date, code, prefix, d_order FROM ({_hosp_sql}) x "
                             "WHERE concept = 'heartfailure' AND d_order = 1")
def _hosp_primary_cause(b):
    return E.primary_cause(_hosp_dx(b), "heartfailure", "primary_hhf")


_union_sql = f"""SELECT patid, concept, date, code, source FROM com_gp
  UNION ALL SELECT patid, concept, date, code, 'hes_icd10' FROM ({_hosp_sql}) h
  UNION ALL SELECT patid, concept, date, code, 'hes_opcs4' FROM ({_proc_sql}) p"""


def _all_sources(b: CohortBuild) -> DataFrame:
    gp = E.extract_events(b.wh.observation, b.comorbidity_codes, code_col="medcodeid",
                          date_col="obsdate", code_alias="code")
    return E.tag_sources({"gp": gp, "hes_icd10": _hosp_dx(b).select("patid", "concept", "date", "code"),
                          "hes_opcs4": _hosp_proc(b)})


@query("tag_union_sources", _union_sql)
def _tag_union_sources(b):
    return _all_sources(b)


@query("valid_dates_by_source", f"""SELECT u.* FROM ({_union_sql}) u JOIN valid_dates v ON u.patid = v.patid
  WHERE u.date >= v.min_dob AND ((u.source = 'gp' AND u.date <= v.gp_ons_end_date)
    OR ((u.source = 'hes_icd10' OR u.source = 'hes_opcs4') AND (v.gp_ons_death_date IS NULL OR u.date <= v.gp_ons_death_date)))""")
def _valid_dates_by_source(b):
    return E.restrict_by_source(_all_sources(b), b.wh.valid_dates, hospital=True)


@query("drug_class_split", "SELECT * FROM oha_split")
def _drug_class_split(b):
    return b.oha_events


@query("coded_drug_events", "SELECT * FROM drug5_clean")
def _coded_drug_events(b):
    return b.drug_events


@query("insulin_events", "SELECT * FROM insulin_clean")
def _insulin_events(b):
    return b.insulin_events


@query("insulin_with_combos", """SELECT patid, date FROM insulin_clean UNION ALL
  SELECT o.patid, o.issuedate AS date FROM drug_issue o JOIN drug_class_lookup l ON o.prodcodeid = l.prodcodeid
  JOIN valid_dates v ON o.patid = v.patid WHERE l.INS = 1 AND o.issuedate >= v.min_dob AND o.issuedate <= v.gp_end_date""")
def _insulin_with_combos(b):
    lk = b.wh.drug_class_lookup.filter(F.col("INS") == 1).select("prodcodeid")
    combos = b.wh.drug_issue.join(lk, "prodcodeid", "left_semi").select("patid", F.col("issuedate").alias("date"))
    combos = E.restrict_to_registration(combos, b.wh.valid_dates)
    return b.insulin_events.select("patid", "date").unionByName(combos)


# ---------------------------------------------------------------------------------------
# measurements
# ---------------------------------------------------------------------------------------


@query("clean_value_range", "SELECT * FROM meas_lim", ["value"])
def _clean_value_range(b):
    return M.apply_value_limits(M.convert_hba1c(b.raw_measurements), b.wh.value_limits)


@query("daily_mean", "SELECT * FROM meas_daily", ["value"])
def _daily_mean(b):
    ev = M.apply_unit_whitelist(M.apply_value_limits(M.convert_hba1c(b.raw_measurements), b.wh.value_limits),
                                b.wh.unit_whitelist)
    return M.daily_mean(ev)


@query("clean_measurements", "SELECT * FROM clean", ["value"])
def _clean_measurements(b):
    return b.clean


@query("hba1c_clean", "SELECT * FROM clean WHERE concept = 'hba1c'", ["value"])
def _hba1c_clean(b):
    return b.clean.filter(F.col("concept") == C.HBA1C)


@query("acr_from_separate", "SELECT * FROM acr_sep", ["value"])
def _acr_from_separate(b):
    return b.acr_from_separate


@query("egfr", "SELECT * FROM egfr", ["value"])
def _egfr(b):
    return b.egfr


@query("baseline_nearest", "SELECT * FROM baseline", ["value"])
def _baseline_nearest(b):
    return b.baseline_long


@query("baseline_nearest_window", "SELECT * FROM baseline", ["value"])
def _baseline_nearest_window(b):
    concepts = C.baseline_concepts() + [C.HBA1C]
    return B.nearest_to_index_window(b.all_measures.filter(F.col("concept").isin(concepts)), IDX)


@query("height_post_mean", "SELECT * FROM height", ["height"])
def _height_post_mean(b):
    return b.height


@query("biomarker_features", "SELECT * FROM biomarkers", BIO_VALUES)
def _biomarker_features(b):
    return b.biomarkers


@query("second_value", f"""SELECT patid, value AS preacr_secondvalue FROM (
  SELECT m.patid, m.value, row_number() OVER (PARTITION BY m.patid ORDER BY date_diff('day', b.date, m.date), m.value) AS rn
  FROM measures m JOIN (SELECT patid, date FROM baseline WHERE concept = 'acr') b ON m.patid = b.patid
  WHERE m.concept IN ('acr', 'acr_from_separate')
    AND date_diff('day', b.date, m.date) BETWEEN {C.BASELINE_LO} AND {C.BASELINE_HI}
    AND date_diff('day', b.date, m.date) <> 0) x WHERE rn = 2""", ["preacr_secondvalue"])
def _second_value(b):
    acr_long = b.all_measures.filter(F.col("concept").isin("acr", "acr_from_separate"))
    base = b.baseline_long.filter(F.col("concept") == "acr")
    return B.second_value(acr_long, base)


# ---------------------------------------------------------------------------------------
# event-date features, stage, frailty
# ---------------------------------------------------------------------------------------


@query("event_dates", "SELECT * FROM com_long")
def _event_dates(b):
    return FT.event_dates(b.comorbidity_dates, IDX)


@query("event_dates_wide", "SELECT * FROM med_w")
def _event_dates_wide(b):
    long = FT.event_dates(b.medication_dates, IDX)
    return FT.to_wide(long, C.medication_concepts(), {
        "earliest_pre": f"pre_{LABEL}_earliest_{{c}}", "latest_pre": f"pre_{LABEL}_latest_{{c}}",
        "first_post": f"post_{LABEL}_first_{{c}}"})


@query("event_flags", "SELECT * FROM com_flags")
def _event_flags(b):
    return FT.event_flags(b.comorbidity_dates, b.spine, IDX, C.COMORBIDITIES)


@query("comorbidity_features", "SELECT * FROM comorbidities")
def _comorbidity_features(b):
    return b.comorbidities


@query("comorbidity_features_hospital", "SELECT * FROM comorbidities_hosp")
def _comorbidity_features_hospital(b):
    """Dormant option: comorbidities from GP and hospital sources (prefix-matched ICD-10,
    OPCS-4, primary-cause heart failure) with the source-aware validity rule."""
    return b.with_options(hospital=True).comorbidities


@query("medication_features", "SELECT * FROM medications")
def _medication_features(b):
    return b.medications


@query("stage_at_index", "SELECT * FROM stage")
def _stage_at_index(b):
    return b.stage


@query("efi", "SELECT * FROM efi", ["pre_index_date_efi_score"])
def _efi(b):
    return b.efi


# ---------------------------------------------------------------------------------------
# cohort, cross-section, analysis extract
# ---------------------------------------------------------------------------------------


@query("prevalent_cohort", "SELECT * FROM cohort_ids")
def _prevalent_cohort(b):
    return b.cohort_ids()


@query("prevalent_cohort_linked", "SELECT * FROM cohort_ids_linked")
def _prevalent_cohort_linked(b):
    return b.cohort_ids(linked_only=True)


@query("cross_section", "SELECT * FROM cross_section", XS_DOUBLES)
def _cross_section(b):
    return b.cross_section()


@query("cross_section_efi", "SELECT * FROM cross_section_efi", XS_DOUBLES + ["pre_index_date_efi_score"])
def _cross_section_efi(b):
    return b.cross_section(with_efi=True)


@query("cross_section_hospital", "SELECT * FROM xs_hospital", XS_DOUBLES)
def _cross_section_hospital(b):
    """Hospital sources in the cross-section, stored beside the primary-care one."""
    b.cross_section()
    return b.with_options(hospital=True).cross_section()


@query("cross_section_linked", "SELECT * FROM xs_linked", XS_DOUBLES)
def _cross_section_linked(b):
    b.cross_section()
    return b.with_options(linked_only=True).cross_section()


@query("cross_section_custom_efi", "SELECT * FROM xs_custom", XS_DOUBLES + ["pre_index_date_efi_score"])
def _cross_section_custom_efi(b):
    b.cross_section(with_efi=True)
    return b.with_options(deficits=O.CUSTOM_DEFICITS).cross_section(with_efi=True)


@query("events_datediff", f"SELECT *, {O._dd('date', O.IDX)} AS datediff FROM com_ev")
def _events_datediff(b):
    return E.with_datediff(b.comorbidity_events, IDX)


@query("treatment_flags", "SELECT patid, " + ", ".join(CO.TREATMENT_FLAG_COLUMNS) + " FROM flagged", ["uacr"])
def _treatment_flags(b):
    return CO.treatment_flags(b.cross_section(), LABEL).select("patid", *CO.TREATMENT_FLAG_COLUMNS)


def _restricted(b: CohortBuild) -> DataFrame:
    return CO.restrict_cohort(CO.treatment_flags(b.cross_section(), LABEL))


@query("restrict_cohort", "SELECT * FROM restricted", XS_DOUBLES + ["uacr"])
def _restrict_cohort(b):
    return _restricted(b)


@query("missing_cohort", "SELECT * FROM missing_uacr", XS_DOUBLES + ["uacr"])
def _missing_cohort(b):
    return CO.missing_cohort(_restricted(b))


@query("missingness", """SELECT 'uacr' AS variable, round_even(100.0 * avg(CASE WHEN uacr IS NULL THEN 1.0 ELSE 0.0 END), 0) AS pct_missing FROM restricted
  UNION ALL SELECT 'preegfr', round_even(100.0 * avg(CASE WHEN preegfr IS NULL THEN 1.0 ELSE 0.0 END), 0) FROM restricted""",
       ["pct_missing"])
def _missingness(b):
    return D.missingness(_restricted(b), ["uacr", "preegfr"])


@query("stage_zero", "SELECT patid, preckdstage, uacr, preegfr, any_ckd FROM stage_zero", ["uacr", "preegfr"])
def _stage_zero(b):
    return CO.recode_stage_zero(_restricted(b)).select("patid", "preckdstage", "uacr", "preegfr", "any_ckd")


@query("prune_columns", "SELECT * FROM pruned", XS_DOUBLES + ["uacr"])
def _prune_columns(b):
    return b.analysis_ready()


@query("eligibility", "SELECT * FROM eligible", XS_DOUBLES + ["uacr", "prepotassium_noNA"])
def _eligibility(b):
    return b.with_eligibility()


_CONT = [v for v in C.TABLE_ONE_VARS if v not in C.TABLE_ONE_FACTORS]
_S = C.TABLE_ONE_STRATA
_long_cont = " UNION ALL ".join(
    f"SELECT CAST({_S} AS VARCHAR) AS stratum, '{v}' AS variable, CAST({v} AS DOUBLE) AS value FROM eligible WHERE {_S} IS NOT NULL"
    for v in _CONT)
_long_cat = " UNION ALL ".join(
    f"SELECT CAST({_S} AS VARCHAR) AS stratum, '{v}' AS variable, CAST({v} AS VARCHAR) AS value FROM eligible WHERE {_S} IS NOT NULL"
    for v in C.TABLE_ONE_FACTORS)
_nn = O._in(C.TABLE_ONE_NONNORMAL)


_cont_sql = f"""SELECT stratum, variable, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS sd,
  CASE WHEN variable IN {_nn} THEN quantile_cont(value, 0.25) END AS p25,
  CASE WHEN variable IN {_nn} THEN quantile_cont(value, 0.5) END AS median,
  CASE WHEN variable IN {_nn} THEN quantile_cont(value, 0.75) END AS p75
  FROM ({_long_cont}) l GROUP BY stratum, variable"""
_cat_sql = f"""SELECT stratum, variable, level, n,
  100.0 * CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY stratum, variable) AS DOUBLE) AS pct FROM (
  SELECT stratum, variable, value AS level, count(*) AS n FROM ({_long_cat}) l WHERE value IS NOT NULL
  GROUP BY stratum, variable, value) c"""
_n_sql = f"SELECT CAST({_S} AS VARCHAR) AS stratum, count(*) AS n FROM eligible WHERE {_S} IS NOT NULL GROUP BY 1"


@query("table_one_continuous", _cont_sql, ["mean", "sd", "p25", "median", "p75"])
def _table_one_continuous(b):
    return D.table_one_continuous(b.with_eligibility(), _CONT, _S, C.TABLE_ONE_NONNORMAL)


@query("table_one_categorical", _cat_sql, ["pct"])
def _table_one_categorical(b):
    return D.table_one_categorical(b.with_eligibility(), C.TABLE_ONE_FACTORS, _S)


@query("table_one_n", _n_sql)
def _table_one_n(b):
    return D.table_one_n(b.with_eligibility(), _S)


_none = "CAST(NULL AS DOUBLE)"


@query("table_one", f"""SELECT 'n' AS part, stratum, CAST(NULL AS VARCHAR) AS variable, CAST(NULL AS VARCHAR) AS level, n,
    {_none} AS mean, {_none} AS sd, {_none} AS p25, {_none} AS median, {_none} AS p75, {_none} AS pct FROM ({_n_sql}) a
  UNION ALL SELECT 'continuous', stratum, variable, NULL, n, mean, sd, p25, median, p75, NULL FROM ({_cont_sql}) b
  UNION ALL SELECT 'categorical', stratum, variable, level, n, NULL, NULL, NULL, NULL, NULL, pct FROM ({_cat_sql}) c""",
       ["mean", "sd", "p25", "median", "p75", "pct"])
def _table_one(b):
    return D.table_one(b.with_eligibility(), C.TABLE_ONE_VARS, _S, factors=C.TABLE_ONE_FACTORS, nonnormal=C.TABLE_ONE_NONNORMAL)


@query("warehouse_tables_roundtrip", "SELECT * FROM biomarkers", BIO_VALUES)
def _warehouse_tables_roundtrip(b):
    """Every domain table written to Parquet, read back by name through ``TableWarehouse`` with
    its declared schema, and the biomarker features built from those tables: of the coded events
    the measurements' lists are extracted, which those features read."""
    paths = TW.write_tables(b.wh, f"{ensure_store(b.wh.spark).rstrip('/')}/warehouse/{b.tag}")
    return CohortBuild(TW.TableWarehouse(b.wh.spark, paths), deficits=X.efi_deficits(), on_demand=True).biomarkers


# ---------------------------------------------------------------------------------------
# lists added to what is stored, own index dates, landmarks, attrition, sketches, names
# ---------------------------------------------------------------------------------------


@query("coded_events_added_list", "SELECT patid, concept, date, value, numunitid FROM raw_meas", ["value"])
def _coded_events_added_list(b):
    """All measurement lists but HbA1c stored first; adding HbA1c then extracts that list alone and
    appends it; the events of all lists are read back."""
    codes = b.observation_codes.filter(F.col("family") == "measure")
    store, _, schema = b._coded("added_list", b._extract_observations, codes.filter(F.col("concept") != C.HBA1C))
    runs = store.ensure(codes)
    return store.read(runs, schema).select("patid", "concept", "date", "value", "numunitid")


def own_index_dates(b: CohortBuild) -> DataFrame:
    """A fixture of one index date per patient: up to 200 days about the common one."""
    days = (F.col("patid").cast("long") % 400 - 200).cast("int")
    return b.wh.patient.select("patid", F.date_add(F.lit(IDX), days).alias("index_date"))


_BY_PATIENT: dict[int, CohortBuild] = {}


def _by_patient(b: CohortBuild) -> CohortBuild:
    if id(b) not in _BY_PATIENT:
        _BY_PATIENT[id(b)] = b.with_options(index_dates=own_index_dates(b))
    return _BY_PATIENT[id(b)]


_OWN = f"(SELECT patid, {O.IDX} + CAST(CAST(patid AS BIGINT) % 400 - 200 AS INTEGER) AS own FROM spine)"
_near = lambda rows: f"""SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY patid, concept, own ORDER BY abs(datediff),
  CASE WHEN concept IN {O._in(C.PREFER_MAX)} THEN -value ELSE value END, datediff) AS place FROM ({rows}) w
  WHERE datediff BETWEEN {C.BASELINE_LO} AND {C.BASELINE_HI}) r WHERE place = 1"""  # noqa: E731


@query("baseline_nearest_by_patient", "SELECT * EXCLUDE (own) FROM (" + _near(f"""SELECT m.patid, m.concept, m.value, m.date,
  {O._dd('m.date', 'i.own')} AS datediff, i.own FROM measures m JOIN {_OWN} i ON m.patid = i.patid
  WHERE m.value IS NOT NULL AND m.concept IN {O._in(C.baseline_concepts() + [C.HBA1C])}""") + ") q", ["value"])
def _baseline_nearest_by_patient(b):
    """Nearest values about each patient's own index date, a column of the spine."""
    return _by_patient(b).baseline_long


@query("event_dates_by_patient", f"""SELECT e.patid, concept, min(date) FILTER (date <= own) AS earliest_pre,
  max(date) FILTER (date <= own) AS latest_pre, min(date) FILTER (date > own) AS first_post
  FROM com_ev e JOIN {_OWN} i ON e.patid = i.patid GROUP BY e.patid, concept""")
def _event_dates_by_patient(b):
    own = _by_patient(b)
    return FT.event_dates(own._indexed(own.comorbidity_dates), own.index)


LANDMARKS = [IDX + dt.timedelta(days=n) for n in (-730, -365, 0, 365)]
_marks = "[" + ", ".join(f"DATE '{d.isoformat()}'" for d in LANDMARKS) + "]"
_asof = lambda op: f"""SELECT l.patid, l.concept, m.value, m.date, {O._dd('m.date', 'l.own')} AS datediff, l.own
  FROM (SELECT patid, concept, unnest({_marks}) AS own FROM spine, (SELECT unnest({list(C.baseline_concepts() + [C.HBA1C])!r}) AS concept) c) l
  ASOF JOIN (SELECT * FROM measures WHERE value IS NOT NULL) m ON l.patid = m.patid AND l.concept = m.concept AND l.own {op} m.date"""  # noqa: E731


@query("baseline_nearest_landmarks", "SELECT * RENAME (own AS landmark) FROM (" + _near(f"{_asof('>=')} UNION ALL {_asof('<')}") + ") q", ["value"])
def _baseline_nearest_landmarks(b):
    """Nearest values at four index dates from one sweep over events and landmarks."""
    return b.baseline_landmarks(LANDMARKS)


def _steps(rules: list[tuple[str, str]], table: str) -> str:
    """Rows and patients left after each rule, by one query per step."""
    out, cond = [], "TRUE"
    for k, (name, rule) in enumerate([("all", "TRUE"), *rules]):
        cond = f"{cond} AND ({rule})"
        out.append(f"SELECT {k} AS step, '{name}' AS rule, count(*) AS n_rows, count(DISTINCT patid) AS n_patients FROM {table} WHERE {cond}")
    return " UNION ALL ".join(out)


@query("measurement_attrition", _steps([
    ("value in limits", "value >= lo AND value <= hi"), ("unit listed", "unit"),
    ("HbA1c after the floor", f"concept <> 'hba1c' OR year(date) >= {C.HBA1C_MIN_YEAR}"), ("registered", "date >= min_dob AND date <= gp_end_date")],
    """(SELECT r.*, l.lo, l.hi, v.min_dob, v.gp_end_date, EXISTS (SELECT 1 FROM unit_whitelist u WHERE u.concept = r.concept
        AND u.numunitid IS NOT DISTINCT FROM r.numunitid) AS unit
      FROM meas_conv r LEFT JOIN value_limits l ON r.concept = l.concept LEFT JOIN valid_dates v ON r.patid = v.patid)"""))
def _measurement_attrition(b):
    return b.measurement_attrition()


@query("cohort_attrition", _steps([
    ("diagnosed", f"dm_diag_date_all <= {O.IDX}"), ("registration begun", f"regstartdate <= {O.IDX}"),
    ("registration lasting", f"gp_record_end >= {O.IDX}"), ("alive", f"death_date IS NULL OR death_date >= {O.IDX}"),
    ("type 2", "diabetes_type = 'type 2'"), ("treated", "ncurrtx > 0"), ("no stage 5 code", "NOT pre_index_date_ckd5_code"),
    ("stage known and not 5", "preckdstage <> 'stage_5'"), ("eGFR known", "preegfr IS NOT NULL"), ("uACR known", "uacr IS NOT NULL"),
    ("kidney disease", f"NOT (preckdstage IN {O._in(C.STAGE_ZERO_FROM)} AND uacr < {C.ELIG_UACR})")],
    """(SELECT c.patid, c.dm_diag_date_all, c.regstartdate, c.gp_record_end, c.death_date, c.diabetes_type, f.ncurrtx, f.pre_index_date_ckd5_code,
        f.preckdstage, f.preegfr, f.uacr FROM diabetes_cohort c LEFT JOIN flagged f ON c.patid = f.patid)"""))
def _cohort_attrition(b):
    return b.cohort_attrition()


@query("table_one_sketched", f"""SELECT stratum, variable, count(value) AS n, TRUE AS p25_within, TRUE AS median_within, TRUE AS p75_within
  FROM ({_long_cont}) l WHERE value IS NOT NULL GROUP BY stratum, variable""")
def _table_one_sketched(b):
    """Quartiles from the merged sketches of two snapshots (two parts of the extract), held
    against the rows: their ranks lie within the stated bound."""
    merged = SK.merge_sketches(b.table_one_sketches(F.col("imd_decile") <= 5), b.table_one_sketches(F.col("imd_decile") > 5))
    return SK.rank_within(b.with_eligibility(), _CONT, _S, SK.table_one_sketched(merged), SK.rank_error())


@query("read_derived_by_name", "SELECT * FROM biomarkers", BIO_VALUES)
def _read_derived_by_name(b):
    """The biomarker table read by its plain name in a second session, which builds nothing."""
    b.biomarkers
    return S.read_derived(b.wh.spark.newSession(), "biomarkers", b.wh.version, index_date=IDX)


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
