"""Independent DuckDB SQL for every registered query.

Written in the original step-by-step form (separate pre/post aggregates, three-step window
pick, one LEFT JOIN per concept) rather than the optimised Spark form, over the same
fixture rules as ``cohortsmith.sources.adapter``.  Each query is a WITH-list of the CTEs it
needs (dependency closure) plus a final SELECT; DOUBLE outputs are rounded to 6 places on
both sides.
"""

from __future__ import annotations

import re

from .. import config as C
from ..sources import fixtures as X

IDX = f"DATE '{C.INDEX_DATE.isoformat()}'"
V21 = f"DATE '{C.VERSION_2021.isoformat()}'"
V24 = f"DATE '{C.VERSION_2024.isoformat()}'"
LABEL = C.period_label(C.INDEX_DATE)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _days(base: str, n: str) -> str:
    return f"(DATE '{base}' + CAST({n} AS INTEGER))"


def _dd(end: str, start: str) -> str:
    """Signed days end - start as INTEGER."""
    return f"CAST(date_diff('day', {start}, {end}) AS INTEGER)"


def _case(expr: str, pairs, cast: str | None = None) -> str:
    body = " ".join(f"WHEN {k} THEN {v}" for k, v in pairs)
    out = f"CASE {expr} {body} END"
    return f"CAST({out} AS {cast})" if cast else out


def _values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return _q(v)
        return repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(cols)})"


CTE: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTE[name] = sql


# ---------------------------------------------------------------------------------------
# adapter rules (same arithmetic as sources/adapter.py)
# ---------------------------------------------------------------------------------------
_dob = _days("1920-01-01", "(k * 7919) % 22000")
cte("cust", "SELECT c_custkey AS k, c_nationkey FROM customer")
cte("dates", f"""SELECT k, c_nationkey, CAST(k AS VARCHAR) AS patid, {_dob} AS dob,
  CASE WHEN k % 20 = 0 THEN DATE '1997-01-01' ELSE {_dob} END AS min_dob,
  {_days('1998-06-01', '(k * 31) % 1200')} AS gp_end_date,
  CASE WHEN k % 11 = 0 THEN {_days('1998-01-01', '(k * 17) % 1200')} END AS death
  FROM cust""")
_gender = "CAST(CASE WHEN k % 50 = 0 THEN 3 WHEN k % 2 = 0 THEN 1 ELSE 2 END AS INTEGER)"
cte("patient", f"SELECT CAST(k AS VARCHAR) AS patid, {_gender} AS gender FROM cust")
cte("spine", "SELECT patid FROM patient")
cte("dob", "SELECT patid, dob FROM dates")
cte("valid_dates", """SELECT patid, min_dob, gp_end_date, least(gp_end_date, death) AS gp_ons_end_date,
  death AS gp_ons_death_date FROM dates""")
cte("diabetes_cohort", f"""SELECT patid, dob, {_gender} AS gender,
  {_days('1985-01-01', '(k * 13) % 5500')} AS dm_diag_date_all,
  {_days('1990-01-01', '(k * 29) % 3600')} AS regstartdate,
  gp_end_date AS gp_record_end, death AS death_date,
  CAST(k % 3 <> 0 AS INTEGER) AS with_hes,
  CASE WHEN k % 10 = 0 THEN 'type 1' ELSE 'type 2' END AS diabetes_type,
  CAST(CASE WHEN c_nationkey % 6 <> 5 THEN c_nationkey % 6 END AS INTEGER) AS ethnicity_5cat,
  CAST(1 + k % 10 AS INTEGER) AS imd_decile,
  CAST(k % 7 = 0 AS INTEGER) AS ins_in_1_year,
  CAST(k % 5 = 0 AS INTEGER) AS has_insulin,
  CAST(k % 4 <> 0 AS INTEGER) AS current_oha
  FROM dates""")
_stage_names = ["stage_1", "stage_2", "stage_3a", "stage_3b", "stage_4", "stage_5"]
cte("stage_history", "SELECT CAST(k AS VARCHAR) AS patid, " + ", ".join(
    f"CASE WHEN (k + {s}) % 3 = 0 THEN {_days('1994-01-01', f'(k * {31 - 3 * s}) % 4000')} END AS {n}"
    for s, n in enumerate(_stage_names, start=1)) + " FROM cust")
cte("lines", """SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_shipdate,
  o.o_custkey, o.o_orderdate FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
_value = _case("p_type", [(_q(t), "(" + re.sub(r"\bq\b", "l_quantity", f) + ")")
                          for t, _, f in X.TYPE_CONCEPT], "DOUBLE")
cte("observation", f"""SELECT CAST(o_custkey AS VARCHAR) AS patid, CAST(o_orderdate AS DATE) AS obsdate,
  CAST(l_partkey AS VARCHAR) AS medcodeid, {_value} AS testvalue,
  {_case('l_linenumber % 4', [(1, 218), (2, 425), (3, 999)], 'INTEGER')} AS numunitid
  FROM lines LEFT JOIN part ON l_partkey = p_partkey""")
cte("drug_issue", """SELECT CAST(o_custkey AS VARCHAR) AS patid, CAST(l_shipdate AS DATE) AS issuedate,
  CAST(l_partkey AS VARCHAR) AS prodcodeid FROM lines""")
cte("hospital_diagnosis", """SELECT CAST(o_custkey AS VARCHAR) AS patid, CAST(l_shipdate AS DATE) AS epistart,
  'I' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') AS ICD, CAST(l_linenumber AS INTEGER) AS d_order FROM lines""")
cte("hospital_procedure", """SELECT CAST(o_custkey AS VARCHAR) AS patid, CAST(l_shipdate AS DATE) AS evdate,
  'K' || lpad(CAST(l_suppkey % 100 AS VARCHAR), 2, '0') AS OPCS FROM lines""")
cte("parts", """SELECT p_partkey, p_type, p_size, CAST(substring(p_brand, 7) AS INTEGER) AS brand,
  CAST(p_partkey AS VARCHAR) AS code FROM part""")
cte("dx_brands", _values(X.comorbidity_brands(), ["concept", "cb"]))
_meas_concept = _case("p_type", [(_q(t), _q(c)) for t, c, _ in X.TYPE_CONCEPT])
_size_concept = _case("p_size % 10", [(k, _q(c)) for k, c in X.SIZE_CONCEPT])
_efi_name = (f"CASE WHEN brand = {X.EFI_LONG_BRAND} THEN {_q(X.EFI_LONG_NAME)} "
             f"ELSE {_q(C.EFI_PREFIX)} || CAST(brand AS VARCHAR) END")
_drug = _case("p_partkey % 7", [(k, _q(c)) for k, c in X.DRUG_CODE])
_fixed = ([(C.VERSION_2024.isoformat(), c, "icd10", code) for c, code in X.icd10_rows()]
          + [(C.VERSION_2024.isoformat(), c, "opcs4", code) for c, code in X.opcs4_rows()])
cte("codelists", f"""
SELECT {V24} AS version, {_meas_concept} AS concept, 'medcode' AS code_system, code FROM parts
UNION ALL SELECT {V24}, {_size_concept}, 'medcode', code FROM parts WHERE p_size % 10 < {len(X.SIZE_CONCEPT)}
UNION ALL SELECT {V24}, {_q(X.THIRD_CONCEPT)}, 'medcode', code FROM parts WHERE p_partkey % {X.THIRD_EVERY} = 0
UNION ALL SELECT {V24}, b.concept, 'medcode', code FROM parts JOIN dx_brands b ON brand = b.cb
UNION ALL SELECT {V21}, b.concept, 'medcode', code FROM parts JOIN dx_brands b ON brand = b.cb
  WHERE b.cb <= 20 AND p_partkey % 2 = 0
UNION ALL SELECT {V24}, {_efi_name}, 'medcode', code FROM parts WHERE p_partkey % 4 = 0
""" + "".join(f"UNION ALL SELECT {V24}, {_q(n)}, 'medcode', code FROM parts WHERE p_partkey % 4 = {r} AND brand <= 3\n"
              for n, r in X.EFI_FORCED_RULES) + f"""
UNION ALL SELECT {V24}, {_drug}, 'prodcode', code FROM parts WHERE p_partkey % 7 < {len(X.DRUG_CODE)}
UNION ALL SELECT {V21}, {_drug}, 'prodcode', code FROM parts WHERE p_partkey % 7 < {len(X.DRUG_CODE)} AND p_partkey % 7 <> 5
UNION ALL SELECT CAST(version AS DATE), concept, code_system, code FROM ({_values(_fixed, ['version', 'concept', 'code_system', 'code'])})
""")
_cls = _case(f"p_size % {len(X.OHA_CLASS_BY_SIZE)}", [(i, _q(c)) for i, c in enumerate(X.OHA_CLASS_BY_SIZE)])
_sub = _case(f"p_partkey % {len(X.SEMA_BY_KEY)}", [(i, _q(c)) for i, c in enumerate(X.SEMA_BY_KEY)])
cte("drug_class_lookup", f"""SELECT code AS prodcodeid, {_cls} AS drug_class_1,
  CASE WHEN {_cls} = 'glp1' THEN {_sub} END AS drug_substance_2,
  CAST({_cls} = 'glp1' AND p_partkey % 5 = 0 AS INTEGER) AS INS FROM parts""")
cte("value_limits", f"SELECT concept, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi FROM ({_values(X.VALUE_LIMITS, ['concept', 'lo', 'hi'])})")
cte("unit_whitelist", f"SELECT concept, CAST(numunitid AS INTEGER) AS numunitid FROM ({_values(X.unit_rows(), ['concept', 'numunitid'])})")

# ---------------------------------------------------------------------------------------
# measurements
# ---------------------------------------------------------------------------------------
_BIO = C.BIOMARKERS + [C.HBA1C]
cte("codes24", f"SELECT * FROM codelists WHERE version = {V24}")
cte("codes21", f"SELECT * FROM codelists WHERE version = {V21}")
cte("raw_meas", f"""SELECT o.patid, c.concept, o.obsdate AS date, o.testvalue AS value, o.numunitid
  FROM observation o JOIN codes24 c ON o.medcodeid = c.code
  WHERE c.code_system = 'medcode' AND c.concept IN {_in(_BIO)}""")
cte("meas_conv", f"""SELECT patid, concept, date,
  CASE WHEN concept = 'hba1c' THEN (CASE WHEN value <= {C.HBA1C_PERCENT_MAX}
       THEN (value - {C.HBA1C_OFFSET}) / {C.HBA1C_SLOPE} ELSE value END) ELSE value END AS value,
  numunitid FROM raw_meas""")
cte("meas_lim", """SELECT r.patid, r.concept, r.date, r.value, r.numunitid FROM meas_conv r
  JOIN value_limits l ON r.concept = l.concept WHERE r.value >= l.lo AND r.value <= l.hi""")
cte("meas_unit", """SELECT m.* FROM meas_lim m JOIN unit_whitelist u
  ON m.concept = u.concept AND m.numunitid IS NOT DISTINCT FROM u.numunitid""")
cte("meas_daily", "SELECT patid, concept, date, avg(value) AS value FROM meas_unit GROUP BY patid, concept, date")
cte("clean", f"""SELECT d.patid, d.concept, d.date, d.value FROM meas_daily d JOIN valid_dates v ON d.patid = v.patid
  WHERE d.date >= v.min_dob AND d.date <= v.gp_end_date
    AND (d.concept <> 'hba1c' OR year(d.date) >= {C.HBA1C_MIN_YEAR})""")
cte("acr_ratio", """SELECT a.patid, 'acr_from_separate' AS concept, a.date, a.value / NULLIF(b.value, 0) AS value
  FROM clean a JOIN clean b ON a.patid = b.patid
  WHERE a.concept = 'albumin_urine' AND b.concept = 'creatinine_urine' AND a.date = b.date""")
cte("acr_sep", """SELECT r.* FROM acr_ratio r JOIN value_limits l ON l.concept = 'acr'
  WHERE r.value >= l.lo AND r.value <= l.hi""")
cte("egfr_in", f"""SELECT c.patid, c.date, c.value AS cr,
  CAST(date_diff('day', d.dob, c.date) AS DOUBLE) / CAST({C.DAYS_PER_YEAR} AS DOUBLE) AS age,
  CASE WHEN p.gender = 1 THEN 'male' WHEN p.gender = 2 THEN 'female' END AS sex
  FROM clean c JOIN dob d ON c.patid = d.patid JOIN patient p ON c.patid = p.patid
  WHERE c.concept = 'creatinine_blood'""")
cte("egfr_k", """SELECT patid, date, age, sex, (cr / 88.4) / (CASE WHEN sex = 'female' THEN 0.7 WHEN sex = 'male' THEN 0.9 END) AS ratio,
  CASE WHEN sex = 'female' THEN -0.241 WHEN sex = 'male' THEN -0.302 END AS alpha FROM egfr_in""")
cte("egfr_all", """SELECT patid, 'egfr' AS concept, date,
  142.0 * pow(least(ratio, 1.0), alpha) * pow(greatest(ratio, 1.0), -1.2) * pow(0.9938, age)
  * (CASE WHEN sex = 'female' THEN 1.012 WHEN sex = 'male' THEN 1.0 END) AS value FROM egfr_k""")
cte("egfr", "SELECT * FROM egfr_all WHERE value IS NOT NULL")
cte("measures", "SELECT * FROM clean UNION ALL SELECT * FROM acr_sep UNION ALL SELECT * FROM egfr")
_BASE = C.baseline_concepts() + [C.HBA1C]
cte("bw", f"""SELECT *, {_dd('date', IDX)} AS datediff FROM measures
  WHERE concept IN {_in(_BASE)} AND {_dd('date', IDX)} <= {C.BASELINE_HI} AND {_dd('date', IDX)} >= {C.BASELINE_LO}""")
cte("ranked", f"""SELECT *, row_number() OVER (PARTITION BY patid, concept ORDER BY abs(datediff),
  CASE WHEN concept IN {_in(C.PREFER_MAX)} THEN -value ELSE value END, datediff) AS place FROM bw WHERE value IS NOT NULL""")
cte("baseline", "SELECT patid, concept, value, date, datediff FROM ranked WHERE place = 1")
cte("height", f"SELECT patid, avg(value) AS height FROM clean WHERE concept = 'height' AND date >= {IDX} GROUP BY patid")
_bio_joins = "".join(
    f"\n  LEFT JOIN (SELECT patid, value AS pre{c}, date AS pre{c}date, datediff AS pre{c}datediff "
    f"FROM baseline WHERE concept = {_q(c)}) USING (patid)" for c in C.baseline_concepts())
cte("biomarkers", f"""SELECT * FROM spine{_bio_joins}
  LEFT JOIN height USING (patid)
  LEFT JOIN (SELECT patid, value AS prehba1c, date AS prehba1cdate, datediff AS prehba1cdatediff
             FROM baseline WHERE concept = 'hba1c') USING (patid)""")

# ---------------------------------------------------------------------------------------
# stage
# ---------------------------------------------------------------------------------------
_stage = " ".join(f"WHEN {s} IS NOT NULL AND {_dd(s, IDX)} <= {C.CKD_GRACE_DAYS} THEN {_q(s)}"
                  for s in C.CKD_STAGES)
_stage_date = " ".join(f"WHEN preckdstage = {_q(s)} THEN {s}" for s in C.CKD_STAGES)
cte("stage0", f"SELECT s.patid, h.*, CASE {_stage} END AS preckdstage FROM spine s LEFT JOIN stage_history h ON s.patid = h.patid")
cte("stage1", f"SELECT patid, preckdstage, CASE {_stage_date} END AS preckdstagedate FROM stage0")
cte("stage", f"SELECT patid, preckdstage, preckdstagedate, {_dd('preckdstagedate', IDX)} AS preckdstagedatediff FROM stage1")

# ---------------------------------------------------------------------------------------
# comorbidities, medications, frailty: events -> pre/post aggregates -> one row per patient
# ---------------------------------------------------------------------------------------
cte("com_codes", f"""SELECT concept, code FROM codelists WHERE code_system = 'medcode' AND concept IN {_in(C.COMORBIDITIES)}
  AND (version = {V21} OR (version = {V24} AND concept NOT IN (SELECT concept FROM codelists WHERE version = {V21})))""")
cte("com_gp", """SELECT o.patid, c.concept, o.obsdate AS date, o.medcodeid AS code, 'gp' AS source
  FROM observation o JOIN com_codes c ON o.medcodeid = c.code""")
cte("com_ev", """SELECT e.patid, e.concept, e.date, e.code, e.source FROM com_gp e JOIN valid_dates v ON e.patid = v.patid
  WHERE e.date >= v.min_dob AND (e.source = 'gp' AND e.date <= v.gp_end_date)""")


def _pre_post(name: str, ev: str) -> None:
    cte(f"{name}_pre", f"SELECT patid, concept, min(date) AS e, max(date) AS l FROM {ev} WHERE date <= {IDX} GROUP BY patid, concept")
    cte(f"{name}_post", f"SELECT patid, concept, min(date) AS p FROM {ev} WHERE date > {IDX} GROUP BY patid, concept")
    cte(f"{name}_long", f"""SELECT patid, concept, a.e AS earliest_pre, a.l AS latest_pre, b.p AS first_post
  FROM {name}_pre a FULL OUTER JOIN {name}_post b USING (patid, concept)""")


def _wide(name: str, long: str, concepts, cols) -> None:
    sel = []
    for c in concepts:
        for src, tmpl in cols:
            sel.append(f"max(CASE WHEN concept = {_q(c)} THEN {src} END) AS {tmpl.format(c=c)}")
    cte(f"{name}_w", f"SELECT patid, {', '.join(sel)} FROM {long} GROUP BY patid")


_pre_post("com", "com_ev")
_wide("com", "com_long", C.COMORBIDITIES, [("earliest_pre", "pre_index_date_earliest_{c}"),
                                           ("latest_pre", "pre_index_date_latest_{c}"),
                                           ("first_post", "post_index_date_first_{c}")])
cte("comorbidities", "SELECT s.patid, " + ", ".join(
    f"pre_index_date_earliest_{c}, pre_index_date_latest_{c}, "
    f"(pre_index_date_earliest_{c} IS NOT NULL) AS pre_index_date_{c}, post_index_date_first_{c}"
    for c in C.COMORBIDITIES) + " FROM spine s LEFT JOIN com_w w ON s.patid = w.patid")
cte("com_flags", "SELECT s.patid, " + ", ".join(
    f"(w.pre_index_date_earliest_{c} IS NOT NULL) AS pre_index_date_{c}" for c in C.COMORBIDITIES)
    + " FROM spine s LEFT JOIN com_w w ON s.patid = w.patid")

# dormant hospital sources: ICD-10 prefix (LIKE) join, OPCS-4 equi join, primary cause, wide validity
cte("hosp_dx", """SELECT h.patid, replace(c.concept, 'icd10_', '') AS concept, h.epistart AS date, h.ICD AS code,
  c.code AS prefix, h.d_order FROM hospital_diagnosis h JOIN codes24 c
  ON c.code_system = 'icd10' AND h.ICD LIKE c.code || '%' WHERE c.concept <> 'icd10_hypertension'""")
cte("hosp_proc", """SELECT p.patid, replace(c.concept, 'opcs4_', '') AS concept, p.evdate AS date, p.OPCS AS code
  FROM hospital_procedure p JOIN codes24 c ON c.code_system = 'opcs4' AND p.OPCS = c.code""")
cte("comh_src", f"""SELECT patid, concept, date, code, source FROM com_gp
  UNION ALL SELECT patid, concept, date, code, 'hes_icd10' FROM hosp_dx
  UNION ALL SELECT patid, {_q(C.PRIMARY_HHF)}, date, code, 'hes_icd10' FROM hosp_dx WHERE concept = 'heartfailure' AND d_order = 1
  UNION ALL SELECT patid, concept, date, code, 'hes_opcs4' FROM hosp_proc""")
cte("comh_ev", """SELECT u.* FROM comh_src u JOIN valid_dates v ON u.patid = v.patid
  WHERE u.date >= v.min_dob AND ((u.source = 'gp' AND u.date <= v.gp_ons_end_date)
    OR ((u.source = 'hes_icd10' OR u.source = 'hes_opcs4') AND (v.gp_ons_death_date IS NULL OR u.date <= v.gp_ons_death_date)))""")
_pre_post("comh", "comh_ev")
_COMH = [C.PRIMARY_HHF] + C.COMORBIDITIES
_wide("comh", "comh_long", _COMH, [("earliest_pre", "pre_index_date_earliest_{c}"),
                                   ("latest_pre", "pre_index_date_latest_{c}"),
                                   ("first_post", "post_index_date_first_{c}")])
cte("comorbidities_hosp", "SELECT s.patid, " + ", ".join(
    f"pre_index_date_earliest_{c}, pre_index_date_latest_{c}, "
    f"(pre_index_date_earliest_{c} IS NOT NULL) AS pre_index_date_{c}, post_index_date_first_{c}"
    for c in _COMH) + " FROM spine s LEFT JOIN comh_w w ON s.patid = w.patid")

_OHA_CLS = [c for c in C.OHA_CLASSES if c != C.INSULIN]
cte("drug5", f"""SELECT d.patid, c.concept, d.issuedate AS date FROM drug_issue d JOIN codes21 c ON d.prodcodeid = c.code
  WHERE c.code_system = 'prodcode' AND c.concept IN {_in(C.DRUGS)}""")
cte("drug5_clean", """SELECT e.patid, e.concept, e.date FROM drug5 e JOIN valid_dates v ON e.patid = v.patid
  WHERE e.date >= v.min_dob AND e.date <= v.gp_end_date""")
cte("oha_raw", "SELECT d.patid, d.issuedate, l.drug_class_1, l.drug_substance_2 FROM drug_issue d JOIN drug_class_lookup l ON d.prodcodeid = l.prodcodeid")
cte("oha_clean", """SELECT o.patid, o.issuedate AS date, o.drug_class_1, o.drug_substance_2 FROM oha_raw o
  JOIN valid_dates v ON o.patid = v.patid WHERE o.issuedate >= v.min_dob AND o.issuedate <= v.gp_end_date""")
cte("oha_split", f"""SELECT patid, drug_class_1 AS concept, date FROM oha_clean WHERE drug_class_1 IN {_in(_OHA_CLS)}
  UNION ALL SELECT patid, drug_substance_2 AS concept, date FROM oha_clean WHERE drug_substance_2 IN {_in(C.SEMA_SUBCLASSES)}""")
cte("insulin_raw", """SELECT d.patid, d.issuedate FROM drug_issue d JOIN codes24 c ON d.prodcodeid = c.code
  WHERE c.code_system = 'prodcode' AND c.concept = 'insulin'""")
cte("insulin_clean", """SELECT i.patid, 'insulin' AS concept, i.issuedate AS date FROM insulin_raw i
  JOIN valid_dates v ON i.patid = v.patid WHERE i.issuedate >= v.min_dob AND i.issuedate <= v.gp_ons_end_date""")
cte("med_ev", "SELECT * FROM oha_split UNION ALL SELECT * FROM insulin_clean UNION ALL SELECT * FROM drug5_clean")
_pre_post("med", "med_ev")
_MED = C.medication_concepts()
_wide("med", "med_long", _MED, [("earliest_pre", f"pre_{LABEL}_earliest_{{c}}"),
                                ("latest_pre", f"pre_{LABEL}_latest_{{c}}"),
                                ("first_post", f"post_{LABEL}_first_{{c}}")])
cte("medications", "SELECT s.patid, " + ", ".join(
    f"pre_{LABEL}_earliest_{c}, pre_{LABEL}_latest_{c}, post_{LABEL}_first_{c}" for c in _MED)
    + " FROM spine s LEFT JOIN med_w w ON s.patid = w.patid")

EFI_DEFICITS = X.efi_deficits()
cte("efi_codes", f"SELECT concept, code FROM codes24 WHERE code_system = 'medcode' AND concept LIKE 'efi\\_%' ESCAPE '\\'")
cte("efi_ev", """SELECT o.patid, c.concept, o.obsdate AS date FROM observation o JOIN efi_codes c ON o.medcodeid = c.code
  JOIN valid_dates v ON o.patid = v.patid WHERE o.obsdate >= v.min_dob AND o.obsdate <= v.gp_end_date""")
cte("efi_pre", f"SELECT patid, concept, min(date) AS e FROM efi_ev WHERE date <= {IDX} GROUP BY patid, concept")
_efi_flag = {c: ("TRUE" if c in C.EFI_FORCED else f"(max(CASE WHEN p.concept = {_q(c)} THEN p.e END) IS NOT NULL)")
             for c in EFI_DEFICITS}
cte("efi_flags", "SELECT s.patid, " + ", ".join(f"{_efi_flag[c]} AS pre_index_date_{C.efi_short(c)}" for c in EFI_DEFICITS)
    + " FROM spine s LEFT JOIN efi_pre p ON s.patid = p.patid GROUP BY s.patid")
_efi_n = " + ".join(f"CAST(pre_index_date_{C.efi_short(c)} AS INTEGER)" for c in EFI_DEFICITS)
cte("efi_n", f"SELECT *, CAST({_efi_n} AS INTEGER) AS efi_n_deficits FROM efi_flags")
cte("efi_s", f"SELECT *, CAST(efi_n_deficits AS DOUBLE) / {float(C.EFI_DENOMINATOR)} AS pre_index_date_efi_score FROM efi_n")
cte("efi", """SELECT *, CASE WHEN pre_index_date_efi_score < 0.12 THEN 'fit'
  WHEN pre_index_date_efi_score >= 0.12 AND pre_index_date_efi_score < 0.24 THEN 'mild'
  WHEN pre_index_date_efi_score >= 0.24 AND pre_index_date_efi_score < 0.36 THEN 'moderate'
  WHEN pre_index_date_efi_score >= 0.36 THEN 'severe' END AS pre_index_date_efi_cat FROM efi_s""")

# ---------------------------------------------------------------------------------------
# cohort and cross-section
# ---------------------------------------------------------------------------------------
_alive = f"(death_date IS NULL OR death_date >= {IDX})"
cte("cohort_ids", f"""SELECT patid FROM diabetes_cohort WHERE dm_diag_date_all <= {IDX} AND regstartdate <= {IDX}
  AND gp_record_end >= {IDX} AND {_alive}""")
cte("cohort_ids_linked", f"""SELECT patid FROM diabetes_cohort WHERE dm_diag_date_all <= {IDX} AND regstartdate <= {IDX}
  AND gp_record_end >= {IDX} AND {_alive} AND with_hes = 1""")
_age = f"CAST(date_diff('day', dob, {IDX}) AS DOUBLE) / CAST({C.DAYS_PER_YEAR} AS DOUBLE)"
_dur = f"CAST(date_diff('day', dm_diag_date_all, {IDX}) AS DOUBLE) / CAST({C.DAYS_PER_YEAR} AS DOUBLE)"
cte("xs_join", """SELECT * FROM cohort_ids LEFT JOIN diabetes_cohort USING (patid) LEFT JOIN biomarkers USING (patid)
  LEFT JOIN stage USING (patid) LEFT JOIN medications USING (patid) LEFT JOIN comorbidities USING (patid)""")
cte("cross_section", f"SELECT *, {_age} AS index_date_age, {_dur} AS index_date_dm_dur_all FROM xs_join")
_xs_hosp = """SELECT * FROM cohort_ids LEFT JOIN diabetes_cohort USING (patid) LEFT JOIN biomarkers USING (patid)
  LEFT JOIN stage USING (patid) LEFT JOIN medications USING (patid) LEFT JOIN comorbidities_hosp USING (patid)"""
cte("xs_hospital", f"SELECT *, {_age} AS index_date_age, {_dur} AS index_date_dm_dur_all FROM ({_xs_hosp}) x")
cte("xs_linked", "SELECT * FROM cross_section WHERE patid IN (SELECT patid FROM cohort_ids_linked)")
CUSTOM_DEFICITS = ["efi_1", "efi_2"]
cte("efi_custom_n", "SELECT patid, pre_index_date_efi_1, pre_index_date_efi_2, " + ", ".join(
    f"TRUE AS pre_index_date_{c}" for c in C.EFI_FORCED) + """,
  CAST(CAST(pre_index_date_efi_1 AS INTEGER) + CAST(pre_index_date_efi_2 AS INTEGER) AS INTEGER) AS efi_n_deficits FROM efi_flags""")
cte("efi_custom", f"""SELECT *, CAST(efi_n_deficits AS DOUBLE) / {float(C.EFI_DENOMINATOR)} AS pre_index_date_efi_score,
  CASE WHEN efi_n_deficits < 4.32 THEN 'fit' ELSE 'mild' END AS pre_index_date_efi_cat FROM efi_custom_n""")
cte("xs_custom", f"""SELECT *, {_age} AS index_date_age, {_dur} AS index_date_dm_dur_all FROM (
  SELECT * FROM xs_join LEFT JOIN efi_custom USING (patid)) x""")
cte("xs_join_efi", "SELECT * FROM xs_join LEFT JOIN efi USING (patid)")
cte("cross_section_efi", f"SELECT *, {_age} AS index_date_age, {_dur} AS index_date_dm_dur_all FROM xs_join_efi")

_P = f"pre_{LABEL}"
cte("flags0", f"""SELECT *,
  ({_P}_earliest_glp1 IS NOT NULL) AS f_glp1, ({_P}_earliest_sglt2 IS NOT NULL) AS f_sglt2,
  ({_P}_latest_finerenone IS NOT NULL) AS f_fine, ({_P}_latest_statins IS NOT NULL) AS f_statin,
  ({_P}_latest_ace_inhibitors IS NOT NULL) AS f_ace, ({_P}_latest_arb IS NOT NULL) AS f_arb,
  ({_P}_latest_ksparing_diuretics IS NOT NULL) AS f_mra,
  ({_P}_latest_insulin IS NOT NULL) AS f_ins, ({_P}_latest_dpp4 IS NOT NULL) AS f_dpp4,
  ({_P}_latest_mfn IS NOT NULL) AS f_mfn, ({_P}_latest_su IS NOT NULL) AS f_su,
  ({_P}_earliest_tzd IS NOT NULL) AS f_tzd
  FROM cross_section""")
_asc = " OR ".join(f"CAST(pre_index_date_{c} AS INTEGER) = 1" for c in C.ASCVD_COMPONENTS)
_eth = " ".join(f"WHEN ethnicity_5cat = {k} THEN {_q(v)}" for k, v in C.ETHNICITY_LABELS.items())
_six = "CAST(f_dpp4 AS INTEGER) + CAST(f_glp1 AS INTEGER) + CAST(f_mfn AS INTEGER) + CAST(f_su AS INTEGER) + CAST(f_sglt2 AS INTEGER) + CAST(f_tzd AS INTEGER)"
_FLAG_COLS = ["pre_index_date_glp1", "pre_index_date_sglt2", "pre_index_date_finerenone",
              "pre_index_date_statin", "pre_index_date_ace", "pre_index_date_arb",
              "pre_index_date_ace_or_arb", "pre_index_date_mra", "pre_index_date_ascvd",
              "pre_index_date_heartfailure", "pre_index_date_genital_infection", "malesex",
              "ethnicity_5cat", "uacr", "pre_index_date_ins", "pre_index_date_dpp4", "pre_index_date_mfn",
              "pre_index_date_su", "pre_index_date_tzd", "ncurrtx", "oha"]
cte("flagged", f"""SELECT * EXCLUDE (f_glp1, f_sglt2, f_fine, f_statin, f_ace, f_arb, f_mra, f_ins, f_dpp4, f_mfn, f_su, f_tzd) REPLACE (
    CAST(pre_index_date_heartfailure AS BOOLEAN) AS pre_index_date_heartfailure,
    CAST(pre_index_date_genital_infection AS BOOLEAN) AS pre_index_date_genital_infection,
    CASE {_eth} END AS ethnicity_5cat),
  f_glp1 AS pre_index_date_glp1, f_sglt2 AS pre_index_date_sglt2, f_fine AS pre_index_date_finerenone,
  f_statin AS pre_index_date_statin, f_ace AS pre_index_date_ace, f_arb AS pre_index_date_arb,
  (f_ace OR f_arb) AS pre_index_date_ace_or_arb, f_mra AS pre_index_date_mra,
  ({_asc}) AS pre_index_date_ascvd, (gender = 1) AS malesex,
  CASE WHEN preacr IS NOT NULL THEN preacr WHEN preacr_from_separate IS NOT NULL THEN preacr_from_separate END AS uacr,
  f_ins AS pre_index_date_ins, f_dpp4 AS pre_index_date_dpp4, f_mfn AS pre_index_date_mfn,
  f_su AS pre_index_date_su, f_tzd AS pre_index_date_tzd,
  CAST({_six} + CAST(f_ins AS INTEGER) AS INTEGER) AS ncurrtx, ({_six}) > 0 AS oha
  FROM flags0""")
cte("restricted", """SELECT * FROM flagged WHERE diabetes_type = 'type 2' AND ncurrtx > 0
  AND CAST(pre_index_date_ckd5_code AS INTEGER) = 0 AND preckdstage <> 'stage_5'""")
cte("missing_uacr", "SELECT * FROM restricted WHERE preegfr IS NOT NULL AND uacr IS NULL")
cte("complete", "SELECT * FROM restricted WHERE preegfr IS NOT NULL AND uacr IS NOT NULL")
cte("stage0_recode", f"""SELECT * REPLACE (CASE WHEN preckdstage IN {_in(C.STAGE_ZERO_FROM)} AND uacr < {C.ELIG_UACR}
  THEN 'stage_0' ELSE CAST(preckdstage AS VARCHAR) END AS preckdstage) FROM complete""")
cte("stage_zero", "SELECT *, (preckdstage <> 'stage_0') AS any_ckd FROM stage0_recode WHERE preckdstage <> 'stage_0'")
_prune_like = " OR ".join(f"contains(lower(c), {_q(x.format(label=LABEL).lower())})" for x in C.PRUNE_CONTAINS)
_prune_end = " OR ".join(f"ends_with(lower(c), {_q(x.lower())})" for x in C.PRUNE_ENDS_WITH)
cte("pruned", f"SELECT COLUMNS(lambda c: NOT ({_prune_like} OR {_prune_end} OR c IN {_in(C.PRUNE_EXACT)})) FROM stage_zero")
cte("eligible", f"""SELECT *,
  (uacr >= {C.ELIG_UACR} AND presbp >= {C.ELIG_SBP}) AS eligible_aceorarb,
  TRUE AS eligible_statin,
  (uacr >= {C.ELIG_MACRO_UACR}) AS macroalbuminuria,
  (preegfr < {C.ELIG_SGLT2_EGFR} OR uacr >= {C.ELIG_UACR}) AS eligible_sglt2_kidney,
  (pre_index_date_ascvd = TRUE OR pre_index_date_heartfailure = TRUE) AS eligible_sglt2_hf,
  CASE WHEN prepotassium IS NULL THEN {C.ELIG_POTASSIUM_IF_MISSING} ELSE prepotassium END AS prepotassium_noNA,
  ((preegfr >= {C.ELIG_FINE_EGFR_LO} AND preegfr < {C.ELIG_FINE_EGFR_HI}) OR coalesce(preckdstage IN {_in(C.ELIG_FINE_STAGES)}, FALSE))
   AND uacr >= {C.ELIG_UACR}
   AND ((CASE WHEN prepotassium IS NULL THEN {C.ELIG_POTASSIUM_IF_MISSING} ELSE prepotassium END) <= {C.ELIG_POTASSIUM_MAX}
        OR pre_index_date_finerenone = TRUE) AS eligible_finerenone
  FROM pruned""")


def deps(names) -> list[str]:
    """CTE names needed (transitively) by ``names``, in definition order."""
    need: set[str] = set()
    todo = list(names)
    keys = list(CTE)
    while todo:
        n = todo.pop()
        if n in need:
            continue
        need.add(n)
        body = CTE[n]
        for k in keys:
            if k not in need and re.search(rf"\b{re.escape(k)}\b", body):
                todo.append(k)
    return [k for k in keys if k in need]


def build(final: str, extra: dict[str, str] | None = None) -> str:
    """WITH <needed CTEs>, <extra CTEs> <final>."""
    extra = extra or {}
    used = [k for k in CTE if re.search(rf"\b{re.escape(k)}\b", final + " ".join(extra.values()))]
    names = deps(used)
    parts = [f"{n} AS (\n{CTE[n]}\n)" for n in names] + [f"{n} AS (\n{s}\n)" for n, s in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final


def rounded(cols) -> str:
    """``* REPLACE (round(c, 6) AS c, ...)`` for the DOUBLE columns ``cols``."""
    cols = list(cols)
    if not cols:
        return "*"
    return "* REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in cols) + ")"
