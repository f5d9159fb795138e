"""Cohort selection, the one-row-per-patient cross-section and analysis flags."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import (any_of, as_date, count_true, ethnicity_label, isin_strict,
                                 years_between)


def prevalent_cohort(cohort: DataFrame, index_date, *, linked_only: bool = False) -> DataFrame:
    """Diagnosed, registered and alive at the index date (optionally hospital-linked)."""
    idx = as_date(index_date)
    cond = ((F.col("dm_diag_date_all") <= idx) & (F.col("regstartdate") <= idx)
            & (F.col("gp_record_end") >= idx)
            & (F.col("death_date").isNull() | (F.col("death_date") >= idx)))
    if linked_only:
        cond = cond & (F.col("with_hes") == 1)
    return cohort.filter(cond).select("patid")


def cross_section(cohort_ids: DataFrame, cohort: DataFrame, features: list[DataFrame], index_date) -> DataFrame:
    """cohort ids LEFT JOIN attributes LEFT JOIN each one-row-per-patient feature table; age and
    diabetes duration in years placed just before ``gender``; patid as text.

    Every input is keyed by patid, so the chain is a series of joins on one key: after the
    first exchange the partitioning is reused and no join fans out."""
    out = cohort_ids.select("patid").join(cohort, "patid", "left")
    for f in features:
        out = out.join(f, "patid", "left")
    idx = as_date(index_date)
    age = years_between(idx, F.col("dob")).alias("index_date_age")
    dur = years_between(idx, F.col("dm_diag_date_all")).alias("index_date_dm_dur_all")
    cols = []
    for c in out.columns:
        if c == "gender":
            cols += [age, dur]
        cols.append(F.col(c).cast("string").alias("patid") if c == "patid" else F.col(c))
    return out.select(*cols)


def treatment_flags(df: DataFrame, label: str) -> DataFrame:
    """Treatment and history flags of the analysis-ready extract (Kleene-safe Booleans)."""
    def pre(kind: str, c: str):
        return F.col(f"pre_{label}_{kind}_{c}").isNotNull()

    f = {
        "pre_index_date_glp1": pre("earliest", "glp1"),
        "pre_index_date_sglt2": pre("earliest", "sglt2"),
        "pre_index_date_finerenone": pre("latest", "finerenone"),
        "pre_index_date_statin": pre("latest", "statins"),
        "pre_index_date_ace": pre("latest", "ace_inhibitors"),
        "pre_index_date_arb": pre("latest", "arb"),
    }
    out = df.withColumns(f)
    out = out.withColumns({
        "pre_index_date_ace_or_arb": any_of(["pre_index_date_ace", "pre_index_date_arb"]),
        "pre_index_date_mra": pre("latest", "ksparing_diuretics"),
        "pre_index_date_ascvd": any_of([f"pre_index_date_{c}" for c in C.ASCVD_COMPONENTS]),
        "pre_index_date_heartfailure": F.col("pre_index_date_heartfailure").cast("boolean"),
        "pre_index_date_genital_infection": F.col("pre_index_date_genital_infection").cast("boolean"),
        "malesex": F.col("gender") == 1,
        "ethnicity_5cat": ethnicity_label(F.col("ethnicity_5cat")),
        "uacr": F.coalesce(F.col("preacr"), F.col("preacr_from_separate")),
        "pre_index_date_ins": pre("latest", "insulin"),
        "pre_index_date_dpp4": pre("latest", "dpp4"),
        "pre_index_date_mfn": pre("latest", "mfn"),
        "pre_index_date_su": pre("latest", "su"),
        "pre_index_date_tzd": pre("earliest", "tzd"),
    })
    six = ["pre_index_date_dpp4", "pre_index_date_glp1", "pre_index_date_mfn", "pre_index_date_su",
           "pre_index_date_sglt2", "pre_index_date_tzd"]
    return out.withColumns({
        "ncurrtx": count_true(six + ["pre_index_date_ins"]),
        "oha": count_true(six) > 0,
    })


TREATMENT_FLAG_COLUMNS = [
    "pre_index_date_glp1", "pre_index_date_sglt2", "pre_index_date_finerenone",
    "pre_index_date_statin", "pre_index_date_ace", "pre_index_date_arb",
    "pre_index_date_ace_or_arb", "pre_index_date_mra", "pre_index_date_ascvd",
    "pre_index_date_heartfailure", "pre_index_date_genital_infection", "malesex",
    "ethnicity_5cat", "uacr", "pre_index_date_ins", "pre_index_date_dpp4", "pre_index_date_mfn",
    "pre_index_date_su", "pre_index_date_tzd", "ncurrtx", "oha",
]


def restrict_cohort(df: DataFrame) -> DataFrame:
    """Type 2 on at least one glucose-lowering drug; no stage-5 code and stage not 5
    (a NULL stage is dropped, as a NULL comparison never passes a filter)."""
    return (df.filter((F.col("diabetes_type") == "type 2") & (F.col("ncurrtx") > 0))
              .filter((F.col("pre_index_date_ckd5_code").cast("int") == 0)
                      & (F.col("preckdstage") != "stage_5")))


def missing_cohort(df: DataFrame) -> DataFrame:
    """eGFR present, uACR missing."""
    return df.filter(F.col("preegfr").isNotNull() & F.col("uacr").isNull())


def recode_stage_zero(df: DataFrame) -> DataFrame:
    """Complete cases (eGFR and uACR present); stage 1/2 with uACR < 3 becomes stage_0;
    keep those with any kidney disease."""
    x = df.filter(F.col("preegfr").isNotNull() & F.col("uacr").isNotNull())
    cond = isin_strict(F.col("preckdstage"), C.STAGE_ZERO_FROM) & (F.col("uacr") < C.ELIG_UACR)
    stage = F.when(cond, F.lit("stage_0")).when(~cond, F.col("preckdstage").cast("string"))
    x = x.withColumn("preckdstage", stage).withColumn("any_ckd", F.col("preckdstage") != "stage_0")
    return x.filter(F.col("any_ckd"))


def drop_matching(df: DataFrame, *, contains=(), ends_with=(), regex=(), exact=()) -> DataFrame:
    """Drop columns by name rule: case-insensitive ``contains``/``ends_with``, ``regex``
    (case-sensitive, ``re.search``) and ``exact`` names, which must all exist."""
    missing = [n for n in exact if n not in df.columns]
    if missing:
        raise ValueError(f"cannot drop unknown columns: {missing}")
    low = [s.lower() for s in contains]
    ends = [s.lower() for s in ends_with]
    pats = [re.compile(r) for r in regex]

    def gone(c: str) -> bool:
        lc = c.lower()
        return (c in exact or any(s in lc for s in low) or any(lc.endswith(s) for s in ends)
                or any(p.search(c) for p in pats))

    return df.select(*[F.col(f"`{c}`") for c in df.columns if not gone(c)])


def prune_columns(df: DataFrame, label: str) -> DataFrame:
    return drop_matching(df, contains=[s.format(label=label) for s in C.PRUNE_CONTAINS],
                         exact=C.PRUNE_EXACT, ends_with=C.PRUNE_ENDS_WITH)


def eligibility_flags(df: DataFrame) -> DataFrame:
    """Treatment-eligibility flags (NULL where a needed value is NULL and not decided)."""
    uacr, sbp, egfr = F.col("uacr"), F.col("presbp"), F.col("preegfr")
    k = F.coalesce(F.col("prepotassium"), F.lit(C.ELIG_POTASSIUM_IF_MISSING))
    fine_kidney = ((egfr >= C.ELIG_FINE_EGFR_LO) & (egfr < C.ELIG_FINE_EGFR_HI)) | isin_strict(
        F.col("preckdstage"), C.ELIG_FINE_STAGES)
    return df.withColumns({
        "eligible_aceorarb": (uacr >= C.ELIG_UACR) & (sbp >= C.ELIG_SBP),
        "eligible_statin": F.lit(True),
        "macroalbuminuria": uacr >= C.ELIG_MACRO_UACR,
        "eligible_sglt2_kidney": (egfr < C.ELIG_SGLT2_EGFR) | (uacr >= C.ELIG_UACR),
        "eligible_sglt2_hf": F.col("pre_index_date_ascvd") | F.col("pre_index_date_heartfailure"),
        "prepotassium_noNA": k,
    }).withColumn(
        "eligible_finerenone",
        fine_kidney & (uacr >= C.ELIG_UACR)
        & ((F.col("prepotassium_noNA") <= C.ELIG_POTASSIUM_MAX) | F.col("pre_index_date_finerenone")))


ELIGIBILITY_COLUMNS = ["eligible_aceorarb", "eligible_statin", "macroalbuminuria",
                       "eligible_sglt2_kidney", "eligible_sglt2_hf", "prepotassium_noNA",
                       "eligible_finerenone"]
