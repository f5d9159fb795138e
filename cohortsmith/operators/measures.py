"""Measurement cleaning and derived measures (long frame: patid, concept, date, value)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import egfr_ckd_epi_2021, hba1c_to_mmol, sex_label, years_between
from .events import restrict_to_registration


def apply_value_limits(ev: DataFrame, limits: DataFrame, *, limit_concept: str | None = None) -> DataFrame:
    """Keep rows with ``lo <= value <= hi`` for their concept (NULL value drops).

    ``limit_concept`` applies one concept's limits to every row (used for derived ratios); its
    single (lo, hi) row is read as literals -- a join on a constant key would plan as a
    keyless nested-loop join."""
    if limit_concept is not None:
        rows = limits.filter(F.col("concept") == limit_concept).select("lo", "hi").limit(2).collect()
        if len(rows) != 1:
            raise ValueError(f"expected one limits row for {limit_concept!r}, found {len(rows)}")
        return ev.filter(F.col("value").between(F.lit(rows[0].lo), F.lit(rows[0].hi)))
    lim = limits.select(F.col("concept").alias("_lc"), "lo", "hi")
    j = ev.join(lim, F.col("concept") == F.col("_lc")).drop("_lc")
    return j.filter(F.col("value").between(F.col("lo"), F.col("hi"))).drop("lo", "hi")


def apply_unit_whitelist(ev: DataFrame, units: DataFrame) -> DataFrame:
    """Keep rows whose (concept, numunitid) is listed; a NULL unit matches a listed NULL."""
    u = units.select(F.col("concept").alias("_uc"), F.col("numunitid").alias("_uu"))
    cond = (F.col("concept") == F.col("_uc")) & F.col("numunitid").eqNullSafe(F.col("_uu"))
    return ev.join(u, cond, "left_semi")


def daily_mean(ev: DataFrame) -> DataFrame:
    """Several values on one patient-day of one concept -> their mean (NULLs ignored)."""
    return ev.groupBy("patid", "concept", "date").agg(F.avg("value").alias("value"))


def convert_hba1c(ev: DataFrame, concept: str = C.HBA1C) -> DataFrame:
    """Percent HbA1c (<= 20) to mmol/mol, for rows of ``concept`` only."""
    v = F.when(F.col("concept") == concept, hba1c_to_mmol(F.col("value"))).otherwise(F.col("value"))
    return ev.withColumn("value", v)


def clean_measurements(raw: DataFrame, limits: DataFrame, units: DataFrame, valid: DataFrame, *,
                       end_col: str = "gp_end_date", hba1c: str = C.HBA1C,
                       hba1c_min_year: int = C.HBA1C_MIN_YEAR) -> DataFrame:
    """raw (patid, concept, date, value, numunitid) -> one clean value per patient-concept-day.

    HbA1c unit conversion -> value limits -> unit whitelist -> valid-registration filter (and
    HbA1c calendar floor) -> daily mean.  The filters are per patient-day, so they may go first,
    and the registration join's partitioning on patid then serves the daily mean as well: one
    exchange of the events."""
    ev = convert_hba1c(raw, hba1c)
    ev = apply_value_limits(ev, limits)
    ev = apply_unit_whitelist(ev, units)
    floor = F.lit(dt.date(hba1c_min_year, 1, 1))
    ev = ev.filter((F.col("concept") != hba1c) | (F.col("date") >= floor))
    return daily_mean(restrict_to_registration(ev, valid, end_col=end_col))


def same_day_ratio(clean: DataFrame, limits: DataFrame, *, num: str = "albumin_urine",
                   den: str = "creatinine_urine", out: str = "acr_from_separate",
                   limit_concept: str = "acr") -> DataFrame:
    """Ratio of two measures taken the same day, re-cleaned with the limits of ``limit_concept``; a
    zero denominator gives NULL and is dropped by the limits.

    ``clean`` has one row per (patid, concept, day), so the pairing is one aggregate by patid and
    date: it combines on the map side and, on a table in buckets of patid, exchanges nothing."""
    pick = lambda c: F.max(F.when(F.col("concept") == c, F.col("value")))
    days = (clean.filter(F.col("concept").isin(num, den) & F.col("patid").isNotNull() & F.col("date").isNotNull())
                 .groupBy("patid", "date").agg(pick(num).alias("_n"), pick(den).alias("_d")))
    r = days.select("patid", F.lit(out).alias("concept"), "date", F.try_divide("_n", "_d").alias("value"))
    return apply_value_limits(r, limits, limit_concept=limit_concept)


def derive_egfr(clean: DataFrame, people: DataFrame, *, creatinine: str = "creatinine_blood",
                out: str = "egfr", unit: str = "umol/L") -> DataFrame:
    """eGFR from clean creatinine, age at the test and sex; ``people`` (patid, dob, gender) has one
    row per patient.  Patients without a row, dob or sex are dropped (NULL results are removed)."""
    cr = clean.filter(F.col("concept") == creatinine).select("patid", "date", "value")
    j = cr.join(people.select("patid", "dob", "gender"), "patid")
    age = years_between(F.col("date"), F.col("dob"))
    egfr = egfr_ckd_epi_2021(F.col("value"), sex_label(F.col("gender")), age, unit=unit)
    return (j.select("patid", F.lit(out).alias("concept"), "date", egfr.alias("value"))
             .filter(F.col("value").isNotNull()))
