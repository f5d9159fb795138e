"""Column expressions (all JVM-side built-ins: no Python UDF anywhere).

Null semantics follow the analysis being re-implemented:
* ``ifelse(cond, TRUE, FALSE)`` is the bare Boolean ``cond`` (NULL stays NULL);
* ``x %in% set`` is FALSE (never NULL) for a NULL ``x``;
* ``round`` is half-to-even (``bround``);
* division by zero gives NULL (``try_divide``), not an error.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

DateLike = "dt.date | str | Column"


def as_date(d) -> Column:
    """A date literal (python date / ISO string) or an existing date Column."""
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def shift(d, days: int) -> Column:
    """``d + days``; folded to a literal for a constant date so the bound reaches Parquet."""
    if isinstance(d, (dt.date, str)):
        base = dt.date.fromisoformat(d) if isinstance(d, str) else d
        return F.lit(base + dt.timedelta(days=days))
    return F.date_add(d, days)


def day_diff(end, start) -> Column:
    """Signed whole days ``end - start`` (same argument order as SQL ``datediff``)."""
    return F.datediff(as_date(end), as_date(start))


def years_between(end, start) -> Column:
    """Days / 365.25 as a double."""
    return day_diff(end, start).cast("double") / F.lit(C.DAYS_PER_YEAR)


def in_window(date_col: Column, index_date, lo: int, hi: int) -> Column:
    """``lo <= datediff(date, index) <= hi`` written as two date bounds (pushable)."""
    return date_col.between(shift(index_date, lo), shift(index_date, hi))


def isin_strict(col: Column, values) -> Column:
    """Set membership that is FALSE for NULL input."""
    return F.coalesce(col.isin(list(values)), F.lit(False))


def count_true(cols) -> Column:
    """Number of TRUE flags (NULL flags count as NULL, like integer addition)."""
    return reduce(add, [F.col(c).cast("int") if isinstance(c, str) else c.cast("int") for c in cols])


def any_of(cols) -> Column:
    """Kleene OR over flags (NULL | TRUE = TRUE, NULL | FALSE = NULL)."""
    return reduce(or_, [F.col(c) if isinstance(c, str) else c for c in cols])


def sex_label(gender: Column) -> Column:
    """1 -> male, 2 -> female, otherwise NULL."""
    return F.when(gender == 1, "male").when(gender == 2, "female")


def ethnicity_label(code: Column) -> Column:
    out = None
    for k, v in C.ETHNICITY_LABELS.items():
        out = F.when(code == k, v) if out is None else out.when(code == k, v)
    return out


def hba1c_to_mmol(value: Column) -> Column:
    """Values <= 20 are taken as percent and converted to mmol/mol."""
    return F.when(value <= C.HBA1C_PERCENT_MAX,
                  (value - C.HBA1C_OFFSET) / C.HBA1C_SLOPE).otherwise(value)


# Published CKD-EPI 2021 creatinine equation (race-free), creatinine in mg/dL.
EGFR_K_FEMALE, EGFR_K_MALE = 0.7, 0.9
EGFR_A_FEMALE, EGFR_A_MALE = -0.241, -0.302
EGFR_EXP_HIGH = -1.2
EGFR_BASE = 142.0
EGFR_AGE_BASE = 0.9938
EGFR_FEMALE_FACTOR = 1.012
UMOL_PER_MGDL = 88.4


def egfr_ckd_epi_2021(creatinine: Column, sex: Column, age: Column, unit: str = "umol/L") -> Column:
    """eGFR (mL/min/1.73m2).  NULL when sex or age or creatinine is NULL."""
    scr = creatinine / UMOL_PER_MGDL if unit == "umol/L" else creatinine
    female = sex == "female"
    kappa = F.when(female, EGFR_K_FEMALE).when(sex == "male", EGFR_K_MALE)
    alpha = F.when(female, EGFR_A_FEMALE).when(sex == "male", EGFR_A_MALE)
    ratio = scr / kappa
    return (F.lit(EGFR_BASE)
            * F.pow(F.least(ratio, F.lit(1.0)), alpha)
            * F.pow(F.greatest(ratio, F.lit(1.0)), F.lit(EGFR_EXP_HIGH))
            * F.pow(F.lit(EGFR_AGE_BASE), age)
            * F.when(female, EGFR_FEMALE_FACTOR).when(sex == "male", 1.0))


def efi_category(score: Column) -> Column:
    """case_when on the frailty score; no match (NULL score) -> NULL."""
    out = None
    lower = None
    for cut, label in C.EFI_CUTS:
        cond = score < cut if lower is None else (score >= lower) & (score < cut)
        out = F.when(cond, label) if out is None else out.when(cond, label)
        lower = cut
    return out.when(score >= lower, C.EFI_TOP)


def stage_at(cols: dict[str, Column], index_date, grace: int) -> Column:
    """Most severe stage whose first date is on/before index + grace (severity beats recency)."""
    bound = shift(index_date, grace)
    out = None
    for name in C.CKD_STAGES:
        cond = cols[name].isNotNull() & (cols[name] <= bound)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out
