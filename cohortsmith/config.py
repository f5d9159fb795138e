"""Configuration: concept lists, windows, thresholds and name templates.

Everything that decides *what* is computed lives here as data, so the
operators stay generic (DataFrame in, DataFrame out) and the same code runs
for any index date, concept list or threshold.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# FIXED VALUES that must equal the analysis being re-implemented
# (concept names, column-name templates, clinical thresholds, label maps).
# They are listed plainly and in their original order.
# ---------------------------------------------------------------------------

# Measurement concepts, in their original order (HbA1c is handled separately).
BIOMARKERS = [
    "weight", "height", "bmi", "hdl", "triglyceride", "creatinine_blood", "ldl", "alt", "ast",
    "totalcholesterol", "dbp", "sbp", "acr", "albumin_urine", "creatinine_urine", "potassium",
]
HBA1C = "hba1c"

# Comorbidity concepts, in their original order.
COMORBIDITIES = [
    "af", "angina", "asthma", "bronchiectasis", "ckd5_code", "cld", "copd", "cysticfibrosis",
    "dementia", "diabeticnephropathy", "fh_premature_cvd", "haem_cancer", "heartfailure",
    "hypertension", "ihd", "myocardialinfarction", "neuropathy", "otherneuroconditions", "pad",
    "pulmonaryfibrosis", "pulmonaryhypertension", "retinopathy", "revasc", "rheumatoidarthritis",
    "solid_cancer", "solidorgantransplant", "stroke", "tia", "anxiety_disorders",
    "genital_infection", "genital_infection_nonspec", "benignprostatehyperplasia",
    "micturition_control", "volume_depletion", "urinary_frequency", "falls", "lowerlimbfracture",
    "dka", "hosp_cause_majoramputation", "hosp_cause_minoramputation", "osteoporosis",
    "unstableangina", "frailty_simple",
]

# Primary-cause hospitalisation for heart failure (hospital sources only), listed first.
PRIMARY_HHF = "primary_hhf"

# Medications: simple drug codelists, glucose-lowering classes, semaglutide sub-classes.
DRUGS = ["ace_inhibitors", "arb", "ksparing_diuretics", "finerenone", "statins"]
OHA_CLASSES = ["acarbose", "dpp4", "glinide", "glp1", "mfn", "sglt2", "su", "tzd", "insulin", "gipglp1"]
SEMA_SUBCLASSES = ["ldsema", "hdsema", "osema", "sema_query"]
INSULIN = "insulin"

# Frailty index: deficit-name prefix, short-name map, forced deficits, denominator, cut points.
EFI_PREFIX = "efi_"
EFI_SHORT_NAMES = {"efi_mobility_and_transfer_problems": "efi_mobility_transfer"}
EFI_FORCED = ["efi_diabetes", "efi_polypharmacy"]
EFI_DENOMINATOR = 36
EFI_CUTS = [(0.12, "fit"), (0.24, "mild"), (0.36, "moderate")]  # score < cut -> label; else "severe"
EFI_TOP = "severe"

# Baseline window (days relative to the index date), inclusive; eGFR prefers the maximum value.
BASELINE_LO = -730
BASELINE_HI = 7
PREFER_MAX = ["egfr"]

# HbA1c: values <= 20 are percent and converted to mmol/mol; records before 1990 are dropped.
HBA1C_PERCENT_MAX = 20.0
HBA1C_OFFSET = 2.152
HBA1C_SLOPE = 0.09148
HBA1C_MIN_YEAR = 1990

# Potassium limits and unit codes that were written into the analysis itself (NULL unit allowed).
POTASSIUM_LO = 2.5
POTASSIUM_HI = 6.5
POTASSIUM_UNITS = [218, 425, None]

# Kidney-disease stages, most severe first; grace days after the index date.
CKD_STAGES = ["stage_5", "stage_4", "stage_3b", "stage_3a", "stage_2", "stage_1"]
CKD_GRACE_DAYS = 7

# Days per year for ages and durations.
DAYS_PER_YEAR = 365.25

# Ethnicity code -> label (no match -> NULL).
ETHNICITY_LABELS = {0: "White", 1: "South Asian", 2: "Black", 3: "Other", 4: "Mixed"}

# Treatment-eligibility thresholds.
ELIG_UACR = 3.0
ELIG_SBP = 110.0
ELIG_MACRO_UACR = 30.0
ELIG_SGLT2_EGFR = 90.0
ELIG_FINE_EGFR_LO = 25.0
ELIG_FINE_EGFR_HI = 60.0
ELIG_FINE_STAGES = ["stage_3a", "stage_3b", "stage_4"]
ELIG_POTASSIUM_MAX = 5.0
ELIG_POTASSIUM_IF_MISSING = 5.5
STAGE_ZERO_FROM = ["stage_1", "stage_2"]

# Atherosclerotic-disease components of the ASCVD flag.
ASCVD_COMPONENTS = ["angina", "ihd", "myocardialinfarction", "pad", "revasc", "stroke", "tia"]

# Descriptive table: variables, factor variables, non-normal variables, stratum.
TABLE_ONE_VARS = [
    "index_date_age", "malesex", "ethnicity_5cat", "index_date_dm_dur_all", "imd_decile", "prebmi",
    "presbp", "predbp", "prepotassium", "prehba1c", "preckdstage", "preegfr", "uacr",
    "pre_index_date_ascvd", "pre_index_date_heartfailure", "pre_index_date_genital_infection",
    "pre_index_date_ace_or_arb", "pre_index_date_statin", "pre_index_date_sglt2",
    "pre_index_date_glp1", "pre_index_date_finerenone", "pre_index_date_mra",
]
TABLE_ONE_FACTORS = [
    "malesex", "ethnicity_5cat", "imd_decile", "pre_index_date_ace_or_arb", "pre_index_date_statin",
    "pre_index_date_sglt2", "pre_index_date_glp1", "pre_index_date_finerenone", "pre_index_date_mra",
    "preckdstage", "pre_index_date_ascvd", "pre_index_date_heartfailure",
    "pre_index_date_genital_infection",
]
TABLE_ONE_NONNORMAL = ["uacr", "index_date_dm_dur_all"]
TABLE_ONE_STRATA = "macroalbuminuria"

# Column pruning rule of the analysis-ready extract: name fragments (case-insensitive), exact
# names (must exist), and a case-insensitive suffix.  "{label}" is the index-period label.
PRUNE_CONTAINS = [
    "pre_{label}", "post_{label}", "post_index_date", "datediff", "pre_index_date_latest",
    "pre_index_date_earliest", "code_count", "dm_diag_",
]
PRUNE_EXACT = ["dob", "ins_in_1_year", "has_insulin", "with_hes", "current_oha"]
PRUNE_ENDS_WITH = ["date"]

# ---------------------------------------------------------------------------
# Parameters of the test fixtures (our own choice, not values of the analysis).
# ---------------------------------------------------------------------------

INDEX_DATE = _dt.date(1999, 3, 1)
VERSION_2021 = _dt.date(2021, 10, 31)
VERSION_2024 = _dt.date(2024, 6, 1)


def period_label(index_date: _dt.date) -> str:
    """'2024_march' style label used in medication column names."""
    return f"{index_date.year}_{index_date.strftime('%B').lower()}"


def baseline_concepts() -> list[str]:
    """Nearest-value concepts in output order: derived first, then the list minus the
    two urine components, minus height (height is a post-index mean)."""
    base = [c for c in BIOMARKERS if c not in ("albumin_urine", "creatinine_urine")]
    base = ["egfr", "acr_from_separate"] + base
    return [c for c in base if c != "height"]


def medication_concepts() -> list[str]:
    return OHA_CLASSES + SEMA_SUBCLASSES + DRUGS


def efi_short(name: str) -> str:
    return EFI_SHORT_NAMES.get(name, name)
