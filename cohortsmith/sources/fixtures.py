"""Fixture parameters for the synthetic test warehouse.

The analysis depends on tables that are not part of it (codelists, value
limits, unit whitelists, drug-class lookup).  For tests and benchmarks they
are derived from the driver's star schema by the rules below.  These are
our own synthetic choices -- never clinical defaults.  The SQL oracle uses
the very same rules (see ``cohortsmith.plans.oracle``).
"""

from __future__ import annotations

from .. import config as C

# p_type -> measurement concept, and the testvalue formula on l_quantity (q) for that type.
TYPE_CONCEPT = [
    ("ECONOMY", "creatinine_blood", "40 + 4 * q"),
    ("LARGE", "hba1c", "2 * q"),
    ("MEDIUM", "potassium", "2 + q / 10"),
    ("PROMO", "albumin_urine", "2 * q"),
    ("SMALL", "creatinine_urine", "q - 1"),
    ("STANDARD", "acr", "q"),
]

# p_size % 10 -> a second measurement concept on the same code (a code may sit in two lists).
SIZE_CONCEPT = [(0, "sbp"), (1, "dbp"), (2, "bmi"), (3, "height"), (4, "weight"), (5, "hdl"),
                (6, "triglyceride"), (7, "ldl"), (8, "alt"), (9, "ast")]

# Every so many-th p_partkey -> a third measurement concept on the same code.
THIRD_EVERY, THIRD_CONCEPT = 3, "totalcholesterol"

# p_partkey % 7 -> prescription concept (prodcode lists); insulin only in the 2024 version.
DRUG_CODE = [(0, "ace_inhibitors"), (1, "arb"), (2, "ksparing_diuretics"), (3, "finerenone"),
             (4, "statins"), (5, "insulin")]

# Frailty: brand number b -> deficit list 'efi_<b>' (b = 25 uses a long name that has a short alias).
EFI_LONG_BRAND = 25
EFI_LONG_NAME = "efi_mobility_and_transfer_problems"
EFI_FORCED_RULES = [("efi_diabetes", 1), ("efi_polypharmacy", 2)]  # p_partkey % 4 == r, brand <= 3



def efi_deficits() -> list[str]:
    """Frailty deficit lists of the fixture catalogue (sorted); a list with no codes at a small
    scale factor still yields its (all-FALSE) flag column."""
    return sorted([f"{C.EFI_PREFIX}{b}" for b in range(1, EFI_LONG_BRAND)] + [EFI_LONG_NAME]
                  + [n for n, _ in EFI_FORCED_RULES])


# Synthetic value limits (inclusive) per concept.  Potassium uses the analysis' own limits.
VALUE_LIMITS = [
    ("weight", 20.0, 300.0), ("height", 1.0, 250.0), ("bmi", 10.0, 80.0), ("hdl", 0.0, 1000.0),
    ("triglyceride", 0.0, 1000.0), ("creatinine_blood", 50.0, 200.0), ("ldl", 0.0, 1000.0),
    ("alt", 0.0, 1000.0), ("ast", 0.0, 1000.0), ("totalcholesterol", 0.0, 1000.0),
    ("dbp", 30.0, 150.0), ("sbp", 50.0, 250.0), ("acr", 0.5, 60.0), ("albumin_urine", 0.0, 1000.0),
    ("creatinine_urine", 0.0, 1000.0), ("potassium", C.POTASSIUM_LO, C.POTASSIUM_HI),
    ("hba1c", 20.0, 195.0),
]

# Synthetic unit whitelist: 218 and 425 everywhere; NULL unit only where listed; 999 never.
NULL_UNIT_OK = ["potassium", "hba1c", "acr", "albumin_urine", "creatinine_urine"]


def unit_rows() -> list[tuple[str, int | None]]:
    rows: list[tuple[str, int | None]] = []
    for concept, _, _ in VALUE_LIMITS:
        rows.append((concept, 218))
        rows.append((concept, 425))
        if concept in NULL_UNIT_OK:
            rows.append((concept, None))
    return rows


def comorbidity_brands() -> list[tuple[str, int]]:
    """Comorbidity i (0-based, list order) uses the codes of brand (i % 25) + 1, so the
    first 18 brands feed two concepts each."""
    return [(name, (i % 25) + 1) for i, name in enumerate(C.COMORBIDITIES)]


def icd10_rows() -> list[tuple[str, str]]:
    """Hospital ICD-10 prefix lists (lengths 2, 3, 4) for a few comorbidities (incl. hypertension,
    which the hospital path excludes, and heart failure, used for the primary-cause concept)."""
    rows = []
    for i in list(range(10)) + [12, 13]:
        concept = "icd10_" + C.COMORBIDITIES[i]
        rows.append((concept, "I" + str(i % 10)))
        rows.append((concept, "I" + str((i * 7 + 3) % 100).zfill(2)))
        rows.append((concept, "I" + str((i * 37 + 11) % 1000).zfill(3)))
    return rows


def opcs4_rows() -> list[tuple[str, str]]:
    rows = []
    for i in [12, 22, 38, 39]:
        concept = "opcs4_" + C.COMORBIDITIES[i]
        rows.append((concept, "K" + str((i * 11) % 100).zfill(2)))
        rows.append((concept, "K" + str((i * 11 + 5) % 100).zfill(2)))
    return rows


OHA_CLASS_BY_SIZE = ["dpp4", "glp1", "mfn", "sglt2", "su", "tzd", "glinide", "insulin",
                     "acarbose", "gipglp1"]  # p_size % 10
SEMA_BY_KEY = ["ldsema", "hdsema", "osema", "sema_query"]  # p_partkey % 4, glp1 only
