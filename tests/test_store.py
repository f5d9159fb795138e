"""Stored tables: identity, versions, refresh, unique keys; the table warehouse's contracts."""
import datetime as dt
import os
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from cohortsmith import config as C
from cohortsmith.plans.pipeline import CohortBuild
from cohortsmith.sources import fixtures as X
from cohortsmith.sources import store as S
from cohortsmith.sources import tables as TW
from cohortsmith.sources.adapter import Warehouse

SF = "/root/testdata/sf0.001"


def name():
    return f"probe_{uuid.uuid4().hex}"


@pytest.fixture(scope="module")
def build(spark):
    return CohortBuild(Warehouse(spark, SF), deficits=X.efi_deficits())


def test_two_builds_on_one_store_do_not_mix(build):
    plain = build.cross_section()
    hosp = build.with_options(hospital=True).cross_section()
    assert "pre_index_date_primary_hhf" in hosp.columns and "pre_index_date_primary_hhf" not in plain.columns
    flags = [F.sum(F.col(f"pre_index_date_{c}").cast("int")).alias(c) for c in ("asthma", "af")]
    assert plain.agg(*flags).first() != hosp.agg(*flags).first()
    custom = build.with_options(deficits=["efi_1", "efi_2"]).cross_section(with_efi=True)
    full = build.cross_section(with_efi=True)
    count = lambda df: len([c for c in df.columns if c.startswith("pre_index_date_efi_")])
    assert count(full) > count(custom)
    linked = build.with_options(linked_only=True).cross_section()
    assert 0 < linked.count() < plain.count() and linked.filter("with_hes <> 1").count() == 0
    assert "pre_index_date_primary_hhf" not in build.with_options().cross_section().columns


def test_a_custom_spine_is_not_stored_under_the_shared_name(build, spark):
    few = spark.createDataFrame([("1",), ("2",)], "patid string")
    assert build.with_spine(few).biomarkers.count() == 2
    assert CohortBuild(Warehouse(spark, SF)).biomarkers.count() == build.spine.count()


def test_new_data_at_an_old_path_is_seen(spark, tmp_path):
    for t in Warehouse.TABLES:
        shutil.copy(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    wh = Warehouse(spark, str(tmp_path))
    before = CohortBuild(wh).biomarkers.count()
    spark.read.parquet(f"{SF}/customer.parquet").orderBy("c_custkey").limit(50).write.parquet(str(tmp_path / "new"))
    os.remove(tmp_path / "customer.parquet")
    os.rename(tmp_path / "new", tmp_path / "customer.parquet")
    again = Warehouse(spark, str(tmp_path))
    assert again.version != wh.version
    assert CohortBuild(again).biomarkers.count() == 50 < before


def test_failed_refresh_keeps_the_old_version(spark):
    n = name()
    S.materialize(spark.createDataFrame([(1,)], "x int"), n, namespace="tests")
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    with pytest.raises(Exception, match="no"):
        S.materialize(bad, n, namespace="tests", refresh=True)
    S._READ.clear()
    assert [r.x for r in S.read_stored(spark, "tests", n).collect()] == [1]


def test_an_unfinished_version_is_not_read(spark):
    n = name()
    spark.range(3).write.parquet(f"{S.table_path(spark, 'tests', n)}/v1-half")
    assert S.read_stored(spark, "tests", n) is None


def test_duplicate_keys_raise_on_store(spark):
    n = name()
    with pytest.raises(ValueError, match="patid"):
        S.materialize(spark.createDataFrame([("a",), ("a",)], "patid string"), n, namespace="tests", unique="patid")
    assert S.read_stored(spark, "tests", n) is None


def test_build_refresh_writes_a_new_version(spark, build):
    old = build.stage.inputFiles()
    new = CohortBuild(build.wh, deficits=X.efi_deficits(), refresh=True).stage
    assert set(new.inputFiles()).isdisjoint(old) and sorted(new.collect()) == sorted(build.stage.collect())


def test_table_warehouse_checks_its_contracts(spark, build, tmp_path):
    paths = TW.write_tables(build.wh, str(tmp_path))
    wh = TW.TableWarehouse(spark, paths)
    assert {t: getattr(wh, t).count() for t in ("patient", "observation")} == {t: getattr(build.wh, t).count() for t in ("patient", "observation")}
    spark.read.parquet(paths["dob"]).withColumn("extra", F.lit(1)).write.parquet(str(tmp_path / "wide"))
    assert TW.TableWarehouse(spark, {"dob": str(tmp_path / "wide")}).dob.columns == ["patid", "dob"]
    spark.read.parquet(paths["dob"]).drop("dob").write.parquet(str(tmp_path / "short"))
    with pytest.raises(TW.ContractError, match="missing"):
        TW.TableWarehouse(spark, {"dob": str(tmp_path / "short")}).dob
    spark.read.parquet(paths["dob"]).withColumn("dob", F.col("dob").cast("string")).write.parquet(str(tmp_path / "typed"))
    with pytest.raises(TW.ContractError, match="not date"):
        TW.TableWarehouse(spark, {"dob": str(tmp_path / "typed")}).dob
    with pytest.raises(TW.ContractError):
        TW.TableWarehouse(spark, {"no_such": "x"})
    spark.read.parquet(paths["patient"]).createOrReplaceTempView("patients_by_name")
    assert TW.TableWarehouse(spark, {"patient": "patients_by_name"}, version="1").patient.count() == build.wh.patient.count()


def test_cross_section_column_order(build):
    cols = build.cross_section().columns
    assert cols[0] == "patid" and cols.index("index_date_dm_dur_all") == cols.index("index_date_age") + 1
    assert cols.index("gender") == cols.index("index_date_dm_dur_all") + 1


def test_no_feature_is_empty(spark):
    b = CohortBuild(Warehouse(spark, "/root/testdata/sf0.01"), deficits=X.efi_deficits())
    for df in (b.biomarkers, b.medications):
        seen = df.agg(*[F.count(c).alias(c) for c in df.columns]).first().asDict()
        assert not [c for c, n in seen.items() if n == 0]


def test_fixed_values():
    """The analysis' constants, as literals."""
    assert (C.BASELINE_LO, C.BASELINE_HI, C.PREFER_MAX) == (-730, 7, ["egfr"])
    assert (C.HBA1C_PERCENT_MAX, C.HBA1C_OFFSET, C.HBA1C_SLOPE, C.HBA1C_MIN_YEAR) == (20.0, 2.152, 0.09148, 1990)
    assert (C.POTASSIUM_LO, C.POTASSIUM_HI, C.POTASSIUM_UNITS) == (2.5, 6.5, [218, 425, None])
    assert C.CKD_STAGES == ["stage_5", "stage_4", "stage_3b", "stage_3a", "stage_2", "stage_1"] and C.CKD_GRACE_DAYS == 7
    assert (C.EFI_DENOMINATOR, C.EFI_CUTS, C.EFI_TOP) == (36, [(0.12, "fit"), (0.24, "mild"), (0.36, "moderate")], "severe")
    assert C.EFI_FORCED == ["efi_diabetes", "efi_polypharmacy"] and C.DAYS_PER_YEAR == 365.25
    assert C.ETHNICITY_LABELS == {0: "White", 1: "South Asian", 2: "Black", 3: "Other", 4: "Mixed"}
    assert (C.ELIG_UACR, C.ELIG_SBP, C.ELIG_MACRO_UACR, C.ELIG_SGLT2_EGFR) == (3.0, 110.0, 30.0, 90.0)
    assert (C.ELIG_FINE_EGFR_LO, C.ELIG_FINE_EGFR_HI, C.ELIG_POTASSIUM_MAX, C.ELIG_POTASSIUM_IF_MISSING) == (25.0, 60.0, 5.0, 5.5)
    assert C.ELIG_FINE_STAGES == ["stage_3a", "stage_3b", "stage_4"] and C.STAGE_ZERO_FROM == ["stage_1", "stage_2"]
    assert C.ASCVD_COMPONENTS == ["angina", "ihd", "myocardialinfarction", "pad", "revasc", "stroke", "tia"]
    assert (len(C.BIOMARKERS), len(C.COMORBIDITIES), len(C.medication_concepts())) == (16, 43, 19)
    assert C.DRUGS == ["ace_inhibitors", "arb", "ksparing_diuretics", "finerenone", "statins"]
    assert C.period_label(dt.date(2024, 3, 1)) == "2024_march"
