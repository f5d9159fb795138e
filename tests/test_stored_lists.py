"""Identity by plan, lists added to stored events, buckets, names, own index dates, runtime filter."""
import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortsmith import config as C
from cohortsmith.operators import attrition as A
from cohortsmith.operators import baseline as B
from cohortsmith.operators import landmarks as L
from cohortsmith.operators import sketches as SK
from cohortsmith.plans import registry
from cohortsmith.plans.pipeline import CohortBuild
from cohortsmith.sources import coded
from cohortsmith.sources import codelists as CL
from cohortsmith.sources import fixtures as X
from cohortsmith.sources import store as S
from cohortsmith.sources import tables as TW
from cohortsmith.sources.adapter import Warehouse

SF = "/root/testdata/sf0.001"
IDX = C.INDEX_DATE


@pytest.fixture(scope="module")
def build(spark):
    return registry.build_for(spark, SF)


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range|round|Single|rebalance)", plan(df)))


# -- identity by plan ------------------------------------------------------------------------


def test_digest_follows_the_plan_and_nothing_else(spark, build):
    one = lambda: build.wh.observation.filter(F.col("testvalue") > 3).groupBy("patid").agg(F.max("testvalue").alias("m"))
    again = Warehouse(spark, SF).observation.filter(F.col("testvalue") > 3).groupBy("patid").agg(F.max("testvalue").alias("m"))
    assert S.plan_digest(one()) == S.plan_digest(one()) == S.plan_digest(again)
    others = [build.wh.observation.filter(F.col("testvalue") > 4).groupBy("patid").agg(F.max("testvalue").alias("m")),
              one().withColumnRenamed("m", "n"), Warehouse(spark, "/root/testdata/sf0.01").observation.filter(F.col("testvalue") > 3)
              .groupBy("patid").agg(F.max("testvalue").alias("m")), one().filter(F.transform(F.array("m"), lambda x: x + 1)[0] > 2)]
    assert len({S.plan_digest(x) for x in [one(), *others]}) == 5
    lam = lambda: one().withColumn("t", F.transform(F.array("m"), lambda x: x + 1))
    assert S.plan_digest(lam()) == S.plan_digest(lam())


def test_no_code_bytes_in_names(spark, build, monkeypatch):
    """Nothing but plans decides a name: with another module text (a comment) every name stays."""
    before = set(S.derived_tables(spark).filter(F.col("data_version") == build.wh.version).select("name", "stored").toPandas().itertuples(index=False, name=None))
    monkeypatch.setattr("builtins.open", lambda *a, **k: pytest.fail("a stored name reads code"))
    fresh = CohortBuild(Warehouse(spark, SF), deficits=X.efi_deficits())
    fresh.biomarkers, fresh.comorbidities  # noqa: B018
    monkeypatch.undo()
    after = set(S.derived_tables(spark).filter(F.col("data_version") == build.wh.version).select("name", "stored").toPandas().itertuples(index=False, name=None))
    assert {n for n, _ in after - before} <= {"biomarkers", "comorbidities", "patient_dimension", "clean_measurements"} or after == before
    again = CohortBuild(Warehouse(spark, SF), deficits=X.efi_deficits())
    assert again.biomarkers.inputFiles() == fresh.biomarkers.inputFiles()


def test_a_changed_limit_changes_what_depends_on_it(spark, build, monkeypatch):
    limits = [(c, lo, hi - 1 if c == "acr" else hi) for c, lo, hi in X.VALUE_LIMITS]
    build = CohortBuild(Warehouse(spark, SF), deficits=X.efi_deficits())  # reads the current versions
    old = {t: sorted(getattr(build, t).inputFiles()) for t in ("clean", "biomarkers", "comorbidities", "medications", "stage", "people")}
    monkeypatch.setattr(X, "VALUE_LIMITS", limits)
    other = CohortBuild(Warehouse(spark, SF), deficits=X.efi_deficits())
    new = {t: sorted(getattr(other, t).inputFiles()) for t in old}
    assert {t for t in old if old[t] != new[t]} == {"clean", "biomarkers"}
    assert other._observations[1] == build._observations[1]


def test_rows_in_memory_have_no_name(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(S.UnidentifiedInput):
        S.plan_digest(df)
    df.createOrReplaceTempView("rows_in_memory")
    view = TW.TableWarehouse(spark, {"patient": "rows_in_memory"})
    with pytest.raises(TW.ContractError, match="version"):
        S.plan_digest(spark.table("rows_in_memory"), view.version_of)
    named = [TW.TableWarehouse(spark, {"patient": "rows_in_memory"}, version=v) for v in "ab"]
    assert S.plan_digest(df, named[0].version_of) != S.plan_digest(df, named[1].version_of)


def test_catalog_table_follows_its_files(spark, tmp_path):
    spark.range(3).write.option("path", str(tmp_path / "t")).saveAsTable("follow_me")
    try:
        first = S.plan_digest(spark.table("follow_me"))
        assert first == S.plan_digest(spark.table("follow_me"))
        spark.range(2).write.mode("append").parquet(str(tmp_path / "t"))
        spark.catalog.refreshTable("follow_me")
        assert S.plan_digest(spark.table("follow_me")) != first
    finally:
        spark.sql("DROP TABLE follow_me")


# -- lists added to what is stored --------------------------------------------------------------


def test_only_new_lists_are_extracted(spark, build):
    codes = build.observation_codes.filter(F.col("family") == "measure")
    asked = []

    def extract(c):
        asked.append({r["concept"] for r in c.select("concept").distinct().collect()})
        return build._extract_observations(c)
    store = coded.CodedEvents(spark, "probe", uuid.uuid4().hex, extract)
    some = ["potassium", "acr", "hdl"]
    first = store.ensure(codes.filter(F.col("concept").isin(some)))
    assert store.ensure(codes.filter(F.col("concept").isin(some))) == first and asked == [set(some)]
    second = store.ensure(codes.filter(F.col("concept").isin([*some, "sbp"])))
    assert asked[1:] == [{"sbp"}] and {k: second[k] for k in first} == first
    schema = build._observations[2]
    got = store.read(second, schema)
    want = build.observations_of("measure").filter(F.col("concept").isin([*some, "sbp"]))
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).isEmpty()
    # a list whose codes changed is extracted anew, the others stay
    fewer = codes.filter(F.col("concept").isin(some)).filter(~((F.col("concept") == "acr") & (F.col("code").cast("int") % 2 == 0)))
    third = store.ensure(fewer)
    assert asked[2:] == [{"acr"}] and {c for (_, c) in third if third["measure", c] != first["measure", c]} == {"acr"}
    assert store.read(third, schema).filter("concept = 'acr'").count() < got.filter("concept = 'acr'").count()


def test_a_list_without_events_is_remembered(spark, build):
    asked = []

    def extract(c):
        asked.append(1)
        return build._extract_observations(c)
    store = coded.CodedEvents(spark, "probe", uuid.uuid4().hex, extract)
    codes = spark.createDataFrame([("measure", "nothing", "no such code")], "family string, concept string, code string")
    runs = store.ensure(codes)
    assert store.ensure(codes) == runs and len(asked) == 1 and store.read(runs, build._observations[2]).count() == 0


def test_duplicate_codes_are_refused(spark, build):
    codes = spark.createDataFrame([("measure", "acr", "1"), ("measure", "acr", "1")], "family string, concept string, code string")
    with pytest.raises(CL.DuplicateCodes, match="acr"):
        coded.CodedEvents(spark, "probe", uuid.uuid4().hex, build._extract_observations).ensure(codes)


# -- buckets and names ------------------------------------------------------------------------


def test_star_join_of_stored_tables_exchanges_nothing(spark, build, no_broadcast):
    build.cross_section(with_efi=True)
    df = build.cross_section_plan(with_efi=True)
    assert exchanges(df) == 0 and plan(df).count("SortMergeJoin") == 6
    assert exchanges(build.with_options(spine=build.spine).biomarkers) <= 4
    assert exchanges(build.baseline_landmarks(registry.LANDMARKS)) <= 1


def test_buckets_in_another_session(spark, build, no_broadcast):
    df = S.read_derived(spark.newSession(), "biomarkers", build.wh.version)
    assert df.count() == build.biomarkers.count()
    n = f"probe_{uuid.uuid4().hex}"
    S.materialize(spark.range(100).select(F.col("id").cast("string").alias("patid"), "id"), n, namespace="tests", bucket_by="patid")
    spark.sql("DROP TABLE cohortsmith_" + S._READ[(spark.sparkContext.applicationId, S.table_path(spark, "tests", n))][0].replace("-", "_"))
    S._READ.clear()
    back = S.read_stored(spark, "tests", n)  # as a session with an empty catalog reads it
    assert back.count() == 100 and exchanges(back.groupBy("patid").count()) == 0


def test_names_and_provenance(spark, build):
    build.with_options(hospital=True).comorbidities, build.comorbidities  # noqa: B018
    v = build.wh.version
    assert "pre_index_date_primary_hhf" in S.read_derived(spark, "comorbidities", v, hospital=True).columns
    assert "pre_index_date_primary_hhf" not in S.read_derived(spark, "comorbidities", v, hospital=False).columns
    with pytest.raises(KeyError):
        S.read_derived(spark, "no_such_table")
    assert "biomarkers" in S.publish_views(spark) and spark.table("biomarkers").columns[0] == "patid"
    row = S.derived_tables(spark).filter((F.col("name") == "biomarkers") & (F.col("data_version") == v)).first()
    assert row["options"]["index_date"] == str(IDX)


def test_buckets_follow_the_size_of_the_warehouse(spark, no_broadcast, tmp_path):
    few = S.store_buckets(spark)
    assert S.store_buckets(spark, few * S.BUCKET_BYTES) == few and S.store_buckets(spark, 5 * few * S.BUCKET_BYTES) == 8 * few
    for name in Warehouse.TABLES:
        spark.read.parquet(f"{SF}/{name}.parquet").limit(50).write.parquet(str(tmp_path / f"{name}.parquet"))
    wh = Warehouse(spark, str(tmp_path))
    assert wh.n_bytes > 0 and CohortBuild(wh).buckets == few
    wh.n_bytes = 2 * few * S.BUCKET_BYTES
    b = CohortBuild(wh)
    seen = set(S._READ)
    b.people, b.cohort_attributes  # noqa: B018
    assert {S._READ[k][2] for k in set(S._READ) - seen if "/all_patid/" in k[1]} == {2 * few}
    both = b.people.join(b.cohort_attributes, "patid")
    assert exchanges(both) == 0 and both.count() == wh.patient.count()


def test_stored_tables_are_made_by_tasks_that_follow_the_size(spark, no_broadcast, tmp_path, monkeypatch):
    """Joins and scans of a stored table begin with as many parts as it has buckets; the session's own settings come back."""
    for name in Warehouse.TABLES:
        spark.read.parquet(f"{SF}/{name}.parquet").limit(50).write.parquet(str(tmp_path / f"{name}.parquet"))
    wh, few = Warehouse(spark, str(tmp_path)), S.store_buckets(spark)
    wh.n_bytes = 8 * few * S.BUCKET_BYTES
    keys = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.files.maxPartitionBytes")
    before, seen, whole = [spark.conf.get(k, None) for k in keys], [], S.materialize
    monkeypatch.setattr(S, "materialize", lambda *a, **how: seen.append([spark.conf.get(k, None) for k in keys]) or whole(*a, **how))
    assert CohortBuild(wh).people.count() == wh.patient.count()
    assert seen == [[str(8 * few), str(coded.TASK_BYTES), str(coded.TASK_BYTES)]]
    assert [spark.conf.get(k, None) for k in keys] == before


# -- exchanges of the events ------------------------------------------------------------------


def test_hospital_lists_are_broadcast(spark, build, no_broadcast):
    for key in ("hosp_prefix_join", "hosp_procedures"):
        p = plan(registry.QUERIES[key](spark, SF))
        assert p.count("Exchange hashpartitioning") == 2 and "BroadcastHashJoin" in p, key  # lines and orders, once each


def test_observations_meet_values_and_lists_in_one_exchange(build, no_broadcast):
    p = plan(build.coded_observations_plan)
    assert p.count("Exchange hashpartitioning(medcodeid") == 1 and "hashpartitioning(l_partkey" not in p


def test_extraction_writes_without_an_exchange_of_its_own(spark, build, monkeypatch):
    hints, keys = [], ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = [spark.conf.get(k, None) for k in keys]
    whole = DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda df, name, *a: hints.append(name) or whole(df, name, *a))
    store = coded.CodedEvents(spark, "probe", uuid.uuid4().hex, build._extract_observations, 1000 * coded.PARTITION_BYTES)
    assert store._sized()[keys[1]] == 1000
    runs = store.ensure(build.observation_codes)
    want = build.coded_observations_plan
    got = store.read(runs, want.schema).select(*want.columns)
    assert not hints and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert [spark.conf.get(k, None) for k in keys] == before


# -- index dates --------------------------------------------------------------------------------


def test_window_bounds_of_own_index_dates_reach_the_scan(build):
    own = registry._by_patient(build)
    lo, hi = own.index_bounds
    p = plan(own.baseline_long)
    scans = p[p.index("FileScan"):]
    assert f">= {lo + dt.timedelta(days=C.BASELINE_LO)}" in p and f"<= {hi + dt.timedelta(days=C.BASELINE_HI)}" in p and "GreaterThanOrEqual(date" in scans


def test_one_index_date_for_all_is_a_special_case(spark, build):
    few = build.wh.patient.filter(F.col("patid").cast("int") % 3 == 0).select("patid", F.lit(IDX).alias("index_date"))
    own = build.with_options(index_dates=few)
    for t in ("biomarkers", "comorbidities", "stage", "efi"):
        mine, all_ = getattr(own, t).join(few, "patid", "left_semi"), getattr(build, t).join(few, "patid", "left_semi")
        assert mine.count() == few.count() and mine.exceptAll(all_.select(*mine.columns)).isEmpty(), t
    assert own.cross_section().count() == build.cross_section().join(few, "patid", "left_semi").count()
    rest = own.biomarkers.join(few, "patid", "left_anti").drop("patid")
    assert rest.count() > 0 and rest.dropna("all").count() == 0
    with pytest.raises(ValueError, match="patid"):
        build.with_options(index_dates=few.unionByName(few)).index_dates


def test_landmarks_equal_one_build_per_date(spark, build):
    got = build.baseline_landmarks(registry.LANDMARKS)
    ev = build.all_measures.filter(F.col("concept").isin(C.baseline_concepts() + [C.HBA1C]))
    for d in registry.LANDMARKS:
        one = B.nearest_to_index(ev, d, one_row_per_day=True)
        mine = got.filter(F.col("landmark") == d).drop("landmark")
        assert sorted(map(str, mine.collect())) == sorted(map(str, one.collect()))
    assert "Join" not in plan(L.nearest_at_landmarks(build.clean, L.landmark_rows(build.spine, registry.LANDMARKS, ["acr"])))


def test_landmark_ties_and_nulls(spark):
    day = lambda n: IDX + dt.timedelta(days=n)
    ev = spark.createDataFrame([("p", "x", day(-2), 5.0), ("p", "x", day(2), 4.0), ("q", "x", day(-2), 4.0), ("q", "x", day(2), 4.0), ("r", "x", day(0), None),
                                ("s", "egfr", day(-3), 1.0), ("s", "egfr", day(3), 2.0), ("t", "x", day(-731), 1.0), ("t", "x", day(8), 1.0), ("u", "x", day(0), 9.0)],
                               "patid string, concept string, date date, value double")
    marks = L.landmark_rows(ev.select("patid").distinct(), [IDX], ["x", "egfr"])
    got = {r["patid"]: (r["value"], r["datediff"]) for r in L.nearest_at_landmarks(ev, marks).collect()}
    assert got == {"p": (4.0, 2), "q": (4.0, -2), "s": (2.0, 3), "u": (9.0, 0)}
    with pytest.raises(ValueError):
        L.nearest_at_landmarks(ev, marks, lo=1, hi=5)


# -- attrition, sketches, runtime filter ------------------------------------------------------------


def test_attrition_counts(spark, build):
    df = spark.createDataFrame([("a", 1, 1), ("a", None, 1), ("b", 0, 1), ("c", 1, None), ("c", 1, 0)], "patid string, x int, y int")
    rules = {"x": F.col("x") > 0, "y": F.col("y") > 0}
    assert [tuple(r) for r in A.attrition(df, rules).orderBy("step").collect()] == [(0, "all", 5, 3), (1, "x", 3, 2), (2, "y", 1, 1)]
    assert [tuple(r)[2:] for r in A.attrition(df.limit(0), rules).collect()] == [(0, 0)] * 3
    last = build.cohort_attrition().orderBy(F.desc("step")).first()
    assert last["n_patients"] == build.analysis_ready().count()


def test_attrition_reads_its_rows_once(spark, tmp_path):
    spark.range(100).select(F.col("id").cast("string").alias("patid"), "id").write.parquet(str(tmp_path / "rows"))
    df = A.attrition(spark.read.parquet(str(tmp_path / "rows")), {"a": F.col("id") > 5, "b": F.col("id") > 7})
    assert plan(df).count("FileScan") == 1


def test_sketches_merge_within_the_bound(spark):
    rows = spark.range(60_000).select(F.lit("s").alias("stratum_"), ((F.col("id") * 7919) % 60_000).cast("double").alias("v"), "id")
    parts = [SK.sketch_values(rows.filter(F.col("id") % 3 == k), ["v"], "stratum_") for k in range(3)]
    got = SK.table_one_sketched(SK.merge_sketches(*parts)).first()
    assert got["n"] == 60_000 and abs(got["mean"] - 29_999.5) < 1e-6
    for c, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75)):
        assert abs(got[c] / 60_000 - p) <= SK.rank_error()
    ok = SK.rank_within(rows, ["v"], "stratum_", SK.table_one_sketched(SK.merge_sketches(*parts)), SK.rank_error()).first()
    assert ok["p25_within"] and ok["median_within"] and ok["p75_within"]
    off = SK.table_one_sketched(SK.merge_sketches(*parts)).withColumn("median", F.col("median") + 6000)
    assert not SK.rank_within(rows, ["v"], "stratum_", off, SK.rank_error()).first()["median_within"]


def test_events_are_filtered_by_the_cohort_before_their_exchange(spark, build, no_broadcast):
    conf = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1", "spark.sql.optimizer.runtime.bloomFilter.enabled": "true"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        few = build.with_options(spine=build.cohort_ids(), cohort_only=True)
        p = plan(few._of_cohort(few.prescriptions_of("drug", "oha")))
        assert "might_contain" in p
        assert p.index("Exchange hashpartitioning(patid") < p.index("might_contain")  # the filter stands below it
        want = build.medications.join(build.cohort_ids(), "patid", "left_semi")
        assert few.medications.count() == want.count() and few.medications.exceptAll(want.select(*few.medications.columns)).isEmpty()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_cross_section_on_the_cohort_equals_the_stored_one(build):
    on, stored = build.cross_section_plan(on_cohort=True), build.cross_section()
    assert on.count() == stored.count() and sorted(map(str, on.select(*stored.columns).collect())) == sorted(map(str, stored.collect()))


def test_lists_on_demand_equal_those_of_one_scan(build, spark, tmp_path):
    """Biomarkers extract the measurements' lists alone; another family is extracted when it is read."""
    paths = TW.write_tables(build.wh, str(tmp_path))
    asked = CohortBuild(TW.TableWarehouse(spark, paths), deficits=X.efi_deficits(), on_demand=True)
    assert sorted(map(tuple, asked.biomarkers.collect())) == sorted(map(tuple, build.biomarkers.collect()))
    store, runs, _ = asked._observations_by[("measure",)]
    assert {f for f, _ in runs} == {"measure"} == {r["family"] for r in store.manifest.collect()}
    count = lambda df: sorted(map(tuple, df.groupBy("family", "concept").count().collect()))
    assert count(asked.observations_of("efi")) == count(build.observations_of("efi"))
    assert {r["family"] for r in store.manifest.collect()} == {"measure", "efi"}
    assert count(CohortBuild(TW.TableWarehouse(spark, paths), deficits=X.efi_deficits()).coded_observations) == count(build.coded_observations)


def test_lists_on_demand_refuse_codes_that_stand_twice(build, spark):
    """Lists of families that are not asked for are checked as well."""
    codes = build.observation_codes
    twice = codes.unionByName(codes.filter(F.col("family") == "efi").limit(1))
    store = coded.CodedEvents(spark, "probe", uuid.uuid4().hex, build._extract_observations)
    with pytest.raises(CL.DuplicateCodes):
        store.ensure(twice, families=("measure",))
