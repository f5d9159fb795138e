"""The feature families wired together over a warehouse.

``CohortBuild`` holds one index date and derives, on demand, every intermediate and final
table of the analysis.  Each property is a DataFrame.  Properties that are stored tables
(coded events, clean measurements, features, cross-section, extract) run Spark jobs when first
read: they write the table unless the same data, code and options have stored it before.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators import attrition as A
from ..operators import baseline as B
from ..operators import cohort as CO
from ..operators import events as E
from ..operators import features as FT
from ..operators import landmarks as L
from ..operators import measures as M
from ..operators import sketches as SK
from ..sources import codelists as CL
from ..sources import store as S
from ..sources.adapter import Warehouse
from ..sources.coded import CodedEvents, settings, sized_scans


class CohortBuild:
    """All tables of one analysis at one index date, or at one of each patient's own.

    Event tables are extracted once per source and list (``coded_observations``,
    ``coded_prescriptions``) and stored; cleaning, derived measures, baseline picks and per-family feature tables are built
    from them on first access.  Feature tables on the full patient spine are stored; with a custom
    ``spine`` they stay lazy.  ``deficits`` fixes the frailty lists (else found in the catalogue)."""

    def __init__(self, wh: Warehouse, index_date: dt.date = C.INDEX_DATE, spine: DataFrame | None = None,
                 deficits: list[str] | None = None, hospital: bool = False, linked_only: bool = False,
                 version: dt.date = C.VERSION_2024, earlier_version: dt.date = C.VERSION_2021,
                 creatinine_unit: str = "umol/L", refresh: bool = False, index_dates: DataFrame | None = None,
                 cohort_only: bool = False, on_demand: bool = False):
        """``hospital=True`` adds the (dormant) hospital sources to the comorbidities: ICD-10
        prefix lists (hypertension excluded), OPCS-4 lists, a primary-cause heart-failure
        concept, and the source-aware validity rule.  ``linked_only=True`` keeps patients with
        hospital linkage.  ``version`` is the codelist version, ``earlier_version`` the one that
        comorbidities prefer and drugs use.  ``refresh=True`` writes every stored table anew, once
        per build.  ``index_dates`` (patid, index_date; unique patid) gives each patient an index
        date instead of ``index_date``; patients without one have no features.  ``cohort_only=True``
        reduces the events to the prevalent cohort before they are exchanged.  ``on_demand=True``
        extracts the observations' lists of a family when a feature first reads it, for a build that
        makes few features; else one scan extracts those of all families."""
        self.wh = wh
        self.index_date = index_date
        self._index_dates = index_dates
        self.cohort_only = cohort_only
        self.on_demand = on_demand
        self.label = C.period_label(index_date) if index_dates is None else "index"
        self._spine = spine
        self._deficits = deficits
        self.hospital = hospital
        self.linked_only = linked_only
        self.version, self.earlier_version = version, earlier_version
        self.creatinine_unit = creatinine_unit
        self.refresh = refresh

    def _options(self) -> dict:
        return {"spine": self._spine, "deficits": self._deficits, "hospital": self.hospital, "linked_only": self.linked_only,
                "version": self.version, "earlier_version": self.earlier_version, "creatinine_unit": self.creatinine_unit,
                "index_dates": self._index_dates, "cohort_only": self.cohort_only,
                "on_demand": self.on_demand}

    def with_options(self, **changed) -> "CohortBuild":
        """Same warehouse and index date with other options; what does not depend on them is read
        from the same stored tables."""
        return CohortBuild(self.wh, self.index_date, **{**self._options(), **changed})

    def with_spine(self, spine: DataFrame) -> "CohortBuild":
        """Same index date and event tables, features attached to another spine."""
        return self.with_options(spine=spine)

    def _keep(self, df: DataFrame, name: str, namespace: str, **how) -> DataFrame:
        """``df`` stored under a name that holds the identity of its plan and inputs; a new table is
        registered under its plain name, for other sessions (``store.read_derived``)."""
        spark, key = df.sparkSession, f"{name}_{S.plan_digest(df, self.wh.version_of)}"
        got = None if self.refresh else S.read_stored(spark, namespace, key)
        if got is None:
            if "bucket_by" in how:
                how["buckets"] = self.buckets
            with settings(spark, sized_scans(spark, self.buckets)):
                got = S.materialize(df, key, namespace=namespace, refresh=self.refresh, **how)
            S.register_name(spark, name, namespace, key, self.wh.version, self.provenance)
        return got

    @cached_property
    def buckets(self) -> int:
        """Buckets of all stored tables of this warehouse: its size decides, so that they agree and
        a task's bucket does not grow with the data."""
        return S.store_buckets(self.wh.spark, self.wh.n_bytes)

    @property
    def provenance(self) -> dict:
        """What a derived table was made with, as it is registered beside its name."""
        return {"index_date": self.index_date if self._index_dates is None else "by patient", "hospital": self.hospital,
                "linked_only": self.linked_only, "version": self.version, "earlier_version": self.earlier_version,
                "creatinine_unit": self.creatinine_unit, "deficits": "all" if self._deficits is None else ",".join(self._deficits)}

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        """Feature tables over the full patient spine are stored once (as the analysis stores each
        family's final table), one row per patient in buckets of patid; on a custom spine they stay
        lazy."""
        if self._spine is not None:
            return df
        return self._keep(df, name, "features", unique="patid", bucket_by="patid")

    # -- the index date, one for all or one per patient -------------------------------
    @cached_property
    def index_dates(self) -> DataFrame | None:
        """The patients' own index dates, stored by their content in buckets of patid."""
        if self._index_dates is None:
            return None
        df = self._index_dates.select(F.col("patid").cast("string"), F.col("index_date").cast("date"))
        h = F.xxhash64("patid", "index_date")
        content = df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h % (1 << 40))).first()
        return S.materialize(df, f"index_dates_{S.digest(tuple(content))}", namespace="index_dates", unique="patid", bucket_by="patid",
                             buckets=self.buckets)

    @property
    def index(self):
        """The index date as the operators take it: a literal date or the spine's column."""
        return self.index_date if self._index_dates is None else F.col("index_date")

    @cached_property
    def index_bounds(self) -> tuple:
        """Earliest and latest index date (one row)."""
        return tuple(self.index_dates.agg(F.min("index_date"), F.max("index_date")).first())

    def _indexed(self, ev: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
        """Events with their patient's index date.  A day window has no literal bounds then, so the
        bounds over all index dates are given beside it: they reach the scan."""
        if self._index_dates is None:
            return ev
        first, last = self.index_bounds
        if lo is not None and first is not None:
            ev = ev.filter(F.col("date").between(F.lit(first + dt.timedelta(days=lo)), F.lit(last + dt.timedelta(days=hi))))
        return ev.join(self.index_dates, "patid")

    def _indexed_rows(self, table: DataFrame) -> DataFrame:
        """A one-row-per-patient table with the patient's index date."""
        return table if self._index_dates is None else table.join(self.index_dates, "patid")

    def _of_cohort(self, ev: DataFrame) -> DataFrame:
        """Events of the prevalent cohort only, where the build asks for that: a semi-join on the
        exchange of the events, ahead of which Spark puts its runtime filter."""
        return ev.join(self.cohort_ids(), "patid", "left_semi") if self.cohort_only else ev

    # -- patients, one row each, in buckets of patid ------------------------------------
    @cached_property
    def people(self) -> DataFrame:
        """patid, in_spine, gender, dob and registration dates: one stored patient dimension."""
        spine = self.wh.patient.select("patid", "gender", F.lit(True).alias("in_spine"))
        df = spine.join(self.wh.dob.select("patid", "dob"), "patid", "full").join(self.wh.valid_dates, "patid", "full")
        return self._keep(df.withColumn("in_spine", F.coalesce("in_spine", F.lit(False))), "patient_dimension", "all_patid",
                          unique="patid", bucket_by="patid")

    @cached_property
    def cohort_attributes(self) -> DataFrame:
        """The diabetes cohort, stored in buckets of patid (with the patients' own index dates)."""
        df = self._keep(self.wh.diabetes_cohort, "diabetes_cohort", "all_patid", unique="patid", bucket_by="patid")
        return df if self._index_dates is None else df.join(self.index_dates, "patid")

    @cached_property
    def spine(self) -> DataFrame:
        return self._spine if self._spine is not None else self.people.filter("in_spine").select("patid")

    # -- codelists ----------------------------------------------------------
    @cached_property
    def codes_2024(self) -> DataFrame:
        return CL.codelist_version(self.wh.codelists, self.version)

    @cached_property
    def codes_2021(self) -> DataFrame:
        return CL.codelist_version(self.wh.codelists, self.earlier_version)

    # -- one scan per event table for every codelist family, stored once -----------
    @cached_property
    def tag(self) -> str:
        return S.digest(self.wh.version, self.version, self.earlier_version)

    @cached_property
    def observation_codes(self) -> DataFrame:
        """(concept, code, family) for every observation-based feature family."""
        def fam(df: DataFrame, name: str) -> DataFrame:
            return df.select("concept", "code", F.lit(name).alias("family"))
        meas = E.select_codes(self.codes_2024, code_system="medcode", concepts=C.BIOMARKERS + [C.HBA1C])
        return (fam(meas, "measure").unionByName(fam(self.comorbidity_codes, "comorbidity"))
                .unionByName(fam(self.efi_codes, "efi")))

    def _extract_observations(self, codes: DataFrame) -> DataFrame:
        obs = self.wh.observation.withColumnRenamed("testvalue", "value")
        return E.extract_events(obs, codes, code_col="medcodeid", date_col="obsdate", keep=["value", "numunitid"], code_alias="code")

    def _extract_prescriptions(self, codes: DataFrame) -> DataFrame:
        return E.extract_events(self.wh.drug_issue, codes, code_col="prodcodeid", date_col="issuedate")

    @property
    def coded_observations_plan(self) -> DataFrame:
        return self._extract_observations(self.observation_codes)

    def _coded(self, name: str, extract, codes: DataFrame, families=None):
        """The stored lists of an event table, those of ``codes`` (of some families) extracted where
        they are missing."""
        one = S.inline_table(codes.sparkSession, [("family", "concept", "code")], "family string, concept string, code string")
        events = extract(one)
        store = CodedEvents(codes.sparkSession, name, S.plan_digest(events, self.wh.version_of), extract, self.wh.n_bytes)
        return store, store.ensure(codes, self.refresh, families), events.schema

    @cached_property
    def _observations(self):
        return self._coded("observations", self._extract_observations, self.observation_codes)

    @cached_property
    def _prescriptions(self):
        return self._coded("prescriptions", self._extract_prescriptions, self.prescription_codes)

    def observations_of(self, *families: str) -> DataFrame:
        """Coded observations of some families, read from the stored lists."""
        if self.on_demand:
            held = self.__dict__.setdefault("_observations_by", {})
            if families not in held:
                held[families] = self._coded("observations", self._extract_observations, self.observation_codes, families)
            store, runs, schema = held[families]
        else:
            store, runs, schema = self._observations
        return store.read(runs, schema, families)

    def prescriptions_of(self, *families: str) -> DataFrame:
        store, runs, schema = self._prescriptions
        return store.read(runs, schema, families)

    @property
    def coded_observations(self) -> DataFrame:
        """Observations of all needed concepts, each list from a single scan, stored by family
        (later reads prune to their lists; lost executors recompute from the stored copy)."""
        return self.observations_of("measure", "comorbidity", "efi")

    @cached_property
    def prescription_codes(self) -> DataFrame:
        def fam(df: DataFrame, name: str) -> DataFrame:
            return df.select("concept", "code", F.lit(name).alias("family"))
        drugs = E.select_codes(self.codes_2021, code_system="prodcode", concepts=C.DRUGS)
        insulin = E.select_codes(self.codes_2024, code_system="prodcode", concepts=[C.INSULIN])
        classes = [c for c in C.OHA_CLASSES if c != C.INSULIN]  # insulin comes from its own list
        oha = E.class_codelist(self.wh.drug_class_lookup, classes=classes, subclasses=C.SEMA_SUBCLASSES)
        return fam(drugs, "drug").unionByName(fam(insulin, "insulin")).unionByName(fam(oha, "oha"))

    @property
    def coded_prescriptions_plan(self) -> DataFrame:
        return self._extract_prescriptions(self.prescription_codes)

    @property
    def coded_prescriptions(self) -> DataFrame:
        return self.prescriptions_of("drug", "insulin", "oha")

    # -- measurements --------------------------------------------------------
    @cached_property
    def raw_measurements(self) -> DataFrame:
        return self._of_cohort(self.observations_of("measure")).select("patid", "concept", "date", "value", "numunitid")

    @property
    def clean_plan(self) -> DataFrame:
        return M.clean_measurements(self.raw_measurements, self.wh.value_limits,
                                    self.wh.unit_whitelist, self.wh.valid_dates)

    @cached_property
    def clean(self) -> DataFrame:
        """Clean measurements, stored: read by the derived measures, baseline and height.  At most one
        row per patient, concept and day, in buckets of patid: what follows exchanges nothing."""
        if self.cohort_only:
            return self.clean_plan
        return self._keep(self.clean_plan, "clean_measurements", "all_patid", bucket_by="patid")

    @cached_property
    def acr_from_separate(self) -> DataFrame:
        return M.same_day_ratio(self.clean, self.wh.value_limits)

    @cached_property
    def egfr(self) -> DataFrame:
        return M.derive_egfr(self.clean, self.people, unit=self.creatinine_unit)

    @cached_property
    def all_measures(self) -> DataFrame:
        """Clean measures + derived ones, one long frame."""
        return self.clean.unionByName(self.acr_from_separate).unionByName(self.egfr)

    @cached_property
    def baseline_long(self) -> DataFrame:
        concepts = C.baseline_concepts() + [C.HBA1C]
        ev = self.all_measures.filter(F.col("concept").isin(concepts))
        ev = self._indexed(ev, C.BASELINE_LO, C.BASELINE_HI)
        return B.nearest_to_index(ev, self.index, one_row_per_day=True)  # daily means

    def baseline_landmarks(self, dates) -> DataFrame:
        """Baseline values at several index dates from one sweep: patid, concept, landmark, value,
        date, datediff.  The outer bounds of all windows reach the scan."""
        concepts, dates = C.baseline_concepts() + [C.HBA1C], sorted(dates)
        first, last = dates[0] + dt.timedelta(days=C.BASELINE_LO), dates[-1] + dt.timedelta(days=C.BASELINE_HI)
        ev = self.all_measures.filter(F.col("concept").isin(concepts) & F.col("date").between(F.lit(first), F.lit(last)))
        return L.nearest_at_landmarks(ev, L.landmark_rows(self.spine, dates, concepts))

    @cached_property
    def height(self) -> DataFrame:
        return B.post_index_mean(self._indexed(self.clean), self.index, concept="height", out="height")

    @cached_property
    def biomarkers(self) -> DataFrame:
        """Spine + pre<c>, pre<c>date, pre<c>datediff per concept, height, then HbA1c."""
        concepts = C.baseline_concepts() + [C.HBA1C]
        wide = FT.to_wide(self.baseline_long, concepts,
                          {"value": "pre{c}", "date": "pre{c}date", "datediff": "pre{c}datediff"})
        out = FT.attach(self.spine, wide).join(self.height, "patid", "left")
        hb = ["prehba1c", "prehba1cdate", "prehba1cdatediff"]
        order = [c for c in out.columns if c not in hb and c != "height"] + ["height"] + hb
        return self._stored("biomarkers", out.select(*order))

    # -- kidney stage -------------------------------------------------------------
    @cached_property
    def stage(self) -> DataFrame:
        return self._stored("ckd_stage", FT.stage_at_index(self.spine, self._indexed_rows(self.wh.stage_history), self.index))

    # -- comorbidities ------------------------------------------------------------
    @cached_property
    def comorbidity_codes(self) -> DataFrame:
        codes = CL.codelist_precedence(self.wh.codelists, [self.earlier_version, self.version])
        return E.select_codes(codes, code_system="medcode", concepts=C.COMORBIDITIES)

    @cached_property
    def hospital_diagnoses(self) -> DataFrame:
        return E.hospital_diagnoses(self.wh.hospital_diagnosis,
                                    E.select_codes(self.codes_2024, code_system="icd10"))

    @cached_property
    def hospital_procedures(self) -> DataFrame:
        return E.hospital_procedures(self.wh.hospital_procedure,
                                     E.select_codes(self.codes_2024, code_system="opcs4"))

    @property
    def comorbidity_concepts(self) -> list[str]:
        return ([C.PRIMARY_HHF] if self.hospital else []) + C.COMORBIDITIES

    @cached_property
    def _comorbidity_sources(self) -> DataFrame:
        gp = self.observations_of("comorbidity").select("patid", "concept", "date", "code")
        sources = {"gp": gp}
        if self.hospital:
            dx = self.hospital_diagnoses
            primary = E.primary_cause(dx, "heartfailure", C.PRIMARY_HHF)
            cols = ["patid", "concept", "date", "code"]
            sources["hes_icd10"] = dx.select(*cols).unionByName(primary.select(*cols))
            sources["hes_opcs4"] = self.hospital_procedures
        return self._of_cohort(E.tag_sources(sources))

    @cached_property
    def comorbidity_events(self) -> DataFrame:
        return E.restrict_by_source(self._comorbidity_sources, self.wh.valid_dates, hospital=self.hospital)

    @cached_property
    def comorbidity_dates(self) -> DataFrame:
        """Distinct (patid, concept, date, source) of the comorbidity events: equal rows are
        combined before the exchange, so a patient with very many rows brings few to the join."""
        slim = self._comorbidity_sources.select("patid", "concept", "date", "source").distinct()
        return E.restrict_by_source(slim, self.wh.valid_dates, hospital=self.hospital)

    @cached_property
    def comorbidities(self) -> DataFrame:
        df = FT.event_features(
            self._indexed(self.comorbidity_dates), self.spine, self.index, self.comorbidity_concepts,
            earliest="pre_index_date_earliest_{c}", latest="pre_index_date_latest_{c}",
            flag="pre_index_date_{c}", post="post_index_date_first_{c}")
        return self._stored("comorbidities", df)

    # -- medications ----------------------------------------------------------------
    def _rx(self, family: str) -> DataFrame:
        return self._of_cohort(self.prescriptions_of(family)).select("patid", "concept", "date")

    @cached_property
    def drug_events(self) -> DataFrame:
        return E.restrict_to_registration(self._rx("drug"), self.wh.valid_dates)

    @cached_property
    def oha_events(self) -> DataFrame:
        return E.restrict_to_registration(self._rx("oha"), self.wh.valid_dates)

    @cached_property
    def insulin_events(self) -> DataFrame:
        return E.restrict_to_registration(self._rx("insulin"), self.wh.valid_dates,
                                          end_col="gp_ons_end_date")

    @cached_property
    def medication_events(self) -> DataFrame:
        return self.oha_events.unionByName(self.insulin_events).unionByName(self.drug_events)

    @cached_property
    def medication_dates(self) -> DataFrame:
        """Distinct (patid, concept, date) of all prescription families from one registration join;
        insulin has its own end date."""
        rx = self._of_cohort(self.coded_prescriptions)
        return E.restrict_dates(rx.withColumn("late", F.col("family") == "insulin"), self.wh.valid_dates)

    @cached_property
    def medications(self) -> DataFrame:
        lb = self.label
        df = FT.event_features(
            self._indexed(self.medication_dates), self.spine, self.index, C.medication_concepts(),
            earliest=f"pre_{lb}_earliest_{{c}}", latest=f"pre_{lb}_latest_{{c}}",
            post=f"post_{lb}_first_{{c}}")
        return self._stored("medications", df)

    # -- frailty ----------------------------------------------------------------------
    @cached_property
    def efi_codes(self) -> DataFrame:
        return CL.codelist_prefix(E.select_codes(self.codes_2024, code_system="medcode"), C.EFI_PREFIX)

    @cached_property
    def efi_deficits(self) -> list[str]:
        """Configured deficit lists, else the names found in the catalogue."""
        return list(self._deficits) if self._deficits is not None else CL.concept_names(self.efi_codes)

    @cached_property
    def efi_events(self) -> DataFrame:
        ev = self._of_cohort(self.observations_of("efi"))
        return E.restrict_dates(ev.withColumn("late", F.lit(False)), self.wh.valid_dates)

    @cached_property
    def efi(self) -> DataFrame:
        df = FT.frailty_index(self._indexed(self.efi_events), self.spine, self.index, self.efi_deficits)
        return self._stored("efi", df)

    # -- cohort ---------------------------------------------------------------------------
    def cohort_ids(self, linked_only: bool | None = None) -> DataFrame:
        linked = self.linked_only if linked_only is None else linked_only
        return CO.prevalent_cohort(self.cohort_attributes, self.index, linked_only=linked)

    def cross_section_plan(self, with_efi: bool = False, on_cohort: bool = False) -> DataFrame:
        """Cohort ids LEFT JOIN the (stored, one-row-per-patient) feature tables: all in buckets of
        patid, so the star join exchanges nothing.

        ``on_cohort=True`` instead builds every feature table with the cohort as spine from the
        cohort's events alone (same values; events are reduced by the cohort ids before their first
        exchange) -- the better plan when the feature tables are not reused."""
        ids = self.cohort_ids()
        src = self.with_options(spine=ids, cohort_only=True) if on_cohort else self
        feats = [src.biomarkers, src.stage, src.medications, src.comorbidities]
        if with_efi:
            feats.append(src.efi)
        return CO.cross_section(ids, self.cohort_attributes, feats, self.index)

    def _analysis(self, name: str, plan) -> DataFrame:
        """An analysis table, stored under the identity of its plan (lazy on a custom spine)."""
        held = self.__dict__.setdefault("_held", {})
        if name not in held:
            df = plan()
            held[name] = df if self._spine is not None else self._keep(df, name, "analysis", unique="patid")
        return held[name]

    def cross_section(self, with_efi: bool = False) -> DataFrame:
        """The cross-section, stored once: the analysis steps downstream read the stored table."""
        if with_efi:
            return self._analysis("cross_section_efi", lambda: self.cross_section_plan(True))
        return self._analysis("cross_section", self.cross_section_plan)

    def analysis_ready(self) -> DataFrame:
        """Flags -> restriction -> complete cases + stage 0 -> pruned columns; stored once (the
        descriptive analysis reads the stored extract)."""
        def plan():
            x = CO.treatment_flags(self.cross_section(), self.label)
            return CO.prune_columns(CO.recode_stage_zero(CO.restrict_cohort(x)), self.label)
        return self._analysis("analysis_ready", plan)

    # -- attrition, each from one pass ----------------------------------------------------------
    def measurement_attrition(self) -> DataFrame:
        """Measurements and patients left after value limits, units, the HbA1c calendar floor and
        registration."""
        ev = M.convert_hba1c(self.raw_measurements)
        units = self.wh.unit_whitelist.select(F.col("concept").alias("_uc"), F.col("numunitid").alias("_uu"), F.lit(True).alias("_unit")).distinct()
        valid = self.wh.valid_dates.select("patid", "min_dob", "gp_end_date")
        ev = (ev.join(self.wh.value_limits, "concept", "left")
                .join(units, (F.col("concept") == F.col("_uc")) & F.col("numunitid").eqNullSafe(F.col("_uu")), "left").join(valid, "patid", "left"))
        floor = F.lit(dt.date(C.HBA1C_MIN_YEAR, 1, 1))
        return A.attrition(ev, {
            "value in limits": F.col("value").between(F.col("lo"), F.col("hi")), "unit listed": F.col("_unit"),
            "HbA1c after the floor": (F.col("concept") != C.HBA1C) | (F.col("date") >= floor),
            "registered": F.col("date").between(F.col("min_dob"), F.col("gp_end_date"))})

    def cohort_attrition(self) -> DataFrame:
        """Patients left after each rule of the cohort selection and of the analysis extract."""
        flags = CO.treatment_flags(self.cross_section(), self.label).select(
            "patid", "ncurrtx", "pre_index_date_ckd5_code", "preckdstage", "preegfr", "uacr")
        idx = self.index if self._index_dates is not None else F.lit(self.index_date)
        df = self.cohort_attributes.join(flags, "patid", "left")
        recoded = F.col("preckdstage").isin(C.STAGE_ZERO_FROM) & (F.col("uacr") < C.ELIG_UACR)
        return A.attrition(df, {
            "diagnosed": F.col("dm_diag_date_all") <= idx, "registration begun": F.col("regstartdate") <= idx,
            "registration lasting": F.col("gp_record_end") >= idx, "alive": F.col("death_date").isNull() | (F.col("death_date") >= idx),
            "type 2": F.col("diabetes_type") == "type 2", "treated": F.col("ncurrtx") > 0,
            "no stage 5 code": ~F.col("pre_index_date_ckd5_code"), "stage known and not 5": F.col("preckdstage") != "stage_5",
            "eGFR known": F.col("preegfr").isNotNull(), "uACR known": F.col("uacr").isNotNull(), "kidney disease": ~recoded})

    # -- Table 1 from mergeable sketches --------------------------------------------------------
    def table_one_sketches(self, part=None) -> DataFrame:
        """Stored sketches of the extract's continuous variables by stratum (of the rows where the
        condition ``part`` holds): a snapshot's state, merged by ``sketches.merge_sketches``."""
        df = self.with_eligibility() if part is None else self.with_eligibility().filter(part)
        names = [v for v in C.TABLE_ONE_VARS if v not in C.TABLE_ONE_FACTORS]
        return self._keep(SK.sketch_values(df, names, C.TABLE_ONE_STRATA), "table_one_sketches", "analysis")

    def with_eligibility(self) -> DataFrame:
        return CO.eligibility_flags(self.analysis_ready())
