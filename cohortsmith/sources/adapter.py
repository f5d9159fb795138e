"""Domain tables over the driver's star schema (test and benchmark warehouse).

The analysis runs on an electronic-health-record warehouse: patients,
registration periods, coded observations and prescriptions, codelists.
``Warehouse`` exposes exactly those tables, derived lazily (no action, no
collect) from the driver-generated parquet by deterministic arithmetic
rules, so that every operator can be run at any scale factor and checked
against DuckDB running the same rules (``cohortsmith.plans.oracle``).

``k`` below is ``c_custkey``.  Real warehouse tables are read by
``cohortsmith.sources.tables.TableWarehouse``, which has the same attributes.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from . import fixtures as X
from .store import files_digest, files_size, inline_table, materialize, plan_digest


def _d(y: int, m: int, d: int) -> Column:
    return F.lit(dt.date(y, m, d))


def _plus_days(y: int, m: int, d: int, n: Column) -> Column:
    return F.date_add(_d(y, m, d), n.cast("int"))


def _case(col: Column, pairs, default=None) -> Column:
    out = None
    for key, val in pairs:
        out = (F.when(col == key, val) if out is None else out.when(col == key, val))
    return out if default is None else out.otherwise(default)


class Warehouse:
    """Lazily derived domain tables; one instance per (session, data directory)."""

    def __init__(self, spark: SparkSession, sf_dir: str, store_lookups: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.store_lookups = store_lookups

    def _lookup(self, df: DataFrame, name: str) -> DataFrame:
        """Small lookup tables (codelists, class lookup) are stored once and read back, as a
        warehouse would hold them; the name carries the digest of the plan and its inputs."""
        if not self.store_lookups:
            return df
        return materialize(df, f"{name}_{plan_digest(df, self.version_of)}", namespace="lookups")

    TABLES = ("customer", "orders", "lineitem", "part")

    @cached_property
    def version(self) -> str:
        """Changes with the path and with the files of the tables read."""
        return files_digest(self.spark, [f"{self.sf_dir}/{t}.parquet" for t in self.TABLES])

    @cached_property
    def n_bytes(self) -> int:
        """Size of the files of the tables read."""
        return files_size(self.spark, [f"{self.sf_dir}/{t}.parquet" for t in self.TABLES])

    def version_of(self, path: str | None) -> str:
        """The state of the files at ``path`` when this warehouse first saw them."""
        held = self.__dict__.setdefault("_versions", {})
        if path not in held:
            held[path] = files_digest(self.spark, [path]) if path else self.version
        return held[path]

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- patients -----------------------------------------------------------
    @cached_property
    def _cust(self) -> DataFrame:
        return self.raw("customer").select(F.col("c_custkey").alias("k"), "c_nationkey")

    @cached_property
    def patient(self) -> DataFrame:
        """patid string (unique), gender int: 1 male, 2 female, 3 other."""
        k = F.col("k")
        gender = F.when(k % 50 == 0, 3).when(k % 2 == 0, 1).otherwise(2)
        return self._cust.select(k.cast("string").alias("patid"), gender.cast("int").alias("gender"))

    @cached_property
    def _dates(self) -> DataFrame:
        k = F.col("k")
        dob = _plus_days(1920, 1, 1, (k * 7919) % 22000)
        death = F.when(k % 11 == 0, _plus_days(1998, 1, 1, (k * 17) % 1200))
        gp_end = _plus_days(1998, 6, 1, (k * 31) % 1200)
        return self._cust.select(
            k, "c_nationkey", k.cast("string").alias("patid"), dob.alias("dob"),
            F.when(k % 20 == 0, _d(1997, 1, 1)).otherwise(dob).alias("min_dob"),
            gp_end.alias("gp_end_date"), death.alias("death"),
        )

    @cached_property
    def dob(self) -> DataFrame:
        """patid (unique), dob date."""
        return self._dates.select("patid", "dob")

    @cached_property
    def valid_dates(self) -> DataFrame:
        """patid (unique), min_dob, gp_end_date, gp_ons_end_date, gp_ons_death_date."""
        return self._dates.select(
            "patid", "min_dob", "gp_end_date",
            F.least("gp_end_date", "death").alias("gp_ons_end_date"),
            F.col("death").alias("gp_ons_death_date"),
        )

    @cached_property
    def diabetes_cohort(self) -> DataFrame:
        """One row per patient with diagnosis, registration and descriptive attributes."""
        k = F.col("k")
        g = F.when(k % 50 == 0, 3).when(k % 2 == 0, 1).otherwise(2).cast("int")
        eth = F.when(F.col("c_nationkey") % 6 != 5, F.col("c_nationkey") % 6).cast("int")
        return self._dates.select(
            "patid", "dob", g.alias("gender"),
            _plus_days(1985, 1, 1, (k * 13) % 5500).alias("dm_diag_date_all"),
            _plus_days(1990, 1, 1, (k * 29) % 3600).alias("regstartdate"),
            F.col("gp_end_date").alias("gp_record_end"),
            F.col("death").alias("death_date"),
            (k % 3 != 0).cast("int").alias("with_hes"),
            F.when(k % 10 == 0, "type 1").otherwise("type 2").alias("diabetes_type"),
            eth.alias("ethnicity_5cat"),
            (1 + k % 10).cast("int").alias("imd_decile"),
            (k % 7 == 0).cast("int").alias("ins_in_1_year"),
            (k % 5 == 0).cast("int").alias("has_insulin"),
            (k % 4 != 0).cast("int").alias("current_oha"),
        )

    @cached_property
    def stage_history(self) -> DataFrame:
        """patid (unique), first date of each kidney-disease stage (NULL if never)."""
        k = F.col("k")
        names = ["stage_1", "stage_2", "stage_3a", "stage_3b", "stage_4", "stage_5"]
        cols = [
            F.when((k + s) % 3 == 0, _plus_days(1994, 1, 1, (k * (31 - 3 * s)) % 4000)).alias(n)
            for s, n in enumerate(names, start=1)
        ]
        return self._cust.select(k.cast("string").alias("patid"), *cols)

    # -- events ---------------------------------------------------------------
    @cached_property
    def _lines(self) -> DataFrame:
        li = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                         "l_quantity", "l_shipdate")
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return li.join(o, li.l_orderkey == o.o_orderkey)

    @cached_property
    def observation(self) -> DataFrame:
        """patid, obsdate date, medcodeid string, testvalue double, numunitid int (nullable)."""
        # joined by the text of the key, as the codelists are: one exchange of the rows serves both
        p = self.raw("part").select(F.col("p_partkey").cast("string").alias("p_code"), "p_type")
        q = F.col("l_quantity")
        formulas = {"40 + 4 * q": 40 + 4 * q, "2 * q": 2 * q, "2 + q / 10": 2 + q / 10,
                    "q - 1": q - 1, "q": q}
        value = _case(F.col("p_type"), [(t, formulas[f]) for t, _, f in X.TYPE_CONCEPT])
        unit = _case(F.col("l_linenumber") % 4, [(1, 218), (2, 425), (3, 999)])
        lines = self._lines.withColumn("medcodeid", F.col("l_partkey").cast("string"))
        return lines.join(p, F.col("medcodeid") == F.col("p_code"), "left").select(
            F.col("o_custkey").cast("string").alias("patid"),
            F.col("o_orderdate").cast("date").alias("obsdate"),
            "medcodeid",
            value.cast("double").alias("testvalue"),
            unit.cast("int").alias("numunitid"),
        )

    @cached_property
    def drug_issue(self) -> DataFrame:
        """patid, issuedate date, prodcodeid string."""
        return self._lines.select(
            F.col("o_custkey").cast("string").alias("patid"),
            F.col("l_shipdate").cast("date").alias("issuedate"),
            F.col("l_partkey").cast("string").alias("prodcodeid"),
        )

    @cached_property
    def hospital_diagnosis(self) -> DataFrame:
        """patid, epistart date, ICD string, d_order int (dormant hospital source)."""
        icd = F.concat(F.lit("I"), F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0"))
        return self._lines.select(
            F.col("o_custkey").cast("string").alias("patid"),
            F.col("l_shipdate").cast("date").alias("epistart"),
            icd.alias("ICD"), F.col("l_linenumber").cast("int").alias("d_order"),
        )

    @cached_property
    def hospital_procedure(self) -> DataFrame:
        """patid, evdate date, OPCS string (dormant hospital source)."""
        opcs = F.concat(F.lit("K"), F.lpad((F.col("l_suppkey") % 100).cast("string"), 2, "0"))
        return self._lines.select(
            F.col("o_custkey").cast("string").alias("patid"),
            F.col("l_shipdate").cast("date").alias("evdate"), opcs.alias("OPCS"),
        )

    # -- codelists and lookups ----------------------------------------------
    @cached_property
    def _parts(self) -> DataFrame:
        return self.raw("part").select(
            "p_partkey", "p_type", "p_size",
            F.expr("cast(substring(p_brand, 7) as int)").alias("brand"),
            F.col("p_partkey").cast("string").alias("code"),
        )

    @cached_property
    def codelists(self) -> DataFrame:
        """Long codelist catalogue: version date, concept, code_system, code."""
        p = self._parts
        v21, v24 = F.lit(C.VERSION_2021), F.lit(C.VERSION_2024)

        def rows(df: DataFrame, version: Column, concept: Column, system: str) -> DataFrame:
            return df.select(version.alias("version"), concept.alias("concept"),
                             F.lit(system).alias("code_system"), "code")

        meas = rows(p, v24, _case(F.col("p_type"), [(t, c) for t, c, _ in X.TYPE_CONCEPT]), "medcode")
        extra = rows(p.filter(F.col("p_size") % 10 < len(X.SIZE_CONCEPT)), v24,
                     _case(F.col("p_size") % 10, X.SIZE_CONCEPT), "medcode")
        third = rows(p.filter(F.col("p_partkey") % X.THIRD_EVERY == 0), v24, F.lit(X.THIRD_CONCEPT), "medcode")
        brands = inline_table(self.spark, X.comorbidity_brands(), "concept string, cb int")
        dx = p.join(F.broadcast(brands), p.brand == brands.cb)  # fixed 43-row config table
        dx24 = rows(dx, v24, F.col("concept"), "medcode")
        dx21 = rows(dx.filter((F.col("cb") <= 20) & (F.col("p_partkey") % 2 == 0)), v21,
                    F.col("concept"), "medcode")
        efi_name = F.when(F.col("brand") == X.EFI_LONG_BRAND, F.lit(X.EFI_LONG_NAME)).otherwise(
            F.concat(F.lit(C.EFI_PREFIX), F.col("brand").cast("string")))
        efi = rows(p.filter(F.col("p_partkey") % 4 == 0), v24, efi_name, "medcode")
        forced = [rows(p.filter((F.col("p_partkey") % 4 == r) & (F.col("brand") <= 3)), v24,
                       F.lit(name), "medcode") for name, r in X.EFI_FORCED_RULES]
        drug_name = _case(F.col("p_partkey") % 7, X.DRUG_CODE)
        drugs = p.filter(F.col("p_partkey") % 7 < len(X.DRUG_CODE))
        drug24 = rows(drugs, v24, drug_name, "prodcode")
        drug21 = rows(drugs.filter(F.col("p_partkey") % 7 != 5), v21, drug_name, "prodcode")
        fixed = inline_table(
            self.spark, [(C.VERSION_2024, c, "icd10", code) for c, code in X.icd10_rows()]
            + [(C.VERSION_2024, c, "opcs4", code) for c, code in X.opcs4_rows()],
            "version date, concept string, code_system string, code string")
        out = meas
        for df in [extra, third, dx24, dx21, efi, *forced, drug24, drug21, fixed]:
            out = out.unionByName(df)
        return self._lookup(out, "codelists")

    @cached_property
    def drug_class_lookup(self) -> DataFrame:
        """prodcodeid, drug_class_1, drug_substance_2 (glp1 only), INS int."""
        p = self._parts
        cls = _case(F.col("p_size") % len(X.OHA_CLASS_BY_SIZE), list(enumerate(X.OHA_CLASS_BY_SIZE)))
        sub = F.when(cls == "glp1", _case(F.col("p_partkey") % len(X.SEMA_BY_KEY), list(enumerate(X.SEMA_BY_KEY))))
        ins = ((cls == "glp1") & (F.col("p_partkey") % 5 == 0)).cast("int")
        return self._lookup(p.select(F.col("code").alias("prodcodeid"), cls.alias("drug_class_1"),
                                     sub.alias("drug_substance_2"), ins.alias("INS")), "drug_class_lookup")

    @cached_property
    def value_limits(self) -> DataFrame:
        return inline_table(self.spark, X.VALUE_LIMITS, "concept string, lo double, hi double")

    @cached_property
    def unit_whitelist(self) -> DataFrame:
        return inline_table(self.spark, X.unit_rows(), "concept string, numunitid int")
