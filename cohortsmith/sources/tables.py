"""A warehouse over real tables: every domain table by name or path, with a declared schema.

``TableWarehouse`` has the attributes that ``CohortBuild`` reads.  Columns are checked against
the contracts below when a table is first read; extra columns are left out.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .store import files_digest, files_size

#: Columns each table must have, and their types.
CONTRACTS: dict[str, str] = {
    "patient": "patid string, gender int",
    "dob": "patid string, dob date",
    "valid_dates": "patid string, min_dob date, gp_end_date date, gp_ons_end_date date, gp_ons_death_date date",
    "diabetes_cohort": "patid string, dob date, gender int, dm_diag_date_all date, regstartdate date, gp_record_end date, "
                       "death_date date, with_hes int, diabetes_type string, ethnicity_5cat int, imd_decile int, "
                       "ins_in_1_year int, has_insulin int, current_oha int",
    "stage_history": "patid string, stage_1 date, stage_2 date, stage_3a date, stage_3b date, stage_4 date, stage_5 date",
    "observation": "patid string, obsdate date, medcodeid string, testvalue double, numunitid int",
    "drug_issue": "patid string, issuedate date, prodcodeid string",
    "hospital_diagnosis": "patid string, epistart date, ICD string, d_order int",
    "hospital_procedure": "patid string, evdate date, OPCS string",
    "codelists": "version date, concept string, code_system string, code string",
    "drug_class_lookup": "prodcodeid string, drug_class_1 string, drug_substance_2 string, INS int",
    "value_limits": "concept string, lo double, hi double",
    "unit_whitelist": "concept string, numunitid int",
}


class ContractError(ValueError):
    """A table lacks a column or has it with another type."""


def checked(df: DataFrame, table: str) -> DataFrame:
    """The contract's columns of ``df``; raises where one is missing or of another type."""
    want, have = T.StructType.fromDDL(CONTRACTS[table]), {f.name: f.dataType for f in df.schema.fields}
    for f in want.fields:
        if f.name not in have:
            raise ContractError(f"{table}: column {f.name} is missing")
        if have[f.name] != f.dataType:
            raise ContractError(f"{table}: column {f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return df.select(*want.names)


class TableWarehouse:
    """``tables``: domain table -> path (holding a ``/``) of Parquet files, or catalog table name.
    ``version`` names the state of the data in stored results; by default it follows the files that
    each table reads, of catalog tables as well.  A table that is not read from files (a view of rows
    in memory, a foreign format) has no such state: storing what depends on it raises unless
    ``version`` is given."""

    def __init__(self, spark: SparkSession, tables: dict[str, str], version: str | None = None):
        if unknown := set(tables) - set(CONTRACTS):
            raise ContractError(f"no such domain table: {sorted(unknown)}")
        self.spark, self.tables, self._version = spark, dict(tables), version

    @cached_property
    def version(self) -> str:
        if self._version:
            return self._version
        paths = sorted(t for t in self.tables.values() if "/" in t)
        return f"{files_digest(self.spark, paths)}-{sorted(self.tables.items())}"

    @cached_property
    def n_bytes(self) -> int:
        """Size of the files of the domain tables that are read from files."""
        paths = [p for t in self.tables.values() for p in ([t] if "/" in t else self.spark.table(t).inputFiles())]
        return files_size(self.spark, paths)

    def version_of(self, path: str | None) -> str:
        """The state of the files at ``path`` (None: of an input that is no file)."""
        if path is None:
            if self._version is None:
                raise ContractError("a table that is not read from files needs a warehouse with version=")
            return self._version
        held = self.__dict__.setdefault("_versions", {})
        if path not in held:
            held[path] = f"{self._version}-{files_digest(self.spark, [path])}"
        return held[path]

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise ContractError(f"table {name} is not in this warehouse")
        at = self.tables[name]
        return checked(self.spark.read.parquet(at) if "/" in at else self.spark.table(at), name)

    def __getattr__(self, name: str) -> DataFrame:
        if name in CONTRACTS:
            df = self.table(name)
            self.__dict__[name] = df
            return df
        raise AttributeError(name)


def write_tables(wh, folder: str) -> dict[str, str]:
    """Every domain table of ``wh`` as Parquet under ``folder``: table -> path."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in CONTRACTS}
    for name, path in paths.items():
        checked(getattr(wh, name), name).write.mode("overwrite").parquet(path)
    return paths
