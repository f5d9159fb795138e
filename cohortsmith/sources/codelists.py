"""Codelist catalogue operations on the long (version, concept, code_system, code) table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DuplicateCodes(ValueError):
    """A code stands more than once in a list: its events would count twice."""


def codelist_version(codelists: DataFrame, version) -> DataFrame:
    """All lists as of one version."""
    return codelists.filter(F.col("version") == F.lit(version))


def codelist_list(codelists: DataFrame) -> DataFrame:
    """Available lists: concept, version, code_system, n_codes."""
    return codelists.groupBy("concept", "version", "code_system").agg(
        F.count(F.lit(1)).alias("n_codes"))


def codelist_precedence(codelists: DataFrame, versions) -> DataFrame:
    """Concatenated catalogues, looked up by name, first one wins: for every concept the
    codes of the first version (in ``versions`` order) that has the concept.

    Decided on the tiny (concept, version) table and applied with an equi join, so a very
    large list is never gathered in one task."""
    versions = list(versions)
    rank = reduce(lambda acc, iv: acc.when(F.col("version") == F.lit(iv[1]), iv[0]),
                  list(enumerate(versions))[1:],
                  F.when(F.col("version") == F.lit(versions[0]), 0))
    present = (codelists.filter(F.col("version").isin(versions))
                        .select("concept", rank.alias("_rank")).distinct())
    first = present.groupBy("concept").agg(F.min("_rank").alias("_rank"))
    ranked = codelists.withColumn("_rank", rank)
    return ranked.join(first, ["concept", "_rank"]).drop("_rank")


def duplicate_codes(codelists: DataFrame) -> DataFrame:
    """(version, concept, code_system, code) present more than once: a duplicated code would
    double-weight its events in a daily mean, so catalogues are checked to be free of them."""
    return (codelists.groupBy("version", "concept", "code_system", "code").count()
                     .filter(F.col("count") > 1))


def codelist_prefix(codelists: DataFrame, prefix: str) -> DataFrame:
    """Lists whose name starts with ``prefix``."""
    return codelists.filter(F.col("concept").startswith(prefix))


def concept_names(codes: DataFrame) -> list[str]:
    """Sorted distinct list names (a bounded, tiny result used to fix an output schema)."""
    return sorted(r[0] for r in codes.select("concept").distinct().collect())


def read_codelist_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Tab-separated codelist with a header; every column read as text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, sep="\t", header=True, schema=schema)


def write_codelist_tsv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
    return path
