"""Materialisation, dated snapshots and key checks on stored tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
import threading
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_store


def digest(*parts) -> str:
    return hashlib.sha1(repr(parts).encode()).hexdigest()[:12]


class UnidentifiedInput(ValueError):
    """A plan reads something whose state has no name (rows held in memory, a foreign table)."""


def plan_digest(df: DataFrame, version_of=None) -> str:
    """Identity of what ``df`` computes: its analysed plan with expression ids renumbered in order
    of appearance, its schema, and the state of every input.

    Code enters through the plan alone, so an edited comment or another operator changes no
    digest, and a changed limit changes those whose plan holds it.  Files of stored tables are
    versions that never change: their path is their state.  Of other files ``version_of(path)``
    is the state (default: names, sizes and times of the files); ``version_of(None)`` is asked
    for inputs that are no files, and may raise."""
    spark = df.sparkSession
    conf, key = spark.conf, "spark.sql.debug.maxToStringFields"
    old = conf.get(key, None)
    conf.set(key, str(1 << 30))
    try:
        plan = df._jdf.queryExecution().analyzed()
        text = plan.toString()
    finally:
        conf.unset(key) if old is None else conf.set(key, old)
    seen: dict[str, str] = {}
    text = re.sub(r"(#|lambda \w+_)(\d+)", lambda m: m[1] + seen.setdefault(m[2], str(len(seen))), text)
    text = re.sub(r"plan_id=\d+|splits=\w+\(?\d*\)?|SubqueryAlias .*", "", text)
    root, states, leaves = ensure_store(spark).rstrip("/"), [], plan.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.getClass().getSimpleName()
        if kind in ("Range", "OneRowRelation", "OneRowRelation$"):
            continue
        if kind == "LogicalRelation" and hasattr(leaf.relation(), "location"):
            for path in leaf.relation().location().rootPaths().mkString("\n").split("\n"):
                if _bare(path).startswith(f"{_bare(root)}/tables/"):
                    states.append(_bare(path))
                else:
                    states.append(version_of(path) if version_of else files_digest(spark, [path]))
        else:
            if version_of is None:
                raise UnidentifiedInput(f"{kind} has no version")
            states.append(version_of(None))
    return digest(text, df.schema.json(), states)


def _bare(path: str) -> str:
    """A path without the scheme that Spark puts before local ones."""
    return re.sub(r"^file:/+", "/", path)


def inline_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small table whose rows stand in the plan itself, and so in its digest."""
    fields = T.StructType.fromDDL(schema).fields
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r if isinstance(r, (tuple, list)) else (r,), fields)]) for r in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def files_digest(spark: SparkSession, paths) -> str:
    """Digest of the names, sizes and times of all files under ``paths`` (any file system that
    Spark reads): new data at an old path gives a new digest.  Lists files, reads none."""
    return hashlib.sha1(repr(sorted(_files(spark, paths))).encode()).hexdigest()[:12]


def files_size(spark: SparkSession, paths) -> int:
    """Bytes of all files under ``paths``."""
    return sum(size for _, size, _ in _files(spark, paths))


def _files(spark: SparkSession, paths) -> list[tuple[str, int, int]]:
    """Name, size and time of all files under ``paths``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            continue
        files = fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            name = f.getPath().toString()
            if not f.getPath().getName().startswith((".", "_")):
                found.append((name, f.getLen(), f.getModificationTime()))
    return found


def table_path(spark: SparkSession, namespace: str, name: str) -> str:
    return f"{ensure_store(spark).rstrip('/')}/tables/{namespace}/{name}"


def _commits(path: str) -> str:
    return f"{path}/commits"


_COMMIT = "seq long, version string, bucket_by string, buckets int, columns string"
_READ: dict[tuple[str, str], tuple] = {}  # (application, path) -> commit that this application reads


BUCKET_BYTES = 8 << 20  #: of the warehouse's files, for each bucket: a bucket's task stays small at any size
MOST_BUCKETS = 1 << 14


def store_buckets(spark: SparkSession, n_bytes: int = 0) -> int:
    """Buckets of co-partitioned tables: ``cohortsmith.store.buckets``, else the shuffle partitions
    (on one machine its cores), doubled until none stands for more than ``BUCKET_BYTES`` of
    ``n_bytes``, the size of the data that the tables are derived from."""
    if given := spark.conf.get("cohortsmith.store.buckets", None):
        return int(given)
    sc = spark.sparkContext
    n = sc.defaultParallelism if sc.master.startswith("local") else int(spark.conf.get("spark.sql.shuffle.partitions"))
    while n * BUCKET_BYTES < n_bytes and n * 2 <= MOST_BUCKETS:
        n *= 2
    return n


def read_stored(spark: SparkSession, namespace: str, name: str) -> DataFrame | None:
    """The stored table, or None.  A table is a set of versions and a log of commits; the last
    commit names the version to read, so a version that was never finished is never seen."""
    path = table_path(spark, namespace, name)
    key = (spark.sparkContext.applicationId, path)
    if key not in _READ:
        try:
            last = spark.read.schema(_COMMIT).parquet(_commits(path)).orderBy(F.desc("seq"), "version").first()
        except AnalysisException:
            return None
        if last is None:
            return None
        _READ[key] = tuple(last)[1:]
    version, bucket_by, buckets, columns = _READ[key]
    return _read_version(spark, f"{path}/{version}", version, bucket_by, buckets, columns)


def _read_version(spark: SparkSession, at: str, version: str, bucket_by: str | None, buckets: int | None, columns: str) -> DataFrame:
    """A version's files.  Buckets are known to Spark through the catalog only, so a bucketed version
    gets an external table over its files there (the name is the version's own)."""
    if not bucket_by:
        return spark.read.parquet(at)
    table = "cohortsmith_" + version.replace("-", "_")
    if not spark.catalog.tableExists(table):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(columns)).fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet CLUSTERED BY (`{bucket_by}`) "
                  f"INTO {buckets} BUCKETS LOCATION '{at}'")
    return spark.table(table)


def materialize(df: DataFrame, name: str, *, namespace: str = "default", refresh: bool = False,
                partition_by: list[str] | None = None, sort_within: list[str] | None = None,
                unique: str | None = None, bucket_by: str | None = None, buckets: int | None = None) -> DataFrame:
    """Write ``df`` once under namespace/name and return the stored table.

    A later call with the same name returns the stored table without evaluating ``df``
    again; ``refresh=True`` writes a new version.  A version is written beside the old ones and
    becomes current by one appended commit row, so a write that fails leaves the old version in
    place.  ``unique`` names a key that must be unique, checked before the commit.
    ``sort_within`` orders rows inside each task before writing (no shuffle), so Parquet min/max
    statistics let later filters on those columns skip row groups.  ``bucket_by`` deals the rows
    out by a key into ``buckets`` buckets (default: ``store_buckets``): joins and aggregates of such tables on that key
    read bucket by bucket and exchange nothing.  Only for tables in which no key has many rows, as
    one task reads a bucket."""
    spark = df.sparkSession
    path = table_path(spark, namespace, name)
    with _lock_for(path):  # queries started from several threads never write one table twice
        if not refresh:
            got = read_stored(spark, namespace, name)
            if got is not None:
                return got
        return _write(df, path, partition_by, sort_within, unique, bucket_by, buckets)


_LOCKS: dict[str, threading.Lock] = {}
_LOCKS_GUARD = threading.Lock()


def _lock_for(path: str) -> threading.Lock:
    with _LOCKS_GUARD:
        return _LOCKS.setdefault(path, threading.Lock())


def _write(df: DataFrame, path: str, partition_by, sort_within, unique, bucket_by, buckets=None) -> DataFrame:
    spark = df.sparkSession
    version = f"v{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    at, n = f"{path}/{version}", (buckets or store_buckets(spark)) if bucket_by else None
    if bucket_by:  # one file per bucket
        (df.repartition(n, bucket_by).write.bucketBy(n, bucket_by).option("path", at)
           .saveAsTable("cohortsmith_" + version.replace("-", "_")))
    else:
        if partition_by:  # files of the advisory size per value, not one per value and input task
            df = df.hint("rebalance", *partition_by)
        if sort_within:
            df = df.sortWithinPartitions(*sort_within)
        w = df.write
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(at)
    commit = (version, bucket_by, n, df.schema.json())
    stored = _read_version(spark, at, *commit)
    if unique:
        assert_unique_key(stored, unique)
    spark.createDataFrame([(time.time_ns(), *commit)], _COMMIT).coalesce(1).write.mode("append").parquet(_commits(path))
    _READ[(spark.sparkContext.applicationId, path)] = commit
    return stored


# -- derived tables by plain name ---------------------------------------------------------------
_NAMES = "seq long, name string, namespace string, stored string, data_version string, options map<string,string>"


def _names_path(spark: SparkSession) -> str:
    return f"{ensure_store(spark).rstrip('/')}/tables/names"


def register_name(spark: SparkSession, name: str, namespace: str, stored: str, data_version: str, options: dict) -> None:
    """Say that the plain ``name`` now means the stored table namespace/stored, and what it was made of."""
    row = (time.time_ns(), name, namespace, stored, data_version, {k: str(v) for k, v in options.items()})
    spark.createDataFrame([row], _NAMES).coalesce(1).write.mode("append").parquet(_names_path(spark))


def derived_tables(spark: SparkSession) -> DataFrame:
    """Every derived table that has a plain name: name, namespace, stored, data_version, options and
    whether it is the ``current`` one of its name.  One row per stored table (the last entry)."""
    try:
        log = spark.read.schema(_NAMES).parquet(_names_path(spark))
    except AnalysisException:
        log = spark.createDataFrame([], _NAMES)
    last = log.groupBy("name", "namespace", "stored").agg(F.max_by(F.struct("seq", "data_version", "options"), "seq").alias("m"))
    newest = log.groupBy("name").agg(F.max("seq").alias("newest"))
    return last.join(newest, "name").select("name", "namespace", "stored", "m.seq", "m.data_version", "m.options",
                                            (F.col("m.seq") == F.col("newest")).alias("current"))


def read_derived(spark: SparkSession, name: str, data_version: str | None = None, **options) -> DataFrame:
    """The derived table of a plain name, read and not built: the last one registered, or the last
    of a data version or with the given options (``hospital=True``, ``index_date=...``)."""
    found = derived_tables(spark).filter(F.col("name") == name)
    if data_version is not None:
        found = found.filter(F.col("data_version") == data_version)
    for k, v in options.items():
        found = found.filter(F.element_at("options", k) == str(v))
    row = found.orderBy(F.desc("seq")).first()
    got = read_stored(spark, row["namespace"], row["stored"]) if row else None
    if got is None:
        raise KeyError(f"no derived table {name!r} with {options}")
    return got


def publish_views(spark: SparkSession) -> list[str]:
    """A temporary view per plain name over its current table; returns the names."""
    names = [r["name"] for r in derived_tables(spark).filter("current").select("name").collect()]
    for name in names:
        read_derived(spark, name).createOrReplaceTempView(name)
    return sorted(names)


def write_snapshot(df: DataFrame, name: str, stamp: dt.date, *, namespace: str = "snapshots") -> str:
    """Write ``df`` as the snapshot of ``name`` stamped yyyymmdd (one stamp format for write and read)."""
    path = f"{table_path(df.sparkSession, namespace, name)}/snapshot={stamp.strftime('%Y%m%d')}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_snapshot(spark: SparkSession, name: str, stamp: dt.date | None = None, *,
                  namespace: str = "snapshots") -> DataFrame:
    """Read the snapshot with ``stamp`` (latest when None); the stamp column is dropped."""
    base = table_path(spark, namespace, name)
    if stamp is not None:
        return spark.read.parquet(f"{base}/snapshot={stamp.strftime('%Y%m%d')}")
    alls = spark.read.option("basePath", base).parquet(base)
    latest = alls.select(F.max("snapshot")).first()[0]
    return alls.filter(F.col("snapshot") == latest).drop("snapshot")


def duplicate_keys(df: DataFrame, key: str = "patid") -> DataFrame:
    return df.groupBy(key).count().filter(F.col("count") > 1)


def assert_unique_key(df: DataFrame, key: str = "patid") -> DataFrame:
    """Raise if ``key`` is not unique (the stored-table unique index as a check)."""
    if duplicate_keys(df, key).limit(1).count() > 0:
        raise ValueError(f"key {key!r} is not unique")
    return df


def key_summary(df: DataFrame, table: str, key: str = "patid") -> DataFrame:
    """One row: table, n_rows, n_keys (distinct non-null keys), n_dup_keys."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(
        F.lit(table).alias("table"), F.sum("_n").alias("n_rows"),
        F.count(key).alias("n_keys"), F.sum((F.col("_n") > 1).cast("long")).alias("n_dup_keys"))
