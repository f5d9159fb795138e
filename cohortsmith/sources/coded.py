"""Coded events stored list by list.

The reference stores one table per codelist, so one more list costs one more extraction.  Here a
manifest names every stored list: its family and concept, a digest of its set of codes, and the run
that extracted it.  Wanted lists are anti-joined with it; what is missing is extracted by one more
scan, joined to the missing lists' codes alone, and appended as a run of its own.  A list whose codes
have changed has another digest and is extracted anew; other lists stay as they are.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .codelists import DuplicateCodes
from .store import _lock_for, table_path

_MANIFEST = "seq long, family string, concept string, codes string, run string, n_codes long"


def list_digests(codes: DataFrame) -> DataFrame:
    """family, concept, codes (a digest of the set of codes, whatever their order), n_codes.

    Equal for equal sets; combines on the map side, so a list of any size meets in no task.  A code
    that stands twice in a list would double its events, so it is refused."""
    once = codes.groupBy("family", "concept", "code").agg(F.count(F.lit(1)).alias("n"))
    h = F.xxhash64("code")
    return once.groupBy("family", "concept").agg(
        F.count(F.lit(1)).alias("n_codes"), F.max("n").alias("most"),
        F.concat_ws("-", F.count(F.lit(1)), F.hex(F.bit_xor(h)), F.sum(F.xxhash64("code", F.lit(1)) % (1 << 40))).alias("codes"))


#: Of the event table's files, for each partition that the extraction's joins begin with, and of their
#: exchanged rows, for each task at most: an event stands in several lists, so a task sorts far more.
PARTITION_BYTES, TASK_BYTES = 2 << 20, 16 << 20


@contextmanager
def settings(spark: SparkSession, conf: dict):
    """Session settings within the block."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sized(spark: SparkSession, n: int) -> dict:
    """Settings of joins and aggregates that begin with ``n`` partitions, as many as the data asks for, and are
    put together up to ``TASK_BYTES``: a task's sort does not grow with the data."""
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    begin = int(spark.conf.get(first, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    return {first: max(begin, n), "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES}


def sized_scans(spark: SparkSession, n: int) -> dict:
    """Those of ``sized``, with scans of ``TASK_BYTES`` at most: a task that combines the rows of its scan
    holds no more at any size of the data."""
    key = "spark.sql.files.maxPartitionBytes"
    most = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(str(spark.conf.get(key)))
    return {**sized(spark, n), key: min(most, TASK_BYTES)}


class CodedEvents:
    """The stored lists of one event table.

    ``source`` names the state of that table; ``extract(codes)`` gives the events of a (family,
    concept, code) table; ``n_bytes`` is the size of the data it reads."""

    def __init__(self, spark: SparkSession, name: str, source: str, extract: Callable[[DataFrame], DataFrame], n_bytes: int = 0):
        self.spark, self.extract, self.n_bytes = spark, extract, n_bytes
        self.path = table_path(spark, "coded", f"{name}_{source}")
        self._known: dict[tuple, str] | None = None

    @property
    def manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException:
            return self.spark.createDataFrame([], _MANIFEST)

    def _sized(self) -> dict:
        """Settings of the extraction's joins: an event table asks for more partitions than its buckets."""
        return sized(self.spark, -(-self.n_bytes // PARTITION_BYTES))

    def ensure(self, codes: DataFrame, refresh: bool = False, families=None) -> dict[tuple[str, str], str]:
        """Extract the lists of ``codes`` (of some families) that are not stored; (family, concept) -> run
        of all stored ones.  All lists are checked, whatever the families.

        What reaches the driver is one row per list."""
        with _lock_for(self.path):
            wanted = list_digests(codes)
            stored = self.manifest.groupBy("family", "concept", "codes").agg(F.max_by("run", "seq").alias("run"))
            rows = wanted.join(stored, ["family", "concept", "codes"], "left").collect()
            if twice := sorted(r["concept"] for r in rows if r["most"] > 1):
                raise DuplicateCodes(f"codes stand more than once in: {twice}")
            missing = [r for r in rows if (refresh or r["run"] is None) and (families is None or r["family"] in families)]
            runs = {(r["family"], r["concept"]): r["run"] for r in rows if r["run"] is not None}
            if missing:
                run = f"run{time.time_ns()}-{uuid.uuid4().hex[:8]}"
                names = [f"{r['family']}/{r['concept']}" for r in missing]
                new = codes.filter(F.concat("family", F.lit("/"), "concept").isin(names))
                # straight from the join's tasks, one open file per family: no exchange of the events; dates in
                # order, so windows skip row groups and later exchanges compress
                with settings(self.spark, {**self._sized(), "spark.sql.maxConcurrentOutputFileWriters": len({r["family"] for r in missing}) + 1}):
                    self.extract(new).sortWithinPartitions("date").write.partitionBy("family").parquet(f"{self.path}/{run}")
                entries = [(time.time_ns(), r["family"], r["concept"], r["codes"], run, r["n_codes"]) for r in missing]
                self.spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
                runs |= {(r["family"], r["concept"]): run for r in missing}
            return runs

    def read(self, runs: dict[tuple[str, str], str], schema: T.StructType, families=None) -> DataFrame:
        """The events of the given lists (of some families): one scan per run, pruned to its lists."""
        parts: dict[str, dict[str, list[str]]] = {}
        for (family, concept), run in sorted(runs.items()):
            if families is None or family in families:
                parts.setdefault(run, {}).setdefault(family, []).append(concept)
        out = []
        for run, lists in sorted(parts.items()):
            rows = self.spark.read.schema(schema).parquet(f"{self.path}/{run}")
            some = reduce(lambda a, b: a | b, [(F.col("family") == f) & F.col("concept").isin(c) for f, c in lists.items()])
            out.append(rows.filter(some))
        return reduce(DataFrame.unionByName, out) if out else self.spark.createDataFrame([], schema)
