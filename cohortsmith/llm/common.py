"""Small helpers shared by the operators: table reads, stored intermediates, global row numbers."""

from __future__ import annotations

import ctypes
import gc
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_store


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage, so a lost
    executor re-reads the stored copy.  Each call writes to a path of its own."""
    spark = df.sparkSession
    path = f"{ensure_store(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    release()
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give the driver's freed memory back to the system (the allocator keeps it otherwise)."""
    gc.collect()
    trim()


def trim() -> None:
    """Give what the allocators of this process hold unused back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def whole_text(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null id: remainder 0, as crc32 of no bytes is 0)."""
    return (F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0)) % n).cast("int")


def fold_of(doc_id, n: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % n


HEAVY_PART = 10_000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` with the columns of their group (one row per ``key``, its row count in ``size``).

    Groups of more than a 10,000th of all ``total`` rows are at most 10,000, so they are broadcast
    and their rows stay where they are; the rows of all others meet their group in a shuffle, in
    which no key has more than that part of the rows."""
    heavy = F.broadcast(groups.filter(F.col(size) * HEAVY_PART > total))
    light = groups.filter(F.col(size) * HEAVY_PART <= total)
    others = rows.join(heavy.select(key), key, "left_anti").join(light, key)
    return rows.join(heavy, key).unionByName(others)


def matching_rows(docs: DataFrame, key: Column, keep: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, key) is in ``keep`` (doc_id, key[, times]), with all
    their columns whatever their names; of repeated rows one, ``times`` times if given.

    One exchange of the rows: the join leaves them sorted by the keys that the window needs."""
    times = F.col("times").cast("int") if "times" in keep.columns else F.lit(1)
    wanted = keep.select(F.col("doc_id").alias("_wid"), F.col("key").alias("_wkey"), times.alias("_times"))
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), key.alias("_key"))
    rows = rows.join(wanted, F.col("_id").eqNullSafe(F.col("_wid")) & (F.col("_key") == F.col("_wkey")))
    same = Window.partitionBy(F.coalesce("_id", F.lit(0)), F.isnull("_id"), "_key").orderBy(F.lit(1))
    rows = rows.select("_row", "_times", F.row_number().over(same).alias("_nth")).filter("_nth = 1")
    if "times" in keep.columns:
        rows = rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return rows.select("_row.*")


def numbered(df: DataFrame, order: list[str], to: str = "row") -> tuple[DataFrame, int]:
    """``df`` with gapless global numbers from 0 in ``order`` (nulls first), and the row count.

    Range partitions are sorted on their own and stored with (partition, place); only one count
    per partition reaches the driver, and these offsets go out as a table of that many rows."""
    spark = df.sparkSession
    placed = stored(df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
                      .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
                      .withColumn("_place", F.monotonically_increasing_id()), "numbered")
    pid = F.shiftright("_place", 33)
    counts = placed.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], 0
    for r in sorted(counts, key=lambda r: r["_pid"]):
        offsets.append((r["_pid"], total))
        total += r["n"]
    table = spark.createDataFrame(offsets, "_pid long, _off long")
    out = (placed.withColumn("_pid", pid).join(F.broadcast(table), "_pid")
                 .withColumn(to, F.col("_off") + F.col("_place").bitwiseAND((1 << 33) - 1))
                 .drop("_pid", "_off", "_place"))
    return out, total


def worker_cache(key: str, make):
    """A value kept for the life of a Python worker (functions sent by value have fresh globals)."""
    import sys
    cache = sys.__dict__.setdefault("_cohortsmith_llm_cache", {})
    if key not in cache:
        cache[key] = make()
    return cache[key]


def frames(it, most: int | None = None):
    """Non-empty pandas frames of Arrow batches, of at most ``most`` rows each.  A worker waits for
    later tasks beside the others of its executor, so it gives its unused memory back at the end."""
    for b in it:
        for at in range(0, b.num_rows, most or max(1, b.num_rows)):
            yield b.slice(at, most or b.num_rows).to_pandas()
    trim()
