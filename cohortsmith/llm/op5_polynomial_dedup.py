"""Exact dedup by composable polynomial fingerprints.

Every text is lower-cased (A-Z only) and cut into byte chunks.  A chunk b_0..b_{k-1} hashes to
sum b_i r^(k-1-i) modulo the prime 2^31 - 1, for four bases r; chunks are hashed side by side,
wherever they are.  Hashes compose: h(x + y) = h(x) r^|y| + h(y), so a chunk shifted by the
length that follows it adds into its document's fingerprint, and the combination is a plain sum
that Spark pre-aggregates.  Documents whose length and four hashes agree are then compared chunk
by chunk: per (fingerprint, chunk number) the least and the greatest chunk must be the same
bytes.  That aggregate combines on the map side, so a group of any size never meets in one task.
Should a fingerprint ever join different texts, its documents are told apart by SHA-256.

Defined cases: null text counts as empty, and all empty texts are one group; null ids rank below
all others, so they stay only if a group has no other id; of repeated rows with one id and text
exactly one stays; an empty table gives an empty result; other input columns are not read.
"""

from __future__ import annotations

import string

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, matching_rows, stored, whole_text

PRIME = (1 << 31) - 1
BASES = (1_103_515_243, 1_664_525_021, 754_077_413, 1_903_815_317)
#: 255 * 2^31 * 2^14 < 2^53: a chunk's dot product is exact in float64.
CHUNK_BYTES = 1 << 14


def power_table(size: int = CHUNK_BYTES) -> np.ndarray:
    out = np.ones((size, len(BASES)), dtype=np.float64)
    for j, r in enumerate(BASES):
        x = 1
        for i in range(size - 1, -1, -1):
            out[i, j] = x
            x = x * r % PRIME
    return out


def chunk_hash(chunk: bytes, table: np.ndarray) -> list[int]:
    b = np.frombuffer(chunk, dtype=np.uint8).astype(np.float64)
    return [int(h) % PRIME for h in b @ table[len(table) - len(b):]]


def shifted(hashes: list[int], after: int) -> list[int]:
    """The hashes of a chunk that ``after`` bytes follow."""
    return [h * pow(r, after, PRIME) % PRIME for h, r in zip(hashes, BASES)] if after else hashes


def combine(left: list[int], right: list[int], right_bytes: int) -> list[int]:
    return [(a + b) % PRIME for a, b in zip(shifted(left, right_bytes), right)]


def normalised(text="text"):
    return F.translate(whole_text(text), string.ascii_uppercase, string.ascii_lowercase)


def _chunks(raw: str, n: str):
    """(number, bytes) of each chunk; one empty chunk for an empty text."""
    last = F.greatest(F.expr(f"({n} + {CHUNK_BYTES - 1}) div {CHUNK_BYTES}"), F.lit(1)) - 1
    return F.transform(F.sequence(F.lit(0).cast("long"), last.cast("long")), lambda i: F.struct(
        i.alias("i"), F.substring(F.col(raw), (i * CHUNK_BYTES + 1).cast("int"), F.lit(CHUNK_BYTES)).alias("b")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, text_sha256, n_bytes, fingerprint of every row."""
    @F.pandas_udf("array<long>")
    def hashes(b: pd.Series, after: pd.Series) -> pd.Series:
        table = power_table()
        return pd.Series([shifted(chunk_hash(x, table), int(k)) for x, k in zip(b, after)])

    t = docs.select("doc_id", normalised().alias("t"))
    t = t.select("doc_id", F.monotonically_increasing_id().alias("row_id"), F.sha2("t", 256).alias("text_sha256"),
                 F.octet_length("t").cast("long").alias("n_bytes"), F.col("t").cast("binary").alias("raw"))
    c = t.select("row_id", "doc_id", "text_sha256", "n_bytes", F.explode(_chunks("raw", "n_bytes")).alias("c"))
    after = F.greatest(F.col("n_bytes") - (F.col("c.i") + 1) * CHUNK_BYTES, F.lit(0))
    c = c.select("row_id", "doc_id", "text_sha256", "n_bytes", hashes("c.b", after).alias("h"))
    sums = [(F.sum(F.col("h")[j]) % PRIME).alias(f"h{j}") for j in range(len(BASES))]
    return (c.groupBy("row_id", "doc_id", "text_sha256", "n_bytes").agg(*sums)
             .select("row_id", "doc_id", "text_sha256", "n_bytes",
                     F.concat_ws("-", "n_bytes", *[F.lpad(F.hex(f"h{j}"), 8, "0") for j in range(len(BASES))])
                      .alias("fingerprint")))


def refuted(docs: DataFrame, prints: DataFrame, total: int) -> DataFrame:
    """Fingerprints that join different texts, by comparing all chunks of equal fingerprints."""
    shared = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = prints.select(F.col("doc_id").alias("_d"), F.col("text_sha256").alias("_s"), "fingerprint").distinct()
    members = join_groups(rows, shared, "fingerprint", "n", total).drop("n")
    t = docs.select("doc_id", normalised().alias("t"))
    t = t.select("doc_id", F.sha2("t", 256).alias("s"), F.octet_length("t").cast("long").alias("n"),
                 F.col("t").cast("binary").alias("raw"))
    c = (t.join(members, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("s") == F.col("_s")))
          .select("fingerprint", F.explode(_chunks("raw", "n")).alias("c")))
    same = (c.groupBy("fingerprint", F.col("c.i").alias("i"))
             .agg((F.min("c.b") == F.max("c.b")).alias("same")))
    return same.groupBy("fingerprint").agg(F.min("same").alias("same")).filter("not same").select("fingerprint")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, fingerprint."""
    prints = stored(fingerprints(docs), "fingerprints")
    total = prints.count()
    bad = refuted(docs, prints, total).withColumn("_bad", F.lit(True))
    rows = prints.join(bad, "fingerprint", "left").withColumn(
        "_class", F.when(F.col("_bad"), F.concat_ws("-", "fingerprint", "text_sha256")).otherwise(F.col("fingerprint")))
    groups = rows.groupBy("_class").agg(F.count(F.lit(1)).alias("group_size"),
                                        F.max(F.struct("doc_id", "row_id")).alias("_top"))
    return join_groups(rows, groups, "_class", "group_size", total).select(
        "doc_id", F.col("_top.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("_top.row_id")).alias("kept"), "text_sha256", "fingerprint")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    keep = exact_duplicates(docs).filter("kept").select("doc_id", F.col("text_sha256").alias("key"))
    return matching_rows(docs, F.sha2(normalised(), 256), keep)
