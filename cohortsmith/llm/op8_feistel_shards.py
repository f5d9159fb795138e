"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows get gapless global numbers in the order (doc_id, text crc32, size), nulls first.  A keyed
Feistel network permutes 0..2^b-1, the smallest power of two holding all rows; a number that
falls outside 0..n-1 is encrypted again until it falls inside (cycle walking), which keeps the
map a permutation of 0..n-1.  Shard and slot are the permuted number modulo and divided by the
shard count, so both are computable for any row number without looking at other rows
(``locate``), and the row of any (shard, slot) is computable back (``row_at``).  Shard sizes
differ by one row at most.

Defined cases: null text has no bytes (size 1, crc32 0); null ids come first; rows alike in all
three order columns are interchangeable; an empty table gives an empty result; other columns of
the input are not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, whole_text

ROUNDS = 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _round_keys(key: int) -> list[int]:
    return [int(_mix(np.array([i + 1], np.uint64), key & (2**64 - 1))[0]) for i in range(ROUNDS)]


def _network(x: np.ndarray, bits: int, keys: list[int], back: bool) -> np.ndarray:
    rb = np.uint64(bits // 2)
    lmask, rmask = np.uint64((1 << (bits - bits // 2)) - 1), np.uint64((1 << (bits // 2)) - 1)
    left, right = x >> rb, x & rmask
    for i in (reversed(range(ROUNDS)) if back else range(ROUNDS)):
        if i % 2 == 0:
            left = left ^ (_mix(right, keys[i]) & lmask)
        else:
            right = right ^ (_mix(left, keys[i]) & rmask)
    return (left << rb) | right


def permute(x, n: int, key: int, back: bool = False) -> np.ndarray:
    """The permuted numbers of ``x`` (all in 0..n-1), or with ``back`` the numbers before it."""
    x = np.asarray(x, dtype=np.uint64)
    bits, keys = max(1, (n - 1).bit_length()), _round_keys(key)
    out = _network(x, bits, keys, back)
    while (outside := out >= np.uint64(n)).any():
        out[outside] = _network(out[outside], bits, keys, back)
    return out.astype(np.int64)


def locate(row: int, n: int, shards: int, key: int) -> tuple[int, int]:
    at = int(permute([row], n, key)[0])
    return at % shards, at // shards


def row_at(shard: int, slot: int, n: int, shards: int, key: int) -> int:
    return int(permute([slot * shards + shard], n, key, back=True)[0])


def feistel_shards(docs: DataFrame, shards: int = 8, key: int = 20240301) -> DataFrame:
    """doc_id, size, text_crc32, row, shard, slot of every document."""
    text = whole_text()
    slim = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows, n = numbered(slim, ["doc_id", "text_crc32", "size"])

    @F.pandas_udf("long")
    def moved(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), n, key))

    return (rows.withColumn("_at", moved("row"))
                .select("doc_id", "size", "text_crc32", "row",
                        (F.col("_at") % shards).cast("int").alias("shard"),
                        F.expr(f"_at div {shards}").alias("slot")))
