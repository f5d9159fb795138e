"""Substring dedup: a common-prefix-aware distributed merge sort of suffixes.

Removed is every byte that a 400-byte string covers which also starts anywhere else.  Sorting all
suffixes is not needed to find these strings: each 400-byte window is represented by an anchor,
the place of the least hash of 8 bytes among its first 200 places.  The anchor depends on the
window's bytes alone, so equal windows have their anchors at the same place, and the suffixes at
these anchors share at least the 200 bytes that follow.

1. Every task finds its anchors and counts their 200-byte prefixes by hash; prefixes met twice
   set a bit in a bitmap, whose size follows their number up to ``MOST_BITS``.  A prefix met once
   cannot lie in a repeated window; a false hit costs time only.
2. The suffixes of the marked anchors (as far as their windows reach, with the bytes before the
   anchor that their windows cover) are sorted in each task into runs, one per bucket of the
   prefix, equal ones written once, front-coded: the length shared with the suffix before, and
   the rest.
3. There are as many buckets as give each about ``BUCKET`` anchors.  Each bucket's runs are merged by a loser tree that keeps, for every run's head, the prefix it
   shares with the last output.  Heads with different such lengths are ordered without reading a
   byte; equal ones are compared from that length on.  The merged order and its shared lengths
   give the groups of anchors that share 200 bytes.
4. Within these groups, the windows that occur twice are found by rolling hashes, which settles
   the exact borders; a window's bytes go back to its document as an interval.
5. A prefix met more than ``HOT`` times would make one bucket large.  Its anchors (marked in a
   second bitmap) leave the merge, and Spark's aggregate, which combines on the map side, counts
   their strings, so no group meets in one task.  The windows of an anchor are taken ``SPAN`` at a
   time by their distance from it: where the whole stretch that such windows cover occurs twice,
   all of them do; where the part that all of them share occurs once, none does.  Windows are
   counted one by one (by 128-bit hashes) only where neither holds, at the borders of passages.
   Both ways are exact, so a false mark costs time only.

Defined cases: null text counts as empty; texts under 400 bytes keep all; matches never cross
documents but do lie within one, overlaps included; repeated rows are repeats of each other; an
empty table gives an empty result; other input columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frames, join_groups, stored, whole_text

LENGTH = 400
REACH = LENGTH // 2
PART_BYTES = 4096  # of one bitmap of Spark's
GRAM = 8
BLOCK = 1 << 20
PLACE_BITS = 21  # places in a block and the window after it
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 30  #: of a bitmap, which has 16 bits a prefix between them
BUCKET = 50_000
HOT, SPAN = 50_000, 16
_A, _B = 0x9E3779B97F4A7C15 | 1, np.random.default_rng(9).integers(1, 2**63, 256, dtype=np.uint64)


def _anchors_of(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first start, last start) of the windows of one block."""
    n = len(b) - LENGTH + 1
    m = n + REACH - 1  # places that can be anchors
    pad = np.zeros(m + GRAM + 8, np.uint8)
    take = min(len(b), len(pad))
    pad[:take] = b[:take]
    h = np.empty(m, np.uint64)
    for k in range(GRAM):
        part = pad[k:k + (len(pad) - k) // 8 * 8].view("<u8")
        h[k::8] = part[:len(h[k::8])]
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    h = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(m, dtype=np.uint64)
    rows = -(-m // REACH)
    grid = np.full(rows * REACH, np.iinfo(np.uint64).max, np.uint64)
    grid[:m] = h
    grid = grid.reshape(rows, REACH)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[REACH - 1:REACH - 1 + n])
    at = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], first, np.append(first[1:] - 1, n - 1)


def anchors(data: bytes):
    """(prefix hash, anchor, first start, last start) for the windows of ``data``."""
    b = np.frombuffer(data, np.uint8)
    for at in range(0, len(b) - LENGTH + 1, BLOCK):
        part = b[at:at + BLOCK + LENGTH - 1]
        for p, s1, s2 in zip(*(x.tolist() for x in _anchors_of(part))):
            p += at
            yield xxhash.xxh3_64_intdigest(data[p:p + REACH]) >> 1, p, s1 + at, s2 + at


def shared_length(a: bytes, b: bytes, start: int) -> int:
    """How many bytes ``a`` and ``b`` share, given that they share ``start``."""
    n, step = min(len(a), len(b)), 32
    while start < n:
        x, y = a[start:start + step], b[start:start + step]
        if x != y:
            k = min(len(x), len(y))
            d = int.from_bytes(x[:k], "big") ^ int.from_bytes(y[:k], "big")
            return start + (k - (d.bit_length() + 7) // 8 if d else k)
        start += step
        step *= 2
    return n


class LoserTree:
    """Merges front-coded sorted runs [(shared, rest, payload), ...]; yields (shared with the
    output before, string, payload) and never compares a known common prefix again."""

    def __init__(self, runs: list[list]):
        self.runs = [iter(r) for r in runs]
        self.size = 1
        while self.size < max(1, len(runs)):
            self.size *= 2
        self.head: list = [None] * self.size  # (string, payload)
        self.known = [0] * self.size  # shared with the last output
        for r in range(len(runs)):
            self._advance(r)
        self.loser = [-1] * self.size
        self.winner = self._build(1)

    def _advance(self, r: int) -> None:
        nxt = next(self.runs[r], None)
        if nxt is None:
            self.head[r] = None
            return
        shared, rest, payload = nxt
        before = self.head[r][0] if self.head[r] else b""
        self.head[r], self.known[r] = (before[:shared] + rest, payload), shared

    def _wins(self, x: int, y: int) -> bool:
        """Whether head x goes first; the loser's known length becomes that to the winner."""
        if self.head[y] is None or self.head[x] is None:
            return self.head[x] is not None or self.head[y] is None
        if self.known[x] != self.known[y]:
            return self.known[x] > self.known[y]
        a, b = self.head[x][0], self.head[y][0]
        k = shared_length(a, b, self.known[x])
        first = k == len(a) or (k < len(b) and a[k] < b[k])
        self.known[y if first else x] = k
        return first

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        x, y = self._build(2 * node), self._build(2 * node + 1)
        won = self._wins(x, y)
        self.loser[node] = y if won else x
        return x if won else y

    def __iter__(self):
        while self.head[self.winner] is not None:
            w = self.winner
            yield self.known[w], *self.head[w]
            self._advance(w)
            node = (w + self.size) // 2
            while node:
                rival = self.loser[node]
                if not self._wins(w, rival):
                    self.loser[node], w = w, rival
                node //= 2
            self.winner = w


def front_coded(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    shared, rest, before = [], [], b""
    for s in strings:
        k = shared_length(before, s, 0)
        shared.append(k)
        rest.append(s[k:])
        before = s
    return shared, rest


_POWERS: dict[int, tuple] = {}


def _powers(n: int):
    if n not in _POWERS:
        mod, inv = 1 << 64, pow(_A, -1, 1 << 64)
        up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
        x = y = 1
        for i in range(n):
            up[i], down[i] = x, y
            x, y = x * _A % mod, y * inv % mod
        _POWERS[n] = (up, down)
    return _POWERS[n]


def window_hashes(data: bytes) -> np.ndarray:
    """A 64-bit polynomial hash of every 400-byte window of a segment."""
    with np.errstate(over="ignore"):
        size = 1 << max(10, (len(data) - 1).bit_length())
        up, down = _powers(size)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_B[np.frombuffer(data, np.uint8)] * up[:len(data)], out=total[1:])
        n = len(data) - LENGTH + 1
        return (total[LENGTH:LENGTH + n] - total[:n]) * down[:n]


def repeated_windows(merged) -> list[tuple[list, int, int]]:
    """(occurrences, first, last) of the runs of repeated windows of the merged suffixes, whose
    payloads are (bytes before the anchor, occurrences)."""
    out, group, found = [], [], []

    def close():
        if len(group) > 1 or (group and len(group[0][1]) > 1):
            out.extend(group)
        group.clear()

    for shared, suffix, (left, occurrences) in merged:
        if shared < REACH:
            close()
        group.append((left + suffix, occurrences))
    close()
    if not out:
        return found
    hashes = [window_hashes(s) for s, _ in out]
    u, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    times = np.bincount(inverse, np.repeat([min(2, len(o)) for _, o in out], [len(h) for h in hashes]), len(u))
    again, at = (times[inverse] >= 2).astype(np.int8), 0
    for (_, occurrences), h in zip(out, hashes):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], again[at:at + len(h)], [0]]).astype(np.int8)))
        found.extend((occurrences, int(a), int(z) - 1) for a, z in zip(edge[::2], edge[1::2]))
        at += len(h)
    return found


_RUN = pa.schema([("bucket", pa.int32()), ("shared", pa.list_(pa.int32())), ("rest", pa.list_(pa.binary())),
                  ("left", pa.list_(pa.binary())), ("docs", pa.list_(pa.list_(pa.int64()))), ("hashes", pa.list_(pa.list_(pa.int64()))),
                  ("starts", pa.list_(pa.list_(pa.int64())))])
_RUN_SQL = ("bucket int, shared array<int>, rest array<binary>, left array<binary>, docs array<array<long>>, "
            "hashes array<array<long>>, starts array<array<long>>")


def _counts(it):
    for pdf in frames(it):
        found = [np.fromiter((g for g, *_ in anchors(t.encode("utf-8"))), np.int64) for t in pdf["text"] if len(t) * 4 >= LENGTH]
        g, c = np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(c)], names=["g", "c"])


def _bitmap(prefixes: DataFrame, n: int) -> np.ndarray:
    """One bit per prefix hash modulo the bitmap's size, for ``n`` prefixes: all that the driver holds."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * n - 1).bit_length())) if n else LEAST_BITS
    bit = F.pmod("g", F.lit(size)) + 1  # Spark counts bits from 1
    parts = (prefixes.groupBy(F.bitmap_bucket_number(bit).alias("part"))
                     .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).toArrow())
    bits = np.zeros(size // 8, np.uint8)
    for part, found in zip(parts["part"].to_pylist(), parts["bits"]):
        at = (part - 1) * PART_BYTES
        bits[at:at + PART_BYTES] = np.frombuffer(found.as_buffer(), np.uint8)
    return bits


def _marked(bits: np.ndarray, g: int) -> int:
    k = g % (len(bits) * 8)
    return int(bits[k >> 3]) >> (k & 7) & 1


_STRETCHES = pa.schema([("core", pa.binary()), ("hull", pa.binary()), ("doc_id", pa.int64()), ("h", pa.int64()),
                        ("first", pa.int64()), ("last", pa.int64()), ("windows", pa.binary())])
_STRETCHES_SQL = "core binary, hull binary, doc_id long, h long, first long, last long, windows binary"


def stretches(data: bytes, p: int, s1: int, s2: int):
    """(hash of what the windows share, hash of all they cover, first start, last start) of the windows
    of anchor ``p``, ``SPAN`` at a time by their distance from it.

    The hull is None where windows with other anchors lie in the stretch: they are not in question."""
    for k in range((p - s2) // SPAN * SPAN, p - s1 + 1, SPAN):
        lo, hi = p - k - SPAN + 1, p - k  # starts of the stretch, wherever their anchors are
        core = xxhash.xxh3_128_digest(data[hi:lo + LENGTH], k + 1)
        hull = xxhash.xxh3_128_digest(data[lo:hi + LENGTH], k + 1) if s1 <= lo and hi <= s2 else None
        yield core, hull, max(lo, s1), min(hi, s2)


def _stretches(hot):
    def run(it):
        marks = hot.value
        for pdf in frames(it):
            rows = []
            for doc_id, h, text in zip(pdf["doc_id"], pdf["h"].tolist(), pdf["text"]):
                data = text.encode("utf-8")
                for g, p, s1, s2 in anchors(data):
                    if _marked(marks, g):
                        rows += [(core, hull, None if pd.isna(doc_id) else int(doc_id), h, a, z, data[a:z + LENGTH])
                                 for core, hull, a, z in stretches(data, p, s1, s2)]
                    if len(rows) > 10_000:
                        yield _rows(rows, _STRETCHES)
                        rows = []
            yield _rows(rows, _STRETCHES)
    return run


def _windows(it):
    """(128-bit hash, document, start) of the windows of undecided stretches."""
    for pdf in frames(it):
        rows = []
        for r in pdf.itertuples(index=False):
            doc_id = None if pd.isna(r.doc_id) else int(r.doc_id)
            rows += [(xxhash.xxh3_128_digest(r.windows[i:i + LENGTH]), doc_id, r.h, r.first + i, r.times) for i in range(r.last - r.first + 1)]
        yield _rows(rows, _WINDOWS)


_WINDOWS = pa.schema([("w", pa.binary()), ("doc_id", pa.int64()), ("h", pa.int64()), ("start", pa.int64()), ("times", pa.int32())])


def _twice(rows: DataFrame, key: str, times=None) -> DataFrame:
    """The rows whose ``key`` (not null) is met more than once."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg((F.count(F.lit(1)) if times is None else times).alias("n")).filter("n > 1")
    return join_groups(rows, counts, key, "n", rows.count()).drop("n")


def hot_spans(t: DataFrame, hot) -> DataFrame:
    """doc_id, h, start, end: the intervals of repeated windows of the anchors marked in ``hot``."""
    end = lambda c: (F.col(c) + LENGTH).alias("end")
    found = stored(t.mapInArrow(_stretches(hot), _STRETCHES_SQL).withColumn("place", F.monotonically_increasing_id()), "hot-stretches")
    slim = found.drop("windows")
    whole = stored(_twice(slim, "hull"), "hot-whole")
    rest = stored(_twice(slim, "core").select("place", "core").join(whole.select("place"), "place", "left_anti"), "hot-open")
    # a window of an undecided stretch may stand in a repeated one: one of each kind is counted, twice
    kinds = whole.groupBy("hull").agg(F.min(F.struct("place", "core")).alias("x")).select("x.*").join(rest.select("core").distinct(), "core", "left_semi")
    wanted = rest.select("place", F.lit(1).alias("times")).unionByName(kinds.select("place", F.lit(2).alias("times")))
    windows = (wanted.join(found.select("place", "doc_id", "h", "first", "last", "windows"), "place")
               .select("doc_id", "h", "first", "last", "windows", "times").mapInArrow(_windows, "w binary, doc_id long, h long, start long, times int"))
    windows = stored(windows, "hot-windows")
    return (whole.select("doc_id", "h", F.col("first").alias("start"), end("last"))
            .unionByName(_twice(windows, "w", F.sum("times")).filter("times = 1").select("doc_id", "h", "start", end("start"))))


def _rows(rows: list[tuple], schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


def _runs(bitmap, hot, buckets: int):
    def run(it):
        bits, marks = bitmap.value, hot.value
        for pdf in frames(it):
            segments: dict[int, dict] = {}
            ids = [None if pd.isna(d) else int(d) for d in pdf["doc_id"]]
            for doc_id, h, text in zip(ids, pdf["h"].tolist(), pdf["text"]):
                data = text.encode("utf-8")
                for g, p, s1, s2 in anchors(data):
                    if _marked(bits, g) and not _marked(marks, g):
                        segments.setdefault(g % buckets, {}).setdefault((data[p:s2 + LENGTH], data[s1:p]), []).append((doc_id, h, s1))
            rows = []
            for bucket, found in segments.items():
                keys = sorted(found)
                shared, rest = front_coded([k[0] for k in keys])
                occ = [found[k] for k in keys]
                rows.append((bucket, shared, rest, [k[1] for k in keys], *[[[o[j] for o in x] for x in occ] for j in range(3)]))
            yield _rows(rows, _RUN)
    return run


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    runs = []
    for r in pdf.itertuples(index=False):
        runs.append([(int(s), x, (left, list(zip(d, h, st))))
                     for s, x, left, d, h, st in zip(r.shared, r.rest, r.left, r.docs, r.hashes, r.starts)])

    def merged():
        """Equal segments of different runs are one, with all their occurrences."""
        before = None
        for shared, s, (left, occ) in LoserTree(runs):
            if before and shared == len(s) == len(before[1]) and left == before[2][0]:
                before[2][1].extend(occ)
                continue
            if before:
                yield before
            before = (shared, s, (left, list(occ)))
        if before:
            yield before

    ids, hs, a, z = [], [], [], []
    for occurrences, first, last in repeated_windows(merged()):
        for d, h, s in occurrences:
            ids.append(None if d is None or pd.isna(d) else int(d))
            hs.append(int(h))
            a.append(int(s) + first)
            z.append(int(s) + last + LENGTH)
    return pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "h": np.array(hs, np.int64), "start": np.array(a, np.int64), "end": np.array(z, np.int64)})


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), start, end: byte intervals of repeated 400-byte strings."""
    spark = docs.sparkSession
    t = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    met = t.select("text").mapInArrow(_counts, "g long, c long").groupBy("g").agg(F.sum("c").alias("c")).filter("c > 1")
    met = stored(met, "prefixes")
    often = met.filter(F.col("c") > HOT)
    all_, heavy = (x.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("c"), F.lit(0)).alias("c")).first() for x in (met, often))
    bits = spark.sparkContext.broadcast(_bitmap(met, all_["n"]))
    hot = spark.sparkContext.broadcast(_bitmap(often, heavy["n"]))
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), (all_["c"] - heavy["c"]) // BUCKET)
    t = t.withColumn("h", F.xxhash64("text"))
    runs = t.mapInArrow(_runs(bits, hot, buckets), _RUN_SQL)
    spans = runs.groupBy("bucket").applyInPandas(_merge, "doc_id long, h long, start long, end long")
    return spans.unionByName(hot_spans(t, hot)) if heavy["n"] else spans


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_bytes, removed array<struct<start,end>> (maximal runs), kept (the bytes left)."""
    spans = stored(repeated_spans(docs), "spans")
    spans = spans.groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "end")).alias("spans")).withColumnsRenamed({"doc_id": "_d", "h": "_h"})
    t = docs.select("doc_id", whole_text().alias("text")).withColumn("h", F.xxhash64("text"))
    t = t.join(spans, F.col("doc_id").cast("long").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), "left")

    @F.pandas_udf("array<struct<start:long,end:long>>")
    def maximal(found: pd.Series) -> pd.Series:
        out = []
        for x in found:
            if x is None:
                out.append(None)
                continue
            runs: list[dict] = []
            for s, e in sorted((int(i["start"]), int(i["end"])) for i in x):
                if runs and s <= runs[-1]["end"]:
                    runs[-1]["end"] = max(runs[-1]["end"], e)
                else:
                    runs.append({"start": s, "end": e})
            out.append(runs)
        return pd.Series(out)

    removed = F.coalesce(maximal("spans"), F.array().cast("array<struct<start:bigint,end:bigint>>"))
    raw = F.col("text").cast("binary")
    t = t.select("doc_id", raw.alias("raw"), F.octet_length("text").cast("long").alias("n_bytes"), removed.alias("removed"))
    # what is left: the stretches between the removed ones, joined as hex digits (binary has no array_join)
    zero = F.array(F.lit(0).cast("long"))
    left = F.zip_with(F.concat(zero, "removed.end"), F.concat("removed.start", F.array("n_bytes")),
                      lambda at, to: F.hex(F.substring("raw", (at + 1).cast("int"), (to - at).cast("int"))))
    kept = F.unhex(F.array_join(left, ""))
    return t.select("doc_id", "n_bytes", "removed", F.when(F.size("removed") == 0, F.col("raw")).otherwise(kept).alias("kept"))
