"""Near-duplicates by order min-hash, verified by banded alignment.

A text is its sequence of five-word shingles (lower case, split at white space).  For each of
``BANDS`` hash orders the ``SAMPLE`` least occurrence-labelled shingles are taken and hashed in
the order in which they stand in the text, so a band agrees only where texts share both the
shingles and their order.  Two texts are linked if the alignment of their shingle sequences
matches at least 0.8 of them: matched / (m1 + m2 - matched) >= 0.8.  Such an alignment skips at
most (m1 + m2) / 9 shingles, which is the width of the band it is sought in.

Candidates, without all pairs of any bucket:

* equal sequences are one key, whatever the number of copies;
* every key is aligned with one leader, of the keys it shares buckets with the one whose buckets
  hold most (the original of a group of copies, as a rule), which joins the bulk of each group at
  one pair per key;
* in every bucket, keys that are not in the leader's class are then paired with the keys of other
  classes there.  Two linked keys share 0.8 of either's shingles, so in any order of the shingles
  they share one of the first fifth (and one more) of both: the join key is the bucket and such a
  shingle, rarest first.  Texts that share a common template only meet in its bucket, but not on
  its shingles, which are their commonest.  Groups of the same keys are paired once.  Every key
  is first aligned with the centre of one of its groups, the key whose shared shingles stand
  foremost (it has the fewest of its own), so copies of a text that are too far from their leader
  join its class at one pair per key.  Lengths, places in the order, parities of the shingles in
  ``BITS`` bins (both before a pair is formed) and shingle histograms (exact bounds on the
  matches: a difference in a bin is a shingle that no alignment can match) thin the other pairs.
  So no two keys that share a bucket and could be linked stay untested unless they are in one
  class already.

Classes are the connected components of the links.  Defined cases: null text counts as empty;
texts without words are one class; texts under five words are one shingle; of a class the row
with the least id is its name (null ids last); repeated rows are members each; an empty table
gives an empty result; other input columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import frames, join_groups, matching_rows, stored, whole_text
from .components import components

WORDS = 5
BANDS, SAMPLE = 20, 4
BINS, MOST_IN_BIN = 256, 127
BITS = 512  #: in 64-bit words
COUNTERS = 1 << 20  #: shingles are ordered by counts in so many bins; any order finds all pairs
NUM, DEN = 4, 5  # similarity 4/5
_A = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(20).integers(1, 2**63, size=(BANDS, 2), dtype=np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in words), np.uint32, len(words))


def shingles(w: np.ndarray) -> np.ndarray:
    if not len(w):
        return np.zeros(0, np.uint64)
    k = min(WORDS, len(w))
    x, out = w.astype(np.uint64), np.zeros(len(w) - k + 1, np.uint64)
    for j in range(k):
        out = out * _A + x[j:len(x) - k + 1 + j]
    return _mix(out + np.uint64(k))


def occurrences(s: np.ndarray) -> np.ndarray:
    """For each shingle, how often it stood before."""
    order = np.argsort(s, kind="stable")
    t = s[order]
    first = np.concatenate([[True], t[1:] != t[:-1]])
    out = np.empty(len(s), np.int64)
    out[order] = np.arange(len(s)) - np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))
    return out


def labelled(s: np.ndarray) -> np.ndarray:
    """The shingles, each hashed with the number of times it stood before: all are distinct."""
    return _mix(s + occurrences(s).astype(np.uint64) * _A) if len(s) else s


def rarest(s: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, labelled shingle) of the first fifth of the shingles and one more, rarest first; those
    that no other text has (their bin counts one) are left out."""
    x = labelled(s)
    c = counts[(x & np.uint64(len(counts) - 1)).astype(np.int64)]
    order = np.lexsort((x, c))[:len(x) - -(-NUM * len(x) // DEN) + 1]
    at = np.flatnonzero(c[order] > 1)
    return at.astype(np.int32), x[order[at]].view(np.int64)


def sketch(s: np.ndarray) -> np.ndarray:
    """One hash per band of the least labelled shingles in text order."""
    if not len(s):
        return np.zeros(0, np.int64)
    x = labelled(s)
    out = np.empty(BANDS, np.uint64)
    for j in range(BANDS):
        r = (x ^ _SEEDS[j, 0]) * _SEEDS[j, 1]
        at = np.sort(np.argpartition(r, SAMPLE)[:SAMPLE]) if len(r) > SAMPLE else np.arange(len(r))
        h = np.uint64(j + 1)
        for v in x[at]:
            h = h * _A + v
        out[j] = h
    return _mix(out).view(np.int64)


def histogram(s: np.ndarray, bins: int) -> np.ndarray:
    """Shingles per bin, at most ``MOST_IN_BIN``: what two histograms differ by, no alignment matches."""
    return np.minimum(np.bincount((s & np.uint64(bins - 1)).astype(np.int64), minlength=bins), MOST_IN_BIN).astype(np.int8)


def parities(s: np.ndarray) -> np.ndarray:
    """One bit per bin, whether its shingles are an odd number: each bit in which two texts differ is a
    shingle that no alignment matches."""
    odd = np.bincount((s & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def matched(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """The most shingles an alignment within ``band`` of the diagonal matches."""
    n = min(len(a), len(b))
    ne = np.flatnonzero(a[:n] != b[:n])
    head = int(ne[0]) if len(ne) else n
    a, b, n = a[head:], b[head:], n - head
    ne = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
    tail = int(ne[0]) if len(ne) else n
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    places: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(int(b[j]), []).append(j)
    if max(map(len, places.values())) <= 20:
        ends: list[int] = []
        for i, v in enumerate(a.tolist()):
            for j in places.get(v, ()):
                if abs(i - j) <= band:
                    k = bisect_left(ends, j)
                    ends[k:k + 1] = [j]
        return head + tail + len(ends)
    row = np.zeros(len(b) + 1, np.int64)  # much repetition: row by row, the band in one step each
    for i, v in enumerate(a):
        lo, hi = max(0, i - band), min(len(b), i + band + 1)
        if lo < hi:
            best = np.maximum(row[lo + 1:hi + 1], row[lo:hi] + (b[lo:hi] == v))
            row[lo + 1:hi + 1] = np.maximum.accumulate(np.maximum(best, row[lo]))
            row[hi + 1:] = np.maximum(row[hi + 1:], row[hi])
    return head + tail + int(row[-1])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    total = len(a) + len(b)
    need = -(-NUM * total // (NUM + DEN))
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    at = np.minimum(np.searchsorted(ub, ua), len(ub) - 1)
    if int(np.minimum(ca, cb[at])[ub[at] == ua].sum()) < need:
        return False
    return matched(a, b, total * (DEN - NUM) // (NUM + DEN)) >= need


_RARE = pa.schema([("key", pa.binary()), ("m", pa.int32()), ("places", pa.list_(pa.int32())), ("rare", pa.list_(pa.int64()))])


def _signatures(docs: DataFrame) -> DataFrame:
    """doc_id, h, key, m, bands, bins, bits of every row."""
    @F.pandas_udf("key binary, m int, bands array<long>, bins array<byte>, bits array<long>")
    def signature(texts: pd.Series) -> pd.DataFrame:
        out = []
        with np.errstate(over="ignore"):
            for t in texts:
                w = word_hashes(t)
                s = shingles(w)
                out.append((xxhash.xxh3_128_digest(w.tobytes()), len(s), sketch(s), histogram(s, BINS), parities(s)))
        return pd.DataFrame(out, columns=["key", "m", "bands", "bins", "bits"])

    t = docs.select("doc_id", whole_text().alias("text"))
    return t.select("doc_id", F.xxhash64("text").alias("h"), signature("text").alias("s")).select("doc_id", "h", "s.*")


def _verified(pairs: DataFrame, seqs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked."""
    side = lambda k: seqs.select(F.col("key").alias(k), F.col("seq").alias(f"_{k}"))

    def run(it):
        with np.errstate(over="ignore"):
            for pdf in frames(it):
                hit = [linked(*(shingles(np.frombuffer(x, np.uint32)) for x in p)) for p in zip(pdf["_a"], pdf["_b"])]
                yield pa.RecordBatch.from_pandas(pdf.loc[hit, ["a", "b"]], schema=pa.schema([("a", pa.binary()), ("b", pa.binary())]), preserve_index=False)

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a binary, b binary")


def _met_once(met: DataFrame) -> DataFrame:
    """The groups (``meet``) of two keys and more, those of the same keys as one group.

    Near copies share most of their buckets and rarest shingles, so the same few keys meet again and
    again.  A key is ``other`` if it is so in one of the groups and has its least place in them: no
    pair that passes in one of the groups is lost."""
    w, k = Window.partitionBy("meet"), F.xxhash64("key", F.lit(1))
    same = {"n": F.count(F.lit(1)).over(w), "x": F.bit_xor(F.xxhash64("key")).over(w), "y": F.bit_xor(k).over(w),
            "s": F.sum(k % (1 << 40)).over(w), "any": F.max("other").over(w)}
    groups = met.withColumns(same).filter("n > 1 and any")
    return (groups.groupBy("n", "x", "y", "s", "key")
                  .agg(F.first("label").alias("label"), F.max("other").alias("other"), F.first("m").alias("m"), F.min("at").alias("at"))
                  .withColumn("meet", F.xxhash64("n", "x", "y", "s")))


def _in_reach(met: DataFrame) -> DataFrame:
    """The keys of each group that have enough shingles from there on to be linked to its shortest
    text, and so to any."""
    least = F.min("m").over(Window.partitionBy("meet"))
    return met.withColumn("least", least).filter(f"(m - at) * {NUM + DEN} >= (m + least) * {NUM}").drop("least")


def _meets(named: DataFrame, seqs: DataFrame, total: int) -> DataFrame:
    """meet, key, label, other, m, at: the groups of keys that share a bucket and one of their rarest
    shingles, where they are of more classes than one.

    ``named`` has the buckets' keys with their class (``label``) and that of the bucket's leader (``top``)."""
    spark = named.sparkSession
    others = named.filter("label <> top").select("bucket", "n").distinct()
    inside = stored(join_groups(named.drop("n"), others, "bucket", "n", total)
                    .select("bucket", "key", F.xxhash64("label").alias("label"), (F.col("label") != F.col("top")).alias("other")), "mixed")
    texts = stored(seqs.join(inside.select("key").distinct(), "key"), "mixed-sequences")

    def count(it):
        with np.errstate(over="ignore"):
            seen = np.zeros(COUNTERS, np.int64)
            for pdf in frames(it):
                of = [labelled(shingles(np.frombuffer(x, np.uint32))) for x in pdf["seq"]]
                seen += np.bincount((np.concatenate(of) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bin", "c"])

    # at most one row per bin reaches the driver, whatever the input
    found = texts.mapInArrow(count, "bin long, c long").groupBy("bin").agg(F.sum("c").alias("c")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[found["bin"].to_numpy()] = found["c"].to_numpy()
    order = spark.sparkContext.broadcast(counts)

    def first(it):
        with np.errstate(over="ignore"):
            for pdf in frames(it):
                out = []
                for key, seq in zip(pdf["key"], pdf["seq"]):
                    s = shingles(np.frombuffer(seq, np.uint32))
                    out.append((key, len(s), *rarest(s, order.value)))
                yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=_RARE.names), schema=_RARE, preserve_index=False)

    rare = texts.mapInArrow(first, "key binary, m int, places array<int>, rare array<long>").filter("size(rare) > 0")
    met = (inside.join(rare, "key").select("bucket", "key", "label", "other", "m", F.explode(F.arrays_zip("places", "rare")).alias("x"))
                 .select(F.xxhash64("bucket", "x.rare").alias("meet"), "key", "label", "other", "m", F.col("x.places").alias("at")))
    return stored(_met_once(_in_reach(met)), "meets")


#: What two texts share from their first common shingle on is enough for a link.
_ENOUGH = f"least(ma - ia, mb - ib) * {NUM + DEN} >= (ma + mb) * {NUM}"


def _central(met: DataFrame) -> DataFrame:
    """One pair (a, b) for each ``other`` key: b is the centre of one of its groups, of another class."""
    centre = F.min(F.struct("other", F.col("at").alias("ib"), F.col("key").alias("b"), F.col("label").alias("lb"), F.col("m").alias("mb")))
    pairs = met.withColumn("c", centre.over(Window.partitionBy("meet"))).filter("other").select(
        F.col("key").alias("a"), F.col("label").alias("la"), F.col("m").alias("ma"), F.col("at").alias("ia"), "c.ib", "c.b", "c.lb", "c.mb")
    return pairs.filter(f"la <> lb and {_ENOUGH}").groupBy("a").agg(F.min(F.struct("ib", "b")).alias("c")).select("a", "c.b")


def _candidates(met: DataFrame, label: DataFrame, size: DataFrame) -> DataFrame:
    """Pairs (a, b) of keys of different classes (``label``) that meet and could be linked.

    In each group one of two keys of different classes is not of its centre's class."""
    of = size.select("key", "bits").join(label.withColumnRenamed("v", "key"), "key", "left").select(
        "key", "bits", F.xxhash64(F.coalesce("label", "key")).alias("label"))
    w = Window.partitionBy("meet")
    met = (met.select("meet", "key", "m", "at").join(of, "key")
              .withColumn("other", F.col("label") != F.min(F.struct("at", "key", "label")).over(w)["label"])
              .withColumn("any", F.max("other").over(w)).filter("any"))
    side = lambda k: [F.col("key").alias(k), *[F.col(c).alias(f"{c[0] if c != 'at' else 'i'}{k}") for c in ("label", "m", "at")], F.col("bits").alias(f"p{k}")]
    left, right = met.filter("other").select("meet", *side("a")), met.select("meet", *side("b"), F.col("other").alias("ob"))
    apart = " + ".join(f"bit_count(pa[{i}] ^ pb[{i}])" for i in range(BITS // 64))
    return (left.join(right, "meet").filter(f"la <> lb and (not ob or a < b) and {_ENOUGH} and ({apart}) * {NUM + DEN} <= (ma + mb) * {DEN - NUM}")
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _bounded(pairs: DataFrame, size: DataFrame) -> DataFrame:
    """The pairs whose shingle histograms allow a link."""
    side = lambda k: size.select(F.col("key").alias(k), F.col("m").alias(f"m{k}"), F.col("bins").alias(f"h{k}"))
    apart = F.aggregate(F.zip_with("ha", "hb", lambda p, q: F.abs(p.cast("int") - q.cast("int"))), F.lit(0), lambda n, d: n + d)
    return (pairs.join(side("a"), "a").join(side("b"), "b")
                 .filter(apart * (NUM + DEN) <= (F.col("ma") + F.col("mb")) * (DEN - NUM)).select("a", "b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), class_id, class_size, kept of every row."""
    rows = stored(_signatures(docs), "signatures")
    keys = rows.groupBy("key").agg(F.min(F.struct(F.isnull("doc_id").alias("n"), "doc_id", "h")).alias("rep"),
                                   *[F.first(c).alias(c) for c in ("m", "bands", "bins", "bits")])
    keys = stored(keys, "keys")
    bands = keys.select("key", F.explode("bands").alias("bucket"))
    total = keys.count() * BANDS
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(join_groups(bands, shared, "bucket", "n", total), "members")
    rank = F.struct(F.col("reach"), F.col("key"))
    reach = stored(members.groupBy("key").agg(F.sum("n").alias("reach")), "reach")
    ranked = members.join(reach, "key").withColumn("rank", rank)
    leaders = stored(ranked.groupBy("bucket").agg(F.max("rank").alias("leader"), F.count(F.lit(1)).alias("n")), "leaders")
    wanted = (reach.select("key").join(keys.select("key", "rep"), "key")
                     .select("key", F.col("rep.doc_id").alias("_d"), F.col("rep.h").alias("_h")))

    @F.pandas_udf("binary")
    def sequence(texts: pd.Series) -> pd.Series:
        return pd.Series([word_hashes(t).tobytes() for t in texts])

    t = docs.select("doc_id", whole_text().alias("text")).withColumn("h", F.xxhash64("text"))
    seqs = t.join(wanted, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")))
    seqs = stored(seqs.select("key", sequence("text").alias("seq")).dropDuplicates(["key"]), "sequences")

    first = (join_groups(members.drop("n"), leaders, "bucket", "n", total).groupBy("key").agg(F.max("leader").alias("leader"))
             .select(F.col("key").alias("a"), F.col("leader.key").alias("b")).filter("a <> b"))
    links = stored(_verified(first, seqs), "first-links")
    label = components(links)
    named = (members.join(label.withColumnRenamed("v", "key"), "key", "left")
                    .withColumn("label", F.coalesce("label", "key")))
    top = (leaders.select("bucket", F.col("leader.key").alias("key"), "n").join(label.withColumnRenamed("v", "key"), "key", "left")
                  .select("bucket", F.coalesce("label", "key").alias("top"), "n"))
    named = stored(join_groups(named.drop("n"), top, "bucket", "n", total).select("bucket", "key", "label", "top", "n"), "named")
    met = _meets(named, seqs, total)
    more = stored(_verified(_central(met), seqs), "central-links")
    label = components(links.unionByName(more))
    rest = _bounded(_candidates(met, label, keys.select("key", "bits")), keys.select("key", "m", "bins"))
    more = _verified(rest, seqs)
    between = (more.join(label.select(F.col("v").alias("a"), F.col("label").alias("la")), "a", "left")
                   .join(label.select(F.col("v").alias("b"), F.col("label").alias("lb")), "b", "left")
                   .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    joined = components(between)
    named_rows = (rows.select("doc_id", "h", "key").join(label.withColumnRenamed("v", "key"), "key", "left")
                      .withColumn("label", F.coalesce("label", "key"))
                      .join(joined.select(F.col("v").alias("label"), F.col("label").alias("_to")), "label", "left")
                      .select("doc_id", "h", F.coalesce("_to", "label").alias("label")))
    classes = named_rows.groupBy("label").agg(
        F.min(F.struct(F.isnull("doc_id").alias("n"), "doc_id", "h")).alias("rep"), F.count(F.lit(1)).alias("class_size"))
    return join_groups(named_rows, classes, "label", "class_size", rows.count()).select(
        "doc_id", "h", F.col("rep.doc_id").alias("class_id"), "class_size",
        (F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("h") == F.col("rep.h"))).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per class, with all its columns."""
    keep = near_duplicates(docs).filter("kept").select("doc_id", F.col("h").alias("key")).distinct()
    return matching_rows(docs, F.xxhash64(whole_text()), keep)
