r"""Document fingerprints by a homomorphic multiset hash, in DataFrame functions only.

A paragraph (a line; a text has one more than it has line feeds) hashes to a wide vector, and a
document's fingerprint is the sum of its paragraphs' vectors, lane by lane, modulo a power of
two.  So the order of paragraphs does not matter, and inserting or deleting a paragraph is adding
or subtracting its vector (``plus``, ``minus``).  The vector has two parts:

* 6 lanes modulo 2^40, cut from the paragraph's SHA-256: they settle equality;
* 64 counts (kept two to a lane, 32 lanes modulo 2^62) of the set bits in the 64-bit hashes of
  all words of the paragraph, and the number of those words; a paragraph that is not empty and has
  no word counts as one.  Counts minus their mean are a random projection of the word multiset, so
  the cosine of two documents' counts estimates how much of it they share (``likeness``, noise
  about 0.1).

Words are counted in stretches of ``STRETCH``, eight counts to a long, whose sums go to the lanes.

Defined cases: null text counts as empty (one empty paragraph); equal fingerprints have likeness
1; a text of line feeds only has likeness 0 to all others; null ids come first and ties go by a
hash of the text; the next document of a single row is itself; an empty table gives an empty
result; other input columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import whole_text

STRONG, STRONG_BITS = 6, 40
LANES, FIELD = 32, 31
WRAP = (1 << 2 * FIELD) - 1
BYTES = 0x0101010101010101
STRETCH = 127
WORD = r"[\p{L}\p{N}]"


def _longs(values) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _byte(sums: Column, bit: Column) -> Column:
    return F.call_function("shiftright", F.get(sums, bit % 8), (bit - bit % 8).cast("int")).bitwiseAND(255)


def vector(text: Column) -> Column:
    """struct(strong, counts, words): the sum of the vectors of the text's paragraphs."""
    digests = F.transform(F.split(text, "\n", -1), lambda p: F.sha2(p, 256))
    digits = STRONG_BITS // 4
    strong = F.aggregate(digests, _longs([0] * STRONG), lambda acc, d: F.transform(acc, lambda a, j: (
        a + F.conv(F.substring(d, (j * digits + 1).cast("int"), F.lit(digits)), 16, 10).cast("long")
    ).bitwiseAND((1 << STRONG_BITS) - 1)))
    words = F.concat(F.filter(F.split(text, r"[^\p{L}\p{N}]+", -1), lambda w: w != ""),
                     F.filter(F.split(text, "\n", -1), lambda p: (p != "") & ~p.rlike(WORD)))
    # in arrays of one, so that the hashes are made once and not for every stretch; no column is
    # named inside a lambda, where an alias of the same name would be taken for it
    made = F.array(F.struct(strong.alias("strong"), F.transform(words, lambda w: F.xxhash64(w)).alias("hashes")))
    # bit 8 f + k of the hashes is counted in byte f of the k-th sum
    summed = F.transform(made, lambda m: F.struct(
        m["strong"].alias("strong"), F.size(m["hashes"]).cast("long").alias("words"),
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(m["hashes"]), F.lit(1)), F.lit(STRETCH)), lambda i: F.aggregate(
            F.slice(m["hashes"], i, STRETCH), _longs([0] * 8), lambda acc, h: F.transform(
                acc, lambda a, k: a + F.call_function("shiftright", h, k).bitwiseAND(BYTES)))).alias("sums")))
    # lane j holds the counts of bits j and j + 32
    return F.element_at(F.transform(summed, lambda m: F.struct(m["strong"].alias("strong"), F.aggregate(
        m["sums"], _longs([0] * LANES), lambda acc, s: F.transform(acc, lambda a, j: (
            a + _byte(s, j) + F.shiftleft(_byte(s, j + LANES), FIELD)).bitwiseAND(WRAP))).alias("counts"), m["words"].alias("words"))), 1)


def _with(a: Column, b: Column, sign: int) -> Column:
    def lanes(name, mask):
        return F.zip_with(a[name], b[name], lambda x, y: (x + sign * y).bitwiseAND(mask)).alias(name)
    return F.struct(lanes("strong", (1 << STRONG_BITS) - 1), lanes("counts", WRAP),
                    (a["words"] + sign * b["words"]).alias("words"))


def plus(a: Column, b: Column) -> Column:
    """The vector of both documents' paragraphs together (insertion)."""
    return _with(a, b, 1)


def minus(a: Column, b: Column) -> Column:
    """The vector of ``a`` without the paragraphs of ``b`` (deletion)."""
    return _with(a, b, -1)


def fingerprint(v: Column) -> Column:
    strong = F.array_join(F.transform(v["strong"], lambda x: F.lpad(F.hex(x), STRONG_BITS // 4, "0")), "")
    counts = F.array_join(F.transform(v["counts"], lambda x: F.lpad(F.hex(x), 16, "0")), "")
    return F.lower(F.concat_ws("-", strong, F.hex(v["words"]), counts))


def _centred(v: Column) -> Column:
    fields = F.flatten(F.transform(v["counts"], lambda x: F.array(*[
        F.shiftright(x, FIELD * f).bitwiseAND((1 << FIELD) - 1) for f in range(2)])))
    return F.transform(fields, lambda c: (2 * c - v["words"]).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of the centred counts, 1 for equal vectors."""
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    x, y = _centred(a), _centred(b)
    norm = F.sqrt(dot(x, x) * dot(y, y))
    return (F.when(a == b, F.lit(1.0)).when(norm > 0, F.least(F.greatest(dot(x, y) / norm, F.lit(0.0)), F.lit(1.0)))
            .otherwise(F.lit(0.0)))


def _bucket(key: Column, bounds: list[int], strict: bool) -> Column:
    """How many of the ascending ``bounds`` are at most (``strict``: below) ``key``, in two steps
    of the square root of their number."""
    if not bounds:
        return F.lit(0)
    below = (lambda x: x < key) if strict else (lambda x: x <= key)
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    k = F.size(F.filter(_longs([g[0] for g in groups]), below))
    within = F.size(F.filter(F.element_at(F.array(*[_longs(g) for g in groups]), F.greatest(k, F.lit(1))), below))
    return F.when(k == 0, F.lit(0)).otherwise((k - 1) * step + within)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and the next document's text by ascending id (after the last: the first).

    Documents are dealt into id ranges whose bounds are ids themselves, so the first row of a
    range is known beforehand and also goes to the end of the range before it: one exchange of
    the texts, no global window.  The bounds, one per shuffle partition, are all the driver sees."""
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)).cast("long"))
    t = docs.select("doc_id", key.alias("_k"), whole_text().alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = t.agg(F.min("_k").alias("least"), F.percentile_approx("_k", [i / n for i in range(1, n)] or [0.5], max(10_000, 20 * n)).alias("b")).first()
    bounds = sorted(set(cuts["b"] or []) - {cuts["least"]})
    own, before = _bucket(F.col("_k"), bounds, False), _bucket(F.col("_k"), bounds, True)
    t = t.withColumn("_own", own).withColumn("_before", before)
    to = F.concat(F.array(F.struct(F.col("_own").alias("b"), F.lit(0).alias("end"))),
                  F.when(F.col("_k") == F.lit(cuts["least"]), F.array(F.struct(F.lit(len(bounds)).alias("b"), F.lit(1).alias("end"))))
                   .when(F.col("_own") != F.col("_before"), F.array(F.struct(F.col("_before").alias("b"), F.lit(1).alias("end"))))
                   .otherwise(F.array().cast("array<struct<b:int,end:int>>")))
    dealt = t.select("doc_id", "_k", "text", F.explode(to).alias("_to"))
    w = Window.partitionBy("_to.b").orderBy("_to.end", "_k", F.xxhash64("text"), F.crc32(F.col("text").cast("binary")))
    return dealt.withColumn("next_text", F.lead("text").over(w)).filter("_to.end = 0").select("doc_id", "text", "next_text")


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    half = F.expr("n_chars div 2")
    d = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    d = d.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                                        F.substring("next_text", F.lit(1), half.cast("int"))))
    d = d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), vector(F.col("text")).alias("v"),
                 vector(F.col("edited")).alias("e"), vector(F.col("next_text")).alias("x"))
    return d.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("v")).alias("fingerprint"),
                    fingerprint(F.col("e")).alias("edited_fingerprint"),
                    likeness(F.col("v"), F.col("e")).alias("near_edited"),
                    likeness(F.col("v"), F.col("x")).alias("near_next"))
