"""Mixing sources to target weights by cube-method balanced sampling.

Each source gets a target share of all words; its documents are taken target / size times.  The
whole part is taken outright; the fractional part is the inclusion probability of a sample that
the cube method draws: the probabilities move through the null space of the balancing
constraints (sum of words, number of documents) until each is 0 or 1, so both totals of every
source are kept exactly while it moves.  Three undecided documents always leave a direction in
that null space, (s3 - s2, s1 - s3, s2 - s1) for their sizes s, so a block of any number of
documents ends with at most two undecided.

Flight runs in blocks of about ``BLOCK`` documents of one source, dealt by a hash of the row, so
a hot source is many blocks.  What the blocks leave undecided is dealt into blocks again, until
each source has one; there the last one or two undecided documents and ten decided ones of a
source are landed together on the choice whose words come nearest.  Steps are drawn from a generator seeded by source, level and block, and
documents go in a fixed order, so reruns agree.

Defined cases: null text has size 0 and takes 0 words; a null source is a source, ordered last;
a source of no words has target 0; an empty table gives an empty result; repeated rows are
drawn each on its own; other input columns are not read.
"""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import matching_rows, stored, whole_text

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 2000
EPS = 1e-9
LANDED = 12  #: documents of a source's last block that the landing decides together
WEIGHTS = (1, 2, 3)
MOST_TIMES = 3


def targets(sizes: dict, weights=WEIGHTS, most: int = MOST_TIMES) -> dict:
    """Words each source is to give.  Sources by code point, null last, weigh ``weights`` in turn;
    a target stops at ``most`` times its source and the excess is shared again by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out, free = sum(sizes.values()), {}, list(order)
    while free:
        rest, by = total - sum(out.values()), sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / by > most * sizes[s]]
        if not over:
            return out | {s: rest * weight[s] / by for s in free}
        out |= {s: float(most * sizes[s]) for s in over}
        free = [s for s in free if s not in out]
    return out


def flight(prob: list[float], size: list[int], rng: random.Random) -> list[float]:
    """``prob`` moved until all but two at most are 0 or 1; sum and size-weighted sum stay."""
    prob, open_ = list(prob), []
    for i in range(len(prob)):
        if EPS < prob[i] < 1 - EPS:
            open_.append(i)
        if len(open_) == 3:
            a, b, c = open_
            u = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
            if u == (0, 0, 0):
                u = (1, -1, 0)
            up = min(((1 - prob[k]) / d if d > 0 else prob[k] / -d) for k, d in zip(open_, u) if d)
            down = min((prob[k] / d if d > 0 else (1 - prob[k]) / -d) for k, d in zip(open_, u) if d)
            step = up if rng.random() * (up + down) < down else -down
            for k, d in zip(open_, u):
                p = prob[k] + step * d
                prob[k] = 0.0 if p <= EPS else 1.0 if p >= 1 - EPS else p
            open_ = [k for k in open_ if 0 < prob[k] < 1]
    return prob


def landing(prob: list[float], size: list[int], off: float = 0.0, spare=()) -> list[float]:
    """The at most two undecided set to 0 or 1 so that the words come nearest (``off``: words so
    far above the target), together with documents of ``spare``, already decided, that may be decided
    anew: ``LANDED`` in all, every choice of which is tried.  Ties go to the nearer number of
    documents, then to fewer changed decisions."""
    open_ = [i for i, p in enumerate(prob) if EPS < p < 1 - EPS]
    taken = set(open_)
    out = [p if i in taken else float(round(p)) for i, p in enumerate(prob)]
    free = open_ + [i for i in spare if i not in taken][:max(0, LANDED - len(open_))]
    choice = (np.arange(1 << len(free))[:, None] >> np.arange(len(free))) & 1
    moved = choice - np.array([out[i] for i in free])
    words = np.abs(off + moved @ np.array([size[i] for i in free], float)).round(6)
    changed = (moved[:, len(open_):] != 0).sum(axis=1)
    best = np.lexsort((np.arange(len(choice)), changed, np.abs(moved.sum(axis=1)).round(6), words))[0]
    for i, x in zip(free, choice[best]):
        out[i] = float(x)
    return out


def _level(rows: DataFrame, level: int, last: bool) -> DataFrame:
    """One flight over blocks (source, _block); the last level also lands."""
    cols = [f.name for f in rows.schema.fields]

    def fly(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_h", "doc_id", "size"], kind="stable", na_position="first")
        seed = f"{pdf['source'].iloc[0]}/{level}/{pdf['_block'].iloc[0]}"
        size = [int(x) for x in pdf["size"]]
        start = pdf["_p"].tolist()
        prob = flight(start, size, random.Random(zlib.crc32(seed.encode())))
        spare = [i for i in reversed(range(len(start))) if EPS < start[i] < 1 - EPS][:LANDED]
        pdf["_p"] = landing(prob, size, spare=spare) if last else prob
        return pdf[cols]

    return rows.groupBy("source", "_block").applyInPandas(fly, rows.schema)


def mix_sources(docs: DataFrame, weights=WEIGHTS, most: int = MOST_TIMES, block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target, times, taken, h (hash of id and text) of every
    document."""
    spark = docs.sparkSession
    sized = stored(docs.select("doc_id", F.col("source").cast("string").alias("source"),
                               F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size"),
                               F.xxhash64("doc_id", whole_text()).alias("_h")), "sized")
    # one row per source reaches the driver: the table of the mixture
    per = {r["source"]: r for r in sized.groupBy("source").agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("n")).collect()}
    target = targets({s: int(r["w"]) for s, r in per.items()}, weights, most)
    plan = [(s, int(r["w"]), float(target[s]), target[s] / r["w"] if r["w"] else 0.0, max(1, math.ceil(r["n"] / block)))
            for s, r in per.items()]
    shares = spark.createDataFrame(plan, "_s string, source_size long, target double, _times double, _blocks long")
    rows = sized.join(F.broadcast(shares), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    whole = F.floor(F.col("_times") + EPS)
    rows = rows.withColumn("_whole", whole.cast("long")).withColumn("_p", F.greatest(F.col("_times") - whole, F.lit(0.0)))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_h", F.lit(0)), F.col("_blocks"))).drop("_times")
    most_blocks, level, decided = max([1, *(p[4] for p in plan)]), 0, None
    undecided = (F.col("_p") > EPS) & (F.col("_p") < 1 - EPS)
    while True:
        last = most_blocks == 1
        rows = _level(rows, level, last)
        if last:
            decided = rows if decided is None else decided.unionByName(rows)
            break
        rows = stored(rows, f"flight{level}")
        done = rows.filter(~undecided)
        decided = done if decided is None else decided.unionByName(done)
        # at most two rows of each block go on, to blocks of ``block`` rows again
        level, most_blocks = level + 1, math.ceil(2 * most_blocks / block)
        rows = rows.filter(undecided).withColumn("_blocks", F.ceil(2 * F.col("_blocks") / block).cast("long"))
        rows = rows.withColumn("_block", F.pmod(F.xxhash64("_h", F.lit(level)), F.col("_blocks")))
    times = F.col("_whole") + F.round("_p").cast("long")
    return decided.select("doc_id", "source", "size", "source_size", "target",
                          times.alias("times"), (times * F.col("size")).alias("taken"), F.col("_h").alias("h"))


def mixed(docs: DataFrame, weights=WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns."""
    take = (mix_sources(docs, weights, most).groupBy("doc_id", F.col("h").alias("key"))
            .agg(F.sum("times").alias("times")).filter("times > 0"))
    return matching_rows(docs, F.xxhash64("doc_id", whole_text()), take)
