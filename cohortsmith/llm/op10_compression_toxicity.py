"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

Fitting, on a bounded sample of labelled rows (``MOST_TOXIC``, ``MOST_ORDINARY``):

1. copies and near copies in the sample count once (one row per class and least hash of the
   three-word runs); byte 6-grams are counted by document in both classes (a Spark aggregate).
   Those that toxic documents hold more often than their share of all grams explains (binomial
   tail), at a false-discovery rate of ``FALSE_DISCOVERIES`` over all grams tested, mark the runs
   of text that set the class apart; the cut follows the size of the sample;
2. the ordinary dictionary holds the commonest words of ordinary documents; the toxic dictionary
   holds the same behind the commonest marked runs of toxic documents, so both compress plain
   prose alike and differ where text reads like the toxic class.  ``RUN_BYTES`` and ``WORD_BYTES``
   are the sizes of the two parts;
3. a document's windows, of three sizes, are compressed with both; the bytes that the toxic
   dictionary saves, in all by length, at most in a window, and shrunk by length, are calibrated
   to a probability by logistic regression on the sample, weighted to the class shares of all
   training labels.

Scoring compresses every window of every whole text.  Defined cases: null and empty text has no
window and scores as text that saves nothing; with no label of one class the score is constant;
an empty table gives an empty result; other input columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frames, stored, whole_text
from .labelled import bounded, class_counts, training_labels

GRAM = 6
WINDOWS = (256, 1024, 4096)
FALSE_DISCOVERIES = 0.05
MOST_TOXIC, MOST_ORDINARY = 3000, 6000
RUN_BYTES, WORD_BYTES = 8192, 2048
SHINGLE = 3
FOLDS, HELD_OUT = 5, 0
#: Lower-cased bytes: ASCII letters and all bytes of longer characters stay, the rest are blanks.
PLAIN = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def plain(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "replace").translate(PLAIN) + b" "


def grams(b: bytes) -> np.ndarray:
    """The 6-grams at each place as integers; 0 where a blank stands inside."""
    a = np.frombuffer(b, np.uint8)
    n = len(a) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out, inner = np.zeros(n, np.int64), np.zeros(n, bool)
    for k in range(GRAM):
        out = (out << 8) | a[k:n + k]
        if 0 < k < GRAM - 1:
            inner |= a[k:n + k] == 32
    out[inner] = 0
    return out


def runs(b: bytes, marked: np.ndarray) -> set[bytes]:
    """The maximal stretches of words that marked grams (sorted) cover, cut at blanks."""
    g = grams(b)
    if not len(g) or not len(marked):
        return set()
    at = np.flatnonzero(marked[np.minimum(np.searchsorted(marked, g), len(marked) - 1)] == g)
    cover = np.zeros(len(b) + 2, np.int8)
    for k in range(GRAM):
        cover[at + k + 1] = 1
    edge = np.flatnonzero(np.diff(cover))
    out = set()
    for start, end in zip(edge[::2], edge[1::2]):
        out.update(m.group() for m in re.finditer(rb" ?[^ ]+ ?", b[start:end]) if len(m.group()) >= GRAM)
    return out


def signature(text: str) -> int:
    """The least hash of the runs of three words: near copies mostly share it."""
    words = plain(text).split()
    return min((xxhash.xxh3_64_intdigest(b" ".join(words[i:i + SHINGLE])) >> 1 for i in range(len(words) - SHINGLE + 1)),
               default=xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) >> 1)


def upper_tails(pairs: np.ndarray, share: float) -> np.ndarray:
    """P(X >= n1) of X ~ Binomial(n1 + n0, share) for each pair (n1, n0)."""
    top = int(pairs.sum(axis=1).max(initial=0))
    log_factorial = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, top + 1)))])
    out = np.empty(len(pairs))
    for i, (n1, n0) in enumerate(pairs):
        k, j = n1 + n0, np.arange(n1, n1 + n0 + 1)
        out[i] = np.exp(log_factorial[k] - log_factorial[j] - log_factorial[k - j]
                        + j * np.log(share) + (k - j) * np.log1p(-share)).sum()
    return np.minimum(out, 1.0)


def discoveries(pairs: np.ndarray, grams_: np.ndarray, share: float, rate: float) -> np.ndarray:
    """Which pairs (n1, n0), held by so many grams each, pass at this false-discovery rate
    (step-up over all grams)."""
    p = upper_tails(pairs, share)
    order = np.argsort(p, kind="stable")
    passed = p[order] <= rate * np.cumsum(grams_[order]) / max(1, grams_.sum())
    return p <= (p[order][passed].max() if passed.any() else -1.0)


def first_bytes(ordered: list[bytes], size: int) -> list[bytes]:
    """As many of the first strings as ``size`` bytes hold, a separator each."""
    total = np.cumsum([len(s) + 1 for s in ordered])
    return ordered[:int(np.searchsorted(total, size, "right"))]


def dictionary(runs_: list[bytes], words: list[bytes]) -> bytes:
    """Most common last, where references to it are shortest; words stand at the very end."""
    kept: list[bytes] = []
    for r in runs_:
        if not any(r in k for k in kept):
            kept.append(r)
    return b"\x01".join([*reversed(kept), b" " + b" ".join(reversed(words)) + b" "])


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    p = zstandard.ZstdCompressionParameters(
        window_log=14, hash_log=14, chain_log=14, search_log=5, min_match=GRAM, target_length=32,
        strategy=zstandard.STRATEGY_LAZY2, write_checksum=0, write_content_size=0, write_dict_id=0)
    return zstandard.ZstdCompressor(compression_params=p, dict_data=zstandard.ZstdCompressionDict(
        content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))


def windows(b: bytes, size: int) -> list[bytes]:
    """Stretches of up to ``size`` bytes, cut at blanks where there are any."""
    out, i = [], 0
    while i < len(b):
        end = i + size
        if end < len(b):
            at = b.rfind(b" ", i + 1, end)
            end = at if at > i else end
        out.append(b[i:end])
        i = end
    return out


def saved(b: bytes, ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> list[float]:
    """Bytes the toxic dictionary saves, by window size: per 1000 bytes, most in a window, per
    1000 bytes shrunk."""
    if len(b) <= 2:
        return [0.0] * (3 * len(WINDOWS))
    out = []
    for size in WINDOWS:
        w = windows(b, size)
        less = [len(x) - len(y) for x, y in zip(ordinary.multi_compress_to_buffer(w), toxic.multi_compress_to_buffer(w))]
        total = sum(less)
        out += [1000 * total / len(b), float(max(less)), 1000 * total / (len(b) + 2000)]
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (last: constant) by Newton's method, a unit normal prior on each (x standardised)."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        r = weight * p * (1 - p) + 1e-9
        step = np.linalg.solve((x * r[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def clipped(x: np.ndarray) -> np.ndarray:
    """Features as the regression takes them: within bounds that no single document can leave."""
    return np.clip(x.reshape(-1, 3 * len(WINDOWS)), np.tile([-20, -10, -20], len(WINDOWS)), np.tile([40, 60, 40], len(WINDOWS)))


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """A small model: two dictionaries and the calibration."""
    train = stored(training_labels(labels, "toxic", FOLDS, HELD_OUT), "toxic-labels")
    n = class_counts(train)
    if not n.get(1) or not n.get(0):
        return {"constant": 1.0 if n.get(1) else 0.0}
    sample = bounded(train, F.col("y") == 1, MOST_TOXIC).unionByName(bounded(train, F.col("y") != 1, MOST_ORDINARY))
    texts = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(sample), "doc_id")
    texts = texts.select("y", _signature()("text").alias("sig"), F.struct("doc_id", "text").alias("row"))
    texts = stored(texts.groupBy("sig", "y").agg(F.min("row").alias("row")).select("y", "row.*"), "toxic-sample")
    size = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return {"constant": 1.0 if n1 else 0.0}

    def count(it):
        for pdf in frames(it):
            parts = []
            for y in (1, 0):
                g = [np.unique(grams(plain(t))) for t in pdf.loc[pdf["y"] == y, "text"]]
                u, c = np.unique(np.concatenate(g), return_counts=True) if g else (np.zeros(0, np.int64), np.zeros(0, int))
                parts.append(pd.DataFrame({"g": u, "n1": c if y else 0, "n0": 0 if y else c}))
            out = pd.concat(parts)
            yield _batch(out[out["g"] != 0])

    per = stored(texts.mapInArrow(count, "g long, n1 long, n0 long").groupBy("g").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), "toxic-grams")
    total = per.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).first()
    if not total["n1"] or not total["n0"]:
        return {"constant": n[1] / (n[1] + n[0])}
    tested = per.filter("n1 > 1")
    pairs = tested.groupBy("n1", "n0").agg(F.count(F.lit(1)).alias("grams")).orderBy("n1", "n0").toPandas()  # of a bounded sample
    found = pairs[discoveries(pairs[["n1", "n0"]].to_numpy(np.int64), pairs["grams"].to_numpy(np.int64),
                              total["n1"] / (total["n1"] + total["n0"]), FALSE_DISCOVERIES)]
    held = texts.sparkSession.createDataFrame([(int(a), int(b)) for a, b in zip(found["n1"], found["n0"])], "n1 long, n0 long")
    marked = np.sort(np.array([r["g"] for r in tested.join(held, ["n1", "n0"]).select("g").collect()], np.int64))

    def pieces(it):
        for pdf in frames(it):
            found: dict[tuple[int, bytes], int] = {}
            for y, t in zip(pdf["y"], pdf["text"]):
                b = plain(t)
                for s in (runs(b, marked) if y == 1 else {w for w in b.split() if len(w) >= 4}):
                    found[int(y), s] = found.get((int(y), s), 0) + 1
            yield _batch(pd.DataFrame([(y, s, k) for (y, s), k in found.items()], columns=["y", "s", "k"]).astype({"y": "int32", "k": "int64"}))

    counted = texts.mapInArrow(pieces, "y int, s binary, k long").groupBy("y", "s").agg(F.sum("k").alias("k")).filter("k > 1")
    first = lambda y, m: first_bytes([bytes(r["s"]) for r in counted.filter(F.col("y") == y).orderBy(F.desc("k"), "s").limit(m).collect()], m)
    toxic_runs, words = first(1, RUN_BYTES), first(0, WORD_BYTES)
    model = {"ordinary": dictionary([], words), "toxic": dictionary(toxic_runs, words)}
    rows = texts.select("y", _features(model)("text").alias("f")).collect()
    x, y = clipped(np.array([r["f"] for r in rows], float)), np.array([r["y"] for r in rows], float)
    weight = np.where(y == 1, n[1] / n1, n[0] / n0) * len(y) / (n[1] + n[0])
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    w = logistic((x - mean) / spread, y, weight)
    slope = w[:-1] / spread
    return model | {"w": np.append(slope, w[-1] - slope @ mean)}


def _batch(pdf: pd.DataFrame):
    import pyarrow as pa
    return pa.RecordBatch.from_pandas(pdf, preserve_index=False)


def _signature():
    @F.pandas_udf("long")
    def signatures(texts: pd.Series) -> pd.Series:
        return texts.map(signature)

    return signatures


def _features(model: dict):
    ordinary, toxic = model["ordinary"], model["toxic"]

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        o, t = compressor(ordinary), compressor(toxic)
        return pd.Series([saved(plain(x), o, t) for x in texts])

    return features


def scorer(model: dict):
    """A column function: text to the probability of the toxic class."""
    if "constant" in model:
        return lambda text: F.lit(model["constant"])
    ordinary, toxic, w = model["ordinary"], model["toxic"], model["w"]

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        o, t = compressor(ordinary), compressor(toxic)
        x = clipped(np.array([saved(plain(x), o, t) for x in texts], float))
        return pd.Series(1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30))))

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    from .common import fold
    score = scorer(fit(docs, labels))
    out = docs.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), score(whole_text()).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic, with all their columns."""
    return docs.filter(scorer(fit(docs, labels))(whole_text()) < threshold)
