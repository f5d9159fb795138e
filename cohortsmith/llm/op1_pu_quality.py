"""Quality classification by positive-unlabelled learning (non-negative unbiased risk).

Trusted positives are rows labelled 1; the unlabelled side is web text as it comes, whatever its
label.  With the class prior p, the risk is

    p E_pos[l(g)] + max(0, E_unl[l(-g)] - p E_pos[l(-g)])

where l is the logistic loss; where the second term turns negative the step goes up it instead
(non-negative correction).  Labels of the other class are not used.  The prior comes from the
unlabelled text itself (``prior`` overrides it): a first fit on half of the positives scores all
documents, and the prior is the least ratio, over thresholds that at least half of the other
positives exceed, of the share of documents over a threshold to that of those positives.  Rows
fitted on are left out of both shares and added to the result as the positives they are.

Features come from the whole text: shares of the byte classes, word and line repetition, word
lengths; they are computed once and stored.  Each scalar is cut at quantiles over all documents,
so the linear score is additive in step functions.  The risk is minimised over bounded samples
(``MOST_POSITIVE``, ``MOST_UNLABELLED``); cut points, prior and scores come from every text.
Defined cases: null and empty text has zero features and is scored by them; without
trusted positives the score is the prior given, else 0.5; an empty table gives an empty result; other input
columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, stored, whole_text
from .labelled import bounded, training_labels

MOST_POSITIVE, MOST_UNLABELLED = 4000, 6000
FOLDS, HELD_OUT = 4, 2
BINS = 8
#: Quantiles at which features are cut, and the inverse of their error in rank.
CUTS, ACCURACY = [0.01, 0.03, *np.linspace(0, 1, BINS + 1)[1:-1].tolist(), 0.97, 0.99], 4000
#: Thresholds a unit of the score at which the prior is sought; positives needed for two halves.
STEPS_A_UNIT, LEAST_HALF = 10, 20
STEPS, RATE, RIDGE = 500, 0.05, 2e-4


def features(text: str, packer: zstandard.ZstdCompressor) -> list[float]:
    b = text.encode("utf-8", "replace")
    h = np.bincount(np.frombuffer(b, np.uint8), minlength=256).astype(float) / max(1, len(b))
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    ends = sum(not w[-1].isalnum() for w in words) / n
    counts = Counter(words)
    common = max(counts.values(), default=0) / n
    return [
        np.log1p(len(b)), np.log1p(len(words)), len(counts) / n, len(set(lines)) / len(lines),
        float(lengths.mean()), float(lengths.std()), float(lengths.max()), ends, common,
        len(packer.compress(b)) / (len(b) + 20), len(lines) / n, float(h[128:].sum()),
        float(h[65:91].sum()), float(h[48:58].sum()), float(h[33:48].sum() + h[58:65].sum() + h[91:97].sum() + h[123:127].sum()),
        *h[32:65], *h[91:97], *h[123:127]]


def matrix(texts) -> np.ndarray:
    packer = zstandard.ZstdCompressor(level=1)
    rows = [features(t, packer) for t in texts]
    return np.array(rows, np.float32) if rows else np.zeros((0, 58), np.float32)


def design(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """One indicator for each scalar being over each of its cut points."""
    return np.concatenate([x[:, [j]] > e[None, :] for j, e in enumerate(edges) if len(e)], axis=1).astype(np.float32)


def described(docs: DataFrame) -> DataFrame:
    """doc_id and the features x of every text, stored."""
    @F.pandas_udf("array<float>")
    def rows(texts: pd.Series) -> pd.Series:
        return pd.Series(list(matrix(texts)))

    return stored(docs.select("doc_id", rows(whole_text()).alias("x")), "quality-features")


def cut_points(rows: DataFrame) -> list[np.ndarray]:
    """The distinct values of each feature at ``CUTS`` over all rows."""
    width = len(features("", zstandard.ZstdCompressor(level=1)))
    got = rows.agg(*[F.percentile_approx(F.col("x")[j], CUTS, ACCURACY).alias(f"q{j}") for j in range(width)]).first()
    return [np.unique(np.array(q if q is not None else [], np.float32)) for q in got]


def nn_pu(pos: np.ndarray, unl: np.ndarray, prior: float) -> np.ndarray:
    """Weights (last: constant) of the linear score with least non-negative risk, by Adam."""
    pos, unl = (np.column_stack([a, np.ones(len(a), np.float32)]) for a in (pos, unl))
    w, m, v = (np.zeros(pos.shape[1], np.float32) for _ in range(3))
    w[-1] = np.log(prior / (1 - prior))
    for t in range(1, STEPS + 1):
        sp, su = (1 / (1 + np.exp(-np.clip(a @ w, -30, 30))) for a in (pos, unl))
        # gradients: l(g) = log(1 + e^-g) has slope s - 1, l(-g) has slope s
        g_pos, g_neg_pos, g_unl = pos.T @ (sp - 1) / len(pos), pos.T @ sp / len(pos), unl.T @ su / len(unl)
        rest = prior * np.log1p(-np.minimum(sp, 0.999999)).mean() - np.log1p(-np.minimum(su, 0.999999)).mean()
        g = prior * g_pos + (g_unl - prior * g_neg_pos) if rest >= 0 else -(g_unl - prior * g_neg_pos)
        g = (g + RIDGE * np.append(w[:-1], 0)).astype(np.float32)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = (w - RATE * (1 - 0.9 * t / STEPS) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return w


def least_ratio(positive: np.ndarray, every: np.ndarray) -> float:
    """The class prior from counts of positives and of all rows by ascending score bin."""
    p, u = (np.cumsum(c[::-1])[::-1] / max(1, c.sum()) for c in (positive, every))
    return float(np.clip((u[p >= 0.5] / p[p >= 0.5]).min(initial=0.99), 0.01, 0.99))


def estimated_prior(rows: DataFrame, positives: DataFrame, pos: np.ndarray, half: np.ndarray, unl: np.ndarray, edges: list[np.ndarray]) -> float:
    """The prior by scores of all rows; ``positives`` holds the trusted ids, ``fitted`` those fitted on."""
    w = nn_pu(design(pos[half], edges), design(unl, edges), 0.5)
    reach = 30 * STEPS_A_UNIT

    @F.pandas_udf("int")
    def place(x: pd.Series) -> pd.Series:
        g = design(np.array(x.tolist(), np.float32), edges) @ w[:-1] + w[-1]
        return pd.Series(np.clip(np.floor(g * STEPS_A_UNIT), -reach, reach - 1).astype(np.int32) + reach)

    met = rows.join(F.broadcast(positives), "doc_id", "left").select(place("x").alias("bin"), "fitted")
    counts = met.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.count_if("fitted").alias("a"), F.count_if(~F.col("fitted")).alias("p")).collect()
    positive, every, n_fitted = np.zeros(2 * reach), np.zeros(2 * reach), 0
    for r in counts:
        positive[r["bin"]], every[r["bin"]] = r["p"], r["n"] - r["a"]
        n_fitted += r["a"]
    if not positive.sum():  # too few positives for two halves
        return 0.5
    n = every.sum()
    return float(np.clip((least_ratio(positive, every) * n + n_fitted) / (n + n_fitted), 0.01, 0.99))


def fit(rows: DataFrame, labels: DataFrame, prior: float | None = None) -> dict:
    """A small model from the stored features of all documents (``described``)."""
    train = stored(training_labels(labels, "quality", FOLDS, HELD_OUT), "quality-labels")
    unknown = 0.5 if prior is None else prior
    positive = bounded(train, F.col("y") == 1, MOST_POSITIVE).select("doc_id", F.lit(True).alias("p"))
    ids = rows.select("doc_id").dropna().distinct()
    unlabelled = bounded(ids, fold("doc_id", FOLDS) != HELD_OUT, MOST_UNLABELLED).select("doc_id", F.lit(False).alias("p"))
    wanted = positive.unionByName(unlabelled).groupBy("doc_id").agg(F.collect_set("p").alias("p"))
    # bounded: at most MOST_POSITIVE + MOST_UNLABELLED ids, 58 numbers each, reach the driver
    got = rows.join(F.broadcast(wanted), "doc_id").select("doc_id", "p", "x").orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id", "x").toPandas()
    known, other = got["p"].map(lambda p: True in p).to_numpy(bool), got["p"].map(lambda p: False in p).to_numpy(bool)
    if not known.any() or not other.any():
        return {"constant": unknown}
    x = np.array(got["x"].tolist(), np.float32)
    pos, unl, edges = x[known], x[other], cut_points(rows)
    if prior is None:
        pos_ids = got.loc[known, "doc_id"]
        codes = pd.factorize(pos_ids)[0]  # an id's rows are in one half
        half = codes % 2 == 0 if codes.max() + 1 >= 2 * LEAST_HALF else np.ones(len(codes), bool)
        held = rows.sparkSession.createDataFrame(sorted({(int(i), bool(h)) for i, h in zip(pos_ids, half)}), "doc_id long, fitted boolean")
        prior = estimated_prior(rows, held, pos, half, unl, edges)
    return {"edges": edges, "w": nn_pu(design(pos, edges), design(unl, edges), prior), "prior": prior}


def scorer(model: dict):
    """A column function: stored features to the probability of good quality."""
    if "constant" in model:
        return lambda x: F.lit(model["constant"])
    edges, w = model["edges"], model["w"]

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        g = design(np.array(x.tolist(), np.float32), edges) @ w[:-1] + w[-1]
        return pd.Series(1 / (1 + np.exp(-np.clip(g, -30, 30))), dtype=float)

    return score


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, prior: float | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    rows = described(docs)
    out = rows.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), scorer(fit(rows, labels, prior))("x").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
