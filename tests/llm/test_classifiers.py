"""The classifiers' parts against plain versions, and their recall on held-out documents."""

import math

import numpy as np
import pytest
import zstandard

from cohortsmith.llm import op1_pu_quality as op1
from cohortsmith.llm import op10_compression_toxicity as op10
from cohortsmith.llm import queries
from cohortsmith.llm.common import read


def test_upper_tails_equal_binomial_sums():
    pairs = np.array([(2, 0), (3, 9), (0, 4), (7, 1), (40, 160)])
    for share in (0.03, 0.4):
        plain = [sum(math.comb(a + b, j) * share**j * (1 - share)**(a + b - j) for j in range(a, a + b + 1)) for a, b in pairs.tolist()]
        assert np.allclose(op10.upper_tails(pairs, share), plain)
    assert len(op10.upper_tails(pairs[:0], 0.1)) == 0


def test_discoveries_step_up_over_all_grams():
    pairs, grams = np.array([(2, 0), (4, 0), (2, 5), (9, 0), (2, 40)]), np.array([40, 3, 500, 2, 300])
    p = sorted((x, k) for x, n, k in zip(op10.upper_tails(pairs, 0.1), grams, range(5)) for _ in range(n))
    last = max((i for i, (x, _) in enumerate(p, 1) if x <= 0.05 * i / len(p)), default=0)
    wanted = {k for _, k in p[:last]}
    assert set(np.flatnonzero(op10.discoveries(pairs, grams, 0.1, 0.05)).tolist()) == wanted == {1, 3}
    assert not op10.discoveries(pairs[:0], grams[:0], 0.1, 0.05).any()
    assert not op10.discoveries(pairs[4:], grams[4:], 0.1, 0.05).any()


def test_signature_of_near_copies_and_short_texts():
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    same = sum(op10.signature(" ".join(words)) == op10.signature(" ".join(words[:k] + ["other"] + words[k + 1:])) for k in range(0, 300, 10))
    assert same >= 28
    assert op10.signature("A b, c!") == op10.signature("a B c") != op10.signature("a b d")
    assert op10.signature("") == op10.signature("") != op10.signature("x")


def test_saved_bytes_are_those_of_single_windows():
    ordinary, toxic = op10.dictionary([], [b"plain", b"words"]), op10.dictionary([b" scumbags ", b" rubbish "], [b"plain", b"words"])
    text = op10.plain("plain words and scumbags, rubbish and more plain words " * 40)
    size = [[len(op10.compressor(d).compress(w)) for w in op10.windows(text, 256)] for d in (ordinary, toxic)]
    less = [a - b for a, b in zip(*size)]
    got = op10.saved(text, op10.compressor(ordinary), op10.compressor(toxic))
    assert got[:3] == [1000 * sum(less) / len(text), max(less), 1000 * sum(less) / (len(text) + 2000)] and max(less) > 0
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(toxic, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
    for w in op10.windows(text, 1024):
        assert d.decompress(op10.compressor(toxic).compress(w), max_output_size=len(w)) == w
    assert b"".join(op10.windows(text, 256)) == text


@pytest.mark.parametrize(("sf", "recall"), [("sf0.01", 0.5), ("sf0.1", 0.55)])
def test_toxic_recall_and_clean_documents(spark, sf, recall):
    path = f"/root/testdata/{sf}"
    d = queries.QUERIES["op10_compression_toxicity"](spark, path).filter("held_out").join(read(spark, path, "labels"), "doc_id").toPandas()
    caught, flagged = (d.loc[d["toxic"] == 1, "predicted"].mean(), d.loc[d["toxic"] == 0, "predicted"].mean())
    print(sf, "caught", caught, "flagged", flagged)
    assert caught >= recall and flagged <= 0.02


def test_least_ratio_finds_the_share_of_positives():
    rng = np.random.default_rng(2)
    for share in (0.1, 0.4, 0.8):
        place = lambda x: np.bincount(np.clip(x * 10 + 300, 0, 599).astype(int), minlength=600)
        good, bad = rng.normal(4, 1, 20_000), rng.normal(-4, 1, 20_000)
        n = int(20_000 * share)
        assert abs(op1.least_ratio(place(good), place(np.append(rng.normal(4, 1, n), bad[:20_000 - n]))) - share) < 0.02


def soft(z):
    return np.mean([math.log1p(math.exp(-v)) for v in z])


def parts(w, pos, unl, prior):
    """The positive part of the plain risk, and the negative part before it is kept from below 0."""
    gp, gu = pos @ w[:-1] + w[-1], unl @ w[:-1] + w[-1]
    return prior * soft(gp), soft(-gu) - prior * soft(-gp)


def test_pu_fit_has_the_least_plain_risk():
    rng = np.random.default_rng(3)
    pos, prior = rng.normal(0.5, 1, (300, 4)).astype(np.float32), 0.4
    unl = np.concatenate([rng.normal(0.5, 1, (360, 4)), rng.normal(-0.5, 1, (540, 4))]).astype(np.float32)
    w = op1.nn_pu(pos, unl, prior)

    def risk(w):
        first, rest = parts(w, pos, unl, prior)
        assert rest > 0  # the negative part stays positive here, so the risk is convex
        return first + rest + op1.RIDGE / 2 * float(w[:-1] @ w[:-1])

    least = risk(w)
    for _ in range(60):
        assert risk(w + rng.normal(0, 0.1, 5)) >= least - 1e-4


def test_pu_fit_keeps_the_negative_part_from_falling():
    rng = np.random.default_rng(4)
    pos, unl, prior = rng.normal(1, 1, (20, 40)).astype(np.float32), rng.normal(0, 1.2, (60, 40)).astype(np.float32), 0.4
    w = op1.nn_pu(pos, unl, prior)  # so few rows could be fitted to any negative value
    assert parts(w, pos, unl, prior)[1] > -0.05


def test_cut_points_are_quantiles_of_all_rows(spark):
    rows = op1.described(read(spark, "/root/testdata/sf0.001", "documents"))
    x = np.array([r["x"] for r in rows.collect()], np.float32)
    for j, e in enumerate(op1.cut_points(rows)):
        wanted = np.unique(np.quantile(x[:, j], op1.CUTS, method="inverted_cdf"))
        assert np.allclose(e, wanted, rtol=1e-6)


@pytest.mark.parametrize(("sf", "most"), [("sf0.01", 0.05), ("sf0.1", 0.03)])
def test_prior_from_unlabelled_text(spark, sf, most):
    path = f"/root/testdata/{sf}"
    labels = read(spark, path, "labels")
    rows = op1.described(read(spark, path, "documents"))
    share = labels.selectExpr("avg(quality)").first()[0]
    prior = op1.fit(rows, labels)["prior"]
    print("prior", prior, "label share", share)
    assert abs(prior - share) < most
