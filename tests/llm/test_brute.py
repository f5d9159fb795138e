"""Operators against brute-force versions and exact round trips."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortsmith.llm import op1_pu_quality as op1
from cohortsmith.llm import op3_multiset_hash as op3
from cohortsmith.llm import op4_cube_mixing as op4
from cohortsmith.llm import op5_polynomial_dedup as op5
from cohortsmith.llm import op6_order_minhash as op6
from cohortsmith.llm import op7_retrieval_packing as op7
from cohortsmith.llm import op8_feistel_shards as op8
from cohortsmith.llm import op9_suffix_dedup as op9
from cohortsmith.llm import common, queries
from cohortsmith.llm.common import fold, fold_of, numbered, read
from cohortsmith.llm.components import components
from cohortsmith.llm.op2_chat_format import LAYOUTS, canonical_json, canonical_turns, layout_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return read(spark, SF, "documents").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


def planted(seed=3):
    """Documents with shared passages, near copies and repeats inside."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(90) for _ in range(4)]
    out = [prose(r.randint(20, 120)) + " " + r.choice(shared) + " " + prose(r.randint(0, 80)) for _ in range(30)]
    out += [shared[0][5:], shared[1] + shared[1], "é" * 300, "xy" * 400, "-" * 399, "-" * 401]
    for t in out[:10]:
        w = t.split()
        w[r.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    return out


def test_feistel_is_a_permutation_and_inverts():
    for n in (1, 2, 3, 7, 100, 1000, 4097):
        at = op8.permute(np.arange(n), n, 5)
        assert sorted(at.tolist()) == list(range(n))
        assert op8.permute(at, n, 5, back=True).tolist() == list(range(n))
    assert all(op8.row_at(*op8.locate(i, 100, 8, 5), 100, 8, 5) == i for i in range(100))


def test_shards(spark, docs, texts):
    rows = queries.op8_feistel_shards(spark, SF).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
        t = texts[r["doc_id"]].encode()
        assert r["size"] == len(t) + 1 and r["text_crc32"] == zlib.crc32(t)
    assert set(by) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    order = sorted(texts)
    for r in op8.feistel_shards(docs).collect():
        assert order[r["row"]] == r["doc_id"] and (r["shard"], r["slot"]) == op8.locate(r["row"], len(order), 8, 20240301)


def test_numbered_is_gapless(spark):
    d = spark.range(0, 5000, 1, 7).select((F.col("id") * 37 % 1000).alias("x"))
    rows, n = numbered(d, ["x"])
    got = [(r["row"], r["x"]) for r in rows.collect()]
    assert n == 5000 and sorted(i for i, _ in got) == list(range(5000))
    assert [x for _, x in sorted(got)] == sorted(x for _, x in got)


def test_heavy_and_light_groups_join_alike(spark, monkeypatch):
    rows = spark.range(1000).select((F.when(F.col("id") < 400, 0).otherwise(F.col("id"))).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    monkeypatch.setattr(common, "HEAVY_PART", 10)
    got = common.join_groups(rows, groups, "k", "n", 1000)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(groups, "k").collect()))


def test_fold(spark):
    rows = spark.range(50).select("id", fold("id", 4).alias("f")).collect()
    assert all(r["f"] == fold_of(r["id"], 4) for r in rows)


def fingerprint_by_hand(text):
    strong, counts, words = [0] * 6, [0] * 60, 0
    for p in text.split("\n"):
        h = hashlib.sha256(p.encode()).hexdigest()
        for j in range(6):
            strong[j] = (strong[j] + int(h[10 * j:10 * j + 10], 16)) % (1 << 40)
    return "".join(f"{x:010x}" for x in strong)


def test_fingerprints(spark, texts):
    order = sorted(texts)
    for r in queries.op3_multiset_hash(spark, SF).collect():
        i = order.index(r["doc_id"])
        t, nxt = texts[order[i]], texts[order[(i + 1) % len(order)]]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"].split("-")[0] == fingerprint_by_hand(t)
        assert r["edited_fingerprint"].split("-")[0] == fingerprint_by_hand(edited)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_multiset_hash_is_order_free_and_incremental(spark):
    d = spark.createDataFrame([("one paragraph\nanother one here\nthird words", "third words\none paragraph\nanother one here",
                                "one paragraph\nthird words", "another one here")], "a string, b string, c string, p string")
    v = lambda c: op3.vector(F.col(c))
    r = d.select(op3.fingerprint(v("a")).alias("a"), op3.fingerprint(v("b")).alias("b"), op3.fingerprint(op3.plus(v("c"), v("p"))).alias("plus"),
                 op3.fingerprint(op3.minus(v("a"), v("p"))).alias("minus"), op3.fingerprint(v("c")).alias("c"),
                 op3.likeness(v("a"), v("b")).alias("same")).first()
    assert r["a"] == r["b"] == r["plus"] and r["minus"] == r["c"] != r["a"] and r["same"] == 1.0


def test_likeness_follows_what_is_shared(spark, texts):
    rows = [r for r in queries.op3_multiset_hash(spark, SF).collect() if r["n_chars"] > 300]
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows]) > 0.95


def test_targets():
    t = op4.targets({"b": 10, None: 1000, "a": 100, "ab": 100})
    assert sum(t.values()) == pytest.approx(1210) and t["b"] == 30 and t["ab"] == 300 and t[None] > t["a"]
    assert op4.targets({}) == {} and op4.targets({"a": 0}) == {"a": 0.0}


def test_flight_keeps_both_totals():
    r = random.Random(1)
    size, prob = [r.randint(0, 900) for _ in range(500)], [0.37] * 500
    out = op4.flight(prob, size, random.Random(2))
    assert sum(1e-9 < p < 1 - 1e-9 for p in out) <= 2 and sum(out) == pytest.approx(sum(prob), abs=1e-6)
    assert sum(p * s for p, s in zip(out, size)) == pytest.approx(sum(p * s for p, s in zip(prob, size)), rel=1e-6)
    assert all(p in (0, 1) for p in op4.landing(out, size))


@pytest.mark.parametrize("block", [7, 2000])
def test_mix(docs, texts, block):
    rows = op4.mix_sources(docs, block=block).collect()
    again = {(r["doc_id"], r["taken"]) for r in op4.mix_sources(docs.repartition(5), block=block).collect()}
    assert {(r["doc_id"], r["taken"]) for r in rows} == again
    by = collections.defaultdict(list)
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]].encode().split()) and r["taken"] <= 3 * r["size"]
        by[r["source"]].append(r)
    for rs in by.values():
        assert abs(sum(r["taken"] for r in rs) - rs[0]["target"]) <= max(r["size"] for r in rs)


def test_polynomial_hashes_compose():
    table, data = op5.power_table(), bytes(range(256)) * 150
    parts = [data[i:i + 1000] for i in range(0, len(data), 1000)]
    whole = [0] * 4
    for p in parts:
        whole = op5.combine(whole, op5.chunk_hash(p, table), len(p))
    by_hand = []
    for r in op5.BASES:
        h = 0
        for b in data:
            h = (h * r + b) % op5.PRIME
        by_hand.append(h)
    assert whole == by_hand


def test_refuted_fingerprints_are_told_apart(spark, monkeypatch):
    """With a fingerprint that collides, the chunk comparison still finds the texts different."""
    d = spark.createDataFrame([(1, "aa"), (2, "bb"), (3, "aa")], "doc_id long, text string")
    real = op5.fingerprints
    monkeypatch.setattr(op5, "fingerprints", lambda x: real(x).withColumn("fingerprint", F.lit("clash")))
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in op5.exact_duplicates(d).collect()}
    assert got == {1: (3, 2), 2: (2, 1), 3: (3, 2)}


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], max(row[j + 1], row[j], prev + 1 if x == y else 0)
    return row[-1]


def test_alignment_equals_full_dynamic_programme():
    r, band = random.Random(4), 10**6
    for kinds in (3, 50):
        for _ in range(60):
            a = np.array([r.randrange(kinds) for _ in range(r.randint(1, 60))], np.uint64)
            b = np.array([x for x in a.tolist() if r.random() > .2] + [r.randrange(kinds) for _ in range(3)], np.uint64)
            full = lcs(a.tolist(), b.tolist())
            assert op6.matched(a, b, band) == full
            assert op6.linked(a, b) == (full * 9 >= 4 * (len(a) + len(b)))


def test_near_classes_equal_brute_force(spark, texts):
    all_ = {**texts, **{10_000 + i: t for i, t in enumerate(planted())}}
    d = spark.createDataFrame(list(all_.items()), "doc_id long, text string")
    with np.errstate(over="ignore"):
        s = {i: op6.shingles(op6.word_hashes(t)) for i, t in all_.items()}
        ids, to = sorted(s), {i: i for i in s}

        def root(x):
            while to[x] != x:
                x = to[x]
            return x
        for k, i in enumerate(ids):
            for j in ids[k + 1:]:
                if len(s[i]) and len(s[j]) and op6.linked(s[i], s[j]):
                    a, b = sorted((root(i), root(j)))
                    to[b] = a
    got = {r["doc_id"]: r["class_id"] for r in op6.near_duplicates(d).collect()}
    assert got == {i: root(i) for i in ids}


def test_linked_texts_share_one_of_their_rarest_shingles():
    r, met = random.Random(21), 0
    counts = np.array([r.randrange(1, 5) for _ in range(64)], np.int64) + 1
    with np.errstate(over="ignore"):
        for kinds in (2, 4, 30):
            for _ in range(150):
                words = [r.randrange(kinds) for _ in range(r.randint(1, 80))]
                other = [w for w in words if r.random() > .04] + [r.randrange(kinds) for _ in range(r.randrange(3))]
                a, b = (op6.shingles(np.array(x, np.uint32)) for x in (words, other))
                if len(a) and len(b) and op6.linked(a, b):
                    (ia, xa), (ib, xb) = op6.rarest(a, counts), op6.rarest(b, counts)
                    both = set(xa.tolist()) & set(xb.tolist())
                    assert both
                    # the bound on what they share from the first common one on
                    i, j = (min(at for at, x in zip(ats.tolist(), xs.tolist()) if x in both) for ats, xs in ((ia, xa), (ib, xb)))
                    assert 9 * min(len(a) - i, len(b) - j) >= 4 * (len(a) + len(b))
                    met += 1
    assert met > 100


def test_groups_of_the_same_keys_are_paired_once(spark):
    """Two keys that meet 50 times make one group, with the least place of each; a lone key and a group without another class make none."""
    rows = [(i, k, k, k == "b", 10, 50 - i if k == "a" else i) for i in range(50) for k in "ab"]
    rows += [(100, "a", "a", True, 10, 3), (101, "c", "c", False, 10, 1), (101, "d", "c", False, 10, 1),
             (102, "a", "a", True, 10, 4), (102, "b", "b", False, 10, 5), (102, "c", "c", False, 10, 6)]
    met = spark.createDataFrame(rows, "meet long, key string, label string, other boolean, m int, at int")
    got = {}
    for r in op6._met_once(met).collect():
        got.setdefault(r["meet"], []).append((r["key"], r["other"], r["at"]))
    assert sorted(map(sorted, got.values())) == [[("a", False, 1), ("b", True, 0)], [("a", True, 4), ("b", False, 5), ("c", False, 6)]]


def test_template_texts_meet_no_pairs(spark):
    """Texts of one template share its bucket, but are no candidates of each other; the few near copies among them are."""
    r = random.Random(5)
    template = [f"t{r.randrange(10**6)}" for _ in range(150)]
    texts = [template[:75] + [f"u{r.randrange(10**7)}" for _ in range(64)] + template[75:] for _ in range(300)]
    near = {300 + i: [*t[:100], "other", *t[101:]] for i, t in enumerate(texts[:20])}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in [*enumerate(texts), *near.items()]], "doc_id long, text string")
    pairs = []
    whole, op6._bounded = op6._bounded, lambda p, size: pairs.append(p.count()) or whole(p, size)
    try:
        got = {x["doc_id"]: (x["class_id"], x["class_size"]) for x in op6.near_duplicates(docs).collect()}
    finally:
        op6._bounded = whole
    assert got == {i: (i - 300 if i >= 300 else i, 2 if i < 20 or i >= 300 else 1) for i in got} and len(got) == 320
    assert pairs[0] <= 100


def test_parities_bound_what_no_alignment_matches():
    r = random.Random(4)
    for _ in range(200):
        words = [r.randrange(40) for _ in range(r.randint(1, 90))]
        other = [w for w in words if r.random() > .1] + [r.randrange(40) for _ in range(r.randrange(4))]
        a, b = (op6.shingles(np.array(x, np.uint32)) for x in (words, other))
        if len(a) and len(b):
            bits = sum(int(x ^ y).bit_count() for x, y in zip(op6.parities(a).view(np.uint64), op6.parities(b).view(np.uint64)))
            assert bits <= len(a) + len(b) - 2 * op6.matched(a, b, 100)


def test_family_of_copies_forms_few_pairs(spark):
    """Copies of a text that is not there, with two or three words changed: most are just too far
    from each other; their classes are those of all pairs, and few pairs are formed."""
    r = random.Random(11)
    base = [f"t{r.randrange(10**6)}" for _ in range(150)]
    texts = []
    for i in range(240):
        t = list(base)
        for j in r.sample(range(150), 2 + i % 2):
            t[j] = f"u{r.randrange(10**7)}"
        texts.append(" ".join(t))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs = []
    whole, op6._bounded = op6._bounded, lambda p, size: pairs.append(p.count()) or whole(p, size)
    try:
        got = {x["doc_id"]: x["class_id"] for x in op6.near_duplicates(docs).collect()}
    finally:
        op6._bounded = whole
    with np.errstate(over="ignore"):
        of, to = [op6.shingles(op6.word_hashes(t)) for t in texts], list(range(len(texts)))
        for b in range(len(texts)):
            for a in range(b):
                if to[a] != to[b] and op6.linked(of[a], of[b]):
                    to = [min(to[a], to[b]) if x in (to[a], to[b]) else x for x in to]
    assert got == dict(enumerate(to))
    assert pairs[0] <= 500


def test_components(spark):
    r = random.Random(9)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(250)]
    to = list(range(400))

    def root(x):
        while to[x] != x:
            x = to[x]
        return x
    for a, b in edges:
        to[root(a)] = root(b)
    label = {r["v"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ends = [x for a, b in edges if a != b for x in (a, b)]
    assert set(label) == set(ends)
    assert all((label[a] == label[b]) == (root(a) == root(b)) for a in ends[:80] for b in ends)


def test_packing(spark, texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array(t.encode(x, add_special_tokens=False).ids + [0], "<u4") for i, x in texts.items()}
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in queries.op7_retrieval_packing(spark, SF).collect():
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes())
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for x, long in [*((p, len(ids[i])) for i, p in pieces.items()), *((s, None) for s in sequences.values())]:
        at = 0
        for start, n in sorted(x):
            assert start == at
            at += n
        assert at == long if long else at <= 1024
    assert sum(sum(n for _, n in s) < 1024 for s in sequences.values()) <= 1 + len(texts) // op7.SHARD


def test_bm25_index_equals_brute_force():
    r = np.random.default_rng(5)
    pieces = [r.integers(0, 60, r.integers(1, 40)) for _ in range(50)]
    idf, mean = r.random(op7.VOCABULARY), 20.0
    index = op7.Index(pieces, idf, mean)

    def weight(i, t):
        tf = int((pieces[i] == t).sum())
        return idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(pieces[i]) / mean)) if tf else 0.0

    unused = np.ones(50, bool)
    unused[:5] = False
    query = sorted(set(pieces[7].tolist()), key=lambda t: (-weight(7, t), t))[:op7.QUERY_TERMS]
    score = {i: sum(weight(i, t) for t in query) for i in range(5, 50)}
    want = [i for i in sorted(score, key=lambda i: -score[i]) if score[i] > 0][:6]
    assert index.neighbours(7, unused, 6) == want


def test_loser_tree_merges_and_knows_shared_lengths():
    r = random.Random(6)
    strings = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 14))) for _ in range(300)]
    runs = []
    for k in range(7):
        own = sorted(strings[k::7])
        runs.append(list(zip(*op9.front_coded(own), own)))
    before, out = b"", []
    for shared, s, payload in op9.LoserTree(runs):
        assert s == payload and shared == op9.shared_length(before, s, 0)
        out.append(s)
        before = s
    assert out == sorted(strings)
    assert list(op9.LoserTree([])) == []


def repeats_by_hand(texts):
    where = collections.defaultdict(list)
    for i, b in texts.items():
        for s in range(len(b) - 399):
            where[b[s:s + 400]].append((i, s))
    cover = {i: bytearray(len(b)) for i, b in texts.items()}
    for found in where.values():
        if len(found) > 1:
            for i, s in found:
                cover[i][s:s + 400] = b"\1" * 400
    return cover


@pytest.mark.parametrize("hot", [50_000, 3, 1])
def test_substring_removal_equals_brute_force(spark, texts, monkeypatch, hot):
    monkeypatch.setattr(op9, "BLOCK", 1000)  # windows of one text in many blocks
    monkeypatch.setattr(op9, "HOT", hot)  # prefixes counted by windows instead of merged: none, some, all
    all_ = {**{i: t for i, t in texts.items() if i < 60}, **{10_000 + i: t for i, t in enumerate(planted())}}
    d = spark.createDataFrame(list(all_.items()), "doc_id long, text string")
    raw = {i: t.encode() for i, t in all_.items()}
    cover = repeats_by_hand(raw)
    assert sum(map(sum, cover.values())) > 5000
    for r in op9.remove_repeats(d).collect():
        i = r["doc_id"]
        assert bytes(r["kept"]) == bytes(b for b, c in zip(raw[i], cover[i]) if not c), i
        assert len(r["removed"]) == len(bytes(cover[i]).replace(b"\0", b" ").split())


@pytest.mark.parametrize("span", [1, 16, 64])
def test_hot_passages_cut_anywhere_equal_brute_force(spark, monkeypatch, span):
    """One passage, cut at all places, whole and in copies: stretches that are repeated whole meet
    others that share only some of their windows."""
    monkeypatch.setattr(op9, "HOT", 1)
    monkeypatch.setattr(op9, "SPAN", span)
    monkeypatch.setattr(op9, "BLOCK", 700)
    r = random.Random(17)
    word = lambda: "".join(r.choice("abcdefgh \u00e9") for _ in range(r.randint(2, 9)))
    passage = " ".join(word() for _ in range(160))
    texts = ["ab" * 700, passage, passage]
    for _ in range(60):
        a = r.randrange(len(passage) - 380)
        z = r.randint(a + 370, len(passage))
        texts.append(" ".join(word() for _ in range(r.randrange(90))) + passage[a:z] + " ".join(word() for _ in range(r.randrange(90))))
    texts.append(texts[10])
    raw = {i: t.encode() for i, t in enumerate(texts)}
    cover = repeats_by_hand(raw)
    got = {x["doc_id"]: bytes(x["kept"]) for x in op9.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: bytes(b for b, c in zip(raw[i], cover[i]) if not c) for i in raw}


def test_layouts_are_told_by_their_paths(spark):
    records = [('{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":"b"}],"id":3}', "messages", [("user", "a"), ("assistant", "b")]),
               ('{"conversations":[{"from":"human","value":"a"},{"from":"gpt","value":"b"}]}', "sharegpt", [("user", "a"), ("assistant", "b")]),
               ('{"instruction":"do","input":"","output":"b"}', "instruction_input", [("user", "do"), ("assistant", "b")]),
               ('{"instruction":"do","output":"b"}', "instruction", [("user", "do"), ("assistant", "b")]),
               ('{"prompt":"a","response":"b"}', "prompt_response", [("user", "a"), ("assistant", "b")]),
               ('{"other":1}', None, None), ("not json", None, None), (None, None, None)]
    df = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(records)], "conv_id long, record string")
    got = {r["conv_id"]: (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in canonical_json(df, "record").collect()}
    assert got == {i: (name, turns) for i, (_, name, turns) in enumerate(records)}
    nested = spark.createDataFrame([(1, [("user", "q"), ("assistant", "a")])], "conv_id long, messages array<struct<role:string,content:string>>")
    assert layout_of(nested.schema).name == "messages" and canonical_turns(nested).first()["turns"][1]["text"] == "a"
    assert len({x.fingerprint for x in LAYOUTS}) == len(LAYOUTS)
    with pytest.raises(ValueError):
        layout_of(spark.range(1).schema)


def test_bm25_neighbours_come_from_the_whole_table(spark, tmp_path):
    """Pieces in many blocks and tasks: each seed's list equals brute force over all of them."""
    r = np.random.default_rng(8)
    n = op7.SHARD + 500
    pieces = [r.integers(1, 400, r.integers(3, 30)).astype("<u2") for _ in range(n)]
    idf, mean = r.random(op7.VOCABULARY), 15.0
    rows = [(i, p.tobytes()) for i, p in enumerate(pieces)]
    postings = spark.createDataFrame(rows, "row long, rest binary").repartition(3).mapInArrow(
        op7._weighed(idf, mean), "row long, length int, terms binary, weights binary")
    is_open = r.random(n) < 0.8
    seeds, hot = np.array([5, 999, n - 1]), np.arange(1, 40)
    got = op7.neighbours(postings, seeds, is_open, 12, hot)
    weights = [dict(zip(t.tolist(), w)) for t, w in op7.weights(pieces, idf, mean)]
    for s in seeds:
        score = {i: sum(weights[i].get(t, 0.0) for t in weights[s]) for i in np.flatnonzero(is_open) if i != s}
        want = sorted(score, key=lambda i: (-score[i], (i - s) % n))[:12]
        assert np.allclose([score[i] for i in got[s]], [score[i] for i in want], rtol=1e-5) and len(set(got[s])) == 12


@pytest.mark.parametrize("listed", [1, 8, 400])
def test_windows_take_the_best_unused_pieces(listed):
    """However short the lists are, every piece is placed once and one window at most is short."""
    r = np.random.default_rng(listed)
    length = r.integers(0, op7.WINDOW, 300).astype(np.int32)
    score = r.random((300, 300))

    def ask(seeds, is_open, most):
        return {int(s): [int(i) for i in np.argsort(-score[s]) if is_open[i] and i != s][:most] for s in seeds}

    windows = [w for some in op7.pack(length, ask, seeds=16, listed=listed) for w in some]
    assert sum(sum(k for *_, k in w) < op7.WINDOW for w in windows) <= 1
    covered = collections.defaultdict(list)
    for w in windows:
        for i, start, k in w:
            covered[i].append((start, k))
    for i, parts in covered.items():
        at = 0
        for start, k in sorted(parts):
            assert start == at and k > 0
            at += k
        assert at == length[i]
    assert set(covered) == set(np.flatnonzero(length).tolist())


def test_likeness_of_short_words_and_of_texts_without_words(spark):
    r = random.Random(2)
    short = [" ".join("".join(r.choice("abcdefgh0123456789") for _ in range(3)) for _ in range(400)) for _ in range(2)]
    signs = ["\n".join("".join(r.choice("+-*/<>=!?") for _ in range(12)) for _ in range(300)) for _ in range(2)]
    for a, b in (short, signs):
        half = a[:len(a) // 2] + b[:len(b) // 2]
        row = spark.createDataFrame([(a, half, b)], "a string, half string, b string").select(
            op3.likeness(op3.vector(F.col("a")), op3.vector(F.col("half"))).alias("near"),
            op3.likeness(op3.vector(F.col("a")), op3.vector(F.col("b"))).alias("far")).first()
        assert 0.2 < row["near"] < 0.95 and row["far"] < row["near"]


def test_counts_do_not_wrap(spark):
    text = F.concat(F.repeat(F.when(F.col("id") >= 0, "evergreen "), 2_200_000), F.lit("other words"))
    v = spark.range(1).select(op3.vector(text).alias("v"), op3.vector(F.lit("evergreen")).alias("one")).select("v", op3.likeness(F.col("v"), F.col("one")).alias("near"), F.xxhash64(F.lit("evergreen")).alias("h")).first()
    counts = [x >> 31 * f & (1 << 31) - 1 for f in range(2) for x in v["v"]["counts"]]
    assert v["v"]["words"] == 2_200_002 and v["near"] > 0.99
    assert all(2_200_000 * (v["h"] >> j & 1) <= c <= 2_200_000 * (v["h"] >> j & 1) + 2 for j, c in enumerate(counts))


def test_counts_equal_those_by_hand(spark):
    text = "one two two\n--\n" + " ".join(f"w{i}" for i in range(300))
    words = ["one", "two", "two", "--", *(f"w{i}" for i in range(300))]
    hashes = [r["h"] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w").alias("h")).collect()]
    v = spark.createDataFrame([(text,)], "t string").select(op3.vector(F.col("t")).alias("v")).first()["v"]
    assert v["words"] == len(words)
    assert [x >> 31 * f & (1 << 31) - 1 for f in range(2) for x in v["counts"]] == [sum(h >> j & 1 for h in hashes) for j in range(64)]


@pytest.mark.parametrize("n", [10, 30, 500])
def test_commonest_word_is_sought_in_the_whole_text(n):
    """The repeated word stands in the middle only; the feature is the same share at every length."""
    middle = [f"a{i}" for i in range(n)] + ["spam"] * n + [f"b{i}" for i in range(n)]
    assert op1.matrix([" ".join(middle), ""])[:, 8].tolist() == pytest.approx([1 / 3, 0.0])


def test_packing_works_on_few_rows_at_a_time():
    """A worker's frames, and what it sends back, follow ``BATCH``, not the batch it was sent."""
    r = random.Random(4)
    texts = [None if k == 7 else " ".join(r.choice(["alpha", "beta", "gamma"]) for _ in range(k % 9)) for k in range(2 * op7.BATCH + 5)]
    sent = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array([t or "" for t in texts])})
    got = list(op7._pieces(op7.RANKS)([sent, sent.slice(0, 0)]))
    assert [b.num_rows for b in got] == [op7.BATCH, op7.BATCH, 5, 1]
    rows = [x for b in got[:-1] for x in b.to_pylist()]
    assert [x["doc_id"] for x in rows] == list(range(len(texts)))
    seen = collections.Counter(t for x in rows for t in set(np.frombuffer(x["rest"], "<u2").tolist()))
    assert seen == dict(zip(got[-1]["ids"][0].as_py(), got[-1]["docs"][0].as_py()))
    queries_ = op7.Queries([np.arange(5)] * 3, np.arange(4))
    assert queries_.hot.nbytes == 12 and queries_.who.tolist() == [0, 1, 2]


def test_chunks_have_the_ids_of_the_whole_text():
    """Texts are cut where the full pattern always cuts, so no look-ahead is needed."""
    assert op7.chunks("a  b\n\n\nc d \t") == ["a ", " b\n\n", "\nc d \t"]
    assert op7.chunks("") == [""] and op7.chunks(" \n ") == [" \n "] and op7.chunks("a \x1cb") == ["a \x1cb"]
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r, bpe = random.Random(12), op7.tokenizer()
    signs = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u180e\u2003\u2028\u200b\u3000\ufeff" + "   \n\n" + "abZé漢5²!'s-😀_"
    for text in ["", "  ", *("".join(r.choices(signs, k=r.randint(1, 30))) for _ in range(3000))]:
        got = op7.document_ids(text, bpe)
        assert got.dtype == np.uint32 and got.tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0]


def test_lists_keep_equal_scores_and_leave_the_seed_out():
    best = op7.Best(np.array([1, 4]), 3, 6)
    for rows in (np.array([0, 1, 2]), np.array([3, 4, 5])):
        best.add(0, np.tile(np.float32([0, 2, 2]), (2, 1)), rows)
    assert best.row.tolist() == [[2, 4, 5], [5, 1, 2]] and not np.isneginf(best.score).any()


def _block(r, n: int, groups: int):
    """Ids, weights and rows of ``n`` pieces of some topics; some are copies, some have a very large weight."""
    topics = [r.choice(op7.VOCABULARY, 300, replace=False) for _ in range(groups)]
    terms = [np.unique(r.choice(topics[i % groups], r.integers(5, 60))) for i in range(n)]
    given = [(r.random(len(t)) * 4).astype("<f4") for t in terms]
    for i in range(0, n, 9):
        terms[i], given[i] = terms[i // 2], given[i // 2]
        given[i + 1] = (given[i + 1] * r.choice([1e-4, 1, 300])).astype("<f4")
    return terms, given


@pytest.mark.parametrize("most, some", [(4, 300), (32, 60)])
def test_bounds_leave_the_lists_as_they_are(most, some, monkeypatch):
    """Lists by bounds equal those of all scores, and few pairs are scored where topics differ."""
    monkeypatch.setattr(op7, "SHARD", 400)
    monkeypatch.setattr(op7, "OWN", 200)
    monkeypatch.setattr(op7, "SHARED", 100)
    r, n = np.random.default_rng(most), 3000
    terms, given = _block(r, n, 5)
    seeds = np.sort(r.choice(n, some, replace=False))
    asked = op7.Bounded(seeds, [terms[i] for i in seeds], n, most, np.arange(0, op7.VOCABULARY, 100))
    scored, scores = [], op7.Sketch.scores
    monkeypatch.setattr(op7.Sketch, "scores", lambda self, d, *x: scored.append(len(d)) or scores(self, d, *x))
    for i in range(0, n, 1500):
        part = slice(i, i + 1500)
        asked.add(np.array([len(t) for t in terms[part]]), np.concatenate(terms[part]), np.concatenate(given[part]), np.arange(i, i + 1500))
    for k, s in enumerate(seeds):
        score = np.array([np.float32(w[np.isin(t, terms[s])].sum(dtype=np.float64)) for t, w in zip(terms, given)])
        score[s] = -1
        assert asked.best.row[k].tolist() == np.lexsort(((np.arange(n) - s) % n, -score))[:most].tolist()
    assert sum(scored) < n * some / 8 and (most > 4 or scored)  # long lists: blocks of this size are scored whole


def test_bounds_are_no_less_than_scores(monkeypatch):
    r = np.random.default_rng(3)
    terms, given = _block(r, 500, 2)
    place = np.arange(op7.VOCABULARY)
    for own, shared in ((512, 256), (40, 8)):
        monkeypatch.setattr(op7, "OWN", own)
        monkeypatch.setattr(op7, "SHARED", shared)
        block = op7.Sketch(np.array([len(t) for t in terms]), np.concatenate(terms), np.concatenate(given), np.arange(500), place)
        who, ids = op7._sparse(terms[:50])
        bounds = block.bounds(who, ids, 50) * block.step
        has = np.zeros((50, op7.VOCABULARY), bool)
        has[who, ids] = True
        d, q = np.divmod(np.arange(500 * 50), 50)
        score = block.scores(d, q, has).reshape(500, 50)
        assert (bounds * (1 + 1e-5) >= score).all()
    a, b = r.integers(0, 256, (7, 768)).astype(np.uint8), r.integers(0, 65, (768, 5)).astype(np.int8)
    assert (op7.product()(a, b) == a.astype(int) @ b.astype(int)).all()
    for n in (0, 5, 64, 1003):
        x = r.random(n) < 0.05
        assert op7._true(x).tolist() == np.flatnonzero(x).tolist()


def test_product_without_onnxruntime(monkeypatch):
    import sys
    monkeypatch.setitem(sys.modules, "onnxruntime", None)
    monkeypatch.setitem(sys.__dict__, "_cohortsmith_llm_cache", {})
    a, b = np.full((3, 768), 255, np.uint8), np.full((768, 2), 64, np.int8)
    assert (op7.product()(a, b) == 255 * 64 * 768).all()


def test_pieces_that_are_used_up_are_not_read_again(spark, tmp_path, monkeypatch):
    """The windows are the same whether closed pieces are dropped and bounds used or not; waiting seeds are found."""
    r = random.Random(6)
    words = [f"{a}{b}" for a in ("alpha", "beta", "gamma", "delta") for b in range(150)]
    texts = [(i, " ".join(r.choices(words[i % 4 * 150:i % 4 * 150 + 150], k=r.randint(5, 300)))) for i in range(1500)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = sorted(map(tuple, op7.pack_documents(docs).collect()))
    read, stored = [], op7.stored
    monkeypatch.setattr(op7, "SEEDS", 64)
    monkeypatch.setattr(op7, "BOUNDED", 0)
    monkeypatch.setattr(op7, "stored", lambda df, name: read.append(name) or stored(df, name))
    got = sorted(map(tuple, op7.pack_documents(docs).collect()))
    assert got == want and read.count("postings") > 1
