"""Suffix-array decontamination, structure repair and Merkle manifest against brute force."""

import hashlib
import heapq
import itertools
import random
import re

import numpy as np
import pytest

from cohortsmith.llm import op11_suffix_decontamination as op11
from cohortsmith.llm import op12_structure_repair as op12
from cohortsmith.llm import op13_merkle_manifest as op13

WORD = re.compile(op11.WORD)


def words_of(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute_hits(text, items, window):
    """(number of words, hit words, items met) by comparing every place with every window."""
    w, hit, met = words_of(text), set(), set()
    for item, t in items:
        q = words_of(t)
        k = min(window, len(q))
        tests = {tuple(q[i:i + k]) for i in range(len(q) - k + 1)} if q else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i:i + k]) in tests:
                hit |= set(range(i, i + k))
                met.add(str(item) if item is not None else "")
    return len(w), hit, sorted(met)


def invented(seed, docs=40, vocabulary=6, words=60):
    rnd = random.Random(seed)
    name = [f"w{k}" if k % 2 else f"É{k}ß" for k in range(vocabulary)]
    text = lambda n: rnd.choice([" ", "--", ", "]).join(rnd.choice(name) for _ in range(n))
    items = [(k, text(rnd.choice([1, 2, 3, 8, 15]))) for k in range(8)] + [(3, text(4)), (None, text(3)), (99, ""), (98, None)]
    rows = [(k, text(rnd.randint(0, words))) for k in range(docs)]
    rows += [(100, None), (101, ""), (None, rows[0][1]), (0, rows[0][1]), (102, rows[1][1].upper()), (103, "\0\0" + items[0][1] + "\0" + items[1][1])]
    return rows, items


DOCS, TESTS = "doc_id long, text string, w string, h string, m string", "item_id long, text string, words string"


def frames(spark, rows, items):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], DOCS), spark.createDataFrame([(*r, "x") for r in items], TESTS)


@pytest.mark.parametrize(("window", "block_words"), [(4, 1 << 18), (4, 20), (10, 1 << 18)])
def test_hits_equal_brute_force(spark, window, block_words):
    rows, items = invented(window)
    docs, bench = frames(spark, rows, items)
    got = op11.contaminated_words(docs, bench, window, block_words).collect()
    want = []
    for i, t in rows:
        n, hit, met = brute_hits(t, items, window)
        want.append((i, n, len(hit), met))
    spans = [(r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["hits"]), r["items"]) for r in got]
    assert sorted(spans, key=str) == sorted(want, key=str)
    for r in got:  # maximal runs
        assert all(a["end"] < b["start"] for a, b in zip(r["hits"], r["hits"][1:]))
    kept = op11.decontaminate(docs, bench, window)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == sorted(
        (str(i), str(t)) for i, t in rows if not brute_hits(t, items, window)[1])


def test_longest_matches_equal_brute_force(spark):
    rows, items = invented(7, vocabulary=12)
    docs, bench = frames(spark, rows, items)
    texts = [words_of(t) for _, t in rows]

    def longest(q):
        best = 0
        for w in texts:
            for i in range(len(w)):
                k = 0
                while k < len(q) and i + k < len(w) and w[i + k] == q[k]:
                    k += 1
                best = max(best, k)
        return best
    got = {(r["item"], r["first"]): r for r in op11.longest_matches(docs, bench).collect()}
    for item, t in items[:8]:
        if item == 3:
            continue  # two items of this id
        q = words_of(t)
        for s in range(len(q)):
            n = longest(q[s:])
            r = got.get((str(item), s))
            assert (r["words"] if r else 0) == n
            if r and r["doc_id"] is not None:
                at = [words_of(x)[r["position"]:r["position"] + n] for i, x in rows if i == r["doc_id"]]
                assert q[s:s + n] in at


@pytest.mark.parametrize("size", [32, 64, 1 << 20])
def test_shards_and_stretches(size):
    """Small shards, and texts longer than a shard, give the same hits."""
    rows, items = invented(3, vocabulary=4, words=200)
    block = op11.TestBlock([(str(i), 0, words_of(t)) for i, t in items[:8] if words_of(t)], 4)
    texts = [(t or "").encode() for _, t in rows]
    n, first, hit, pairs, best = op11.search_texts(texts, block, size)
    for k, (_, t) in enumerate(rows):
        want = brute_hits(t, [x for x in items[:8]], 4)
        assert n[k] == want[0] and set(np.flatnonzero(hit[first[k]:first[k + 1]]).tolist()) == want[1]
        assert sorted(block.items[j] for i, j in pairs if i == k) == want[2]


def test_suffixes_are_sorted():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 3, 500).astype(np.uint64) << np.uint64(50)
    sa = op11.SuffixArray(codes, [(0, 200), (200, 203), (203, 500)], 400)
    ends = [200, 203, 500]
    text = lambda p: codes[p:next(e for e in ends if e > p)].tolist()
    suffixes = [text(int(p)) for p in sa.word[sa.suffix]]
    assert len(suffixes) == 500 and all(a[:400] <= b[:400] for a, b in zip(suffixes, suffixes[1:]))


def test_long_words_and_slices():
    long = b"x" * (op11.SLICE + 10)
    w = op11.Words([long + b" a", b"", b"a " + long])
    assert np.diff(w.first).tolist() == [2, 0, 2] and w.codes[0] == w.codes[3] and w.codes[1] == w.codes[2]


# -- structure repair ---------------------------------------------------------------------
PATTERN = re.compile(r"(s?(ua)+)?")


def brute_repair(rows):
    """Cheapest (cost, audit, rows) over all edit sequences, by uniform-cost search on whole outputs."""
    found = op12.faults(rows)
    heap, most = [(0, "", 0, ())], 3 * len(rows) + 1
    best = None
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        if best and cost > best[0]:
            return best
        initials = "".join(r[:1] or "?" for r, _ in out)
        if i == len(rows) and PATTERN.fullmatch(initials):
            if best is None or (cost, audit) < best[:2]:
                best = (cost, audit, list(out))
        if cost >= most or not re.fullmatch(r"s?(ua)*u?", initials):
            continue
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2, audit + "I", i, (*out, (role, ""))))
        if i < len(rows):
            late = found[i] == "truncated"
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, out))
            if found[i] not in ("blank", "duplicate"):
                heapq.heappush(heap, (cost + late, audit + "K", i + 1, (*out, rows[i])))
                for role in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, (*out, (role, rows[i][1]))))
    return best


def test_repair_equals_all_edits():
    rnd = random.Random(5)
    texts = ["yes.", "no", "why?", " \t\n", "", "no", "yes."]
    for n in range(5):
        for _ in range(60 if n else 1):
            rows = [(rnd.choice(["user", "assistant", "system", "tool", "", " ", "a", "User"]), rnd.choice(texts)) for _ in range(n)]
            cost, audit = op12.cheapest(rows, op12.faults(rows))
            assert (cost, audit, op12.edited(rows, audit)) == brute_repair(rows), rows


def test_repair_of_a_long_conversation():
    rows = [("user" if k % 2 else "assistant", f"say {k}.") for k in range(3000)]
    cost, audit = op12.cheapest(rows, op12.faults(rows))
    assert PATTERN.fullmatch("".join(r[0] for r, _ in op12.edited(rows, audit))) and cost == 4 and len(audit) == 3002


def test_conversations_of_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, None, "system", "first."), (1, 2, None, "x"), (1, 2, "user", "ask?"), (1, 2, "user", "ask?"),
            (None, 0, "assistant", "x."), (None, None, None, None), (2, None, "user", "no turn"), (3, 5, "", "")]
    df = spark.createDataFrame([(*r, "junk", "junk") for r in rows], "conv_id long, turn long, role string, text string, audit string, rows string")
    got = {r["conv_id"]: r for r in op12.repair_conversations(df).collect()}
    assert set(got) == {1, None, 2, 3} and got[1]["gaps"] == 1 and got[2]["gaps"] == 0
    for conv, r in got.items():
        mine = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or " ", x[3] if x[3] is not None else " "))
        said = [(x[2] if x[2] is not None else " ", x[3] if x[3] is not None else " ") for x in mine]
        want = brute_repair(said)
        assert (r["cost"], r["audit"], [tuple(x) for x in r["repaired"]]) == want
    assert op12.repair_conversations(df.limit(0)).count() == 0
    assert op12.damage(df).count() <= 2 * len(rows)


# -- Merkle manifest ------------------------------------------------------------------------


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_are_a_layout(levels):
    at = [op13.address(levels, d, np.arange(8 ** d)) for d in range(levels)]
    assert sorted(np.concatenate(at).tolist()) == list(range(op13.tree_size(levels))) and at[0][0] == 0
    if levels > 2:  # the lowest subtrees stand together
        low = levels // 2
        below = np.concatenate([op13.address(levels, levels - low + k, np.arange(8 ** k)) for k in range(low)])
        assert np.ptp(below) + 1 == len(below)


def brute_tree(leaves):
    """The root and each leaf's [(siblings before, after)] by plain lists."""
    paths, level, at = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[i:i + 8] for i in range(0, len(level), 8)]
        for leaf, i in enumerate(at):
            run, k = runs[i // 8], i % 8
            paths[leaf].append(("".join(run[:k]), "".join(run[k + 1:])))
        level, at = [hashlib.sha256("".join(r).encode()).hexdigest() for r in runs], [i // 8 for i in at]
    return (level[0] if level else None), paths


def brute_leaf(row, lower=False):
    def part(v):
        s = str(v)
        return "-" if v is None else f"{len(s.encode())}:{s}"
    text = row["text"]
    if lower and text is not None:
        text = "".join(c.lower() if c.isascii() else c for c in text)
    return hashlib.sha256("".join(map(part, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))).encode()).hexdigest()


def brute_manifest(rows):
    import zlib
    order = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    langs = sorted({r["lang"] for r in rows}, key=order)
    trees = {}
    for g in langs:
        mine = sorted((r for r in rows if r["lang"] == g), key=lambda r: (order(r["doc_id"]), brute_leaf(r)))
        trees[g] = (mine, *brute_tree([brute_leaf(r) for r in mine]))
    root, tops = brute_tree([trees[g][1] for g in langs])
    out = []
    for g, top in zip(langs, tops):
        for r, path in zip(trees[g][0], trees[g][2]):
            path = path + top
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            out.append((r["doc_id"], brute_leaf(r), trees[g][1], root, hashlib.sha256("".join(a + b for a, b in path).encode()).hexdigest(),
                        op13.fold(brute_leaf(r, lower=hit), path)))
    return out


@pytest.mark.parametrize("sizes", [[1], [3, 1, 8], [9, 64, 65, 1, 2, 7, 30, 4, 5, 6], [4097, 20]])
def test_manifest_equals_brute_force(spark, sizes):
    rnd, rows = random.Random(len(sizes)), []
    for k, n in enumerate(sizes):
        lang = None if k == 1 else f"ß{k}" if k % 2 else f"l{k}"
        rows += [{"doc_id": rnd.randint(0, 9 * n), "text": rnd.choice([None, "", "Abc É", f"Row {i}"]), "lang": lang, "source": rnd.choice([None, "s"]),
                  "n_chars": rnd.choice([None, 5])} for i in range(n)]
    rows.append({**rows[0], "doc_id": None})
    rnd.shuffle(rows)
    cols = ("doc_id", "text", "lang", "source", "n_chars")
    df = spark.createDataFrame([(*(r[c] for c in cols), "x", "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, pos string, tree string")
    got = op13.Manifest(op13.document_leaves(df)).proofs().drop("proof").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_manifest(rows)))


def test_paths_fold_to_the_root(spark):
    df = spark.createDataFrame([(i, f"t{i}", "a" if i % 3 else "b", None, None) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
    for r in op13.Manifest(op13.document_leaves(df).drop("claim")).proofs(with_paths=True).collect():
        assert op13.fold(r["leaf"], [tuple(p) for p in r["proof"]]) == r["root"] == r["folded_root"]


def test_manifest_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    m = op13.Manifest(op13.document_leaves(df))
    assert m.root is None and m.proofs().count() == 0


def test_edits_in_ascii_order():
    assert sorted(op12.DIGIT, key=op12.DIGIT.get) == sorted("DIKR")
    w = op12.Weights(3)
    paths = ["", *("".join(p) for n in (1, 2, 3) for p in itertools.product("DIKR", repeat=n))]

    def weight(audit):
        v = 0
        for e in reversed(audit):
            v = w.before(e, v)
        return v
    for a in paths:
        assert w.read(weight(a)) == (sum(op12.COST[e] for e in a), a)
    same = [a for a in paths if sum(op12.COST[e] for e in a) == 2]
    assert sorted(same) == sorted(same, key=weight)


# -- JSON records whose first message is incomplete ------------------------------------------------


def test_json_layouts_look_at_all_messages(spark):
    from cohortsmith.llm.op2_chat_format import canonical_json
    rows = [(1, '{"messages":[{"role":"assistant","content":null},{"role":"user","content":"hi"}]}'),
            (2, '{"messages":[{"role":"assistant","tool_calls":[1]},{"role":"user","content":"hi"}]}'),
            (3, '{"messages":[{"role":"user","content":"hi"}]}'), (4, "{}"), (5, None), (6, "no json"), (7, '{"messages":[]}'), (8, '{"messages":3}')]
    got = {r["conv_id"]: r for r in canonical_json(spark.createDataFrame(rows, "conv_id long, record string"), "record").collect()}
    assert got[3]["layout"] is not None and [tuple(t) for t in got[3]["turns"]] == [("user", "hi")]
    for i in (1, 2):
        assert got[i]["layout"] == got[3]["layout"] and [tuple(t) for t in got[i]["turns"]] == [("assistant", ""), ("user", "hi")]
    assert all(got[i]["layout"] is None and got[i]["turns"] is None for i in (4, 5, 6, 7, 8))


# -- landing of the mix ------------------------------------------------------------------------------


def test_every_source_of_fifty_documents_meets_its_target(spark):
    from cohortsmith.llm.common import read
    from cohortsmith.llm.op4_cube_mixing import mix_sources
    rows = mix_sources(read(spark, "/root/testdata/sf0.01", "documents")).toPandas()
    per = rows.groupby("source").agg(n=("doc_id", "size"), taken=("taken", "sum"), target=("target", "first"))
    off = ((per["taken"] - per["target"]).abs() / per["target"])[per["n"] >= 40]
    assert len(off) >= 10 and off.max() < 0.01
    assert (rows["taken"] <= 3 * rows["size"]).all()
