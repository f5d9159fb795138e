"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cohortsmith.llm import op1_pu_quality as op1
from cohortsmith.llm import op3_multiset_hash as op3
from cohortsmith.llm import op4_cube_mixing as op4
from cohortsmith.llm import op5_polynomial_dedup as op5
from cohortsmith.llm import op6_order_minhash as op6
from cohortsmith.llm import op7_retrieval_packing as op7
from cohortsmith.llm import op8_feistel_shards as op8
from cohortsmith.llm import op9_suffix_dedup as op9
from cohortsmith.llm import op10_compression_toxicity as op10
from cohortsmith.llm import op11_suffix_decontamination as op11
from cohortsmith.llm import op13_merkle_manifest as op13
from cohortsmith.llm.op2_chat_format import canonical_turns, format_chats, parse_chats

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, label string, size string, "
          "h string, row string, bucket string, start string, _h string, _n string, _row string, times string")
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
TEXTS = [(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, "ALPHA beta gamma delta epsilon zeta eta theta"),
         (3, None), (4, ""), (None, "null id"), (None, None), (5, "same"), (5, "same"), (6, LONG), (7, LONG),
         (8, "aaaa" * 500), (9, "\n\n\n"), (10, "é\U0001F600 <|endoftext|> \\ </turn>"), (11, "one")]


def table(spark, rows):
    junk = ("x",) * 11
    return spark.createDataFrame([(i, t, None, None if n % 3 else "s", n, *junk) for n, (i, t) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, TEXTS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (5, 1, 0), (5, 0, 1), (9, 0, 1), (11, 1, 0)],
                                 "doc_id long, quality int, toxic int")


def items(df):
    return df.select(F.col("doc_id").alias("item_id"), "text", "label").filter("1 = 0")


PER_ROW = {
    "quality": lambda d, x: op1.score_quality(d, x), "fingerprints": lambda d, x: op3.document_fingerprints(d),
    "mix": lambda d, x: op4.mix_sources(d), "exact": lambda d, x: op5.exact_duplicates(d), "near": lambda d, x: op6.near_duplicates(d),
    "shards": lambda d, x: op8.feistel_shards(d), "substrings": lambda d, x: op9.remove_repeats(d),
    "toxicity": lambda d, x: op10.score_toxicity(d, x),
    "benchmark words": lambda d, x: op11.contaminated_words(d, items(d)), "proofs": lambda d, x: op13.Manifest(op13.document_leaves(d)).proofs()}
KEEP = {"mixed": lambda d, x: op4.mixed(d), "drop exact": lambda d, x: op5.drop_exact_duplicates(d),
        "drop near": lambda d, x: op6.drop_near_duplicates(d), "drop toxic": lambda d, x: op10.drop_toxic(d, x),
        "decontaminate": lambda d, x: op11.decontaminate(d, items(d))}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(name, odd, labels):
    got = PER_ROW[name](odd, labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in TEXTS)


@pytest.mark.parametrize("name", [*PER_ROW, *KEEP, "pack"])
def test_empty_table(name, odd, labels):
    f = {**PER_ROW, **KEEP, "pack": lambda d, x: op7.pack_documents(d)}[name]
    assert f(odd.limit(0), labels).count() == 0


@pytest.mark.parametrize("name", ["quality", "toxicity", "drop toxic"])
def test_no_labels(name, odd, labels):
    assert {**PER_ROW, **KEEP}[name](odd, labels.limit(0)).count() == len(TEXTS)


@pytest.mark.parametrize("name", KEEP)
def test_columns_stay(name, odd, labels):
    got = KEEP[name](odd, labels)
    assert got.columns == odd.columns and got.dtypes == odd.dtypes
    assert got.filter("key <> 'x' or _h <> 'x' or _row <> 'x' or times <> 'x'").count() == 0


def test_scores_are_probabilities(odd, labels):
    for f in (op1.score_quality, op10.score_toxicity):
        assert f(odd, labels).filter("score is null or score < 0 or score > 1 or predicted is null").count() == 0


def test_exact_groups(odd):
    rows = op5.exact_duplicates(odd).collect()
    assert sum(r["kept"] for r in rows) == 9
    empty = [r for r in rows if r["text_sha256"] == hashlib.sha256(b"").hexdigest()]
    assert len(empty) == 3 and {r["keep_id"] for r in empty} == {4} and sum(r["kept"] for r in empty) == 1
    assert {r["keep_id"] for r in rows if r["doc_id"] in (1, 2)} == {2}
    assert sum(r["kept"] for r in rows if r["doc_id"] == 5) == 1
    assert op5.drop_exact_duplicates(odd).filter("doc_id = 5").count() == 1


def test_near_groups(odd):
    by = {}
    for r in op6.near_duplicates(odd).collect():
        by.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert by[1] == by[2] == {1} and by[6] == by[7] == {6} and by[3] == by[4] == by[9] == {3}
    assert op6.drop_near_duplicates(odd).filter("doc_id in (1, 2, 5, 6, 7)").count() == 3


def test_substrings_of_odd_texts(odd):
    rows = {}
    for r in op9.remove_repeats(odd).collect():
        rows.setdefault(r["doc_id"], []).append(r)
    assert all(bytes(r["kept"]) == b"" for i in (6, 7, 8) for r in rows[i])  # two copies; one run of one letter
    assert bytes(rows[5][0]["kept"]) == b"same" and rows[3][0]["n_bytes"] == 0


def test_pack_keeps_every_row(odd):
    rows = op7.pack_documents(odd).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 5) == 2 * [r["doc_tokens"] for r in rows if r["doc_id"] == 5][0]
    assert sorted(r["doc_tokens"] for r in rows if r["doc_id"] in (3, 4)) == [1, 1]


def test_chats_of_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", "tie"), (1, 0, "user", "tie"), (1, 1, None, "no role"), (1, None, "system", "first"),
            (None, 0, "assistant", "x"), (2, 0, "ro>le\n<", "\\0\\1\\2 <turn:assistant>\n</turn>\n\\")]
    df = spark.createDataFrame([(*r, "junk", "junk") for r in rows], "conv_id long, turn long, role string, text string, turns string, prompt string")
    back = {r["conv_id"]: r for r in parse_chats(format_chats(canonical_turns(df))).collect()}
    assert [tuple(t) for t in back[2]["turns"]] == [("ro>le\n<", rows[-1][3])]
    assert [tuple(t) for t in back[1]["turns"]] == [("system", "first"), ("user", ""), ("user", "tie"), ("user", "tie"), ("", "no role")]
    assert back[None]["loss_text"] == "x" and back[2]["loss_text"] == ""
    assert canonical_turns(df.limit(0)).count() == 0


def test_fingerprint_of_one_row(spark):
    one = op3.document_fingerprints(table(spark, [(3, "abcd")])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0


def test_stored_tables_stay_in_the_shared_folder(spark, odd):
    path = op5.exact_duplicates(odd).inputFiles()[0]
    assert spark.sparkContext.getConf().get("spark.checkpoint.dir") in path
