"""Registered queries: SQL oracles, held-out accuracy, the pipeline against its parts."""

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from cohortsmith.llm import op5_polynomial_dedup as op5
from cohortsmith.llm import op6_order_minhash as op6
from cohortsmith.llm import queries
from cohortsmith.llm.common import read

SF = "/root/testdata/sf0.001"


def test_all_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF).select(*want.columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def auc(score, y):
    order = np.argsort(np.argsort(score)) + 1
    n1 = int(y.sum())
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


@pytest.mark.parametrize(("name", "label", "least"), [("op1_pu_quality", "quality", 0.97), ("op10_compression_toxicity", "toxic", 0.8)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    d = queries.QUERIES[name](spark, sf).filter("held_out").join(read(spark, sf, "labels"), "doc_id").toPandas()
    assert auc(d["score"].to_numpy(), d[label].to_numpy()) > least
    assert (d["predicted"] == d[label]).mean() > max(d[label].mean(), 1 - d[label].mean())


def test_pipeline_stages(spark):
    docs = read(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "mixing", "packing"]
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == columns
        if name == "exact dedup":
            t = [r["text"].lower() for r in kept.collect()]
            assert len(t) == len(set(t)) and kept.count() == op5.exact_duplicates(before).filter("kept").count()
        if name == "near dedup":
            assert kept.count() == op6.near_duplicates(before).select("class_id").distinct().count()
    packed = corpus_pipeline.packing(spark, kept, SF)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in kept.collect()}
