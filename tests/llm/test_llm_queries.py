"""The registered queries over whole tables, against SQL or plain versions."""

import brute
import duckdb
import pytest
from compare import duck_rows, spark_rows

from txnguard.llm import queries

FOLDER = "/root/testdata/sf0.01"


def table(name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{FOLDER}/{name}.parquet'").fetchall()


DOCS = table("documents", "doc_id, text")


@pytest.mark.parametrize("key", list(queries.ORACLE_SQL))
def test_query_equals_sql(spark, key):
    assert spark_rows(queries.QUERIES[key](spark, FOLDER)) == duck_rows(queries.ORACLE_SQL[key], FOLDER)


def test_personal_data(spark):
    texts = dict(DOCS)
    for r in queries.op1_semi_markov_pii(spark, FOLDER).collect():
        base = brute.personal(texts[r.doc_id])
        named = [f"{k}:{s}:{e}" for k, s, e in base]
        assert r.base_sha256 == brute.sha(",".join(named))
        assert [sum(k == x for k, _, _ in base) for x in ("email", "ip", "card", "phone")] == list(r[1:5])
        assert set(named) <= set(r.spans.split(","))


def test_near_duplicates(spark):
    found = {r.doc_id: r.class_id for r in queries.op2_dart_minhash(spark, FOLDER).collect()}
    assert found == brute.near_classes(DOCS)


def test_fingerprints(spark):
    assert {tuple(r) for r in queries.op3_scaled_sketch(spark, FOLDER).collect()} == set(brute.fingerprints(DOCS))


def test_repeats(spark):
    assert {tuple(r) for r in queries.op4_difference_cover(spark, FOLDER).collect()} == set(brute.without_repeats(DOCS))


def test_quality_tells_held_out_grades_apart(spark):
    rows = queries.op6_ordinal_quality(spark, "/root/testdata/sf0.1").collect()
    quality = dict(duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.1/labels.parquet'").fetchall())
    judged = [(r.selected, quality[r.doc_id] == 1) for r in rows if r.held_out and r.doc_id in quality]
    assert sum(a == b for a, b in judged) / len(judged) > 0.95


def test_benchmark(spark):
    expected = brute.benchmark_hits(DOCS, table("benchmark", "item_id, text"))
    for r in queries.op8_suffix_array(spark, FOLDER).collect():
        assert tuple(r)[1:6] == expected[r.doc_id]


def test_toxicity_of_held_out_documents(spark):
    rows = queries.op9_crf_toxicity(spark, "/root/testdata/sf0.1").collect()
    toxic = dict(duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet'").fetchall())
    judged = [(r.predicted, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    assert sum(a == b for a, b in judged) / len(judged) > 0.95
    assert sum(a for a, b in judged if b) / sum(b for _, b in judged) > 0.9
