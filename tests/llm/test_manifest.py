"""The Merkle manifest against a plain version, on odd rows and on a tree of several rounds of blocks."""

import hashlib

import pytest
from pyspark.sql import functions as F

from txnguard.llm import manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(values):
    texts = [None if v is None else str(v) for v in values]
    return sha("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def climb(nodes):
    """Root, and per node the siblings up to it."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            paths[k].append(nodes[i ^ 1] if i ^ 1 < len(nodes) else "")
        nodes = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        at = [i >> 1 for i in at]
    return nodes[0], paths


def plain_manifest(rows):
    """rows: (group, order, leaf) -> sorted (leaf, subroot, root, proof)."""
    names = sorted({g for g, _, _ in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        leaves = sorted(((o is not None, o or 0), h) for x, o, h in rows if x == g)
        trees[g] = ([h for _, h in leaves], *climb([h for _, h in leaves]))
    root, tops = climb([trees[g][1] for g in names])
    out = []
    for g, top in zip(names, tops, strict=True):
        leaves, subroot, paths = trees[g]
        out += [(h, subroot, root, sha("".join(p + top))) for h, p in zip(leaves, paths, strict=True)]
    return sorted(out)


def found(rows):
    proof = manifest.proof_digest(F.col("path"))
    folded = manifest.fold(F.col("leaf"), F.col("path"))
    got = rows.select("leaf", "subroot", "root", proof.alias("proof"), folded.alias("folded")).collect()
    assert all(r.folded == r.root for r in got)
    return sorted(tuple(r)[:4] for r in got)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def test_odd_rows(odd_docs, no_docs):
    with_leaf = odd_docs.withColumns({"n_chars": F.length("text"), "leaf": manifest.leaf(*map(F.col, FIELDS))})
    with_leaf = with_leaf.withColumn("n_chars", F.length("text"))
    rows = [tuple(r[c] for c in FIELDS) for r in with_leaf.collect()]
    expected = plain_manifest([(r[2], r[0], h.leaf) for r, h in zip(rows, with_leaf.collect(), strict=True)])
    assert found(manifest.build(with_leaf, "lang", "doc_id", "leaf", ["doc_id", "size"])) == expected
    plain = odd_docs.select(*FIELDS, manifest.leaf(*map(F.col, FIELDS)).alias("leaf")).collect()
    assert all(r.leaf == plain_leaf(tuple(r)[:5]) for r in plain)
    empty = no_docs.withColumn("leaf", manifest.leaf(F.col("text")))
    assert manifest.build(empty, "lang", "doc_id", "leaf", ["doc_id"]).count() == 0


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 513, 1025])
def test_sizes_around_blocks(spark, monkeypatch, n):
    """One large group beside single rows; blocks of four nodes make the large one five rounds deep."""
    monkeypatch.setattr(manifest, "LEVELS", 2 if n > 300 else 8)
    monkeypatch.setattr(manifest, "BLOCK", 4 if n > 300 else 256)
    rows = [("big", i // 2, sha(str(i % 700))) for i in range(n)] + [(None, 1, sha("a")), ("", None, sha("b"))]
    df = spark.createDataFrame(rows, "g string, o long, leaf string")
    assert found(manifest.build(df, "g", "o", "leaf", ["o"])) == plain_manifest(rows)


def test_a_changed_row_does_not_lead_to_the_root(spark):
    df = spark.range(20).select(F.lit("x").alias("g"), "id", manifest.leaf(F.col("id")).alias("leaf"))
    rows = manifest.build(df, "g", "id", "leaf", ["id"])
    folded = manifest.fold(manifest.leaf(F.col("row.id") + 1), F.col("path"))
    assert rows.where(folded == F.col("root")).count() == 0
