"""Learned partitions against distances to all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnguard.llm import neighbours, queries

NAN, INF = float("nan"), float("inf")


def plain(rows, asked, k=10):
    """{query: [(score, id)]} over rows (id, vector), all of one length and usable."""
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=float)
    out = {}
    for q, v in rows:
        if asked(q):
            far = np.sqrt(((x - np.array(v, dtype=float)) ** 2).sum(axis=1))
            out[q] = sorted((float(d), int(i)) for d, i in zip(far, ids, strict=True) if i != q)[:k]
    return out


def ranked(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(found, true):
    both = sum(len({i for _, i in found.get(q, [])} & {i for _, i in best}) for q, best in true.items())
    return both / sum(map(len, true.values()))


def check(found, rows, true):
    vectors = {i: np.array(v, dtype=float) for i, v in rows}
    assert found.keys() == true.keys()
    for q, best in found.items():
        assert len(best) == len(true[q]) and best == sorted(best) and len({i for _, i in best}) == len(best)
        for score, i in best:
            assert i != q and score == np.sqrt(((vectors[i] - vectors[q]) ** 2).sum())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    true, found = plain(rows, lambda q: q % 100 == 0), ranked(queries.op12_learned_partitions(spark, folder))
    check(found, rows, true)
    assert recall(found, true) >= 0.9


def clusters(n, groups, d=16, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, d)) * 3
    return [(i, (centre[i % groups] + rng.normal(size=d)).tolist()) for i in range(n)]


def test_parts_cut_again(spark, monkeypatch):
    """Three cuts; in clustered data a query looks at a small part of all rows."""
    for name, value in (("LEAF", 60), ("AGAIN", 150), ("MOST_PARTS", 8), ("CHUNK", 50), ("QUERIES", 7)):
        monkeypatch.setattr(neighbours, name, value)
    rows = clusters(3000, 40)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    looked, best = [], neighbours._best
    monkeypatch.setattr(neighbours, "_best", lambda index, asked, k: looked.extend([index, asked]) or best(index, asked, k))
    found = ranked(neighbours.nearest(df, F.col("vec_id") % 50 == 0))
    true = plain(rows, lambda q: q % 50 == 0)
    check(found, rows, true)
    assert recall(found, true) >= 0.9
    index, asked = looked
    cells = {r.cell: r["count"] for r in index.groupBy("cell").count().collect()}
    assert sum(cells.values()) == 3000 and max(c.count("/") for c in cells) > 1
    seen = sum(cells.get(r.cell, 0) for r in asked.select("cell").collect())
    assert seen < 0.5 * 60 * 3000


def test_cut_is_balanced_and_follows_the_graph():
    x = np.array([v for _, v in clusters(1024, 8)])
    near = neighbours._nearest(x, x, 11)
    label = neighbours.cut_graph(x, near, 8)
    assert np.bincount(label).tolist() == [128] * 8
    assert (label[near] == label[:, None]).mean() > 0.85
    assert len(neighbours.cut_graph(x[:5], near[:5] % 5, 4)) == 5


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=4).round(1).tolist()) for i in range(60)] + [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(60, 100)]
    bad = [(200, None), (201, [0.0] * 4), (202, [1.0, None, 1.0, 1.0]), (203, [1.0, NAN, 0.0, 0.0]), (204, [INF, 1.0, 1.0, 1.0]),
           (205, []), (206, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    rows = [(*r, 1, "x", 0, 2, 3) for r in good + good[:7] + good[60:65] + bad]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, cell string, chunk int, score int, vector int")
    found = ranked(neighbours.nearest(df, F.col("vec_id") % 10 == 0))
    stored = [(i, [float(np.float32(x)) for x in v]) for i, v in good]
    true = plain(stored, lambda q: q % 10 == 0)
    check(found, stored, true)
    assert found[70] == [(0.0, i) for i in range(60, 71) if i != 70]
    assert ranked(neighbours.exact(df.where(F.size("embedding") == 4), F.col("vec_id") % 10 == 0)) == true
    empty = neighbours.nearest(df.limit(0), F.lit(True))
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]
    few = df.where("vec_id < 3").select("vec_id", "embedding")
    assert {q: len(x) for q, x in ranked(neighbours.nearest(few, F.lit(True))).items()} == {0: 2, 1: 2, 2: 2}
    assert neighbours.nearest(df.where("vec_id = 5"), F.lit(True)).count() == 0
