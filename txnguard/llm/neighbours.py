"""Approximate nearest neighbours by learned partitions.

Of a bounded sample the graph of nearest neighbours is cut into balanced parts with few edges between
them. A small classifier learns a vector's part, from the parts of its neighbours. It places every vector
in its most probable part, and routes a query to the most probable parts until they hold a share of the
probability that finds RECALL of the neighbours of held-out vectors. Parts that are still large are cut
again in the same way. What a query's parts hold is reranked by the exact distance.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnguard.session import materialise

#: Vectors that a classifier is fitted on, at most; one in HELD_OUT of them sets the share to probe.
SAMPLE, HELD_OUT = 8192, 8
#: Rows wanted in a part, parts of one cut, rows from which a part is cut again, and how often.
LEAF, MOST_PARTS, AGAIN, LEVELS = 1024, 64, 4096, 3
#: Share of the neighbours to be found by each cut; three cuts keep over 0.9.
RECALL = 0.98
#: Neighbours in the graph.
DEGREE = 10
#: Vectors, and queries, that one task holds at a time.
CHUNK, QUERIES = 8192, 1024

_MODEL = "cell string, share double, weights binary"


# ---- learning, on one bounded sample


def _nearest(queries: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Numbers of each query's k nearest vectors, in any order."""
    found = []
    for first in range(0, len(queries), 1024):
        q = queries[first : first + 1024]
        far = (vectors**2).sum(1) - 2 * q @ vectors.T
        found.append(np.argpartition(far, min(k, len(vectors) - 1), axis=1)[:, :k])
    return np.concatenate(found)


def cut_graph(vectors: np.ndarray, near: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """A part for each vector, by halving the graph again and again.

    A half is the upper side of the graph's slow eigenvector, cut at the median; then pairs whose swap
    saves edges are swapped. Halves differ by one vector at most.
    """
    rng = np.random.default_rng(seed)
    n = len(vectors)
    a, b = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    pairs = np.unique(np.concatenate([a * n + b, b * n + a])[np.tile(a != b, 2)])
    a, b = pairs // n, pairs % n
    label = np.zeros(n, dtype=np.int64)
    while label.max() + 1 < parts:
        inside = label[a] == label[b]
        side = _halves(vectors @ rng.normal(size=vectors.shape[1]), label, a[inside], b[inside], rng)
        label = 2 * label + side
    return label


def _places(value: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Rank of each value in its group."""
    order = np.lexsort((value, group))
    first = np.concatenate([[0], np.cumsum(np.bincount(group))])
    place = np.empty(len(value), dtype=np.int64)
    place[order] = np.arange(len(value)) - first[group[order]]
    return place


def _halves(start: np.ndarray, group: np.ndarray, a: np.ndarray, b: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    n = len(start)
    degree = np.maximum(np.bincount(a, minlength=n), 1).astype(float)
    root = np.sqrt(degree)
    weight, v = np.bincount(group, degree), start
    for _ in range(40):  # power iteration, kept apart from the constant vector of each group
        v = v - (np.bincount(group, v * root) / weight)[group] * root
        v = 0.5 * (v + np.bincount(a, v[b] / (root[a] * root[b]), minlength=n))
        v = v / np.sqrt(np.bincount(group, v * v) + 1e-30)[group]
    side = (_places(v / root, group) >= (np.bincount(group) // 2)[group]).astype(np.int64)
    for _ in range(30):
        across = side[a] != side[b]
        gain = np.bincount(a, across, minlength=n) - np.bincount(a, ~across, minlength=n)
        half = 2 * group + side
        place, size = _places(-gain, half), np.bincount(half, minlength=2 * (group.max() + 1))
        paired = place < size.reshape(-1, 2).min(axis=1)[group]
        order = np.lexsort((place, group))
        order = order[paired[order]]
        left, right = order[side[order] == 0], order[side[order] == 1]
        saves = gain[left] + gain[right] > 2
        if not saves.any():
            break
        swapped = saves & (rng.random(len(left)) < 0.3)  # not all at once: gains change with the others
        side[left[swapped]], side[right[swapped]] = 1, 0
    return side


def _fit(vectors: np.ndarray, target: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Weights of a softmax regression, the last row the constants; ``target`` are shares of the parts."""
    centre = vectors.mean(axis=0)
    scale = np.sqrt(((vectors - centre) ** 2).sum(axis=1).mean()) or 1.0
    x = np.c_[(vectors - centre) / scale, np.ones(len(vectors))]
    weights = np.zeros((x.shape[1], target.shape[1]))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):
        slope = x.T @ (_softmax(x @ weights) - target) / len(x) + 1e-4 * weights
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        weights -= 0.3 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    inner = weights[:-1] / scale
    return np.r_[inner, [weights[-1] - centre @ inner]]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _probabilities(vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return _softmax(vectors @ weights[:-1] + weights[-1])


def _before(probability: np.ndarray) -> np.ndarray:
    """For each part the probability of all parts that are more probable."""
    order = np.argsort(-probability, axis=1, kind="stable")
    ahead = np.take_along_axis(probability, order, axis=1)
    out = np.empty_like(probability)
    np.put_along_axis(out, order, np.cumsum(ahead, axis=1) - ahead, axis=1)
    return out


def learn(vectors: np.ndarray, parts: int) -> tuple[np.ndarray, float]:
    """Weights, and the share of probability to probe: parts are probed while those before hold no more."""
    held = np.arange(len(vectors)) % HELD_OUT == 0
    held &= len(vectors) >= 4 * HELD_OUT
    known = vectors[~held]
    near = _nearest(known, known, DEGREE + 1)
    label = cut_graph(known, near, parts)
    target = np.zeros((len(known), parts))
    np.add.at(target, (np.repeat(np.arange(len(known)), near.shape[1]), label[near].ravel()), 1 / near.shape[1])
    weights = _fit(known, target)
    if not held.any():
        return weights, 1.0
    place = _probabilities(known, weights).argmax(axis=1)
    needed = np.take_along_axis(
        _before(_probabilities(vectors[held], weights)), place[_nearest(vectors[held], known, DEGREE)], axis=1
    )
    return weights, float(np.quantile(needed, RECALL, method="higher"))


# ---- on tables


def _matrix(column: pa.ChunkedArray, kind: type = np.float64) -> np.ndarray:
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(values), -1)


def _learned(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("order")
    count = rows["count"][0].as_py()
    parts = min(MOST_PARTS, max(4, 1 << max(0, -(-count // LEAF) - 1).bit_length()))
    weights, share = learn(_matrix(rows["vector"]), parts)
    return pa.table({"cell": rows["cell"].slice(0, 1), "share": [share], "weights": [weights.tobytes()]})


def _models(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """One model for each of the cells (cell, count), all fitted at the same time."""
    order = F.xxhash64(F.lit(5), "vector").alias("order")
    thin = F.pmod("order", F.lit(1 << 40)) < F.col("count").cast("double") ** -1 * float(2 * SAMPLE << 40)
    picked = rows.join(cells, "cell").select("cell", "count", "vector", order).where(thin)
    first = F.row_number().over(Window.partitionBy("cell").orderBy("order"))
    sample = picked.withColumn("n", first).where(F.col("n") <= SAMPLE).drop("n")
    return materialise(sample.groupBy("cell").applyInArrow(_learned, _MODEL))


def _routed(key: tuple, rows: pa.Table, models: pa.Table, several: bool) -> pa.Table:
    """Rows with the child cells they belong to, or are to look in; as they are where there is no model."""
    rows = rows.drop_columns(["chunk"])
    if not len(models) or not len(rows):
        return rows
    vectors = _matrix(rows["vector"])
    weights = np.frombuffer(models["weights"][0].as_py()).reshape(vectors.shape[1] + 1, -1)
    found = []
    for first in range(0, len(vectors), CHUNK):
        p = _probabilities(vectors[first : first + CHUNK], weights)
        chosen = _before(p) <= models["share"][0].as_py() if several else np.arange(p.shape[1]) == p.argmax(axis=1)[:, None]
        row, part = np.nonzero(chosen)
        found.append((row + first, part))
    row, part = (np.concatenate(x) for x in zip(*found, strict=True))
    cell = rows["cell"][0].as_py()
    names = np.array([f"{cell}{k}/" for k in range(weights.shape[1])], dtype=object)
    out = rows.take(pa.array(row))
    return out.set_column(out.schema.get_field_index("cell"), "cell", pa.array(names[part], pa.string()))


def _chunks(rows: DataFrame, of: str, size: int) -> tuple[DataFrame, DataFrame]:
    """Rows with ``chunk``, by a hash of ``of`` so that a cell's chunks hold about ``size`` rows, and the
    number of chunks by cell."""
    n = materialise(rows.groupBy("cell").agg(F.ceil(F.count("*") / size).alias("chunks")))
    return rows.join(n, "cell").withColumn("chunk", F.pmod(F.xxhash64(F.lit(9), of), "chunks")).drop("chunks"), n


def _route(rows: DataFrame, of: str, models: DataFrame, several: bool) -> DataFrame:
    spread, n = _chunks(rows, of, 4 * CHUNK)
    each = models.join(n, "cell").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks")
    both = spread.groupBy("cell", "chunk").cogroup(each.groupBy("cell", "chunk"))
    return materialise(both.applyInArrow(partial(_routed, several=several), rows.schema))


def _reranked(key: tuple, rows: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k nearest rows of each query in the chunk, the query's own id left out."""
    found = {"query_id": [], "vec_id": [], "score": []}
    if len(rows) and len(queries):
        vectors, asked = _matrix(rows["vector"]), _matrix(queries["vector"])
        ids = [np.array(x) for x in rows["ids"].to_pylist()]
        most = max(map(len, ids))
        norms = (vectors**2).sum(axis=1)
        rough = norms - 2 * asked @ vectors.T
        # A query's own id takes one place at most. Rounding may not decide what is looked at closely.
        last = min(k, len(vectors) - 1)
        bound = np.partition(rough, last, axis=1)[:, last] + 1e-9 * (norms.max() + (asked**2).sum(axis=1) + 1e-300)
        for i, query in enumerate(queries["query_id"].to_pylist()):
            close = np.nonzero(rough[i] <= bound[i])[0]
            far = np.sqrt(((vectors[close] - asked[i]) ** 2).sum(axis=1))
            name = np.concatenate([ids[c] for c in close])
            far = np.repeat(far, [len(ids[c]) for c in close]) if most > 1 else far
            others = name != query
            name, far = name[others], far[others]
            best = np.lexsort((name, far))[:k]
            found["query_id"] += [query] * len(best)
            found["vec_id"] += name[best].tolist()
            found["score"] += far[best].tolist()
    kinds = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
    return pa.table({name: pa.array(found[name], kind) for name, kind in kinds.items()})


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, of finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """Each vector once, with its least ids: k + 1 of them, as no query can need more."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    least = rows.withColumn("n", place).where(F.col("n") <= k + 1)
    return least.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def nearest(
    table: DataFrame, asked: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row for which ``asked`` holds, by
    Euclidean distance in double precision, nearest first, ties to the smaller id.

    Every row is in the index; a query's own id is no neighbour of it, repeated rows count once. Vectors
    that are null, zero, or hold null or non-finite components take no part, nor do rows without id.
    Vectors of another length than most have (of equally many: the shortest) take no part either.
    Other columns are looked at by ``asked`` only. No rows, no result. Copies of a vector are indexed as one
    with their least k + 1 ids, which loses nothing. ``recall`` compares with all rows.
    """
    named = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), F.coalesce(asked, F.lit(False)).alias("asked"))
    rows = materialise(named.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct())
    length = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    if length is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    rows = rows.where(F.size("vector") == length["d"])
    index = materialise(_distinct_vectors(rows, k).withColumn("cell", F.lit("")))
    queries = rows.where("asked").select(F.col("vec_id").alias("query_id"), "vector", F.lit("").alias("cell"))
    queries = materialise(queries)
    for level in range(LEVELS):
        cells = index.groupBy("cell").count().where(F.col("count") > (AGAIN if level else 1))
        cells = materialise(cells)
        if cells.isEmpty():
            break
        models = _models(index, cells)
        index, queries = _route(index, "vector", models, False), _route(queries, "query_id", models, True)
    return _best(index, queries, k)


def _best(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    chunked, n = _chunks(index, "vector", CHUNK)
    asking, m = _chunks(queries, "query_id", QUERIES)

    def each(df: DataFrame, other: DataFrame, name: str) -> DataFrame:
        return df.join(other, "cell").withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks")

    left = each(chunked.withColumnRenamed("chunk", "part"), m, "turn")
    right = each(asking.withColumnRenamed("chunk", "turn"), n, "part")
    keys = ["cell", "part", "turn"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(partial(_reranked, k=k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")).alias("rank")
    return found.distinct().select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)


def exact(table: DataFrame, asked: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The same by looking at all rows, in blocks of rows and queries: what ``nearest`` is measured against."""
    named = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), F.coalesce(asked, F.lit(False)).alias("asked"))
    rows = materialise(named.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct())
    index = _distinct_vectors(rows, k).withColumn("cell", F.lit(""))
    queries = rows.where("asked").select(F.col("vec_id").alias("query_id"), "vector", F.lit("").alias("cell"))
    return _best(materialise(index), materialise(queries), k)


def recall(found: DataFrame, true: DataFrame) -> float:
    """Share of the true neighbours that were found."""
    both = true.join(found, ["query_id", "vec_id"], "left_semi").count()
    return both / max(1, true.count())
