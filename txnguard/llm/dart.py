"""Near-duplicate classes by weighted MinHash from hashed darts.

A text is a weighted set: its shingles of five words, each weighing as often as it occurs. Darts are
points of a fixed random process over shingle x weight x rank, all made by hashing, so every text
sees the same ones. A text keeps the darts that fall within its shingles' weights and below a rank
that leaves about ``k ln k`` of them, whatever its length; each dart belongs to one of k coordinates,
and a coordinate's value is its dart of least rank. Two texts agree in a coordinate with the
probability of their weighted Jaccard similarity. Bands of coordinates give the candidate groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.components import components
from txnguard.llm.words import find_words, mix, row_slices, windows
from txnguard.session import materialise

SHINGLE, SIMILARITY, BANDS, BAND_ROWS = 5, 0.8, 32, 4
#: Shingles of a block of a bucket, of members and of strays each.
BLOCK_SHINGLES = 1_000_000
_CELL, _TRY, _NAME, _WHERE = (np.uint64(x | 1) for x in (0x51ED2701, 0xA3B195354A39B70D, 0x1B873593CC9E2D51, 0x2545F4914F6CDD1D))


def weighted_shingles(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, ...]:
    """(shingle hash, weight, row) with one entry per distinct shingle of a row.

    Words are runs of non-space characters, unchanged. A text of fewer words, but not none, is one
    shingle; a text without words has none.
    """
    words = find_words(texts)
    shingle, at = windows(words, width, short=True)
    row = words.row[at]
    order = np.lexsort((shingle, row))
    shingle, row = shingle[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(row))).astype(np.float64)
    return shingle[at], weight, row[at]


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _throw(element, weight, row, reach, k):
    """All darts within the elements' weights and below each row's rank: (row, coordinate, rank, name).

    The region of an element is cut into cells of unit weight; in each, ranks of darts follow a
    Poisson process, of which the next is drawn until it passes ``reach``.
    """
    cells = np.ceil(weight).astype(np.int64)
    owner = np.repeat(np.arange(len(element)), cells)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(cells) - cells, cells)
    seed = mix(element[owner] + level.astype(np.uint64) * _CELL)
    room = weight[owner] - level
    of, most = row[owner], reach[row[owner]]
    rank = np.zeros(len(owner))
    kept, n = [], 0
    while len(seed):
        n += 1
        drawn = mix(seed + np.array([n], np.uint64) * _TRY)
        rank = rank - np.log(_unit(drawn))
        near = rank <= most
        seed, rank, room, of, most, drawn = (x[near] for x in (seed, rank, room, of, most, drawn))
        name = mix(drawn ^ _NAME)
        within = (room >= 1) | (_unit(mix(name + _WHERE)) < room)
        kept.append((of[within], rank[within], name[within]))
    of, rank, name = (np.concatenate([x[i] for x in kept]) if kept else np.zeros(0) for i in range(3))
    return of.astype(np.int64), (name.astype(np.uint64) % np.uint64(k)).astype(np.int64), rank, name


def signatures(element, weight, row, rows: int, k: int) -> np.ndarray:
    """For each row k dart names; rows without elements have zeros.

    Rows of which some coordinate got no dart are thrown for again with twice the reach; a dart's
    rank does not depend on the reach, so the result is as if it had been without end.
    """
    out = np.zeros((rows, k), np.uint64)
    total = np.bincount(row, weight, rows)
    darts = k * math.log(k) + 3 * k if k > 1 else 4
    todo = total > 0
    while todo.any():
        mine = todo[row]
        reach = np.where(todo, darts / np.maximum(total, 1e-300), 0)
        of, where, rank, name = _throw(element[mine], weight[mine], row[mine], reach, k)
        order = np.argsort(rank, kind="stable")[::-1]
        flat = of[order] * k + where[order]
        filled = np.zeros(rows * k, bool)
        filled[flat] = True
        whole = filled.reshape(rows, k).all(axis=1) & todo
        value = np.zeros(rows * k, np.uint64)
        value[flat] = name[order]
        out[whole] = value.reshape(rows, k)[whole]
        todo &= ~whole
        darts *= 2
    return out


def _sign(bands: int, band_rows: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in row_slices(batch.column(1), 1 << 20):
                part = batch.slice(first, last - first)
                element, weight, row = weighted_shingles(part.column(1), width)
                n = last - first
                sig = signatures(element, weight, row, n, bands * band_rows)
                key = np.zeros((n, bands), np.uint64)
                for r in range(band_rows):
                    key = mix(key * _CELL + sig[:, r::band_rows] + np.arange(bands, dtype=np.uint64))
                size = np.bincount(row, weight, n)
                each = np.where(size > 0, bands, 0)
                flat = key[size > 0].reshape(-1).view(np.int64)
                offsets = np.concatenate([[0], np.cumsum(each)]).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, pa.float64()), keys], ["digest", "size", "keys"]
                )

    return run


def _similarity(width: int):
    """Adds the exact weighted Jaccard similarity of each pair of texts."""

    def of(texts: pa.Array, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        element, weight, row = weighted_shingles(texts, width)
        return mix(element + salt[row]), weight, row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in row_slices(batch.column(2), 1 << 20):
                part = batch.slice(first, last - first)
                n = len(part)
                salt = mix(np.arange(1, n + 1, dtype=np.uint64))
                left, left_weight, left_row = of(part.column(2), salt)
                right, right_weight, right_row = of(part.column(3), salt)
                _, i, j = np.intersect1d(left, right, assume_unique=True, return_indices=True)
                both = np.bincount(left_row[i], np.minimum(left_weight[i], right_weight[j]), n)
                either = np.bincount(left_row, left_weight, n) + np.bincount(right_row, right_weight, n) - both
                value = np.divide(both, either, out=np.zeros(n), where=either > 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(value)], ["a", "b", "similarity"]
                )

    return run


def _apart(similarity: float, width: int):
    """Links between strays and members of a block of a bucket that are in different components: of
    those found, a set that joins the same components and closes no circle."""

    def run(table: pa.Table) -> pa.Table:
        node, part, stray = (table.column(c).to_numpy() for c in ("node", "part", "stray"))
        element, weight, row = weighted_shingles(table.column("text").combine_chunks(), width)
        # A shingle that occurs w times as w elements: similarity of weights is then that of sets.
        times = weight.astype(np.int64)
        level = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        element = mix(np.repeat(element, times) + level.astype(np.uint64) * _CELL)
        row = np.repeat(row, times)
        _, element = np.unique(element, return_inverse=True)
        size = np.bincount(row, minlength=len(node))
        start = np.cumsum(size) - size
        member = ~stray & (size > 0)
        # Rows are in order, so each text's elements are a slice; held is how many members have one.
        held = np.bincount(element[member[row]], minlength=element.max() + 1 if len(element) else 1)
        order = np.argsort(np.where(member[row], element, len(held)), kind="stable")[: int(size[member].sum())]
        first = np.concatenate([[0], np.cumsum(held)])
        mine = np.zeros(len(held), bool)
        a, b = [], []
        above: dict[int, int] = {}

        def top(c: int) -> int:
            while (up := above.get(c, c)) != c:
                above[c] = above.get(up, up)
                c = up
            return c

        for x in np.flatnonzero(stray & (size > 0)):
            own = element[start[x] : start[x] + size[x]]
            need = math.ceil(similarity * size[x] - 1e-9)
            # A text similar enough has one of any size - need + 1 elements: take the rarest.
            rare = own[np.argsort(held[own], kind="stable")[: size[x] - need + 1]]
            near = np.unique(np.concatenate([row[order[first[e] : first[e + 1]]] for e in rare]))
            near = near[(part[near] != part[x]) & (size[near] >= need) & (size[near] * similarity <= size[x] + 1e-9)]
            if len(near):
                mine[own] = True
                flat = np.repeat(start[near] - np.cumsum(size[near]) + size[near], size[near]) + np.arange(size[near].sum())
                both = np.add.reduceat(mine[element[flat]].astype(np.int64), np.cumsum(size[near]) - size[near])
                mine[own] = False
                close = near[both >= (similarity - 1e-12) * (size[x] + size[near] - both)]
                for y in close:
                    one, other = top(int(part[x])), top(int(part[y]))
                    if one != other:
                        above[one] = other
                        a.append(min(node[x], node[y]))
                        b.append(max(node[x], node[y]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    width: int = SHINGLE,
) -> DataFrame:
    """One row per row of ``docs``: (<id>, digest, class_key, class_id, class_size).

    Texts are linked when the weighted Jaccard similarity of their shingles is at least
    ``similarity``; classes are the connected components, told apart by class_key; class_id is the least id in the class,
    class_size its number of rows. With 32 bands of 4 a pair at 0.8 shares a band with probability 1 - 5e-8; each candidate is checked exactly.

    Equal texts are joined by digest before anything else, and a group of thousands of copies counts
    as one text. In a bucket, texts are compared with its pivot, not with each other. What is then
    still apart from the bucket's main component is compared with all of the bucket outside its own
    component: only these pairs can hold a missing link, so none is lost and no bucket is capped. This
    is done in blocks of bounded size, by the rarest shingles of each stray; pairs are not listed.

    Null text counts as empty. Texts without words are one class only if equal. Null ids are allowed:
    they never name a class unless all its ids are null. Repeated rows and ids fall into the classes
    of their texts. Other columns are not looked at. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(
        F.col(id_col).alias("id"), F.unhex(F.md5(text)).alias("digest"), text.alias("text")
    )
    spark = docs.sparkSession
    signed = source.select("digest", "text").mapInArrow(
        _sign(bands, band_rows, width), "digest binary, size double, keys array<bigint>"
    )
    # One row per text. Its number is fixed once written.
    texts = materialise(
        signed.groupBy("digest")
        .agg(F.first("size").alias("size"), F.first("keys").alias("keys"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    keys = texts.select("node", "size", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = materialise(keys.join(shared.select("key"), "key"))
    crowd = buckets.select("node").distinct()
    wanted = texts.join(crowd, "node", "left_semi").select("node", "digest")
    content = materialise(
        source.select("digest", "text").dropDuplicates(["digest"]).join(wanted, "digest").select("node", "text")
    )

    def links(pairs: DataFrame) -> DataFrame:
        """Those of (a, b) that are similar enough."""
        left = content.select(F.col("node").alias("a"), F.col("text").alias("left"))
        right = content.select(F.col("node").alias("b"), F.col("text").alias("right"))
        with_texts = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        checked = with_texts.mapInArrow(_similarity(width), "a long, b long, similarity double")
        return checked.where(F.col("similarity") >= similarity - 1e-12).select("a", "b")

    fits = "least(size, other_size) >= {} * greatest(size, other_size)".format(similarity - 1e-9)
    order = F.struct(F.xxhash64("node").alias("h"), "node", "size")
    found = None
    for pick in (F.min, F.max):
        pivots = buckets.groupBy("key").agg(pick(order).alias("p"))
        pairs = (
            buckets.join(pivots, "key")
            .select("node", "size", F.col("p.node").alias("other"), F.col("p.size").alias("other_size"))
            .where(f"node != other and {fits}")
            .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
            .distinct()
        )
        more = links(pairs)
        found = more if found is None else found.union(more)
    found = materialise(found.distinct())
    part = components(found)
    placed = materialise(
        buckets.join(part, "node", "left").select(
            "key", "node", "size", F.coalesce("component", "node").alias("part")
        )
    )
    # For each bucket that is still in parts, into how many blocks its members and strays go.
    main = (
        placed.groupBy("key", "part")
        .agg(F.count("*").alias("n"), F.sum("size").alias("size"))
        .groupBy("key")
        .agg(F.max(F.struct("n", "part", "size")).alias("m"), F.sum("size").alias("size"), F.count("*").alias("parts"))
        .where("parts > 1")
        .select(
            "key",
            F.col("m.part").alias("main"),
            F.ceil(F.col("size") / BLOCK_SHINGLES).cast("int").alias("blocks"),
            F.ceil((F.col("size") - F.col("m.size")) / BLOCK_SHINGLES).cast("int").alias("stray_blocks"),
        )
    )
    mixed = placed.join(main, "key")
    dealt = F.abs(F.xxhash64("node") % F.lit(1 << 40))
    members = mixed.select(
        "key", "node", "part", F.lit(False).alias("stray"),
        (dealt % F.col("blocks")).alias("block"), F.explode(F.sequence(F.lit(0), F.col("stray_blocks") - 1)).alias("stray_block"),
    )
    strays = mixed.where("part != main").select(
        "key", "node", "part", F.lit(True).alias("stray"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), (dealt % F.col("stray_blocks")).alias("stray_block"),
    )
    rest = (
        members.union(strays)
        .join(content, "node")
        .groupBy("key", "block", "stray_block")
        .applyInArrow(_apart(similarity, width), "a long, b long")
    )
    found = materialise(found.union(rest).distinct())
    part = components(found)
    named = materialise(
        texts.select("digest", "node")
        .join(part, "node", "left")
        .select("digest", F.coalesce("component", "node").alias("part"))
    )
    rows = materialise(source.select("id", "digest").join(named, "digest"))
    classes = rows.groupBy("part").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    return rows.join(classes, "part").select(
        F.col("id").alias(id_col), "digest", F.col("part").alias("class_key"), "class_id", "class_size"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the least id, and of equal ids the least
    digest of text. Null ids come last; of repeated rows one stays. All columns are kept."""
    found = near_duplicates(docs, id_col, text_col, **settings).select(
        F.col(id_col).alias("id"), "digest", "class_key"
    )
    order = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    best = found.groupBy("class_key").agg(F.min(order).alias("best"))
    best = best.select(F.col("best.id").alias("best_id"), F.col("best.digest").alias("best_digest"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("id"),
        F.unhex(F.md5(text)).alias("digest"),
    )
    same = (F.col("digest") == F.col("best_digest")) & F.col("id").eqNullSafe(F.col("best_id"))
    kept = packed.join(best, same).dropDuplicates(["digest", "best_digest", "id", "best_id"])
    return kept.select("row.*")
