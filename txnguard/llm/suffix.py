"""Verbatim matches of benchmark items in a corpus, by suffix arrays over shards of the corpus.

Each shard (some megabytes of documents) is turned into word numbers, with a mark between documents,
and its suffixes are sorted. The windows of all items are then found by binary search: a window's
occurrences are a range of the array. No shuffle is needed; documents are never split.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.llm.words import ALPHANUMERIC, LOWER, find_words, mix, row_slices
from txnguard.session import materialise

WINDOW = 13
BLOCK_BYTES = 16 << 20
#: About so many places of windows are followed at once.
PLACES = 1 << 20
#: Word numbers that a sort key holds, if a block has no more than fit into 21 bits each, and else.
_PACK, _FEWER = 3, 2


@dataclass
class Tests:
    """A block of items: the vocabulary, the items' word numbers, and their distinct windows."""

    vocabulary: np.ndarray
    words: np.ndarray
    start: np.ndarray
    width: np.ndarray
    #: For window i, the items are item[first[i] : first[i + 1]].
    first: np.ndarray
    item: np.ndarray
    ids: list[str | None]
    #: Where window i occurs in the items' words: place[place_first[i] : place_first[i + 1]].
    place: np.ndarray
    place_first: np.ndarray


def prepare(ids: list, texts: list, window: int = WINDOW) -> Tests:
    found = find_words(pa.array(texts, pa.string()), ALPHANUMERIC, LOWER)
    vocabulary = np.unique(found.hash)
    number = np.searchsorted(vocabulary, found.hash).astype(np.int64) + 1
    # A zero after each item, and enough at the end for reads past it.
    at = np.arange(len(number)) + found.row
    words = np.zeros(len(number) + len(texts) + window + 1, np.int64)
    words[at] = number
    counts, begin = found.counts, found.first + np.arange(len(texts))
    width = np.minimum(counts, window)
    each = np.where(counts > 0, counts - width + 1, 0)
    item = np.repeat(np.arange(len(texts)), each)
    offset = np.arange(len(item)) - np.repeat(np.cumsum(each) - each, each)
    start, width = begin[item] + offset, width[item]
    key = np.zeros(len(start), np.uint64)
    for k in range(window):
        inside = k < width
        key[inside] = mix(key[inside] + words[start[inside] + k].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    key = mix(key + width.astype(np.uint64))
    _, one, which = np.unique(key, return_index=True, return_inverse=True)
    pairs = np.unique(np.stack([which, item], axis=1), axis=0) if len(item) else np.zeros((0, 2), int)
    first = np.searchsorted(pairs[:, 0], np.arange(len(one) + 1))
    order = np.argsort(which, kind="stable")
    place_first = np.searchsorted(which[order], np.arange(len(one) + 1))
    return Tests(vocabulary, words, start[one], width[one], first, pairs[:, 1], ids, start[order], place_first)


class Shard:
    """The sorted suffixes of some documents, as far as they can begin a match."""

    def __init__(self, texts: pa.Array, tests: Tests, depth: int):
        found = find_words(texts, ALPHANUMERIC, LOWER)
        self.counts = found.counts
        self.begin = found.first + np.arange(len(found.counts))
        near = np.searchsorted(tests.vocabulary, found.hash)
        near[near == len(tests.vocabulary)] = 0
        known = tests.vocabulary[near] == found.hash if len(tests.vocabulary) else near < 0
        pack = _PACK if len(tests.vocabulary) < (1 << 21) - 1 else _FEWER
        bits = 63 // pack
        self.words = np.zeros(len(found.hash) + len(found.counts) + depth + _PACK, np.int64)
        self.words[np.arange(len(found.hash)) + found.row] = np.where(known, near + 1, 0)
        self.row = np.repeat(np.arange(len(found.counts)), found.counts + 1)
        least = int(tests.width.min()) if len(tests.width) else depth
        # How many words of the vocabulary follow without a gap; a shorter run begins no match.
        zero = np.flatnonzero(self.words == 0)
        n = len(self.row)
        run = zero[np.searchsorted(zero, np.arange(n))] - np.arange(n)
        at = np.flatnonzero(run >= least)
        keys = []
        for k in range(0, depth, pack):
            key = np.zeros(len(at), np.int64)
            for j in range(pack):
                key = (key << bits) | np.where(run[at] > k + j, self.words[np.minimum(at + k + j, len(self.words) - 1)], 0)
            keys.append(key)
        self.array = at[np.lexsort(keys[::-1])]

    def search(self, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
        """The range of the array that begins with each window."""
        return self._bound(tests, False), self._bound(tests, True)

    def _bound(self, tests: Tests, above: bool) -> np.ndarray:
        low = np.zeros(len(tests.start), np.int64)
        high = np.full(len(tests.start), len(self.array), np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            sign = self._compare(self.array[middle], tests, open_)
            right = sign <= 0 if above else sign < 0
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]

    def _compare(self, at: np.ndarray, tests: Tests, which: np.ndarray) -> np.ndarray:
        """Whether the suffixes lie before (-1), at (0) or behind (1) the windows."""
        sign = np.zeros(len(at), np.int64)
        level = np.arange(len(at))
        k = 0
        while len(level):
            level = level[tests.width[which[level]] > k]
            mine = self.words[at[level] + k]
            theirs = tests.words[tests.start[which[level]] + k]
            sign[level] = np.sign(mine - theirs)
            # A suffix that has ended lies before; its zero is less than any number.
            level = level[mine == theirs]
            k += 1
        return sign

    def lengths(self, at: np.ndarray, test: np.ndarray, width: np.ndarray, tests: Tests) -> np.ndarray:
        """How many words agree from each occurrence on."""
        length, level = width.copy(), np.arange(len(at))
        while len(level):
            mine = self.words[at[level] + length[level]]
            level = level[(mine > 0) & (mine == tests.words[test[level] + length[level]])]
            length[level] += 1
        return length


def _ranges(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - low, size)


_FOUND = "n_words bigint, hits array<int>, items array<string>, longest int, matches array<struct<item:string,item_word:int,doc_word:int,n_words:int>>"
_MATCH = pa.struct([("item", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("n_words", pa.int32())])


def _lists(flat: pa.Array, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), flat)


def _search(block, window: int, locations: bool):
    """Adds the block's matches to what earlier blocks have found: the hit words of a document,
    as starts and ends of its ranges, and the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests: Tests = block.value
        for batch in batches:
            for first, last in row_slices(batch.column("text")):
                yield one(batch.slice(first, last - first), tests)

    def one(part: pa.RecordBatch, tests: Tests) -> pa.RecordBatch:
        n = len(part)
        shard = Shard(part.column("text"), tests, max(window, _PACK))
        low, high = shard.search(tests)
        which = np.repeat(np.arange(len(low)), high - low)
        at = shard.array[_ranges(low, high - low)]
        width = tests.width[which]
        change = np.zeros(len(shard.words) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + width, -1)
        hit = np.cumsum(change)[: len(shard.row)] > 0
        before = part.column("hits")
        if before.null_count < n:
            for i, pairs in enumerate(before.to_pylist()):
                for a, b in zip(pairs[::2], pairs[1::2], strict=True):
                    hit[shard.begin[i] + a : shard.begin[i] + b] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
        edge_row = shard.row[np.minimum(edge, len(shard.row) - 1)] if len(edge) else edge
        edge_row[1::2] = edge_row[::2]
        hits = _lists(pa.array((edge - shard.begin[edge_row]).astype(np.int32)), np.bincount(edge_row, minlength=n))
        # The items of a document: each of its windows once, then each window's items.
        row = shard.row[at]
        pairs = np.unique(row * np.int64(max(1, len(low))) + which)
        row_of, window_of = pairs // max(1, len(low)), pairs % max(1, len(low))
        many = tests.first[window_of + 1] - tests.first[window_of]
        item = tests.item[_ranges(tests.first[window_of], many)]
        item_row = np.repeat(row_of, many)
        pairs = np.unique(item_row * np.int64(max(1, len(tests.ids))) + item)
        items = [set(x or ()) for x in part.column("items").to_pylist()]
        for r, i in zip(pairs // max(1, len(tests.ids)), pairs % max(1, len(tests.ids)), strict=True):
            if tests.ids[i] is not None:
                items[r].add(tests.ids[i])
        # An occurrence is followed along each place of its window that it cannot be followed to from the left.
        longest = np.zeros(n, np.int64)
        matches = [x or [] for x in part.column("matches").to_pylist()] if locations else None
        begins = tests_begin(tests)
        places = tests.place_first[which + 1] - tests.place_first[which]
        for some in np.split(np.arange(len(at)), np.searchsorted(np.cumsum(places), np.arange(PLACES, places.sum(), PLACES))):
            of = np.repeat(some, places[some])
            start = tests.place[_ranges(tests.place_first[which[some]], places[some])]
            before = shard.words[np.maximum(at[of] - 1, 0)]
            back = (at[of] > 0) & (start > 0) & (before > 0) & (before == tests.words[np.maximum(start - 1, 0)])
            of, start = of[~back], start[~back]
            length = shard.lengths(at[of], start, width[of], tests)
            np.maximum.at(longest, row[of], length)
            if locations:
                add_matches(matches, shard, tests, begins, at[of], start, length)
        longest = np.maximum(longest, part.column("longest").to_numpy(zero_copy_only=False))
        columns = [
            part.column("row"),
            part.column("text"),
            pa.array(shard.counts),
            hits,
            pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            pa.array(longest.astype(np.int32)),
            pa.array(matches, pa.list_(_MATCH)) if locations else part.column("matches"),
        ]
        return pa.RecordBatch.from_arrays(columns, ["row", "text", "n_words", "hits", "items", "longest", "matches"])

    def add_matches(matches, shard, tests, begins, at, start, length):
        """Adds matches that cannot be made longer to the left, with where they lie, for each item."""
        item = np.searchsorted(begins, start, side="right") - 1
        rows = shard.row[at]
        for i, r in enumerate(rows):
            matches[r].append(
                {
                    "item": tests.ids[item[i]],
                    "item_word": int(start[i] - begins[item[i]]),
                    "doc_word": int(at[i] - shard.begin[r]),
                    "n_words": int(length[i]),
                }
            )

    return run


def tests_begin(tests: Tests) -> np.ndarray:
    """Where each item begins among the block's words: after each zero but the padding."""
    zero = np.flatnonzero(tests.words == 0)[: max(0, len(tests.ids) - 1)]
    return np.concatenate([[0], zero + 1])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list, list]]:
    """The items in blocks of bounded size, read one partition at a time."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string"))
    for item, text in rows.toLocalIterator():
        ids.append(item)
        texts.append(text or "")
        size += len(texts[-1].encode())
        if size > BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
    yield ids, texts


def _searched(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, window: int, locations: bool) -> DataFrame:
    spark = docs.sparkSession
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    schema = T.StructType([*packed.schema.fields, *T._parse_datatype_string(_FOUND).fields])
    out = packed.selectExpr(
        "row", "text", "0L AS n_words", "CAST(NULL AS array<int>) AS hits",
        "CAST(NULL AS array<string>) AS items", "0 AS longest",
        "CAST(NULL AS array<struct<item:string,item_word:int,doc_word:int,n_words:int>>) AS matches",
    )
    for i, (ids, texts) in enumerate(_blocks(benchmark, item_col, item_text_col)):
        if i:
            out = materialise(out)
        block = spark.sparkContext.broadcast(prepare(ids, texts, window))
        out = out.mapInArrow(_search(block, window, locations), schema)
    return out.withColumn(
        "n_hit",
        F.aggregate(F.col("hits"), F.lit(0), lambda s, x: x - s).cast("long"),
    )


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    locations: bool = True,
) -> DataFrame:
    """One row per document: (<id>, n_words, n_hit, items, longest, matches).

    Words are runs of ASCII letters, digits and anything beyond ASCII, with A-Z as a-z. A window is
    ``window`` consecutive words of an item; an item of fewer, but not none, is one window. n_hit
    counts the document's words inside any occurrence of a window; items are the ids (as sorted
    strings) of those with an occurring window; longest is the longest verbatim match in words;
    matches say where the matches lie that cannot be made longer, for each item and each place in it
    (only with ``locations``).

    The items are the query set. They are taken in blocks of 16 MB of text, whatever their number,
    and one block is broadcast at a time; an item that is longer is a block of its own. Null text has no words. An item without id counts for
    n_hit, but is not listed. Repeated rows are judged each for itself. Without items nothing is hit;
    without documents there are no rows. Other columns are not looked at.
    """
    found = _searched(docs.select(id_col, text_col), benchmark, text_col, item_col, item_text_col, window, locations)
    return found.select(F.col(f"row.{id_col}").alias(id_col), "n_words", "n_hit", "items", "longest", "matches")


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """At least a twentieth of the words are hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``docs`` without the contaminated ones; all columns are kept."""
    found = _searched(docs, benchmark, text_col, item_col, item_text_col, window, False)
    return found.where(~is_contaminated()).select("row.*")
