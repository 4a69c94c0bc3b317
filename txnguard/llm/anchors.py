"""Repeated passages by difference-cover anchors.

A difference cover D modulo v has, for any two positions i and j, a step k < v with both i + k and
j + k in D (modulo v). So of two equal windows of ``window`` words, wherever they start, some equal
inner windows of ``window - v + 1`` words both start at covered positions: anchors. Only anchors
(three of seven positions) are compared over the corpus; where texts share one, the windows around
it are compared in full.

Hashes travel in packed blocks, dealt by hash. A hash that one batch holds several times is decided
there as far as it can be, and sent once; so a hash has at most one entry per batch, however many
documents hold it. Anchors are hashes of 64 bits: where two differ but collide, windows are compared for
nothing. Windows are told by 128 bits of a cryptographic hash of their words, texts by MD5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.words import find_words, row_slices, windows
from txnguard.session import materialise

WINDOW = 13
PERIOD, COVER = 7, (0, 1, 3)
#: Words per range of hashes, which are compared at a time; the least number of ranges, and the most
#: partitions that they are dealt to, each partition taking its ranges one after the other.
PART_WORDS, LEAST_PARTS, MOST_TASKS = 4_000_000, 32, 20_000
_LAST = (1 << 63) - 1
_PACKED = "part bigint, owner bigint, positions binary"
#: A window: its hash, what decides who is smaller, the text it lies in, its first word there, and the
#: rest of its hash.
_ENTRY = np.dtype([("hash", "<u8"), ("rank", "<i8"), ("owner", "<i8"), ("at", "<i4"), ("more", "<u8")])


def difference_cover(period: int, cover: tuple[int, ...]) -> np.ndarray:
    """Whether each residue is covered; checks that every difference occurs."""
    if {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("not a difference cover")
    return np.isin(np.arange(period), cover)


def _pack(entries: np.ndarray) -> bytes:
    """Columns one after the other: they compress better so."""
    columns = [entries[c] for c in _ENTRY.names]
    columns[3] = np.diff(columns[3], prepend=np.int32(0))
    raw = np.array([len(entries)], "<i8").tobytes() + b"".join(c.tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    out, at = np.empty(n, _ENTRY), 8
    for c in _ENTRY.names:
        out[c] = np.frombuffer(raw, _ENTRY[c], n, at)
        at += n * _ENTRY[c].itemsize
    out["at"] = np.cumsum(out["at"], dtype=np.int32)
    return out


def _groups(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries in order of hash, and where each hash begins."""
    entries = entries[np.lexsort((entries["more"], entries["hash"]))]
    new = np.ones(len(entries), bool)
    new[1:] = (entries["hash"][1:] != entries["hash"][:-1]) | (entries["more"][1:] != entries["more"][:-1])
    return entries, np.flatnonzero(new)


def _repeated(entries: np.ndarray, smaller: bool) -> tuple[np.ndarray, np.ndarray]:
    """(entries known to be repeated, those still to be compared with other batches).

    Repeated is what another rank has too; with ``smaller``, what a smaller rank has. What is left
    open are the entries of the least rank; where these are known to be repeated, one of them stands
    for all.
    """
    entries, first = _groups(entries)
    if not len(entries):
        return entries, entries
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(entries))))
    least = np.minimum.reduceat(entries["rank"], first)[group]
    most = np.maximum.reduceat(entries["rank"], first)[group]
    told = entries["rank"] > least if smaller else least != most
    standing = np.flatnonzero(entries["rank"] == least)
    one = np.ones(len(standing), bool)
    one[1:] = np.diff(group[standing]) > 0
    return entries[told], entries[standing[one | ~told[standing]]]


def _by_owner(found: np.ndarray, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """Positions of each owner, to be passed on."""
    if len(found):
        found = found[np.argsort(found["owner"], kind="stable")]
        cut = np.flatnonzero(np.diff(found["owner"])) + 1
        for group in np.split(found, cut):
            owner = int(group["owner"][0])
            yield owner % parts, owner, np.unique(group["at"]).tobytes()


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.binary()),
        ],
        ["part", "owner", "positions"],
    )


def _deal(pick: Callable, parts: int, smaller: bool):
    """From texts to packed hashes by partition, and what is already known to be repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, words_held = [], 0
            for part in _with_text(batch):
                hashes, more, row, at = pick(part)
                entries = np.empty(len(hashes), _ENTRY)
                entries["hash"], entries["more"], entries["at"] = hashes, more, at
                for c in ("rank", "owner"):
                    entries[c] = part.column(c).to_numpy()[row]
                held.append(entries)
                words_held += len(entries)
                if words_held > 1_500_000:
                    yield from send(np.concatenate(held))
                    held, words_held = [], 0
            if held:
                yield from send(np.concatenate(held))

    def send(entries: np.ndarray) -> Iterator[pa.RecordBatch]:
        told, open_ = _repeated(entries, smaller)
        # Sorted by hash, so each range is a slice.
        part = ((open_["hash"] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        cut = np.flatnonzero(np.diff(part)) + 1
        rows = []
        for block in np.split(open_, cut) if len(open_) else []:
            number = int(((int(block["hash"][0]) >> 32) * parts) >> 32)
            block = block[np.lexsort((block["at"], block["owner"]))]
            rows.append((number, None, _pack(block)))
        rows += _by_owner(told, parts)
        for i in range(0, len(rows), 2000):
            yield _emit(rows[i : i + 2000])

    return run


def _with_text(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of bounded size, with texts that travelled packed in full."""
    if "packed" not in batch.schema.names:
        for first, last in row_slices(batch.column("text"), most):
            yield batch.slice(first, last - first)
        return
    packed, first, texts, size = batch.column("packed"), 0, [], 0
    unpack = zstandard.ZstdDecompressor()
    for i in range(len(packed)):
        texts.append(unpack.decompress(packed[i].as_py()))
        size += len(texts[-1])
        if size > most or i == len(packed) - 1:
            column = pa.array(texts, pa.binary()).cast(pa.string())
            yield batch.slice(first, i + 1 - first).append_column("text", column)
            first, texts, size = i + 1, [], 0


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed by themselves: they are to be shuffled."""
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [pack.compress(x.as_buffer()) for x in batch.column("text")]
        columns = [batch.column("id"), batch.column("digest"), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "digest", "packed"])


def _compare(parts: int, smaller: bool):
    """What is repeated over all batches, from packed hashes in order of their ranges, a range at a time."""

    def told_of(blocks: list[bytes], passed: dict[int, list[np.ndarray]]) -> list[tuple]:
        rows = [(0, owner, np.unique(np.concatenate(x)).tobytes()) for owner, x in passed.items()]
        if blocks:
            rows += _by_owner(_repeated(np.concatenate([_unpack(x) for x in blocks]), smaller)[0], parts)
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blocks, passed, rows = None, [], {}, []
        for batch in batches:
            for part, owner, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if part != current:
                    rows += told_of(blocks, passed)
                    current, blocks, passed = part, [], {}
                    if len(rows) > 2000:
                        yield _emit(rows)
                        rows = []
                if owner is None:
                    blocks.append(data)
                else:
                    own = passed.setdefault(owner, [])
                    own.append(np.frombuffer(data, np.int32))
                    if len(own) > 64:
                        own[:] = [np.unique(np.concatenate(own))]
        rows += told_of(blocks, passed)
        for i in range(0, len(rows), 2000):
            yield _emit(rows[i : i + 2000])

    return run


def _found(texts: DataFrame, pick: Callable, parts: int, smaller: bool) -> DataFrame:
    """(owner, positions): where each owner's windows are repeated. ``texts`` has rank, owner, packed.

    An owner's list has an entry per range of hashes at most."""
    dealt = texts.mapInArrow(_deal(pick, parts, smaller), _PACKED)
    ranged = dealt.repartition(min(parts, MOST_TASKS), "part").sortWithinPartitions("part")
    told = ranged.mapInArrow(_compare(parts, smaller), _PACKED)
    return told.groupBy("owner").agg(F.collect_list("positions").alias("positions"))


def _anchors(window: int, period: int, cover: tuple[int, ...]):
    covered = difference_cover(period, cover)

    def pick(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        words = find_words(part.column("text"))
        hashes, at = windows(words, window - period + 1)
        inner = at - words.first[words.row[at]]
        kept = covered[inner % period] & (words.counts[words.row[at]] >= window)
        return hashes[kept], np.zeros(int(kept.sum()), np.uint64), words.row[at[kept]], inner[kept]

    return pick


def _starts(positions: list[bytes], n: int, window: int, period: int) -> np.ndarray:
    """Where the windows start that hold one of the anchors within their first ``period`` words."""
    near = np.zeros(n + 1, np.int32)
    at = np.unique(np.concatenate([np.frombuffer(x, np.int32) for x in positions]))
    np.add.at(near, np.maximum(at - period + 1, 0), 1)
    np.add.at(near, np.minimum(at + 1, n), -1)
    return np.flatnonzero(np.cumsum(near)[: max(0, n - window + 1)] > 0)


def _candidates(window: int, period: int):
    """The windows around shared anchors, whole: by a hash of their words with one space between."""

    def pick(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        digests, row, at = [], [], []
        for i, (text, positions) in enumerate(zip(part.column("text").to_pylist(), part.column("positions").to_pylist(), strict=True)):
            split = text.encode().split()
            starts = _starts(positions, len(split), window, period)
            line, ends = b" ".join(split), np.cumsum([len(w) + 1 for w in split])
            begins = np.concatenate([[0], ends[:-1]])
            for s in starts.tolist():
                digests.append(hashlib.blake2b(line[begins[s] : ends[s + window - 1] - 1], digest_size=16).digest())
            row.append(np.full(len(starts), i))
            at.append(starts)
        both = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
        return both[:, 0], both[:, 1], np.concatenate(row), np.concatenate(at)

    return pick


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        split = [x.encode().split() for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("digest"),
                pa.array([len(x) for x in split], pa.int64()),
                pa.array([hashlib.sha256(b" ".join(x)).hexdigest() for x in split]),
            ],
            ["id", "digest", "n_words", "sha"],
        )


def _cut(window: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _with_text(whole)):
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("digest", "text", "positions"))
            for digest, text, positions in zip(*columns, strict=True):
                words = text.encode().split()
                change = np.zeros(len(words) + 1, np.int32)
                at = np.unique(np.concatenate([np.frombuffer(x, np.int32) for x in positions]))
                change[at] += 1
                np.add.at(change, at + window, -1)
                left = np.cumsum(change)[: len(words)] == 0
                kept = b" ".join(w for w, k in zip(words, left, strict=True) if k)
                rows.append((digest, int(len(words) - left.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if keep_text else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.string(), pa.string()))],
                ["digest", "n_removed", "kept_sha", "kept"],
            )

    return run


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    period: int = PERIOD,
    cover: tuple[int, ...] = COVER,
    keep_text: bool = True,
) -> DataFrame:
    """One row per document: (<id>, n_words, n_removed, kept_sha256[, kept]).

    A word is removed if it lies in a window of ``window`` words that also starts in a document with a
    smaller id; kept words are joined by a space. ``kept`` (with ``keep_text``) is the text that is
    left, null where nothing is removed or nothing is left to tell: the text's own words then hold.

    Ids are integers. Windows are judged on the input. Texts that are equal are compared once, for
    the least of their ids; the others lose all words (if they have ``window`` words). Null text has
    no words. A null id counts as the largest. Rows with equal ids do not take words from each
    other, as neither is smaller. Very long texts are handled whole. Other columns are not looked at.
    An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.unhex(F.md5(text)).alias("digest"))
    summary = materialise(source.mapInArrow(_summary, "id long, digest binary, n_words long, sha string"))
    n_words = summary.agg(F.sum("n_words")).first()[0] or 0
    parts = int(max(LEAST_PARTS, n_words // PART_WORDS))
    # The documents to compare, one per distinct text, numbered. Copies combine before the shuffle.
    packed = source.mapInArrow(_squeeze, "id long, digest binary, packed binary")
    distinct = packed.groupBy("digest").agg(F.min("id").alias("least"), F.first("packed").alias("packed"))
    texts = materialise(distinct.withColumn("owner", F.monotonically_increasing_id()))
    owner = F.col("owner")
    shared = _found(texts.select(owner.alias("rank"), "owner", "packed"), _anchors(window, period, cover), parts, False)
    near = materialise(texts.join(materialise(shared), "owner"))
    rank = F.coalesce("least", F.lit(_LAST)).alias("rank")
    repeated = _found(near.select(rank, "owner", "packed", "positions"), _candidates(window, period), parts, True)
    removed = materialise(
        near.drop("positions")
        .join(materialise(repeated), "owner")
        .select("digest", "packed", "positions")
        .mapInArrow(_cut(window, keep_text), "digest binary, n_removed long, kept_sha string, kept string")
    )
    out = summary.join(texts.select("digest", "least"), "digest").join(removed, "digest", "left")
    smaller = (F.col("least") < F.col("id")) | (F.col("id").isNull() & F.col("least").isNotNull())
    copy = smaller & (F.col("n_words") >= window)
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        *([F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept")] if keep_text else []),
    )
