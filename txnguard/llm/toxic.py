"""Toxic spans by a linear-chain conditional random field over words, and document scores from them.

A word is described by hashed features: itself, its beginnings and endings, the words beside it. The
field has two states; their forward-backward marginals say for each word how likely it is toxic.
Labels are per document, so words are labelled first: in toxic documents those whose word or
beginning is more frequent there than chance allows, then the best words of what is left. A document's score comes from its largest
marginal and the expected number of toxic words, by a logistic fit to the document labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.llm.sampling import thinned
from txnguard.llm.words import ALPHANUMERIC, LOWER, Words, column_bytes, find_words, mix, row_slices

BITS = 18
AFFIXES = (3, 4, 5, 6, -3, -4)
#: Words are tagged in chains of CORE, each with REACH words of context on both sides.
CORE, REACH = 256, 24
#: The fit looks at this many labelled documents of either label at most, none longer than MAX_CHARS.
SAMPLE, MAX_CHARS = 1200, 20_000
#: A telling word lies in so many toxic rows at least; of those found by the first test, which share may
#: be so by chance; how often rows without a toxic word are looked at again.
LEAST, FALSE, ROUNDS = 4, 0.01, 8


@dataclass
class Model:
    weights: np.ndarray  # by feature
    change: np.ndarray  # log potentials of (state before, state)
    document: np.ndarray  # bias, weights of the two document features


def features(words: Words) -> np.ndarray:
    """Feature numbers, one row per kind."""
    kinds = [words.hash, *words.affixes]
    before = np.concatenate([[np.uint64(1)], words.hash[:-1]]) if len(words.hash) else words.hash
    after = np.concatenate([words.hash[1:], [np.uint64(1)]]) if len(words.hash) else words.hash
    first = words.first[words.counts > 0]
    before[first] = 1
    if len(after):
        after[(words.first + words.counts - 1)[words.counts > 0]] = 1
    kinds += [before, after]
    shift = np.uint64(64 - BITS)
    return np.stack([(mix(x + np.uint64(k * 7919 + 1)) >> shift).astype(np.int32) for k, x in enumerate(kinds)])


def chains(words: Words) -> tuple[np.ndarray, ...]:
    """Cuts rows into chains: (first word, number of words, first and end of the core)."""
    n = (words.counts + CORE - 1) // CORE
    row = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    core = words.first[row] + k * CORE
    core_end = np.minimum(core + CORE, (words.first + words.counts)[row])
    start = np.maximum(core - REACH, words.first[row])
    end = np.minimum(core_end + REACH, (words.first + words.counts)[row])
    return start, end - start, core, core_end


def marginals(score: np.ndarray, change: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each word the probability of the toxic state; expected counts of state changes.

    ``score`` is the log potential of toxic against clean of each word.
    """
    out = np.zeros(len(score))
    pairs = np.zeros((2, 2))
    start, length, core, core_end = chains(words)
    step = np.exp(np.clip(change, -30, 30))
    order = np.argsort(length)
    for part in np.array_split(order, max(1, len(order) // 4096)):
        if not len(part):
            continue
        s, n = start[part], length[part]
        width = int(n.max())
        at = np.minimum(s + np.arange(width)[:, None], len(score) - 1)
        inside = np.arange(width)[:, None] < n
        odds = np.where(inside, np.exp(np.clip(score[at], -30, 30)), 1.0)
        forward = np.empty((width, 2, len(part)))
        a, b = np.full(len(part), 0.5), 0.5 * odds[0]
        for t in range(width):
            if t:
                a, b = (
                    a * step[0, 0] + b * step[1, 0],
                    (a * step[0, 1] + b * step[1, 1]) * odds[t],
                )
            total = a + b
            a, b = a / total, b / total
            forward[t, 0], forward[t, 1] = a, b
        back0 = back1 = np.ones(len(part))
        p = np.empty((width, len(part)))
        for t in range(width - 1, -1, -1):
            zero, one = forward[t, 0] * back0, forward[t, 1] * back1
            p[t] = one / (zero + one)
            if t:
                ahead = odds[t] * back1
                f0, f1 = forward[t - 1]
                each = [[f0 * step[0, 0] * back0, f0 * step[0, 1] * ahead], [f1 * step[1, 0] * back0, f1 * step[1, 1] * ahead]]
                norm = np.where(inside[t], 1 / (each[0][0] + each[0][1] + each[1][0] + each[1][1]), 0)
                pairs += [[(x * norm).sum() for x in r] for r in each]
                n0 = step[0, 0] * back0 + step[0, 1] * ahead
                n1 = step[1, 0] * back0 + step[1, 1] * ahead
                # Past a chain's end nothing is known of what follows.
                total = n0 + n1
                back0 = np.where(inside[t], n0 / total, 1.0)
                back1 = np.where(inside[t], n1 / total, 1.0)
        kept = inside & (at >= core[part]) & (at < core_end[part])
        out[at[kept]] = p[kept]
    return out, pairs


def read(texts: pa.Array) -> Words:
    return find_words(texts, ALPHANUMERIC, LOWER, AFFIXES)


def _score(model_weights: np.ndarray, found: np.ndarray) -> np.ndarray:
    return sum((model_weights[x] for x in found), np.zeros(found.shape[1]))


def document_features(p: np.ndarray, words: Words) -> np.ndarray:
    """Of each row: the largest log odds of a word, and the log of 1 + expected toxic words."""
    n = len(words.counts)
    top = np.full(n, 1e-6)
    np.maximum.at(top, words.row, np.clip(p, 1e-6, 1 - 1e-6))
    count = np.bincount(words.row, np.where(p > 0.05, p, 0), n)
    return np.stack([np.ones(n), np.log(top / (1 - top)), np.log1p(count)], axis=1)


def word_labels(words: Words, found: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which words of the toxic rows are toxic: those with a telling word or beginning.

    Telling is first what is so much more frequent in toxic rows that chance would hardly do it, given
    how many are tried. A toxic row has some toxic word, so rows without any are then explained, in a
    few rounds, by their best words: those that are best in several such rows. How large a share of the
    toxic rows has a word does not matter.
    """
    kinds = [k for k in range(1 + len(AFFIXES)) if k == 0 or AFFIXES[k - 1] > 3]  # three bytes tell too little
    pairs = [np.unique(words.row * np.int64(1 << BITS) + found[k]) for k in kinds]
    clean = [np.bincount(x[~toxic[x >> BITS]] & ((1 << BITS) - 1), minlength=1 << BITS) for x in pairs]
    n_neg = (~toxic).sum()
    label = np.zeros(len(words.hash), bool)
    left = toxic.copy()
    for n in range(ROUNDS):
        share = left.sum() / (left.sum() + n_neg)
        gains, new = [], np.zeros(len(label), bool)
        for k, x, neg in zip(kinds, pairs, clean, strict=True):
            pos = np.bincount(x[left[x >> BITS]] & ((1 << BITS) - 1), minlength=1 << BITS)
            odds = np.log((pos + 0.5) / (left.sum() + 1)) - np.log((neg + 0.5) / (n_neg + 1))
            # Minus the log of a bound (Chernoff) on the chance of so many toxic among pos + neg rows.
            gain = pos * np.log(np.maximum(pos, 1) / np.maximum((pos + neg) * share, 1e-9))
            gain += neg * np.log(np.maximum(neg, 1) / np.maximum((pos + neg) * (1 - share), 1e-9))
            gain[(pos < LEAST) | (odds <= 2)] = 0
            gains.append(gain[found[k]])
            if n == 0:
                # False discoveries are bounded (Benjamini and Hochberg).
                order = np.argsort(-gain)
                tried = np.arange(1, len(order) + 1) / max(1, (pos + neg >= LEAST).sum())
                good = np.flatnonzero((gain[order] > 0) & (np.exp(-gain[order]) <= FALSE * tried))
                telling = np.zeros(1 << BITS, bool)
                telling[order[: good[-1] + 1 if len(good) else 0]] = True
                new |= telling[found[k]]
        if n:
            gain = np.max(gains, axis=0)
            top = np.zeros(len(toxic))
            np.maximum.at(top, words.row, gain)
            best = left[words.row] & (gain > 0) & (gain == top[words.row])
            at = np.flatnonzero(best)
            pair = np.unique(words.row[at] * np.int64(1 << BITS) + found[0][at])
            support = np.bincount(pair & ((1 << BITS) - 1), minlength=1 << BITS)
            new = (support >= LEAST)[found[0]]
        new &= toxic[words.row] & ~label
        label |= new
        left[words.row[new]] = False
        if n and not new.any() or not left.any():
            break
    return label


def fit(texts: list[str], toxic: np.ndarray, weight: np.ndarray, rounds: int = 40) -> Model:
    """Fits words, then documents. ``weight`` is how many labelled documents each one stands for."""
    words = read(pa.array(texts, pa.string()))
    found = features(words)
    label = word_labels(words, found, toxic) if toxic.any() and not toxic.all() else np.zeros(len(words.hash), bool)
    weights = np.zeros(1 << BITS)
    change = np.zeros((2, 2))
    seen = np.zeros((2, 2))
    if len(label):
        same = np.zeros(len(label), bool)
        same[1:] = words.row[1:] == words.row[:-1]
        at = np.flatnonzero(same)
        np.add.at(seen, (label[at - 1].astype(int), label[at].astype(int)), 1)
    if label.any():
        squares, change_squares = np.full(1 << BITS, 1e-8), np.full((2, 2), 1e-8)
        for _ in range(rounds):
            p, pairs = marginals(_score(weights, found), change, words)
            left = label - p
            grad = sum(np.bincount(x, left, 1 << BITS) for x in found) - 0.3 * weights
            squares += grad**2
            weights += 0.5 * grad / np.sqrt(squares)
            grad = seen - pairs - change
            change_squares += grad**2
            change += 0.5 * grad / np.sqrt(change_squares)
    p, _ = marginals(_score(weights, found), change, words)
    x = document_features(p, words)
    document = np.zeros(3)
    y = toxic.astype(float)
    w = weight / max(weight.sum(), 1e-9)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ document, -30, 30)))
        grad = x.T @ (w * (y - q)) - 1e-4 * document
        hess = (x * (w * q * (1 - q))[:, None]).T @ x + 1e-4 * np.eye(3)
        document = document + np.linalg.solve(hess, grad)
    # A score must not fall as more is found.
    document[1:] = np.maximum(document[1:], 0)
    return Model(weights.astype(np.float32), change, document)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str, sample: int) -> tuple[list, np.ndarray, np.ndarray]:
    """At most ``sample`` labelled documents of either label, and what each stands for.

    Which ones is decided by a hash of the text, so reruns agree; equal texts count once.
    """
    known = labels.where(f"`{label_col}` IN (0, 1)").select(
        F.col(label_id).alias("id"), F.col(label_col).cast("int").alias("toxic")
    )
    count = dict(known.groupBy("toxic").count().collect())
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).alias("id"), text.alias("text")).where(F.length("text") <= MAX_CHARS)
    texts, toxic, weight = [], [], []
    for label in (0, 1):
        total = count.get(label, 0)
        # Twice the sample by hash of the id, as some are dropped; few enough to be broadcast.
        these = known.where(F.col("toxic") == label).withColumn("h", F.xxhash64("id"))
        some = thinned(these, total, 2 * sample).distinct().orderBy("h", "id").limit(2 * sample).drop("h")
        rows = (
            source.join(F.broadcast(some), "id")
            .groupBy(F.xxhash64("text").alias("h"))
            .agg(F.min("text").alias("text"))
            .orderBy("h")
            .limit(sample)
            .collect()
        )
        texts += [r["text"] for r in rows]
        toxic += [bool(label)] * len(rows)
        weight += [total / max(1, len(rows))] * len(rows)
    return texts, np.array(toxic, bool), np.array(weight)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from documents and labels (0 or 1; other labels and null ids are not used).

    Fitted on at most ``sample`` documents of either label of at most 20,000 characters each, which
    bounds what the driver holds. Without labels of both kinds no word is toxic.
    """
    return fit(*training_rows(docs, labels, id_col, text_col, label_id, label_col, sample))


def _tag(model, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = model.value
        for batch in batches:
            for first, last in row_slices(batch.column(1), 1 << 21):
                part = batch.slice(first, last - first)
                words = read(part.column(1))
                p, _ = marginals(_score(own.weights, features(words)), own.change, words)
                z = document_features(p, words) @ own.document
                columns = [part.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))]
                columns.append(_spans(part.column(1), words, p) if spans else pa.nulls(len(part), _SPANS))
                yield pa.RecordBatch.from_arrays(columns, ["row", "score", "spans"])

    return run


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))


def _spans(texts: pa.Array, words: Words, p: np.ndarray) -> pa.Array:
    """Runs of words more likely toxic than not, in code points, with their largest marginal."""
    out: list[list[dict]] = [[] for _ in words.counts]
    hot = np.flatnonzero(p > 0.5)
    if len(hot):
        new = np.ones(len(hot), bool)
        new[1:] = (np.diff(hot) > 1) | (words.row[hot[1:]] != words.row[hot[:-1]])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(hot)) - 1
        rows = words.row[hot[first]]
        row_bytes = {r: texts[int(r)].as_py().encode() for r in np.unique(rows)}
        offset = column_bytes(texts)[1]
        for i, j, r in zip(first, last, rows, strict=True):
            a, b = words.start[hot[i]] - offset[r], words.end[hot[j]] - offset[r]
            raw = row_bytes[r]
            start = len(raw[:a].decode())
            out[r].append({"start": start, "end": start + len(raw[a:b].decode()), "p": float(p[hot[i : j + 1]].max())})
    return pa.array(out, _SPANS)


def score(docs: DataFrame, model: Model, text_col: str = "text", spans: bool = True) -> DataFrame:
    """(row, score, spans): ``row`` holds all columns of ``docs``, score is from 0 to 1, spans are the
    toxic ones (start, end, p) in code points (null unless ``spans``).

    Every whole text is tagged, in chains of 256 words with 24 words of context on either side. Null
    or empty texts, and texts without words, get the score of a text in which nothing is found.
    Repeated rows are scored each for itself. No rows give no rows.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [packed.schema["row"], *T._parse_datatype_string("score double, spans array<struct<start:int,end:int,p:double>>").fields]
    )
    return packed.mapInArrow(_tag(shared, spans), schema)


def reject_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without those that score at least ``threshold``; all columns are kept."""
    return score(docs, model, text_col, spans=False).where(F.col("score") < threshold).select("row.*")
