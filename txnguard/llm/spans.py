"""Personal data: exact patterns, and further spans by a semi-Markov conditional random field.

The patterns find what is written by the book. The field scores whole candidate spans by features of
the span (digit groups, separators, what stands around it, checksums), and dynamic programming over
spans of bounded length chooses boundaries and kinds together. It is trained on the patterns' own
finds in a sample, without features that would only repeat the patterns, so that it also finds spans
of the same make that a pattern misses. What the patterns find always stays.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.llm.sampling import thinned

KINDS = ("email", "ip", "card", "phone")
#: Atoms of the longest entity, of a piece that a long region is judged in, and the least marginal of a
#: span that is added.
MOST_ATOMS, PIECE, SURE = 24, 400, 0.75
#: The fit looks at this many texts at most, none longer than MAX_CHARS, and as many regions at most.
SAMPLE_DOCS, MAX_CHARS, SAMPLE_REGIONS = 1500, 20_000, 1500

# Possessive quantifiers and a fixed start keep each search linear in the text.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HOT = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_ATOM = re.compile(r"[0-9]+|[A-Za-z]+|[^\x00-\x7f]+|.", re.DOTALL)
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def small(number: str) -> bool:
    """At most 255, with any number of leading zeros."""
    number = number.lstrip("0")
    return len(number) < 3 or (len(number) == 3 and number <= "255")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the run of local characters before it and a domain after it. A run holds no @, so a
    match can only begin where a run does, and no run is read twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that do not overlap within it, less those that fail its check."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", s, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(map(small, m[0].split("."))):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start():
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGIT.findall(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Runs of words with a digit or @, one space between them: only they can hold an entity."""
    open_: list[int] | None = None
    m = _HOT.search(text)
    while m:
        floor = open_[1] if open_ else 0
        start = m.start()
        while start > floor and not _SPACE.match(text, start - 1):
            start -= 1
        gap = _SPACE.search(text, m.end())
        end = gap.start() if gap else len(text)
        if open_ and start == open_[1] + 1 and text[open_[1]] == " ":
            open_[1] = end
        else:
            if open_:
                yield open_[0], open_[1]
            open_ = [start, end]
        m = _HOT.search(text, end)
    if open_:
        yield open_[0], open_[1]


def _side(c: str) -> str:
    if not c:
        return "none"
    return "digit" if c.isdigit() else "letter" if c.isalpha() else "space" if c.isspace() else c


def candidates(atoms: list[str]) -> list[tuple[int, int]]:
    """Spans of atoms that begin and end like an entity and have an @, or at least seven digits, or four
    numbers with dots between them."""
    out = []
    n = len(atoms)
    good_end = [a[0].isascii() and a[0].isalnum() for a in atoms]
    for i in range(n):
        if not (good_end[i] or atoms[i] in "+("):
            continue
        digits, dots, at = 0, 0, False
        for j in range(i + 1, min(n, i + MOST_ATOMS) + 1):
            a = atoms[j - 1]
            at |= a == "@"
            digits += len(a) if a[0] in "0123456789" else 0
            dots += a == "."
            if good_end[j - 1] and (at or 7 <= digits <= 24 or (dots == 3 and digits >= 4 and j - i == 7)):
                out.append((i, j))
    return out


def span_features(atoms: list[str], i: int, j: int, left: str, right: str) -> list[str]:
    """What is told of a candidate as a whole. A leading + is not told: phones come without it too."""
    part = atoms[i:j]
    numbers = [a for a in part if a[0] in "0123456789"]
    digits = "".join(numbers)
    size = next((top for top in (9, 12, 15, 16, 19) if len(digits) <= top), 99)
    marks = sorted({a for a in part if not (a[0].isascii() and a[0].isalnum())} - {"+"})
    shapes = ["d" + str(min(len(a), 5)) if a[0] in "0123456789" else "a" if a.isascii() and a.isalpha() else a[:1] for a in part if a != "+"]
    before = atoms[i - 1][-1] if i else left
    after = atoms[j][0] if j < len(atoms) else right
    at = part.index("@") if "@" in part else -1
    quad = len(part) == 7 and len(numbers) == 4 and part.count(".") == 3
    return [
        "bias",
        f"digits {size}",
        f"groups {min(len(numbers), 6)}",
        f"marks {''.join(marks)[:8]}",
        f"tail {''.join(shapes[-3:])}",
        f"long tail {''.join(shapes[-5:])}",
        f"head {shapes[0]}",
        f"ends {shapes[-1][0]}",
        f"at {part.count('@')} first {at == 0} dotted {at >= 0 and '.' in part[at:]}",
        f"before {_side(before)}",
        f"after {_side(after)}",
        f"quad {quad} {quad and all(map(small, numbers))}",
        f"check {14 <= len(digits) <= 19 and luhn(digits)} {at >= 0}",
    ]


@dataclass
class Model:
    number: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1, len(KINDS))))


@dataclass
class Lattice:
    """A region's atoms, candidates and their feature numbers."""

    size: int
    pairs: list[tuple[int, int]]
    features: np.ndarray


def lattice(number: dict[str, int], atoms: list[str], left: str, right: str, grow: bool = False) -> Lattice:
    pairs = candidates(atoms)
    rows = []
    for i, j in pairs:
        names = span_features(atoms, i, j, left, right)
        # Number 0 is for what was not seen in training; it has no weight.
        rows.append([number.setdefault(x, len(number) + 1) if grow else number.get(x, 0) for x in names])
    return Lattice(len(atoms), pairs, np.array(rows, np.int64) if rows else np.zeros((0, 1), np.int64))


def marginals(grid: Lattice, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Of each candidate and kind the probability that it is an entity, by forward and backward sums
    over all ways to cut the region; the log of the total. An atom outside entities scores nothing."""
    scores = weights[grid.features].sum(axis=1) if len(grid.pairs) else np.zeros((0, len(KINDS)))
    n = grid.size
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    beginning: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (i, j) in enumerate(grid.pairs):
        ending[j].append(k)
        beginning[i].append(k)
    top = np.clip(scores, -60, 60)
    each = np.log(np.exp(top).sum(axis=1)) if len(grid.pairs) else np.zeros(0)
    forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        forward[j] = _sum([forward[j - 1], *(forward[grid.pairs[k][0]] + each[k] for k in ending[j])])
    for i in range(n - 1, -1, -1):
        backward[i] = _sum([backward[i + 1], *(backward[grid.pairs[k][1]] + each[k] for k in beginning[i])])
    outer = np.array([forward[i] + backward[j] - forward[n] for i, j in grid.pairs])
    return np.exp(outer[:, None] + top) if len(grid.pairs) else scores, forward[n]


def _sum(values: list[float]) -> float:
    most = max(values)
    return most + math.log(sum(math.exp(v - most) for v in values))


def decode(grid: Lattice, weights: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The best way to cut the region: (first atom, end, kind, candidate) of its entities."""
    if not grid.pairs:
        return []
    scores = weights[grid.features].sum(axis=1)
    kind, best_score = scores.argmax(axis=1), scores.max(axis=1)
    best: list[float] = [0.0] * (grid.size + 1)
    back: list[int] = [-1] * (grid.size + 1)
    ending: list[list[int]] = [[] for _ in range(grid.size + 1)]
    for k, (_, j) in enumerate(grid.pairs):
        ending[j].append(k)
    for j in range(1, grid.size + 1):
        best[j] = best[j - 1]
        for k in ending[j]:
            value = best[grid.pairs[k][0]] + best_score[k]
            if value > best[j]:
                best[j], back[j] = value, k
    out, j = [], grid.size
    while j:
        if back[j] >= 0:
            i = grid.pairs[back[j]][0]
            out.append((i, j, int(kind[back[j]]), back[j]))
            j = i
        else:
            j -= 1
    return out[::-1]


def _worth(region: str) -> bool:
    return "@" in region or len(_DIGIT.findall(region)) >= 7 or region.count(".") >= 3


def fit(texts: list[str], rounds: int = 40) -> Model:
    """Trains on the patterns' finds: in each region the candidates that they make are entities, all
    else is not. Of finds that overlap the longest counts."""
    number: dict[str, int] = {}
    grids: dict[tuple[str, str, str], tuple[Lattice, np.ndarray]] = {}
    for text in texts:
        spans = sorted(base_spans(text), key=lambda s: s[1] - s[2])
        for start, end in regions(text):
            region, left, right = text[start:end], text[max(0, start - 1) : start], text[end : end + 1]
            key = (_side(left), region, _side(right))
            if key in grids or not _worth(region) or end - start > 400 or len(grids) >= SAMPLE_REGIONS:
                continue
            atoms = _ATOM.findall(region)
            grid = lattice(number, atoms, left, right, grow=True)
            at = np.cumsum([0, *map(len, atoms)]) + start
            where = {(int(at[i]), int(at[j])): k for k, (i, j) in enumerate(grid.pairs)}
            target = np.zeros((len(grid.pairs), len(KINDS)))
            taken: list[tuple[int, int]] = []
            for kind, s, e in spans:
                if start <= s and e <= end and (s, e) in where and all(e <= a or b <= s for a, b in taken):
                    target[where[s, e], KINDS.index(kind)] = 1
                    taken.append((s, e))
            if grid.pairs:
                grids[key] = grid, target
    weights = np.zeros((len(number) + 1, len(KINDS)))
    squares = np.full_like(weights, 1e-6)
    for _ in range(rounds):
        grad = -0.05 * weights
        for grid, target in grids.values():
            p, _ = marginals(grid, weights)
            np.add.at(grad, grid.features, (target - p)[:, None, :])
        grad[0] = 0
        squares += grad**2
        weights += 0.5 * grad / np.sqrt(squares)
    return Model(number, weights)


def train(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE_DOCS) -> Model:
    """A model from at most ``sample`` texts of up to MAX_CHARS characters that hold digits or an @; which
    ones is decided by a hash of the text, so reruns agree. Of these texts the first SAMPLE_REGIONS
    different regions of up to 400 characters are learned from. Without such texts nothing is added."""
    text = F.col(text_col).cast("string")
    useful = docs.select(text.alias("text"), F.xxhash64(text).alias("h")).where(
        (F.length("text") <= MAX_CHARS) & F.col("text").rlike("@|[0-9][0-9 .()-]{5,}")
    )
    few = thinned(useful, useful.count(), sample)
    rows = few.groupBy("h").agg(F.min("text").alias("text")).orderBy("h").limit(sample).collect()
    return fit([r["text"] for r in rows])


def added_spans(text: str, base: list[Span], judge) -> list[Span]:
    """The field's spans that overlap none of the patterns'."""
    out: list[Span] = []
    for start, end in regions(text):
        region = text[start:end]
        if not _worth(region):
            continue
        for kind, i, j in judge(_side(text[max(0, start - 1) : start]), region, _side(text[end : end + 1])):
            s, e = start + i, start + j
            if all(e <= b[1] or b[2] <= s for b in base):
                out.append((kind, s, e))
    return out


def judge_with(model: Model):
    """Entities of a region, (kind, start, end); regions that occur again are remembered."""

    @lru_cache(maxsize=20_000)
    def judge(left: str, region: str, right: str) -> tuple[Span, ...]:
        out = []
        atoms = _ATOM.findall(region)
        at = np.cumsum([0, *map(len, atoms)])
        # Long regions in pieces that reach into the next one by the longest entity. What begins in a
        # piece is told there, and the next piece begins where that ends.
        begin = 0
        while begin < len(atoms):
            core = begin + PIECE
            stop = min(len(atoms), core + MOST_ATOMS)
            before, after = left if not begin else atoms[begin - 1][-1], right if stop == len(atoms) else atoms[stop][0]
            grid = lattice(model.number, atoms[begin:stop], before, after)
            found = [x for x in decode(grid, model.weights) if begin + x[0] < core]
            if found:
                p, _ = marginals(grid, model.weights)
                out += [(KINDS[kind], int(at[begin + i]), int(at[begin + j])) for i, j, kind, k in found if p[k, kind] >= SURE]
            begin = max(core, begin + found[-1][1] if found else 0)
        return tuple(out)

    return judge


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])


def _find(model, replace: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = judge_with(model.value)
        for batch in batches:
            for first in range(0, len(batch), 500):
                part = batch.slice(first, 500)
                found, texts = [], []
                for text in part.column(1).to_pylist():
                    base = base_spans(text) if _HOT.search(text) else []
                    more = added_spans(text, base, judge)
                    spans = in_order(base + more)
                    # A pattern's find and an added one are never the same span.
                    kept = set(base)
                    found.append([{"kind": k, "start": s, "end": e, "base": (k, s, e) in kept} for k, s, e in spans])
                    texts.append(masked(text, spans) if replace else None)
                columns = [part.column(0), pa.array(found, pa.list_(_SPAN)), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "spans", "masked"])

    return run


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of spans that overlap, replaced by the first one's kind."""
    out, at, k = [], 0, 0
    while k < len(spans):
        kind, start, end = spans[k]
        while k + 1 < len(spans) and spans[k + 1][1] < end:
            k += 1
            end = max(end, spans[k][2])
        out += [text[at:start], f"<{kind.upper()}>"]
        at = end
        k += 1
    return "".join([*out, text[at:]])


def find(docs: DataFrame, model: Model, text_col: str = "text", replace: bool = False) -> DataFrame:
    """(row, spans, masked): ``row`` holds all columns of ``docs``; spans are (kind, start, end, base) in
    code points, in order of start and then of kind; ``masked`` is the text with spans replaced by
    their kind in angle brackets (null unless ``replace``).

    The patterns search every whole text; the field adds spans that overlap none of theirs. Null text
    is empty. Repeated rows are judged each for itself. No rows give no rows.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    extra = T._parse_datatype_string("spans array<struct<kind:string,start:int,end:int,base:boolean>>, masked string")
    return packed.mapInArrow(_find(shared, replace), T.StructType([packed.schema["row"], *extra.fields]))


def mask(docs: DataFrame, model: Model, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with personal data replaced in the text, and ``length_col`` set to the new length in code
    points. Null texts stay null; all columns are kept."""
    found = find(docs, model, text_col, replace=True)
    text = F.when(F.col(f"row.`{text_col}`").isNotNull(), F.col("masked"))
    new = {text_col: text}
    if length_col:
        new[length_col] = F.when(text.isNotNull(), F.length(text)).otherwise(F.col(f"row.`{length_col}`")).cast(docs.schema[length_col].dataType)
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
