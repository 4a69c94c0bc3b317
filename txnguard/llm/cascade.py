"""URL filters: exact membership in a list of keys by a cascade of Bloom filters.

The first filter encodes the listed keys. Over the complete set of keys that occur, some others pass
it; the second filter encodes these. The listed keys that pass the second are encoded by the third,
and so on until nothing passes wrongly. A key that occurs is then judged without error by walking the
levels, with a few bits per key and no join. All expressions are Spark's own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.session import materialise

#: Levels travel to all tasks, so the sum of their sizes is bounded; beyond it keys are joined.
MOST_WORDS = 1 << 21


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _tails(host: Column) -> Column:
    """A host and all domains that it is a subdomain of."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def keys_of(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """The keys of a URL that a rule may list: the domains of so many labels, each with the beginnings of
    the path that are so long."""
    domains = F.filter(_tails(host), lambda d: F.array_contains(F.lit(labels), F.size(F.split(d, r"\.", -1))))
    begins = F.filter(F.lit(lengths), lambda n: n <= F.length(path))
    return F.flatten(F.transform(domains, lambda d: F.transform(begins, lambda n: F.concat(d, F.substring(path, F.lit(1), n)))))


@dataclass
class Level:
    words: DataFrame  # one row: an array of longs
    bits: int
    hashes: int


@dataclass
class Cascade:
    levels: list[Level]
    #: Whether a key that passes all levels is listed.
    last: bool
    #: The listed keys, for the case that the levels would be too large.
    listed: DataFrame | None = None


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    # The level comes first: keys that collide at one level then do not at the next.
    return [F.pmod(F.xxhash64(F.lit(level * 64 + i), key), F.lit(bits)) for i in range(hashes)]


def _passes(level: Level, number: int, key: Column) -> Column:
    words = level.words.scalar()
    out = F.lit(True)
    for at in _positions(key, number, level.bits, level.hashes):
        word = F.get(words, F.shiftright(at, 6).cast("int"))
        out &= F.call_function("getbit", word, (at % 64).cast("int")) == 1
    return out


def _encode(keys: DataFrame, number: int, bits: int, hashes: int) -> Level:
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), number, bits, hashes))).alias("at"))
    one = F.expr("shiftleft(1L, CAST(at % 64 AS INT))")
    words = at.groupBy(F.shiftright("at", 6).alias("id")).agg(F.bit_or(one).alias("word"))
    n = (bits + 63) // 64
    every = keys.sparkSession.range(n).join(words, "id", "left")
    pairs = F.sort_array(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0)).alias("word"))))
    return Level(materialise(every.agg(F.transform(pairs, lambda p: p["word"]).alias("words"))), bits, hashes)


def build(listed: DataFrame, universe: DataFrame, most_words: int = MOST_WORDS) -> Cascade:
    """The cascade for ``listed`` over ``universe``, each with a column ``key``.

    Listed keys outside the universe are left out: nothing asks for them. Null keys are never listed.
    Repeated keys count once. An empty list gives a cascade that lists nothing.
    """
    inside = materialise(universe.select("key").where("key IS NOT NULL").distinct().join(listed.select("key").distinct(), "key", "left_semi"))
    n_inside = inside.count()
    if not n_inside:
        return Cascade([], False)
    outside = materialise(universe.select("key").where("key IS NOT NULL").distinct().join(inside, "key", "left_anti"))
    n_outside = outside.count()
    encoded, others, sizes = inside, outside, [n_inside, n_outside]
    levels: list[Level] = []
    words = 0
    while sizes[0]:
        # The first filter is as strict as pays off; each later one lets half pass.
        rate = min(0.5, sizes[0] / max(1, sizes[1]) / math.sqrt(2)) if not levels else 0.5
        hashes = max(1, round(-math.log2(rate)))
        bits = max(64, math.ceil(sizes[0] * -math.log(rate) / math.log(2) ** 2))
        words += (bits + 63) // 64
        if words > most_words:
            return Cascade([], False, inside)
        levels.append(_encode(encoded, len(levels), bits, hashes))
        passed = materialise(others.where(_passes(levels[-1], len(levels) - 1, F.col("key"))))
        encoded, others, sizes = passed, encoded, [passed.count(), sizes[0]]
    return Cascade(levels, len(levels) % 2 == 1)


def mark(df: DataFrame, key: str, cascade: Cascade, name: str = "listed") -> DataFrame:
    """Adds whether ``key`` is listed; for keys of the universe this is exact. Null is not listed."""
    if cascade.listed is not None:
        marked = cascade.listed.withColumnRenamed("key", "_listed_key")
        joined = df.join(marked, F.col(key) == F.col("_listed_key"), "left")
        return joined.withColumn(name, F.col("_listed_key").isNotNull()).drop("_listed_key")
    answer = F.lit(cascade.last)
    for number in reversed(range(len(cascade.levels))):
        # Not passing an odd level means listed: it encodes what is not.
        answer = F.when(_passes(cascade.levels[number], number, F.col(key)), answer).otherwise(F.lit(number % 2 == 1))
    return df.withColumn(name, F.col(key).isNotNull() & answer)


def judge(pages: DataFrame, rules: list[Rule] | DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(<id>, host, path, rule, listed, verdict) of each row.

    The rules' keys are listed in a cascade over all keys that the table's URLs can be listed by, and
    those that block in a second one over the listed keys. A URL's keys are asked for one by one; the
    longest listed one is its rule (of equally long ones the greater), and decides. A URL without one is
    not listed, and allowed. A null URL, or one without ``://``, has an empty host and path. Of rules with
    the same key, one that blocks counts. Repeated rows are judged each for itself; other columns are not
    looked at; an empty table gives no rows. ``rules`` may be a table (verdict, host, path) of any length.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        listed = [F.struct(*[F.lit(x).alias(c) for c, x in (("verdict", r.verdict), ("host", r.host), ("path", r.path))]) for r in rules]
        rules = spark.range(1).select(F.inline(F.array(*listed).cast("array<struct<verdict:string,host:string,path:string>>")))
    named = materialise(rules.select("verdict", F.concat("host", "path").alias("key"), F.size(F.split("host", r"\.", -1)).alias("labels"), F.length("path").alias("length")))
    labels, lengths = (sorted(r[0] for r in named.select(c).distinct().collect()) for c in ("labels", "length"))
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    parsed = pages.select(F.monotonically_increasing_id().alias("at"), F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    keys = keys_of(F.col("host"), F.col("path"), labels, lengths) if labels else F.array().cast("array<string>")
    asked = parsed.withColumn("key", F.explode_outer(keys))
    universe = materialise(asked.select("key").distinct())
    listed = build(named.select("key"), universe)
    blocked = build(named.where("verdict = 'block'").select("key"), named.select("key").distinct())
    told = mark(mark(asked, "key", listed), "key", blocked, "blocked")
    best = F.max(F.when(F.col("listed"), F.struct(F.length("key").alias("n"), "key", "blocked"))).alias("best")
    # A row's keys lie together, so each task sends one row for it.
    rows = told.groupBy("at", "id", "host", "path").agg(best)
    verdict = F.when(F.col("best.blocked"), "block").otherwise("allow")
    return rows.select(
        F.col("id").alias(id_col), "host", "path", F.col("best.key").alias("rule"), F.col("best").isNotNull().alias("listed"), verdict.alias("verdict")
    )
