"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions.

Every source should give its weight's share of the mix, but no source is repeated more than a given
number of times. What a clamped source cannot give is shared by the others in proportion to their
weights, until no other has to be clamped. A source's target is met by repeating all its documents
the whole number of times that fits, and a seeded choice of documents once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnguard.session import materialise

SHARE, MAX_EPOCHS, WEIGHTS, SEED = 1.5, 2.0, (3.0, 1.0, 2.0), 17
WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the seeded hash by which a source's documents are dealt to ranges.
RANGE_DIGITS = 3


def cycled_weights(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Adds ``weight`` to a table with one row per ``source``: the given weights in turn, by the
    sources' names in code point order, null last.

    Places are counted within the partitions of a sorted table and shifted by the partitions' sizes,
    so no task sees all sources.
    """
    row = F.monotonically_increasing_id()
    placed = materialise(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("row", row))
    part = F.shiftright("row", 33)
    counts = sorted(placed.groupBy(part.alias("p")).count().collect())
    offset, before = F.lit(0).cast("long"), 0
    for p, n in counts:
        offset = F.when(part == p, F.lit(before)).otherwise(offset)
        before += n
    place = F.col("row") - F.shiftleft(part, 33) + offset
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    return placed.withColumn("weight", weight).drop("row")


def water_fill(sources: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight): what each source gives to a mix of ``share``
    times all sizes, at most ``max_epochs`` times its size.

    Each round fixes the level by which weights are multiplied, from what is clamped at the level
    before; only sums come to the driver. If all are clamped, the mix is smaller than asked for.
    Sources of no size or weight give nothing.
    """
    cap = F.col("source_size") * max_epochs
    total = share * float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level, clamped = 0.0, -1
    while True:
        full = F.col("weight") * level > cap
        sums = sources.agg(
            F.count_if(full),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if sums[0] == clamped or sums[2] <= 0:
            break
        clamped, level = sums[0], (total - sums[1]) / sums[2]
    return sources.withColumn("target", F.least(cap, F.col("weight") * level))


def plan_mix(
    docs: DataFrame,
    carried: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    weights: tuple[float, ...] = WEIGHTS,
    seed: int = SEED,
) -> DataFrame:
    """(row, size, source_size, target, repeats, extra, taken) of each document: ``row`` holds the columns
    ``carried``; size counts words; it is to be taken ``repeats`` times whole and then its first
    ``extra`` words; taken is the number of words in all.

    ``extra`` is the whole document for those that come first in a seeded order of ids within their
    source, part of one document where the target falls inside it, and 0 for the rest, so a source
    gives its target to the word. The order is cut into ranges of the hash, so that a source that
    holds most of the rows is summed in many tasks. Reruns agree.

    Null text has size 0; null is a source of its own; a null id has its place in the order. Rows with
    the same id and size are interchangeable. Other columns may have any name. No rows give no rows.
    """
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    packed = materialise(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), id_text)).alias("order"),
        )
    )
    span = F.substring("order", 1, RANGE_DIGITS).alias("span")
    spans = packed.groupBy("source", span).agg(F.sum("size").alias("span_size"))
    spans = materialise(spans)
    sizes = spans.groupBy("source").agg(F.sum("span_size").alias("source_size"))
    filled = water_fill(cycled_weights(sizes, weights), share, max_epochs)
    # What comes before each range of a source: at most 16 ** RANGE_DIGITS rows a source.
    earlier = Window.partitionBy("source").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("span_size").over(earlier), F.lit(0)).alias("before")
    placed = spans.select("source", "span", before)
    placed = placed.join(filled.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    placed = materialise(placed.withColumnsRenamed({"source": "of", "span": "part"}))
    joined = packed.withColumn("span", span).join(
        placed, F.col("source").eqNullSafe(F.col("of")) & (F.col("span") == F.col("part"))
    )
    inside = Window.partitionBy("source", "span").orderBy("order", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.round("target").cast("long") - F.col("repeats") * F.col("source_size")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("ahead")))
    return (
        joined.withColumn("ahead", ahead)
        .withColumn("repeats", repeats.cast("long"))
        .withColumn("rest", rest)
        .withColumn("extra", extra.cast("long"))
        .select("row", "size", "source_size", "target", "repeats", "extra", (F.col("repeats") * F.col("size") + F.col("extra")).alias("taken"))
    )


def expand(plan: DataFrame, text_col: str = "text") -> DataFrame:
    """The mix itself: each planned row as often as it is repeated whole (``part`` 0, 1, ..), and once
    with the words that are taken beyond that, joined by spaces."""
    text = F.col(f"row.{text_col}")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    whole = F.transform(F.sequence(F.lit(1), F.col("repeats").cast("int")), lambda i: text)
    copies = F.when(F.col("repeats") > 0, whole).otherwise(F.array().cast("array<string>"))
    cut = F.when(F.col("extra") == F.col("size"), text).otherwise(F.array_join(F.slice(words, 1, F.col("extra").cast("int")), " "))
    more = F.when(F.col("extra") > 0, F.array(cut)).otherwise(F.array().cast("array<string>"))
    return plan.select("row", F.posexplode(F.concat(copies, more)).alias("part", "mixed_text"))
