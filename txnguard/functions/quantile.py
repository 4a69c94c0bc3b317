"""Exact per-key median that stands a key with a third of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnguard.session import materialise

BINS_PER_EFOLD = 64


def _bin(value: Column) -> Column:
    """A coarse, order-preserving bin: logarithmic in size, mirrored below zero.

    There are at most some 90,000 bins over all doubles, whatever the data.
    """
    # Infinity gets a bin of its own beyond all others.
    size = F.floor(F.least(F.log1p(F.abs(value)) * F.lit(BINS_PER_EFOLD), F.lit(1e6)))
    mirrored = F.when(value < 0, -size - 1).otherwise(size).cast("int")
    # Never null for a value, and said so: else a join on it adds a filter to one side only,
    # and the two sides no longer share their exchange.
    return F.coalesce(mirrored, F.lit(0))


#: Rows of a key, and distinct values in a bin, from which one task is not to sort them.
MOST = 1_000_000
WAYS = 4096


def grouped_median(df: DataFrame, key: str, value: str, out: str, most: int = MOST) -> DataFrame:
    """One row per key: ``(key, out)``, the mean of the two middle values. Null keys and values are
    skipped.

    A built-in median holds every value of a key in one buffer. Here equal values are first
    counted with map-side combine; a small histogram per key tells in which bin the middle
    ranks fall; and only that bin is sorted. Keys with more than ``most`` rows are told first, and
    theirs is cut again and again, until no more than ``most`` distinct values are left to sort.
    """
    given = df.select(key, value).filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    heavy = materialise(given.groupBy(key).count().filter(F.col("count") > most).select(key))
    if heavy.isEmpty():
        return _by_bin(given, key, value, out)
    light = _by_bin(given.join(heavy, key, "left_anti"), key, value, out)
    return light.unionByName(_by_levels(given.join(heavy, key, "left_semi"), key, value, out, most))


def _by_levels(df: DataFrame, key: str, value: str, out: str, most: int) -> DataFrame:
    """Selection by radix: of the interval that a middle rank lies in, counts per slot (combined before the
    shuffle) tell the slot, whose least and greatest values are the next interval.

    Slots keep the order of values, as differences and quotients are rounded alike. A pass leaves a
    4096th of the interval, so two or three are enough for values of any precision but odd ones, and a few
    more for those.
    """
    counts = materialise(df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.groupBy(key).agg(F.sum("_n").alias("_total"))
    middle = F.array_distinct(F.array(F.expr("(_total + 1) DIV 2"), F.expr("(_total + 2) DIV 2")))
    ranks = total.select(key, F.explode(middle).alias("_rank"), F.lit(0).cast("long").alias("_before"))
    found = _narrowed(counts.join(ranks, key).withColumn("_slot", _bin(F.col(value))), key, value)
    done = []
    while True:
        done.append(found.filter(F.col("_size") <= most))
        large = found.filter(F.col("_size") > most)
        if large.isEmpty():
            break
        inside = counts.join(large, key).filter(F.col(value).between(F.col("_low"), F.col("_high")))
        share = (F.col(value) - F.col("_low")) / (F.col("_high") - F.col("_low"))
        found = _narrowed(inside.withColumn("_slot", F.floor(share * (WAYS - 1)).cast("int")), key, value)
    intervals = reduce(DataFrame.unionByName, done)
    last = counts.join(intervals, key).filter(F.col(value).between(F.col("_low"), F.col("_high")))
    up = W.partitionBy(key, "_rank").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    upto = F.col("_before") + F.sum("_n").over(up)
    at = last.withColumn("_upto", upto).filter("_upto >= _rank AND _upto - _n < _rank")
    return at.groupBy(key).agg(((F.min(value) + F.max(value)) / 2).alias(out))


def _narrowed(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Per key and rank the slot that holds the rank: rows before it, its interval and distinct values."""
    slots = rows.groupBy(key, "_rank", "_before", "_slot").agg(
        F.sum("_n").alias("_in"),
        F.count(F.lit(1)).alias("_size"),
        F.min(value).alias("_low"),
        F.max(value).alias("_high"),
    )
    up = W.partitionBy(key, "_rank").orderBy("_slot").rowsBetween(W.unboundedPreceding, W.currentRow)
    upto = slots.withColumn("_upto", F.col("_before") + F.sum("_in").over(up))
    held = upto.filter("_upto >= _rank AND _upto - _in < _rank")
    return materialise(held.select(key, "_rank", (F.col("_upto") - F.col("_in")).alias("_before"), "_size", "_low", "_high"))


def _by_bin(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    counts = (
        df.groupBy(key, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bin", _bin(F.col(value)))
    )

    by_key = W.partitionBy(key)
    upward = by_key.orderBy("_bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    wanted = (
        counts.groupBy(key, "_bin")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(upward))
        .withColumn("_total", F.sum("_n").over(by_key))
        .withColumn("_low", F.expr("(_total + 1) DIV 2"))
        .withColumn("_high", F.expr("(_total + 2) DIV 2"))
        .withColumn("_before", F.col("_upto") - F.col("_n"))
        .filter((F.col("_upto") >= F.col("_low")) & (F.col("_before") < F.col("_high")))
        .select(key, "_bin", "_before", "_low", "_high")
    )

    in_bin = W.partitionBy(key, "_bin").orderBy(value)
    in_bin = in_bin.rowsBetween(W.unboundedPreceding, W.currentRow)
    middle = (
        counts.join(wanted, [key, "_bin"])
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(in_bin))
        .filter(
            (F.col("_upto") >= F.col("_low")) & (F.col("_upto") - F.col("_n") < F.col("_high"))
        )
    )
    return middle.groupBy(key).agg(((F.min(value) + F.max(value)) / 2).alias(out))
