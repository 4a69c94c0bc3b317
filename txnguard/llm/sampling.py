"""Bounded samples by hash, for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def thinned(rows: DataFrame, total: int, n: int, hash_col: str = "h") -> DataFrame:
    """About ``2 * n`` of ``total`` rows, or all if they are no more: those with the least hashes.

    Taking the n least of all rows would send n from each task to the driver, however many tasks
    there are. What is left here is sorted and cut to n by the caller.
    """
    if total <= 2 * n:
        return rows
    bound = int((1 << 64) * (2 * n / total)) - (1 << 63)
    return rows.where(F.col(hash_col) < F.lit(bound))
