"""Contract check of whole frames: what is broken, and the split into kept and set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.functions.contract import FIELD_CHECKS, meets_contract
from txnguard.operators.parsing import RAW_VIOLATIONS


def with_violations(df: DataFrame) -> DataFrame:
    """Adds ``violations``: names of all checks the row fails, those of its text first."""
    cases = ", ".join(f"if({sql}, '{name}', NULL)" for name, sql in FIELD_CHECKS.items())
    found = f"array_compact(array({cases}))"
    if RAW_VIOLATIONS in df.columns:
        found = f"concat({RAW_VIOLATIONS}, {found})"
    return df.withColumn("violations", F.expr(found)).drop(RAW_VIOLATIONS)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("violations") == 0).drop("violations")


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("violations") > 0)


def keep_valid(df: DataFrame) -> DataFrame:
    """The rows that meet the contract."""
    return df.filter(meets_contract())


def violation_counts(checked: DataFrame) -> DataFrame:
    return (
        checked.select(F.explode_outer("violations").alias("violation"))
        .filter("violation IS NOT NULL")
        .groupBy("violation")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
