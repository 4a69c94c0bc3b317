"""Tables in files: parquet by default, any other format with its jar on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def overwrite_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None
) -> None:
    """Replace the whole table, also where the session overwrites partition by partition."""
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_keyed(df: DataFrame, path: str, order: list[str], blooms: dict[str, int], mode: str = "overwrite") -> None:
    """A copy of a table for look-ups: ranged and sorted by ``order``, so that a filter on its first column
    skips files and row groups by their least and greatest values, with a Bloom filter per row group for
    each column in ``blooms``, so that one on those skips row groups too.

    ``blooms`` gives the number of distinct values to expect in a row group, which sets the filter's size.
    """
    writer = df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode)
    for column, distinct in blooms.items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", distinct)
    writer.parquet(path)


def rows_to_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType | list[str]) -> DataFrame:
    """A frame from literal rows, with a schema or with names only (types inferred)."""
    return spark.createDataFrame(rows, schema)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The table as a stream of the files added to it. Set a limit to bound one batch."""
    reader = spark.readStream.format(fmt)
    if fmt != "delta":
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
