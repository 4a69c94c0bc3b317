"""Tables in a relational database over JDBC. The driver's jar has to be on the class path.

Reads are cut into ``partitions`` ranges of a numeric or time column. Writes go to a
staging table: Spark's JDBC writer has no insert-unless-present, so the merge by key is one
statement in the database, for which ``merge_statement`` gives the text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.schema import ALERT_FIELDS


@dataclass(frozen=True)
class Database:
    url: str
    driver: str = "org.postgresql.Driver"
    properties: dict[str, str] = field(default_factory=dict, repr=False)

    def options(self, table: str) -> dict[str, str]:
        return {"url": self.url, "dbtable": table, "driver": self.driver, **self.properties}


def range_options(column: str, lower: str, upper: str, partitions: int) -> dict[str, str]:
    return {
        "partitionColumn": column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(partitions),
    }


def read_database(
    spark: SparkSession, database: Database, table: str, ranges: dict[str, str] | None = None
) -> DataFrame:
    options = {**database.options(table), "fetchsize": "10000", **(ranges or {})}
    return spark.read.format("jdbc").options(**options).load()


def write_database(
    df: DataFrame, database: Database, table: str, mode: str = "overwrite", connections: int = 16
) -> None:
    """``connections`` bounds the number of sessions opened at once."""
    (
        df.write.format("jdbc")
        .options(**database.options(table), batchsize="10000", numPartitions=str(connections))
        .mode(mode)
        .save()
    )


def alert_row_types(alerts: DataFrame) -> DataFrame:
    """Alerts in the column types of the database's table; a number that does not fit is an error."""
    narrow = {"amount": "decimal(12,2)", "txn_count": "int", "total_amount": "decimal(14,2)"}
    return alerts.withColumns({name: F.col(name).cast(kind) for name, kind in narrow.items()})


def merge_statement(staging: str, target: str) -> str:
    """Moves staged alerts over, leaving known transactions alone (unique key on txn_id)."""
    columns = ", ".join(ALERT_FIELDS)
    return (
        f"INSERT INTO {target} ({columns}) SELECT {columns} FROM {staging} "
        "ON CONFLICT (txn_id) DO NOTHING"
    )


def execute(spark: SparkSession, database: Database, statement: str) -> None:
    """Runs one statement in the database, in a transaction of its own, on the driver's connection."""
    jvm = spark._jvm
    jvm.java.lang.Class.forName(database.driver)
    settings = jvm.java.util.Properties()
    for key, value in database.properties.items():
        settings.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(database.url, settings)
    try:
        connection.createStatement().execute(statement)
    finally:
        connection.close()
