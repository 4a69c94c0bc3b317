"""What rules hold transactions against, in versions that are renewed while streams run."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from txnguard.operators import profile
from txnguard.streaming.ledger import Ledger


@dataclass(frozen=True)
class Known:
    """Static tables. See ``profile`` for how they are made."""

    profile: DataFrame
    seen_devices: DataFrame
    seen_states: DataFrame

    def as_of(self, time: int | None) -> Known:
        return self


_PARTS = ("profile", "seen_devices", "seen_states")


class KnownTables:
    """Versions of the known tables. A micro-batch asks for the one that held when its rows came in, so a
    new version is used without a restart, and a batch that is run again uses the version it used before.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.ledger = Ledger(spark, f"{self.path}/ledger")

    def publish(self, history: DataFrame, valid_from: int | None = None) -> None:
        """Makes a version from history. It holds from now on, or from the time given in microseconds."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        profile.spend_profile(history).write.parquet(f"{folder}/profile")
        values = profile.stored_values(history, [profile.DEVICE, profile.STATE])
        for part, attribute in (("seen_devices", profile.DEVICE), ("seen_states", profile.STATE)):
            profile.pairs_of(values, attribute).write.parquet(f"{folder}/{part}")
        self.ledger.commit(folder.rsplit("/", 1)[-1], folder, {}, at=valid_from)

    def as_of(self, time: int | None) -> Known:
        """The last version that held at ``time``, in microseconds (the first one if none did), the last one for None."""
        entries = self.ledger.entries()
        if not entries:
            raise LookupError(f"no profile has been published to {self.path}")
        holding = [e for e in entries if time is None or e.at <= time] or entries[:1]
        folder = holding[-1].folder
        return Known(*(self.spark.read.parquet(f"{folder}/{part}") for part in _PARTS))
