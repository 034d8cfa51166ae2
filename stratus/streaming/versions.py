"""Tables that a stream rewrites, one folder per micro-batch.

``<path>/batch=<id>/`` holds the whole table as of that batch.  A replayed batch
overwrites its own folder and builds on the same predecessor, so a restart changes
nothing; readers take the newest finished folder and never see a half-written one.
Older folders are dropped, but for the predecessor (a replay needs it).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from stratus.sources.fs import Store

_BATCH = re.compile(r"batch=(\d+)")


class Versions:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.store = spark, path.rstrip("/"), Store(spark)

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    def ids(self) -> list[int]:
        return sorted(int(m[1]) for m in map(_BATCH.fullmatch, self.store.names(self.path)) if m)

    def newest(self, before: int | None = None) -> int | None:
        """The last finished batch (below ``before``)."""
        return next((k for k in reversed(self.ids()) if (before is None or k < before)
                     and self.store.exists(f"{self._folder(k)}/_SUCCESS")), None)

    def read(self, before: int | None = None) -> DataFrame | None:
        k = self.newest(before)
        return None if k is None else self.spark.read.parquet(self._folder(k))

    def write(self, table: DataFrame, batch_id: int) -> None:
        kept = self.newest(batch_id)
        table.write.mode("overwrite").parquet(self._folder(batch_id))
        for k in self.ids():
            if k < batch_id and k != kept:
                self.store.delete(self._folder(k))


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The table as of the last finished batch."""
    found = Versions(spark, path).read()
    if found is None:
        raise FileNotFoundError(f"{path}: no finished batch yet")
    return found
