"""A keyed table kept as one parquet folder per micro-batch.

A batch overwrites its own folder and reads only earlier ones, so running it again after a
failure gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch"


class VersionedTable:
    """Rows written by later batches replace those of earlier batches with the same key.

    Every ``compact_every`` batches the whole table is written, and older folders are no
    longer read.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], schema: str, compact_every: int = 20
    ):
        self.spark, self.path, self.keys, self.schema = spark, path, list(keys), schema
        self.compact_every = compact_every
        spark.createDataFrame([], schema).write.mode("ignore").parquet(self._folder(-1))

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/{BATCH}={batch_id}"

    def batches(self) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, {BATCH} long").parquet(self.path)

    def before(self, batch_id: int) -> DataFrame:
        """The table as it was before ``batch_id``."""
        last_whole = max(-1, (batch_id - 1) // self.compact_every * self.compact_every if batch_id > 0 else -1)
        return self._latest(self.batches().where((F.col(BATCH) < batch_id) & (F.col(BATCH) >= last_whole)))

    def latest(self) -> DataFrame:
        """The table as it is now, from its last whole folder on."""
        newest = self.batches().agg(F.max(BATCH)).first()[0]  # of folder names
        return self.before(newest + 1)

    def _latest(self, rows: DataFrame) -> DataFrame:
        values = [name for name in rows.columns if name not in [*self.keys, BATCH]]
        return (
            rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), BATCH).alias("row")).select(*self.keys, "row.*")
        )

    def write(self, batch_id: int, changed: DataFrame) -> None:
        if batch_id % self.compact_every == 0:
            merged = self.before(batch_id).withColumn(BATCH, F.lit(0)).unionByName(
                changed.withColumn(BATCH, F.lit(1))
            )
            changed = self._latest(merged)
        changed.write.mode("overwrite").parquet(self._folder(batch_id))


class BatchLog:
    """Rows added by each micro-batch, one folder per batch."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/{BATCH}=-1")

    def write(self, batch_id: int, rows: DataFrame) -> DataFrame:
        """Write the batch and return it as read back, so that it is computed once."""
        folder = f"{self.path}/{BATCH}={batch_id}"
        rows.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(self.schema).parquet(folder)

    def read(self) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, {BATCH} long").parquet(self.path).drop(BATCH)


def ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
