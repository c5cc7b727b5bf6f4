"""Tables derived once and kept under the shared folder for the life of the application."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarmac.session import scratch_path

_written: dict[tuple[str, str, str], str] = {}


def write_parquet(rows: DataFrame, path: str) -> None:
    rows.write.parquet(path)


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], write=write_parquet) -> DataFrame:
    """The table ``name``, written on first use. A failed write leaves no entry behind."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch_path(spark, name)
        write(build(), path)
        _written[key] = path
    return spark.read.parquet(_written[key])
