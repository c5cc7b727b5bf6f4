"""Structured JSON log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schemas import LOG_LINE


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return _columns(spark.read.schema(LOG_LINE).json(path))


def parse_logs(lines: DataFrame, column: str = "line") -> DataFrame:
    return _columns(lines.select(F.from_json(column, LOG_LINE).alias("e")).select("e.*"))


def _columns(lines: DataFrame) -> DataFrame:
    return lines.select(
        # log time stamps end in Z; they are kept as the UTC wall clock
        F.regexp_replace("timestamp", "Z$", "").try_cast("timestamp_ntz").alias("logged_at"),
        "level",
        "message",
        F.col("correlationId").alias("correlation_id"),
        F.col("runId").alias("run_id"),
        F.col("odGroup").alias("od_group"),
    )
