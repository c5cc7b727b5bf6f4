"""Rollups of run metrics and structured logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.clock import millis_between


def metrics_summary(metrics: DataFrame, operations: DataFrame | None = None) -> DataFrame:
    """Count, mean, extremes and total per operation. Listed operations with no record get zeros."""
    found = metrics.groupBy("operation").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("duration_ms").alias("mean"),
        F.min("duration_ms").alias("min_ms"),
        F.max("duration_ms").alias("max_ms"),
        F.sum("duration_ms").cast("long").alias("total_ms"),
    )
    if operations is not None:
        found = operations.join(found, "operation", "full_outer")

    def or_zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("long").alias(name)

    return found.select(
        "operation",
        or_zero("count"),
        F.format_string("%.2f", F.coalesce("mean", F.lit(0.0))).alias("avg_ms"),
        or_zero("min_ms"),
        or_zero("max_ms"),
        or_zero("total_ms"),
    )


def run_trace(logs: DataFrame) -> DataFrame:
    """Per correlation id, run and O&D group: first and last line, span, and lines by level."""
    return (
        logs.groupBy("correlation_id", "run_id", "od_group")
        .agg(
            F.min("logged_at").alias("first_at"),
            F.max("logged_at").alias("last_at"),
            F.count(F.lit(1)).alias("lines"),
            F.count_if(F.col("level") == "ERROR").alias("errors"),
            F.count_if(F.col("level") == "WARN").alias("warnings"),
        )
        .withColumn("span_ms", millis_between(F.col("first_at"), F.col("last_at")))
    )


def run_checkpoints(logs: DataFrame) -> DataFrame:
    """Milliseconds from the first line of a run to the first line with each message, one row
    per checkpoint."""
    seen = logs.groupBy("run_id", "message").agg(F.min("logged_at").alias("reached_at"))
    began = seen.groupBy("run_id").agg(F.min("reached_at").alias("began_at"))
    return seen.join(began, "run_id").select(
        "run_id",
        F.col("message").alias("checkpoint"),
        millis_between(F.col("began_at"), F.col("reached_at")).alias("offset_ms"),
    )


def merged_metadata(records: DataFrame, keys: Sequence[str], metadata: str, order: Column) -> DataFrame:
    """One map per ``keys`` out of the records' maps: for each name the value written last, in ``order``.

    Every entry goes its own way until one value per name is left, so records of one key are never gathered; null maps
    and null values write nothing.
    """
    entries = records.select(*keys, order.alias("_order"), F.explode(metadata).alias("name", "value"))
    last = entries.where(F.col("value").isNotNull()).groupBy(*keys, "name").agg(F.max_by("value", "_order").alias("value"))
    return last.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("metadata"))


def metadata_text(metadata: str) -> Column:
    """``a=1, b=2``, by name."""
    entries = F.array_sort(F.map_entries(metadata))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", ")


def checkpoint_metadata(checkpoints: DataFrame, key: str) -> DataFrame:
    """Checkpoints (``key``, checkpoint, offset_ms) as one map per key: ``checkpoint_<place>_<label>`` to ``<n>ms``.

    Places count from 0 in the order the checkpoints were reached, ties by label. There are as many as labels.
    """
    reached = F.array_sort(F.collect_list(F.struct("offset_ms", "checkpoint")))
    name = lambda c, n: F.concat(F.lit("checkpoint_"), n.cast("string"), F.lit("_"), c["checkpoint"])
    entry = lambda c, n: F.struct(name(c, n), F.concat(c["offset_ms"].cast("string"), F.lit("ms")))
    return checkpoints.groupBy(key).agg(F.map_from_entries(F.transform(reached, entry)).alias("checkpoints"))


def run_metrics(records: DataFrame, logs: DataFrame, order: Column, completed_at: Column | None = None) -> DataFrame:
    """One record per run as a tracker would leave it: operation, duration, when it was made, and its metadata, in which
    checkpoints win over entries of the same name.

    ``records`` has run_id and a map ``metadata``; ``completed_at`` is the current time unless given.
    """
    metadata = merged_metadata(records, ["run_id"], "metadata", order)
    reached = checkpoint_metadata(run_checkpoints(logs), "run_id")
    spans = logs.groupBy("run_id").agg(F.min("logged_at").alias("first_at"), F.max("logged_at").alias("last_at"))
    none = F.create_map().cast("map<string,string>")
    own, theirs = F.coalesce("metadata", none), F.coalesce("checkpoints", none)
    merged = F.map_concat(F.map_filter(own, lambda k, _: ~F.map_contains_key(theirs, k)), theirs)
    return spans.join(metadata, "run_id", "left").join(reached, "run_id", "left").select(
        F.col("run_id").alias("operation"),
        millis_between(F.col("first_at"), F.col("last_at")).alias("duration_ms"),
        (F.current_timestamp() if completed_at is None else completed_at).alias("timestamp"),
        merged.alias("metadata"),
    )
