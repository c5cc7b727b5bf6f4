"""Origin-destination demand: totals, periods, top routes, demand of one flight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.capacity import od_key
from tarmac.functions.clock import period_start

OD = ["origin", "destination"]


def _demand_totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_requests"),
        F.sum("seats").cast("long").alias("total_seats_requested"),
        F.avg("seats").alias("average_seats_per_request"),
    ]


def od_demand(requests: DataFrame) -> DataFrame:
    return (
        requests.groupBy(*OD)
        .agg(
            *_demand_totals(),
            F.min("request_time").alias("period_start"),
            F.max("request_time").alias("period_end"),
        )
        .select(od_key().alias("od_key"), "*")
    )


def od_demand_by_period(requests: DataFrame, period: str = "month") -> DataFrame:
    """Demand per calendar period; ``period`` is year, quarter, month, week or
    day. The end shown is the
    last second inside the half-open period."""
    start = period_start(period, F.col("request_time"))
    return (
        requests.groupBy(start.alias("period_start"), *OD)
        .agg(*_demand_totals())
        .withColumn("period_end", F.expr(f"timestampadd({period}, 1, period_start) - interval 1 second"))
    )


def top_routes(requests: DataFrame, k: int = 10) -> DataFrame:
    """The k routes with the most seats requested."""
    return (
        requests.groupBy(*OD)
        .agg(*_demand_totals())
        .orderBy(F.desc("total_seats_requested"), *OD)
        .limit(k)
    )


def flight_demand(bookings: DataFrame) -> DataFrame:
    """Requests per flight, over the days from the first request to the last."""
    day = period_start("day", F.col("request_time"))
    return (
        bookings.where(F.col("flight_id").isNotNull())
        .groupBy("flight_id")
        .agg(
            *_demand_totals(),
            F.min(day).alias("period_start"),
            (F.max(day) + F.expr("interval 1 day") - F.expr("interval 1 second")).alias("period_end"),
        )
    )
