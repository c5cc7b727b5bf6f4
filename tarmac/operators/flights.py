"""Listing, lookup, filters and capacity over the table of current flights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.capacity import has_capacity, is_fully_booked, occupied_seats
from tarmac.schemas import FLIGHT_EXISTS

FLIGHT_COLUMNS = [
    "flight_id",
    "flight_number",
    "origin",
    "destination",
    "distance",
    "scheduled_departure",
    "scheduled_arrival",
    "total_seats",
    "available_seats",
    "status",
]


def list_flights(flights: DataFrame) -> DataFrame:
    return flights.select(*FLIGHT_COLUMNS)


def lookup_flights(requests: DataFrame, flights: DataFrame) -> DataFrame:
    """Each requested ``flight_id`` with its flight, or with a not-found message."""
    known = flights.select("flight_id", "flight_number", "available_seats", "status", F.lit(True).alias("found"))
    return requests.join(known, ["flight_id"], "left").withColumns(
        {
            "found": F.coalesce("found", F.lit(False)),
            "message": F.when(
                F.col("found").isNull(), F.concat(F.lit("Flight "), F.col("flight_id"), F.lit(" not found"))
            ),
        }
    )


def missing_flights(requests: DataFrame, flights: DataFrame) -> DataFrame:
    """Requested ids the table does not hold, once each."""
    wanted = requests.select("flight_id").distinct()
    return wanted.join(flights.select("flight_id"), "flight_id", "left_anti")


def by_route(flights: DataFrame, origin: str, destination: str) -> DataFrame:
    return list_flights(flights.where((F.col("origin") == origin) & (F.col("destination") == destination)))


def by_status(flights: DataFrame, status: str) -> DataFrame:
    return list_flights(flights.where(F.col("status") == status))


def with_seats_left(flights: DataFrame, seats: int = 1) -> DataFrame:
    return list_flights(flights.where(has_capacity(F.lit(seats))))


def capacity(flights: DataFrame, wanted: Column) -> DataFrame:
    """Occupied seats, whether the flight is full, and whether it can take ``wanted`` more."""
    return flights.select(
        "flight_id",
        "total_seats",
        "available_seats",
        occupied_seats().alias("occupied_seats"),
        is_fully_booked().alias("is_fully_booked"),
        wanted.alias("wanted"),
        has_capacity(wanted).alias("has_capacity"),
    )


def capacity_by(flights: DataFrame, keys: Sequence[str]) -> DataFrame:
    return flights.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("flights"),
        F.sum("total_seats").cast("long").alias("total_seats"),
        F.sum("available_seats").cast("long").alias("available_seats"),
        F.sum(occupied_seats()).cast("long").alias("occupied_seats"),
        F.count_if(is_fully_booked()).alias("full_flights"),
    )


# --- registration --------------------------------------------------------------------------


def _first_requests(requests: DataFrame) -> DataFrame:
    """The earliest request per id; the aggregate runs map-side, so a repeated id does no harm."""
    return requests.groupBy("flight_id").agg(F.min("request_no").alias("first_no"))


def register_flights(requests: DataFrame, flights: DataFrame) -> DataFrame:
    """Requests that create a flight: the id is new, and the request is the first with it."""
    winners = requests.groupBy("flight_id").agg(F.min_by(F.struct(*requests.columns), "request_no").alias("won"))
    return winners.join(flights.select("flight_id"), "flight_id", "left_anti").select("won.*")


def register_rejects(requests: DataFrame, flights: DataFrame) -> DataFrame:
    """Requests for an id that is already taken, by the table or by an earlier request."""
    taken = _first_requests(requests).join(
        flights.select("flight_id", F.lit(True).alias("exists")), "flight_id", "left"
    )
    return (
        requests.join(taken, ["flight_id"], "left")
        .where(F.col("exists") | (F.col("request_no") > F.col("first_no")))
        .drop("exists", "first_no")
        .withColumn("reason", F.lit(FLIGHT_EXISTS))
    )


def upsert_flights(flights: DataFrame, changes: DataFrame) -> DataFrame:
    """The table after ``changes`` (same columns plus ``version``); the highest version wins."""
    columns = [name for name in changes.columns if name != "version"]
    base = flights.select(*columns, F.lit(-1).cast("long").alias("version"))
    return (
        base.unionByName(changes)
        .groupBy("flight_id")
        .agg(F.max_by(F.struct(*columns), "version").alias("latest"))
        .select("latest.*")
    )
