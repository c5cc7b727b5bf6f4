"""Booking lifecycle: created, confirmed, cancelled, and what it does to seats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


OD = ["origin", "destination"]


def assign_flights(requests: DataFrame, flights: DataFrame) -> DataFrame:
    """Each request with the first flight of its route."""
    first = flights.groupBy(*OD).agg(
        F.min_by("flight_id", F.struct("scheduled_departure", "flight_id")).alias("flight_id")
    )
    return requests.join(first, OD, "left")


def booking_events(assigned: DataFrame) -> DataFrame:
    """Booking events from requests and their order status: F is confirmed, P confirmed and then
    cancelled, anything else only created. A request with no flight cannot be confirmed."""
    steps = (
        F.when(F.col("flight_id").isNull(), 1)
        .when(F.col("order_status") == "F", 2)
        .when(F.col("order_status") == "P", 3)
        .otherwise(1)
    )
    number = F.col("sequence_number")
    return (
        assigned.withColumn("sequence_number", F.explode(F.sequence(F.lit(1).cast("long"), steps.cast("long"))))
        .select(
            F.concat(F.lit("booking-"), F.col("request_id")).alias("persistence_id"),
            "sequence_number",
            F.when(number == 1, "BookingCreated")
            .when(number == 2, "BookingConfirmed")
            .otherwise("BookingCancelled")
            .alias("event_type"),
            F.expr("timestampadd(HOUR, cast(sequence_number - 1 as int), request_time)").alias("event_ts"),
            F.concat(F.lit("bk-"), F.col("request_id")).alias("booking_id"),
            F.when(number > 1, F.col("flight_id")).alias("flight_id"),
            "seats",
            F.when(number == 3, "Cancelled by passenger").alias("reason"),
        )
    )


def booking_state(events: DataFrame) -> DataFrame:
    """Current status of each booking, and the seats it holds."""
    status = F.regexp_replace("event_type", "^Booking", "")
    return (
        events.groupBy("booking_id")
        .agg(
            F.max_by(status, "sequence_number").alias("status"),
            F.max("flight_id").alias("flight_id"),
            F.max("seats").alias("seats"),
            F.min("event_ts").alias("created_at"),
        )
        .withColumn("seats_held", F.when(F.col("status") == "Confirmed", F.col("seats")).otherwise(0))
    )


def seat_effects(events: DataFrame) -> DataFrame:
    """Seats a booking event takes from (+) or returns to (-) its flight."""
    effect = F.when(F.col("event_type") == "BookingConfirmed", F.col("seats")).when(
        F.col("event_type") == "BookingCancelled", -F.col("seats")
    )
    return events.where(effect.isNotNull()).select(
        "booking_id", "flight_id", "event_ts", effect.cast("long").alias("seats_taken")
    )


def booking_details(states: DataFrame, requests: DataFrame, flights: DataFrame) -> DataFrame:
    """Bookings with their passenger and flight number."""
    who = requests.select(
        F.concat(F.lit("bk-"), F.col("request_id")).alias("booking_id"), "passenger_id", "passenger_name"
    )
    named = states.join(who, "booking_id")
    numbers = flights.select("flight_id", "flight_number")
    return named.join(numbers, ["flight_id"], "left").select(
        "booking_id",
        "passenger_id",
        "passenger_name",
        "flight_id",
        "flight_number",
        F.col("seats").alias("seats_booked"),
        "status",
        "created_at",
    )


def seat_reconciliation(effects: DataFrame, allocations: DataFrame, released: DataFrame, flights: DataFrame) -> DataFrame:
    """Flights whose occupied seats differ from seats booked plus seats allocated less seats released.

    All four are entries of one ledger, summed per flight in one aggregate, so no two of them are joined.
    """
    none = F.lit(0).cast("long")

    def entries(rows: DataFrame, kind: str, seats: str) -> DataFrame:
        amount = {k: F.expr(seats).cast("long") if k == kind else none for k in ("booked", "allocated", "released", "occupied")}
        return rows.select("flight_id", *[value.alias(f"{k}_seats") for k, value in amount.items()])

    ledger = (
        entries(effects, "booked", "seats_taken")
        .unionByName(entries(allocations, "allocated", "seats_allocated"))
        .unionByName(entries(released, "released", "seats"))
        .unionByName(entries(flights, "occupied", "total_seats - available_seats"))
    )
    summed = ledger.groupBy("flight_id").agg(
        *[F.coalesce(F.sum(f"{k}_seats"), none).alias(f"{k}_seats") for k in ("booked", "allocated", "released", "occupied")]
    )
    expected = F.col("booked_seats") + F.col("allocated_seats") - F.col("released_seats")
    return summed.withColumn("difference", F.col("occupied_seats") - expected).where(F.col("difference") != 0)
