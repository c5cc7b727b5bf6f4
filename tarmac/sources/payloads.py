"""Stored events: serialized JSON payloads with a type name, written from typed rows and read back into them.

A stored row is ordering, persistence_id, sequence_number, deleted, event_ser_manifest (whose last word is the event's
type) and event_payload, the JSON text in UTF-8. Fields an event does not have are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.clock import whole_seconds
from tarmac.functions.durations import (
    format_duration,
    format_local_date_time,
    parse_duration_micros,
    parse_local_date_time,
)

AIRPORT = "struct<code:string,name:string,city:string,country:string>"
OD_PAIR = f"struct<origin:{AIRPORT},destination:{AIRPORT}>"
FLIGHT = (
    f"struct<flightId:string,flightNumber:string,route:struct<origin:{AIRPORT},destination:{AIRPORT},distance:double,"
    "estimatedDuration:string>,scheduledDeparture:string,scheduledArrival:string,totalSeats:int,availableSeats:int,status:string>"
)
FLIGHT_EVENT = (
    "seatsAllocated int, seatsReleased int, remainingSeats int, oldStatus string, newStatus string, reason string,"
    f" timestamp string, flight {FLIGHT}"
)
BOOKING_EVENT = (
    "bookingId string, flightId string, seatsBooked int, reason string, timestamp string, request struct<requestId:string,"
    "passenger:struct<passengerId:string,firstName:string,lastName:string,email:string>,"
    f"odPair:{OD_PAIR},requestedSeats:int,requestTime:string>"
)
ALLOCATION_EVENT = (
    "allocationId string, runId string, reason string, timestamp string,"
    f" allocation struct<odPair:{OD_PAIR},flight:struct<flightId:string>,seatsAllocated:int>,"
    # pairs with a number each: arrays of two, read as text
    " request struct<odPairs:array<array<string>>,priority:string,requestTime:string>,"
    f" result struct<allocations:array<struct<seatsAllocated:int>>,unallocated:array<array<string>>,processingTimeMs:long>"
)


def stored_rows(events: DataFrame, family: str, payload: Column) -> DataFrame:
    return events.select(
        "ordering",
        "persistence_id",
        "sequence_number",
        "deleted",
        F.concat(F.lit(f"models.events.{family}Events$"), "event_type").alias("event_ser_manifest"),
        F.encode(payload, "UTF-8").alias("event_payload"),
    )


def _parsed(stored: DataFrame, schema: str) -> DataFrame:
    return stored.withColumn("e", F.from_json(F.decode("event_payload", "UTF-8"), schema)).withColumn(
        "event_type", F.regexp_extract("event_ser_manifest", r"([A-Za-z]+)$", 1)
    )


def _airport(prefix: str) -> Column:
    parts = [F.col(f"flight.{prefix}").alias("code")] + [F.col(f"flight.{prefix}_{p}").alias(p) for p in ("name", "city", "country")]
    return F.struct(*parts)


# --- flights -------------------------------------------------------------------------------


def encode_flight_events(journal: DataFrame) -> DataFrame:
    """Journal rows as stored rows. A cancellation has its reason alone: the status is in its name."""
    kind, flight_id = F.col("event_type"), F.regexp_replace("persistence_id", "^flight-", "")
    flight = F.struct(
        flight_id.alias("flightId"),
        F.col("flight.flight_number").alias("flightNumber"),
        F.struct(
            _airport("origin").alias("origin"),
            _airport("destination").alias("destination"),
            F.col("flight.distance").alias("distance"),
            format_duration(F.col("flight.seconds")).alias("estimatedDuration"),
        ).alias("route"),
        format_local_date_time(F.col("flight.scheduled_departure")).alias("scheduledDeparture"),
        format_local_date_time(F.col("flight.scheduled_arrival")).alias("scheduledArrival"),
        F.col("total_seats").alias("totalSeats"),
        F.col("remaining_seats").alias("availableSeats"),
        F.col("new_status").alias("status"),
    )
    is_seats, is_status = kind.isin("SeatsAllocated", "SeatsReleased"), kind == "FlightStatusChanged"
    payload = F.to_json(
        F.struct(
            flight_id.alias("flightId"),
            F.when(kind == "FlightCreated", flight).alias("flight"),
            F.when(kind == "SeatsAllocated", F.col("seats")).alias("seatsAllocated"),
            F.when(kind == "SeatsReleased", F.col("seats")).alias("seatsReleased"),
            F.when(is_seats, F.col("remaining_seats")).alias("remainingSeats"),
            F.when(is_status, F.col("old_status")).alias("oldStatus"),
            F.when(is_status, F.col("new_status")).alias("newStatus"),
            "reason",
            format_local_date_time(F.col("event_ts")).alias("timestamp"),
        )
    )
    return stored_rows(journal, "Flight", payload)


def decode_flight_events(stored: DataFrame) -> DataFrame:
    """Stored rows of flights as typed journal rows."""
    return _parsed(stored, FLIGHT_EVENT).select(
        "ordering",
        "persistence_id",
        "sequence_number",
        "deleted",
        "event_type",
        parse_local_date_time(F.col("e.timestamp")).alias("event_ts"),
        F.col("e.flight.totalSeats").alias("total_seats"),
        F.coalesce("e.seatsAllocated", "e.seatsReleased").alias("seats"),
        F.coalesce("e.remainingSeats", "e.flight.availableSeats").alias("remaining_seats"),
        F.col("e.oldStatus").alias("old_status"),
        F.coalesce("e.newStatus", "e.flight.status", F.when(F.col("event_type") == "FlightCancelled", "Cancelled")).alias("new_status"),
        F.col("e.reason").alias("reason"),
        F.lit(None).cast("string").alias("booking_id"),
        F.lit(None).cast("string").alias("allocation_id"),
        F.when(F.col("e.flight").isNotNull(), _flight_record("e.flight")).alias("flight"),
    )


def _flight_record(flight: str) -> Column:
    """A decoded flight in the journal's form."""
    ends = [
        F.col(f"{flight}.route.{end}.{part}").alias(end if part == "code" else f"{end}_{part}")
        for end in ("origin", "destination")
        for part in ("code", "name", "city", "country")
    ]
    micros = parse_duration_micros(F.col(f"{flight}.route.estimatedDuration"))
    return F.struct(
        F.col(f"{flight}.flightNumber").alias("flight_number"),
        *ends,
        F.col(f"{flight}.route.distance").alias("distance"),
        whole_seconds(micros).alias("seconds"),
        parse_local_date_time(F.col(f"{flight}.scheduledDeparture")).alias("scheduled_departure"),
        parse_local_date_time(F.col(f"{flight}.scheduledArrival")).alias("scheduled_arrival"),
    )


# --- bookings and allocations ----------------------------------------------------------------


def _code_only(origin: str, destination: str) -> Column:
    """An O&D pair of airports of which only the code is known."""
    ends = []
    for name, code in (("origin", origin), ("destination", destination)):
        rest = [F.lit("").alias(part) for part in ("name", "city", "country")]
        ends.append(F.struct(F.col(code).alias("code"), *rest).alias(name))
    return F.struct(*ends)


def encode_booking_events(events: DataFrame) -> DataFrame:
    """Booking events with what was asked (request_id, passenger_id, passenger_name, origin, destination, request_time)."""
    kind = F.col("event_type")
    passenger = F.struct(
        F.concat(F.lit("pax-"), "passenger_id").alias("passengerId"),
        F.split_part("passenger_name", F.lit("#"), F.lit(1)).alias("firstName"),
        F.split_part("passenger_name", F.lit("#"), F.lit(2)).alias("lastName"),
        F.concat(F.lit("p"), "passenger_id", F.lit("@mail.example")).alias("email"),
    )
    request = F.struct(
        F.col("request_id").cast("string").alias("requestId"),
        passenger.alias("passenger"),
        _code_only("origin", "destination").alias("odPair"),
        F.col("seats").alias("requestedSeats"),
        format_local_date_time(F.col("request_time")).alias("requestTime"),
    )
    confirmed = kind == "BookingConfirmed"
    payload = F.to_json(
        F.struct(
            F.col("booking_id").alias("bookingId"),
            F.when(kind == "BookingCreated", request).alias("request"),
            F.when(confirmed, F.col("flight_id")).alias("flightId"),
            F.when(confirmed, F.col("seats")).alias("seatsBooked"),
            F.when(kind == "BookingCancelled", F.col("reason")).alias("reason"),
            format_local_date_time(F.col("event_ts")).alias("timestamp"),
        )
    )
    return stored_rows(events, "Booking", payload)


def decode_booking_events(stored: DataFrame) -> DataFrame:
    return _parsed(stored, BOOKING_EVENT).select(
        "persistence_id",
        "sequence_number",
        "event_type",
        parse_local_date_time(F.col("e.timestamp")).alias("event_ts"),
        F.col("e.bookingId").alias("booking_id"),
        F.col("e.request.requestId").alias("request_id"),
        F.col("e.request.passenger.passengerId").alias("passenger_id"),
        F.concat_ws(" ", "e.request.passenger.firstName", "e.request.passenger.lastName").alias("passenger_name"),
        F.col("e.request.odPair.origin.code").alias("origin"),
        F.col("e.request.odPair.destination.code").alias("destination"),
        parse_local_date_time(F.col("e.request.requestTime")).alias("request_time"),
        F.coalesce("e.request.requestedSeats", "e.seatsBooked").alias("seats"),
        F.col("e.flightId").alias("flight_id"),
        F.col("e.reason").alias("reason"),
    )


def encode_allocation_events(events: DataFrame) -> DataFrame:
    """Run events, and allocations made as events ``SeatAllocationMade`` with origin, destination, flight_id and seats."""
    kind = F.col("event_type")
    made = F.struct(
        _code_only("origin", "destination").alias("odPair"),
        F.struct(F.col("flight_id").alias("flightId")).alias("flight"),
        F.col("seats").alias("seatsAllocated"),
    )
    payload = F.to_json(
        F.struct(
            F.col("allocation_id").alias("allocationId"),
            F.col("run_id").alias("runId"),
            F.when(kind == "SeatAllocationMade", made).alias("allocation"),
            F.when(kind == "AllocationFailed", F.col("reason")).alias("reason"),
            format_local_date_time(F.col("event_ts")).alias("timestamp"),
        )
    )
    return stored_rows(events, "Allocation", payload)


def decode_allocation_events(stored: DataFrame) -> DataFrame:
    """Stored rows of allocation runs; requests and results, where a payload has them, as counts."""
    return _parsed(stored, ALLOCATION_EVENT).select(
        "persistence_id",
        "sequence_number",
        "event_type",
        parse_local_date_time(F.col("e.timestamp")).alias("event_ts"),
        F.col("e.allocationId").alias("allocation_id"),
        F.col("e.runId").alias("run_id"),
        F.col("e.allocation.odPair.origin.code").alias("origin"),
        F.col("e.allocation.odPair.destination.code").alias("destination"),
        F.col("e.allocation.flight.flightId").alias("flight_id"),
        F.col("e.allocation.seatsAllocated").alias("seats"),
        F.size("e.request.odPairs").alias("pairs"),
        F.col("e.request.priority").alias("priority"),
        F.size("e.result.allocations").alias("allocations"),
        F.size("e.result.unallocated").alias("unallocated"),
        F.col("e.result.processingTimeMs").alias("processing_ms"),
        F.col("e.reason").alias("reason"),
    )
