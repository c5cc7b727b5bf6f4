"""Record schemas, enumerations and configured limits."""

from __future__ import annotations

from pyspark.sql import types as T

# Enumeration members, in the order they are declared.
FLIGHT_STATUSES = ["Scheduled", "Boarding", "Departed", "Arrived", "Cancelled", "Delayed"]
PRIORITIES = ["Low", "Medium", "High", "Critical"]
FLIGHT_LIFECYCLE = ["Scheduled", "Boarding", "Departed", "Arrived"]

# Limits.
MIN_LAYOVER_MINUTES = 45
MAX_LAYOVER_MINUTES = 360
SNAPSHOT_INTERVAL = 100
SNAPSHOTS_KEPT = 2
MAX_SEATS_PER_FLIGHT = 300

# Reply texts.
FLIGHT_EXISTS = "Flight already exists"
INSUFFICIENT_SEATS = "Insufficient seats available"

FLIGHT_ID_PREFIX = "flight-"
BOOKING_ID_PREFIX = "booking-"


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


AIRPORT = T.StructType(_strings("code", "name", "city", "country"))

ROUTE = T.StructType(
    [
        T.StructField("origin", AIRPORT),
        T.StructField("destination", AIRPORT),
        T.StructField("distance", T.DoubleType()),
        T.StructField("estimatedDuration", T.DayTimeIntervalType()),
    ]
)

FLIGHT = T.StructType(
    _strings("flightId", "flightNumber")
    + [
        T.StructField("route", ROUTE),
        T.StructField("scheduledDeparture", T.TimestampNTZType()),
        T.StructField("scheduledArrival", T.TimestampNTZType()),
        T.StructField("totalSeats", T.IntegerType()),
        T.StructField("availableSeats", T.IntegerType()),
        T.StructField("status", T.StringType()),
    ]
)

# A create request as it arrives: date-times and the duration are still text.
CREATE_FLIGHT_REQUEST = T.StructType(
    _strings(
        "flightNumber",
        "originCode",
        "originName",
        "originCity",
        "originCountry",
        "destinationCode",
        "destinationName",
        "destinationCity",
        "destinationCountry",
    )
    + [T.StructField("distance", T.DoubleType())]
    + _strings("estimatedDuration", "scheduledDeparture", "scheduledArrival")
    + [T.StructField("totalSeats", T.IntegerType())]
)

ALLOCATION_REQUEST = T.StructType(
    [
        T.StructField("runId", T.StringType()),
        T.StructField(
            "odPairs",
            T.ArrayType(
                T.StructType(
                    _strings("originCode", "destinationCode") + [T.StructField("demand", T.IntegerType())]
                )
            ),
        ),
        T.StructField("priority", T.StringType()),
    ]
)

PASSENGER = T.StructType(_strings("passengerId", "firstName", "lastName", "email"))

BOOKING_REQUEST = T.StructType(
    [
        T.StructField("passenger", PASSENGER),
        T.StructField("flightId", T.StringType()),
        T.StructField("requestedSeats", T.IntegerType()),
    ]
)

LOG_LINE = T.StructType(_strings("timestamp", "level", "message", "correlationId", "runId", "odGroup"))

# What a create event says about its flight, beside its seats and status.
FLIGHT_RECORD = T.StructType(
    [
        *_strings("flight_number", "origin", "origin_name", "origin_city", "origin_country"),
        *_strings("destination", "destination_name", "destination_city", "destination_country"),
        T.StructField("distance", T.DoubleType()),
        T.StructField("seconds", T.LongType()),
        T.StructField("scheduled_departure", T.TimestampNTZType()),
        T.StructField("scheduled_arrival", T.TimestampNTZType()),
    ]
)

# The event log: one wide typed row per event; columns an event does not carry are null.
JOURNAL = T.StructType(
    [
        T.StructField("ordering", T.LongType()),
        T.StructField("persistence_id", T.StringType()),
        T.StructField("sequence_number", T.LongType()),
        T.StructField("deleted", T.BooleanType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_ts", T.TimestampNTZType()),
        T.StructField("total_seats", T.IntegerType()),
        T.StructField("seats", T.IntegerType()),
        T.StructField("remaining_seats", T.IntegerType()),
        T.StructField("old_status", T.StringType()),
        T.StructField("new_status", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("booking_id", T.StringType()),
        T.StructField("allocation_id", T.StringType()),
        T.StructField("flight", FLIGHT_RECORD),
    ]
)
