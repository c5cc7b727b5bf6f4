"""Reading flight and allocation requests from JSON, with quarantine of bad records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.capacity import priority_rank
from tarmac.functions.durations import interval_of, is_duration, parse_duration_micros, parse_local_date_time
from tarmac.schemas import (
    ALLOCATION_REQUEST,
    BOOKING_REQUEST,
    CREATE_FLIGHT_REQUEST,
    FLIGHT_STATUSES,
    MAX_SEATS_PER_FLIGHT,
    PASSENGER,
    PRIORITIES,
)

CORRUPT = "_corrupt_record"


def read_request_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as text in ``body``; parsing is left to the rules below so that a bad line is kept."""
    return spark.read.text(path).withColumnRenamed("value", "body")


def parse_flight_requests(lines: DataFrame, body: str = "body") -> DataFrame:
    """Parse create-flight bodies into ``request``, with times in ``parsed``, and say what is wrong
    with each in ``reason``, which is null for a good record. Every field is required."""
    request = F.from_json(
        F.col(body),
        CREATE_FLIGHT_REQUEST.simpleString().removesuffix(">") + f",{CORRUPT}:string>",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    field = F.col("request").getField
    times = F.struct(
        parse_local_date_time(field("scheduledDeparture")).alias("departure"),
        parse_local_date_time(field("scheduledArrival")).alias("arrival"),
        parse_duration_micros(field("estimatedDuration")).alias("duration_micros"),
    )
    parsed = _once(_once(lines, request, "request"), times, "parsed")
    return parsed.withColumn("reason", _flight_request_problem()).withColumn(
        "request", F.col("request").dropFields(CORRUPT)
    )


def _once(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column through a one-element explode: rules and filters that use its fields then
    cannot be rewritten to parse the text again for each of them."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _flight_request_problem() -> Column:
    field, parsed = F.col("request").getField, F.col("parsed").getField
    missing = F.coalesce(
        *[F.when(field(name).isNull(), F.lit(f"missing {name}")) for name in CREATE_FLIGHT_REQUEST.names]
    )
    return F.coalesce(
        F.when(F.col("request").isNull() | field(CORRUPT).isNotNull(), F.lit("malformed JSON")),
        missing,
        F.when(parsed("departure").isNull(), F.lit("bad scheduledDeparture")),
        F.when(parsed("arrival").isNull(), F.lit("bad scheduledArrival")),
        F.when(
            parsed("duration_micros").isNull(),
            F.when(is_duration(field("estimatedDuration")), F.lit("estimatedDuration too long")).otherwise("bad estimatedDuration"),
        ),
    )


def flag_seat_limit(parsed: DataFrame) -> DataFrame:
    """Stricter optional rule: seats must be between 1 and the configured maximum."""
    return parsed.withColumn(
        "reason",
        F.coalesce(
            "reason",
            F.when(~F.col("request.totalSeats").between(1, MAX_SEATS_PER_FLIGHT), F.lit("bad totalSeats")),
        ),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).drop("reason")


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).drop("request", "parsed")


def to_flights(good: DataFrame, flight_id: Column | None = None) -> DataFrame:
    """Accepted requests as nested flight records: all seats free, status Scheduled.

    Without a ``flight_id`` column a random UUID is drawn.
    """
    r = F.col("request").getField

    def airport(side: str) -> Column:
        return F.struct(*[r(f"{side}{part}").alias(part.lower()) for part in ("Code", "Name", "City", "Country")])

    return good.select(
        (F.expr("uuid()") if flight_id is None else flight_id).alias("flightId"),
        r("flightNumber").alias("flightNumber"),
        F.struct(
            airport("origin").alias("origin"),
            airport("destination").alias("destination"),
            r("distance").alias("distance"),
            interval_of(F.col("parsed.duration_micros")).alias("estimatedDuration"),
        ).alias("route"),
        F.col("parsed.departure").alias("scheduledDeparture"),
        F.col("parsed.arrival").alias("scheduledArrival"),
        r("totalSeats").alias("totalSeats"),
        r("totalSeats").alias("availableSeats"),
        F.lit(FLIGHT_STATUSES[0]).alias("status"),
    )


def flatten_flights(flights: DataFrame) -> DataFrame:
    """Nested flight records to the flat columns the operators use."""
    return flights.select(
        F.col("flightId").alias("flight_id"),
        F.col("flightNumber").alias("flight_number"),
        F.col("route.origin.code").alias("origin"),
        F.col("route.destination.code").alias("destination"),
        F.col("route.distance").alias("distance"),
        F.col("scheduledDeparture").alias("scheduled_departure"),
        F.col("scheduledArrival").alias("scheduled_arrival"),
        F.col("totalSeats").alias("total_seats"),
        F.col("availableSeats").alias("available_seats"),
        "status",
    )


def parse_updates(lines: DataFrame, body: str = "body") -> DataFrame:
    """Parse update bodies, ``{"status": name}`` or ``{"seats": n}``; status names are exact."""
    parsed = _once(lines, F.from_json(F.col(body), "status string, seats int"), "update")
    status, seats = F.col("update.status"), F.col("update.seats")
    reason = F.coalesce(
        F.when(F.col("update").isNull() | (status.isNull() & seats.isNull()), F.lit("malformed JSON")),
        F.when(status.isNotNull() & ~status.isin(FLIGHT_STATUSES), F.lit("bad status")),
    )
    return parsed.withColumns({"status": status, "seats": seats, "reason": reason}).drop("update")


def parse_booking_requests(lines: DataFrame, body: str = "body") -> DataFrame:
    """Parse booking bodies: a passenger, a flight and a positive number of seats. ``reason`` is null for a good record.

    Every field is required; an e-mail address needs text on both sides of its only ``@``.
    """
    schema = BOOKING_REQUEST.simpleString().removesuffix(">") + f",{CORRUPT}:string>"
    request = F.from_json(F.col(body), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = _once(lines, request, "request")
    r = F.col("request").getField
    who = r("passenger")
    missing = F.coalesce(
        F.when(who.isNull(), F.lit("missing passenger")),
        *[F.when(who.getField(name).isNull(), F.lit(f"missing {name}")) for name in PASSENGER.names],
        *[F.when(r(name).isNull(), F.lit(f"missing {name}")) for name in ("flightId", "requestedSeats")],
    )
    return parsed.withColumn(
        "reason",
        F.coalesce(
            F.when(F.col("request").isNull() | r(CORRUPT).isNotNull(), F.lit("malformed JSON")),
            missing,
            F.when(~who.getField("email").rlike("^[^@\\s]+@[^@\\s]+$"), F.lit("bad email")),
            F.when(r("requestedSeats") < 1, F.lit("bad requestedSeats")),
        ),
    ).withColumn("request", F.col("request").dropFields(CORRUPT))


def to_bookings(good: DataFrame, booking_id: Column | None = None) -> DataFrame:
    """Accepted booking requests as flat rows; without a ``booking_id`` column a random UUID is drawn."""
    r = F.col("request").getField
    return good.select(
        (F.expr("uuid()") if booking_id is None else booking_id).alias("booking_id"),
        r("passenger").getField("passengerId").alias("passenger_id"),
        F.concat_ws(" ", r("passenger").getField("firstName"), r("passenger").getField("lastName")).alias("passenger_name"),
        r("passenger").getField("email").alias("email"),
        r("flightId").alias("flight_id"),
        r("requestedSeats").alias("seats"),
    )


def parse_allocation_requests(lines: DataFrame, body: str = "body") -> DataFrame:
    """Parse allocation-request bodies; ``reason`` is null for a good record."""
    parsed = _once(lines, F.from_json(F.col(body), ALLOCATION_REQUEST), "request")
    r = F.col("request").getField
    complete = F.forall(
        r("odPairs"),
        lambda pair: pair.originCode.isNotNull() & pair.destinationCode.isNotNull() & pair.demand.isNotNull(),
    )
    return parsed.withColumn(
        "reason",
        F.coalesce(
            F.when(F.col("request").isNull(), F.lit("malformed JSON")),
            F.when(r("runId").isNull(), F.lit("missing runId")),
            F.when(r("odPairs").isNull(), F.lit("missing odPairs")),
            F.when(~F.coalesce(complete, F.lit(False)), F.lit("bad odPairs")),
            F.when(F.exists(r("odPairs"), lambda pair: pair.demand < 0), F.lit("negative demand")),
            F.when(F.coalesce(~r("priority").isin(PRIORITIES), F.lit(True)), F.lit("bad priority")),
        ),
    )


def to_demands(good: DataFrame, allocation_id: Column | None = None) -> DataFrame:
    """One row per O&D pair of each request; ``position`` is its place in the list.

    Airports carry their code only.
    """
    return good.select(
        (F.expr("uuid()") if allocation_id is None else allocation_id).alias("allocation_id"),
        F.col("request.runId").alias("run_id"),
        F.col("request.priority").alias("priority"),
        priority_rank(F.col("request.priority")).alias("priority_rank"),
        F.posexplode("request.odPairs").alias("position", "pair"),
    ).select(
        "allocation_id",
        "run_id",
        "priority",
        "priority_rank",
        "position",
        F.col("pair.originCode").alias("origin"),
        F.col("pair.destinationCode").alias("destination"),
        F.col("pair.demand").alias("seats"),
    )
