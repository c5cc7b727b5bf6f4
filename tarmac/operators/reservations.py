"""Booking commands against the seats of flights: two families of entities decided in one fold.

A booking is created, confirmed on a flight and cancelled. Confirming takes the flight's seats or is refused, cancelling
gives back what was taken, so what happens to a booking depends on all bookings of its flight before it, and what happens
to a flight on its bookings. What needs no seats is decided per booking by plain aggregates: which create counts, which
cancel ends the booking, and every command before, after or beside them. Only confirms of living bookings and the
cancels that end one go on; they are sorted by flight and folded in one pass over Arrow batches.

The fold holds one flight's counter and the bookings that hold its seats, so never more entries than the flight has
seats. Both families are numbered in the same pass. Commands of one flight are decided one after another by nature, since
a confirmation that is refused leaves nothing to give back: a flight is one task's work, however many tasks there are.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.seats import BAD_SEATS, NOT_FOUND, UNKNOWN, gathered, ints, new_keys
from tarmac.schemas import BOOKING_ID_PREFIX, FLIGHT_ID_PREFIX, INSUFFICIENT_SEATS

# functions of this module travel to the executors whole, so these need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BOOKING_EXISTS = "Booking already exists"
BOOKING_NOT_FOUND = "Booking not found"
BOOKING_CONFIRMED = "Booking already confirmed"
BOOKING_CANCELLED = "Booking already cancelled"

COMMANDS = ("create", "confirm", "cancel")
_START = "start"
_DECISION = (
    "accepted boolean, reason string, sequence_number long, seats_taken long, remaining_seats int, flight_sequence_number long"
)


def _known(commands: DataFrame) -> DataFrame:
    """Commands with what their booking's first valid create says (``born``, ``on_flight``, ``held``) and with ``ended``,
    the first cancel after it."""
    order = F.col("ordering")
    creates = commands.where((F.col("command") == "create") & (F.col("seats") > 0))
    births = creates.groupBy("booking_id").agg(
        F.min(order).alias("born"), F.min_by(F.struct("flight_id", "seats"), order).alias("made")
    )
    births = births.select("booking_id", "born", F.col("made.flight_id").alias("on_flight"), F.col("made.seats").alias("held"))
    with_birth = commands.join(births, ["booking_id"], "left")
    ends = (
        with_birth.where((F.col("command") == "cancel") & (order > F.col("born")))
        .groupBy("booking_id")
        .agg(F.min(order).alias("ended"))
    )
    return with_birth.join(ends, ["booking_id"], "left")


def _refusal() -> Column:
    """Why a command fails whatever seats there are; null when the seats decide or nothing is wrong."""
    order, command = F.col("ordering"), F.col("command")
    unborn = F.coalesce(order < F.col("born"), F.lit(True))
    return (
        F.when(~F.coalesce(command.isin(*COMMANDS), F.lit(False)), UNKNOWN)
        .when((command == "create") & ~F.coalesce(F.col("seats") > 0, F.lit(False)), BAD_SEATS)
        .when((command == "create") & (order != F.col("born")), BOOKING_EXISTS)
        .when((command != "create") & unborn, BOOKING_NOT_FOUND)
        .when((command != "create") & (order > F.col("ended")), BOOKING_CANCELLED)
    )


def booking_command_log(commands: DataFrame, flights: DataFrame) -> DataFrame:
    """Decide every booking command, in ``ordering``.

    ``commands``: booking_id, ordering (unique), command, and on creates flight_id and seats; other columns are kept.
    ``flights``: flight_id, available_seats and last_number, the flight's newest sequence number. Columns added:
    accepted, reason; on accepted commands ``sequence_number`` of the booking's event; where seats moved
    ``seats_taken`` (negative when given back), ``remaining_seats`` and ``flight_sequence_number`` of the flight's event.
    A booking without a flight is never confirmed. A refused confirmation may be tried again.
    """
    judged = _known(commands).withColumn("refusal", _refusal())
    given = commands.columns
    by_seats = F.col("refusal").isNull() & F.col("command").isin("confirm", "cancel")
    nothing = F.lit(None)
    settled = judged.where(~by_seats).select(
        *given,
        F.col("refusal").isNull().alias("accepted"),
        F.col("refusal").alias("reason"),
        F.when(F.col("refusal").isNull(), F.lit(1)).cast("long").alias("sequence_number"),
        nothing.cast("long").alias("seats_taken"),
        nothing.cast("int").alias("remaining_seats"),
        nothing.cast("long").alias("flight_sequence_number"),
    )
    open_ = judged.where(by_seats).select(*given, "on_flight", "held")
    return settled.unionByName(_fold(open_, flights, given))


def _fold(commands: DataFrame, flights: DataFrame, given: list[str]) -> DataFrame:
    fields = [f"`{name}` {commands.schema[name].dataType.simpleString()}" for name in given]
    starts = flights.select(
        F.col("flight_id").alias("on_flight"),
        F.lit(_START).alias("command"),
        F.col("available_seats").cast("int").alias("start_free"),
        F.col("last_number").cast("long").alias("start_number"),
    )
    rows = commands.unionByName(starts, allowMissingColumns=True)
    return gathered(rows, ["on_flight"], ["ordering"]).mapInArrow(_folder(given), ", ".join([*fields, _DECISION]))


def _folder(given: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.array([_START, "confirm", "cancel"])
        start, confirm, _ = range(3)
        reasons = pa.array([None, NOT_FOUND, INSUFFICIENT_SEATS, BOOKING_CONFIRMED])
        accepted, no_flight, insufficient, again = range(4)
        flight, free, number, holding = None, None, 0, {}  # free is None while the flight is not known
        for batch in batches:
            if not batch.num_rows:
                continue
            verdicts, numbers, taken, left, flight_numbers = [], [], [], [], []
            keep = pc.not_equal(batch.column("command"), _START)
            columns = zip(
                new_keys(batch, ["on_flight"], flight),
                ints(pc.index_in(batch.column("command"), kinds)),
                batch.column("booking_id").to_pylist(),
                ints(batch.column("held")),
                ints(batch.column("start_free")),
                ints(batch.column("start_number")),
                batch.column("on_flight").is_valid().to_pylist(),
            )
            for new, kind, booking, seats, start_free, start_number, named in columns:
                if new:
                    free, number, holding = None, 0, {}
                if kind == start:
                    free, number = start_free, start_number
                    continue
                verdict, moved = accepted, 0
                sequence = 2
                if kind == confirm:
                    if free is None or not named:
                        verdict = no_flight
                    elif booking in holding:
                        verdict = again
                    elif free < seats:
                        verdict = insufficient
                    else:
                        moved = holding[booking] = seats
                elif booking in holding:
                    moved, sequence = -holding.pop(booking), 3
                if moved:
                    free -= moved
                    number += 1
                verdicts.append(verdict)
                numbers.append(sequence if verdict == accepted else None)
                taken.append(moved or None)
                left.append(free if moved else None)
                flight_numbers.append(number if moved else None)
            flight = (batch.column("on_flight")[batch.num_rows - 1].as_py(),)
            decided, codes = batch.filter(keep), pa.array(verdicts, pa.int8())
            yield pa.RecordBatch.from_arrays(
                [
                    *[decided.column(n) for n in given],
                    pc.equal(codes, accepted),
                    pc.take(reasons, codes),
                    pa.array(numbers, pa.int64()),
                    pa.array(taken, pa.int64()),
                    pa.array(left, pa.int32()),
                    pa.array(flight_numbers, pa.int64()),
                ],
                names=[*given, "accepted", "reason", "sequence_number", "seats_taken", "remaining_seats", "flight_sequence_number"],
            )

    return fold


def booking_seat_events(log: DataFrame) -> DataFrame:
    """Events of both families from a decided log that has ``command_ts``: what happened to each booking, numbered per
    booking, and what that did to its flight, numbered per flight after the flight's own events.

    Every event names its booking; flights are named by the persistence id of their own events.
    """
    done = log.where("accepted")
    kind = (
        F.when(F.col("command") == "create", "BookingCreated")
        .when(F.col("command") == "confirm", "BookingConfirmed")
        .otherwise("BookingCancelled")
    )
    made = done.where("command = 'create'").select("booking_id", F.col("flight_id").alias("of_flight"), F.col("seats").alias("of_seats"))
    about = done.drop("flight_id", "seats").join(made, "booking_id")
    booked = about.select(
        F.concat(F.lit(BOOKING_ID_PREFIX), "booking_id").alias("persistence_id"),
        "sequence_number",
        kind.alias("event_type"),
        F.col("command_ts").alias("event_ts"),
        "booking_id",
        F.col("of_seats").alias("seats"),
        F.lit(None).cast("int").alias("remaining_seats"),
    )
    moved = about.where("seats_taken is not null").select(
        F.concat(F.lit(FLIGHT_ID_PREFIX), "of_flight").alias("persistence_id"),
        F.col("flight_sequence_number").alias("sequence_number"),
        F.when(F.col("seats_taken") > 0, "SeatsAllocated").otherwise("SeatsReleased").alias("event_type"),
        F.col("command_ts").alias("event_ts"),
        "booking_id",
        F.abs("seats_taken").cast("int").alias("seats"),
        "remaining_seats",
    )
    return booked.unionByName(moved)


def booking_states(log: DataFrame) -> DataFrame:
    """Each booking's flight, seats, status and the seats it holds."""
    done = log.where("accepted")
    return done.groupBy("booking_id").agg(
        F.max(F.when(F.col("command") == "create", F.col("flight_id"))).alias("flight_id"),
        F.max(F.when(F.col("command") == "create", F.col("seats"))).alias("seats"),
        F.max_by(
            F.when(F.col("command") == "create", "Created").when(F.col("command") == "confirm", "Confirmed").otherwise("Cancelled"),
            "sequence_number",
        ).alias("status"),
        F.coalesce(F.sum("seats_taken"), F.lit(0)).cast("long").alias("seats_held"),
    )


def flights_after(log: DataFrame, flights: DataFrame) -> DataFrame:
    """Free seats of every flight after the log: what it had, less the seats its bookings hold."""
    made = log.where("accepted and command = 'create'").select("booking_id", F.col("flight_id").alias("of_flight"))
    moved = log.where("seats_taken is not null").select("booking_id", "seats_taken").join(made, "booking_id")
    taken = moved.groupBy(F.col("of_flight").alias("flight_id")).agg(F.sum("seats_taken").alias("taken"))
    return flights.join(taken, "flight_id", "left").select(
        "flight_id", (F.col("available_seats") - F.coalesce("taken", F.lit(0))).cast("int").alias("available_seats")
    )
