"""Bookings that take seats, against a plain loop; booking bodies and their rules."""

import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tarmac.operators import reservations as res
from tarmac.operators import seats
from tarmac.schemas import INSUFFICIENT_SEATS
from tarmac.sources import ingest


def decide(commands, flights):
    """(ordering, accepted, reason, booking number, seats moved, seats left, flight number) of each command."""
    free, number = {f: a for f, a, _ in flights}, {f: n for f, _, n in flights}
    books, out = {}, []
    for booking, order, command, flight, want in sorted(commands, key=lambda c: c[1]):
        book, reason, mine, moved = books.get(booking), None, None, 0
        if command not in ("create", "confirm", "cancel"):
            reason = seats.UNKNOWN
        elif command == "create" and (want is None or want <= 0):
            reason = seats.BAD_SEATS
        elif command == "create":
            if book:
                reason = res.BOOKING_EXISTS
            else:
                books[booking], mine = {"flight": flight, "seats": want, "state": "created"}, 1
        elif book is None:
            reason = res.BOOKING_NOT_FOUND
        elif book["state"] == "cancelled":
            reason = res.BOOKING_CANCELLED
        elif command == "confirm":
            if book["flight"] not in free:
                reason = seats.NOT_FOUND
            elif book["state"] == "confirmed":
                reason = res.BOOKING_CONFIRMED
            elif free[book["flight"]] < book["seats"]:
                reason = INSUFFICIENT_SEATS
            else:
                book["state"], mine, moved = "confirmed", 2, book["seats"]
        else:
            moved = -book["seats"] if book["state"] == "confirmed" else 0
            book["state"], mine = "cancelled", 3 if moved else 2
        left = nth = None
        if moved:
            free[book["flight"]] -= moved
            number[book["flight"]] += 1
            left, nth = free[book["flight"]], number[book["flight"]]
        out.append((order, reason is None, reason, mine, moved or None, left, nth))
    return out, free


def case(seed):
    rng = random.Random(seed)
    flights = [(f"F{n}", rng.randrange(0, 40), rng.randrange(1, 4)) for n in range(6)]
    commands = []
    for order in range(900):
        booking = f"b{rng.randrange(120)}"
        flight = "F0" if rng.random() < 0.4 else rng.choice([None, "F9", *(f for f, _, _ in flights)])
        kind = rng.choices(["create", "confirm", "cancel", "fly", None], [4, 6, 2, 0.2, 0.2])[0]
        commands.append((booking, order, kind, flight, rng.choice([None, 0, -2, 1, 2, 3, 5, 8])))
    return commands, flights


def frames(spark, commands, flights):
    rows = spark.createDataFrame(commands, "booking_id string, ordering long, command string, flight_id string, seats int")
    return rows.repartition(5), spark.createDataFrame(flights, "flight_id string, available_seats int, last_number long")


DECIDED = ["ordering", "accepted", "reason", "sequence_number", "seats_taken", "remaining_seats", "flight_sequence_number"]


@pytest.mark.parametrize("seed,batch", [(1, "10000"), (2, "37"), (3, "37")])
def test_commands_equal_a_plain_loop(spark, seed, batch):
    commands, flights = case(seed)
    rows, known = frames(spark, commands, flights)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        log = res.booking_command_log(rows.withColumn("kept", F.lit("x")), known)
        got = sorted(tuple(r) for r in log.select(*DECIDED).collect())
        free = {r.flight_id: r.available_seats for r in res.flights_after(log, known).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want, left = decide(commands, flights)
    assert got == want and free == left and "kept" in log.columns


def test_both_families_are_numbered_without_gaps(spark):
    commands, flights = case(7)
    rows, known = frames(spark, commands, flights)
    log = res.booking_command_log(rows.withColumn("command_ts", F.expr("timestamp_ntz'2026-04-01 07:30:00'")), known)
    numbers = defaultdict(list)
    for r in res.booking_seat_events(log).collect():
        numbers[r.persistence_id].append(r.sequence_number)
    heads = {f"flight-{f}": n for f, _, n in flights}
    assert numbers and all(sorted(n) == list(range(heads.get(p, 0) + 1, heads.get(p, 0) + 1 + len(n))) for p, n in numbers.items())
    held = log.groupBy().agg(F.sum("seats_taken")).first()[0]
    assert held == res.booking_states(log).agg(F.sum("seats_held")).first()[0]


def test_book_two_seats_then_cancel(spark):
    commands = [("bk", 1, "create", "VN201", 2), ("bk", 2, "confirm", None, None), ("bk", 3, "cancel", None, None)]
    rows, known = frames(spark, commands, [("VN201", 180, 1)])
    log = res.booking_command_log(rows, known).orderBy("ordering").collect()
    assert [(r.accepted, r.seats_taken, r.remaining_seats) for r in log] == [(True, None, None), (True, 2, 178), (True, -2, 180)]


def test_no_commands(spark):
    rows, known = frames(spark, [], [("F", 1, 1)])
    log = res.booking_command_log(rows, known)
    assert log.count() == 0 and res.flights_after(log, known).first().available_seats == 1


GOOD = {
    "passenger": {"passengerId": "pax-001", "firstName": "Nguyen", "lastName": "Van A", "email": "nguyen.vana@example.com"},
    "flightId": "F1",
    "requestedSeats": 2,
}


def test_booking_bodies(spark):
    who = GOOD["passenger"]
    cases = [
        (GOOD, None),
        (GOOD | {"requestedSeats": 0}, "bad requestedSeats"),
        (GOOD | {"passenger": None}, "missing passenger"),
        (GOOD | {"passenger": who | {"email": "a@b@c"}}, "bad email"),
        (GOOD | {"passenger": {k: v for k, v in who.items() if k != "lastName"}}, "missing lastName"),
        ({k: v for k, v in GOOD.items() if k != "flightId"}, "missing flightId"),
    ]
    bodies = [(str(i), json.dumps(c)) for i, (c, _) in enumerate(cases)] + [("bad", "{oops"), ("null", None), ("empty", "")]
    parsed = ingest.parse_booking_requests(spark.createDataFrame(bodies, "i string, body string"))
    got = {r.i: r.reason for r in parsed.collect()}
    assert got == {str(i): reason for i, (_, reason) in enumerate(cases)} | dict.fromkeys(("bad", "null", "empty"), "malformed JSON")
    booking = ingest.to_bookings(ingest.accepted(parsed)).first()
    assert (booking.passenger_name, booking.flight_id, booking.seats, len(booking.booking_id)) == ("Nguyen Van A", "F1", 2, 36)
