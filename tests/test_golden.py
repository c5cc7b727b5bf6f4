"""The worked examples of the domain: create, list, seats, recovery, booking, allocation, demand."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tarmac.operators import allocation, bookings, connections, demand, events, flights, observability, seats
from tarmac.sources import export, ingest

AIRPORTS = {
    "HAN": ("Noi Bai International Airport", "Hanoi"),
    "SGN": ("Tan Son Nhat International Airport", "Ho Chi Minh City"),
    "DAD": ("Da Nang International Airport", "Da Nang"),
}


def body(number, origin, destination, distance, duration, departure, arrival, total, **changes):
    fields = {"flightNumber": number}
    for side, code in (("origin", origin), ("destination", destination)):
        name, city = AIRPORTS[code]
        fields |= {f"{side}Code": code, f"{side}Name": name, f"{side}City": city, f"{side}Country": "Vietnam"}
    fields |= {
        "distance": distance,
        "estimatedDuration": duration,
        "scheduledDeparture": departure,
        "scheduledArrival": arrival,
        "totalSeats": total,
    }
    fields |= changes
    return json.dumps({k: v for k, v in fields.items() if v is not ...})


VN201 = ("VN201", "HAN", "SGN", 1137.0, "PT2H", "2026-04-01T08:00:00", "2026-04-01T10:00:00", 180)
VN571 = ("VN571", "HAN", "DAD", 765.0, "PT1H20M", "2026-04-01T09:00:00", "2026-04-01T10:20:00", 150)
VN133 = ("VN133", "SGN", "DAD", 605.0, "PT1H10M", "2026-04-01T11:00:00", "2026-04-01T12:10:00", 120)


@pytest.fixture(scope="module")
def three(spark):
    lines = spark.createDataFrame([(f[0], body(*f)) for f in (VN201, VN571, VN133)], "flight_id string, body string")
    parsed = ingest.parse_flight_requests(lines)
    return ingest.flatten_flights(ingest.to_flights(ingest.accepted(parsed), F.col("flight_id")))


def test_created_flight(spark):
    lines = spark.createDataFrame([(body(*VN201),)], "body string")
    flight = ingest.to_flights(ingest.accepted(ingest.parse_flight_requests(lines))).first()
    assert (flight.totalSeats, flight.availableSeats, flight.status) == (180, 180, "Scheduled")
    assert len(flight.flightId) == 36
    assert flight.route.estimatedDuration == dt.timedelta(hours=2)
    assert flight.route.origin.name == "Noi Bai International Airport"
    assert flight.scheduledDeparture == dt.datetime(2026, 4, 1, 8)


def test_list_lookup_and_route(spark, three):
    assert {r.flight_number for r in flights.list_flights(three).collect()} == {"VN201", "VN571", "VN133"}
    asked = spark.createDataFrame([("VN201",), ("nonexistent-id-12345",)], "flight_id string")
    replies = {r.flight_id: r for r in flights.lookup_flights(asked, three).collect()}
    assert replies["VN201"].found and replies["VN201"].message is None
    assert replies["nonexistent-id-12345"].message == "Flight nonexistent-id-12345 not found"
    assert [r.flight_id for r in flights.by_route(three, "HAN", "DAD").collect()] == ["VN571"]


@pytest.mark.parametrize(
    "changes,reason",
    [
        ({"scheduledDeparture": "2026-04-01"}, "bad scheduledDeparture"),
        ({"scheduledDeparture": "2026-04-01 08:00:00"}, "bad scheduledDeparture"),
        ({"scheduledArrival": "2026-04-01T10:00:00Z"}, "bad scheduledArrival"),
        ({"scheduledArrival": "2026-04-31T10:00:00"}, "bad scheduledArrival"),
        ({"estimatedDuration": "2h"}, "bad estimatedDuration"),
        ({"totalSeats": ...}, "missing totalSeats"),
        ({"totalSeats": "many"}, "missing totalSeats"),
        ({"scheduledDeparture": "2026-04-01T08:00"}, None),
        ({"totalSeats": 999}, None),
    ],
)
def test_input_rules(spark, changes, reason):
    lines = spark.createDataFrame([(body(*VN201, **changes),)], "body string")
    got = ingest.parse_flight_requests(lines).first().reason
    # a field of the wrong type is reported either as malformed or as missing
    assert got == reason or (changes.get("totalSeats") == "many" and got == "malformed JSON")


def test_malformed_line_and_seat_limit(spark):
    lines = spark.createDataFrame([("{oops",), (body(*VN201, totalSeats=999),)], "body string")
    parsed = ingest.parse_flight_requests(lines)
    assert {r.reason for r in ingest.quarantined(parsed).collect()} == {"malformed JSON"}
    assert {r.reason for r in ingest.quarantined(ingest.flag_seat_limit(parsed)).collect()} == {
        "malformed JSON",
        "bad totalSeats",
    }


def test_allocation_request_rules(spark):
    good = {"runId": "r", "priority": "High", "odPairs": [{"originCode": "HAN", "destinationCode": "SGN", "demand": 50}]}
    cases = [
        (good, None),
        (good | {"priority": "high"}, "bad priority"),
        ({k: v for k, v in good.items() if k != "runId"}, "missing runId"),
        ({k: v for k, v in good.items() if k != "odPairs"}, "missing odPairs"),
        (good | {"odPairs": [{"originCode": "HAN", "demand": 1}]}, "bad odPairs"),
        (good | {"odPairs": []}, None),
    ]
    lines = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)], "i int, body string")
    got = {r.i: r.reason for r in ingest.parse_allocation_requests(lines).collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(cases)}


def seat_log(spark, total, *commands):
    rows = [("1", 0, "create", total)] + [("1", n, kind, k) for n, (kind, k) in enumerate(commands, 1)]
    df = spark.createDataFrame(rows, "flight_id string, ordering long, command string, seats int")
    return seats.seat_command_log(df).orderBy("ordering").collect()


def test_seat_updates(spark):
    log = seat_log(spark, 180, ("allocate", 5), ("allocate", 999), ("allocate", 175), ("release", 2), ("create", 10))
    assert [r.remaining_seats for r in log] == [180, 175, 175, 0, 2, 2]
    assert [r.reason for r in log] == [None, None, "Insufficient seats available", None, None, "Flight already exists"]


def journal_rows(spark, *rows):
    return spark.createDataFrame(
        rows,
        "persistence_id string, sequence_number long, event_type string, total_seats int, seats int, new_status string,"
        " deleted boolean",
    )


def test_recovery_and_cancel(spark):
    journal = journal_rows(
        spark,
        ("flight-a", 1, "FlightCreated", 100, None, "Scheduled", False),
        ("flight-a", 2, "SeatsAllocated", None, 30, None, None),
        ("flight-a", 3, "FlightStatusChanged", None, None, "Boarding", False),
        ("flight-b", 1, "FlightCreated", 50, None, "Scheduled", None),
        ("flight-b", 2, "FlightCancelled", None, None, "Cancelled", None),
        # an event before any create leaves the entity empty
        ("flight-c", 1, "SeatsReleased", None, 5, None, False),
    )
    states = {r.persistence_id: (r.available_seats, r.status) for r in events.replay(journal).collect()}
    assert states == {"flight-a": (70, "Boarding"), "flight-b": (50, "Cancelled")}
    # without marks no event is deleted
    assert events.replay(journal.drop("deleted")).count() == 2
    assert [r.persistence_id for r in events.cancelled(events.replay(journal)).collect()] == ["flight-b"]


def test_booking_takes_and_returns_seats(spark):
    asked = spark.createDataFrame(
        [(1, "F"), (2, "P"), (3, "O")], "request_id long, order_status string"
    ).selectExpr("*", "2 as seats", "'VN201' as flight_id", "timestamp_ntz'2026-04-01 07:30:00' as request_time")
    history = bookings.booking_events(asked)
    states = {r.booking_id: (r.status, r.seats_held) for r in bookings.booking_state(history).collect()}
    assert states == {"bk-1": ("Confirmed", 2), "bk-2": ("Cancelled", 0), "bk-3": ("Created", 0)}
    effects = sorted((r.booking_id, r.seats_taken) for r in bookings.seat_effects(history).collect())
    assert effects == [("bk-1", 2), ("bk-2", -2), ("bk-2", 2)]


def test_allocation_run(spark, three):
    line = json.dumps(
        {
            "runId": "run-2026-04-01-001",
            "odPairs": [
                {"originCode": "HAN", "destinationCode": "SGN", "demand": 50},
                {"originCode": "HAN", "destinationCode": "DAD", "demand": 30},
                {"originCode": "SGN", "destinationCode": "DAD", "demand": 20},
            ],
            "priority": "High",
        }
    )
    parsed = ingest.parse_allocation_requests(spark.createDataFrame([(line,)], "body string"))
    demands = ingest.to_demands(ingest.accepted(parsed), F.lit("alloc-1")).selectExpr(
        "*", "cast(position as long) as request_id", "timestamp_ntz'2026-04-01 07:00:00' as request_time"
    )
    given = allocation.allocate_greedy(demands, three).collect()
    assert sorted((r.flight_id, r.seats_allocated) for r in given) == [("VN133", 20), ("VN201", 50), ("VN571", 30)]
    assert allocation.unallocated(allocation.with_outcome(demands, three)).count() == 0


def test_connection(three):
    found = connections.connections(three).collect()
    assert [(r.first_flight_number, r.second_flight_number) for r in found] == [("VN201", "VN133")]
    assert (found[0].layover_seconds, found[0].total_seconds) == (3_600, 4 * 3_600 + 600)


def test_layover_bounds(spark):
    def leg(name, o, d, dep, arr):
        start = dt.datetime(2026, 1, 1)
        return (name, name, o, d, start + dt.timedelta(seconds=dep), start + dt.timedelta(seconds=arr), "Scheduled")

    gaps = {"44:59": 2_699, "44:59.9": 2_699.9, "45:00": 2_700, "360:59": 21_659, "360:59.9": 21_659.9, "361:00": 21_660}
    rows = [leg("in", "A", "B", 0, 3_600)] + [leg(n, "B", "C", 3_600 + s, 9_000 + s) for n, s in gaps.items()]
    flights_df = spark.createDataFrame(
        rows,
        "flight_id string, flight_number string, origin string, destination string,"
        " scheduled_departure timestamp_ntz, scheduled_arrival timestamp_ntz, status string",
    )
    found = connections.connections(flights_df).collect()
    assert {r.second_flight_id for r in found} == {"45:00", "360:59", "360:59.9"}


def test_demand(spark):
    asked = spark.createDataFrame([(2,)] * 5, "seats int").selectExpr(
        "*",
        "'VN201' as flight_id",
        "'HAN' as origin",
        "'SGN' as destination",
        "timestamp_ntz'2026-04-01 09:15:00' as request_time",
    )
    row = demand.flight_demand(asked).first()
    assert (row.total_requests, row.total_seats_requested, row.average_seats_per_request) == (5, 10, 2.0)
    assert (str(row.period_start), str(row.period_end)) == ("2026-04-01 00:00:00", "2026-04-01 23:59:59")
    assert demand.od_demand(asked).first().od_key == "HAN-SGN"


def test_metrics_of_an_idle_operation(spark):
    listed = spark.createDataFrame([("idle",)], "operation string")
    none = spark.createDataFrame([], "operation string, duration_ms long")
    row = observability.metrics_summary(none, listed).first()
    assert (row["count"], row.avg_ms, row.min_ms, row.max_ms, row.total_ms) == (0, "0.00", 0, 0, 0)


def test_allocation_replies(spark):
    states = spark.createDataFrame(
        [("a", "in-progress", 1, 2, None, None), ("b", "completed", 3, 3, 3, None), ("c", "failed", 0, 3, None, "no feed")],
        "allocation_id string, state string, pairs_done long, pairs_total long, allocations long, fail_reason string",
    )
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "allocation_id string")
    got = {r.allocation_id: (r.status, r.message) for r in allocation.allocation_status(asked, states).collect()}
    assert got == {
        "a": ("in-progress", "50.0% complete"),
        "b": ("completed", "Allocation completed with 3 allocations"),
        "c": ("failed", "no feed"),
        "d": ("not-found", "Allocation d not found"),
    }


def test_listing_files_hold_every_flight(spark, three, tmp_path):
    airports = spark.createDataFrame([(c, n, t, "Vietnam") for c, (n, t) in AIRPORTS.items()], "code string, name string, city string, country string")
    documents = export.flight_documents(three, airports)
    export.write_listing(documents, str(tmp_path / "listing"), files=2)
    listed = []
    for part in (tmp_path / "listing").glob("part-*"):
        if part.stat().st_size:
            listed += json.loads(part.read_text())["flights"]
    assert sorted(f["flightNumber"] for f in listed) == ["VN133", "VN201", "VN571"]
    one = next(f for f in listed if f["flightNumber"] == "VN571")
    assert one["route"]["estimatedDuration"] == "PT1H20M"
    assert one["scheduledDeparture"] == "2026-04-01T09:00:00"
    assert one["route"]["origin"] == {"code": "HAN", "name": AIRPORTS["HAN"][0], "city": "Hanoi", "country": "Vietnam"}
    export.write_documents(documents, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 3


def test_allocation_documents_read_back(spark, three):
    asked = [("a1", "r", n, "HAN", "SGN", 100, 4, n) for n in range(3)] + [("a2", "r", 7, "SGN", "DAD", 20, 1, 0)]
    demands = spark.createDataFrame(
        asked,
        "allocation_id string, run_id string, request_id long, origin string, destination string, seats int,"
        " priority_rank int, position long",
    ).withColumn("request_time", F.expr("timestamp_ntz'2026-04-01 07:35:00'"))
    place = demands.select("request_id", "position")
    given = allocation.allocate_greedy(demands, three).join(place, "request_id")
    airports = spark.createDataFrame([("HAN", "x", "y", "z")], "code string, name string, city string, country string")
    inputs = (allocation.with_outcome(demands, three), given, export.flight_documents(three, airports), F.lit(42))
    parts = export.allocation_documents(*inputs, part=2)
    assert {(r.allocation_id, r.part) for r in parts.collect()} == {("a1", 0), ("a1", 1), ("a2", 0)}
    last = json.loads(parts.where("allocation_id = 'a1' and part = 1").first().document)
    assert list(last)[:4] == ["allocationId", "runId", "part", "parts"] and (last["part"], last["parts"]) == (1, 2)
    documents = export.allocation_documents(*inputs)
    assert documents.count() == 2
    one = json.loads(documents.where("allocation_id = 'a1'").first().document)
    assert list(one) == ["allocationId", "runId", "allocations", "unallocated", "processingTimeMs", "completedAt"]
    assert one["allocations"][0]["flight"]["flightNumber"] == "VN201"
    assert one["unallocated"] == [
        [{s: {"code": c, "name": "", "city": "", "country": ""} for s, c in (("origin", "HAN"), ("destination", "SGN"))}, n]
        for n in (20, 100)
    ]
    assert (one["processingTimeMs"], one["completedAt"]) == (42, "2026-04-01T07:35:00")
    read = export.parse_allocation_documents(documents)
    assert read.where("flight_id is not null").agg(F.sum("seats")).first()[0] == 200
    assert read.where("flight_id is null").agg(F.sum("seats")).first()[0] == 120


def test_files_of_requests_and_logs(spark, tmp_path):
    from tarmac.sources import logs

    (tmp_path / "requests.jsonl").write_text(body(*VN201) + "\n{oops\n")
    parsed = ingest.parse_flight_requests(ingest.read_request_lines(spark, str(tmp_path / "requests.jsonl")))
    assert ingest.accepted(parsed).count() == 1 and ingest.quarantined(parsed).first().body == "{oops"
    line = {"timestamp": "2026-03-16T10:30:45.123Z", "level": "INFO", "message": "m", "correlationId": "550e"}
    (tmp_path / "app.log").write_text(json.dumps(line) + "\n")
    row = observability.run_trace(logs.read_logs(spark, str(tmp_path / "app.log"))).first()
    assert (row.correlation_id, row.run_id, row.lines, str(row.first_at)) == ("550e", None, 1, "2026-03-16 10:30:45.123000")


def test_status_names_are_exact(spark):
    lines = spark.createDataFrame([('{"status": "Boarding"}',), ('{"status": "boarding"}',), ('{"seats": 5}',), ("{}",)], "body string")
    assert [r.reason for r in ingest.parse_updates(lines).collect()] == [None, "bad status", None, "malformed JSON"]
