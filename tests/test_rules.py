"""Inputs off the usual path: bad commands, odd demands, deleted events, streams in many batches."""

import pytest
from pyspark.sql import functions as F

from tarmac.operators import allocation, events, seats
from tarmac.operators.skew import DEFAULT, SkewPolicy
from tarmac.streaming import jobs

SLICED = SkewPolicy(floor=2, chunk=3)


@pytest.mark.parametrize("policy", [DEFAULT, SLICED], ids=["plain", "sliced"])
def test_bad_commands_are_rejected_and_change_nothing(spark, policy):
    rows = [
        ("f", 1, "create", None), ("f", 2, "create", -2_000_000_000), ("f", 3, "create", 10), ("f", 4, "allocate", None),
        ("f", 5, "allocate", -5), ("f", 6, "allocate", 0), ("f", 7, "release", -1), ("f", 8, "fly", 3), ("f", 9, None, 3),
        ("f", 10, "allocate", 4), ("f", 11, "status", None), ("f", 12, "release", 1), ("f", 13, "create", 0), ("g", 14, "create", 5),
    ]
    df = spark.createDataFrame(rows, "flight_id string, ordering long, command string, seats int")
    got = {r.ordering: (r.accepted, r.reason, r.remaining_seats) for r in seats.seat_command_log(df, policy=policy).collect()}
    bad, unknown = (False, seats.BAD_SEATS), (False, seats.UNKNOWN)
    assert got == {
        1: (*bad, None), 2: (*bad, None), 3: (True, None, 10), 4: (*bad, 10), 5: (*bad, 10), 6: (*bad, 10), 7: (*bad, 10),
        8: (*unknown, 10), 9: (*unknown, 10), 10: (True, None, 6), 11: (True, None, 6), 12: (True, None, 7), 13: (*bad, 7),
        14: (True, None, 5),
    }


def test_odd_demands(spark):
    flights = spark.createDataFrame(
        [("F1", "A", "B", 5, "Scheduled", 1), ("F2", "A", "B", 5, "Scheduled", 2)],
        "flight_id string, origin string, destination string, available_seats int, status string, h int",
    ).withColumn("scheduled_departure", F.expr("timestamp_ntz'2026-01-01' + make_interval(0, 0, 0, 0, h)"))
    demands = spark.createDataFrame(
        [("a", "r", n, "A", "B", s, 1) for n, s in enumerate((10, -5, 0, None))],
        "allocation_id string, run_id string, request_id long, origin string, destination string, seats int, priority_rank int",
    ).withColumn("request_time", F.expr("timestamp_ntz'2026-01-01 00:00:00'"))
    given = allocation.allocate_greedy(demands, flights).agg(F.sum("seats_allocated")).first()[0]
    outcome = {r.request_id: (r.allocated_seats, r.unallocated_seats) for r in allocation.with_outcome(demands, flights).collect()}
    assert given == 10 and outcome == {0: (10, 0), 2: (0, 0)}


EVENTS = "persistence_id string, sequence_number long, event_type string, total_seats int, seats int, new_status string, deleted boolean"


def journal(spark, rows):
    df = spark.createDataFrame(rows, EVENTS)
    return df.withColumns({"remaining_seats": F.lit(None).cast("int"), "ordering": F.col("sequence_number"), "event_ts": F.lit(None).cast("timestamp_ntz")})


ODD = [
    ("x", 1, "SeatsReleased", None, 5, None, False), ("x", 2, "FlightStatusChanged", None, None, "Delayed", False),
    ("x", 3, "FlightCreated", 90, None, "Scheduled", True), ("x", 4, "FlightCreated", 100, None, "Scheduled", False),
    ("x", 5, "SeatsAllocated", None, 30, None, True), ("x", 6, "SeatsAllocated", None, 20, None, False),
    ("x", 7, "FlightCreated", 50, None, "Scheduled", False), ("x", 8, "FlightStatusChanged", None, None, "Boarding", False),
    ("y", 1, "SeatsAllocated", None, 3, None, False),
]


def test_replay_is_the_fold(spark):
    df = journal(spark, ODD)
    want = [("x", 100, 80, "Boarding", 8)]
    key = lambda r: (r.persistence_id, r.total_seats, r.available_seats, r.status, r.sequence_number)
    assert [key(r) for r in events.replay(df).collect()] == want
    for interval in (1, 2, 3, 4):
        saved = events.snapshots(df, interval=interval, keep=2)
        assert [key(r) for r in events.replay_from_snapshots(df, saved, interval=interval).collect()] == want
    changes = [(r.old_status, r.new_status) for r in events.status_transitions(df).orderBy("sequence_number").collect()]
    assert changes == [(None, "Scheduled"), ("Scheduled", "Boarding")]
    assert events.audit_trail(df).count() == len(ODD) - 2
    ids = spark.createDataFrame([("x",), ("y",)], "entity_id string")
    flights = df.withColumn("persistence_id", F.concat(F.lit("flight-"), "persistence_id"))
    assert [r[0] for r in events.unrecovered(ids, events.replay(flights)).collect()] == ["flight-y"]


def test_dedup_loses_nothing_in_many_batches(spark, small, tmp_path):
    """Files out of time order, one to a batch, and a delay far below the span of the data."""
    table = spark.read.parquet(f"{small}/events.parquet")
    for n in range(3):
        table.where(f"event_id % 3 = {n}").orderBy(F.desc("ts")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    table.where("event_id % 5 = 0").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    arriving = jobs.table_stream(spark, f"{tmp_path}/in", files_per_batch=1)
    got = jobs.without_duplicates(arriving, ["event_id"], "ts", f"{tmp_path}/out", "1 day")
    assert sorted(r.event_id for r in got.collect()) == sorted(r.event_id for r in table.collect())


def test_metadata_is_merged_last_write_wins(spark):
    from tarmac.operators import observability

    rows = [("a", 1, {"x": "1", "y": "2"}), ("a", 3, {"x": "3", "z": None}), ("a", 2, {"x": "2", "y": "5"}), ("a", 4, None), ("b", 1, {}), ("c", 1, {"k": "v"})]
    records = spark.createDataFrame(rows, "operation string, n int, metadata map<string,string>")
    merged = observability.merged_metadata(records, ["operation"], "metadata", F.col("n"))
    texts = {r.operation: r.text for r in merged.select("operation", observability.metadata_text("metadata").alias("text")).collect()}
    assert texts == {"a": "x=3, y=5", "c": "k=v"}


def test_checkpoints_become_metadata(spark):
    from tarmac.operators import observability

    logs = spark.createDataFrame([("r", "load", 0), ("r", "save", 40), ("r", "check", 15), ("q", "load", 0)], "run_id string, message string, s int").withColumn(
        "logged_at", F.expr("timestampadd(SECOND, s, timestamp_ntz'2026-01-01 00:00:00')")
    )
    notes = [("r", 1, {"rows": "7", "checkpoint_0_load": "own"})]
    records = spark.createDataFrame(notes, "run_id string, n int, metadata map<string,string>")
    found = {r.operation: r for r in observability.run_metrics(records, logs, F.col("n")).collect()}
    assert found["r"].metadata == {"rows": "7", "checkpoint_0_load": "0ms", "checkpoint_1_check": "15000ms", "checkpoint_2_save": "40000ms"}
    assert (found["r"].duration_ms, found["q"].metadata) == (40_000, {"checkpoint_0_load": "0ms"}) and found["q"].timestamp is not None
