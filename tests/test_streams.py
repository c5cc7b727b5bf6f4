"""Streams cut into several micro-batches against the batch operators."""

import pytest
from pyspark.sql import functions as F

from tarmac.operators import allocation, connections, events, seats
from tarmac.operators.skew import DEFAULT, SkewPolicy
from tarmac.plans.catalog import built_journal
from tarmac.sources import tables
from tarmac.streaming import jobs
from tarmac.streaming.versioned import VersionedTable
from tests.test_skew import rows_of


def in_files(df, path, order, files):
    """Write rows as files that follow ``order``, oldest first by name and time."""
    rows = df.orderBy(order).collect()
    size = -(-len(rows) // files)
    for n in range(0, len(rows), size):
        df.sparkSession.createDataFrame(rows[n : n + size], df.schema).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def event_files(spark, small, tmp_path_factory):
    events = tables.read(spark, small, "events")
    return in_files(events, str(tmp_path_factory.mktemp("events") / "events"), "event_id", 4)


@pytest.mark.parametrize("policy", [DEFAULT, SkewPolicy(floor=10, share=0.0, chunk=64)])
def test_flight_commands(spark, small, event_files, tmp_path, policy):
    firsts = tables.first_events(spark, small)
    state, journal = jobs.flight_commands(
        jobs.table_stream(spark, event_files, 1),
        lambda rows: tables.commands_from(rows, firsts),
        str(tmp_path),
        policy,
    )
    assert state.batches().select("batch").distinct().count() >= 4
    expected = seats.seat_state(seats.seat_command_log(tables.commands(spark, small)))
    assert rows_of(state.latest().select(expected.columns)) == rows_of(expected)
    assert rows_of(journal.read()) == rows_of(built_journal(spark, small))


def test_od_demand_windows(spark, tmp_path):
    rows = [(f"2026-01-{1 + n // 4:02d} {n % 24:02d}:00:00", "AB"[n % 2], 1 + n % 7) for n in range(80)]
    asked = spark.createDataFrame(rows, "t string, origin string, seats int").selectExpr(
        "cast(t as timestamp_ntz) as request_time", "origin", "'Z' as destination", "seats"
    )
    path = in_files(asked, str(tmp_path / "asked"), "request_time", 4)
    got = jobs.od_demand(jobs.table_stream(spark, path, 1), str(tmp_path / "out"), "2 days", "5 days")
    expected = jobs.windowed_demand(asked, F.window("requested_at", "5 days"), "2 days")
    assert rows_of(got.select(expected.columns)) == rows_of(expected)


def test_session_windows_close(spark, tmp_path):
    rows = [("2026-01-01 00:00:00", 1), ("2026-01-01 00:20:00", 2), ("2026-01-01 03:00:00", 4), ("2026-01-09 00:00:00", 8)]
    asked = spark.createDataFrame(rows, "t string, seats int").selectExpr(
        "cast(t as timestamp_ntz) as request_time", "'A' as origin", "'Z' as destination", "seats"
    )
    path = in_files(asked, str(tmp_path / "asked"), "request_time", 1)
    demand = jobs.windowed_demand(
        jobs.table_stream(spark, path), F.session_window("requested_at", "30 minutes"), "1 day"
    )
    out = jobs._to_files(demand, str(tmp_path / "out"))
    # the last session is still open
    assert sorted(r.total_seats_requested for r in out.collect()) == [3, 4]


def test_connections(spark, small, tmp_path):
    flights = tables.flights(spark, small)
    path = in_files(flights, str(tmp_path / "flights"), "scheduled_departure", 3)
    stream = jobs.table_stream(spark, path, 1)
    again = jobs.table_stream(spark, path, 1)
    got = jobs.connections(stream, again, str(tmp_path / "out"), "12 hours")
    assert rows_of(got) == rows_of(connections.connections(flights).select(got.columns))


def test_duplicates_across_batches(spark, small, event_files, tmp_path):
    sent = jobs.table_stream(spark, event_files, 1)
    again = jobs.table_stream(spark, event_files, 2)
    got = jobs.without_duplicates(sent.unionByName(again), ["event_id"], "ts", str(tmp_path), "40 days")
    assert rows_of(got) == rows_of(tables.read(spark, small, "events"))


def test_allocation_spends_seats_once(spark, small, tmp_path):
    requests = tables.booking_requests(spark, small)
    path = in_files(requests, str(tmp_path / "asked"), "request_id", 3)
    flights = tables.flights(spark, small)
    given = jobs.allocate(
        jobs.table_stream(spark, path, 1), tables.demands_of, flights, str(tmp_path / "out")
    )
    # with one priority the order of arrival is the order of processing
    per_flight = {r.flight_id: r.s for r in given.groupBy("flight_id").agg(F.sum("seats_allocated").alias("s")).collect()}
    seats_of = {r.flight_id: r.available_seats for r in flights.collect()}
    assert all(taken <= seats_of[f] for f, taken in per_flight.items())
    # whatever the order, each route hands out as many seats as the batch run
    batch = allocation.allocate_greedy(tables.demands_of(requests), flights)
    total = lambda df: rows_of(df.groupBy("origin", "destination").agg(F.sum("seats_allocated")))
    assert total(given) == total(batch)


def test_versioned_table_survives_retries_and_compaction(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], "k string, v int", compact_every=3)
    expected = {}
    for batch in range(8):
        changed = {f"k{batch % 3}": batch, "all": batch * 10}
        rows = spark.createDataFrame(list(changed.items()), "k string, v int")
        for _ in range(2):
            assert {r.k: r.v for r in table.before(batch).collect()} == expected
            table.write(batch, rows)
        expected |= changed
    assert {r.k: r.v for r in table.latest().collect()} == expected


# --- state per key ---------------------------------------------------------------------------


def keyed_log(spark, path, out, files):
    commands = tables.raw_commands_from(jobs.table_stream(spark, path, files))
    return jobs.keyed_flight_commands(commands, str(out))


@pytest.mark.parametrize("files", [1, None])
def test_keyed_commands_equal_the_batch_fold_for_any_split(spark, small, event_files, tmp_path, files):
    log = keyed_log(spark, event_files, tmp_path, files)
    expected = seats.seat_command_log(tables.commands(spark, small))
    columns = ["flight_id", "ordering", "command", "command_ts", "seats", "accepted", "reason", "total_seats", "remaining_seats"]
    assert rows_of(log.select(columns)) == rows_of(expected.select(columns))
    records = tables.flight_records(spark, small).select(F.col("flight_no").cast("string").alias("flight_id"), "flight")
    assert rows_of(jobs.journal_of(log, records)) == rows_of(built_journal(spark, small))


def test_late_and_resent_commands_change_nothing(spark, small, event_files, tmp_path):
    rows = tables.read(spark, small, "events")
    path = str(tmp_path / "in")
    for part in ("event_id < 600", "event_id >= 300 and event_id < 700", "event_id < 50", "event_id >= 700"):
        rows.where(part).coalesce(1).write.mode("append").parquet(path)
    log = keyed_log(spark, path, tmp_path / "out", 1)
    once = seats.seat_command_log(tables.commands(spark, small))
    late = log.where(F.col("reason") == jobs.LATE)
    assert late.count() == 300 + 50 and late.where("accepted").count() == 0
    kept = log.where(F.coalesce(F.col("reason") != jobs.LATE, F.lit(True)))
    columns = ["flight_id", "ordering", "accepted", "remaining_seats"]
    assert rows_of(kept.select(columns)) == rows_of(once.select(columns))


def test_keyed_commands_go_on_after_a_restart(spark, small, event_files, tmp_path):
    rows, path = tables.read(spark, small, "events"), str(tmp_path / "in")
    for part in ("event_id < 500", "event_id >= 500"):
        rows.where(part).coalesce(1).write.mode("append").parquet(path)
        log = keyed_log(spark, path, tmp_path / "out", 1)
    expected = seats.seat_command_log(tables.commands(spark, small))
    columns = ["flight_id", "ordering", "accepted", "total_seats", "remaining_seats"]
    assert rows_of(log.select(columns)) == rows_of(expected.select(columns))


# --- events once -----------------------------------------------------------------------------


def feed(spark):
    """Events up to a day out of order, some resent, some far too late, some without a time or with a reused key."""
    rows = [(n, f"2026-01-{1 + n // 10:02d} {(n * 7) % 24:02d}:00:00", n % 5) for n in range(150)]
    rows += rows[20:60:3] + rows[140:150]
    rows += [(1, "2026-01-20 00:00:00", 9), (1, "2026-01-20 00:00:00", 9), (2, None, 7), (2, None, 7), (3, "2025-12-01 00:00:00", 8)]
    rows += [(3, "2025-12-01 00:00:00", 8), rows[0], rows[5]]
    return spark.createDataFrame(rows, "event_id long, t string, v long").selectExpr("event_id", "cast(t as timestamp_ntz) as ts", "v")


@pytest.mark.parametrize("files", [1, 3, None])
def test_events_come_out_once_for_any_split(spark, tmp_path, files):
    rows = feed(spark).collect()
    for n in range(7):
        part = rows[n * 24 : (n + 1) * 24 if n < 6 else None]
        spark.createDataFrame(part, "event_id long, ts timestamp_ntz, v long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = jobs.table_stream(spark, f"{tmp_path}/in", files)
    got = jobs.without_duplicates(stream, ["event_id"], "ts", f"{tmp_path}/out", "1 day")
    assert rows_of(got) == rows_of(feed(spark).distinct())


def test_late_events_are_put_aside(spark, tmp_path):
    """A row below the watermark goes to the side table, a timely one does not."""
    for n, part in enumerate(("event_id = 100", "event_id = 120", "event_id = 3")):
        feed(spark).where(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = jobs.table_stream(spark, f"{tmp_path}/in", 1)
    got = jobs.without_duplicates(stream, ["event_id"], "ts", f"{tmp_path}/out", "1 day")
    late = spark.read.parquet(f"{tmp_path}/out/late")
    assert {r.event_id for r in late.collect()} == {3} and rows_of(got) == rows_of(feed(spark).where("event_id in (100, 120, 3)").distinct())


# --- snapshots -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def journal_files(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("journal") / "files")
    return tables.in_ordered_files(built_journal(spark, small), path, "ordering", 5)


@pytest.mark.parametrize("files,interval,policy", [(1, 7, DEFAULT), (2, 10, SkewPolicy(floor=5, share=0.0, chunk=2))], ids=["plain", "sliced"])
def test_snapshots_advance(spark, small, journal_files, tmp_path, files, interval, policy):
    state, saved = jobs.snapshots(jobs.table_stream(spark, journal_files, files), str(tmp_path), interval, policy)
    journal = built_journal(spark, small)
    columns = ["persistence_id", "sequence_number", "total_seats", "available_seats", "status", "flight"]
    assert rows_of(jobs.newest_snapshots(saved.read(), 2).select(columns)) == rows_of(events.snapshots(journal, interval, 2).select(columns))
    assert rows_of(state.latest().select(columns)) == rows_of(events.replay(journal).select(columns))


def test_snapshots_survive_a_crash_and_a_resend(spark, small, journal_files, tmp_path, monkeypatch):
    """The third batch fails after it has written half of its tables; the stream is started again."""
    written = []

    class Failing(VersionedTable):
        def write(self, batch_id, changed):
            if batch_id == 2 and not written:
                written.append(batch_id)
                raise RuntimeError("executor lost")
            super().write(batch_id, changed)

    monkeypatch.setattr(jobs, "VersionedTable", Failing)
    journal, again = spark.read.parquet(journal_files), str(tmp_path / "in")
    for part in ("ordering <= 200", "ordering <= 400", "ordering between 100 and 700", "ordering > 650"):
        journal.where(part).coalesce(1).write.mode("append").parquet(again)
    run = lambda: jobs.snapshots(jobs.table_stream(spark, again, 1), str(tmp_path / "out"), 10)
    with pytest.raises(Exception, match="executor lost"):
        run()
    state, saved = run()
    columns = ["persistence_id", "sequence_number", "total_seats", "available_seats", "status"]
    assert written and rows_of(state.latest().select(columns)) == rows_of(events.replay(journal).select(columns))
    assert rows_of(jobs.newest_snapshots(saved.read(), 2).select(columns)) == rows_of(events.snapshots(journal, 10, 2).select(columns))
