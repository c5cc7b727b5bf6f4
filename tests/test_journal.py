import json

import pytest
from pyspark.sql import functions as F

from tarmac.operators import events, flights
from tarmac.plans.catalog import built_journal
from tarmac.sources import journal as event_log
from tests.test_skew import rows_of


def test_append_in_two_steps_equals_one(spark, small, tmp_path):
    """A journal appended in two batches, the second of them sent twice, equals one numbering."""
    whole = built_journal(spark, small).cache()
    decided = whole.drop("sequence_number", "old_status")
    path = str(tmp_path / "journal")
    first, second = decided.where("ordering <= 400"), decided.where("ordering > 400")
    event_log.append(event_log.new_events(first), path)
    for _ in range(2):
        so_far = event_log.read_journal(spark, path)
        fresh = event_log.not_yet_journaled(second, so_far)
        event_log.append(event_log.new_events(fresh, event_log.heads(so_far)), path)
    assert rows_of(event_log.read_journal(spark, path)) == rows_of(whole)


def test_scan_is_ordered_and_skips_deleted(spark, small):
    journal = built_journal(spark, small).withColumn("deleted", F.col("sequence_number") == 2)
    keys = [(r.persistence_id, r.sequence_number) for r in event_log.scan(journal).collect()]
    assert keys == sorted(keys) and all(n != 2 for _, n in keys)


def test_stored_payloads_are_decoded(spark):
    airport = {"code": "HAN", "name": "", "city": "", "country": ""}
    flight = {
        "flightId": "a",
        "flightNumber": "VN999",
        "route": {"origin": airport, "destination": airport | {"code": "SGN"}, "distance": 1137.0, "estimatedDuration": "PT2H"},
        "scheduledDeparture": "2026-04-15T08:00:00",
        "scheduledArrival": "2026-04-15T10:00:00",
        "totalSeats": 100,
        "availableSeats": 100,
        "status": "Scheduled",
    }
    stored = [
        (1, "flight-a", 1, False, "models.events.FlightCreated", {"flightId": "a", "flight": flight, "timestamp": "2026-04-01T07:00:00.25"}),
        (2, "flight-a", 2, False, "models.events.SeatsAllocated", {"flightId": "a", "seatsAllocated": 30, "remainingSeats": 70, "timestamp": "2026-04-01T07:01:00"}),
        (3, "flight-a", 3, False, "models.events.FlightStatusChanged", {"flightId": "a", "oldStatus": "Scheduled", "newStatus": "Boarding", "timestamp": "2026-04-01T07:02"}),
    ]
    rows = [(*r[:5], bytearray(json.dumps(r[5]).encode())) for r in stored]
    typed = event_log.decode_payloads(
        spark.createDataFrame(
            rows,
            "ordering long, persistence_id string, sequence_number long, deleted boolean, event_ser_manifest string, event_payload binary",
        )
    )
    from tarmac.operators import events

    state = events.replay(typed).first()
    assert (state.total_seats, state.available_seats, state.status) == (100, 70, "Boarding")
    created = typed.where("event_type = 'FlightCreated'").first()
    assert created.flight.destination == "SGN" and created.flight.seconds == 7_200
    assert str(created.event_ts) == "2026-04-01 07:00:00.250000"
    assert created.flight.origin_name == "" and typed.where("event_type <> 'FlightCreated'").where("flight is not null").count() == 0


@pytest.fixture(scope="module")
def whole(spark, small):
    return built_journal(spark, small).cache()


def unnumbered(journal):
    return journal.drop("sequence_number", "old_status")


def keys_are_unique(journal):
    rows = journal.count()
    return rows == journal.select("ordering").distinct().count() == journal.select(*event_log.SCAN_ORDER).distinct().count()


def test_resent_batches_add_nothing(spark, whole, tmp_path):
    path, decided = str(tmp_path / "journal"), unnumbered(whole)
    half, twice = decided.where("ordering <= 400"), decided.unionByName(decided.where("ordering % 3 = 0"))
    for batch in (half, half, twice, decided.where("ordering between 300 and 600"), decided.where("false"), decided):
        event_log.append_new(batch, path)
        assert keys_are_unique(event_log.read_journal(spark, path))
    assert rows_of(event_log.read_journal(spark, path)) == rows_of(whole)


def test_a_batch_stored_in_part_is_completed(spark, whole, tmp_path):
    """What a crash in the middle of a commit leaves: some files of the batch, not others."""
    path = str(tmp_path / "journal")
    event_log.append(whole.where("ordering <= 300 or (ordering <= 800 and ordering % 2 = 0)"), path)
    event_log.append_new(unnumbered(whole.where("ordering between 301 and 800")), path)
    event_log.append_new(unnumbered(whole.where("ordering > 800")), path)
    assert rows_of(event_log.read_journal(spark, path)) == rows_of(whole)


def test_a_late_batch_is_numbered_last(spark, whole, tmp_path):
    path, decided = str(tmp_path / "journal"), unnumbered(whole)
    for batch in ("ordering <= 300", "ordering > 600", "ordering between 301 and 600", "ordering > 600"):
        event_log.append_new(decided.where(batch), path)
    stored = event_log.read_journal(spark, path)
    assert keys_are_unique(stored) and stored.count() == whole.count()
    late = stored.where("ordering between 301 and 600").groupBy("persistence_id").agg(F.min("sequence_number").alias("first"))
    last = stored.where("ordering > 600").groupBy("persistence_id").agg(F.max("sequence_number").alias("last"))
    assert late.join(last, "persistence_id").where("first <= last").count() == 0


def test_a_range_of_orderings_is_read_from_its_folders(spark, whole, tmp_path, monkeypatch):
    monkeypatch.setattr(event_log, "SPAN", 100)
    path = str(tmp_path / "journal")
    event_log.append(whole, path)
    few = event_log.read_journal(spark, path, 250, 349)
    folders = {f.split("span=")[1].split("/")[0] for f in few.inputFiles()}
    assert rows_of(few) == rows_of(whole.where("ordering between 250 and 349"))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(span" in plan and "(span" in plan.split("PartitionFilters")[1] and folders


def test_a_tag_is_read_from_its_own_files(spark, whole, tmp_path):
    path = str(tmp_path / "tags")
    marked = whole.withColumn("deleted", F.when(F.col("sequence_number") == 3, True))
    event_log.write_tag_index(marked, path)
    index = spark.read.parquet(path)
    live = event_log.live_events(marked)
    want = {"seats": "event_type like 'Seats%'", "lifecycle": "event_type not like 'Seats%'", "flight": "true", "created": "event_type = 'FlightCreated'", "cancelled": "event_type = 'FlightCancelled'"}
    assert {r.tag for r in index.select("tag").distinct().collect()} == set(want)
    for tag, rule in want.items():
        assert rows_of(event_log.events_by_tag(index, tag).select(whole.columns)) == rows_of(live.where(rule).select(whole.columns))
    plan = event_log.events_by_tag(index, "seats")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tag" in plan and "Join" not in plan and "Exchange" not in plan
    both = event_log.events_by_tags(index, ["seats", "flight"])
    assert sorted(r.ordering for r in both.collect()) == sorted(r.ordering for r in live.where("event_type like 'Seats%'").collect())
    assert event_log.events_by_tags(index, ["seats", "lifecycle"]).count() == 0


def test_the_flight_goes_through_the_journal(spark, small, whole):
    """Number, route and times come back from the journal by replay, and by a snapshot and its tail."""
    want = {r.persistence_id: r.flight for r in whole.where("event_type = 'FlightCreated'").collect()}
    saved = events.snapshots(whole, interval=10)
    for states in (events.replay(whole), events.replay_from_snapshots(whole, saved, interval=10)):
        assert {r.persistence_id: r.flight for r in states.collect()} == want
        assert all(f.origin and f.destination_name and f.scheduled_departure for f in want.values())
    listed = flights.list_flights(events.as_flights(events.replay(whole)))
    one = listed.where("flight_id = '7'").first()
    assert (one.flight_number, one.total_seats, one.origin, one.destination) == ("SF1007", 300, "N07", "N08")


def test_regular_journals_are_replayed_without_a_join(spark, whole, tmp_path):
    whole.write.parquet(str(tmp_path / "journal"))
    whole = spark.read.parquet(str(tmp_path / "journal"))
    plan = events.replay(whole)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    planted = whole.unionByName(whole.where("ordering = 1").withColumn("sequence_number", F.lit(10**6).cast("long")).withColumn("event_type", F.lit("FlightCreated")))
    key = lambda r: (r.persistence_id, r.available_seats, r.status, r.sequence_number)
    assert sorted(map(key, events.replay(planted).collect())) == sorted(map(key, events.replay(whole).collect()))
