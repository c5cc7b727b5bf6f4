"""Every operator as a named query over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import allocation, bookings, demand, events, observability, reservations, seats
from tarmac.operators import connections as ott
from tarmac.operators import flights as registry
from tarmac.sources import export, ingest, logs, payloads, tables
from tarmac.sources import journal as event_log
from tarmac.sources.store import stored
from tarmac.schemas import JOURNAL
from tarmac.session import scratch_path
from tarmac.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def journal_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flight journal, written once per application and then scanned."""
    rows = stored(spark, sf_dir, "journal", lambda: built_journal(spark, sf_dir), event_log.append)
    return rows.select(*JOURNAL.names)


def built_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("flight_id"))
    log = seats.seat_command_log(tables.commands(spark, sf_dir), sized_by=raw)
    entities = raw.select(F.concat(F.lit("flight-"), F.col("flight_id")).alias("persistence_id"))
    return event_log.new_events(events.facts_from_log(log), sized_by=entities)


# --- connections ---------------------------------------------------------------------------


@query
def connections(spark, sf_dir):
    return ott.connections(tables.flights(spark, sf_dir))


@query
def connections_for_od(spark, sf_dir):
    return ott.connections(tables.flights(spark, sf_dir), "N03", "N09")


@query
def connections_operable(spark, sf_dir):
    return ott.connections(tables.flights_current(spark, sf_dir))


@query
def connections_3leg(spark, sf_dir):
    return ott.connections_three_legs(tables.flights(spark, sf_dir))


# --- demand --------------------------------------------------------------------------------


@query
def od_demand(spark, sf_dir):
    return demand.od_demand(tables.booking_requests(spark, sf_dir))


@query
def od_demand_monthly(spark, sf_dir):
    return demand.od_demand_by_period(tables.booking_requests(spark, sf_dir), "month")


@query
def od_demand_daily(spark, sf_dir):
    return demand.od_demand_by_period(tables.booking_requests(spark, sf_dir), "day")


@query
def od_demand_weekly(spark, sf_dir):
    return demand.od_demand_by_period(tables.booking_requests(spark, sf_dir), "week")


@query
def od_demand_quarterly(spark, sf_dir):
    return demand.od_demand_by_period(tables.booking_requests(spark, sf_dir), "quarter")


@query
def od_demand_yearly(spark, sf_dir):
    return demand.od_demand_by_period(tables.booking_requests(spark, sf_dir), "year")


@query
def top_routes(spark, sf_dir):
    return demand.top_routes(tables.booking_requests(spark, sf_dir), 10)


@query
def flight_demand(spark, sf_dir):
    return demand.flight_demand(_assigned(spark, sf_dir))


# --- sources and sinks ---------------------------------------------------------------------


@query
def ingest_flights(spark, sf_dir):
    parsed = ingest.parse_flight_requests(tables.flight_request_lines(spark, sf_dir))
    flights = ingest.to_flights(ingest.accepted(parsed), F.col("flight_id"))
    return ingest.flatten_flights(flights)


@query
def validate_requests(spark, sf_dir):
    parsed = ingest.parse_flight_requests(tables.flight_request_lines(spark, sf_dir))
    return (
        parsed.groupBy(F.coalesce("reason", F.lit("accepted")).alias("verdict"))
        .agg(F.count(F.lit(1)).alias("requests"))
    )


@query
def quarantine_requests(spark, sf_dir):
    parsed = ingest.parse_flight_requests(tables.flight_request_lines(spark, sf_dir))
    return ingest.quarantined(parsed).select("flight_id", "reason")


@query
def ingest_status_updates(spark, sf_dir):
    return ingest.parse_updates(tables.update_lines(spark, sf_dir)).select("update_id", "status", "seats", "reason")


@query
def ingest_allocation_requests(spark, sf_dir):
    parsed = ingest.parse_allocation_requests(tables.allocation_request_lines(spark, sf_dir))
    return ingest.to_demands(ingest.accepted(parsed), F.col("allocation_id"))


@query
def journal_scan(spark, sf_dir):
    return event_log.flattened(event_log.scan(journal_table(spark, sf_dir)))


@query
def journal_entity_ids(spark, sf_dir):
    return event_log.entity_ids(journal_table(spark, sf_dir))


@query
def journal_append(spark, sf_dir):
    """Number the accepted events straight from the command stream."""
    return event_log.flattened(built_journal(spark, sf_dir))


@query
def journal_resend(spark, sf_dir):
    """Half of the events, then all of them, then all of them again: the journal holds each once, numbered alike."""
    path = scratch_path(spark, "resent")
    decided = journal_table(spark, sf_dir).drop("sequence_number", "old_status")
    half = decided.agg(F.expr("max(ordering) div 2")).first()[0] or 0
    for batch in (decided.where(F.col("ordering") <= half), decided, decided):
        event_log.append_new(batch, path)
    return event_log.flattened(event_log.read_journal(spark, path))


@query
def flight_payloads(spark, sf_dir):
    """The journal as stored blobs, decoded again."""
    stored_rows = payloads.encode_flight_events(journal_table(spark, sf_dir))
    return event_log.flattened(payloads.decode_flight_events(stored_rows))


def _as_stored(events_in, ordering):
    """Events of another family in the form of the stored journal."""
    return events_in.withColumns({"ordering": ordering, "deleted": F.lit(False)})


@query
def booking_payloads(spark, sf_dir):
    asked = tables.booking_requests(spark, sf_dir).drop("seats", "order_status", "priority", "priority_rank")
    events_in = bookings.booking_events(_assigned(spark, sf_dir)).withColumn("request_id", F.substring("booking_id", 4, 20).cast("long"))
    rows = _as_stored(events_in.join(asked, "request_id"), F.col("request_id") * 4 + F.col("sequence_number"))
    return payloads.decode_booking_events(payloads.encode_booking_events(rows))


@query
def allocation_payloads(spark, sf_dir):
    named = ["allocation_id", "run_id", "event_type", "event_ts", "origin", "destination", "flight_id", "seats", "reason"]
    runs = _run_events(spark, sf_dir).withColumn("run_id", F.concat(F.lit("run-"), F.substring("allocation_id", 7, 10)))
    made = allocation_table(spark, sf_dir).withColumns(
        {
            "event_type": F.lit("SeatAllocationMade"),
            "event_ts": F.col("request_time"),
            "seats": F.col("seats_allocated").cast("int"),
            "sequence_number": F.col("request_id") * 1000 + F.col("axis_start") % 1000,
        }
    )
    rows = runs.select("sequence_number", *[c for c in named if c in runs.columns]).unionByName(
        made.select("sequence_number", *[c for c in named if c in made.columns]), allowMissingColumns=True
    )
    rows = rows.withColumn("persistence_id", F.concat(F.lit("allocation-"), "allocation_id"))
    return payloads.decode_allocation_events(payloads.encode_allocation_events(_as_stored(rows, F.col("sequence_number")))).select(
        "persistence_id", "sequence_number", *named
    )


def tag_index(spark, sf_dir):
    return stored(spark, sf_dir, "tags", lambda: journal_table(spark, sf_dir), event_log.write_tag_index)


@query
def events_by_tag(spark, sf_dir):
    found = event_log.events_by_tag(tag_index(spark, sf_dir), "seats")
    return found.select("ordering", "persistence_id", "sequence_number", "event_type")


@query
def events_by_tags(spark, sf_dir):
    return event_log.events_by_tags(tag_index(spark, sf_dir), ["flight", "lifecycle", "cancelled"])


@query
def export_flights_json(spark, sf_dir):
    return export.flight_documents(tables.flights_current(spark, sf_dir), tables.airports(spark, sf_dir))


@query
def export_flight_listing(spark, sf_dir):
    """The listings as they were written: every flight of every ``{"flights": [...]}`` file, read back."""
    path = scratch_path(spark, "listing")
    documents = export.flight_documents(tables.flights_current(spark, sf_dir), tables.airports(spark, sf_dir))
    export.write_listing(documents, path)
    return export.read_listing(spark, path)


@query
def export_allocation_results(spark, sf_dir):
    outcome = outcome_table(spark, sf_dir).withColumn("position", F.col("request_id"))
    given = allocation_table(spark, sf_dir).withColumn("position", F.col("request_id"))
    flights = export.flight_documents(tables.flights(spark, sf_dir), tables.airports(spark, sf_dir))
    return export.allocation_documents(outcome, given, flights)


# --- flights -------------------------------------------------------------------------------


@query
def list_flights(spark, sf_dir):
    return registry.list_flights(tables.flights_current(spark, sf_dir))


@query
def lookup_flights(spark, sf_dir):
    return registry.lookup_flights(tables.registration_requests(spark, sf_dir), tables.flights_current(spark, sf_dir))


@query
def lookup_missing(spark, sf_dir):
    return registry.missing_flights(tables.registration_requests(spark, sf_dir), tables.flights_current(spark, sf_dir))


@query
def flights_by_route(spark, sf_dir):
    return registry.by_route(tables.flights_current(spark, sf_dir), "N03", "N09")


@query
def flights_by_status(spark, sf_dir):
    return registry.by_status(tables.flights_current(spark, sf_dir), "Boarding")


@query
def flights_available(spark, sf_dir):
    return registry.with_seats_left(tables.flights_current(spark, sf_dir), 50)


@query
def flight_capacity(spark, sf_dir):
    return registry.capacity(tables.flights_current(spark, sf_dir), F.expr("cast(1 + flight_no % 60 as int)"))


@query
def route_capacity(spark, sf_dir):
    return registry.capacity_by(tables.flights_current(spark, sf_dir), ["origin", "destination"])


@query
def status_capacity(spark, sf_dir):
    return registry.capacity_by(tables.flights_current(spark, sf_dir), ["status"])


@query
def register_flights(spark, sf_dir):
    return registry.register_flights(tables.registration_requests(spark, sf_dir), tables.flights(spark, sf_dir))


@query
def register_rejects(spark, sf_dir):
    return registry.register_rejects(tables.registration_requests(spark, sf_dir), tables.flights(spark, sf_dir))


@query
def upsert_flights(spark, sf_dir):
    return registry.upsert_flights(tables.flights(spark, sf_dir), tables.flight_changes(spark, sf_dir))


# --- event sourcing ------------------------------------------------------------------------


@query
def create_outcomes(spark, sf_dir):
    return events.create_outcomes(tables.create_commands(spark, sf_dir))


@query
def seat_command_log(spark, sf_dir):
    return seats.seat_command_log(
        tables.commands(spark, sf_dir).select("flight_id", "ordering", "command", "seats")
    )


@query
def seat_commands_state(spark, sf_dir):
    return seats.seat_state(
        seats.seat_command_log(tables.commands(spark, sf_dir).select("flight_id", "ordering", "command", "seats"))
    )


@query
def replay_flights(spark, sf_dir):
    return event_log.flattened(events.replay(journal_table(spark, sf_dir)))


def _recovered(spark, sf_dir):
    journal = journal_table(spark, sf_dir)
    return events.recovered(event_log.entity_ids(journal), events.replay(journal))


@query
def recover_flights(spark, sf_dir):
    return event_log.flattened(_recovered(spark, sf_dir))


@query
def list_recovered(spark, sf_dir):
    """The table of current flights as a restart rebuilds it from the journal alone."""
    return registry.list_flights(events.as_flights(_recovered(spark, sf_dir)))


@query
def recovered_by_route(spark, sf_dir):
    return registry.by_route(events.as_flights(_recovered(spark, sf_dir)), "N03", "N04")


@query
def unrecovered_flights(spark, sf_dir):
    """Ids asked for whose journal gives no state: customers that never sent a command."""
    asked = tables.read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("entity_id"))
    return events.unrecovered(asked, events.replay(journal_table(spark, sf_dir)))


@query
def replay_planted_flights(spark, sf_dir):
    """Events that must not count, planted around every flight's own: one before its create, a second
    create, and a deleted allocation. The states are those of the journal without them."""
    journal = journal_table(spark, sf_dir)
    fields = "sequence_number long, event_type string, total_seats int, seats int, deleted boolean"
    planted = [("0", "SeatsReleased", "null", "5", "false"), ("last_number + 1", "FlightCreated", "50", "null", "false")]
    planted.append(("last_number + 2", "SeatsAllocated", "null", "30", "true"))
    rows = ", ".join(f"struct(cast({n} as long), '{t}', cast({a} as int), cast({b} as int), {d})" for n, t, a, b, d in planted)
    names = [f.split()[0] for f in fields.split(", ")]
    found = event_log.heads(journal).select("persistence_id", F.expr(f"inline(array({rows}))").alias(*names))
    return event_log.flattened(events.replay(journal.unionByName(found, allowMissingColumns=True)))


@query
def snapshots_keep2(spark, sf_dir):
    return event_log.flattened(events.snapshots(journal_table(spark, sf_dir), interval=25, keep=2))


@query
def replay_from_snapshot(spark, sf_dir):
    journal = journal_table(spark, sf_dir)
    saved = stored(spark, sf_dir, "snapshots", lambda: events.snapshots(journal, interval=25, keep=2))
    return event_log.flattened(events.replay_from_snapshots(journal, saved, interval=25))


@query
def flight_history(spark, sf_dir):
    return event_log.history(journal_table(spark, sf_dir), "flight-7").select(
        "ordering", "persistence_id", "sequence_number", "event_type", "event_ts", "seats", "remaining_seats", "new_status"
    )


@query
def seat_mismatches(spark, sf_dir):
    """Some flights have stored one seat too many all along; they and no others come out."""
    wrong = F.split_part("persistence_id", F.lit("-"), F.lit(2)).cast("long") % 5 == 0
    stored_wrong = F.when(wrong, F.col("remaining_seats") + 1).otherwise(F.col("remaining_seats"))
    return events.seat_mismatches(journal_table(spark, sf_dir).withColumn("remaining_seats", stored_wrong))


@query
def status_transitions(spark, sf_dir):
    return events.status_transitions(journal_table(spark, sf_dir))


@query
def lifecycle_violations(spark, sf_dir):
    return events.lifecycle_violations(events.status_transitions(journal_table(spark, sf_dir)))


@query
def cancelled_flights(spark, sf_dir):
    return event_log.flattened(events.cancelled(events.replay(journal_table(spark, sf_dir))))


@query
def events_by_entity_type(spark, sf_dir):
    return events.count_by_entity_type(_all_events(spark, sf_dir))


@query
def audit_trail(spark, sf_dir):
    return events.audit_trail(*_families(spark, sf_dir)).select(
        "event_ts", "persistence_id", "sequence_number", "event_type", "seats", "reason"
    )


def _families(spark, sf_dir):
    return (
        journal_table(spark, sf_dir),
        bookings.booking_events(_assigned(spark, sf_dir)),
        _run_events(spark, sf_dir),
    )


def _all_events(spark, sf_dir):
    parts = [family.select("persistence_id") for family in _families(spark, sf_dir)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- bookings ------------------------------------------------------------------------------


def _assigned(spark, sf_dir):
    return bookings.assign_flights(tables.booking_requests(spark, sf_dir), tables.flights(spark, sf_dir))


@query
def booking_state(spark, sf_dir):
    return bookings.booking_state(bookings.booking_events(_assigned(spark, sf_dir)))


@query
def booking_details(spark, sf_dir):
    assigned = _assigned(spark, sf_dir)
    states = bookings.booking_state(bookings.booking_events(assigned))
    return bookings.booking_details(
        states, tables.booking_requests(spark, sf_dir), tables.flights(spark, sf_dir)
    )


@query
def ingest_booking_requests(spark, sf_dir):
    parsed = ingest.parse_booking_requests(tables.booking_request_lines(spark, sf_dir))
    return ingest.to_bookings(ingest.accepted(parsed), F.col("booking_id"))


@query
def quarantine_booking_requests(spark, sf_dir):
    parsed = ingest.parse_booking_requests(tables.booking_request_lines(spark, sf_dir))
    return ingest.quarantined(parsed).select("booking_id", "reason")


def _decided_bookings(spark, sf_dir):
    # the flights were registered: their first event is in the journal
    flights = tables.flights(spark, sf_dir).withColumn("last_number", F.lit(1))
    commands = tables.booking_commands_of(_assigned(spark, sf_dir))
    return stored(spark, sf_dir, "booking-log", lambda: reservations.booking_command_log(commands, flights))


@query
def booking_commands(spark, sf_dir):
    return _decided_bookings(spark, sf_dir).select(
        "booking_id", "ordering", "command", "accepted", "reason", "sequence_number", "seats_taken", "remaining_seats"
    )


@query
def booking_seat_events(spark, sf_dir):
    return reservations.booking_seat_events(_decided_bookings(spark, sf_dir))


@query
def booked_states(spark, sf_dir):
    return reservations.booking_states(_decided_bookings(spark, sf_dir))


@query
def flights_after_bookings(spark, sf_dir):
    return reservations.flights_after(_decided_bookings(spark, sf_dir), tables.flights(spark, sf_dir))


@query
def seat_reconciliation(spark, sf_dir):
    # a user of the journal is the flight of that number
    named = F.regexp_replace("persistence_id", "^flight-", "F").alias("flight_id")
    released = journal_table(spark, sf_dir).where("event_type = 'SeatsReleased'").select(named, "seats")
    return bookings.seat_reconciliation(
        bookings.seat_effects(bookings.booking_events(_assigned(spark, sf_dir))),
        allocation_table(spark, sf_dir),
        released,
        tables.flights_current(spark, sf_dir),
    )


# --- allocation ----------------------------------------------------------------------------


@query
def allocate_stub(spark, sf_dir):
    return allocation.allocate_stub(tables.allocation_demands(spark, sf_dir))


@query
def demand_candidates(spark, sf_dir):
    return allocation.demand_candidates(tables.allocation_demands(spark, sf_dir), tables.flights(spark, sf_dir))


@query
def allocate_greedy(spark, sf_dir):
    return allocation.allocate_greedy(tables.allocation_demands(spark, sf_dir), tables.flights(spark, sf_dir)).select(
        "allocation_id", "run_id", "request_id", "origin", "destination", "flight_id", "seats_allocated"
    )


@query
def unallocated_demand(spark, sf_dir):
    return allocation.unallocated(
        allocation.with_outcome(tables.allocation_demands(spark, sf_dir), tables.flights(spark, sf_dir))
    )


@query
def run_summary(spark, sf_dir):
    return allocation.run_summary(
        allocation.with_outcome(tables.allocation_demands(spark, sf_dir), tables.flights(spark, sf_dir))
    )


@query
def allocation_events(spark, sf_dir):
    # the flights were registered: their first event is in the journal
    heads = tables.flights(spark, sf_dir).select(
        F.concat(F.lit("flight-"), "flight_id").alias("persistence_id"), F.lit(1).cast("long").alias("last_number")
    )
    return allocation.allocation_events(
        allocation.allocate_greedy(tables.allocation_demands(spark, sf_dir), tables.flights(spark, sf_dir)), heads
    )


def allocation_table(spark, sf_dir):
    """Allocations of all runs, written once per application as a finished run's result is."""
    return stored(
        spark,
        sf_dir,
        "allocations",
        lambda: allocation.allocate_greedy(tables.allocation_demands(spark, sf_dir), tables.flights(spark, sf_dir)),
    )


def outcome_table(spark, sf_dir):
    """What each demand got and did not get, kept likewise."""
    return stored(
        spark,
        sf_dir,
        "outcome",
        lambda: allocation.with_outcome(tables.allocation_demands(spark, sf_dir), tables.flights(spark, sf_dir)),
    )


def _run_events(spark, sf_dir):
    return tables.run_events_from(tables.allocation_demands(spark, sf_dir), allocation_table(spark, sf_dir))


@query
def allocation_status(spark, sf_dir):
    states = allocation.run_states(_run_events(spark, sf_dir))
    return allocation.allocation_status(tables.status_requests(spark, sf_dir), states)


@query
def allocation_result(spark, sf_dir):
    states = allocation.run_states(_run_events(spark, sf_dir))
    summary = allocation.run_summary(outcome_table(spark, sf_dir))
    return allocation.allocation_result(tables.status_requests(spark, sf_dir), states, summary)


# --- metrics and logs ----------------------------------------------------------------------


@query
def metrics_summary(spark, sf_dir):
    listed = spark.createDataFrame([("click",), ("allocation",)], "operation string")
    return observability.metrics_summary(tables.metrics(spark, sf_dir), listed)


@query
def metrics_metadata(spark, sf_dir):
    """What each operation noted about itself, the last value of each name."""
    records = tables.metadata_records(spark, sf_dir)
    merged = observability.merged_metadata(records, ["correlation_id"], "metadata", F.col("record_no"))
    return merged.select("correlation_id", F.size("metadata").alias("entries"), observability.metadata_text("metadata").alias("metadata"))


@query
def run_metrics(spark, sf_dir):
    """One performance record per run, with its checkpoints among its metadata."""
    lines = logs.parse_logs(tables.log_lines(spark, sf_dir))
    made_at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    found = observability.run_metrics(tables.metadata_records(spark, sf_dir), lines, F.col("record_no"), made_at)
    return found.withColumn("metadata", observability.metadata_text("metadata"))


@query
def run_trace(spark, sf_dir):
    return observability.run_trace(logs.parse_logs(tables.log_lines(spark, sf_dir)))


@query
def run_checkpoints(spark, sf_dir):
    return observability.run_checkpoints(logs.parse_logs(tables.log_lines(spark, sf_dir)))


# --- streams -------------------------------------------------------------------------------
# Each runs its stream over files to the end and returns what was written. Commands, journal events, requests and
# flights arrive in files that follow their order, one to a micro-batch, and watermarks are short.

FILES = 4


def arriving(spark, rows, name, order):
    """The rows as a stream of files in order."""
    path = tables.in_ordered_files(rows, scratch_path(spark, name), order, FILES)
    return jobs.table_stream(spark, path, files_per_batch=1)


def _keyed_log(spark, sf_dir):
    events_in = arriving(spark, tables.read(spark, sf_dir, "events"), "events", "event_id")
    return jobs.keyed_flight_commands(tables.raw_commands_from(events_in), scratch_path(spark, "flight-commands"))


@query
def stream_flight_state(spark, sf_dir):
    return seats.seat_state(_keyed_log(spark, sf_dir))


@query
def stream_journal_append(spark, sf_dir):
    records = tables.flight_records(spark, sf_dir).select(F.col("flight_no").cast("string").alias("flight_id"), "flight")
    return event_log.flattened(jobs.journal_of(_keyed_log(spark, sf_dir), records))


@query
def stream_flight_batches(spark, sf_dir):
    """The same states by the batch operator, a micro-batch at a time, as busy flights need it."""
    firsts = tables.first_events(spark, sf_dir)
    state, _ = jobs.flight_commands(
        arriving(spark, tables.read(spark, sf_dir, "events"), "events", "event_id"),
        lambda rows: tables.commands_from(rows, firsts),
        scratch_path(spark, "flight-batches"),
    )
    return state.latest()


def _stream_snapshots(spark, sf_dir):
    journal = arriving(spark, journal_table(spark, sf_dir), "events", "ordering")
    return jobs.snapshots(journal, scratch_path(spark, "snapshots"), interval=25)


@query
def stream_snapshots(spark, sf_dir):
    _, saved = _stream_snapshots(spark, sf_dir)
    return event_log.flattened(jobs.newest_snapshots(saved.read(), keep=2))


@query
def stream_replay(spark, sf_dir):
    state, _ = _stream_snapshots(spark, sf_dir)
    return event_log.flattened(state.latest())


def _request_stream(spark, sf_dir):
    orders = arriving(spark, tables.read(spark, sf_dir, "orders"), "orders", "unix_date(cast(o_orderdate as date))")
    return tables.booking_requests_from(orders, tables.read(spark, sf_dir, "customer"))


@query
def stream_od_demand(spark, sf_dir):
    return jobs.od_demand(_request_stream(spark, sf_dir), scratch_path(spark, "demand"), "1 day")


@query
def stream_od_demand_sliding(spark, sf_dir):
    return jobs.od_demand(_request_stream(spark, sf_dir), scratch_path(spark, "demand"), "1 day", "28 days", "14 days")


@query
def stream_connections(spark, sf_dir):
    """Flights are announced by departure; they land within six hours of it, which the delay covers."""
    part, by_departure = tables.read(spark, sf_dir, "part"), "p_partkey * 37 % 43200"
    flights = [tables.flights_from(arriving(spark, part, "part", by_departure)) for _ in range(2)]
    return jobs.connections(*flights, scratch_path(spark, "connections"), "12 hours")


@query
def stream_dedup(spark, sf_dir):
    """Every event is sent, and a file later the last quarter of all is sent again: each comes out once."""
    events_in = tables.read(spark, sf_dir, "events")
    path = tables.in_ordered_files(events_in, scratch_path(spark, "events"), "event_id", FILES)
    for again in ("event_id % 4 = 0", "event_id % 4 = 0"):
        events_in.where(again).coalesce(1).write.mode("append").parquet(path)
    sent = jobs.table_stream(spark, path, files_per_batch=1)
    return jobs.without_duplicates(sent, ["event_id"], "ts", scratch_path(spark, "dedup"), "1 day")


@query
def stream_allocation(spark, sf_dir):
    customer = tables.read(spark, sf_dir, "customer")
    return jobs.allocate(
        jobs.table_stream(spark, f"{sf_dir}/orders.parquet"),
        lambda rows: tables.demands_of(tables.booking_requests_from(rows, customer)),
        tables.flights(spark, sf_dir),
        scratch_path(spark, "allocation"),
    ).select("allocation_id", "run_id", "request_id", "origin", "destination", "flight_id", "seats_allocated")
