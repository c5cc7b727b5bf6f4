"""Event sourcing: command outcomes, journal facts, replay, snapshots, status history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.capacity import entity_type
from tarmac.operators.skew import DEFAULT, SkewPolicy, ordered_scan
from tarmac.schemas import (
    FLIGHT_EXISTS,
    FLIGHT_ID_PREFIX,
    FLIGHT_LIFECYCLE,
    FLIGHT_RECORD,
    SNAPSHOT_INTERVAL,
    SNAPSHOTS_KEPT,
)
from tarmac.session import shared_folder
from tarmac.sources.journal import flattened, live_events

ENTITY = "persistence_id"


def create_outcomes(commands: DataFrame) -> DataFrame:
    """Reply to each create or get command, per flight in ``ordering``: the first create wins."""
    created = (
        commands.where(F.col("command") == "create")
        .groupBy("flight_id")
        .agg(F.min("ordering").alias("created_at"))
    )
    before = F.col("created_at").isNull() | (F.col("ordering") < F.col("created_at"))
    is_create = F.col("command") == "create"
    outcome = (
        F.when(is_create & (F.col("ordering") == F.col("created_at")), "FlightCreated")
        .when(is_create, "FlightOperationFailed")
        .when(before, "FlightNotFound")
        .otherwise("FlightInfo")
    )
    return commands.join(created, ["flight_id"], "left").select(
        "flight_id",
        "ordering",
        "command",
        outcome.alias("outcome"),
        F.when(outcome == "FlightOperationFailed", FLIGHT_EXISTS)
        .when(outcome == "FlightNotFound", F.concat(F.lit("Flight "), F.col("flight_id"), F.lit(" not found")))
        .alias("reason"),
    )


def facts_from_log(log: DataFrame, *carried: str) -> DataFrame:
    """Accepted commands as typed events, not yet numbered, with other columns that are to be ``carried`` on."""
    event_type = (
        F.when(F.col("command") == "create", "FlightCreated")
        .when(F.col("command") == "allocate", "SeatsAllocated")
        .when(F.col("command") == "release", "SeatsReleased")
        .when(F.col("command") == "cancel", "FlightCancelled")
        .otherwise("FlightStatusChanged")
    )
    is_create = F.col("command") == "create"
    flight = F.when(is_create, F.col("flight")) if "flight" in log.columns else F.lit(None).cast(FLIGHT_RECORD)
    return log.where("accepted").select(
        "ordering",
        F.concat(F.lit(FLIGHT_ID_PREFIX), F.col("flight_id")).alias(ENTITY),
        F.lit(False).alias("deleted"),
        event_type.alias("event_type"),
        F.col("command_ts").alias("event_ts"),
        F.when(is_create, F.col("seats")).alias("total_seats"),
        F.when(~is_create, F.col("seats")).alias("seats"),
        F.when(F.col("seats").isNotNull(), F.col("remaining_seats")).alias("remaining_seats"),
        F.when(is_create, "Scheduled").otherwise(F.col("new_status")).alias("new_status"),
        F.when(F.col("command") == "cancel", "Cancelled by operator").alias("reason"),
        F.lit(None).cast("string").alias("booking_id"),
        F.lit(None).cast("string").alias("allocation_id"),
        flight.alias("flight"),
        *carried,
    )


# --- replay --------------------------------------------------------------------------------


def seat_change() -> Column:
    return (
        F.when(F.col("event_type") == "FlightCreated", F.col("total_seats"))
        .when(F.col("event_type") == "SeatsAllocated", -F.col("seats"))
        .when(F.col("event_type") == "SeatsReleased", F.col("seats"))
        .otherwise(0)
        .cast("long")
    )


def _sequenced(value: str) -> Column:
    """The sequence number where ``value`` is present, to pick its last one."""
    return F.when(F.col(value).isNotNull(), F.col("sequence_number"))


#: Shares that the events of an irregular entity are dealt into for its join.
SALTS = 16


def effective(journal: DataFrame) -> DataFrame:
    """The events that count: an entity begins with its first create that is not deleted; events before
    it, further creates and deleted events change nothing.

    An entity is regular when its only create is its first event: then all its events count, and no join is
    needed. A count per entity, combined before the shuffle, finds the others; their events alone are joined
    to the entity's birth, dealt over salts.
    """
    shared_folder(journal.sparkSession)  # makes sure checkpoints have a place
    live = live_events(journal)
    is_create, number = F.col("event_type") == "FlightCreated", F.col("sequence_number")
    births = live.groupBy(ENTITY).agg(
        F.min(F.when(is_create, number)).alias("_born"), F.count_if(is_create).alias("_creates"), F.min(number).alias("_first")
    )
    irregular = births.where((F.col("_creates") != 1) | (F.col("_born") != F.col("_first"))).checkpoint()
    if irregular.isEmpty():
        return live
    salts = F.explode(F.array(*[F.lit(n).cast("long") for n in range(SALTS)]))
    born = irregular.where(F.col("_born").isNotNull()).select(ENTITY, "_born", salts.alias("_salt"))
    known = live.withColumn("_salt", F.pmod(number, F.lit(SALTS))).join(born, [ENTITY, "_salt"])
    counted = known.where((number == F.col("_born")) | ((number > F.col("_born")) & ~is_create))
    regular = live.join(irregular.select(ENTITY), ENTITY, "left_anti")
    return regular.unionByName(counted.select(*live.columns))


def _flight(events: DataFrame) -> Column:
    """The flight as its create describes it; null in journals that do not say."""
    if "flight" not in events.columns:
        return F.first(F.lit(None).cast(FLIGHT_RECORD))
    return F.min_by("flight", F.when(F.col("event_type") == "FlightCreated", F.col("sequence_number")))


def replay(journal: DataFrame) -> DataFrame:
    """Current state of each entity, with the ``flight`` its create describes. Every fact folds associatively,
    so the aggregation is combined before the shuffle and a long history is no harder than a short one."""
    counted = effective(journal)
    return (
        counted.groupBy(ENTITY)
        .agg(
            F.max("total_seats").alias("total_seats"),
            F.sum(seat_change()).alias("available_seats"),
            F.max_by("new_status", _sequenced("new_status")).alias("status"),
            F.max("sequence_number").alias("sequence_number"),
            _flight(counted).alias("flight"),
        )
        .where(F.col("total_seats").isNotNull())
    )


def as_flights(states: DataFrame) -> DataFrame:
    """States as rows of the table of current flights, so that listing, lookup and filters apply to them."""
    return flattened(states).withColumn("flight_id", F.regexp_replace(ENTITY, f"^{FLIGHT_ID_PREFIX}", ""))


def seat_mismatches(journal: DataFrame) -> DataFrame:
    """Entities whose summed seat changes differ from the seats stored with their last seat event."""
    return (
        effective(journal)
        .groupBy(ENTITY)
        .agg(
            F.sum(seat_change()).alias("summed"),
            F.max_by("remaining_seats", _sequenced("remaining_seats")).cast("long").alias("stored"),
        )
        .where(F.col("summed") != F.col("stored"))
    )


def recovered(ids: DataFrame, states: DataFrame) -> DataFrame:
    """States of the listed entities; ids without one are left to ``unrecovered``."""
    key = F.concat(F.lit(FLIGHT_ID_PREFIX), F.col("entity_id"))
    return ids.select(key.alias(ENTITY)).join(states, ENTITY)


def unrecovered(ids: DataFrame, states: DataFrame) -> DataFrame:
    key = F.concat(F.lit(FLIGHT_ID_PREFIX), F.col("entity_id"))
    return ids.select(key.alias(ENTITY)).join(states.select(ENTITY), ENTITY, "left_anti")


# --- snapshots -----------------------------------------------------------------------------


def blocks(events: DataFrame, interval: int) -> DataFrame:
    """Facts of events that count, summed per entity and block of ``interval`` sequence numbers."""
    return events.groupBy(ENTITY, F.expr(f"(sequence_number - 1) div {interval}").alias("block")).agg(
        F.max("total_seats").alias("total_seats"),
        F.sum(seat_change()).alias("seat_change"),
        F.max_by("new_status", _sequenced("new_status")).alias("status"),
        F.max("sequence_number").alias("last_number"),
        _flight(events).alias("flight"),
    )


def running_blocks(summed: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Blocks with the state after each: seats_then, available_seats, status_then and flight_then."""
    return ordered_scan(
        summed,
        [ENTITY],
        ["block"],
        sums={"available_seats": F.col("seat_change")},
        latest={"status_then": F.col("status"), "seats_then": F.col("total_seats"), "flight_then": F.col("flight")},
        ordinal="block",
        policy=policy,
    )


def snapshots(
    journal: DataFrame,
    interval: int = SNAPSHOT_INTERVAL,
    keep: int = SNAPSHOTS_KEPT,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """State after every ``interval`` events, the newest ``keep`` per entity.

    The journal is summed per block first; the running state is over blocks only.
    """
    summed = blocks(effective(journal), interval)
    newest = summed.groupBy(ENTITY).agg(F.expr(f"max(last_number) div {interval}").alias("complete"))
    due = (F.col("block") < F.col("complete")) & (F.col("block") >= F.col("complete") - keep)
    return (
        running_blocks(summed, policy)
        .join(newest, [ENTITY], "inner")
        .where(due)
        .select(
            ENTITY,
            ((F.col("block") + 1) * interval).alias("sequence_number"),
            F.col("seats_then").alias("total_seats"),
            "available_seats",
            F.col("status_then").alias("status"),
            F.col("flight_then").alias("flight"),
        )
    )


def replay_from_snapshots(journal: DataFrame, saved: DataFrame, interval: int = SNAPSHOT_INTERVAL) -> DataFrame:
    """Latest snapshot plus the events after it; equals a full replay.

    Snapshots fall on block ends, so the tail is whole blocks and the join is on summed blocks.
    """
    facts = ["total_seats", "available_seats", "status", "flight"]
    latest = saved.groupBy(ENTITY).agg(
        F.max("sequence_number").alias("saved_at"),
        *[F.max_by(name, "sequence_number").alias(f"saved_{name}") for name in facts],
    )
    tail = (
        blocks(effective(journal), interval)
        .join(latest.select(ENTITY, "saved_at"), [ENTITY], "left")
        .where(F.col("saved_at").isNull() | (F.col("last_number") > F.col("saved_at")))
    )
    folded = tail.groupBy(ENTITY).agg(
        F.max("total_seats").alias("total_seats"),
        F.sum("seat_change").alias("seat_change"),
        F.max_by("status", F.when(F.col("status").isNotNull(), F.col("block"))).alias("status"),
        F.max("last_number").alias("last_number"),
        F.min_by("flight", F.when(F.col("flight").isNotNull(), F.col("block"))).alias("flight"),
    )
    return (
        folded.join(latest, ENTITY, "full_outer")
        .select(
            ENTITY,
            F.coalesce("saved_total_seats", "total_seats").alias("total_seats"),
            (F.coalesce("saved_available_seats", F.lit(0)) + F.coalesce("seat_change", F.lit(0))).alias("available_seats"),
            F.coalesce("status", "saved_status").alias("status"),
            F.coalesce("last_number", "saved_at").alias("sequence_number"),
            F.coalesce("saved_flight", "flight").alias("flight"),
        )
        .where(F.col("total_seats").isNotNull())
    )


# --- status --------------------------------------------------------------------------------


def status_transitions(journal: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Each status change with the status before it."""
    changes = effective(journal).where(F.col("new_status").isNotNull()).select(
        ENTITY, "sequence_number", "event_ts", "event_type", "new_status"
    )
    return ordered_scan(
        changes,
        [ENTITY],
        ["sequence_number"],
        previous={"old_status": F.col("new_status")},
        ordinal="sequence_number",
        policy=policy,
    )


def lifecycle_violations(transitions: DataFrame) -> DataFrame:
    """Counts per pair of statuses, with a flag on pairs off the usual path. Report only.

    On the path are one step forward along the lifecycle, and any change to or from Delayed
    or to Cancelled.
    """
    steps = [
        (F.col("old_status") == a) & (F.col("new_status") == b)
        for a, b in zip(FLIGHT_LIFECYCLE, FLIGHT_LIFECYCLE[1:])
    ]
    forward = steps[0] | steps[1] | steps[2]
    on_path = (
        forward
        | (F.col("new_status") == "Cancelled")
        | ((F.col("new_status") == "Delayed") & F.col("old_status").isin("Scheduled", "Boarding"))
        | ((F.col("old_status") == "Delayed") & F.col("new_status").isin("Scheduled", "Boarding", "Departed"))
    )
    return (
        transitions.where(F.col("old_status").isNotNull())
        .groupBy("old_status", "new_status")
        .agg(F.count(F.lit(1)).alias("changes"))
        .withColumn("off_path", ~on_path)
    )


def cancelled(states: DataFrame) -> DataFrame:
    """Cancelled flights keep their record."""
    return states.where(F.col("status") == "Cancelled")


def audit_trail(*journals: DataFrame) -> DataFrame:
    """Events of several entity families as one ordered history, deleted events left out."""
    first, *rest = map(live_events, journals)
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first.orderBy("event_ts", ENTITY, "sequence_number")


def count_by_entity_type(journal: DataFrame) -> DataFrame:
    return journal.groupBy(entity_type(F.col(ENTITY)).alias("entity_type")).agg(
        F.count(F.lit(1)).alias("events")
    )
