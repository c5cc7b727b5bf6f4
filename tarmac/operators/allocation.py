"""Seat allocation: demands in priority order take the free seats of a route's flights.

Per route, demands laid end to end in processing order cover intervals of a seat axis, and so
do flights laid end to end by departure. A demand gets seats on a flight exactly where the two
intervals overlap, which is what a sequential greedy fill would give it.

Overlaps are found by an equi-join on (route, block of the axis). A block holds at most
``block`` seats, hence at most that many demands and flights, however large the route is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.clock import floor_div
from tarmac.operators.skew import DEFAULT, SkewPolicy, ordered_scan
from tarmac.schemas import FLIGHT_ID_PREFIX

OD = ["origin", "destination"]
BLOCK = 512  # seats per block of the axis
SELLABLE = ["Scheduled", "Boarding", "Delayed"]


def allocate_stub(demands: DataFrame) -> DataFrame:
    """Every demand stays unallocated."""
    return demands.select(
        "allocation_id", "request_id", "origin", "destination", F.col("seats").alias("unallocated_seats")
    )


def sellable(flights: DataFrame) -> DataFrame:
    return flights.where(F.col("status").isin(SELLABLE) & (F.col("available_seats") > 0))


def route_capacity(flights: DataFrame) -> DataFrame:
    return sellable(flights).groupBy(*OD).agg(F.sum("available_seats").cast("long").alias("route_seats"))


def order_demands(demands: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Demands with the end of their interval on the route's seat axis, in processing order:
    priority, then request time, then id. Rows without a positive number of seats take no place."""
    keyed = demands.where(F.col("seats") > 0).withColumn("turn", -F.col("priority_rank"))
    placed = ordered_scan(
        keyed,
        OD,
        ["turn", "request_time", "request_id"],
        sums={"demand_end": F.col("seats").cast("long")},
        policy=policy,
    )
    return placed.withColumn("demand_start", F.col("demand_end") - F.col("seats")).drop("turn")


def order_flights(flights: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Flights with their interval on the route's seat axis, by departure then id."""
    placed = ordered_scan(
        sellable(flights).select("flight_id", *OD, "scheduled_departure", "available_seats"),
        OD,
        ["scheduled_departure", "flight_id"],
        sums={"flight_end": F.col("available_seats").cast("long")},
        policy=policy,
    )
    return placed.withColumn("flight_start", F.col("flight_end") - F.col("available_seats"))


def _blocks(start: str, end: Column, block: int) -> Column:
    return F.explode(F.sequence(floor_div(F.col(start), block), floor_div(end - 1, block)))


def allocate_greedy(
    demands: DataFrame, flights: DataFrame, block: int = BLOCK, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """One row per demand and flight that share seats."""
    taking = (
        order_demands(demands, policy).join(route_capacity(flights), OD, "inner")
        # what lies beyond the route's last seat cannot meet a flight
        .where(F.col("demand_start") < F.col("route_seats"))
        .withColumn("_block", _blocks("demand_start", F.least("demand_end", "route_seats"), block))
    )
    wanted = demands.where(F.col("seats") > 0).groupBy(*OD).agg(F.sum("seats").cast("long").alias("route_demand"))
    giving = (
        order_flights(flights, policy).join(wanted, OD, "inner")
        .where(F.col("flight_start") < F.col("route_demand"))
        .withColumn("_block", _blocks("flight_start", F.least("flight_end", "route_demand"), block))
    )
    start = F.greatest("demand_start", "flight_start")
    end = F.least("demand_end", "flight_end")
    return (
        taking.join(giving, [*OD, "_block"])
        # each overlap is reported by the block it starts in
        .where((start < end) & (floor_div(start, block) == F.col("_block")))
        .select(
            "allocation_id",
            "run_id",
            "request_id",
            "request_time",
            *OD,
            "flight_id",
            (end - start).alias("seats_allocated"),
            (F.col("flight_end") - end).alias("flight_seats_left"),
            start.alias("axis_start"),
        )
    )


def with_outcome(demands: DataFrame, flights: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Each demand with the seats it gets and does not get, without listing flights.

    A demand of no seats gets none and misses none. Null and negative seats are no demand: ingest
    quarantines them, and here they have no row.
    """
    placed = order_demands(demands, policy).join(route_capacity(flights), OD, "left")
    got = F.greatest(
        F.lit(0).cast("long"),
        F.least(F.col("demand_end"), F.coalesce("route_seats", F.lit(0))) - F.col("demand_start"),
    )
    asked = placed.withColumn("allocated_seats", got).withColumn(
        "unallocated_seats", F.col("seats") - F.col("allocated_seats")
    )
    nothing = F.lit(0).cast("long")
    idle = demands.where(F.col("seats") == 0).withColumns({"allocated_seats": nothing, "unallocated_seats": nothing})
    return asked.unionByName(idle, allowMissingColumns=True)


def unallocated(outcome: DataFrame) -> DataFrame:
    return outcome.where(F.col("unallocated_seats") > 0).select(
        "allocation_id", "run_id", "request_id", *OD, "unallocated_seats"
    )


def run_summary(outcome: DataFrame) -> DataFrame:
    """Per run: demands with and without seats, and the seats."""
    return outcome.groupBy("allocation_id", "run_id").agg(
        F.count(F.lit(1)).alias("demands"),
        F.count_if(F.col("allocated_seats") > 0).alias("allocated_demands"),
        F.count_if(F.col("unallocated_seats") > 0).alias("unallocated_demands"),
        F.sum("allocated_seats").cast("long").alias("allocated_seats"),
        F.sum("unallocated_seats").cast("long").alias("unallocated_seats"),
    )


def demand_candidates(demands: DataFrame, flights: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Flights that can serve each route's demand, with their place in the route's order.

    Demand is summed per route first: a flight comes out once, not once per request.
    """
    wanted = demands.where(F.col("seats") > 0).groupBy(*OD).agg(
        F.count(F.lit(1)).alias("requests"), F.sum("seats").cast("long").alias("seats_wanted")
    )
    return order_flights(flights, policy).join(wanted, OD, "inner").select(
        *OD, "flight_id", "available_seats", "flight_start", "requests", "seats_wanted"
    )


def allocation_events(allocations: DataFrame, heads: DataFrame) -> DataFrame:
    """Each allocation as a SeatsAllocated event with the seats then left on the flight.

    Numbers go on behind ``heads`` (persistence_id, last_number), the newest event of each flight's journal. A flight has
    no more allocations than seats, so the window per flight is small.
    """
    turn = Window.partitionBy("flight_id").orderBy("axis_start")
    made = allocations.select(
        F.concat(F.lit(FLIGHT_ID_PREFIX), F.col("flight_id")).alias("persistence_id"),
        F.row_number().over(turn).cast("long").alias("turn"),
        F.lit("SeatsAllocated").alias("event_type"),
        F.col("request_time").alias("event_ts"),
        F.col("seats_allocated").alias("seats"),
        F.col("flight_seats_left").alias("remaining_seats"),
        "allocation_id",
        "request_id",
    )
    known = heads.select("persistence_id", "last_number")
    number = F.col("turn") + F.coalesce("last_number", F.lit(0))
    return made.join(known, ["persistence_id"], "left").withColumn("sequence_number", number).drop("turn", "last_number")


# --- run states ----------------------------------------------------------------------------


def run_states(run_events: DataFrame) -> DataFrame:
    """Fold run events (allocation_id, sequence_number, event_type, pairs_done, pairs_total,
    allocations, reason) to one row per allocation id."""
    state = (
        F.when(F.col("event_type") == "AllocationCompleted", "completed")
        .when(F.col("event_type") == "AllocationFailed", "failed")
        .otherwise("in-progress")
    )
    return run_events.groupBy("allocation_id").agg(
        F.max_by(state, "sequence_number").alias("state"),
        F.max("pairs_done").alias("pairs_done"),
        F.max("pairs_total").alias("pairs_total"),
        F.max("allocations").alias("allocations"),
        F.max_by("reason", "sequence_number").alias("fail_reason"),
    )


def progress(states: DataFrame) -> Column:
    return F.coalesce(F.col("pairs_done") / F.nullif(F.col("pairs_total"), F.lit(0)), F.lit(0.0))


def _reply(requests: DataFrame, states: DataFrame, in_progress_text: str) -> DataFrame:
    found = requests.join(states, ["allocation_id"], "left")
    state = F.coalesce("state", F.lit("not-found"))
    message = (
        F.when(
            state == "completed",
            F.format_string("Allocation completed with %d allocations", F.coalesce("allocations", F.lit(0))),
        )
        .when(state == "in-progress", F.format_string(in_progress_text, progress(found) * 100))
        .when(state == "failed", F.col("fail_reason"))
        .otherwise(F.format_string("Allocation %s not found", F.col("allocation_id")))
    )
    return found.select("allocation_id", state.alias("status"), message.alias("message"))


def allocation_status(requests: DataFrame, states: DataFrame) -> DataFrame:
    return _reply(requests, states, "%.1f%% complete")


def allocation_result(
    requests: DataFrame, states: DataFrame, summary: DataFrame
) -> DataFrame:
    """The reply to a result request: totals once the run is completed, else a status message."""
    reply = _reply(requests, states, "Allocation is %.1f%% complete")
    totals = summary.select("allocation_id", "allocated_seats", "unallocated_seats")
    done = F.col("status") == "completed"
    return reply.join(totals, ["allocation_id"], "left").select(
        "allocation_id",
        "status",
        F.when(~done, F.col("message")).alias("message"),
        F.when(done, F.col("allocated_seats")).alias("allocated_seats"),
        F.when(done, F.col("unallocated_seats")).alias("unallocated_seats"),
    )
