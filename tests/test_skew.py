"""The paths for heavy keys, forced with a small policy, against plain ones and brute force."""

import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.functions.clock import MICROS
from tarmac.operators import allocation, connections, events, seats
from tarmac.operators.skew import SkewPolicy, heavy_keys, ordered_scan, row_slices

TINY = SkewPolicy(floor=40, share=0.0, chunk=16)
KEEP_PLAIN = SkewPolicy(floor=10**9)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def hot_rows(spark):
    rng = random.Random(7)
    rows = []
    for n in range(600):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(60)}"
        rows.append((key, n, rng.randrange(-5, 9) if rng.random() < 0.9 else None, rng.choice("abc") if rng.random() < 0.3 else None))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "key string, n long, v int, tag string").repartition(5)


def test_heavy_keys_are_found(hot_rows):
    found = heavy_keys(hot_rows, ["key"], TINY)
    assert [r.key for r in found.collect()] == ["hot"]
    assert heavy_keys(hot_rows, ["key"], KEEP_PLAIN) is None


@pytest.mark.parametrize("ordinal", ["n", None])
def test_ordered_scan(hot_rows, ordinal):
    asked = dict(
        sums={"total": F.col("v")}, latest={"last_tag": F.col("tag")}, previous={"tag_before": F.col("tag")}
    )
    sliced = ordered_scan(hot_rows, ["key"], ["n"], ordinal=ordinal, policy=TINY, **asked)
    plain = ordered_scan(hot_rows, ["key"], ["n"], policy=KEEP_PLAIN, **asked)
    assert sliced.columns == plain.columns
    assert rows_of(sliced) == rows_of(plain)

    running = defaultdict(lambda: None)
    expected = {}
    for r in sorted(hot_rows.collect(), key=lambda r: r.n):
        if r.v is not None:
            running[r.key] = (running[r.key] or 0) + r.v
        expected[r.n] = running[r.key]
    assert {r.n: r.total for r in sliced.collect()} == expected


def commands_like(spark, seed, creates=True):
    rng = random.Random(seed)
    rows = []
    for n in range(900):
        flight = "1" if rng.random() < 0.4 else str(rng.randrange(2, 30))
        kind = rng.choices(["create", "allocate", "release", "status"], [1 if creates else 0, 8, 5, 2])[0]
        amount = rng.choice([100, 60]) if kind == "create" else rng.randrange(1, 30) if kind != "status" else None
        rows.append((flight, n, kind, amount))
    return rows, spark.createDataFrame(rows, "flight_id string, ordering long, command string, seats int").repartition(4)


def decide(rows, state=None):
    state = dict(state or {})
    out = []
    for flight, n, kind, amount in rows:
        have = state.get(flight)
        ok = True
        if have is None:
            ok = kind == "create"
            if ok:
                state[flight] = (amount, amount)
        elif kind == "create":
            ok = False
        elif kind == "allocate":
            ok = have[1] >= amount
            if ok:
                state[flight] = (have[0], have[1] - amount)
        elif kind == "release":
            ok = have[1] + amount <= have[0]
            if ok:
                state[flight] = (have[0], have[1] + amount)
        total, free = state.get(flight, (None, None))
        out.append((flight, n, ok, total, free))
    return sorted(out, key=repr)


@pytest.mark.parametrize("policy", [TINY, KEEP_PLAIN])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_seat_commands_equal_a_plain_loop(spark, policy, seed):
    rows, df = commands_like(spark, seed)
    log = seats.seat_command_log(df, policy=policy)
    got = log.select("flight_id", "ordering", "accepted", "total_seats", "remaining_seats")
    assert rows_of(got) == decide(rows)


@pytest.mark.parametrize("policy", [TINY, KEEP_PLAIN])
def test_seat_commands_continue_from_state(spark, policy):
    rows, df = commands_like(spark, 5)
    start = {"1": (80, 13), "4": (70, 70)}
    state = spark.createDataFrame(
        [(k, *v) for k, v in start.items()], "flight_id string, total_seats int, remaining_seats int"
    )
    log = seats.seat_command_log(df, state, policy)
    got = log.select("flight_id", "ordering", "accepted", "total_seats", "remaining_seats")
    assert rows_of(got) == decide(rows, start)


@pytest.mark.parametrize("policy", [SkewPolicy(floor=2_000, share=0.0, chunk=4_000), KEEP_PLAIN])
def test_seat_commands_with_splitting_joins(spark, policy):
    """Many input partitions, several Arrow batches per flight, and joins split at run time."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    rng = random.Random(9)
    rows = [("1" if rng.random() < 0.4 else str(rng.randrange(2, 40)), n, rng.choice(["allocate", "release"]), rng.randrange(1, 40)) for n in range(20_000)]
    rows[:40] = [(str(n + 1), n, "create", 300) for n in range(40)]
    start = {str(n): (200, n) for n in range(1, 40, 3)}
    df = spark.createDataFrame(rows, "flight_id string, ordering long, command string, seats int")
    df = df.repartitionByRange(12, "ordering")
    state = spark.createDataFrame([(k, *v) for k, v in start.items()], "flight_id string, total_seats int, remaining_seats int")
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        log = seats.seat_command_log(df.join(state.select("flight_id"), "flight_id", "left"), state, policy)
        got = rows_of(log.select("flight_id", "ordering", "accepted", "total_seats", "remaining_seats"))
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert got == decide(rows, start)


def flights_like(spark, seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        o = "HUB" if rng.random() < 0.4 else rng.choice("ABCD")
        d = rng.choice([c for c in ["HUB", *"ABCD"] if c != o])
        dep = rng.randrange(0, 3 * 86_400)
        rows.append((f"f{i}", f"n{i}", o, d, dep, dep + rng.randrange(1_800, 9_000), 50, rng.randrange(0, 50), "Scheduled"))
    return spark.createDataFrame(
        rows, "flight_id string, flight_number string, origin string, destination string, dep int, arr int,"
        " total_seats int, available_seats int, status string"
    ).selectExpr(
        "* except (dep, arr)",
        "timestampadd(SECOND, dep, timestamp_ntz'2026-01-01 00:00:00') as scheduled_departure",
        "timestampadd(SECOND, arr, timestamp_ntz'2026-01-01 00:00:00') as scheduled_arrival",
    )


@pytest.mark.parametrize("policy", [SkewPolicy(floor=5, share=0.0), KEEP_PLAIN])
@pytest.mark.parametrize("bucket", [1_000 * MICROS, 10_800 * MICROS, 86_400 * MICROS])
def test_connections_equal_a_plain_pairing(spark, policy, bucket):
    flights = flights_like(spark, 11)
    found = connections.connections(flights, bucket=bucket, policy=policy)
    rows = flights.collect()
    expected = sorted(
        (a.flight_id, b.flight_id)
        for a in rows
        for b in rows
        if a.destination == b.origin
        and a.origin != b.destination
        and 45 <= (b.scheduled_departure - a.scheduled_arrival).total_seconds() // 60 <= 360
    )
    assert sorted((r.first_flight_id, r.second_flight_id) for r in found.collect()) == expected


@pytest.mark.parametrize("policy", [SkewPolicy(floor=20, share=0.0, chunk=16), KEEP_PLAIN])
@pytest.mark.parametrize("block", [7, 512])
def test_allocation_equals_a_greedy_loop(spark, policy, block):
    rng = random.Random(3)
    flights = flights_like(spark, 3, 120)
    routes = sorted({(r.origin, r.destination) for r in flights.collect()})
    asked = []
    for i in range(500):
        o, d = ("HUB", "A") if rng.random() < 0.4 else rng.choice(routes)
        # one demand is far larger than any route
        asked.append((f"a{i % 9}", "r", i, o, d, 5_000 if i == 17 else rng.randrange(0, 40), rng.randrange(1, 5), rng.randrange(5)))
    demands = spark.createDataFrame(
        asked, "allocation_id string, run_id string, request_id long, origin string, destination string, seats int,"
        " priority_rank int, t int",
    ).selectExpr("* except (t)", "timestampadd(HOUR, t, timestamp_ntz'2026-01-01 00:00:00') as request_time")

    free = defaultdict(list)
    for f in sorted(flights.collect(), key=lambda f: (f.scheduled_departure, f.flight_id)):
        free[f.origin, f.destination].append([f.flight_id, f.available_seats])
    expected, left_over = {}, {}
    for _, _, i, o, d, want, rank, t in sorted(asked, key=lambda a: (-a[6], a[7], a[2])):
        for flight in free[o, d]:
            take = min(want, flight[1])
            if take:
                expected[i, flight[0]] = take
                want -= take
                flight[1] -= take
        if want:
            left_over[i] = want

    given = allocation.allocate_greedy(demands, flights, block, policy).collect()
    assert {(g.request_id, g.flight_id): g.seats_allocated for g in given} == expected
    assert len(given) == len(expected)
    missed = allocation.unallocated(allocation.with_outcome(demands, flights, policy)).collect()
    assert {m.request_id: m.unallocated_seats for m in missed} == left_over
    by_flight = defaultdict(int)
    for g in given:
        by_flight[g.flight_id] += g.seats_allocated
    assert all(by_flight[f.flight_id] <= f.available_seats for f in flights.collect())


@pytest.mark.parametrize("policy", [SkewPolicy(floor=10, share=0.0, chunk=4), KEEP_PLAIN])
@pytest.mark.parametrize("interval,keep", [(10, 2), (7, 3), (100, 2)])
def test_snapshot_and_tail_equal_full_replay(spark, small, policy, interval, keep):
    from tarmac.plans.catalog import journal_table

    journal = journal_table(spark, small)
    saved = events.snapshots(journal, interval, keep, policy)
    per_key = {r[0]: r[1] for r in saved.groupBy("persistence_id").count().collect()}
    assert all(n <= keep for n in per_key.values())
    full = events.replay(journal)
    assert rows_of(events.replay_from_snapshots(journal, saved, interval).select(full.columns)) == rows_of(full)


def test_transitions_of_a_heavy_entity(spark, small):
    from tarmac.plans.catalog import journal_table

    journal = journal_table(spark, small)
    tiny = SkewPolicy(floor=3, share=0.0, chunk=5)
    assert rows_of(events.status_transitions(journal, tiny)) == rows_of(events.status_transitions(journal))


# --- slices, cells and maps of bounded size ----------------------------------------------------


def crowded_times(spark):
    """Three quarters of the rows in one second, some of them in one instant, the rest over years; nulls among them."""
    rng = random.Random(4)
    rows = []
    for n in range(3_000):
        micros = None if n % 50 == 0 else 10**15 if n % 4 == 0 else 10**15 + rng.randrange(10**6) if n % 4 < 3 else rng.randrange(-(10**16), 10**16)
        rows.append(("hot" if n % 10 else None if n % 20 else "cold", micros, n * (-1) ** n * 2 ** (n % 40), rng.randrange(9)))
    return spark.createDataFrame(rows, "key string, micros long, id long, v int").selectExpr(
        "key", "case when micros is not null then timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, micros / 1000000.0d) end as at", "id", "v"
    ).repartition(6)


def test_slices_are_bounded_and_follow_the_order(spark):
    rows = crowded_times(spark).where("key = 'hot'")
    sliced = row_slices(rows, ["key"], ["at", "id"], chunk=40)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert max(sizes) <= 40 and sum(sizes) == rows.count() and len(sizes) < rows.count() / 4
    ordered = sliced.orderBy(F.col("at").asc_nulls_first(), "id").collect()
    paths = [tuple(r._slice) for r in ordered]
    assert paths == sorted(paths)


def test_slices_of_equal_rows_end(spark):
    rows = spark.createDataFrame([("k", 5, "x")] * 200 + [("k", 6, "y")], "key string, n int, s string")
    assert sorted(r["count"] for r in row_slices(rows, ["key"], ["n"], 10).groupBy("_slice").count().collect()) == [1, 200]
    assert {len(r._slice) for r in row_slices(rows, ["key"], ["s"], 10).collect()} == {0}


def test_scan_over_crowded_times(spark):
    rows = crowded_times(spark)
    asked = dict(sums={"total": F.col("v")}, latest={"last": F.col("v")}, previous={"before": F.col("v")})
    sliced = ordered_scan(rows, ["key"], ["at", "id"], policy=SkewPolicy(floor=40, share=0.0, chunk=30), **asked)
    assert rows_of(sliced) == rows_of(ordered_scan(rows, ["key"], ["at", "id"], policy=KEEP_PLAIN, **asked))


@pytest.mark.parametrize("shape", ["arrivals", "departures", "both"])
def test_no_cell_of_a_connection_join_is_crowded(spark, shape):
    arrivals, departures = {"arrivals": (2_000, 5), "departures": (5, 2_000), "both": (300, 300)}[shape]
    begin = "timestamp_ntz'2026-01-01 00:00:00'"
    leg = "concat('{0}', id) as flight_id, concat('{0}', id) as flight_number, '{1}' as origin, '{2}' as destination, {3} as scheduled_departure, {4} as scheduled_arrival, 'Scheduled' as status"
    hours = lambda text: f"timestampadd(SECOND, cast({text} as int), {begin})"
    into = spark.range(arrivals).selectExpr(*split_columns(leg.format("a", "X", "HUB", hours("id % 60"), hours("3600 + id % 900"))))
    out = spark.range(departures).selectExpr(*split_columns(leg.format("d", "HUB", "Y", hours("10000 + id % 900"), hours("20000"))))
    flights = into.unionByName(out)
    policy = SkewPolicy(pairs=400)
    legs = connections.legs(flights)
    left = connections._first_legs(legs).withColumn("_bucket", F.lit(0))
    right = connections._next_legs(legs).withColumn("_bucket", F.lit(0))
    left, right, keys = connections.dealt(left, right, ["hub", "_bucket"], policy)
    met = left.groupBy(*keys).count().join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys)
    cells = [r["count"] * r.n for r in met.collect()]
    assert len(cells) > 10 and max(cells) <= 4 * policy.pairs
    found = connections.connections(flights, policy=policy)
    assert found.count() == connections.connections(flights, policy=KEEP_PLAIN).count() == arrivals * departures
    assert found.select("first_flight_id", "second_flight_id").distinct().count() == arrivals * departures


def test_tasks_of_a_large_connection_join_follow_its_pairs(spark, monkeypatch):
    """Few rows that make many pairs: neither side is broadcast, so one file's rows are not all paired in one task."""
    flights, policy = flights_like(spark, 12).coalesce(1), SkewPolicy(pairs=400)
    plain = connections.connections(flights, policy=KEEP_PLAIN)
    monkeypatch.setattr(connections, "TASK_PAIRS", 50)
    found = connections.connections(flights, policy=policy)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert found.rdd.getNumPartitions() >= 32
    assert sorted(found.collect()) == sorted(plain.collect())


def test_joins_below_a_crowded_cell_are_dealt_too(spark, monkeypatch):
    """Pairs of all cells together count: there may be many without any crowded cell, also of operable flights alone."""
    flights = flights_like(spark, 13).withColumn("status", F.expr("if(hash(flight_id) % 4 = 0, 'Cancelled', status)")).coalesce(1)
    plain = sorted(connections.connections(flights).collect())
    plain_legs = sorted(connections.connections_three_legs(flights).collect())
    monkeypatch.setattr(connections, "PLAIN_PAIRS", 400)
    found, legs = connections.connections(flights), connections.connections_three_legs(flights)
    for df in (found, legs):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert plain and sorted(found.collect()) == plain
    assert plain_legs and sorted(legs.collect()) == plain_legs


@pytest.mark.parametrize("keys", [["hub"], ["hub", "_bucket"]])
def test_cells_count_the_pairs_that_meet(spark, keys):
    left = spark.createDataFrame([("A", 1), ("A", 1), ("A", 2), (None, 1), ("B", None), ("C", 1)], "hub string, _bucket long")
    right = spark.createDataFrame([("A", 1), ("A", 1), ("A", 3), (None, 1), ("B", None), ("D", 1)], "hub string, _bucket long")
    counts = connections.cell_counts(left, right, keys)
    met = left.join(right, keys).count()
    assert met > 0 and sum(r._left * r._right for r in counts.collect()) == met


def split_columns(text):
    """Column expressions of a select list whose commas inside brackets do not count."""
    parts, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            parts.append(text[start:i].strip())
            start = i + 1
    parts.append(text[start:].strip())
    return parts


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 30), st.lists(st.tuples(st.booleans(), st.integers(1, 35)), max_size=40), st.integers(0, 40))
def test_seat_maps(total, commands, cut):
    """What a run of commands does to every number of free seats, and two runs composed."""

    def run(free, part):
        for take, n in part:
            if take and free >= n:
                free -= n
            elif not take and free + n <= total:
                free += n
        return free

    maps = []
    for part in (commands[:cut], commands[cut:], commands):
        seat_map = seats.SeatMap.unchanged(total)
        for take, n in part:
            seat_map.allocate(n) if take else seat_map.release(n, total)
        assert [seat_map(f) for f in range(total + 1)] == [run(f, part) for f in range(total + 1)]
        maps.append(seat_map)
    joined = maps[0].then(maps[1])
    assert [joined(f) for f in range(total + 1)] == [maps[2](f) for f in range(total + 1)]
    started = seats.SeatMap.constant(total).then(maps[2])
    assert started(0) == run(total, commands)


def test_a_map_does_not_grow_with_the_seats():
    seat_map = seats.SeatMap.unchanged(2_000_000_000)
    rng = random.Random(1)
    for _ in range(2_000):
        n = rng.randrange(1, 40)
        seat_map.allocate(n) if rng.random() < 0.5 else seat_map.release(n, 2_000_000_000)
    assert len(seat_map.starts) < 4_000


@pytest.mark.parametrize("fan", [2, 64])
def test_large_flights_are_sliced(spark, fan, monkeypatch):
    monkeypatch.setattr(seats, "FAN", fan)
    rng = random.Random(8)
    rows = [("1", 10**12 + n * n, rng.choice(["allocate", "release"]), rng.randrange(1, 10**8)) for n in range(700)]
    rows = [("1", 5, "create", 2_000_000_000)] + rows + [("2", n, "create" if n == 0 else "allocate", 50 if n == 0 else 1) for n in range(60)]
    df = spark.createDataFrame(rows, "flight_id string, ordering long, command string, seats int").repartition(3)
    log = seats.seat_command_log(df, policy=SkewPolicy(floor=40, share=0.0, chunk=16))
    assert rows_of(log.select("flight_id", "ordering", "accepted", "total_seats", "remaining_seats")) == decide(sorted(rows, key=lambda r: r[1]))
