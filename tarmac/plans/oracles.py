"""The registered queries in plain SQL, for cross-checking on any engine that reads the tables."""

from __future__ import annotations


def _code(number: str) -> str:
    return f"'N' || lpad(CAST({number} AS VARCHAR), 2, '0')"


CTES = {
    "airports": f"""SELECT {_code('n_nationkey')} AS code, n_name AS name, n_name AS city, r_name AS country
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "legs0": """SELECT p_partkey, p_size, p_partkey % 25 AS o, (p_partkey + 1 + (p_partkey // 25) % 24) % 25 AS d,
  TIMESTAMP '2024-01-01' + to_minutes(CAST(p_partkey * 37 % 43200 AS INTEGER)) AS dep FROM part""",
    "flights": f"""SELECT 'F' || p_partkey AS flight_id, 'SF' || (1000 + p_partkey) AS flight_number,
  {_code('o')} AS origin, {_code('d')} AS destination, CAST(100 + p_size * 50 AS DOUBLE) AS distance,
  dep AS scheduled_departure, dep + to_minutes(CAST(45 + p_size * 6 AS INTEGER)) AS scheduled_arrival,
  CAST(50 + p_size * 5 AS INTEGER) AS total_seats, CAST(50 + p_size * 5 AS INTEGER) AS available_seats,
  'Scheduled' AS status, p_partkey AS flight_no FROM legs0""",
    "flights_current": """SELECT flight_id, flight_number, origin, destination, distance, scheduled_departure,
  scheduled_arrival, total_seats, CAST(total_seats - (flight_no * 7) % (total_seats + 1) AS INTEGER) AS available_seats,
  ['Scheduled', 'Scheduled', 'Boarding', 'Departed', 'Arrived', 'Cancelled', 'Delayed', 'Scheduled'][flight_no % 8 + 1]
  AS status, flight_no FROM flights""",
    "booking_requests": f"""SELECT o_orderkey AS request_id, o_custkey AS passenger_id, c_name AS passenger_name,
  {_code('c_nationkey')} AS origin, {_code('(c_nationkey + 1 + o_orderkey % 24) % 25')} AS destination,
  CAST(1 + o_orderkey % 50 AS INTEGER) AS seats, o_orderdate AS request_time,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium'
  ELSE 'Low' END AS priority,
  CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 ELSE 1 END AS priority_rank,
  o_orderstatus AS order_status FROM orders JOIN customer ON o_custkey = c_custkey""",
    "connections": """SELECT a.origin, a.destination AS first_terminal, b.destination AS second_terminal,
  a.flight_id AS first_flight_id, b.flight_id AS second_flight_id, a.flight_number AS first_flight_number,
  b.flight_number AS second_flight_number,
  date_diff('second', a.scheduled_arrival, b.scheduled_departure) AS layover_seconds,
  date_diff('second', a.scheduled_departure, b.scheduled_arrival) AS total_seconds,
  b.scheduled_arrival AS ends
  FROM flights a JOIN flights b ON a.destination = b.origin
   AND b.scheduled_departure >= a.scheduled_arrival + INTERVAL 2700 SECOND
   AND b.scheduled_departure < a.scheduled_arrival + INTERVAL 21660 SECOND
  WHERE a.origin <> b.destination""",
}

# tables each expression reads
NEEDS = {
    "flights": ["legs0"],
    "flights_current": ["flights"],
    "connections": ["flights"],
}

ORACLES: dict[str, tuple[list[str], str]] = {}


def oracle(name: str, needs: str, sql: str) -> None:
    ORACLES[name] = (needs.split(), sql)


def render(name: str) -> str:
    wanted: list[str] = []

    def visit(table: str) -> None:
        for below in NEEDS.get(table, []):
            visit(below)
        if table not in wanted:
            wanted.append(table)

    needs, sql = ORACLES[name]
    for table in needs:
        visit(table)
    if not wanted:
        return sql
    parts = ",\n".join(f"{table} AS ({CTES[table]})" for table in wanted)
    return f"WITH RECURSIVE {parts}\n{sql}"


DEMAND = """count(*) AS total_requests, CAST(sum(seats) AS BIGINT) AS total_seats_requested,
  avg(seats) AS average_seats_per_request"""

oracle(
    "connections",
    "connections",
    """SELECT origin, first_terminal, second_terminal, first_flight_id, second_flight_id, first_flight_number,
  second_flight_number, layover_seconds, total_seconds FROM connections""",
)
oracle(
    "connections_for_od",
    "connections",
    """SELECT origin, first_terminal, second_terminal, first_flight_id, second_flight_id, first_flight_number,
  second_flight_number, layover_seconds, total_seconds FROM connections WHERE origin = 'N03' AND second_terminal = 'N09'""",
)
oracle(
    "connections_operable",
    "flights_current",
    """SELECT a.origin, a.destination AS first_terminal, b.destination AS second_terminal,
  a.flight_id AS first_flight_id, b.flight_id AS second_flight_id, a.flight_number AS first_flight_number,
  b.flight_number AS second_flight_number,
  date_diff('second', a.scheduled_arrival, b.scheduled_departure) AS layover_seconds,
  date_diff('second', a.scheduled_departure, b.scheduled_arrival) AS total_seconds
  FROM flights_current a JOIN flights_current b ON a.destination = b.origin
   AND b.scheduled_departure >= a.scheduled_arrival + INTERVAL 2700 SECOND
   AND b.scheduled_departure < a.scheduled_arrival + INTERVAL 21660 SECOND
  WHERE a.origin <> b.destination AND a.status <> 'Cancelled' AND b.status <> 'Cancelled'""",
)
oracle(
    "connections_3leg",
    "connections",
    """SELECT c.origin, c.first_terminal, c.second_terminal, f.destination, c.first_flight_id, c.second_flight_id,
  f.flight_id AS third_flight_id, c.layover_seconds AS first_layover_seconds,
  date_diff('second', c.ends, f.scheduled_departure) AS second_layover_seconds,
  c.total_seconds + date_diff('second', c.ends, f.scheduled_arrival) AS total_seconds
  FROM connections c JOIN flights f ON f.origin = c.second_terminal
   AND f.scheduled_departure >= c.ends + INTERVAL 2700 SECOND AND f.scheduled_departure < c.ends + INTERVAL 21660 SECOND
  WHERE f.destination <> c.origin AND f.destination <> c.first_terminal""",
)
oracle(
    "od_demand",
    "booking_requests",
    f"""SELECT origin || '-' || destination AS od_key, origin, destination, {DEMAND},
  min(request_time) AS period_start, max(request_time) AS period_end FROM booking_requests GROUP BY origin, destination""",
)
for _name, _period, _length in (
    ("daily", "day", "1 DAY"), ("weekly", "week", "7 DAY"), ("monthly", "month", "1 MONTH"),
    ("quarterly", "quarter", "3 MONTH"), ("yearly", "year", "1 YEAR"),
):
    oracle(
        f"od_demand_{_name}",
        "booking_requests",
        f"""SELECT CAST(date_trunc('{_period}', request_time) AS TIMESTAMP) AS period_start, origin, destination, {DEMAND},
  CAST(date_trunc('{_period}', request_time) AS TIMESTAMP) + INTERVAL {_length} - INTERVAL 1 SECOND AS period_end
  FROM booking_requests GROUP BY 1, origin, destination""",
    )
oracle(
    "top_routes",
    "booking_requests",
    f"""SELECT origin, destination, {DEMAND} FROM booking_requests GROUP BY origin, destination
  ORDER BY total_seats_requested DESC, origin, destination LIMIT 10""",
)

# --- more tables ---------------------------------------------------------------------------

CTES |= {
    "commands": """SELECT CAST(user_id AS VARCHAR) AS flight_id, event_id + 1 AS ordering, ts AS command_ts,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS turn,
  CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1 THEN 'create'
   WHEN event_type = 'error' AND event_id % 50 = 0 THEN 'cancel'
   WHEN event_type IN ('click', 'purchase') THEN 'allocate' WHEN event_type = 'view' THEN 'release'
   ELSE 'status' END AS command,
  1 + CAST(floor(value) AS BIGINT) % 40 AS k,
  ['Scheduled', 'Boarding', 'Departed', 'Arrived', 'Delayed'][event_id % 5 + 1] AS asked FROM events""",
    "folded": """SELECT flight_id, turn, ordering, 300 AS free, TRUE AS accepted FROM commands WHERE turn = 1
  UNION ALL
  SELECT c.flight_id, c.turn, c.ordering,
   CASE WHEN c.command = 'allocate' AND f.free >= c.k THEN CAST(f.free - c.k AS INTEGER)
    WHEN c.command = 'release' AND f.free + c.k <= 300 THEN CAST(f.free + c.k AS INTEGER) ELSE f.free END,
   CASE c.command WHEN 'allocate' THEN f.free >= c.k WHEN 'release' THEN f.free + c.k <= 300 ELSE TRUE END
  FROM folded f JOIN commands c ON c.flight_id = f.flight_id AND c.turn = f.turn + 1""",
    "seat_log": """SELECT c.flight_id, c.ordering, c.command,
  CAST(CASE c.command WHEN 'create' THEN 300 WHEN 'allocate' THEN k WHEN 'release' THEN k END AS INTEGER) AS seats,
  f.accepted, CASE WHEN f.accepted THEN NULL WHEN c.command = 'allocate' THEN 'Insufficient seats available'
  ELSE 'Release exceeds total seats' END AS reason, 300 AS total_seats, f.free AS remaining_seats,
  c.command_ts, CASE c.command WHEN 'status' THEN c.asked WHEN 'cancel' THEN 'Cancelled' END AS new_status
  FROM commands c JOIN folded f ON f.flight_id = c.flight_id AND f.turn = c.turn""",
    "facts": """SELECT ordering, 'flight-' || flight_id AS persistence_id,
  row_number() OVER (PARTITION BY flight_id ORDER BY ordering) AS sequence_number, FALSE AS deleted,
  CASE command WHEN 'create' THEN 'FlightCreated' WHEN 'allocate' THEN 'SeatsAllocated'
   WHEN 'release' THEN 'SeatsReleased' WHEN 'cancel' THEN 'FlightCancelled' ELSE 'FlightStatusChanged' END AS event_type,
  command_ts AS event_ts, CASE WHEN command = 'create' THEN seats END AS total_seats,
  CASE WHEN command <> 'create' THEN seats END AS seats,
  CASE WHEN seats IS NOT NULL THEN remaining_seats END AS remaining_seats,
  CASE WHEN command = 'create' THEN 'Scheduled' ELSE new_status END AS new_status,
  CASE WHEN command = 'cancel' THEN 'Cancelled by operator' END AS reason FROM seat_log WHERE accepted""",
    "status_changes": """SELECT ordering, persistence_id, sequence_number, event_ts, event_type,
  lag(new_status) OVER (PARTITION BY persistence_id ORDER BY sequence_number) AS old_status, new_status
  FROM facts WHERE new_status IS NOT NULL""",
    "journal": """SELECT f.*, s.old_status, CAST(NULL AS VARCHAR) AS booking_id, CAST(NULL AS VARCHAR) AS allocation_id
  FROM facts f LEFT JOIN status_changes s ON s.ordering = f.ordering""",
    "records": """SELECT 'flight-' || flight_no AS persistence_id, flight_number, origin, o.name AS origin_name,
  o.city AS origin_city, o.country AS origin_country, destination, d.name AS destination_name, d.city AS destination_city,
  d.country AS destination_country, distance, date_diff('second', scheduled_departure, scheduled_arrival) AS seconds,
  scheduled_departure, scheduled_arrival FROM flights JOIN airports o ON origin = o.code JOIN airports d ON destination = d.code""",
    "journal_records": """SELECT j.*, r.* EXCLUDE (persistence_id) FROM journal j
  LEFT JOIN records r ON r.persistence_id = j.persistence_id AND j.event_type = 'FlightCreated'""",
    "states": """SELECT * FROM plain_states LEFT JOIN records USING (persistence_id)""",
    "plain_states": """SELECT persistence_id, max(total_seats) AS total_seats,
  CAST(sum(CASE event_type WHEN 'FlightCreated' THEN total_seats WHEN 'SeatsAllocated' THEN -seats
   WHEN 'SeatsReleased' THEN seats ELSE 0 END) AS BIGINT) AS available_seats,
  arg_max(new_status, CASE WHEN new_status IS NOT NULL THEN sequence_number END) AS status,
  max(sequence_number) AS sequence_number FROM journal GROUP BY persistence_id""",
    "asks": """SELECT 'F' || (o_orderkey // 5) AS flight_id, o_orderkey AS request_no, o_custkey AS requested_by FROM orders""",
    "first_flights": """SELECT origin, destination, flight_id FROM (SELECT *, row_number() OVER
  (PARTITION BY origin, destination ORDER BY scheduled_departure, flight_id) AS n FROM flights) WHERE n = 1""",
    "assigned": """SELECT b.*, f.flight_id FROM booking_requests b LEFT JOIN first_flights f USING (origin, destination)""",
    "booking_events": """SELECT 'booking-' || request_id AS persistence_id, n AS sequence_number,
  ['BookingCreated', 'BookingConfirmed', 'BookingCancelled'][n] AS event_type,
  request_time + to_hours(CAST(n - 1 AS INTEGER)) AS event_ts, 'bk-' || request_id AS booking_id,
  CASE WHEN n > 1 THEN flight_id END AS flight_id, seats, CASE WHEN n = 3 THEN 'Cancelled by passenger' END AS reason
  FROM assigned JOIN (SELECT unnest([1, 2, 3]) AS n) ON n <= CASE WHEN flight_id IS NULL THEN 1
  WHEN order_status = 'F' THEN 2 WHEN order_status = 'P' THEN 3 ELSE 1 END""",
    "booking_states": """SELECT booking_id, replace(arg_max(event_type, sequence_number), 'Booking', '') AS status,
  max(flight_id) AS flight_id, max(seats) AS seats, min(event_ts) AS created_at FROM booking_events GROUP BY booking_id""",
    "demands": """SELECT 'alloc-' || strftime(request_time, '%Y-%m-%d') || '-' || priority
  AS allocation_id, 'run-' || strftime(request_time, '%Y-%m-%d') AS run_id, request_id, origin, destination, seats,
  priority, priority_rank, request_time FROM booking_requests""",
    "demand_axis": """SELECT *, sum(seats) OVER (PARTITION BY origin, destination
  ORDER BY priority_rank DESC, request_time, request_id ROWS UNBOUNDED PRECEDING) AS demand_end FROM demands""",
    "flight_axis": """SELECT *, sum(available_seats) OVER (PARTITION BY origin, destination
  ORDER BY scheduled_departure, flight_id ROWS UNBOUNDED PRECEDING) AS flight_end FROM flights""",
    "allocations": """SELECT d.allocation_id, d.run_id, d.request_id, d.request_time, d.origin, d.destination, f.flight_id,
  CAST(least(demand_end, flight_end) - greatest(demand_end - d.seats, flight_end - available_seats) AS BIGINT)
   AS seats_allocated, CAST(flight_end - least(demand_end, flight_end) AS BIGINT) AS flight_seats_left,
  greatest(demand_end - d.seats, flight_end - available_seats) AS axis_start
  FROM demand_axis d JOIN flight_axis f ON d.origin = f.origin AND d.destination = f.destination
   AND demand_end - d.seats < flight_end AND flight_end - available_seats < demand_end""",
    "outcome": """SELECT d.*, CAST(coalesce(got, 0) AS BIGINT) AS allocated_seats,
  CAST(d.seats - coalesce(got, 0) AS BIGINT) AS unallocated_seats FROM demands d
  LEFT JOIN (SELECT request_id, sum(seats_allocated) AS got FROM allocations GROUP BY request_id) USING (request_id)""",
    "run_events": """SELECT allocation_id, 'allocation-' || allocation_id AS persistence_id, n AS sequence_number,
  CASE WHEN n = 1 THEN 'AllocationStarted' WHEN digit = 1 THEN 'AllocationFailed' ELSE 'AllocationCompleted' END
   AS event_type, day + to_hours(CAST(n AS INTEGER)) AS event_ts, pairs_total,
  CASE WHEN n = 2 THEN pairs_total ELSE pairs_total // 2 END AS pairs_done,
  CASE WHEN n = 2 AND digit <> 1 THEN coalesce(made, 0) END AS allocations,
  CASE WHEN n = 2 AND digit = 1 THEN 'capacity feed unavailable' END AS reason
  FROM (SELECT allocation_id, count(*) AS pairs_total, min(request_time) AS day,
   dayofmonth(min(request_time)) % 10 AS digit FROM demands GROUP BY allocation_id)
  LEFT JOIN (SELECT allocation_id, count(*) AS made FROM allocations GROUP BY allocation_id) USING (allocation_id)
  JOIN (SELECT unnest([1, 2]) AS n) ON n = 1 OR digit <> 0""",
    "runs": """SELECT allocation_id, CASE arg_max(event_type, sequence_number) WHEN 'AllocationCompleted' THEN 'completed'
  WHEN 'AllocationFailed' THEN 'failed' ELSE 'in-progress' END AS state, max(pairs_done) AS pairs_done,
  max(pairs_total) AS pairs_total, max(allocations) AS allocations,
  max(reason) AS fail_reason FROM run_events GROUP BY allocation_id""",
    "status_asks": """SELECT DISTINCT allocation_id FROM demands
  UNION ALL SELECT 'alloc-none-' || c_custkey FROM customer""",
    "logs": """SELECT CAST(user_id AS VARCHAR) AS correlation_id, 'run-' || strftime(ts, '%Y-%m-%d') AS run_id,
  CAST(CAST(json_extract(props, '$.k') AS INTEGER) % 25 AS VARCHAR) AS od_group, ts AS logged_at, event_type AS message,
  CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level FROM events""",
    "request_faults": """SELECT flight_id, CASE flight_no % 19 WHEN 1 THEN 'bad estimatedDuration'
  WHEN 2 THEN 'bad scheduledDeparture' WHEN 4 THEN 'bad scheduledArrival' WHEN 5 THEN 'missing totalSeats'
  WHEN 6 THEN 'malformed JSON' END AS reason FROM flights""",
}

NEEDS |= {
    "folded": ["commands"],
    "seat_log": ["folded"],
    "facts": ["seat_log"],
    "status_changes": ["facts"],
    "journal": ["status_changes"],
    "records": ["flights", "airports"],
    "journal_records": ["journal", "records"],
    "plain_states": ["journal"],
    "states": ["plain_states", "records"],
    "first_flights": ["flights"],
    "assigned": ["first_flights", "booking_requests"],
    "booking_events": ["assigned"],
    "booking_states": ["booking_events"],
    "demands": ["booking_requests"],
    "demand_axis": ["demands"],
    "flight_axis": ["flights"],
    "allocations": ["demand_axis", "flight_axis"],
    "outcome": ["allocations"],
    "run_events": ["allocations"],
    "runs": ["run_events"],
    "status_asks": ["demands"],
    "request_faults": ["flights"],
}

FLIGHT = """flight_id, flight_number, origin, destination, distance, scheduled_departure, scheduled_arrival, total_seats,
  available_seats, status"""
CAPACITY = """count(*) AS flights, CAST(sum(total_seats) AS BIGINT) AS total_seats,
  CAST(sum(available_seats) AS BIGINT) AS available_seats,
  CAST(sum(total_seats - available_seats) AS BIGINT) AS occupied_seats,
  count(*) FILTER (available_seats <= 0) AS full_flights"""

oracle(
    "flight_demand",
    "assigned",
    f"""SELECT flight_id, {DEMAND}, CAST(date_trunc('day', min(request_time)) AS TIMESTAMP) AS period_start,
  CAST(date_trunc('day', max(request_time)) AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 SECOND AS period_end
  FROM assigned WHERE flight_id IS NOT NULL GROUP BY flight_id""",
)

oracle(
    "ingest_flights",
    "flights request_faults",
    f"""SELECT {FLIGHT} FROM flights
  WHERE flight_id IN (SELECT flight_id FROM request_faults WHERE reason IS NULL)""",
)
oracle(
    "validate_requests",
    "request_faults",
    "SELECT coalesce(reason, 'accepted') AS verdict, count(*) AS requests FROM request_faults GROUP BY 1",
)
oracle("quarantine_requests", "request_faults", "SELECT * FROM request_faults WHERE reason IS NOT NULL")
oracle(
    "ingest_status_updates",
    "",
    """SELECT event_id AS update_id, status, CASE WHEN status IS NULL THEN CAST(1 + CAST(floor(value) AS BIGINT) % 40
  AS INTEGER) END AS seats, CASE WHEN status IN ('boarding', 'Landed') THEN 'bad status' END AS reason
  FROM (SELECT *, CASE WHEN event_type IN ('signup', 'error') THEN ['Scheduled', 'Boarding', 'boarding', 'Departed',
   'Arrived', 'Landed', 'Cancelled', 'Delayed'][event_id % 8 + 1] END AS status FROM events)""",
)
oracle(
    "ingest_allocation_requests",
    "demands",
    """SELECT allocation_id, run_id, priority, priority_rank, CAST(row_number() OVER (PARTITION BY allocation_id
  ORDER BY request_id) - 1 AS INTEGER) AS position, origin, destination, seats FROM demands""",
)
oracle("journal_scan", "journal_records", "SELECT * FROM journal_records ORDER BY persistence_id, sequence_number")
oracle("journal_append", "journal_records", "SELECT * FROM journal_records")
oracle("journal_resend", "journal_records", "SELECT * FROM journal_records")
oracle("journal_entity_ids", "journal", "SELECT DISTINCT substr(persistence_id, 8) AS entity_id FROM journal")
oracle(
    "events_by_tag",
    "journal",
    """SELECT ordering, persistence_id, sequence_number, event_type FROM journal
  WHERE event_type IN ('SeatsAllocated', 'SeatsReleased')""",
)
oracle(
    "events_by_tags",
    "journal",
    """SELECT persistence_id, sequence_number, ordering, event_type FROM journal WHERE event_type = 'FlightCancelled'""",
)


def _flight_document(table: str) -> str:
    return f"""SELECT flight_id, CAST(json_object('flightId', flight_id, 'flightNumber', flight_number, 'route', json_object(
   'origin', json_object('code', o.code, 'name', o.name, 'city', o.city, 'country', o.country),
   'destination', json_object('code', d.code, 'name', d.name, 'city', d.city, 'country', d.country),
   'distance', distance, 'estimatedDuration', 'PT' || CASE WHEN minutes // 60 > 0 THEN (minutes // 60) || 'H' ELSE '' END
    || CASE WHEN minutes % 60 > 0 THEN (minutes % 60) || 'M' ELSE '' END),
   'scheduledDeparture', strftime(scheduled_departure, '%Y-%m-%dT%H:%M:%S'),
   'scheduledArrival', strftime(scheduled_arrival, '%Y-%m-%dT%H:%M:%S'), 'totalSeats', total_seats,
   'availableSeats', available_seats, 'status', status) AS VARCHAR) AS document
  FROM (SELECT *, date_diff('minute', scheduled_departure, scheduled_arrival) AS minutes FROM {table})
  JOIN airports o ON origin = o.code JOIN airports d ON destination = d.code"""


CTES["flight_docs"] = _flight_document("flights")
NEEDS["flight_docs"] = ["flights", "airports"]
oracle("export_flights_json", "flights_current airports", _flight_document("flights_current"))
oracle("export_flight_listing", "flights_current airports", _flight_document("flights_current"))

AIRPORT = """'{{"code":"' || {0} || '","name":"","city":"","country":""}}'"""
PAIR = f"""'{{"origin":' || {AIRPORT.format('origin')} || ',"destination":' || {AIRPORT.format('destination')} || '}}'"""
oracle(
    "export_allocation_results",
    "outcome allocations flight_docs",
    f"""SELECT allocation_id, coalesce(given, 0) AS allocation_count, missing AS unallocated_count,
  '{{"allocationId":"' || allocation_id || '","runId":"' || run_id || '","allocations":[' || coalesce(allocations, '')
  || '],"unallocated":[' || coalesce(unallocated, '') || '],"processingTimeMs":0,"completedAt":"'
  || strftime(completed, '%Y-%m-%dT%H:%M:%S') || '"}}' AS document
  FROM (SELECT allocation_id, run_id, count(*) FILTER (unallocated_seats > 0) AS missing,
   max(request_time) AS completed, string_agg('[' || {PAIR} || ',' || unallocated_seats || ']', ',' ORDER BY request_id)
    FILTER (unallocated_seats > 0) AS unallocated FROM outcome GROUP BY allocation_id, run_id)
  LEFT JOIN (SELECT allocation_id, count(*) AS given, string_agg('{{"odPair":' || {PAIR}
    || ',"flight":' || document || ',"seatsAllocated":' || seats_allocated || '}}', ',' ORDER BY request_id, axis_start)
   AS allocations FROM allocations JOIN flight_docs USING (flight_id) GROUP BY allocation_id)
  USING (allocation_id)""",
)

oracle("list_flights", "flights_current", f"SELECT {FLIGHT} FROM flights_current")
oracle(
    "lookup_flights",
    "flights_current asks",
    """SELECT flight_id, request_no, requested_by, flight_number, available_seats, status,
  flight_number IS NOT NULL AS found, CASE WHEN flight_number IS NULL THEN 'Flight ' || flight_id || ' not found' END
  AS message FROM asks LEFT JOIN flights_current USING (flight_id)""",
)
oracle(
    "lookup_missing",
    "flights_current asks",
    "SELECT DISTINCT flight_id FROM asks WHERE flight_id NOT IN (SELECT flight_id FROM flights_current)",
)
oracle(
    "flights_by_route",
    "flights_current",
    f"SELECT {FLIGHT} FROM flights_current WHERE origin = 'N03' AND destination = 'N09'",
)
oracle("flights_by_status", "flights_current", f"SELECT {FLIGHT} FROM flights_current WHERE status = 'Boarding'")
oracle("flights_available", "flights_current", f"SELECT {FLIGHT} FROM flights_current WHERE available_seats >= 50")
oracle(
    "flight_capacity",
    "flights_current",
    """SELECT flight_id, total_seats, available_seats, total_seats - available_seats AS occupied_seats,
  available_seats <= 0 AS is_fully_booked, CAST(1 + flight_no % 60 AS INTEGER) AS wanted,
  available_seats >= 1 + flight_no % 60 AS has_capacity FROM flights_current""",
)
oracle(
    "route_capacity",
    "flights_current",
    f"SELECT origin, destination, {CAPACITY} FROM flights_current GROUP BY origin, destination",
)
oracle("status_capacity", "flights_current", f"SELECT status, {CAPACITY} FROM flights_current GROUP BY status")
oracle(
    "register_flights",
    "flights asks",
    """SELECT flight_id, request_no, requested_by FROM (SELECT *, row_number() OVER (PARTITION BY flight_id
  ORDER BY request_no) AS n FROM asks) WHERE n = 1 AND flight_id NOT IN (SELECT flight_id FROM flights)""",
)
oracle(
    "register_rejects",
    "flights asks",
    """SELECT flight_id, request_no, requested_by, 'Flight already exists' AS reason FROM (SELECT *, row_number() OVER
  (PARTITION BY flight_id ORDER BY request_no) AS n FROM asks)
  WHERE n > 1 OR flight_id IN (SELECT flight_id FROM flights)""",
)
oracle(
    "upsert_flights",
    "flights_current",
    """SELECT flight_id, CASE status WHEN 'Scheduled' THEN 'Boarding' WHEN 'Boarding' THEN 'Departed' ELSE status END
  AS status, available_seats FROM flights_current""",
)

oracle(
    "create_outcomes",
    "",
    """SELECT flight_id, ordering, command, outcome, CASE outcome WHEN 'FlightOperationFailed' THEN 'Flight already exists'
   WHEN 'FlightNotFound' THEN 'Flight ' || flight_id || ' not found' END AS reason
  FROM (SELECT *, CASE WHEN command = 'create' AND before = 0 THEN 'FlightCreated'
   WHEN command = 'create' THEN 'FlightOperationFailed' WHEN before = 0 THEN 'FlightNotFound' ELSE 'FlightInfo' END
   AS outcome FROM (SELECT CAST(user_id AS VARCHAR) AS flight_id, event_id + 1 AS ordering,
    CASE event_type WHEN 'signup' THEN 'create' ELSE 'get' END AS command,
    count(*) FILTER (event_type = 'signup') OVER (PARTITION BY user_id ORDER BY event_id
     ROWS UNBOUNDED PRECEDING) - CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS before
    FROM events))""",
)
SEAT_LOG = "flight_id, ordering, command, seats, accepted, reason, total_seats, remaining_seats"
oracle("seat_command_log", "seat_log", f"SELECT {SEAT_LOG} FROM seat_log")
oracle(
    "seat_commands_state",
    "seat_log",
    """SELECT flight_id, arg_max(total_seats, ordering) AS total_seats, arg_max(remaining_seats, ordering)
  AS remaining_seats, count(*) FILTER (accepted) AS accepted, count(*) FILTER (NOT accepted) AS rejected,
  max(ordering) AS last_ordering FROM seat_log GROUP BY flight_id""",
)
oracle("replay_flights", "states", "SELECT * FROM states")
oracle("recover_flights", "states", "SELECT * FROM states")
RECOVERED = f"""SELECT {FLIGHT} FROM (SELECT *, substr(persistence_id, 8) AS flight_id FROM states)"""
oracle("list_recovered", "states", RECOVERED)
oracle("recovered_by_route", "states", f"{RECOVERED} WHERE origin = 'N03' AND destination = 'N04'")
oracle("replay_planted_flights", "states", "SELECT * FROM states")
oracle(
    "unrecovered_flights",
    "",
    """SELECT 'flight-' || c_custkey AS persistence_id FROM customer
  WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)""",
)
oracle("replay_from_snapshot", "states", "SELECT * FROM states")
oracle(
    "snapshots_keep2",
    "journal records",
    """SELECT * FROM (SELECT persistence_id, sequence_number, 300 AS total_seats, available_seats, status FROM (
  SELECT persistence_id, sequence_number, row_number() OVER (PARTITION BY persistence_id ORDER BY sequence_number DESC)
   AS newest, available_seats, status FROM (SELECT persistence_id, sequence_number,
    CAST(sum(CASE event_type WHEN 'FlightCreated' THEN total_seats WHEN 'SeatsAllocated' THEN -seats
     WHEN 'SeatsReleased' THEN seats ELSE 0 END) OVER past AS BIGINT) AS available_seats,
    last_value(new_status IGNORE NULLS) OVER past AS status FROM journal
    WINDOW past AS (PARTITION BY persistence_id ORDER BY sequence_number ROWS UNBOUNDED PRECEDING))
  WHERE sequence_number % 25 = 0) WHERE newest <= 2) LEFT JOIN records USING (persistence_id)""",
)
oracle(
    "flight_history",
    "journal",
    """SELECT ordering, persistence_id, sequence_number, event_type, event_ts, seats, remaining_seats, new_status
  FROM journal WHERE persistence_id = 'flight-7' ORDER BY sequence_number""",
)
oracle(
    "seat_mismatches",
    "states seat_log",
    """SELECT persistence_id, available_seats AS summed, CAST(stored AS BIGINT) AS stored FROM states
  JOIN (SELECT 'flight-' || flight_id AS persistence_id, arg_max(remaining_seats, ordering)
    + CASE WHEN CAST(flight_id AS BIGINT) % 5 = 0 THEN 1 ELSE 0 END AS stored FROM seat_log
   WHERE accepted AND seats IS NOT NULL GROUP BY flight_id) USING (persistence_id) WHERE available_seats <> stored""",
)
oracle(
    "status_transitions",
    "status_changes",
    "SELECT persistence_id, sequence_number, event_ts, event_type, old_status, new_status FROM status_changes",
)
oracle(
    "lifecycle_violations",
    "status_changes",
    """SELECT old_status, new_status, count(*) AS changes, NOT (old_status || '>' || new_status IN
  ('Scheduled>Boarding', 'Boarding>Departed', 'Departed>Arrived', 'Scheduled>Delayed', 'Boarding>Delayed',
   'Delayed>Scheduled', 'Delayed>Boarding', 'Delayed>Departed') OR new_status = 'Cancelled') AS off_path
  FROM status_changes WHERE old_status IS NOT NULL GROUP BY old_status, new_status""",
)
oracle("cancelled_flights", "states", "SELECT * FROM states WHERE status = 'Cancelled'")
oracle(
    "events_by_entity_type",
    "journal booking_events run_events",
    """SELECT split_part(persistence_id, '-', 1) AS entity_type, count(*) AS events FROM (
  SELECT persistence_id FROM journal UNION ALL SELECT persistence_id FROM booking_events
  UNION ALL SELECT persistence_id FROM run_events) GROUP BY 1""",
)
oracle(
    "audit_trail",
    "journal booking_events run_events",
    """SELECT event_ts, persistence_id, sequence_number, event_type, seats, reason FROM journal
  UNION ALL SELECT event_ts, persistence_id, sequence_number, event_type, seats, reason FROM booking_events
  UNION ALL SELECT event_ts, persistence_id, sequence_number, event_type, NULL, reason FROM run_events""",
)

oracle(
    "booking_state",
    "booking_states",
    "SELECT *, CASE WHEN status = 'Confirmed' THEN seats ELSE 0 END AS seats_held FROM booking_states",
)
oracle(
    "booking_details",
    "booking_states flights booking_requests",
    """SELECT s.booking_id, r.passenger_id, r.passenger_name, s.flight_id, f.flight_number, s.seats AS seats_booked,
  s.status, s.created_at FROM booking_states s JOIN booking_requests r ON s.booking_id = 'bk-' || r.request_id
  LEFT JOIN flights f ON f.flight_id = s.flight_id""",
)
oracle(
    "seat_reconciliation",
    "booking_events allocations flights_current journal",
    """SELECT flight_id, CAST(sum(booked) AS BIGINT) AS booked_seats, CAST(sum(given) AS BIGINT) AS allocated_seats,
  CAST(sum(back) AS BIGINT) AS released_seats, CAST(sum(taken) AS BIGINT) AS occupied_seats,
  CAST(sum(taken) - sum(booked) - sum(given) + sum(back) AS BIGINT) AS difference FROM (
  SELECT flight_id, 0 AS booked, 0 AS given, 0 AS back, total_seats - available_seats AS taken FROM flights_current
  UNION ALL SELECT flight_id, CASE event_type WHEN 'BookingConfirmed' THEN seats ELSE -seats END, 0, 0, 0
   FROM booking_events WHERE event_type <> 'BookingCreated'
  UNION ALL SELECT flight_id, 0, seats_allocated, 0, 0 FROM allocations
  UNION ALL SELECT 'F' || substr(persistence_id, 8), 0, 0, seats, 0 FROM journal WHERE event_type = 'SeatsReleased')
  GROUP BY flight_id HAVING difference <> 0""",
)

oracle(
    "allocate_stub",
    "demands",
    "SELECT allocation_id, request_id, origin, destination, seats AS unallocated_seats FROM demands",
)
oracle(
    "demand_candidates",
    "flight_axis demands",
    """SELECT origin, destination, flight_id, available_seats, CAST(flight_end - available_seats AS BIGINT) AS flight_start,
  requests, seats_wanted FROM flight_axis JOIN (SELECT origin, destination, count(*) AS requests,
  CAST(sum(seats) AS BIGINT) AS seats_wanted FROM demands GROUP BY origin, destination) USING (origin, destination)""",
)
ALLOCATION = "SELECT allocation_id, run_id, request_id, origin, destination, flight_id, seats_allocated FROM allocations"
oracle("allocate_greedy", "allocations", ALLOCATION)
oracle(
    "unallocated_demand",
    "outcome",
    """SELECT allocation_id, run_id, request_id, origin, destination, unallocated_seats FROM outcome
  WHERE unallocated_seats > 0""",
)
SUMMARY = """SELECT allocation_id, run_id, count(*) AS demands, count(*) FILTER (allocated_seats > 0) AS allocated_demands,
  count(*) FILTER (unallocated_seats > 0) AS unallocated_demands, CAST(sum(allocated_seats) AS BIGINT) AS allocated_seats,
  CAST(sum(unallocated_seats) AS BIGINT) AS unallocated_seats FROM outcome GROUP BY allocation_id, run_id"""
oracle("run_summary", "outcome", SUMMARY)
oracle(
    "allocation_events",
    "allocations",
    """SELECT 'flight-' || flight_id AS persistence_id, 1 + row_number() OVER (PARTITION BY flight_id ORDER BY axis_start)
  AS sequence_number, 'SeatsAllocated' AS event_type, request_time AS event_ts, seats_allocated AS seats,
  flight_seats_left AS remaining_seats, allocation_id, request_id FROM allocations""",
)
MESSAGE = """CASE coalesce(state, 'not-found')
  WHEN 'completed' THEN 'Allocation completed with ' || allocations || ' allocations'
  WHEN 'in-progress' THEN {prefix} printf('%.1f%% complete', pairs_done / pairs_total * 100)
  WHEN 'failed' THEN fail_reason ELSE 'Allocation ' || allocation_id || ' not found' END"""
oracle(
    "allocation_status",
    "runs status_asks",
    f"""SELECT allocation_id, coalesce(state, 'not-found') AS status, {MESSAGE.format(prefix='')} AS message
  FROM status_asks LEFT JOIN runs USING (allocation_id)""",
)
oracle(
    "allocation_result",
    "runs status_asks outcome",
    f"""SELECT allocation_id, coalesce(state, 'not-found') AS status, CASE WHEN state = 'completed' THEN NULL
  ELSE {MESSAGE.format(prefix="'Allocation is ' ||")} END AS message,
  CASE WHEN state = 'completed' THEN got END AS allocated_seats, CASE WHEN state = 'completed' THEN missed END
  AS unallocated_seats FROM status_asks LEFT JOIN runs USING (allocation_id)
  LEFT JOIN (SELECT allocation_id, CAST(sum(allocated_seats) AS BIGINT) AS got, CAST(sum(unallocated_seats) AS BIGINT)
   AS missed FROM outcome GROUP BY allocation_id) USING (allocation_id)""",
)

oracle(
    "metrics_summary",
    "",
    """SELECT operation, coalesce(n, 0) AS count, printf('%.2f', coalesce(mean, 0)) AS avg_ms, coalesce(low, 0) AS min_ms,
  coalesce(high, 0) AS max_ms, coalesce(total, 0) AS total_ms
  FROM (SELECT event_type AS operation, count(*) AS n, avg(ms) AS mean, min(ms) AS low, max(ms) AS high,
   CAST(sum(ms) AS BIGINT) AS total FROM (SELECT event_type, CAST(floor(value * 10) AS BIGINT) AS ms FROM events)
   GROUP BY event_type) FULL JOIN (SELECT unnest(['click', 'allocation']) AS operation) USING (operation)""",
)
CTES |= {
    "notes": """SELECT CAST(user_id AS VARCHAR) AS correlation_id, 'run-' || strftime(ts, '%Y-%m-%d') AS run_id, event_id,
  unnest(['k', event_type, 'user']) AS name, unnest([json_extract_string(props, '$.k'),
   CASE WHEN event_id % 3 <> 0 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END, CAST(user_id AS VARCHAR)]) AS value
  FROM events WHERE event_id % 10 <> 0""",
    "run_notes": """SELECT run_id, name, arg_max(value, event_id) AS value FROM notes WHERE value IS NOT NULL GROUP BY run_id, name""",
    "run_steps": """SELECT run_id, 'checkpoint_' || (row_number() OVER (PARTITION BY run_id ORDER BY ms, message) - 1) || '_'
  || message AS name, ms || 'ms' AS value FROM (SELECT run_id, message, (epoch_us(reached_at)
   - epoch_us(min(reached_at) OVER (PARTITION BY run_id))) // 1000 AS ms
   FROM (SELECT run_id, message, min(logged_at) AS reached_at FROM logs GROUP BY run_id, message))""",
}
NEEDS |= {"run_notes": ["notes"], "run_steps": ["logs"]}
oracle(
    "metrics_metadata",
    "notes",
    """SELECT correlation_id, CAST(count(*) AS INTEGER) AS entries, string_agg(name || '=' || value, ', ' ORDER BY name) AS metadata
  FROM (SELECT correlation_id, name, arg_max(value, event_id) AS value FROM notes WHERE value IS NOT NULL
   GROUP BY correlation_id, name) GROUP BY correlation_id""",
)
oracle(
    "run_metrics",
    "run_notes run_steps logs",
    """SELECT run_id AS operation, (epoch_us(max(logged_at)) - epoch_us(min(logged_at))) // 1000 AS duration_ms,
  TIMESTAMP '2024-02-01' AS timestamp, any_value(metadata) AS metadata
  FROM logs JOIN (SELECT run_id, string_agg(name || '=' || value, ', ' ORDER BY name) AS metadata
   FROM (SELECT * FROM run_notes UNION ALL SELECT * FROM run_steps) GROUP BY run_id) USING (run_id) GROUP BY run_id""",
)
oracle(
    "run_trace",
    "logs",
    """SELECT correlation_id, run_id, od_group, min(logged_at) AS first_at, max(logged_at) AS last_at, count(*) AS lines,
  count(*) FILTER (level = 'ERROR') AS errors, count(*) FILTER (level = 'WARN') AS warnings,
  (epoch_us(max(logged_at)) - epoch_us(min(logged_at))) // 1000 AS span_ms FROM logs GROUP BY ALL""",
)
oracle(
    "run_checkpoints",
    "logs",
    """SELECT run_id, message AS checkpoint, (epoch_us(reached_at) - epoch_us(min(reached_at) OVER (PARTITION BY run_id)))
  // 1000 AS offset_ms FROM (SELECT run_id, message, min(logged_at) AS reached_at FROM logs GROUP BY run_id, message)""",
)

oracle(
    "flight_payloads",
    "journal_records",
    """SELECT * REPLACE (CASE WHEN event_type = 'FlightCancelled' THEN NULL ELSE old_status END AS old_status)
  FROM journal_records""",
)
oracle(
    "booking_payloads",
    "booking_events booking_requests",
    """SELECT persistence_id, n AS sequence_number, event_type, event_ts, booking_id, CASE WHEN n = 1 THEN id END AS request_id,
  CASE WHEN n = 1 THEN 'pax-' || passenger_id END AS passenger_id,
  CASE WHEN n = 1 THEN replace(passenger_name, '#', ' ') ELSE '' END AS passenger_name, CASE WHEN n = 1 THEN origin END AS origin,
  CASE WHEN n = 1 THEN destination END AS destination, CASE WHEN n = 1 THEN request_time END AS request_time,
  CASE WHEN n < 3 THEN seats END AS seats, CASE WHEN n = 2 THEN flight_id END AS flight_id, reason
  FROM (SELECT e.*, e.sequence_number AS n, CAST(r.request_id AS VARCHAR) AS id, r.passenger_id, r.passenger_name, r.origin,
   r.destination, r.request_time FROM booking_events e JOIN booking_requests r ON e.booking_id = 'bk-' || r.request_id)""",
)
oracle(
    "allocation_payloads",
    "run_events allocations",
    """SELECT persistence_id, sequence_number, allocation_id, 'run-' || substr(allocation_id, 7, 10) AS run_id, event_type,
  event_ts, NULL AS origin, NULL AS destination, NULL AS flight_id, CAST(NULL AS INTEGER) AS seats, reason FROM run_events
  UNION ALL SELECT 'allocation-' || allocation_id, CAST(request_id * 1000 + axis_start % 1000 AS BIGINT), allocation_id, run_id,
   'SeatAllocationMade', request_time, origin, destination, flight_id, CAST(seats_allocated AS INTEGER), NULL FROM allocations""",
)

# --- bookings against seats ----------------------------------------------------------------

CTES |= {
    "booking_commands": """SELECT 'bk-' || request_id AS booking_id, request_time + to_hours(h) AS command_ts, command,
  CAST(epoch(request_time + to_hours(h)) // 3600 AS BIGINT) * 100000000000 + request_id * 8 + step AS ordering,
  CASE WHEN command = 'create' THEN flight_id END AS flight_id, CASE WHEN command = 'create' THEN seats END AS seats
  FROM assigned JOIN (VALUES (0, 'create', 0), (1, 'confirm', 1), (2, 'cancel', 2), (3, 'confirm', 3), (4, 'cancel', 4),
   (5, 'create', 5), (6, 'confirm', -1)) AS s(step, command, h) ON step = 0
   OR (step = 1 AND order_status IN ('F', 'P')) OR (step = 3 AND request_id % 7 = 0) OR (step = 4 AND request_id % 17 = 0)
   OR (step = 2 AND (order_status = 'P' OR (order_status = 'F' AND request_id % 11 = 0)))
   OR (step = 5 AND request_id % 13 = 0) OR (step = 6 AND request_id % 19 = 0)""",
    "births": """SELECT booking_id, min(ordering) AS born, arg_min(flight_id, ordering) AS on_flight,
  arg_min(seats, ordering) AS held FROM booking_commands WHERE command = 'create' GROUP BY booking_id""",
    "lives": """SELECT b.*, min(c.ordering) AS ended FROM births b LEFT JOIN booking_commands c
  ON c.booking_id = b.booking_id AND c.command = 'cancel' AND c.ordering > b.born GROUP BY ALL""",
    "judged": """SELECT c.*, l.on_flight, l.held, CASE WHEN command = 'create' AND ordering <> born THEN 'Booking already exists'
   WHEN command <> 'create' AND ordering < born THEN 'Booking not found'
   WHEN command <> 'create' AND ordering > ended THEN 'Booking already cancelled' END AS refusal
  FROM booking_commands c JOIN lives l USING (booking_id)""",
    "seat_turns": """SELECT *, row_number() OVER (PARTITION BY on_flight ORDER BY ordering) AS turn FROM judged
  WHERE refusal IS NULL AND command <> 'create'""",
    "sold": """SELECT flight_id AS on_flight, CAST(0 AS BIGINT) AS turn, CAST(0 AS BIGINT) AS ordering, available_seats AS free,
  CAST([] AS VARCHAR[]) AS holders, CAST(1 AS BIGINT) AS number, CAST(NULL AS VARCHAR) AS why, CAST(0 AS BIGINT) AS moved FROM flights
  UNION ALL
  SELECT on_flight, turn, ordering, CAST(free - step AS INTEGER), CASE WHEN step > 0 THEN list_append(holders, booking_id)
   WHEN step < 0 THEN list_filter(holders, lambda x: x <> booking_id) ELSE holders END,
   number + CASE WHEN step <> 0 THEN 1 ELSE 0 END, why, step
  FROM (SELECT s.on_flight, t.turn, t.ordering, t.booking_id, s.free, s.holders, s.number,
    CASE WHEN t.command = 'confirm' AND list_contains(s.holders, t.booking_id) THEN 'Booking already confirmed'
     WHEN t.command = 'confirm' AND s.free < t.held THEN 'Insufficient seats available' END AS why,
    CAST(CASE WHEN t.command = 'confirm' THEN CASE WHEN list_contains(s.holders, t.booking_id) OR s.free < t.held THEN 0
      ELSE t.held END WHEN list_contains(s.holders, t.booking_id) THEN -t.held ELSE 0 END AS BIGINT) AS step
   FROM sold s JOIN seat_turns t ON t.on_flight = s.on_flight AND t.turn = s.turn + 1)""",
    "booking_log": """SELECT j.booking_id, j.ordering, j.command, j.command_ts, j.on_flight, j.held,
  coalesce(refusal, s.why, CASE WHEN command = 'confirm' AND on_flight IS NULL THEN 'Flight not found' END) AS reason,
  CASE WHEN s.moved <> 0 THEN s.moved END AS seats_taken, CASE WHEN s.moved <> 0 THEN s.free END AS remaining_seats,
  CASE WHEN s.moved <> 0 THEN s.number END AS flight_sequence_number
  FROM judged j LEFT JOIN (SELECT * FROM sold WHERE turn > 0) s USING (on_flight, ordering)""",
    "booking_decisions": """SELECT *, reason IS NULL AS accepted, CAST(CASE WHEN reason IS NOT NULL THEN NULL
  WHEN command = 'create' THEN 1 WHEN seats_taken < 0 THEN 3 ELSE 2 END AS BIGINT) AS sequence_number FROM booking_log""",
}
NEEDS |= {
    "booking_commands": ["assigned"],
    "births": ["booking_commands"],
    "lives": ["births"],
    "judged": ["lives"],
    "seat_turns": ["judged"],
    "sold": ["seat_turns", "flights"],
    "booking_log": ["sold", "judged"],
    "booking_decisions": ["booking_log"],
}
oracle(
    "booking_commands",
    "booking_decisions",
    """SELECT booking_id, ordering, command, accepted, reason, sequence_number, seats_taken, remaining_seats
  FROM booking_decisions""",
)
oracle(
    "booking_seat_events",
    "booking_decisions",
    """SELECT 'booking-' || booking_id AS persistence_id, sequence_number, CASE command WHEN 'create' THEN 'BookingCreated'
   WHEN 'confirm' THEN 'BookingConfirmed' ELSE 'BookingCancelled' END AS event_type, command_ts AS event_ts, booking_id,
  held AS seats, CAST(NULL AS INTEGER) AS remaining_seats FROM booking_decisions WHERE accepted
  UNION ALL SELECT 'flight-' || on_flight, flight_sequence_number, CASE WHEN seats_taken > 0 THEN 'SeatsAllocated'
   ELSE 'SeatsReleased' END, command_ts, booking_id, CAST(abs(seats_taken) AS INTEGER), remaining_seats
  FROM booking_decisions WHERE seats_taken IS NOT NULL""",
)
oracle(
    "booked_states",
    "booking_decisions",
    """SELECT booking_id, max(on_flight) AS flight_id, max(held) AS seats, CASE arg_max(command, sequence_number)
  WHEN 'create' THEN 'Created' WHEN 'confirm' THEN 'Confirmed' ELSE 'Cancelled' END AS status,
  CAST(coalesce(sum(seats_taken), 0) AS BIGINT) AS seats_held FROM booking_decisions WHERE accepted GROUP BY booking_id""",
)
oracle(
    "flights_after_bookings",
    "sold",
    "SELECT on_flight AS flight_id, arg_max(free, turn) AS available_seats FROM sold GROUP BY on_flight",
)
oracle(
    "ingest_booking_requests",
    "booking_requests",
    """SELECT 'bk-' || request_id AS booking_id, 'pax-' || passenger_id AS passenger_id,
  replace(passenger_name, '#', ' ') AS passenger_name, 'p' || passenger_id || '@mail.example' AS email,
  'F' || (request_id % 100) AS flight_id, seats FROM booking_requests WHERE request_id % 23 NOT BETWEEN 1 AND 6""",
)
oracle(
    "quarantine_booking_requests",
    "booking_requests",
    """SELECT 'bk-' || request_id AS booking_id, ['missing lastName', 'bad email', 'missing passenger', 'missing flightId',
  'bad requestedSeats', 'malformed JSON'][request_id % 23] AS reason FROM booking_requests WHERE request_id % 23 BETWEEN 1 AND 6""",
)

# --- streams -------------------------------------------------------------------------------

oracle("stream_flight_state", "seat_log", ORACLES["seat_commands_state"][1])
oracle("stream_flight_batches", "seat_log", ORACLES["seat_commands_state"][1])
oracle("stream_snapshots", *[" ".join(ORACLES["snapshots_keep2"][0]), ORACLES["snapshots_keep2"][1]])
oracle("stream_replay", "states", "SELECT * FROM states")
oracle("stream_journal_append", "journal_records", "SELECT * FROM journal_records")
# weeks and fortnights are counted from the epoch
WINDOWED = f"""SELECT period_start, period_start + INTERVAL {{length}} DAY AS period_end, origin || '-' || destination AS od_key,
  {DEMAND} FROM (SELECT *, TIMESTAMP '1970-01-01' + to_days(CAST((date_diff('day', TIMESTAMP '1970-01-01', request_time)
   // {{step}}) * {{step}} - back AS INTEGER)) AS period_start FROM booking_requests, (SELECT unnest({{backs}}) AS back))
  GROUP BY period_start, origin, destination"""
oracle("stream_od_demand", "booking_requests", WINDOWED.format(length=7, step=7, backs="[0]"))
oracle("stream_od_demand_sliding", "booking_requests", WINDOWED.format(length=28, step=14, backs="[0, 14]"))
oracle(
    "stream_connections",
    "connections",
    """SELECT origin, first_terminal, second_terminal, first_flight_id, second_flight_id, layover_seconds, total_seconds
  FROM connections""",
)
oracle("stream_dedup", "", "SELECT * FROM events")
oracle("stream_allocation", "allocations", ALLOCATION)
