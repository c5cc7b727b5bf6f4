"""Domain tables derived from the given star-schema tables.

All arithmetic is on integers, so that the same table can be written in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.clock import day_text, epoch_micros, floor_div, seconds_between
from tarmac.functions.durations import format_local_date_time
from tarmac.schemas import FLIGHT_RECORD

HUBS = 25  # airports are the nations
OPENING_SEATS = 300
ROWS_PER_FILE = 1 << 22


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def in_ordered_files(rows: DataFrame, path: str, order: str, files: int) -> str:
    """Write rows as files that follow the integer expression ``order``, one after the other as a feed would drop them:
    ``files`` of them, or more where one would hold over ``ROWS_PER_FILE`` rows of evenly spread order."""
    place = F.expr(order)
    first, last, count = rows.agg(F.min(place), F.max(place), F.count(F.lit(1))).first()
    files = max(files, -(-count // ROWS_PER_FILE))
    step = max(1, -(-(last - first + 1) // files)) if first is not None else 1
    for n in range(files if first is not None else 1):
        part = rows if first is None else rows.where(place.between(first + n * step, first + (n + 1) * step - 1))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def _code(number: str) -> str:
    return f"concat('N', lpad(cast({number} as string), 2, '0'))"


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        f"{_code('n_nationkey')} as code", "n_name as name", "n_name as city", "r_name as country"
    )


def flights_from(part: DataFrame) -> DataFrame:
    """Scheduled flights with every seat free, one per part."""
    leg = part.selectExpr(
        "p_partkey",
        "p_size",
        f"cast(p_partkey % {HUBS} as int) as o",
        f"cast((p_partkey + 1 + (p_partkey div {HUBS}) % {HUBS - 1}) % {HUBS} as int) as d",
        "timestampadd(MINUTE, cast(p_partkey * 37 % 43200 as int), timestamp_ntz'2024-01-01 00:00:00') as dep",
    )
    return leg.selectExpr(
        "concat('F', p_partkey) as flight_id",
        "concat('SF', 1000 + p_partkey) as flight_number",
        f"{_code('o')} as origin",
        f"{_code('d')} as destination",
        "cast(100 + p_size * 50 as double) as distance",
        "dep as scheduled_departure",
        "timestampadd(MINUTE, 45 + p_size * 6, dep) as scheduled_arrival",
        "cast(50 + p_size * 5 as int) as total_seats",
        "cast(50 + p_size * 5 as int) as available_seats",
        "'Scheduled' as status",
        "p_partkey as flight_no",
    )


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_from(read(spark, sf_dir, "part"))


def flights_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same flights part-way through sales and operation."""
    return flights(spark, sf_dir).withColumns(
        {
            "available_seats": F.expr("cast(total_seats - (flight_no * 7) % (total_seats + 1) as int)"),
            "status": F.expr(
                "element_at(array('Scheduled', 'Scheduled', 'Boarding', 'Departed', 'Arrived', 'Cancelled',"
                " 'Delayed', 'Scheduled'), cast(flight_no % 8 as int) + 1)"
            ),
        }
    )


def flight_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights by number, each as the nested record that its create event carries."""
    flown, places = flights(spark, sf_dir), airports(spark, sf_dir)
    for end in ("origin", "destination"):
        names = places.select(F.col("code").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in ("name", "city", "country")])
        flown = flown.join(names, end)
    flown = flown.withColumn("seconds", seconds_between(F.col("scheduled_departure"), F.col("scheduled_arrival")))
    return flown.select("flight_no", F.struct(*FLIGHT_RECORD.names).alias("flight"))


def booking_requests_from(orders: DataFrame, customer: DataFrame) -> DataFrame:
    asked = orders.selectExpr(
        "o_orderkey as request_id",
        "o_custkey as c_custkey",
        "o_orderstatus as order_status",
        "cast(1 + o_orderkey % 50 as int) as seats",
        "o_orderdate as request_time",
        "o_orderkey % 24 as turn",
        "case o_orderpriority when '1-URGENT' then 'Critical' when '2-HIGH' then 'High'"
        " when '3-MEDIUM' then 'Medium' else 'Low' end as priority",
        "case o_orderpriority when '1-URGENT' then 4 when '2-HIGH' then 3 when '3-MEDIUM' then 2 else 1 end"
        " as priority_rank",
    )
    home = customer.select("c_custkey", "c_name", "c_nationkey")
    return asked.join(home, "c_custkey").selectExpr(
        "request_id",
        "c_custkey as passenger_id",
        "c_name as passenger_name",
        f"{_code('c_nationkey')} as origin",
        f"{_code(f'(c_nationkey + 1 + turn) % {HUBS}')} as destination",
        "seats",
        "request_time",
        "priority",
        "priority_rank",
        "order_status",
    )


def booking_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return booking_requests_from(read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer"))


def flight_request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create-flight bodies as JSON text, one per flight; some break one of the input rules."""
    flown, places = flights(spark, sf_dir), airports(spark, sf_dir)

    def end(side: str) -> DataFrame:
        return places.select(F.col("code").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("name", "city", "country")])

    fault = F.col("flight_no") % 19
    leaves, lands = F.col("scheduled_departure"), F.col("scheduled_arrival")
    minutes = floor_div(seconds_between(leaves, lands), 60)
    body = F.to_json(
        F.struct(
            F.col("flight_number").alias("flightNumber"),
            *[
                F.col(f"{side}{column}").alias(f"{side}{name}")
                for side in ("origin", "destination")
                for column, name in (("", "Code"), ("_name", "Name"), ("_city", "City"), ("_country", "Country"))
            ],
            "distance",
            F.when(fault == 1, F.lit("2 hours"))
            .otherwise(F.concat(F.lit("PT"), minutes.cast("string"), F.lit("M")))
            .alias("estimatedDuration"),
            F.when(fault == 2, leaves.cast("string"))
            .when(fault == 3, F.substring(format_local_date_time(leaves), 1, 16))
            .otherwise(format_local_date_time(leaves))
            .alias("scheduledDeparture"),
            F.when(fault == 4, F.lit("2024-02-30T10:00:00"))
            .otherwise(format_local_date_time(lands))
            .alias("scheduledArrival"),
            F.when(fault != 5, F.col("total_seats")).alias("totalSeats"),
        )
    )
    return (
        flown.join(end("origin"), "origin")
        .join(end("destination"), "destination")
        .select("flight_id", F.when(fault == 6, F.substring(body, 1, 40)).otherwise(body).alias("body"))
    )


def allocation_request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allocation-request bodies as JSON text, one per day and priority."""
    asked = booking_requests(spark, sf_dir)
    pair = F.struct(
        "request_id",
        F.col("origin").alias("originCode"),
        F.col("destination").alias("destinationCode"),
        F.col("seats").alias("demand"),
    )
    return (
        asked.groupBy(day_text(F.col("request_time")).alias("day"), "priority")
        .agg(F.array_sort(F.collect_list(pair)).alias("pairs"))
        .select(
            F.concat_ws("-", F.lit("alloc"), "day", "priority").alias("allocation_id"),
            F.to_json(
                F.struct(
                    F.concat(F.lit("run-"), F.col("day")).alias("runId"),
                    F.transform("pairs", lambda p: p.dropFields("request_id")).alias("odPairs"),
                    "priority",
                )
            ).alias("body"),
        )
    )


def allocation_demands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same demands as rows, without going through JSON."""
    return demands_of(booking_requests(spark, sf_dir))


def booking_request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Booking bodies as JSON text, one per request; some break one of the input rules."""
    fault = F.col("request_id") % 23
    passenger = F.struct(
        F.concat(F.lit("pax-"), F.col("passenger_id")).alias("passengerId"),
        F.split_part("passenger_name", F.lit("#"), F.lit(1)).alias("firstName"),
        F.when(fault != 1, F.split_part("passenger_name", F.lit("#"), F.lit(2))).alias("lastName"),
        F.concat(F.lit("p"), F.col("passenger_id"), F.when(fault == 2, ".example").otherwise("@mail.example")).alias("email"),
    )
    body = F.to_json(
        F.struct(
            F.when(fault != 3, passenger).alias("passenger"),
            F.when(fault != 4, F.concat(F.lit("F"), F.col("request_id") % 100)).alias("flightId"),
            F.when(fault == 5, 0).otherwise(F.col("seats")).alias("requestedSeats"),
        )
    )
    text = F.when(fault == 6, F.substring(body, 1, 30)).otherwise(body)
    return booking_requests(spark, sf_dir).select(F.concat(F.lit("bk-"), "request_id").alias("booking_id"), text.alias("body"))


#: Steps of a booking: its command and the hours after the request.
BOOKING_STEPS = [("create", 0), ("confirm", 1), ("cancel", 2), ("confirm", 3), ("cancel", 4), ("create", 5), ("confirm", -1)]


def booking_commands_of(assigned: DataFrame) -> DataFrame:
    """Booking commands from requests and their order status: F is confirmed, P confirmed and then cancelled. Some are
    confirmed again or late, cancelled twice or after all, created twice, or confirmed before they are created."""
    number = F.col("request_id")
    wanted = [
        F.lit(True),
        F.col("order_status").isin("F", "P"),
        (F.col("order_status") == "P") | ((F.col("order_status") == "F") & (number % 11 == 0)),
        number % 7 == 0,
        number % 17 == 0,
        number % 13 == 0,
        number % 19 == 0,
    ]
    step = F.explode(F.array_compact(F.array(*[F.when(sent, F.lit(n)) for n, sent in enumerate(wanted)]))).alias("step")
    hours = F.element_at(F.array(*[F.lit(h) for _, h in BOOKING_STEPS]), F.col("step") + 1)
    kind = F.element_at(F.array(*[F.lit(c) for c, _ in BOOKING_STEPS]), F.col("step") + 1)
    sent = assigned.select("*", step).withColumn("hours", hours).withColumn(
        "command_ts", F.expr("timestampadd(HOUR, hours, request_time)")
    )
    is_create = kind == "create"
    # by time, then request, then step, in one number
    hour = floor_div(epoch_micros(F.col("command_ts")), 3_600_000_000)
    return sent.select(
        F.concat(F.lit("bk-"), "request_id").alias("booking_id"),
        (hour * 10**11 + number * 8 + F.col("step")).alias("ordering"),
        kind.alias("command"),
        "command_ts",
        F.when(is_create, F.col("flight_id")).alias("flight_id"),
        F.when(is_create, F.col("seats")).alias("seats"),
    )


def demands_of(requests: DataFrame) -> DataFrame:
    return requests.select(
        F.concat_ws("-", F.lit("alloc"), day_text(F.col("request_time")), "priority").alias("allocation_id"),
        F.concat(F.lit("run-"), day_text(F.col("request_time"))).alias("run_id"),
        "request_id",
        "origin",
        "destination",
        "seats",
        "priority",
        "priority_rank",
        "request_time",
    )


def commands_from(events: DataFrame, firsts: DataFrame | None) -> DataFrame:
    """Flight commands read off the event stream: a user is a flight, its first event creates it.

    ``firsts`` has a row for each user: its first event and the ``flight`` to create. Without it nothing is a create.
    """
    if firsts is None:
        events = events.withColumns({"first_id": F.lit(None).cast("long"), "flight": F.lit(None).cast(FLIGHT_RECORD)})
    else:
        events = events.join(firsts, ["user_id"], "inner")
    kind = (
        F.when(F.col("event_id") == F.col("first_id"), "create")
        .when((F.col("event_type") == "error") & (F.col("event_id") % 50 == 0), "cancel")
        .when(F.col("event_type").isin("click", "purchase"), "allocate")
        .when(F.col("event_type") == "view", "release")
        .otherwise("status")
    )
    return (
        events.withColumn("command", kind)
        .select(
            F.col("user_id").cast("string").alias("flight_id"),
            (F.col("event_id") + 1).alias("ordering"),
            F.col("ts").alias("command_ts"),
            "command",
            F.when(F.col("command") == "create", OPENING_SEATS)
            .when(F.col("command").isin("allocate", "release"), 1 + F.floor("value") % 40)
            .cast("int")
            .alias("seats"),
            F.when(
                F.col("command") == "status",
                F.expr(
                    "element_at(array('Scheduled', 'Boarding', 'Departed', 'Arrived', 'Delayed'),"
                    " cast(event_id % 5 as int) + 1)"
                ),
            )
            .when(F.col("command") == "cancel", "Cancelled")
            .alias("new_status"),
            F.when(F.col("command") == "create", F.col("flight")).alias("flight"),
        )
    )


def first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's first event, and the flight it creates: the one whose number is the user's."""
    firsts = read(spark, sf_dir, "events").groupBy("user_id").agg(F.min("event_id").alias("first_id"))
    records = flight_records(spark, sf_dir).withColumnRenamed("flight_no", "user_id")
    return firsts.join(records, ["user_id"], "left")


def raw_commands_from(events: DataFrame) -> DataFrame:
    """Flight commands as they arrive, with no look at other events. ``opening_seats`` are those of the flight that the
    command would create, were it the first of its flight."""
    return commands_from(events, None).withColumn("opening_seats", F.lit(OPENING_SEATS))


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commands_from(read(spark, sf_dir, "events"), first_events(spark, sf_dir))


def create_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a create or a get, with several creates per flight."""
    return (
        read(spark, sf_dir, "events")
        .select(
            F.col("user_id").cast("string").alias("flight_id"),
            (F.col("event_id") + 1).alias("ordering"),
            F.when(F.col("event_type") == "signup", "create").otherwise("get").alias("command"),
        )
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("operation"),
        F.floor(F.col("value") * 10).alias("duration_ms"),
        F.col("user_id").cast("string").alias("correlation_id"),
    )


def metadata_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What operations note about themselves: a few named values per event, some of them missing."""
    value = F.floor("value").cast("string")
    entries = F.map_from_arrays(
        F.array(F.lit("k"), F.col("event_type"), F.lit("user")),
        F.array(
            F.get_json_object("props", "$.k"),
            F.when(F.col("event_id") % 3 != 0, value),
            F.col("user_id").cast("string"),
        ),
    )
    return read(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("correlation_id"),
        F.concat(F.lit("run-"), day_text(F.col("ts"))).alias("run_id"),
        F.col("event_id").alias("record_no"),
        F.when(F.col("event_id") % 10 != 0, entries).alias("metadata"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured log lines as JSON text."""
    return read(spark, sf_dir, "events").select(
        F.to_json(
            F.struct(
                format_local_date_time(F.col("ts")).alias("timestamp"),
                F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
                F.col("event_type").alias("message"),
                F.col("user_id").cast("string").alias("correlationId"),
                F.concat(F.lit("run-"), day_text(F.col("ts"))).alias("runId"),
                (F.get_json_object("props", "$.k").cast("int") % HUBS).cast("string").alias("odGroup"),
            )
        ).alias("line")
    )


def registration_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that name flights by number; each number is asked for several times, and some
    are not in the flight table."""
    return read(spark, sf_dir, "orders").selectExpr(
        "concat('F', o_orderkey div 5) as flight_id", "o_orderkey as request_no", "o_custkey as requested_by"
    )


def flight_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of each current flight: as it is, and one step later."""
    current = flights_current(spark, sf_dir).select("flight_id", "status", "available_seats")
    later = current.where("status in ('Scheduled', 'Boarding')").withColumn(
        "status", F.when(F.col("status") == "Boarding", "Departed").otherwise("Boarding")
    )
    return current.withColumn("version", F.lit(1).cast("long")).unionByName(
        later.withColumn("version", F.lit(2).cast("long"))
    )


def run_events_from(demands: DataFrame, allocations: DataFrame) -> DataFrame:
    """Events of each allocation run: every run starts; by its day it is still half done, failed,
    or completed."""
    runs = demands.groupBy("allocation_id").agg(
        F.count(F.lit(1)).alias("pairs_total"), F.min("request_time").alias("day")
    )
    made = allocations.groupBy("allocation_id").agg(F.count(F.lit(1)).alias("allocations"))
    number, digit = F.col("sequence_number"), F.dayofmonth("day") % 10
    return (
        runs.join(made, "allocation_id", "left")
        .withColumn("sequence_number", F.explode(F.when(digit == 0, F.expr("array(1L)")).otherwise(F.expr("array(1L, 2L)"))))
        .select(
            "allocation_id",
            F.concat(F.lit("allocation-"), F.col("allocation_id")).alias("persistence_id"),
            "sequence_number",
            F.when(number == 1, "AllocationStarted")
            .when(digit == 1, "AllocationFailed")
            .otherwise("AllocationCompleted")
            .alias("event_type"),
            F.expr("timestampadd(HOUR, cast(sequence_number as int), day)").alias("event_ts"),
            "pairs_total",
            F.when(number == 2, F.col("pairs_total")).otherwise(F.expr("pairs_total div 2")).alias("pairs_done"),
            F.when((number == 2) & (digit != 1), F.coalesce("allocations", F.lit(0))).alias("allocations"),
            F.when((number == 2) & (digit == 1), "capacity feed unavailable").alias("reason"),
        )
    )


def status_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every allocation id, and ids that were never started."""
    known = allocation_demands(spark, sf_dir).select("allocation_id").distinct()
    unknown = read(spark, sf_dir, "customer").selectExpr("concat('alloc-none-', c_custkey) as allocation_id")
    return known.unionByName(unknown)


def update_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and seat updates as JSON text; some status names are misspelt."""
    status = F.expr(
        "element_at(array('Scheduled', 'Boarding', 'boarding', 'Departed', 'Arrived', 'Landed', 'Cancelled', 'Delayed'),"
        " cast(event_id % 8 as int) + 1)"
    )
    is_status = F.col("event_type").isin("signup", "error")
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("update_id"),
        F.to_json(
            F.struct(
                F.when(is_status, status).alias("status"),
                F.when(~is_status, 1 + F.floor("value") % 40).cast("int").alias("seats"),
            )
        ).alias("body"),
    )
