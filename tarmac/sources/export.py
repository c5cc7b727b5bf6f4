"""Result documents as JSON text, one per line.

Flights are one document each, and so are allocation runs. For runs too large for one document, parts of
a number of demands can be asked for; a part says which one it is and of how many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.clock import floor_div, seconds_between
from tarmac.functions.durations import format_duration, format_local_date_time


def _airport(code: str, prefix: str | None = None) -> Column:
    """An airport object; without a ``prefix`` only the code is known."""
    details = [
        (F.lit("") if prefix is None else F.coalesce(f"{prefix}_{name}", F.lit(""))).alias(name)
        for name in ("name", "city", "country")
    ]
    return F.struct(F.col(code).alias("code"), *details).alias(code)


def flight_documents(flights: DataFrame, airports: DataFrame) -> DataFrame:
    for end in ("origin", "destination"):
        names = airports.select(
            F.col("code").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in ("name", "city", "country")]
        )
        flights = flights.join(names, [end], "left")
    length = seconds_between(F.col("scheduled_departure"), F.col("scheduled_arrival"))
    document = F.struct(
        F.col("flight_id").alias("flightId"),
        F.col("flight_number").alias("flightNumber"),
        F.struct(
            _airport("origin", "origin"),
            _airport("destination", "destination"),
            "distance",
            format_duration(length).alias("estimatedDuration"),
        ).alias("route"),
        format_local_date_time(F.col("scheduled_departure")).alias("scheduledDeparture"),
        format_local_date_time(F.col("scheduled_arrival")).alias("scheduledArrival"),
        F.col("total_seats").alias("totalSeats"),
        F.col("available_seats").alias("availableSeats"),
        "status",
    )
    return flights.select("flight_id", F.to_json(document).alias("document"))


def _listed(position: list[str], text: Column, keep: Column | None = None) -> Column:
    """Elements of a JSON array, in order, as one text."""
    element = F.struct(*position, text.alias("text"))
    elements = F.collect_list(element if keep is None else F.when(keep, element))
    return F.array_join(F.transform(F.array_sort(elements), lambda e: e["text"]), ",")


def allocation_documents(
    outcome: DataFrame,
    allocations: DataFrame,
    flight_docs: DataFrame,
    processing_ms: Column | None = None,
    part: int | None = None,
) -> DataFrame:
    """Results per allocation id. ``outcome`` and ``allocations`` carry ``position``, which orders the
    demands of a run; ``flight_docs`` comes from ``flight_documents``.

    Each allocation shows its O&D pair, flight and seats; unallocated demand is listed as
    [pair, seats]. A run is completed at its last request. With ``part``, ``position`` must be the place
    of the demand in its run, from 0, and a document holds that many places; it then names its part, and
    every part has the run's number of parts and its time of completion.
    """
    pair = F.to_json(F.struct(_airport("origin"), _airport("destination")))
    number = F.lit(0) if part is None else floor_div(F.col("position"), part)
    where = [F.col("allocation_id"), number.alias("part")]

    shown = allocations.join(flight_docs, ["flight_id"], "left")
    given = shown.groupBy(*where).agg(
        F.count(F.lit(1)).alias("allocation_count"),
        _listed(
            ["position", "axis_start"],
            F.concat(
                F.lit('{"odPair":'), pair, F.lit(',"flight":'), F.col("document"),
                F.lit(',"seatsAllocated":'), F.col("seats_allocated").cast("string"), F.lit("}"),
            ),
        ).alias("allocations"),
    )
    short = F.col("unallocated_seats") > 0
    left = outcome.groupBy(*where, "run_id").agg(
        F.count_if(short).alias("unallocated_count"),
        F.max("request_time").alias("completed_at"),
        _listed(
            ["position"],
            F.concat(F.lit("["), pair, F.lit(","), F.col("unallocated_seats").cast("string"), F.lit("]")),
            short,
        ).alias("unallocated"),
    )
    named = [F.col("allocation_id").alias("allocationId"), F.col("run_id").alias("runId")]
    if part is not None:
        runs = left.groupBy("allocation_id").agg(F.max("completed_at").alias("completed_at"), F.max("part").alias("last"))
        left = left.drop("completed_at").join(runs, "allocation_id")
        named += [F.col("part"), (F.col("last") + 1).alias("parts")]
    header = F.to_json(F.struct(*named))
    footer = F.to_json(
        F.struct(
            (F.lit(0) if processing_ms is None else processing_ms).cast("long").alias("processingTimeMs"),
            format_local_date_time(F.col("completed_at")).alias("completedAt"),
        )
    )
    document = F.concat(
        F.rtrim(header, F.lit("}")), F.lit(',"allocations":['), F.coalesce("allocations", F.lit("")),
        F.lit('],"unallocated":['), F.col("unallocated"), F.lit("],"), F.ltrim(footer, F.lit("{")),
    )
    return left.join(given, ["allocation_id", "part"], "left").select(
        "allocation_id",
        *([] if part is None else ["part"]),
        F.coalesce("allocation_count", F.lit(0)).cast("long").alias("allocation_count"),
        "unallocated_count",
        document.alias("document"),
    )


def parse_allocation_documents(lines: DataFrame, column: str = "document") -> DataFrame:
    """Read result documents back: one row per allocation and per unallocated pair."""
    read = lines.select(
        F.from_json(
            column,
            "allocationId string, runId string, allocations array<struct<odPair:struct<origin:struct<code:string>,"
            "destination:struct<code:string>>,flight:struct<flightId:string>,seatsAllocated:long>>,"
            # a pair and a number in one array: read as text, then parse the pair
            "unallocated array<array<string>>",
        ).alias("d")
    ).select("d.*")
    ids = [F.col("allocationId").alias("allocation_id"), F.col("runId").alias("run_id")]
    given = read.select(*ids, F.explode("allocations").alias("a")).select(
        "allocation_id",
        "run_id",
        F.col("a.odPair.origin.code").alias("origin"),
        F.col("a.odPair.destination.code").alias("destination"),
        F.col("a.flight.flightId").alias("flight_id"),
        F.col("a.seatsAllocated").alias("seats"),
    )
    pair = F.from_json(F.col("u")[0], "origin struct<code:string>, destination struct<code:string>")
    left = read.select(*ids, F.explode("unallocated").alias("u")).select(
        "allocation_id",
        "run_id",
        pair["origin"]["code"].alias("origin"),
        pair["destination"]["code"].alias("destination"),
        F.lit(None).cast("string").alias("flight_id"),
        F.col("u")[1].cast("long").alias("seats"),
    )
    return given.unionByName(left)


def write_documents(documents: DataFrame, path: str) -> None:
    documents.select("document").write.text(path)


def write_listing(documents: DataFrame, path: str, files: int | None = None) -> None:
    """Flights as files that each hold a ``{"flights": [...]}`` listing, one flight per line.

    The rows of a file are streamed through; none is gathered in memory.
    """

    def wrap(batches):
        import pandas as pd

        opened = False
        for batch in batches:
            lines = [("," if i or opened else '{"flights":[') + text for i, text in enumerate(batch["document"])]
            if lines:
                opened = True
                yield pd.DataFrame({"value": lines})
        if opened:
            yield pd.DataFrame({"value": ["]}"]})

    rows = documents.select("document")
    (rows if files is None else rows.repartition(files)).mapInPandas(wrap, "value string").write.text(path)


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """The flights of written listings: flight_id and the flight's document, with the listing around it taken off."""
    lines = spark.read.text(path)
    flight = F.regexp_replace("value", r'^(\{"flights":\[|,)', "")
    return lines.where("value <> ']}'").select(F.get_json_object(flight, "$.flightId").alias("flight_id"), flight.alias("document"))
