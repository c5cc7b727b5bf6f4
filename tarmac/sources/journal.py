"""The event journal: reading, appending and tags. ``payloads`` has its stored-blob form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tarmac.functions.capacity import entity_type
from tarmac.functions.clock import floor_div
from tarmac.operators.skew import DEFAULT, SkewPolicy, ordered_scan
from tarmac.schemas import FLIGHT_ID_PREFIX, JOURNAL
from tarmac.sources.payloads import decode_flight_events as decode_payloads  # noqa: F401  the stored-blob form

SCAN_ORDER = ["persistence_id", "sequence_number"]
#: Orderings that share a folder of the stored journal, so that a range of them is found without reading the rest.
SPAN = 1 << 24


def read_journal(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The stored journal, or the events from ordering ``first`` to ``last`` of it, out of the folders that can hold them."""
    rows = spark.read.schema(StructType([*JOURNAL.fields, StructField("span", LongType())])).parquet(path)
    if first is not None:
        rows = rows.where(F.col("span") >= first // SPAN).where(F.col("ordering") >= first)
    if last is not None:
        rows = rows.where(F.col("span") <= last // SPAN).where(F.col("ordering") <= last)
    return rows.select(*JOURNAL.names)


def read_journal_jdbc(
    spark: SparkSession, url: str, lower: int, upper: int, partitions: int, table: str = "event_journal", **options: str
) -> DataFrame:
    """The stored journal table over JDBC, read in parallel ranges of its unique ``ordering``."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .options(
            partitionColumn="ordering", lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions)
        )
        .load()
    )


def flattened(rows: DataFrame) -> DataFrame:
    """The flight's own columns in place of the nested ``flight``."""
    return rows.select(*[f"`{name}`" for name in rows.columns if name != "flight"], "flight.*")


def live_events(journal: DataFrame) -> DataFrame:
    """Events that are not marked deleted; a null mark, and a journal without marks, mean they are not."""
    return journal.where(~F.coalesce("deleted", F.lit(False))) if "deleted" in journal.columns else journal


def scan(journal: DataFrame) -> DataFrame:
    """Live events by entity and sequence. The sort is by range, and the sequence is part of
    the range, so one busy entity is spread over several partitions."""
    return live_events(journal).orderBy(*SCAN_ORDER)


def entity_ids(journal: DataFrame, prefix: str = FLIGHT_ID_PREFIX) -> DataFrame:
    return (
        live_events(journal)
        .where(F.col("persistence_id").startswith(prefix))
        .select(F.regexp_replace("persistence_id", f"^{prefix}", "").alias("entity_id"))
        .distinct()
    )


def history(journal: DataFrame, persistence_id: str) -> DataFrame:
    return scan(journal.where(F.col("persistence_id") == persistence_id))


def tags() -> Column:
    """The tags of an event: its family, what it is about, and whether it is a create or an end."""
    kind = F.col("event_type")
    return F.array_compact(
        F.array(
            entity_type(F.col("persistence_id")),
            F.when(kind.isin("SeatsAllocated", "SeatsReleased"), "seats").otherwise("lifecycle"),
            F.when(kind.endswith("Created"), "created").when(kind.endswith("Cancelled"), "cancelled"),
        )
    )


def write_tag_index(journal: DataFrame, path: str) -> None:
    """Live events once for each of their tags, in one folder per tag, sorted by ordering.

    A tag's events are range partitioned, so a tag that most events carry is many files.
    """
    tagged = live_events(journal).withColumn("tag", F.explode(tags()))
    tagged.repartitionByRange("tag", "ordering").sortWithinPartitions("tag", "ordering").write.partitionBy("tag").parquet(path)


def events_by_tag(index: DataFrame, tag: str) -> DataFrame:
    """Events carrying a tag, read from the tag's own folder of the index."""
    return index.where(F.col("tag") == tag).drop("tag")


def events_by_tags(index: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Events that carry all the tags, read from these tags' folders alone."""
    held = index.where(F.col("tag").isin(*wanted)).groupBy(*SCAN_ORDER).agg(
        F.count_distinct("tag").alias("held"), F.first("ordering").alias("ordering"), F.first("event_type").alias("event_type")
    )
    return held.where(F.col("held") == len(set(wanted))).drop("held")


def heads(journal: DataFrame) -> DataFrame:
    """Last sequence number and last status of each entity."""
    return journal.groupBy("persistence_id").agg(
        F.max("sequence_number").alias("last_number"),
        F.max_by("new_status", F.when(F.col("new_status").isNotNull(), F.col("sequence_number"))).alias("last_status"),
    )


def not_yet_journaled(decided: DataFrame, journal: DataFrame) -> DataFrame:
    """Leave out events whose arrival number is journaled already, so that a retry adds nothing."""
    return decided.join(journal.select("ordering"), "ordering", "left_anti")


def new_events(
    decided: DataFrame,
    known_heads: DataFrame | None = None,
    policy: SkewPolicy = DEFAULT,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Number accepted events per entity, continuing after ``known_heads``, and note the status
    each status event replaces.

    ``decided`` has the journal's columns but ``sequence_number`` and ``old_status``;
    ``ordering`` is the arrival number.
    """
    numbered = ordered_scan(
        decided,
        ["persistence_id"],
        ["ordering"],
        sums={"sequence_number": F.lit(1).cast("long")},
        previous={"old_status": F.col("new_status")},
        policy=policy,
        sized_by=sized_by,
    )
    if known_heads is not None:
        numbered = numbered.join(known_heads, ["persistence_id"], "left").withColumns(
            {
                "sequence_number": F.col("sequence_number") + F.coalesce("last_number", F.lit(0)),
                "old_status": F.coalesce("old_status", "last_status"),
            }
        )
    changes_status = F.col("new_status").isNotNull()
    return numbered.withColumn("old_status", F.when(changes_status, F.col("old_status"))).select(*JOURNAL.names)


def append(events: DataFrame, path: str) -> None:
    """Add events to the parquet journal: folders by range of ordering, and in each file events of an entity together,
    so that scans of one entity prune row groups."""
    spanned = events.select(*JOURNAL.names, floor_div(F.col("ordering"), SPAN).alias("span"))
    order = ["span", *SCAN_ORDER]
    spanned.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).write.partitionBy("span").mode(
        "append"
    ).parquet(path)


def append_new(decided: DataFrame, path: str, policy: SkewPolicy = DEFAULT) -> None:
    """Add a batch of accepted events to the stored journal, however often the batch is sent.

    ``decided`` has the journal's columns but ``sequence_number`` and ``old_status``. Both keys of the journal stay unique:
    an event whose ``ordering`` is stored already, or comes twice in the batch, is not added again, and an entity's numbers
    go on behind the events that are not of this batch. The whole batch is numbered before the stored part of it is left
    out, so a batch of which a crash stored only some files is completed with the numbers it would have had. Stored
    events are compared within the batch's range of ordering, from that range's folders.
    """
    spark = decided.sparkSession
    sent = decided.dropDuplicates(["ordering"])
    first, last = sent.agg(F.min("ordering"), F.max("ordering")).first()
    if first is None:
        return
    spark.createDataFrame([], JOURNAL).withColumn("span", F.lit(0).cast("long")).write.partitionBy("span").mode("ignore").parquet(path)
    # stored before this batch, and so what its entities' numbers go on from
    touched = sent.select("persistence_id").distinct()
    earlier = read_journal(spark, path).join(touched, "persistence_id", "left_semi")
    others = earlier.join(sent.select("ordering"), "ordering", "left_anti")
    numbered = new_events(sent, heads(others), policy)
    append(not_yet_journaled(numbered, read_journal(spark, path, first, last)), path)
