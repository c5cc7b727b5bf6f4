"""Bound-certified best-fit packing of documents into sequences of a fixed number of tokens.

Pieces are dealt by a hash of their row number, so that rows without an id or with one id spread, to partitions small enough
for one task, and packed by best-fit decreasing. Dual feasible functions give a lower bound for the same pieces; where it
equals the number of sequences the partition is certified optimal. A partition with a gap gives up its worst-filled
sequences; what all such partitions give up is dealt anew, so they exchange documents, and packed again, until every
partition is certified, one is left alone with its gap, or a round gives up no fewer pieces than the one before.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarmac.llm.encoding import encoder
from tarmac.llm.text import cut, whole

CAPACITY = 4096
#: Pieces a partition holds on average.
PER_PARTITION = 50_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Documents as tokens, cut every ``capacity`` ids: one row per piece, on request with its ids (little-endian).

    Null text counts as empty, and an empty document is the end id alone.
    """
    end, width = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, drops_space=True).ids
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                for at in range(0, len(ids), width):
                    part = ids[at : at + width]
                    rows.append((doc_id, at // width, at // 4, len(part) // 4, zlib.crc32(part), part)[: 5 + with_ids])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names) if rows else batch.slice(0, 0)

    schema = PIECES + (", ids binary" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    types = [{"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in schema.split(", ")]
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole("text").alias("text"))
    return chosen.mapInArrow(run, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, and the free tokens of each sequence. ``lengths`` must descend."""
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]  # sequences by free tokens
    rooms, room = 0, []  # bit r: some sequence has r free tokens
    for i, length in enumerate(lengths.tolist()):
        fitting = rooms >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            at = by_room[free].pop()
            if not by_room[free]:
                rooms &= ~(1 << free)
        else:
            free, at = capacity, len(room)
            room.append(capacity)
        where[i], offset[i] = at, capacity - free
        room[at] = left = free - length
        by_room[left].append(at)
        rooms |= (1 << left) & ~1
    return where, offset, np.array(room, np.int64)


def lower_bound(counts: np.ndarray, capacity: int, steps: int = 64) -> int:
    """No packing of ``counts[n]`` pieces of each length n uses fewer sequences.

    The largest of two families of dual feasible functions: lengths over capacity - e count whole and those under e not
    at all; and lengths rounded down to k-ths of (k + 1) / k times their share.
    """
    sizes = np.arange(capacity + 1)
    number, tokens = np.cumsum(counts), np.cumsum(counts * sizes)
    e = np.arange(1, capacity // 2 + 1)
    large = number[-1] - number[capacity - e]
    middle = tokens[capacity - e] - tokens[e - 1]
    best = max(-(-int(tokens[-1]) // capacity), int((large + -(-middle // capacity)).max(initial=0)))
    for k in range(1, steps):
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    return best


def _packer(capacity: int, last: bool) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        """Rows (``piece``, the row itself, ``number`` and ``part``) with their places."""
        of = pa.table([pc.struct_field(table.column("piece"), "length"), table.column("number")], ["length", "number"])
        table = table.take(pc.sort_indices(of, [("length", "descending"), ("number", "ascending")]))
        lengths = pc.struct_field(table.column("piece"), "length").to_numpy()
        where, offset, room = best_fit_decreasing(lengths, capacity)
        gap = len(room) - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        given = np.zeros(len(room), bool)
        if gap and not last:  # the emptiest sequences, until their free tokens would fill the gap and one sequence more
            worst = np.argsort(-room, kind="stable")
            given[worst[: np.searchsorted(np.cumsum(room[worst]), (gap + 1) * capacity) + 1]] = True
        out = {"sequence": where, "place": offset, "given": given[where]}
        for name, values in out.items():
            table = table.append_column(name, pa.array(values))
        return table

    return run


def packed(found: DataFrame, capacity: int = CAPACITY, per_partition: int = PER_PARTITION, rounds: int | None = None) -> DataFrame:
    """``found`` pieces with sequence_id and offset; every other column is carried along, whatever its name.

    Sequence ids are unique and otherwise arbitrary. Rows that repeat a document are packed one by one. An empty table
    gives no rows. ``rounds`` ends the exchange earlier.
    """
    names = [n for n in found.columns if n not in ("sequence_id", "offset")]
    piece = F.struct(*[F.col(f"`{n}`") for n in names]).alias("piece")
    open_, done = cut(found.select(piece, F.monotonically_increasing_id().alias("number"))), None
    of_result = "number bigint, part int, sequence bigint, place bigint, given boolean"
    schema = StructType([open_.schema["piece"], *StructType.fromDDL(of_result)])
    turn, before = 0, float("inf")
    while True:
        pieces_left = open_.count()
        groups = max(1, -(-pieces_left // per_partition))
        dealt = open_.withColumn("part", F.pmod(F.xxhash64("number", F.lit(turn)), F.lit(groups)).cast("int"))
        last = turn > 0 and (groups == 1 or pieces_left >= before) or turn + 1 == rounds
        result = cut(dealt.groupBy("part").applyInArrow(_packer(capacity, last), schema))
        number = F.lit(turn << 56).cast("bigint") + F.shiftleft(F.col("part").cast("bigint"), 28) + F.col("sequence")
        settled = result.where("NOT given").select("piece", number.alias("sequence"), "place")
        done = settled if done is None else done.unionByName(settled)
        open_ = result.where("given").select("piece", "number")
        if last or open_.isEmpty():
            break
        turn, before = turn + 1, pieces_left
    columns = [F.col("piece").getField(n).alias(n) for n in names]
    return done.select(*columns, F.col("sequence").alias("sequence_id"), F.col("place").alias("offset"))


def certificate(packing: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """Sequences used, and the lower bound for all pieces together; only a count per length reaches the driver."""
    used = packing.select("sequence_id").distinct().count()
    counts = np.zeros(capacity + 1, np.int64)
    for row in packing.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    return used, lower_bound(counts, capacity)
