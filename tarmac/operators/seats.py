"""Seat commands: an ordered, bounded counter per flight.

An allocation is accepted while enough seats are left, a release while the total is not
exceeded, so whether a command counts depends on every command before it. Rows are
repartitioned by flight, sorted, and folded in one pass over Arrow batches; nothing but the
current flight's counter is held.

A flight with very many commands is cut into slices of equal numbers of commands. What a slice does is a
map from the free seats before it to those after it. On a run of numbers that pass the same tests
the map adds the same amount, so it is kept as these runs and amounts, however many seats there
are. Maps compose: they are made slice by slice, composed group by group in parallel, and walked
per flight to give every slice its starting counter. All slices are then folded like ordinary flights.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.clock import floor_div
from tarmac.operators.skew import DEFAULT, PATH, SkewPolicy, heavy_keys, row_slices, split_rows
from tarmac.schemas import FLIGHT_EXISTS, INSUFFICIENT_SEATS

# functions of this module travel to the executors whole, so these need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NOT_FOUND = "Flight not found"
RELEASE_TOO_LARGE = "Release exceeds total seats"
BAD_SEATS = "Invalid number of seats"
UNKNOWN = "Unknown command"

COMMANDS = ("create", "allocate", "release", "status", "cancel")
#: Slices of a flight whose maps are composed in one task.
FAN = 64

_START = "start"
_DECISION = "accepted boolean, reason string, total_seats int, remaining_seats int"


def seat_command_log(
    commands: DataFrame,
    state: DataFrame | None = None,
    policy: SkewPolicy = DEFAULT,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Decide every command, in ``ordering`` within its flight.

    ``commands``: flight_id, ordering (unique), command, seats; other columns are kept. Commands other
    than ``COMMANDS``, and creates, allocations and releases whose seats are null, below 1 or above
    ``MAX_SEATS``, are rejected and change nothing.
    ``state`` (flight_id, total_seats, remaining_seats, one row per flight) is where known
    flights start; others start uncreated. ``sized_by``: rows to measure flights on, when
    ``commands`` is costly.
    """
    starts = None
    if state is not None:
        starts = state.select(
            "flight_id", F.col("total_seats").alias("start_total"), F.col("remaining_seats").alias("start_free")
        )
    heavy = heavy_keys(commands if sized_by is None else sized_by, ["flight_id"], policy)
    if heavy is None:
        return _fold(commands, starts, ["flight_id"])
    hot, cold = split_rows(commands, ["flight_id"], heavy)
    hot = row_slices(hot, ["flight_id"], ["ordering"], policy.chunk).withColumnRenamed("_slice", "slice")
    hot_starts = None if starts is None else split_rows(starts, ["flight_id"], heavy)[0]
    return _fold(hot, _slice_starts(hot, hot_starts), ["flight_id", "slice"]).unionByName(
        _fold(cold, starts, ["flight_id"])
    )


def seat_state(log: DataFrame) -> DataFrame:
    """Last state of each flight and how many commands were accepted and rejected."""
    return log.groupBy("flight_id").agg(
        F.max_by("total_seats", "ordering").alias("total_seats"),
        F.max_by("remaining_seats", "ordering").alias("remaining_seats"),
        F.count_if("accepted").alias("accepted"),
        F.count_if(~F.col("accepted")).alias("rejected"),
        F.max("ordering").alias("last_ordering"),
    )


def gathered(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of a key side by side in one partition, in order.

    The partitioning is on a hash of the keys, not on the keys: were the rows already
    partitioned by them, by a join say, Spark would drop this shuffle, and the join could then
    still split a large partition at run time.
    """
    return rows.repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys, *order)


def _fold(commands: DataFrame, starts: DataFrame | None, keys: list[str]) -> DataFrame:
    """Fold each key's commands. Where a key starts from is a row of its own, sorted in front of
    the commands by its null ordering, so no join is needed."""
    kept = [name for name in commands.columns if name != "slice"]
    fields = [f"{name} {commands.schema[name].dataType.simpleString()}" for name in kept]
    nothing = F.lit(None).cast("int")
    rows = commands.withColumns({"start_total": nothing, "start_free": nothing})
    if starts is not None:
        rows = rows.unionByName(starts.withColumn("command", F.lit(_START)), allowMissingColumns=True)
    return gathered(rows, keys, ["ordering"]).mapInArrow(_folder(keys, kept), ", ".join([*fields, _DECISION]))


def ints(column: pa.Array) -> list[int]:
    """Integers with -1 for null, as a plain list."""
    return pc.fill_null(column, -1).to_numpy(zero_copy_only=False).tolist()


def new_keys(batch: pa.RecordBatch, keys: list[str], last: tuple | None) -> list[bool]:
    """For each row, whether its key differs from the row before; ``last`` precedes the batch."""
    changed = np.zeros(batch.num_rows, dtype=bool)
    for name in keys:
        column = batch.column(name)
        if pa.types.is_list(column.type):
            values = column.to_pylist()
            changed[1:] |= np.fromiter((a != b for a, b in zip(values, values[1:])), bool, len(values) - 1)
        else:
            here, there = column.slice(1), column.slice(0, len(column) - 1)  # a null is another key than any value
            other = pc.or_(pc.fill_null(pc.not_equal(here, there), False), pc.xor(here.is_null(), there.is_null()))
            changed[1:] |= other.to_numpy(zero_copy_only=False)
    changed[0] = tuple(batch.column(name)[0].as_py() for name in keys) != last
    return changed.tolist()


_START_KIND, _CREATE, _ALLOCATE, _RELEASE = range(4)
_REASONS = [None, NOT_FOUND, FLIGHT_EXISTS, INSUFFICIENT_SEATS, RELEASE_TOO_LARGE, BAD_SEATS, UNKNOWN]
_ACCEPTED, _NOT_FOUND, _EXISTS, _INSUFFICIENT, _TOO_LARGE, _BAD_SEATS, _UNKNOWN = range(7)


def _decided(kind: int, seats: int, total: int, free: int) -> tuple[int, int, int]:
    """Verdict and the seats after it. ``kind`` is the place in start and ``COMMANDS``, -1 for others; a flight that does
    not exist has a negative total."""
    if kind < 0:
        return _UNKNOWN, total, free
    if kind <= _RELEASE and seats <= 0:
        return _BAD_SEATS, total, free
    if total < 0:
        return (_ACCEPTED, seats, seats) if kind == _CREATE else (_NOT_FOUND, total, free)
    if kind == _ALLOCATE:
        return (_ACCEPTED, total, free - seats) if free >= seats else (_INSUFFICIENT, total, free)
    if kind == _RELEASE:
        return (_ACCEPTED, total, free + seats) if free + seats <= total else (_TOO_LARGE, total, free)
    return (_EXISTS if kind == _CREATE else _ACCEPTED), total, free


def seat_decision(command: str | None, seats: int | None, total: int, free: int) -> tuple[str | None, int, int]:
    """Why the command fails, null if it is accepted, and the seats after it; a negative total means no flight."""
    kind = COMMANDS.index(command) + 1 if command in COMMANDS else -1
    verdict, total, free = _decided(kind, -1 if seats is None else seats, total, free)
    return _REASONS[verdict], total, free


def _folder(keys: list[str], kept: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, reasons = pa.array([_START, *COMMANDS]), pa.array(_REASONS)
        last, total, free = None, -1, -1  # total is negative while the flight does not exist
        for batch in batches:
            if not batch.num_rows:
                continue
            verdicts, totals, frees = [], [], []
            kind_of = pc.index_in(batch.column("command"), kinds)
            for new, kind, seats, start_total, start_free in zip(
                new_keys(batch, keys, last),
                ints(kind_of),
                ints(batch.column("seats")),
                ints(batch.column("start_total")),
                ints(batch.column("start_free")),
            ):
                if new:
                    total, free = -1, -1
                if kind == _START_KIND:
                    if start_total >= 0:
                        total, free = start_total, start_free
                    continue
                verdict, total, free = _decided(kind, seats, total, free)
                verdicts.append(verdict)
                totals.append(total)
                frees.append(free)
            last = tuple(batch.column(name)[batch.num_rows - 1].as_py() for name in keys)
            codes, unborn = pa.array(verdicts, pa.int8()), pc.less(pa.array(totals, pa.int32()), 0)
            decided = batch.filter(pc.not_equal(pc.fill_null(batch.column("command"), ""), _START))
            known = [pc.if_else(unborn, pa.scalar(None, pa.int32()), pa.array(n, pa.int32())) for n in (totals, frees)]
            yield pa.RecordBatch.from_arrays(
                [*[decided.column(n) for n in kept], pc.equal(codes, _ACCEPTED), pc.take(reasons, codes), *known],
                names=[*kept, "accepted", "reason", "total_seats", "remaining_seats"],
            )

    return fold


# --- what a run of commands does -----------------------------------------------------------


class SeatMap:
    """Free seats after some commands, for each number of free seats before them, from 0 to ``top``.

    From ``starts[i]`` up to the next start the map adds ``shifts[i]``.
    """

    def __init__(self, top: int, starts: np.ndarray, shifts: np.ndarray) -> None:
        self.top, self.starts, self.shifts = top, starts, shifts

    @classmethod
    def unchanged(cls, top: int) -> SeatMap:
        return cls(top, np.zeros(1, np.int64), np.zeros(1, np.int64))

    @classmethod
    def constant(cls, value: int) -> SeatMap:
        """Of a flight that is created on the way: what was before does not matter, 0 stands for it."""
        return cls(0, np.zeros(1, np.int64), np.array([value], np.int64))

    def __call__(self, free: int) -> int:
        i = int(np.searchsorted(self.starts, free, "right")) - 1
        return free + int(self.shifts[i])

    def _ends(self) -> np.ndarray:
        return np.append(self.starts[1:] - 1, self.top)

    def _split(self, at: int) -> None:
        """Cut every run whose images go over ``at`` in front of the number that lands there."""
        low, high = self.starts + self.shifts, self._ends() + self.shifts
        over = np.flatnonzero((low < at) & (at <= high))
        if len(over):
            self.starts = np.insert(self.starts, over + 1, at - self.shifts[over])
            self.shifts = np.insert(self.shifts, over + 1, self.shifts[over])

    def _joined(self) -> None:
        if len(self.shifts) > 1:
            new = np.append(True, self.shifts[1:] != self.shifts[:-1])
            if not new.all():
                self.starts, self.shifts = self.starts[new], self.shifts[new]

    def allocate(self, seats: int) -> None:
        self._split(seats)
        self.shifts = np.where(self.starts + self.shifts >= seats, self.shifts - seats, self.shifts)
        self._joined()

    def release(self, seats: int, total: int) -> None:
        self._split(total - seats + 1)
        self.shifts = np.where(self.starts + self.shifts <= total - seats, self.shifts + seats, self.shifts)
        self._joined()

    def then(self, later: SeatMap) -> SeatMap:
        """This map followed by ``later``."""
        low, high = self.starts + self.shifts, self._ends() + self.shifts
        first = np.searchsorted(later.starts, low, "right") - 1
        many = np.searchsorted(later.starts, high, "right") - first
        own = np.repeat(np.arange(len(low)), many)
        piece = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many) + first[own]
        starts = np.maximum(later.starts[piece] - self.shifts[own], self.starts[own])
        found = SeatMap(self.top, starts, self.shifts[own] + later.shifts[piece])
        found._joined()
        return found


# --- flights with very many commands -------------------------------------------------------


def _slice_starts(hot: DataFrame, starts: DataFrame | None) -> DataFrame:
    """(flight_id, slice) -> start_total, start_free for the slices of heavy flights."""
    created = (
        hot.where((F.col("command") == "create") & (F.col("seats") > 0))
        .groupBy("flight_id")
        .agg(F.min("ordering").alias("created_at"), F.min_by("seats", "ordering").alias("created_seats"))
    )
    flights = hot.select("flight_id").distinct().join(created, "flight_id", "left")
    if starts is None:
        nothing = F.lit(None).cast("int")
        flights = flights.withColumns({"start_total": nothing, "start_free": nothing})
    else:
        flights = flights.join(starts, "flight_id", "left")
    # a flight that exists from the start takes no create
    known = F.col("start_total").isNotNull()
    flights = flights.select(
        "flight_id",
        F.when(~known, F.col("created_at")).alias("created_at"),
        F.coalesce("start_total", "created_seats").alias("capacity"),
        "start_total",
        "start_free",
    )
    # at most one row per heavy flight, so the size bound of the heavy keys carries over
    rows = hot.join(F.broadcast(flights), "flight_id").where(F.col("capacity").isNotNull())
    needed = rows.select(
        "flight_id", "slice", "ordering", "command", "seats", "created_at", "capacity", "start_total", "start_free"
    )
    made = gathered(needed, ["flight_id", "slice"], ["ordering"]).mapInArrow(_slice_maps, f"flight_id string, slice {PATH}, {_MAP}")
    turn = F.row_number().over(Window.partitionBy("flight_id").orderBy("slice"))
    maps = made.withColumn("turn", turn).withColumn("span", floor_div(F.col("turn"), FAN)).checkpoint()
    spans = gathered(maps.drop("slice"), ["flight_id", "span"], ["turn"]).mapInArrow(_composed, f"flight_id string, span long, {_MAP}")
    of_spans = gathered(spans, ["flight_id"], ["span"]).mapInArrow(
        _walked(["flight_id"], ["span"]), "flight_id string, span long, start_total int, start_free int"
    )
    inside = maps.drop("start_total", "start_free").join(of_spans, ["flight_id", "span"])
    return gathered(inside, ["flight_id", "span"], ["turn"]).mapInArrow(
        _walked(["flight_id", "span"], ["slice"]), f"flight_id string, slice {PATH}, start_total int, start_free int"
    )


_MAP = (
    "created boolean, capacity int, start_total int, start_free int, top long, starts array<long>, shifts array<long>"
)


def _map_row(seat_map: SeatMap, created: bool, capacity: int, start_total: int | None, start_free: int | None) -> dict:
    return {
        "created": pa.array([created], pa.bool_()),
        "capacity": pa.array([capacity], pa.int32()),
        "start_total": pa.array([start_total], pa.int32()),
        "start_free": pa.array([start_free], pa.int32()),
        "top": pa.array([seat_map.top], pa.int64()),
        "starts": pa.array([seat_map.starts], pa.list_(pa.int64())),
        "shifts": pa.array([seat_map.shifts], pa.list_(pa.int64())),
    }


def _slice_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (flight, slice): what the slice does to the free seats, and whether the flight is created in it."""
    current, seat_map, about, created = None, None, None, False

    def emit() -> pa.RecordBatch:
        key = {"flight_id": pa.array([current[0]], pa.string()), "slice": pa.array([current[1]], pa.list_(pa.int64()))}
        return pa.RecordBatch.from_pydict(key | _map_row(seat_map, created, *about[1:]))

    kinds = pa.array(["allocate", "release"])
    for batch in batches:
        if not batch.num_rows:
            continue
        column = {name: batch.column(name) for name in batch.schema.names}
        rows = zip(
            zip(column["flight_id"].to_pylist(), column["slice"].to_pylist()),
            ints(column["ordering"]),
            ints(pc.index_in(column["command"], kinds)),
            ints(column["seats"]),
        )
        for i, (key, ordering, kind, seats) in enumerate(rows):
            if key != current:
                if current is not None:
                    yield emit()
                current, created = key, False
                about = [column[n][i].as_py() for n in ("created_at", "capacity", "start_total", "start_free")]
                seat_map = SeatMap.unchanged(about[1])
            created_at, capacity = about[:2]
            if created_at is not None and ordering <= created_at:
                if ordering == created_at:
                    seat_map, created = SeatMap.constant(capacity), True
            elif seats <= 0:
                pass
            elif kind == 0:
                seat_map.allocate(seats)
            elif kind == 1:
                seat_map.release(seats, capacity)
    if current is not None:
        yield emit()


def _maps(batch: pa.RecordBatch) -> Iterator[SeatMap]:
    starts, shifts = batch.column("starts"), batch.column("shifts")
    for i, top in enumerate(batch.column("top").to_pylist()):
        yield SeatMap(top, starts[i].values.to_numpy(), shifts[i].values.to_numpy())


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (flight, span): the maps of its slices as one."""
    current, whole, about, created = None, None, None, False

    def emit() -> pa.RecordBatch:
        key = {"flight_id": pa.array([current[0]], pa.string()), "span": pa.array([current[1]], pa.int64())}
        return pa.RecordBatch.from_pydict(key | _map_row(whole, created, *about))

    for batch in batches:
        names = ("flight_id", "span", "created", "capacity", "start_total", "start_free")
        for flight, span, creates, *facts, seat_map in zip(*(batch.column(n).to_pylist() for n in names), _maps(batch)):
            if (flight, span) != current:
                if current is not None:
                    yield emit()
                current, whole, about, created = (flight, span), seat_map, facts, creates
            elif creates:
                whole, created = seat_map, True
            else:
                whole = whole.then(seat_map)
    if current is not None:
        yield emit()


def _walked(keys: list[str], named: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Walk the maps of each key in order, handing every one the counter it starts from."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total, free = None, None, None
        for batch in batches:
            totals, frees = [], []
            facts = ("created", "capacity", "start_total", "start_free")
            rows = zip(zip(*(batch.column(n).to_pylist() for n in keys)), *(batch.column(n).to_pylist() for n in facts), _maps(batch))
            for key, created, capacity, first_total, first_free, seat_map in rows:
                if key != current:
                    current, total, free = key, first_total, first_free
                totals.append(total)
                frees.append(free)
                if created:
                    total, free = capacity, seat_map(0)
                elif total is not None:
                    free = seat_map(free)
            yield pa.RecordBatch.from_arrays(
                [batch.column("flight_id"), *[batch.column(n) for n in named], pa.array(totals, pa.int32()), pa.array(frees, pa.int32())],
                ["flight_id", *named, "start_total", "start_free"],
            )

    return walk
