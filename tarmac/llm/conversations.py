"""Repair of conversations by a minimum-cost edit, solved block by block with precomputed transitions.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``. Edits: keep a row (0), set its role
to user or assistant (1), delete it (2; required for blank rows and repetitions), insert an empty user or assistant row
(5). A truncated row that is not deleted costs 5 more. The cheapest edits are wanted, and of these the ASCII-least.

Four Russians: what lies ahead of a place is summed up by four costs, one for each state of the pattern. Less their
minimum they take few values, so for every vector and every block of ``BLOCK`` symbols the vector in front of the block
is tabulated, and a conversation is solved by one lookup a block, from its end to its start. For tracing, a block is
expanded backward into the vectors inside it; every step then takes the least letter among the cheapest, so ties are
decided by true costs to the end.

A conversation may hold any share of the rows. Equal rows are combined before the first shuffle. Rows are range
partitioned by conversation and turn and cut into chunks of at most 2^``CHUNK_BITS`` rows. A chunk is a map from the
vector behind it to the vector in front of it; maps are chained per conversation, chunks are then traced in parallel
from every state a chunk may start in, and a second chain picks the state. Only the digest of a repaired conversation
is made in one task, as SHA-256 reads its input in order; it holds one batch.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.text import cut

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Symbols of a block; the table has 8^BLOCK columns.
BLOCK = 4
CHUNK_BITS = 11
#: Edits and audit letters sent back at once.
OUTPUT_EDITS = 1 << 16

SPACE = " \t\n\x0b\f\r"
INITIALS = "sua"
#: Faults of a row, the first that holds counting from the right.
CLEAN, CUT_OFF, REPEATED, BLANK = range(4)
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: State after one more row of role user or assistant, and that role.
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {EMPTY: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
#: State after a row is kept, by state and initial.
KEPT = {(EMPTY, 0): SYSTEM, (EMPTY, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
LEGAL = {(0, 1), (1, 2), (2, 1)}
NO_TEXT = hashlib.sha256().hexdigest()


# --- transition tables ---------------------------------------------------------------------


def _inserted(costs: list[int]) -> tuple[int, ...]:
    """Costs when rows may be inserted first."""
    for _ in range(2):
        costs = [min(costs[s], INSERT + costs[NEXT[s]]) for s in range(4)]
    return tuple(costs)


def _choices(after: tuple[int, ...], symbol: int, state: int) -> list[tuple[int, str, int]]:
    """Cost to the end, letter and next state of what can be done with a row (initial, truncated or not)."""
    initial, extra = symbol >> 1, TRUNCATED * (symbol & 1)
    found = [(DELETE + after[state], "D", state)]
    if (state, initial) in KEPT:
        found.append((KEEP + extra + after[KEPT[state, initial]], "K", KEPT[state, initial]))
    return [*found, (REROLE + extra + after[NEXT[state]], "R", NEXT[state])]


def _before(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    return _inserted([min(_choices(after, symbol, s))[0] for s in range(4)])


def _decided(after: tuple[int, ...], symbol: int, state: int) -> tuple[str, int]:
    """Letters that use up one row, and the state behind it. D < I < K < R, so inserting comes second."""
    costs, letters = _before(after, symbol), ""
    while True:
        best = sorted((letter, then) for cost, letter, then in _choices(after, symbol, state) if cost == costs[state])
        if best and not (best[0][0] > "I" and INSERT + costs[NEXT[state]] == costs[state]):
            return letters + best[0][0], best[0][1]
        letters, state = letters + "I", NEXT[state]


class Tables:
    """All vectors that can lie behind a row; ``one`` and ``many`` give the vector in front of a symbol and of a block."""

    def __init__(self) -> None:
        end = _inserted([0, 2 * INSERT, INSERT, 0])
        self.vectors, found = [end], {end: 0}
        steps, self.letters = [], []
        for vector in self.vectors:  # grows while it is read
            row, said = [], []
            for symbol in range(8):
                costs = _before(vector, symbol)
                least = min(costs)
                reached = tuple(c - least for c in costs)
                if reached not in found:
                    found[reached] = len(self.vectors)
                    self.vectors.append(reached)
                row.append(found[reached])
                said.append([_decided(vector, symbol, s) for s in range(4)])
            steps.append(row)
            self.letters.append(said)
        self.one = np.array(steps, np.uint8)
        many = self.one
        for _ in range(BLOCK - 1):  # one more symbol in front: its number is the high digit
            many = np.concatenate([self.one[many, symbol] for symbol in range(8)], axis=1)
        self.many = many
        self.expanded: dict[tuple[int, int, int], tuple[list[str], int]] = {}

    def blocks(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the whole blocks, and the symbols behind them."""
        whole = len(symbols) // BLOCK * BLOCK
        weights = 8 ** np.arange(BLOCK - 1, -1, -1)
        return symbols[:whole].reshape(-1, BLOCK) @ weights, symbols[whole:]

    def map(self, symbols: np.ndarray) -> np.ndarray:
        """The vector in front of the symbols for each vector behind them."""
        blocks, rest = self.blocks(symbols)
        at = np.arange(len(self.vectors))
        for symbol in rest[::-1]:
            at = self.one[at, symbol]
        for block in blocks[::-1]:
            at = self.many[at, block]
        return at.astype(np.uint8)

    def behind(self, symbols: np.ndarray, end: int) -> tuple[list[int], list[int], list[int], list[int]]:
        """Blocks and rest, each with the vectors behind them."""
        blocks, rest = self.blocks(symbols)
        of_rest, of_blocks, at = [], [], end
        for symbol in rest[::-1].tolist():
            of_rest.append(at)
            at = int(self.one[at, symbol])
        for block in blocks[::-1].tolist():
            of_blocks.append(at)
            at = int(self.many[at, block])
        return blocks.tolist(), of_blocks[::-1], rest.tolist(), of_rest[::-1]

    def expand(self, behind: int, block: int, state: int) -> tuple[list[str], int]:
        """Letters of each row of a block, and the state behind it."""
        key = behind, block, state
        if key not in self.expanded:
            symbols = [block // 8**k % 8 for k in range(BLOCK - 1, -1, -1)]
            inside = [behind]
            for symbol in symbols[:0:-1]:
                inside.append(int(self.one[inside[-1], symbol]))
            letters = []
            for symbol, vector in zip(symbols, inside[::-1]):
                said, state = self.letters[vector][symbol][state]
                letters.append(said)
            self.expanded[key] = letters, state
        return self.expanded[key]

    def trace(self, symbols: np.ndarray, end: int, state: int) -> tuple[list[str], int]:
        blocks, of_blocks, rest, of_rest = self.behind(symbols, end)
        letters: list[str] = []
        for block, vector in zip(blocks, of_blocks):
            said, state = self.expand(vector, block, state)
            letters += said
        for symbol, vector in zip(rest, of_rest):
            said, state = self.letters[vector][symbol][state]
            letters.append(said)
        return letters, state


@functools.cache
def tables() -> Tables:
    return Tables()


# --- rows ----------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in, by crc32 of ``conv_id:turn``: 0 drops the row, 1 empties it, 2 takes its sentence ends,
    3 repeats it, 4 makes it the user's. Nulls in the key, the role and the text stand as one space."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(said[0], F.lit(":"), said[1])) % 20
    rows = conversations.select("conv_id", "turn", "role", "text", fault.alias("fault")).where("fault <> 0")
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _said() -> Column:
    """256 bits of role and text."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def prepared(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``said``; a null role or text is one space."""
    space = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    return rows.withColumn("said", _said())


def placed(rows: DataFrame) -> DataFrame:
    """Distinct prepared rows without their text, in order: ``place`` rises with conversation, turn (nulls first), role and
    text digest; ``copies`` equal rows stand at one place. ``code`` is the initial's number times 4 plus the fault."""
    ending = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    initial = F.substring("role", 1, 1)
    light = rows.select(
        "conv_id",
        "turn",
        "said",
        F.substring("role", 1, 32).alias("start"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"),
        F.when(ending == "", BLANK).when(ending.isin(*".!?"), CLEAN).otherwise(CUT_OFF).alias("fault"),
    )
    order = ["conv_id", "turn", "start", "said"]
    distinct = light.groupBy(*order, "initial", "fault").agg(F.count(F.lit(1)).alias("copies"))
    ordered = distinct.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(
        *[F.col(c).asc_nulls_first() for c in order]
    )
    numbered = cut(ordered.withColumn("place", F.monotonically_increasing_id()))
    first = numbered.where(F.col("fault") != BLANK).groupBy("conv_id", "said").agg(F.min("place").alias("place"))
    marked = numbered.join(first.select("place", F.lit(True).alias("first")), "place", "left")
    fault = F.when((F.col("fault") != BLANK) & F.col("first").isNull(), REPEATED).otherwise(F.col("fault"))
    return marked.select("conv_id", "turn", "said", "place", "copies", (F.col("initial") * 4 + fault).cast("byte").alias("code"))


def chunks(places: DataFrame) -> DataFrame:
    """Up to 2^CHUNK_BITS neighbouring places of a conversation in one row; ``at`` is the first of them."""
    row = F.struct("place", "code", "copies")
    found = places.groupBy("conv_id", F.shiftright("place", CHUNK_BITS).alias("part")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return found.select(
        "conv_id",
        F.col("rows")[0]["place"].alias("at"),
        F.transform("rows", lambda r: r["code"]).alias("codes"),
        F.transform("rows", lambda r: r["copies"]).alias("copies"),
    )


def _symbols(codes: np.ndarray) -> np.ndarray:
    """Symbols of the rows that need not be deleted. The others add the same to all four costs, so they move no vector."""
    left = codes[codes % 4 <= CUT_OFF].astype(np.int64)
    return (left >> 2) * 2 + left % 4


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.split(values, (column.offsets.to_numpy() - column.offsets[0].as_py())[1:-1]) if len(column) else []


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = _lists(batch.column("codes"))
        maps = [tables().map(_symbols(c)).tobytes() for c in codes]
        first, last = ([int(c[i]) >> 2 for c in codes] for i in (0, -1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("at"), pa.array(maps, pa.binary()), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
            ["conv_id", "at", "map", "first", "last"],
        )


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's chunks from its last to its first: the vector behind each, whether it is the last or the first,
    and whether its last row and the next chunk's first are an illegal pair."""
    schema = pa.schema([("at", pa.int64()), ("behind", pa.int32()), ("closes", pa.bool_()), ("opens", pa.bool_()), ("seam", pa.int64())])
    fresh, conv, held, vector, following = True, None, None, 0, 0
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "at", "map", "first", "last")]
        out = []
        for of, at, through, first, last in zip(*columns):
            new = fresh or of != conv
            if held is not None:
                out.append((*held[:3], new, held[3]))
            if new:
                vector = 0
            held = at, vector, new, 0 if new else int((last, following) not in LEGAL)
            vector, following, conv, fresh = through[vector], first, of, False
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema) if out else pa.RecordBatch.from_pylist([], schema)
    if held is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*held[:3], True, held[3])))], schema)


_EDIT = "array<struct<place:bigint,part:int,role:string,kept:boolean>>"
_TRACED = (
    "at bigint, entry int, exit int, audit string, cost bigint, blank bigint, duplicate bigint, truncated bigint,"
    f" illegal bigint, edits {_EDIT}"
)


def _traced(conv_type: pa.DataType):
    edit = pa.list_(pa.struct([("place", pa.int64()), ("part", pa.int32()), ("role", pa.string()), ("kept", pa.bool_())]))
    numbers = [(n, pa.int64()) for n in ("cost", "blank", "duplicate", "truncated", "illegal")]
    schema = pa.schema(
        [("conv_id", conv_type), ("at", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()), ("audit", pa.string()), *numbers, ("edits", edit)]
    )

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held = [], 0
            names = ("conv_id", "at", "behind", "closes", "opens", "seam")
            for codes, copies, (conv, at, behind, closes, opens, seam) in zip(
                _lists(batch.column("codes")), _lists(batch.column("copies")), zip(*(batch.column(n).to_pylist() for n in names))
            ):
                symbols, counted = _symbols(codes), _counted(codes, copies, seam)
                if held > OUTPUT_EDITS:
                    yield pa.RecordBatch.from_pylist(found, schema)
                    found, held = [], 0
                for entry in [EMPTY] if opens else range(4):
                    letters, state = tables().trace(symbols, behind, entry)
                    audit, cost, edits = _edits(codes.tolist(), copies.tolist(), letters, at, entry)
                    if closes:
                        last = at + len(codes) - 1
                        while state in (SYSTEM, USER):
                            edits.append({"place": last, "part": 3 + len(edits), "role": ROLE[state], "kept": False})
                            audit, cost, state = audit + "I", cost + INSERT, NEXT[state]
                    found.append(dict(zip(schema.names, (conv, at, entry, state, audit, cost, *counted, edits))))
                    held += len(edits) + len(audit)
            yield pa.RecordBatch.from_pylist(found, schema)

    return trace


def _counted(codes: np.ndarray, copies: np.ndarray, seam: int) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and illegal neighbours; equal rows at one place are illegal neighbours."""
    faults, initials = codes % 4, codes >> 2
    again = int(copies[faults < REPEATED].sum() - (faults < REPEATED).sum())
    pairs = sum((a, b) not in LEGAL for a, b in zip(initials.tolist(), initials[1:].tolist()))
    return (
        int(copies[faults == BLANK].sum()),
        int(copies[faults == REPEATED].sum()) + again,
        int((faults == CUT_OFF).sum()),
        pairs + int(copies.sum()) - len(codes) + seam,
    )


def _edits(codes: list[int], copies: list[int], letters: list[str], at: int, state: int) -> tuple[str, int, list[dict]]:
    """Audit and cost of a chunk, and what it leaves: rows kept or given a role, and rows inserted before them."""
    audit, cost, edits, said = [], 0, [], iter(letters)
    for i, (code, many) in enumerate(zip(codes, copies)):
        if code % 4 > CUT_OFF:
            audit.append("D" * many)
            cost += DELETE * many
            continue
        own = next(said)
        audit.append(own + "D" * (many - 1))
        cost += DELETE * (many - 1)
        for part, letter in enumerate(own):
            if letter == "D":
                cost += DELETE
                continue
            kept = letter != "I"
            role = None if letter == "K" else ROLE[state]
            cost += {"I": INSERT, "K": KEEP, "R": REROLE}[letter] + (TRUNCATED if kept and code % 4 == CUT_OFF else 0)
            edits.append({"place": at + i, "part": part, "role": role, "kept": kept})
            state = KEPT[state, code >> 2] if letter == "K" else NEXT[state]
    return "".join(audit), cost, edits


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's chunks in order: the state each starts in."""
    fresh, conv, state, done = True, None, EMPTY, None
    for batch in batches:
        ats, entries = [], []
        for of, at, entry, leaves in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "at", "entry", "exit"))):
            if fresh or of != conv:
                state, conv, fresh = EMPTY, of, False
            if entry == state and at != done:
                ats.append(at)
                entries.append(entry)
                state, done = leaves, at
        yield pa.RecordBatch.from_arrays([pa.array(ats, pa.int64()), pa.array(entries, pa.int32())], ["at", "entry"])


def _by_conversation(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows of a conversation side by side, in order."""
    return rows.repartition(F.xxhash64("conv_id")).sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order)


def solved(places: DataFrame) -> DataFrame:
    """The cheapest edits, a row for each chunk: conv_id, at, audit, cost, the four counts and ``edits``."""
    kind = places.schema["conv_id"].dataType.simpleString()
    parts = cut(chunks(places))
    maps = parts.select("conv_id", "at", "codes").mapInArrow(_maps, f"conv_id {kind}, at bigint, map binary, first int, last int")
    chained = _by_conversation(maps, F.col("at").desc()).mapInArrow(_chained, "at bigint, behind int, closes boolean, opens boolean, seam bigint")
    arrow = pa.null() if kind == "void" else _arrow_type(places)
    spread = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # tracing costs time, not bytes
    # by a hash of the key: by the key itself the join's own partitions would do, which are few, as the rows are short
    traced = cut(parts.join(chained, "at").repartition(spread, F.xxhash64("at")).mapInArrow(_traced(arrow), f"conv_id {kind}, {_TRACED}"))
    steps = traced.select("conv_id", "at", "entry", "exit")
    entered = _by_conversation(steps, F.col("at"), F.col("entry")).mapInArrow(_entered, "at bigint, entry int")
    return cut(traced.join(entered, ["at", "entry"]))


def _arrow_type(places: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(places.schema["conv_id"].dataType)


# --- results -------------------------------------------------------------------------------


def repaired(rows: DataFrame, places: DataFrame, solution: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, part, role, text; (place, part) orders a conversation's rows.

    Of rows equal in conversation, turn, role and text, at most one is left.
    """
    edits = solution.select("conv_id", F.explode("edits").alias("edit")).select("conv_id", "edit.*")
    added = edits.where(~F.col("kept")).select("conv_id", "place", "part", "role", F.lit("").alias("text"))
    left = edits.where("kept").select("place", "part", F.col("role").alias("given"))
    wanted = left.join(places.select("place", F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("said").alias("s")), "place")
    texts = rows.dropDuplicates(["conv_id", "turn", "said"])
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("said") == F.col("s"))
    found = texts.join(wanted, same).select("conv_id", "place", "part", F.coalesce("given", "role").alias("role"), "text")
    return found.unionByName(added)


def _digested(conv_type: pa.DataType):
    schema = pa.schema([("conv_id", conv_type), ("repaired_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """SHA-256 of each conversation's ``role:text`` lines; a conversation may go over any number of batches."""
        conv, running = None, None
        for batch in batches:
            out = []
            for of, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if running is not None and of == conv:
                    running.update(b"\n")
                else:
                    if running is not None:
                        out.append({"conv_id": conv, "repaired_sha256": running.hexdigest()})
                    conv, running = of, hashlib.sha256()
                running.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_pylist(out, schema)
        if running is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": running.hexdigest()}], schema)

    return digest


def audited(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """One row for each conversation of ``asked`` (column conv_id): conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit and the SHA-256 of the repaired text.

    ``rows``: conv_id, turn, role, text; other columns are ignored, whatever their names. Rows stand by turn, nulls first,
    then by role and by digest of role and text. A null role or text is one space; a null conv_id names a conversation of
    its own; an empty text is a blank row; texts may have any length. Rows that repeat turn and role with other texts stay
    apart, equal rows are repetitions. Initials other than s, u, a are illegal and never kept. A conversation without rows
    has zeros, an empty audit and the digest of nothing; empty tables give no rows.
    """
    rows = prepared(rows)
    places = cut(placed(rows))
    solution = solved(places)
    turns = places.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).cast("bigint").alias("gaps")
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    lines = _by_conversation(repaired(rows, places, solution), F.col("place"), F.col("part")).select("conv_id", "role", "text")
    digests = lines.mapInArrow(_digested(_arrow_type(places)), f"conv_id {kind}, repaired_sha256 string")
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    parts = (
        asked.select("conv_id").distinct().withColumn("asked", F.lit(True))
        .unionByName(turns, allowMissingColumns=True)
        .unionByName(digests, allowMissingColumns=True)
        .unionByName(solution.select("conv_id", "at", "audit", *counts), allowMissingColumns=True)
    )
    piece = F.when(F.col("at").isNotNull(), F.struct("at", "audit"))
    none = F.lit(0).cast("bigint")
    return (
        parts.groupBy("conv_id")
        .agg(
            F.max("asked").alias("asked"),
            F.coalesce(F.max("gaps"), none).alias("gaps"),
            *[F.coalesce(F.sum(c), none).alias(c) for c in counts],
            F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["audit"]), "").alias("audit"),
            F.coalesce(F.max("repaired_sha256"), F.lit(NO_TEXT)).alias("repaired_sha256"),
        )
        .where("asked")
        .drop("asked")
    )
