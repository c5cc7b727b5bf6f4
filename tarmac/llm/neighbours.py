"""Nearest neighbours by cosine with a forest of hash-prefix trees.

A tree is a sorted array of 64-bit strings, the signs of a vector's products with 64 random planes. A query descends in
every tree to its longest matching prefixes, then all trees are ascended together, one bit at a time, until enough rows
share a prefix with it in some tree. Two vectors at angle a agree in a bit with probability p = 1 - a / pi, so a row at
that angle shares no prefix of x bits in any of T trees with probability (1 - p^x)^T.

Every block of rows has its forest; all blocks use the same planes. First, all queries descend in all blocks. Their
best scores over all blocks bound the angle of their k-th neighbour, and the second search ascends to the highest level
at which a row at that angle is missed with probability ``MISS`` at most (some trees a level higher than others, to keep
close to it). The level follows from the scores alone: nothing caps the candidates, and a query of scattered data reads
large parts of the blocks where one of clustered data reads little. Candidates are scored on the vectors themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.text import cut
from tarmac.llm.vectors import best, blocked, finite, matrix, met, numbers, others, ranked

TREES, BITS, SEED = 64, 64, 11
#: Probability that a true neighbour stays unseen.
MISS = 0.02
#: Entries, over all trees, that the first search gathers for each query and block.
FIRST = 3 * TREES

_FOUND = "query bigint, query_id bigint, vec_id bigint, score double, own boolean"


def unit_free(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two that brings its largest component near 1; cosines stay the same to the bit."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    return np.ldexp(vectors, -exponent[:, None])


def cosines(vectors: np.ndarray, norms: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
    """In double precision, each row on its own, so that equal vectors score alike wherever they stand."""
    return (vectors * query).sum(axis=1) / (norms * norm)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def hashes(units: np.ndarray) -> np.ndarray:
    """(trees, rows): the first plane gives the highest bit."""
    out = np.empty((TREES, len(units)), np.uint64)
    for tree in range(TREES):
        planes = np.random.default_rng([SEED, tree]).standard_normal((BITS, units.shape[1])) if units.shape[1] else np.zeros((BITS, 0))
        out[tree] = np.packbits(units @ planes.T > 0, axis=1).view(">u8").ravel()
    return out


def _bit_length(x: np.ndarray) -> np.ndarray:
    high, low = (x >> np.uint64(32)).astype(np.float64), (x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1])


class Forest:
    def __init__(self, units: np.ndarray) -> None:
        strings = hashes(units)
        self.order = np.argsort(strings, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(strings, self.order, axis=1)
        self.rows = len(units)

    def spans(self, strings: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of each tree whose first ``levels`` bits are the query's; both arguments are (trees, queries)."""
        rest = np.uint64(BITS) - levels.astype(np.uint64)
        free = np.where(rest == BITS, np.uint64(2**64 - 1), (np.uint64(1) << (rest % np.uint64(BITS))) - np.uint64(1))
        first, last = strings & ~free, strings | free
        low = np.stack([np.searchsorted(s, f, "left") for s, f in zip(self.sorted, first)])
        return low, np.stack([np.searchsorted(s, f, "right") for s, f in zip(self.sorted, last)])

    def longest(self, strings: np.ndarray) -> np.ndarray:
        """Longest prefix each query shares with a row of some tree, found beside its place in the sorted arrays."""
        top = np.zeros(strings.shape[1], np.int64)
        for tree, asked in zip(self.sorted, strings):
            place = np.searchsorted(tree, asked)
            for side in (np.maximum(place - 1, 0), np.minimum(place, self.rows - 1)):
                top = np.maximum(top, BITS - _bit_length(tree[side] ^ asked))
        return top

    def first_level(self, strings: np.ndarray) -> np.ndarray:
        """Highest level at which the trees hold ``FIRST`` entries for a query; 0 if there are not so many."""
        level = self.longest(strings)
        active = np.arange(strings.shape[1])
        while len(active):
            low, high = self.spans(strings[:, active], np.broadcast_to(level[active], (TREES, len(active))))
            active = active[((high - low).sum(axis=0) < FIRST) & (level[active] > 0)]
            level[active] -= 1
        return level

    def candidates(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Rows in any of a query's ranges, one for each tree."""
        seen = np.zeros(self.rows, bool)
        for order, a, b in zip(self.order, low.tolist(), high.tolist()):
            seen[order[a:b]] = True
        return np.flatnonzero(seen)


def levels(scores: np.ndarray) -> np.ndarray:
    """(trees, queries): prefix lengths at which a row as near as the score is missed with probability ``MISS`` at most."""
    agree = 1 - np.arccos(np.clip(scores, -1, 1)) / np.pi
    with np.errstate(divide="ignore"):
        unseen = np.log1p(-(agree ** np.arange(BITS + 2)[:, None]))  # of one tree, by length; -inf at length 0
    enough = TREES * unseen[: BITS + 1] <= np.log(MISS)
    whole = BITS - np.argmax(enough[::-1], axis=0)  # the longest at which all trees together do
    column = np.arange(len(scores))
    shorter, longer = unseen[whole, column], unseen[np.minimum(whole + 1, BITS), column]
    with np.errstate(invalid="ignore", divide="ignore"):
        need = np.ceil((np.log(MISS) - TREES * longer) / (shorter - longer))
    need = np.where(np.isfinite(need) & (whole < BITS), need, np.where(whole < BITS, 1, TREES)).clip(1, TREES)
    return np.where(np.arange(TREES)[:, None] < need, whole, np.minimum(whole + 1, BITS))


def _search(k: int):
    schema = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("own", pa.bool_())])

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        """The best k + 1 rows of a block for each query, the asking row among them. ``reach``: the score that the k-th
        neighbour has at least; null where fewer than k are known, NaN in the first search."""
        if not rows.num_rows or not queries.num_rows:
            return schema.empty_table()
        vectors, asked = matrix(rows["vector"]), matrix(queries["vector"])
        width = max(vectors.shape[1], asked.shape[1])
        vectors, asked = (unit_free(np.pad(m, ((0, 0), (0, width - m.shape[1])))) for m in (vectors, asked))
        lengths, asked_lengths = _lengths(vectors), _lengths(asked)
        units, asked_units = vectors / lengths[:, None], asked / asked_lengths[:, None]
        forest, strings = Forest(units), hashes(asked_units)
        wanted = np.broadcast_to(forest.first_level(strings), strings.shape)
        reach = queries["reach"].combine_chunks()
        known = reach.fill_null(-1).to_numpy(zero_copy_only=False)
        second = ~np.isnan(known)
        if second.any():
            allowed = np.where(reach.is_null().to_numpy(zero_copy_only=False), 0, levels(np.where(second, known, 1)))
            wanted = np.where(second, np.minimum(wanted, allowed), wanted)
        low, high = forest.spans(strings, wanted)
        ids, query_ids = numbers(rows["vec_id"]), queries["query_id"].to_pylist()
        found, scored, own = [], [], []
        for i, asking in enumerate(query_ids):
            near = forest.candidates(low[:, i], high[:, i])
            rough = units[near] @ asked_units[i]
            if len(near) > k + 1:
                near = near[rough >= np.partition(rough, -k - 1)[-k - 1] - 1e-9]
            exact = cosines(vectors[near], lengths[near], asked[i], asked_lengths[i])
            top = best(exact, ids[near], k + 1)
            found.append(near[top])
            scored.append(exact[top])
            own.append((ids[near[top]] == asking) & (vectors[near[top]] == asked[i]).all(axis=1))
        sizes = [len(f) for f in found]
        return pa.table(
            [
                pa.array(np.repeat(queries["row"].to_numpy(), sizes)),
                pa.array(np.repeat(np.array(query_ids, np.int64), sizes)),
                rows["vec_id"].combine_chunks().take(pa.array(np.concatenate(found))),
                pa.array(np.concatenate(scored)),
                pa.array(np.concatenate(own)),
            ],
            schema=schema,
        )

    return search


def nearest(rows: DataFrame, asked: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` nearest found of ``rows`` for each row of ``asked``: query_id, rank from 1, vec_id, score (the cosine).

    Both have vec_id and embedding; other columns are ignored, whatever their names. ``asked`` are rows of ``rows`` with
    an id, and a row never finds itself; of rows that repeat an id, each asks and is found on its own. Vectors that are
    null, empty or zero, or hold a null or a number that is not finite, take no part. A shorter vector counts as followed
    by zeros. Ties go to the smaller id, a missing id last. With fewer than ``k`` others all are returned; empty tables
    give no rows.
    """
    chosen = [
        t.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
        .where(finite("vector"))
        .where(F.exists("vector", lambda x: x != 0))
        for t in (rows, asked)
    ]
    (table, blocks), (queries, parts) = map(blocked, chosen)
    queries = queries.withColumnRenamed("vec_id", "query_id")
    first = met(table, blocks, queries.withColumn("reach", F.lit(float("nan"))), parts, _search(k), _FOUND)
    known = ranked(others(first, ["query"], "score", "vec_id"), ["query"], "score", "vec_id").where(F.col("rank") == k)
    bounded = cut(queries.join(known.select(F.col("query").alias("row"), F.col("score").alias("reach")), "row", "left"))
    found = met(table, blocks, bounded, parts, _search(k), _FOUND)
    kept = ranked(others(found, ["query"], "score", "vec_id"), ["query"], "score", "vec_id").where(F.col("rank") <= k)
    return kept.select("query_id", "rank", "vec_id", "score")
