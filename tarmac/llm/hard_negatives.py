"""Hard negatives by vertical scans: one dimension after another, the heaviest of an anchor first.

A block of rows is held as columns. For an anchor its dimensions are read by descending magnitude; what the dimensions
still unread can add to a score lies between the sums of their smallest and largest contributions, known from the
block's least and greatest component of each. A row leaves the candidate bitmap as soon as these bounds show that it
cannot be among the anchor's positives, or in the first rows of any window below one of its positives. Where all
dimensions are read the scores are exact, and so are the results.

Scores are integers. They are summed as doubles where no sum in the block can pass 2^53, and as integers of any length
otherwise; a score that does not fit 64 bits fails the job.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.text import cut
from tarmac.llm.vectors import best, blocked, finite, matrix, met, numbers, others, ranked

POSITIVES = NEGATIVES = 5
#: A negative's score is between so many hundredths of the positive's and all of it.
LEAST, MOST = 80, 100
#: Dimensions read between two looks at the bounds.
STEP = 4
SCALE = 256


class Columns:
    """Some rows of a block, one array a dimension, and the least and greatest component of each."""

    def __init__(self, values: np.ndarray, ids: np.ndarray) -> None:
        self.values, self.ids = values, ids
        self.least, self.most = (values.min(axis=1), values.max(axis=1)) if values.shape[1] else (values[:, :0], values[:, :0])


def integers(table: pa.Table) -> np.ndarray:
    """Components times 256, rounded down."""
    return np.floor(SCALE * matrix(table["vector"]))


def _exact(values: np.ndarray, anchors: np.ndarray) -> bool:
    """Whether doubles hold every sum of products."""
    most = (np.abs(values).max(axis=0, initial=0) * np.abs(anchors).max(axis=0, initial=0)).sum()
    return bool(most < 2.0**53)


def _whole(values: np.ndarray) -> np.ndarray:
    out = np.empty(values.shape, object)
    out.ravel()[:] = [int(v) for v in values.ravel()]
    return out


def scan(columns: Columns, anchor: np.ndarray, alive: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """Rows left of ``alive`` and their scores. ``keep(lower, upper)`` tells from the bounds of the scores which rows stay."""
    order = np.argsort(-np.abs(anchor.astype(np.float64)), kind="stable")
    ends = np.stack([anchor * columns.least, anchor * columns.most])[:, order]
    # what the dimensions from each place on add at least and at most
    low, high = (np.append(np.cumsum(side[::-1])[::-1], 0) for side in (ends.min(axis=0), ends.max(axis=0)))
    partial = np.zeros(len(alive), anchor.dtype)
    for start in range(0, len(order), STEP):
        read = order[start : start + STEP]
        partial = partial + anchor[read] @ columns.values[read][:, alive]
        done = min(start + STEP, len(order))
        stays = keep(partial + low[done], partial + high[done])
        if not stays.all():
            alive, partial = alive[stays], partial[stays]
        if not len(alive):
            break
    return alive, partial


def largest(many: int):
    """Keeps rows that may be among the ``many`` largest scores, ties included."""

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        if len(lower) <= many:
            return np.ones(len(lower), bool)
        return upper >= np.sort(lower)[-many] if lower.dtype == object else upper >= np.partition(lower, -many)[-many]

    return keep


def first_below(tops: list[int], many: int):
    """Keeps rows that may be among the ``many`` largest scores of a window, from ``LEAST`` hundredths of a top up to it."""
    floors = [-(-LEAST * top // MOST) for top in tops]

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        stays = np.zeros(len(lower), bool)
        for w, top in enumerate(tops):
            inside = (upper >= floors[w]) & (lower <= top)
            sure = lower[(lower >= floors[w]) & (upper <= top)]
            if len(sure) >= many:  # so many rows are in the window with at least this score
                floors[w] = np.sort(sure)[-many]
                inside &= upper >= floors[w]
            stays |= inside
        return stays

    return keep


def _tables(rows: pa.Table, anchors: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    values, asked = integers(rows), integers(anchors)
    width = max(values.shape[1], asked.shape[1])
    values, asked = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (values, asked))
    return (values, asked) if _exact(values, asked) else (_whole(values), _whole(asked))


_POSITIVE = "anchor bigint, anchor_id bigint, positive_id bigint, positive_score bigint, own boolean"
_NEGATIVE = "anchor bigint, positive_score bigint, negative_id bigint, negative_score bigint"


def _positives(many: int):
    names = ["anchor", "anchor_id", "positive_id", "positive_score", "own"]
    schema = pa.schema(list(zip(names, [pa.int64()] * 4 + [pa.bool_()])))

    def search(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return schema.empty_table()
        values, asked = _tables(rows, anchors)
        labels, ids, given = numbers(rows["label"]), numbers(rows["vec_id"]), rows["vec_id"].to_pylist()
        out: list[tuple] = []
        by_label: dict[int, tuple[Columns, np.ndarray]] = {}
        for row, asking, label, vector in zip(anchors["row"].to_pylist(), anchors["vec_id"].to_pylist(), numbers(anchors["label"]).tolist(), asked):
            if label not in by_label:
                places = np.flatnonzero(labels == label)
                by_label[label] = Columns(np.ascontiguousarray(values[places].T), ids[places]), places
            columns, places = by_label[label]
            left, scores = scan(columns, vector, np.arange(len(places)), largest(many + 1)) if len(places) else (places, places)
            for place in best(scores, columns.ids[left], many + 1).tolist():
                at = places[left[place]]
                out.append((row, asking, given[at], int(scores[place]), given[at] == asking and bool((values[at] == vector).all())))
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema) if out else schema.empty_table()

    return search


def _negatives(many: int):
    schema = pa.schema([(n, pa.int64()) for n in ("anchor", "positive_score", "negative_id", "negative_score")])

    def search(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        """For each anchor and each score of a positive (column ``tops``) the first rows of its window in this block."""
        if not rows.num_rows or not anchors.num_rows:
            return schema.empty_table()
        values, asked = _tables(rows, anchors)
        labels, ids, given = numbers(rows["label"]), numbers(rows["vec_id"]), rows["vec_id"].to_pylist()
        columns = Columns(np.ascontiguousarray(values.T), ids)
        out: list[tuple] = []
        for row, label, tops, vector in zip(anchors["row"].to_pylist(), numbers(anchors["label"]).tolist(), anchors["tops"].to_pylist(), asked):
            alive, scores = scan(columns, vector, np.flatnonzero(labels != label), first_below(tops, many))
            for top in tops:
                inside = np.flatnonzero((LEAST * top <= MOST * scores) & (scores <= top))
                for place in best(scores[inside], ids[alive[inside]], many).tolist():
                    out.append((row, top, given[alive[inside[place]]], int(scores[inside[place]])))
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema) if out else schema.empty_table()

    return search


def mined(rows: DataFrame, asked: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """Hard negatives of each anchor and positive: anchor_id, positive_id, rank from 1, negative_id and both scores.

    ``rows`` and ``asked`` have vec_id, label and embedding; other columns are ignored, whatever their names. ``asked`` are
    rows of ``rows`` with an id; an anchor is not its own positive, but another row with its id may be. Rows with a null label
    or vector, or a component that is null or not finite, take no part; an empty vector scores 0. A shorter vector counts as
    followed by zeros. A missing id comes last among ties. Positives without a row in their window, and those whose score
    is below 0, give no rows; empty tables give none.
    """
    chosen = [
        t.select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.col("label").cast("bigint").alias("label"),
            F.col("embedding").cast("array<double>").alias("vector"),
        ).where(F.col("label").isNotNull() & finite("vector"))
        for t in (rows, asked)
    ]
    (table, blocks), (anchors, parts) = map(blocked, chosen)
    near = others(met(table, blocks, anchors, parts, _positives(positives), _POSITIVE), ["anchor"], "positive_score", "positive_id")
    chosen_positives = cut(ranked(near, ["anchor"], "positive_score", "positive_id").where(F.col("rank") <= positives).withColumnRenamed("rank", "turn"))
    tops = chosen_positives.where("positive_score >= 0").groupBy("anchor").agg(F.collect_set("positive_score").alias("tops"))
    windows = cut(anchors.join(tops.withColumnRenamed("anchor", "row"), "row"))
    found = met(table, blocks, windows, parts, _negatives(negatives), _NEGATIVE)
    kept = ranked(found, ["anchor", "positive_score"], "negative_score", "negative_id").where(F.col("rank") <= negatives)
    return chosen_positives.join(kept, ["anchor", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def relabelled(embeddings: DataFrame) -> DataFrame:
    """Rows whose id is divisible by 7 with the next of ten labels."""
    given = F.col("label").cast("bigint")
    label = F.when(F.col("vec_id") % 7 == 0, (given + 1) % 10).otherwise(given)
    return embeddings.select("vec_id", label.alias("label"), "embedding")


SQL = """
WITH v AS (SELECT vec_id, row_number() OVER () AS n, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.n AS anchor, b.vec_id, b.n, a.label = b.label AS same,
  CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.n <> b.n WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS turn FROM s WHERE same),
r AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor, p.turn ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score WHERE p.turn <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 5
"""
