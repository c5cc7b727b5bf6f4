"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of its words, hashed; a document's is the
noisy-or of its sentences' scores: toxic unless every sentence is clean. Labels exist for documents alone, and the
gradient of the noisy-or hands each one's label to the sentences that explain it. The same sentence scores then locate
the offending sentences.

The model is fitted on a bounded sample of the labelled documents (``SAMPLE`` of each label, those with the smallest id
hashes, whole texts; classes weighted back to their shares among all labels). Scoring covers every document, in one pass
without a shuffle; the weights are a fixed ``DIMENSIONS`` numbers.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.text import bucket, whole

FOLDS = 5
#: Labelled documents of each label to learn from.
SAMPLE = 2_000
DIMENSIONS = 1 << 20
EPOCHS, STEP, SPARSITY, SURPRISE = 150, 0.15, 3e-4, 2.0
#: Code points of a word's beginnings.
BEGINNINGS = (4, 5)

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
#: Words whose weight a worker remembers.
REMEMBERED = 200_000


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def _slots(word: str) -> list[int]:
    """A word counts as itself and as its beginnings, which inflected forms share."""
    parts = {word, *(f"{word[:n]}-" for n in BEGINNINGS if len(word) > n)}
    return [zlib.crc32(part.encode()) % DIMENSIONS for part in sorted(parts)]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the distinct words of each sentence that has a word, end to end, and how many each sentence has."""
    bags = (set(WORD.findall(s.lower())) for s in SENTENCE.findall(text))
    of = [[slot for word in sorted(bag) for slot in _slots(word)] for bag in bags if bag]
    return np.array([slot for bag in of for slot in bag], np.int32), np.array([len(bag) for bag in of], np.int32)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, shares: np.ndarray) -> Model:
    """Weights from the ``features`` of documents; ``shares`` weigh the documents. Full batches, so it is repeatable."""
    lengths = np.concatenate([np.zeros(0, np.int32), *(n for _, n in bags)])
    if not len(lengths):
        return Model(np.zeros(DIMENSIONS), -6.0)
    sentences = lengths
    of_doc = np.repeat(np.arange(len(bags)), [len(n) for _, n in bags])
    slots = np.concatenate([slots for slots, _ in bags])
    of_sentence = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    pairs = np.unique(of_doc[of_sentence].astype(np.int64) * DIMENSIONS + slots)  # document and slot
    met = np.bincount(pairs % DIMENSIONS, minlength=DIMENSIONS)
    in_toxic = np.bincount(pairs % DIMENSIONS, toxic[pairs // DIMENSIONS], DIMENSIONS)
    chance = met * toxic.mean()  # documents only hint at a word that is in more or fewer toxic ones than by chance
    used = (np.abs(in_toxic - chance) > SURPRISE * np.sqrt(chance + 1))[slots]
    kept, column = np.unique(slots[used], return_inverse=True)
    row = of_sentence[used]
    w, b = np.zeros(len(kept)), -4.0
    moment, square = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    shares = shares / shares.sum()
    for epoch in range(1, EPOCHS + 1):
        p = 1 / (1 + np.exp(-(b + np.bincount(row, w[column], len(sentences)))))
        clean = np.bincount(of_doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(bags))  # log of "no sentence is toxic"
        either = np.maximum(-np.expm1(clean), 1e-12)
        pull = np.where(toxic, -np.exp(clean) / either, 1.0) * shares
        slope = pull[of_doc] * p
        gradient = np.append(np.bincount(column, slope[row], len(kept)), slope.sum())
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        move = STEP * (moment / (1 - 0.9**epoch)) / (np.sqrt(square / (1 - 0.999**epoch)) + 1e-8)
        still = np.abs(gradient[:-1]) < SPARSITY * (w == 0)  # too weak a reason to leave zero
        w = np.where(still, 0.0, w - move[:-1])
        w = np.sign(w) * np.maximum(np.abs(w) - SPARSITY * STEP, 0)
        b -= float(move[-1])
    weights = np.zeros(DIMENSIONS)
    weights[kept] = w
    return Model(weights, b)


class _Weights(dict):
    """Weights by word, computed when first asked for."""

    def __init__(self, weights: np.ndarray) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = float(self.weights[_slots(word)].sum())
        if len(self) < REMEMBERED:
            self[word] = value
        return value


def scored(text: str, weights: _Weights, bias: float) -> tuple[float, list[dict]]:
    """Score of a text, and its sentences that are likelier toxic than not, by code points. No word: 0."""
    clean, offending = 0.0, []
    for match in SENTENCE.finditer(text):
        bag = set(WORD.findall(match.group().lower()))
        if bag:
            z = min(max(bias + sum(map(weights.__getitem__, bag)), -30.0), 30.0)
            odds = np.exp(z)
            clean -= np.log1p(odds)
            if z >= 0:
                offending.append({"start": match.start(), "end": match.end(), "score": float(odds / (1 + odds))})
    return float(-np.expm1(clean)), offending


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of the labelled documents outside the held-out fold. Rows without a label teach nothing."""
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .where(bucket("doc_id", FOLDS) != 0)
    )
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    chosen = []
    for value in sorted(totals):
        chosen += known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [[part.tobytes() for part in features(t.as_py())] for t in batch.column(2)]
            columns = [batch.column(0), batch.column(1), *(pa.array([b[i] for b in bags], pa.binary()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "slots", "lengths"])

    if not chosen:
        return fit([], np.zeros(0, bool), np.zeros(0))
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], int(r["toxic"])) for r in chosen], "__id bigint, toxic int")
    found = docs.select("doc_id", whole("text").alias("text")).join(F.broadcast(ids), F.col("doc_id") == F.col("__id"))
    table = found.select("doc_id", "toxic", "text").mapInArrow(run, "doc_id bigint, toxic int, slots binary, lengths binary").toArrow()
    table = table.sort_by([("doc_id", "ascending"), ("toxic", "ascending"), ("slots", "ascending")])
    toxic = table.column("toxic").to_numpy()
    both = zip(table.column("slots"), table.column("lengths"))
    bags = [tuple(np.frombuffer(part.as_buffer(), np.int32) for part in pair) for pair in both]
    weight = {v: totals[v] / max(1, int((toxic == v).sum())) for v in totals}
    return fit(bags, toxic == 1, np.array([weight[v] for v in toxic.tolist()], float))


RESULT = "doc_id bigint, score double, offending array<struct<start: int, end: int, score: double>>"


def assessed(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted and the offending sentences.

    Null text counts as empty and scores 0. Repeated rows are scored one by one; other columns are never read, whatever
    their names; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    offences = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        known = _Weights(weights)
        for batch in batches:
            found = [scored(t.as_py(), known, bias) for t in batch.column(1)]
            columns = [batch.column(0), pa.array([s for s, _ in found], pa.float64()), pa.array([o for _, o in found], offences)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "offending"])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole("text").alias("text"))
    return chosen.mapInArrow(run, RESULT).select(
        "doc_id",
        F.coalesce(bucket("doc_id", FOLDS) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "offending",
    )
