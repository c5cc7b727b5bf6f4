"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised to 1 + floor(log2(count)), and the filter holds a pair of n-gram and level for
every level up to its own. A count is read back by asking for level 1, 2, ... until one is missing. Pairs are hashed and
summed in segments whose number follows the corpus; each segment becomes a part of the filter. All probes of two levels lie
in one 64-bit word, so reading a count takes a memory access or two.

The filter is one file in the shared folder that every worker maps or reads, never larger than ``FILTER_BYTES``, and the
corpus is scored in one pass. A part has ``BITS`` bits to an entry where its share of the file allows that. Beyond, its
entries get fewer, and once they would get less than ``LEAST_BITS``, counts are quantised by powers of 4, 8, ... instead of
2, which takes fewer entries. So a filter of any corpus is held, and what grows with a corpus too large for it is the error:
an unknown n-gram is taken for a known one in 5 % of cases at 7 bits to an entry, 11 % at 5 and 28 % at 3 (measured).

The probability of a word after another is its pair count smoothed by the word's own probability, itself an add-one
estimate: (min(c(ab), c(a)) + WEIGHT * p(b)) / (c(a) + WEIGHT).

The base score needs exact counts. The most frequent words, a bounded number, are broadcast; all other words of a document
are joined with the counts, and no such word is frequent enough to be a hot key.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log10
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.text import bucket, cut, whole
from tarmac.session import scratch_path

FOLDS, HELD_OUT = 7, 2
#: The end of a document; no word holds white space.
END = b"\n"
#: Words with broadcast counts at most; distinct words a task counts, and pairs it gathers, before it passes them on.
HEAD, FLUSH_WORDS, FLUSH_PAIRS = 50_000, 300_000, 3_000_000
#: Word pairs of the corpus to a segment; filter bits to an entry, wanted and at least; and levels that share a word.
SEGMENT_PAIRS, BITS, LEAST_BITS, SHARED = 2_000_000, 7, 3, 2
#: Bytes of the filter file, and the words' share of them.
FILTER_BYTES, WORD_SHARE = 512 << 20, 0.25
#: Bytes of a pair's hash that tasks pass on beside its segment; two of a segment's pairs share them once in a million.
LOW_BYTES = 5
MOST_CUT_BITS = 64 - 8 * LOW_BYTES
WEIGHT = 20.0
#: Words a scoring worker remembers, and tokens it scores at once.
REMEMBERED, AT_ONCE = 300_000, 500_000

_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_ALL = (1 << 64) - 1


def tokens(text: str) -> list[bytes]:
    return [*text.encode().lower().split(), END]  # bytes: A-Z only, and just the six white-space characters


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 7)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def pair_hash(first: np.ndarray, second: np.ndarray, cut_bits: int) -> np.ndarray:
    """The segment in the top bits, and the low bytes; tasks pass on the latter alone."""
    kept = ((1 << cut_bits) - 1) << (64 - cut_bits) | ((1 << 8 * LOW_BYTES) - 1)
    return _mixed(first * _STEP + second) & np.uint64(kept)


def level(counts: np.ndarray, step: int = 1) -> np.ndarray:
    """1 + floor(log2(count) / step)."""
    return (np.frexp(counts.astype(np.float64))[1].astype(np.int64) - 1) // step + 1


def count_at(levels: np.ndarray, step: np.ndarray | int = 1) -> np.ndarray:
    """Middle of the counts with this level; 0 for level 0."""
    least, top = (np.exp2(step * n.astype(np.float64)) for n in (levels - 1, levels))
    return np.where(levels > 0, (least + top - 1) / 2, 0.0)


def _start(hashes: np.ndarray) -> np.ndarray:
    return _mixed(hashes ^ _MIX1)


def _word_at(mixed: np.ndarray, at: int, size: np.ndarray | np.uint64) -> np.ndarray:
    """Place, among ``size``, of the word that holds a level; the same for ``SHARED`` levels."""
    own = _mixed(mixed + np.uint64((at - 1) // SHARED * int(_STEP) & _ALL))
    return (own >> np.uint64(32)) * size >> np.uint64(32)


def _probes(mixed: np.ndarray, at: int, probes: np.ndarray | int) -> np.ndarray:
    """The bits a level has in its word."""
    turned = mixed * np.uint64((2 * at + 1) * int(_STEP) & _ALL | 1)
    bits = np.zeros(len(mixed), np.uint64)
    for i in range(int(np.max(probes, initial=0))):
        bit = np.uint64(1) << (turned >> np.uint64(58 - 6 * i) & np.uint64(63))
        bits |= bit if np.ndim(probes) == 0 else np.where(probes > i, bit, np.uint64(0))
    return bits


class Part(NamedTuple):
    """Words of one segment of a filter, probes to an entry, and the step of its levels."""

    words: np.ndarray
    probes: int
    step: int


NO_PART = Part(np.zeros(1, np.uint64), 1, 1)


def filter_part(hashes: np.ndarray, counts: np.ndarray, room: float = float("inf"), wanted: float = BITS) -> Part:
    """One segment from distinct hashes and their counts, in at most ``room`` bits, or one word."""
    step, levels = 1, level(counts)
    while (entries := int(levels.sum())) * LEAST_BITS > room and levels.max(initial=0) > 1:
        step += 1
        levels = level(counts, step)
    bits = min(wanted, room / max(entries, 1))
    probes = min(3, max(1, round(0.45 * bits)))
    size = np.uint64(max(1, int(entries * bits / 64)))
    words = np.zeros(int(size), np.uint64)
    mixed = _start(hashes)
    for at in range(1, int(levels.max(initial=0)) + 1):
        left = mixed[levels >= at]
        np.bitwise_or.at(words, _word_at(left, at, size).astype(np.int64), _probes(left, at, probes))
    return Part(words, probes, step)


class LogFilter:
    """A filter cut into 2 ** ``cut_bits`` segments by the top bits of the hash."""

    def __init__(self, parts: list[Part], cut_bits: int) -> None:
        sizes = np.array([len(p.words) for p in parts], np.int64)
        starts = np.cumsum(sizes) - sizes
        self._set(cut_bits, np.stack([starts, sizes, [p.probes for p in parts], [p.step for p in parts]]), np.concatenate([p.words for p in parts]))

    def _set(self, cut_bits: int, directory: np.ndarray, words: np.ndarray) -> None:
        self.cut_bits, self.words = cut_bits, words
        self.starts, self.sizes, self.probes, self.steps = directory
        self.sizes = self.sizes.astype(np.uint64)
        self.alike = int(self.probes[0]) if (self.probes == self.probes[0]).all() else None

    @classmethod
    def of(cls, cut_bits: int, directory: np.ndarray, words: np.ndarray) -> LogFilter:
        """From arrays as the filter file has them."""
        found = cls.__new__(cls)
        found._set(cut_bits, directory, words)
        return found

    def segments(self, hashes: np.ndarray) -> np.ndarray:
        return np.zeros(len(hashes), np.int64) if not self.cut_bits else (hashes >> np.uint64(64 - self.cut_bits)).astype(np.int64)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        found, left, part = np.zeros(len(hashes), np.int64), np.arange(len(hashes)), self.segments(hashes)
        mixed, word = _start(hashes), np.zeros(0, np.uint64)
        for at in range(1, 65):
            if (at - 1) % SHARED == 0:
                word = self.words[self.starts[part] + _word_at(mixed, at, self.sizes[part]).astype(np.int64)]
            bits = _probes(mixed, at, self.probes[part] if self.alike is None else self.alike)
            met = word & bits == bits
            left, part, mixed, word = left[met], part[met], mixed[met], word[met]
            if not len(left):
                break
            found[left] = at
        return found

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """The count each hash is taken to have."""
        return count_at(self.levels(hashes), self.steps[self.segments(hashes)])


# --- the filter file -----------------------------------------------------------------------
# Unsigned 64-bit little-endian: number of segments, then for words and for pairs the directory (starts, sizes, probes and
# steps, each by segment), then the words of all parts, starts counting from there.


def _filter_writer(folder: str, segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One task writes the file, whose size has a bound."""
        parts: dict[tuple[int, int], Part] = {}
        for batch in batches:
            for kind, segment, words, probes, step in zip(*(c.to_pylist() for c in batch.columns)):
                parts[kind, segment] = Part(np.frombuffer(words, "<u8"), probes, step)
        if not parts:
            return
        directory, data, at = np.zeros((2, 4, segments), "<u8"), [], 0
        for kind in range(2):
            for segment in range(segments):
                part = parts.get((kind, segment), NO_PART)
                directory[kind, :, segment] = at, len(part.words), part.probes, part.step
                data.append(part.words)
                at += len(part.words)
        system, place = fs.FileSystem.from_uri(folder)
        system.create_dir(place, recursive=True)
        own = f"{place}/{TaskContext.get().taskAttemptId()}"
        with system.open_output_stream(own) as out:
            for piece in (np.array([segments], "<u8"), directory, *data):
                out.write(piece.astype("<u8", copy=False).tobytes())
        system.move(own, f"{place}/filter")
        yield pa.RecordBatch.from_arrays([pa.array([at])], ["words"])

    return run


def _filters(folder: str | None, cut_bits: int) -> list[LogFilter]:
    """The filters of words and of pairs; the file is mapped where the shared folder is a file system, else read."""
    if folder is None:
        return [LogFilter([NO_PART], 0) for _ in range(2)]
    system, place = fs.FileSystem.from_uri(folder)
    if isinstance(system, fs.LocalFileSystem):
        held = np.memmap(f"{place}/filter", "<u8", "r")
    else:
        with system.open_input_file(f"{place}/filter") as file:
            held = np.frombuffer(file.read(), "<u8")
    segments = int(held[0])
    directory = np.array(held[1 : 1 + 8 * segments]).reshape(2, 4, segments).astype(np.int64)
    return [LogFilter.of(cut_bits, directory[kind], held[1 + 8 * segments :]) for kind in range(2)]


class Corpus(NamedTuple):
    """What the learning rows hold: exact word counts, totals, and the folder of the filter file."""

    counts: DataFrame  # word binary, n bigint
    n_tokens: int
    n_words: int
    folder: str | None
    cut_bits: int


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["word", "n"])

    found: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            found.update(tokens(text.as_py()))
            if len(found) > FLUSH_WORDS:
                yield out(found)
                found = Counter()
    if found:
        yield out(found)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = word_hash(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


def _low_bytes(hashes: np.ndarray) -> bytes:
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :LOW_BYTES]).tobytes()


def _from_low_bytes(packed: bytes) -> np.ndarray:
    low = np.frombuffer(packed, np.uint8).reshape(-1, LOW_BYTES)
    return np.concatenate([low, np.zeros((len(low), 8 - LOW_BYTES), np.uint8)], axis=1).view("<u8").ravel().astype(np.uint64)


def _pair_counts(cut_bits: int):
    """Pairs of a task, summed and sorted, as one row per segment: low bytes of the hashes, and counts."""

    def out(arrays: list[np.ndarray]) -> pa.RecordBatch:
        hashes, n = np.unique(np.concatenate(arrays), return_counts=True)
        segment = (hashes >> np.uint64(64 - cut_bits)).astype(np.int64) if cut_bits else np.zeros(len(hashes), np.int64)
        some, starts = np.unique(segment, return_index=True)
        ends = [*starts[1:], len(hashes)]
        packed = [_low_bytes(hashes[a:b]) for a, b in zip(starts, ends)]
        counts = [n[a:b].astype("<u4").tobytes() for a, b in zip(starts, ends)]
        columns = [pa.array(some), pa.array(packed, pa.binary()), pa.array(counts, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["segment", "hashes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, arrays, size = _Hashes(), [], 0
        for batch in batches:
            for text in batch.column(0):
                found = np.array([known[w] for w in (END, *tokens(text.as_py()))], np.uint64)
                arrays.append(pair_hash(found[:-1], found[1:], cut_bits))
                size += len(found) - 1
                if size > FLUSH_PAIRS:
                    yield out(arrays)
                    arrays, size = [], 0
        if arrays:
            yield out(arrays)

    return run


_PART = "kind int, segment bigint, words binary, probes int, step int"
WORDS, PAIRS = range(2)


def _part(kind: int, segment: int, hashes: np.ndarray, counts: np.ndarray, room: float, bits: float) -> pa.Table:
    part = filter_part(hashes, counts, room, bits)
    columns = [pa.array([kind], pa.int32()), pa.array([segment], pa.int64()), pa.array([part.words.tobytes()], pa.binary())]
    columns += [pa.array([n], pa.int32()) for n in (part.probes, part.step)]
    return pa.table(columns, ["kind", "segment", "words", "probes", "step"])


def _pair_filter(cut_bits: int, room: float, bits: float):
    def run(table: pa.Table) -> pa.Table:
        segment = table.column("segment")[0].as_py()
        low = np.concatenate([_from_low_bytes(v.as_py()) for v in table.column("hashes")])
        counts = np.concatenate([np.frombuffer(v.as_py(), "<u4") for v in table.column("counts")])
        low, where = np.unique(low, return_inverse=True)
        top = np.uint64(segment << (64 - cut_bits) if cut_bits else 0)
        return _part(PAIRS, segment, low | top, np.bincount(where, counts, len(low)), room, bits)

    return run


def _word_filter(room: float, bits: float):
    def run(table: pa.Table) -> pa.Table:
        hashes = np.array([word_hash(w) for w in table.column("word").to_pylist()], np.uint64)
        return _part(WORDS, table.column("segment")[0].as_py(), hashes, table.column("n").to_numpy(), room, bits)

    return run


def _words_segment(words: pa.Array, cut_bits: int) -> list[int]:
    return [word_hash(w) >> (64 - cut_bits) if cut_bits else 0 for w in words.to_pylist()]


def learned(docs: DataFrame, segment_pairs: int = SEGMENT_PAIRS, filter_bytes: int = FILTER_BYTES, bits: float = BITS) -> Corpus:
    """Counts of all rows of ``docs``; null texts count as empty."""
    texts = docs.select(whole("text").alias("text"))
    counts = cut(texts.mapInArrow(_count_words, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_tokens = total["n"] or 0
    cut_bits = min(MOST_CUT_BITS, (max(1, n_tokens // segment_pairs) - 1).bit_length())
    room = 8 * filter_bytes / (1 << cut_bits)  # bits, for words and pairs of one segment

    def with_segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments = pa.array(_words_segment(batch.column(0), cut_bits), pa.int64())
            yield pa.RecordBatch.from_arrays([segments, *batch.columns], ["segment", "word", "n"])

    words = counts.mapInArrow(with_segment, "segment bigint, word binary, n bigint").groupBy("segment")
    some = texts.mapInArrow(_pair_counts(cut_bits), "segment bigint, hashes binary, counts binary").groupBy("segment")
    parts = words.applyInArrow(_word_filter(WORD_SHARE * room, bits), _PART).union(
        some.applyInArrow(_pair_filter(cut_bits, (1 - WORD_SHARE) * room, bits), _PART)
    )
    folder = scratch_path(docs.sparkSession, "filter")
    written = parts.repartition(1).mapInArrow(_filter_writer(folder, 1 << cut_bits), "words bigint").collect()
    return Corpus(counts, n_tokens, total["v"], folder if written else None, cut_bits)


class _Places(dict):
    """Numbers of words in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return len(self) - 1


class _Scorer:
    """Scores of documents, with what it has looked up of the words met lately."""

    def __init__(self, words: LogFilter, pairs: LogFilter, head: dict[bytes, int], n_tokens: int, n_words: int) -> None:
        self.words, self.pairs, self.head = words, pairs, head
        self.floor = n_tokens + n_words + 1
        self.forget()

    def forget(self) -> None:
        self.places = _Places()
        self.hashes, self.counts, self.logs = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)

    def look_up(self) -> list[bytes]:
        """All words met, those that are new looked up."""
        names = list(self.places)
        new = names[len(self.hashes) :]
        if new:
            hashes = np.array([word_hash(w) for w in new], np.uint64)
            logs = np.array([log10(self.head[w] + 1) if w in self.head else np.nan for w in new])
            self.hashes = np.concatenate([self.hashes, hashes])
            self.counts = np.concatenate([self.counts, self.words.counts(hashes)])
            self.logs = np.concatenate([self.logs, logs])
        return names

    def score(self, found: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
        """Log10 probability of each document."""
        before = np.concatenate([found[:1], found[:-1]])
        before[np.flatnonzero(np.diff(doc, prepend=-1))] = self.places[END]
        both = self.pairs.counts(pair_hash(self.hashes[before], self.hashes[found], self.pairs.cut_bits))
        context, alone = self.counts[before], (self.counts[found] + 1) / self.floor
        return np.bincount(doc, np.log10((np.minimum(both, context) + WEIGHT * alone) / (context + WEIGHT)), docs)


ROWS = "row bigint, doc_id bigint, word binary, n bigint, known bigint, head double, score double"


def _scoring(corpus: Corpus, head: dict[bytes, int], context):
    """A pass over documents: one row per document, and one per distinct word of it outside ``head``."""
    shared = context.broadcast(head)
    folder, cut_bits, n_tokens, n_words = corpus.folder, corpus.cut_bits, corpus.n_tokens, corpus.n_words
    fields = list(zip([c.split()[0] for c in ROWS.split(", ")], [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]))

    def batch_of(size: int, **columns) -> pa.RecordBatch:
        arrays = [pa.array(columns[n], t) if n in columns else pa.nulls(size, t) for n, t in fields]
        return pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])

    def out(scorer: _Scorer, rows: list[int], ids: list[int | None], words: list[int], lengths: list[int]) -> Iterator[pa.RecordBatch]:
        names = scorer.look_up()
        found, docs = np.array(words, np.int64), len(rows)
        doc = np.repeat(np.arange(docs), lengths)
        logs = scorer.logs[found]
        in_head = ~np.isnan(logs)
        head_sum = np.bincount(doc, np.where(in_head, logs, 0.0), docs)
        known = np.bincount(doc, in_head, docs).astype(np.int64)
        yield batch_of(docs, row=rows, doc_id=ids, n=lengths, known=known, head=head_sum, score=scorer.score(found, doc, docs))
        other, times = np.unique(doc[~in_head] << 32 | found[~in_head], return_counts=True)
        word = pa.array(names, pa.binary()).take(pa.array(other & 0xFFFFFFFF))
        yield batch_of(len(other), row=np.array(rows, np.int64)[other >> 32], word=word, n=times)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(*_filters(folder, cut_bits), shared.value, n_tokens, n_words)
        rows, ids, words, lengths = [], [], [], []
        place = scorer.places.__getitem__
        for batch in batches:
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found = tokens(text.as_py())
                rows.append(row)
                ids.append(doc_id)
                words += map(place, found)
                lengths.append(len(found))
                if len(words) > AT_ONCE:
                    yield from out(scorer, rows, ids, words, lengths)
                    rows, ids, words, lengths = [], [], [], []
                    if len(scorer.places) > REMEMBERED:
                        scorer.forget()
                        place = scorer.places.__getitem__
        if rows:
            yield from out(scorer, rows, ids, words, lengths)

    return run


def _head(counts: DataFrame) -> dict[bytes, int]:
    """The most frequent words, at most ``HEAD``, cut between eighths of a power of two; a row for each of these comes to the
    driver first."""
    step = F.floor(8 * F.log2("n"))
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()
    reached, least = 0, 1 << 30
    for at, words in sorted(steps, reverse=True):
        reached += words
        if reached > HEAD:
            break
        least = at
    return {bytes(r["word"]): r["n"] for r in counts.where(step >= least).collect()}


def scored(docs: DataFrame, corpus: Corpus) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null text counts as empty and is the end token alone. Repeated rows are scored one by one; other columns are never
    read, whatever their names; an empty table gives no rows. With nothing learned every probability is the floor.
    """
    spark = docs.sparkSession
    head = _head(corpus.counts)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), whole("text").alias("text")
    )
    found = cut(rows.mapInArrow(_scoring(corpus, head, spark.sparkContext), ROWS))
    own = found.where("word IS NULL")
    rare = (
        found.where("word IS NOT NULL")
        .select("row", "word", "n")
        .join(corpus.counts.select(F.col("word").alias("__word"), F.col("n").alias("times")), F.col("word") == F.col("__word"))
        .groupBy("row")
        .agg(F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("times") + 1)).alias("rare"))
    )
    floor = float(np.log10(corpus.n_tokens + corpus.n_words + 1))
    return own.join(rare, "row", "left").select(
        "doc_id",
        F.coalesce(bucket("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(corpus.n_tokens).cast("bigint").alias("train_tokens"),
        (F.col("head") + F.coalesce("rare", F.lit(0.0)) - F.col("n") * floor).alias("base_score"),
        "score",
    )


def training(docs: DataFrame) -> DataFrame:
    """Rows outside the held-out fold; a null id is in no fold."""
    return docs.where(F.coalesce(bucket("doc_id", FOLDS) != HELD_OUT, F.lit(True)))
