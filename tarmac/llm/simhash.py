"""SimHash near-duplicates with pigeonring candidate search.

Fingerprints are 64 bits in a ring of four 16-bit segments. If two of them differ in at most three bits, then for some
segment i every chain of l segments from i on differs in at most floor(3 l / 4) bits: 0, 1, 2, 3 for l = 1..4. The
first two links of the chain make the join key: segment i equal, segment i + 1 equal up to one bit. One side carries the
key as it is and the other all 17 spellings of the second segment, so a 32-bit equality replaces the scan of a 16-bit
bucket; the chains of three and of four segments are checked before a pair leaves the join. Copies never meet as pairs:
the search runs over distinct fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.components import components
from tarmac.llm.text import cut, whole
from tarmac.session import scratch_path

SEED = 42
SEGMENTS, SEGMENT_BITS, DISTANCE = 4, 16, 3
#: Shingles turned into bits at once.
CHUNK = 1 << 14


def fingerprint(text: bytes) -> int:
    """64 bits of a text in UTF-8; zero when it has no word."""
    words = text.lower().split()  # bytes: A-Z only, and just the six white-space characters
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < 3:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = [digest(b" ".join(window), SEED) for window in zip(words, words[1:], words[2:])]
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = np.array(hashes[start : start + CHUNK], np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [fingerprint(text.as_py().encode()) for text in batch.column(0)]
        signed = np.array(values, np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(signed)], ["doc_id", "row", "fingerprint"])


def fingerprints(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """doc_id, a number for the row, 0 unless given, and the fingerprint as a signed 64-bit integer."""
    row = F.lit(0) if row is None else row
    chosen = docs.select(whole("text").alias("text"), F.col("doc_id").cast("bigint").alias("doc_id"), row.cast("bigint").alias("row"))
    return chosen.mapInArrow(_fingerprints, "doc_id bigint, row bigint, fingerprint bigint")


def _segment(i: int) -> Column:
    return F.shiftrightunsigned("fingerprint", SEGMENT_BITS * (i % SEGMENTS)).bitwiseAND(F.lit(0xFFFF).cast("bigint"))


def _key(i: int, second: Column) -> Column:
    """Place in the ring, segment i and the next one in one integer."""
    return F.shiftleft(_segment(i), SEGMENT_BITS).bitwiseOR(second).bitwiseOR(F.lit(i << 2 * SEGMENT_BITS).cast("bigint"))


def _within(i: Column, length: int) -> Column:
    """The chain of ``length`` segments from i on keeps its budget."""
    ring = (1 << 64) - 1
    masks = []
    for start in range(SEGMENTS):
        mask = sum(0xFFFF << SEGMENT_BITS * ((start + k) % SEGMENTS) for k in range(length)) & ring
        masks.append(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint"))
    mask = F.get(F.array(*masks), i)
    return F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other")).bitwiseAND(mask)) <= length * DISTANCE // SEGMENTS


def links(distinct: DataFrame) -> DataFrame:
    """Pairs of distinct fingerprints (column ``fingerprint``) that differ in at most three bits, each once."""
    plain = F.array(*[_key(i, _segment(i + 1)) for i in range(SEGMENTS)])
    flips = [0, *(1 << bit for bit in range(SEGMENT_BITS))]
    spelt = F.array(*[_key(i, _segment(i + 1).bitwiseXOR(F.lit(flip).cast("bigint"))) for i in range(SEGMENTS) for flip in flips])
    left = distinct.select("fingerprint", F.explode(spelt).alias("key"))
    right = distinct.select(F.col("fingerprint").alias("other"), F.explode(plain).alias("key"))
    at = F.shiftright("key", 2 * SEGMENT_BITS).cast("int")
    near = (F.col("fingerprint") < F.col("other")) & _within(at, 3) & _within(at, SEGMENTS)
    met = left.join(right.withColumnRenamed("key", "same"), (F.col("key") == F.col("same")) & near)
    return met.select("fingerprint", "other").distinct()


def _named(prints: DataFrame) -> DataFrame:
    """fingerprint and the first row of its component (missing id or not, doc_id, row), where that has several rows.

    Components are those of fingerprints. A node is a fingerprint behind its first row, so the smallest node of a
    component holds the component's first row, and ids that repeat or are null join and cut nothing.
    """
    row = F.struct(F.isnull("doc_id").alias("missing"), "doc_id", "row", "fingerprint")
    classes = cut(prints.groupBy("fingerprint").agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("size")))
    pairs = cut(links(classes.select("fingerprint")))
    first = classes.select("fingerprint", "first")
    edges = (
        pairs.join(first, "fingerprint")
        .select(F.col("first").alias("a"), "other")
        .join(first.select(F.col("fingerprint").alias("other"), F.col("first").alias("b")), "other")
        .select("a", "b")
    )
    roots = components(edges).select(F.col("node.fingerprint").alias("fingerprint"), "root")
    named = classes.join(roots, "fingerprint", "left").where("size > 1 OR root IS NOT NULL")
    return named.select("fingerprint", F.coalesce("root", "first").alias("named"))


def labelled(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (signed) and component_id, the smallest doc_id it is linked to.

    Null text counts as empty; all texts without a word have fingerprint zero and are linked like any other. Rows that
    repeat an id are labelled one by one, by their texts; a null doc_id never names a component unless nothing else does.
    Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    prints = cut(fingerprints(docs))
    return prints.join(_named(prints), "fingerprint", "left").select(
        "doc_id", "fingerprint", F.coalesce("named.doc_id", "doc_id").alias("component_id")
    )


def decisions(docs: DataFrame) -> DataFrame:
    """As ``labelled``, the fingerprint in 16 lowercase hexadecimal digits."""
    written = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return labelled(docs).select("doc_id", written.alias("fingerprint"), "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns whatever their names, with one row of each component, the one with the smallest id.

    Of several rows with that id, or if no row of the component has an id, one stays. Rows of other components stay
    whatever their ids. Null text counts as empty; texts without a word are linked to each other; texts of any length are
    read whole; an empty table gives no rows.
    """
    place = scratch_path(docs.sparkSession, "numbered")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    docs.select(row, F.monotonically_increasing_id().alias("number")).write.parquet(place)  # a row keeps its number
    rows = docs.sparkSession.read.parquet(place)
    prints = cut(fingerprints(rows.select("document.doc_id", "document.text", "number"), F.col("number")))
    gone = prints.join(_named(prints), "fingerprint").where("row <> named.row").select(F.col("row").alias("gone"))
    kept = rows.join(gone, F.col("number") == F.col("gone"), "left_anti")
    return kept.select("document.*")
