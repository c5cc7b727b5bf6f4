"""Token ids in binary files: documents compressed one by one with a shared zstandard dictionary.

A file is a run of compressed documents, then their index, then a footer. All numbers are little-endian:

    magic, 8 bytes; id width in bytes, 8 bytes; SHA-256 of the dictionary, 32 bytes
    compressed id arrays, one after another, in ascending doc_id order
    index: doc_id (signed), tokens, end of the compressed array in the file, 8 bytes each, column by column
    documents, 8 bytes; place of the index, 8 bytes

So a document is found by a binary search of the index and read alone. The dictionary is trained on the id arrays of a
bounded sample of documents; it decides how small the files are and nothing else. Tasks write under a name of their own
and then rename, so a task that runs twice leaves one whole file. Files go to the shared folder, through pyarrow's file
systems.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.encoding import encoder
from tarmac.llm.text import cut, whole
from tarmac.session import scratch_path

MAGIC = b"IDFILE01"
#: Documents the dictionary is trained on, bytes taken of each, and its size.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 2_000, 1 << 14, 1 << 16
#: Compressed bytes a file holds on average; of a corpus that would take more files than ``MOST_FILES``, as many more.
FILE_BYTES, MOST_FILES = 8 << 20, 1 << 16
LEVEL = 3
#: Stands for a null doc_id in an index, and sorts first as nulls do.
NO_ID = -(1 << 63)


def _codec(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def _serialized(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()


def trained(docs: DataFrame, tokenizer: str, end_id: int, width: int) -> bytes:
    """A dictionary from the documents with the smallest id hashes; empty where they are too few to train one."""
    order = F.xxhash64("doc_id")
    chosen = [r[0] for r in docs.select("doc_id").orderBy(order, "doc_id").limit(SAMPLE_DOCS).collect()]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, drops_space=False).column
        for batch in batches:
            taken = [_serialized(i + end, width)[:SAMPLE_BYTES] for i in encode(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(taken, pa.binary())], ["ids"])

    some = docs.where(F.col("doc_id").isin(chosen)).select(whole("text").alias("text"))
    samples = sorted(bytes(r[0]) for r in some.mapInArrow(run, "ids binary").limit(2 * SAMPLE_DOCS).collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def id_width(tokenizer: str, end_id: int) -> int:
    """Bytes that hold every id of the tokenizer, and the end id: 2 or 4."""
    return 2 if max(encoder(tokenizer, drops_space=False).size - 1, end_id) < 1 << 16 else 4


def _compressed(docs: DataFrame, tokenizer: str, end_id: int, width: int, dictionary: bytes) -> DataFrame:
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, drops_space=False).column
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=_codec(dictionary)).compress
        for batch in batches:
            tokens, packed = [], []
            for ids in encode(batch.column(1)):
                tokens.append(len(ids) // 4 + 1)
                packed.append(compress(_serialized(ids + end, width)))
            columns = [batch.column(0), pa.array(tokens, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "packed"])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole("text").alias("text"))
    return chosen.mapInArrow(run, "doc_id bigint, n_tokens bigint, packed binary")


def _number(n: int) -> bytes:
    return n.to_bytes(8, "little")


def _writer(folder: str, width: int, hashed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, place = fs.FileSystem.from_uri(folder)
        path = f"{place}/{task.partitionId():08d}.ids"
        own = f"{path}.{task.taskAttemptId()}"
        ids, tokens, ends, out, at = [], [], [], None, 48
        for batch in batches:
            for doc_id, n, packed in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    out = system.open_output_stream(own)
                    out.write(MAGIC + _number(width) + hashed)
                out.write(packed)
                at += len(packed)
                ids.append(NO_ID if doc_id is None else doc_id)
                tokens.append(n)
                ends.append(at)
        if out is not None:
            out.write(np.array(ids, "<i8").tobytes() + np.array(tokens, "<i8").tobytes() + np.array(ends, "<i8").tobytes())
            out.write(_number(len(ids)) + _number(at))
            out.close()
            system.move(own, path)
            rows = [[task.partitionId()], [path], [len(ids)], [sum(tokens)]]
            yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], ["file", "path", "docs", "tokens"])

    return run


class IdFile:
    """One file, read document by document."""

    def __init__(self, folder: str, path: str, dictionary: bytes) -> None:
        system, _ = fs.FileSystem.from_uri(folder)
        self.file = system.open_input_file(path)
        size = self.file.size()
        n, index = np.frombuffer(self.file.read_at(16, size - 16), "<i8").tolist()
        head = self.file.read_at(48, 0)
        if head[:8] != MAGIC or head[16:48] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path}: not an id file, or of another dictionary")
        self.width = int.from_bytes(head[8:16], "little")
        self.doc_ids, self.tokens, self.ends = np.frombuffer(self.file.read_at(24 * n, index), "<i8").reshape(3, n)
        self.decompress = zstandard.ZstdDecompressor(dict_data=_codec(dictionary)).decompress

    def ids(self, i: int) -> np.ndarray:
        start = int(self.ends[i - 1]) if i else 48
        packed = self.file.read_at(int(self.ends[i]) - start, start)
        return np.frombuffer(self.decompress(packed), f"<u{self.width}").astype("<u4")

    def find(self, doc_id: int) -> np.ndarray | None:
        """Ids of one document, reading no other."""
        i = int(np.searchsorted(self.doc_ids, doc_id))
        return self.ids(i) if i < len(self.doc_ids) and self.doc_ids[i] == doc_id else None


def write(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, width: int | None = None
) -> tuple[DataFrame, str, bytes]:
    """Writes ``docs`` to ``folder``; gives one row per file (file, path, docs, tokens), the folder and the dictionary.

    Files are numbered in ascending doc_id order, and documents ascend inside them. Null text counts as empty and is the
    end id alone; documents without an id come first; rows that repeat an id are all written, in any order, and may go
    over several files. Ids take the bytes that the tokenizer's vocabulary needs, unless ``width`` says how many; too
    small a width is an error. Other columns are never read, whatever their names.
    """
    needed = id_width(tokenizer, end_id)
    if width is None:
        width = needed
    elif width < needed:
        raise ValueError(f"ids of this tokenizer take {needed} bytes")
    folder = folder or scratch_path(docs.sparkSession, "ids")
    dictionary = trained(docs, tokenizer, end_id, width)
    system, place = fs.FileSystem.from_uri(folder)
    system.create_dir(place, recursive=True)
    with system.open_output_stream(f"{place}/dictionary.zdict") as out:
        out.write(dictionary)
    rows = cut(_compressed(docs, tokenizer, end_id, width, dictionary).withColumn("row", F.monotonically_increasing_id()))
    size = rows.agg(F.sum(F.length("packed"))).first()[0] or 0
    count = max(1, min(MOST_FILES, size // FILE_BYTES))
    # the row number spreads an id that many rows repeat, or lack
    files = rows.repartitionByRange(count, "doc_id", "row").sortWithinPartitions("doc_id", "row").drop("row")
    writer = _writer(folder, width, hashlib.sha256(dictionary).digest())
    return cut(files.mapInArrow(writer, "file bigint, path string, docs bigint, tokens bigint")), folder, dictionary


def read(files: DataFrame, folder: str, dictionary: bytes) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32. There are as many tasks as files."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))  # of MOST_FILES rows at most
    tasks = max(1, files.count())  # a number, or re-planning at run time would put all these short rows into one task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = IdFile(folder, path, dictionary)
                starts = start + np.cumsum(file.tokens) - file.tokens
                crc = [zlib.crc32(file.ids(i).tobytes()) for i in range(len(file.doc_ids))]
                columns = [pa.array(file.doc_ids, mask=file.doc_ids == NO_ID), pa.array(starts), pa.array(file.tokens), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return placed.select("path", "start", "file").repartition(tasks, "file").select("path", "start").mapInArrow(run, schema)
