"""What the operators on vectors share: usable rows, row blocks met by query blocks, vectors as matrices, ranked rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.text import cut

#: Components in a block of rows or queries: 4,096 vectors of 64.
BLOCK_VALUES = 1 << 18


def finite(vector: str) -> Column:
    """Whether there is a vector and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def blocked(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` (with a column ``vector``) written to the shared folder with a row number and a block, and the number of blocks.

    Blocks hold about ``BLOCK_VALUES`` components each, whatever ids or vectors repeat.
    """
    number = F.monotonically_increasing_id()
    values = rows.agg(F.sum(F.size("vector"))).first()[0] or 0
    blocks = max(1, -(-values // BLOCK_VALUES))
    numbered = rows.withColumn("row", number).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    return cut(numbered), blocks


def met(rows: DataFrame, blocks: int, queries: DataFrame, parts: int, search: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``search(rows, queries)`` for every block of rows and every block of queries; a task holds one of each."""
    left = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = queries.withColumnRenamed("block", "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(search, schema)


def matrix(column: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Vectors as rows of doubles. A shorter one is followed by zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), max(width, int(sizes.max(initial=0)))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def best(scores: np.ndarray, ids: np.ndarray, many: int) -> np.ndarray:
    """Places of the ``many`` largest scores, ties by the smaller id."""
    return np.lexsort((ids, -scores))[:many]


def numbers(column: pa.ChunkedArray) -> np.ndarray:
    """Ids as integers to order by; a missing id comes after all others."""
    return column.combine_chunks().fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def ranked(found: DataFrame, group: list[str], score: str, identity: str) -> DataFrame:
    """``found`` with ``rank`` inside each group: larger score first, then smaller id, a missing id last."""
    order = Window.partitionBy(*group).orderBy(F.col(score).desc(), F.col(identity).asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order))


def others(found: DataFrame, group: list[str], score: str, identity: str) -> DataFrame:
    """``found`` without the asking row itself: one row marked ``own`` goes, as rows with its id and vector are alike."""
    order = Window.partitionBy(*group).orderBy(F.col("own").desc(), F.col(score).desc(), F.col(identity).asc_nulls_last())
    return found.withColumn("turn", F.row_number().over(order)).where(~F.col("own") | (F.col("turn") > 1)).drop("turn", "own")
