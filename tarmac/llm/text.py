"""Small helpers the text operators share: word splitting, column hygiene, let-bindings, checkpoints."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import shared_folder

#: Characters that separate words, as the inside of a character class.
SPACES = r"\x20\x09-\x0D"
SPACE_RUN = f"[{SPACES}]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole(column: str | Column) -> Column:
    """The text itself, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once and only where the result is asked for."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Runs of characters other than white space, in order."""
    for space in "\t\n\x0b\f\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def bucket(doc_id: str | Column, buckets: int) -> Column:
    """crc32 of the id written as text, modulo ``buckets``; the split into learning and held-out rows."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % buckets


def cut(rows: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again, so that a lost executor costs no recomputation."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()
