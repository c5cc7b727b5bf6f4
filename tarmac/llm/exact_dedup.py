"""Exact duplicates: 128-bit content hash, smallest id kept, bytes compared inside each group.

Texts are equal when identical after every run of white space is replaced by one space. One shuffle carries the
texts: rows are grouped by (hash, text), so the grouping itself compares the bytes of all texts with one hash, and
Spark combines equal texts before the shuffle, so a group holding a third of all rows leaves each map task as one row.
Rows then learn their group through the hash alone. Where one hash stands for several texts, its rows are joined on the
text as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.text import SPACE_RUN, cut, whole


def normalised(text: str | Column = "text") -> Column:
    return F.regexp_replace(whole(text), SPACE_RUN, " ")


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text))


def groups(docs: DataFrame, digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Distinct texts: hash, text, smallest id, number of rows."""
    return (
        docs.select("doc_id", normalised().alias("body"))
        .select("doc_id", "body", digest(F.col("body")).alias("hash"))
        .groupBy("hash", "body")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )


def _joined(rows: DataFrame, docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """``rows`` (with __id, __body, __hash) plus __keep and __size. Only hashes met more than once are joined."""
    found = groups(docs, digest)
    by_hash = cut(
        found.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("texts"), F.min("keep_id").alias("__keep"), F.sum("group_size").alias("__size"))
        .where("__size > 1")
    )
    single = by_hash.where("texts = 1").select(F.col("hash").alias("__of"), "__keep", "__size")
    alone = F.when(F.col("__size").isNull(), F.col("__id")).otherwise(F.col("__keep"))
    out = rows.join(single, F.col("__hash") == F.col("__of"), "left")
    clashes = by_hash.where("texts > 1").select(F.col("hash").alias("__of"))
    if not clashes.isEmpty():
        apart = rows.join(clashes, F.col("__hash") == F.col("__of"), "left_anti")
        out = apart.join(single, F.col("__hash") == F.col("__of"), "left")
        texts = found.join(clashes, F.col("hash") == F.col("__of"), "left_semi").select(
            F.col("hash").alias("__of"), F.col("body").alias("__text"), F.col("keep_id").alias("__keep"), F.col("group_size").alias("__size")
        )
        same = (F.col("__hash") == F.col("__of")) & (F.col("__body") == F.col("__text"))
        out = out.unionByName(rows.join(texts, same).drop("__text"))
    return out.withColumns({"__keep": alone, "__size": F.coalesce("__size", F.lit(1).cast("bigint"))})


def decisions(docs: DataFrame, digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; empty texts form one group. A null doc_id is never the smallest unless its whole group
    has none. Rows that repeat an id count towards group_size and stay or go together. Other columns are ignored,
    whatever their names. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").alias("__id"), normalised().alias("__body")).withColumns(
        {"__hash": digest(F.col("__body")), "__sha": F.sha2("__body", 256)}
    )
    return _joined(rows, docs, digest).select(
        F.col("__id").alias("doc_id"),
        F.col("__keep").alias("keep_id"),
        F.col("__size").alias("group_size"),
        F.col("__id").eqNullSafe(F.col("__keep")).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns whatever their names, whose document stays: of equal texts the smallest doc_id.

    Null text counts as empty. Rows that repeat that id stay together; a null id stays only where no row of the group has
    one. Texts of any length are compared whole; an empty table gives no rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col("doc_id").alias("__id"), normalised().alias("__body")).withColumn("__hash", content_hash(F.col("__body")))
    kept = _joined(rows, docs, content_hash).where(F.col("__id").eqNullSafe(F.col("__keep")))
    return kept.select("row.*")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0b\x0c\r]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.body) AS text_sha256
FROM d JOIN g USING (body)
"""
