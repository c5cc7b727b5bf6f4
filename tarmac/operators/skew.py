"""Ordered scans that hold up when one key owns a large share of the rows.

A key is *heavy* when it has more than ``max(floor, share * rows)`` rows. Fewer than
``1 / share`` keys can pass that test whatever the data, so the list of heavy keys has a
fixed size bound and may be broadcast. Every other key fits one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.clock import epoch_micros, floor_div
from tarmac.session import shared_folder


@dataclass(frozen=True)
class SkewPolicy:
    """``floor``: rows one task takes without trouble; ``share``: heavy-key threshold as a
    fraction of all rows; ``chunk``: rows per slice of a heavy key; ``pairs``: pairs of rows that
    one cell of an interval join may compare."""

    floor: int = 1 << 20
    share: float = 1e-4
    chunk: int = 1 << 18
    pairs: int = 1 << 26


DEFAULT = SkewPolicy()


def heavy_keys(df: DataFrame, keys: Sequence[str], policy: SkewPolicy = DEFAULT) -> DataFrame | None:
    """Heavy keys of ``df`` with their row counts in ``_rows``, or None when there are none.

    This runs a count over the key columns. Where ``df`` is costly to compute, callers measure
    the cheaper rows it comes from.
    """
    measured = df.select(*keys)
    known = (df.sparkSession.sparkContext.applicationId, measured.semanticHash(), policy)
    if known in _measured and _measured[known][0].sameSemantics(measured):
        return _measured[known][1]
    heavy = _find_heavy(measured, policy)
    if len(_measured) >= _MEASURED_LIMIT:
        _measured.pop(next(iter(_measured)))
    _measured[known] = (measured, heavy)
    return heavy


# What earlier calls found for the same rows. Any list of heavy keys gives the right result,
# so an entry that has gone stale costs time at most.
_measured: dict[tuple, tuple[DataFrame, DataFrame | None]] = {}
_MEASURED_LIMIT = 200


def _find_heavy(keyed: DataFrame, policy: SkewPolicy) -> DataFrame | None:
    rows = keyed.count()
    limit = max(policy.floor, int(rows * policy.share))
    if rows <= limit:
        return None
    counted = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > limit)
    found = counted.collect()  # fewer than rows / limit <= 1 / share of them
    if not found:
        return None
    return keyed.sparkSession.createDataFrame(found, counted.schema)


def split_rows(df: DataFrame, keys: Sequence[str], heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of heavy keys, all other rows)."""
    small = F.broadcast(heavy.select(*keys))
    return df.join(small, list(keys), "left_semi"), df.join(small, list(keys), "left_anti")


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    sums: dict[str, Column] | None = None,
    latest: dict[str, Column] | None = None,
    previous: dict[str, Column] | None = None,
    ordinal: str | None = None,
    policy: SkewPolicy = DEFAULT,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add running columns over each key's rows in ascending ``order`` (a total order).

    ``sums``: total up to and including the row. ``latest``: last non-null value up to and
    including the row. ``previous``: last non-null value before the row.

    Heavy keys are cut into slices that follow the order, scanned slice by slice, and joined
    to what the earlier slices carry over. ``ordinal`` names an integer column that rises with
    the order, is unique within a key and leaves few numbers out: a slice then is a range of
    ``policy.chunk`` ordinals and nothing is measured. Otherwise slices come from ``row_slices``.
    """
    keys, order = list(keys), list(order)
    sums, latest, previous = sums or {}, latest or {}, previous or {}
    heavy = heavy_keys(df if sized_by is None else sized_by, keys, policy)
    if heavy is None:
        rows = Window.partitionBy(*keys).orderBy(*order)
        so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        earlier = rows.rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns(
            {name: F.sum(value).over(so_far) for name, value in sums.items()}
            | {name: F.last(value, ignorenulls=True).over(so_far) for name, value in latest.items()}
            | {name: F.last(value, ignorenulls=True).over(earlier) for name, value in previous.items()}
        )

    if ordinal is not None:
        marked = df.join(F.broadcast(heavy.select(*keys, F.lit(True).alias("_heavy"))), keys, "left")
        marked = marked.withColumn(
            "_slice", F.when(F.col("_heavy"), floor_div(F.col(ordinal), policy.chunk)).otherwise(F.lit(0))
        ).withColumn("_heavy", F.coalesce("_heavy", F.lit(False)))
    else:
        hot, cold = split_rows(df, keys, heavy)
        sliced = row_slices(hot, keys, order, policy.chunk).withColumn("_heavy", F.lit(True))
        rest = cold.withColumns({"_slice": F.array().cast(PATH), "_heavy": F.lit(False)})
        marked = sliced.unionByName(rest)

    rows = Window.partitionBy(*keys, "_slice").orderBy(*order)
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = rows.rowsBetween(Window.unboundedPreceding, -1)
    within = marked.withColumns(
        {f"_in_{name}": F.sum(value).over(so_far) for name, value in sums.items()}
        | {f"_in_{name}": F.last(value, ignorenulls=True).over(so_far) for name, value in latest.items()}
        | {f"_in_{name}": F.last(value, ignorenulls=True).over(earlier) for name, value in previous.items()}
    )

    position = F.struct(*order)
    totals = (
        marked.where("_heavy")
        .groupBy(*keys, "_slice")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.sum(value).alias(f"_carry_{name}") for name, value in sums.items()],
            *[
                F.max_by(value, F.when(value.isNotNull(), position)).alias(f"_carry_{name}")
                for name, value in (latest | previous).items()
            ],
        )
    )
    slices = Window.partitionBy(*keys).orderBy("_slice")
    before = slices.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys,
        "_slice",
        *[F.sum(f"_carry_{name}").over(before).alias(f"_carry_{name}") for name in sums],
        *[
            F.last(f"_carry_{name}", ignorenulls=True).over(before).alias(f"_carry_{name}")
            for name in latest | previous
        ],
    )

    joined = within.join(carried, [*keys, "_slice"], "left")
    carry = {
        # a sum of nulls only stays null
        name: F.coalesce(
            F.col(f"_in_{name}") + F.col(f"_carry_{name}"), F.col(f"_in_{name}"), F.col(f"_carry_{name}")
        )
        for name in sums
    }
    carry |= {name: F.coalesce(f"_in_{name}", f"_carry_{name}") for name in latest | previous}
    return joined.select(*df.columns, *[value.alias(name) for name, value in carry.items()])


PATH = "array<bigint>"
#: Parts a slice is cut into at once.
MOST_PARTS = 1 << 16


def _coordinates(df: DataFrame, order: list[str]) -> list[Column]:
    """The order as integers below 2^33, two for each column, up to the first column that is not a number or a time.

    Nulls come first.
    """
    found: list[Column] = []
    for name in order:
        kind = df.schema[name].dataType
        column = F.col(name)
        if isinstance(kind, T.TimestampNTZType):
            column = epoch_micros(column)
        elif isinstance(kind, T.TimestampType):
            column = F.unix_micros(column)
        elif isinstance(kind, T.DateType):
            column = F.unix_date(column)
        elif not isinstance(kind, T.IntegralType):
            break
        column = column.cast("long")
        low = column.bitwiseAND(F.lit((1 << 32) - 1).cast("long"))
        found += [F.coalesce(F.shiftright(column, 32), F.lit(-(1 << 32))), F.coalesce(low, F.lit(0).cast("long"))]
    return found


def row_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: int) -> DataFrame:
    """``df`` with a column ``_slice`` that follows the order inside each key, at most ``chunk`` rows to a slice.

    A slice is cut where it holds more: its rows are counted with the least and greatest value of each
    ordering column, and the first column that differs is cut into equal widths, twice as many as the
    rows need. Crowded parts are cut again. ``_slice`` is the path of these cuts. Only counts per slice
    are kept between rounds, so nothing is gathered and no order is sampled. Rows alike in all numeric
    and time columns of the order stay in one slice.
    """
    shared_folder(df.sparkSession)  # makes sure checkpoints have a place
    keys, order = list(keys), list(order)
    places = _coordinates(df, order)
    names = [f"_c{i}" for i in range(len(places))]
    rows = df.withColumns(dict(zip(names, places)) | {"_slice": F.array().cast(PATH)})
    differs = [F.col(f"_least{n}") < F.col(f"_most{n}") for n in names]
    while names:
        counted = rows.groupBy(*keys, "_slice").agg(
            F.count(F.lit(1)).alias("_rows"), *[f(n).alias(f"{side}{n}") for n in names for f, side in ((F.min, "_least"), (F.max, "_most"))]
        )
        crowded = counted.where((F.col("_rows") > chunk) & reduce(or_, differs))
        first = F.coalesce(*[F.when(d, F.lit(i)) for i, d in enumerate(differs)])
        least = F.coalesce(*[F.when(d, F.col(f"_least{n}")) for n, d in zip(names, differs)])
        most = F.coalesce(*[F.when(d, F.col(f"_most{n}")) for n, d in zip(names, differs)])
        parts = F.least(F.lit(MOST_PARTS), F.ceil(2 * F.col("_rows") / chunk))
        width = F.greatest(F.lit(1), F.ceil((most - least + 1) / parts)).cast("long")
        cuts = crowded.select(*keys, "_slice", first.alias("_by"), least.alias("_from"), width.alias("_width")).checkpoint()
        if cuts.isEmpty():
            break
        by = F.element_at(F.array(*names), F.col("_by") + 1)
        deeper = F.concat("_slice", F.array(F.call_function("div", by - F.col("_from"), F.col("_width"))))
        rows = (
            rows.join(cuts, [*keys, "_slice"], "left")
            .withColumn("_slice", F.when(F.col("_by").isNotNull(), deeper).otherwise(F.col("_slice")))
            .drop("_by", "_from", "_width")
        )
    return rows.select(*df.columns, "_slice")
