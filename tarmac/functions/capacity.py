"""Seat and route expressions over flight rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.schemas import PRIORITIES


def occupied_seats() -> Column:
    return F.col("total_seats") - F.col("available_seats")


def is_fully_booked() -> Column:
    return F.col("available_seats") <= 0


def has_capacity(seats: Column) -> Column:
    return F.col("available_seats") >= seats


def od_key() -> Column:
    return F.concat_ws("-", "origin", "destination")


def entity_type(persistence_id: Column) -> Column:
    return F.split_part(persistence_id, F.lit("-"), F.lit(1))


def priority_rank(priority: Column) -> Column:
    """1 for the lowest priority; null for a name that is not one."""
    rank = F.when(priority == PRIORITIES[0], 1)
    for position, name in enumerate(PRIORITIES[1:], start=2):
        rank = rank.when(priority == name, position)
    return rank
