"""Results must not depend on the zone of the session."""

import pytest

from tarmac.plans import catalog
from tests.test_skew import rows_of


@pytest.mark.parametrize(
    "name", ["connections", "od_demand_monthly", "flight_demand", "export_flights_json", "run_trace", "stream_od_demand"]
)
def test_zone_does_not_matter(spark, small, name):
    before = rows_of(catalog.QUERIES[name](spark, small))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows_of(catalog.QUERIES[name](spark, small)) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_clock_across_a_missing_hour(spark):
    """02:30 on this day does not exist in New York."""
    from pyspark.sql import functions as F

    from tarmac.functions import clock

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.sql(
            "select timestamp_ntz'2024-03-10 01:30:00' as a, timestamp_ntz'2024-03-10 02:30:00.25' as b,"
            " timestamp_ntz'1969-12-31 23:59:58.5' as c"
        ).select(
            clock.seconds_between(F.col("a"), F.col("b")).alias("s"),
            clock.millis_between(F.col("a"), F.col("b")).alias("ms"),
            clock.to_wall_clock(clock.to_instant(F.col("b"))).cast("string").alias("back"),
            clock.epoch_micros(F.col("c")).alias("before_epoch"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row.s, row.ms, row.back, row.before_epoch) == (3600, 3_600_250, "2024-03-10 02:30:00.25", -1_500_000)
