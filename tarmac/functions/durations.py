"""ISO-8601 durations and local date-times as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two text formats accepted on input.
LOCAL_DATE_TIME = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}(:\d{2}(\.\d{0,9})?)?$"
DURATION = (
    r"^(?=.*\d[DdHhMmSs.,])(?!.*[Tt]$)([-+]?)[Pp](?:([-+]?\d+)[Dd])?"
    r"(?:[Tt](?:([-+]?\d+)[Hh])?(?:([-+]?\d+)[Mm])?(?:([-+]?\d+)(?:[.,](\d{0,9}))?[Ss])?)?$"
)
# Totals are below this many microseconds, which an interval holds: about 31,700 years.
LONGEST = 10**18

MICROS = 1_000_000


def parse_local_date_time(text: Column) -> Column:
    """``2026-04-01T08:00[:00[.0]]`` to a zone-less timestamp; null for any other form."""
    tidy = F.regexp_replace(F.regexp_replace(F.upper(text), r"\.$", ""), r"(\.\d{6})\d+$", "$1")
    return F.when(text.rlike(LOCAL_DATE_TIME), tidy.try_cast("timestamp_ntz"))


def format_local_date_time(ts: Column) -> Column:
    """Text with seconds, and with as many digits of the fraction as it needs."""
    return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))


def parse_duration_micros(text: Column) -> Column:
    """Length in microseconds of an ISO-8601 duration; null when the text is not one, or its total reaches ``LONGEST``."""

    # sign, days, hours, minutes, seconds, fraction: matched once, then used by position
    parts = F.split(F.regexp_replace(text, DURATION, "$1,$2,$3,$4,$5,$6"), ",")

    def total(part: Column) -> Column:
        def amount(position: int) -> Column:
            # absent parts are tested for: a failing cast is far slower than a comparison
            return F.when(part[position] == "", F.lit(0).cast("long")).otherwise(part[position].try_cast("long"))

        def times(position: int, unit: int) -> Column:
            return F.try_multiply(amount(position), F.lit(unit * MICROS))

        # null where a part or a sum is beyond 64 bits
        whole_micros = F.try_add(F.try_add(times(1, 86_400), times(2, 3_600)), F.try_add(times(3, 60), times(4, 1)))
        # the fraction takes the sign written on the seconds
        fraction = F.rpad(part[5], 6, "0").cast("long") * F.when(part[4].startswith("-"), -1).otherwise(1)
        return F.when(part[0] == "-", -1).otherwise(1) * F.try_add(whole_micros, fraction)

    micros = F.transform(F.array(parts), lambda part: F.transform(F.array(total(part)), lambda n: F.when(n.between(1 - LONGEST, LONGEST - 1), n))[0])[0]
    return F.when(text.rlike(DURATION), micros)


def is_duration(text: Column) -> Column:
    """The text is an ISO-8601 duration, however long."""
    return text.rlike(DURATION)


def parse_duration(text: Column) -> Column:
    """ISO-8601 duration text to a day-time interval; null when the text is not one."""
    return interval_of(parse_duration_micros(text))


def interval_of(micros: Column) -> Column:
    zero = F.lit(0)
    return F.make_dt_interval(zero, zero, zero, (micros.cast("decimal(18,0)") / MICROS).cast("decimal(18,6)"))


def format_duration(seconds: Column) -> Column:
    """Whole seconds to ISO-8601; hours do not roll over into days (``PT26H``)."""
    hours = F.call_function("div", seconds, F.lit(3_600))
    minutes = F.call_function("div", seconds % 3_600, F.lit(60))
    rest = seconds % 60

    def part(amount: Column, unit: str) -> Column:
        return F.when(amount != 0, F.concat(amount.cast("string"), F.lit(unit))).otherwise("")

    return F.when(seconds == 0, "PT0S").otherwise(
        F.concat(F.lit("PT"), part(hours, "H"), part(minutes, "M"), part(rest, "S"))
    )
