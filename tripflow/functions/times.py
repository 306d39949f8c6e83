"""Time expressions on wall-clock timestamps (``timestamp_ntz``).

Nothing here reads the session time zone: a trip at 17:30 is in hour 17 on
every cluster, and a trip over a daylight-saving change keeps its length.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from tripflow.constants import DAY_NAMES, TIME_TEXT_PATTERN, UNKNOWN_DAY


def wall_clock(column: Column, data_type: T.DataType) -> Column:
    """Read a time column as wall-clock time, choosing by its schema type.

    Text must have the form ``yyyy-MM-dd HH:mm:ss``; any other text is NULL.
    """
    if isinstance(data_type, T.TimestampNTZType):
        return column
    if isinstance(data_type, T.StringType):
        return F.when(column.rlike(TIME_TEXT_PATTERN), column.try_cast("timestamp_ntz"))
    return column.cast("timestamp_ntz")


def epoch_seconds(column: Column) -> Column:
    """Whole seconds since year 1, fractions cut off.

    Counting from year 1 keeps the number positive, so cutting the fraction
    always rounds down.
    """
    start = F.expr("timestamp_ntz'0001-01-01 00:00:00'")
    return (column - start).cast("interval second").cast("bigint")


def trip_minutes(pickup: Column, dropoff: Column) -> Column:
    """Minutes between two times, rounded half-up to hundredths.

    The second count is whole, so hundredths of a minute are ``seconds * 5 / 3``
    and never fall on a tie: adding one half and flooring is the exact rounding,
    at less than half the cost of ``round`` on doubles.
    """
    seconds = epoch_seconds(dropoff) - epoch_seconds(pickup)
    return F.floor(seconds * 5 / F.lit(3.0) + 0.5) / F.lit(100.0)


def day_name(day_of_week: Column) -> Column:
    """English day name of a weekday number (1 = Sunday)."""
    names = F.array(*[F.lit(name) for name in DAY_NAMES])
    valid = day_of_week.between(1, len(DAY_NAMES))
    return F.coalesce(F.when(valid, F.try_element_at(names, day_of_week)), F.lit(UNKNOWN_DAY))
