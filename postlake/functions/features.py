"""Time, score and growth features as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from postlake import fixed


def event_time(epoch_seconds: Column) -> Column:
    return F.timestamp_seconds(epoch_seconds)


def row_hash(*parts: Column) -> Column:
    return F.md5(F.concat_ws("_", *[part.cast("string") for part in parts]))


def time_features(time: Column, null_bucket: str | None = None) -> dict[str, Column]:
    """Hour, weekday (1 = Sunday), day name, weekend flag and part of the day."""
    return {
        "hour_of_day": F.hour(time),
        "day_of_week": F.dayofweek(time),
        "day_name": F.date_format(time, "EEEE"),
        "is_weekend": F.dayofweek(time).isin(1, 7),
        "time_period": time_period(F.hour(time), null_bucket),
    }


def time_period(hour: Column, null_bucket: str | None = None) -> Column:
    """Part of the day. A NULL hour stays NULL unless ``null_bucket`` names its bucket."""
    bucket = F
    for last, name in fixed.TIME_PERIODS:
        bucket = bucket.when(hour <= last, name)
    return bucket.when(hour.isNotNull(), fixed.LAST_PERIOD).otherwise(F.lit(null_bucket))


def engagement(score: Column, null_bucket: str | None = None) -> Column:
    """Score bucket. A NULL score stays NULL unless ``null_bucket`` names its bucket."""
    bucket = F
    for edge, name in fixed.ENGAGEMENT:
        bucket = bucket.when(score < edge, name)
    return bucket.when(score.isNotNull(), fixed.TOP_ENGAGEMENT).otherwise(F.lit(null_bucket))


def min_max(value: Column, low: Column, high: Column, scale: float = 100.0) -> Column:
    """Place of ``value`` between ``low`` and ``high`` on 0..scale; 0 when the two are equal."""
    place = F.try_divide(value - low, high - low) * scale
    return F.when(value.isNotNull(), F.coalesce(place, F.lit(0.0)))


def steady_round(value: Column, digits: int) -> Column:
    """Round a mean or deviation of fractions.

    Its last bits depend on the order of summing, which is not fixed in a cluster. Rounding to 12 digits
    first takes these bits away, so that a value on the edge (0.3125) always goes the same way.
    """
    return F.round(F.round(value, 12), digits)


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def growth_rate(
    value: str, keys: Sequence[str], order: str = "date", calendar: bool = False
) -> Column:
    """Change against the previous row of the same keys, in percent.

    The previous row is the previous one present. With ``calendar`` the rate is NULL unless that row is
    from the day before. Meant for aggregated rows, of which each key has few.
    """
    window = Window.partitionBy(*keys).orderBy(order)
    before = F.lag(value).over(window)
    rate = F.round(F.try_divide(F.col(value) - before, before) * 100, 2)
    if not calendar:
        return rate
    return F.when(F.date_add(F.lag(order).over(window), 1) == F.col(order), rate)


def dominant(value: Column) -> Column:
    """The most frequent value, ties to the smallest. Any value counts, also one in no list known beforehand."""
    return F.mode(value, True)


def hour_counts(hour: Column) -> Column:
    """The rows of a group in each of the 24 hours: fixed-size buffers, however many rows there are."""
    return F.array(*[F.count_if(hour == h) for h in range(24)])


def hours_list(counts: Column) -> Column:
    """``hour_counts`` written out: all hours of a group in ascending order, one entry per row. As long as
    its group, so it is made on reading and for small groups, and not stored."""
    runs = F.transform(counts, lambda n, h: F.array_repeat(h, n.cast("int")))
    return F.flatten(runs)


def distinct_hours(hour: Column) -> Column:
    """Number of different hours in a group."""
    seen = F.bit_or(F.call_function("shiftleft", F.lit(1), hour))
    return F.coalesce(F.bit_count(seen), F.lit(0))
