"""Column expressions for the trip derivations.

Each function returns a ``Column`` built only from ``pyspark.sql.functions``
so every derivation stays inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow import schema as S


def coerce_timestamp(name: str) -> Column:
    """Timestamp without zone; unparsable input becomes NULL (ANSI-safe)."""
    return F.col(name).try_cast(T.TimestampNTZType())


def duration_minutes(pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime") -> Column:
    """Whole seconds between pickup and dropoff, in minutes."""
    return (F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)) / 60.0


def is_weekend(ts: str = "pickup_datetime") -> Column:
    return F.dayofweek(ts).isin(*S.WEEKEND_DAYS)


def is_peak_hour(hour: str = "pickup_hour") -> Column:
    return reduce(lambda a, b: a | b, [F.col(hour).between(lo, hi) for lo, hi in S.PEAK_HOUR_RANGES])


def average_speed_mph(
    distance: str = "trip_distance", minutes: str = "trip_duration_minutes"
) -> Column:
    """Miles per hour; NULL when the duration is not positive."""
    return F.when(F.col(minutes) > 0, F.col(distance) / (F.col(minutes) / 60.0))


def is_refund_or_reversal(fare: str = "fare_amount", total: str = "total_amount") -> Column:
    return (F.col(fare) < 0) | (F.col(total) < 0)


def is_anomalous_trip(
    minutes: str = "trip_duration_minutes",
    distance: str = "trip_distance",
    total: str = "total_amount",
) -> Column:
    """Three-valued: NULL when no rule fires and one input is NULL."""
    return (
        (F.col(minutes) <= 0)
        | (F.col(minutes) > S.MAX_DURATION_MINUTES)
        | (F.col(distance) > S.MAX_DISTANCE_MILES)
        | (F.col(total) > S.MAX_TOTAL_AMOUNT)
    )


def is_rejected(flag: str = "is_anomalous_trip") -> Column:
    """Routing predicate: an unknown flag counts as rejected so no row is lost."""
    return F.coalesce(F.col(flag), F.lit(True))


def in_period(ts: str, start, end) -> Column:
    """Calendar date of ``ts`` between two dates, both inclusive."""
    return F.to_date(F.col(ts)).between(F.lit(start), F.lit(end))


def iso_seconds(c: Column) -> Column:
    """ISO-8601 text with seconds, no zone."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
