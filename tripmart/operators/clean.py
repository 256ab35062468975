"""Trip cleaning: dedupe, duration, validity filter, fills, caps, casts.

Each step is a ``DataFrame -> DataFrame`` function. The filter is a
deterministic function of the row, so Catalyst pushes it below the full-row
dedupe and the shuffle only carries valid trips; the dedupe itself is a hash
aggregate with map-side combine, so a heavily copied row is collapsed before
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.schema import DROPOFF, DURATION, EARLY_FILL_VALUES, FILL_VALUES, INT_COLUMNS, PICKUP


def dedupe(df: DataFrame) -> DataFrame:
    """SET1: drop exact duplicate rows (NULL equals NULL)."""
    return df.distinct()


def duration_minutes(pickup: str = PICKUP, dropoff: str = DROPOFF) -> Column:
    """Whole seconds between zone-less timestamps, in minutes.

    A subtraction of TIMESTAMP_NTZ values, so no session time zone (and no DST
    hour) is involved.
    """
    return elapsed(pickup, dropoff).cast("bigint").cast("double") / F.lit(60.0)


def elapsed(pickup: str = PICKUP, dropoff: str = DROPOFF) -> Column:
    """Time between two zone-less timestamps as an interval of seconds."""
    between = F.col(dropoff).cast("timestamp_ntz") - F.col(pickup).cast("timestamp_ntz")
    return between.cast("interval second")


def with_duration(df: DataFrame, name: str = DURATION) -> DataFrame:
    """PRJ1: add the trip duration in minutes."""
    return df.withColumn(name, duration_minutes())


def positive(c: str) -> Column:
    """Above zero; NaN compares greater than any number in Spark and is not a valid value. The column is
    named once: below the dedupe a computed column is worked out as often as its filter names it."""
    return F.nanvl(F.col(c).cast("double"), F.lit(0.0)) > 0


def valid_trips(df: DataFrame, passenger_policy: str = "drop",
                duration: str = DURATION) -> DataFrame:
    """PRJ2 / PRJ3: keep trips with positive duration, fare and distance.

    ``passenger_policy="drop"`` also requires ``passenger_count > 0`` (so NULL
    passenger counts are dropped, as the clean job does); ``"fill"`` leaves
    passenger_count out of the filter, for a later fill.
    """
    cond = positive(duration) & positive("fare_amount") & positive("trip_distance")
    if passenger_policy == "drop":
        cond = cond & positive("passenger_count")
    elif passenger_policy != "fill":
        raise ValueError(f"unknown passenger_policy {passenger_policy!r}")
    return df.where(cond)


def fill_constants(df: DataFrame, values: dict | None = None) -> DataFrame:
    """IMP1 / IMP2: constant fills, only for columns present in the frame."""
    values = FILL_VALUES if values is None else values
    present = {c: v for c, v in values.items() if c in df.columns}
    return df.fillna(present) if present else df


def cast_int_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """PRJ4: cast code columns to integer (truncates toward zero)."""
    cols = INT_COLUMNS if cols is None else cols
    return df.withColumns({c: F.col(c).cast("int") for c in cols if c in df.columns})


def clean_prefix(df: DataFrame, passenger_policy: str = "drop",
                 fills: dict | None = None) -> DataFrame:
    """Dedupe -> duration -> validity filter -> fills (the lazy, pre-cap part)."""
    return fill_constants(valid_trips(with_duration(dedupe(df)), passenger_policy), fills)


def clean_early_prefix(df: DataFrame) -> DataFrame:
    """PL3 before its caps: dedupe, duration, three-predicate filter, 3 fills."""
    out = with_duration(dedupe(df), "trip_duration")
    out = valid_trips(out, "fill", duration="trip_duration")
    return fill_constants(out, EARLY_FILL_VALUES)

