"""Star schema: five dimensions and one trip fact (ST1-ST6, SET2, SET3, JN1).

Dimensions are group-bys over the cleaned trips (partial aggregation first, so
the shuffle carries at most one row per key per map task). Non-key values are
chosen deterministically: the value seen at the earliest pickup, ties by the
value itself, in two aggregation stages. The fact joins the datetime dimension
(sort-merge at scale, AQE splits a hot pair) or, with hash keys, needs no join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.scalar import calendar, code_label, money
from tripmart.operators.keymap import KeyMap
from tripmart.operators.keys import dense_key, hash_key
from tripmart.schema import (DROPOFF, DURATION, FACT_MONEY, PAYMENT_LABELS,
                             PICKUP, RATE_LABELS)

def representative(df: DataFrame, key: str, values: list[str], order: str = PICKUP) -> DataFrame:
    """SET2 with a deterministic pick: per ``key``, the ``values`` at the
    earliest ``order``, ties broken by the values. Rows with a NULL key drop."""
    first = (df.where(F.col(key).isNotNull())
               .groupBy(key, *values).agg(F.min(order).alias("_first")))
    best = first.groupBy(key).agg(F.min(F.struct("_first", *values)).alias("_r"))
    return best.select(key, *[F.col(f"_r.{v}").alias(v) for v in values])


def dim_datetime(clean: DataFrame, key_mode: str = "dense", key_map: str | None = None) -> DataFrame:
    """ST1: one row per (pickup, dropoff) with calendar fields and whole minutes. With
    ``key_map``, the path of a stored ``KeyMap``, pairs keep the keys of earlier loads and
    new ones are added to it."""
    pairs = (clean.groupBy(F.col(PICKUP).alias("pickup_datetime"),
                           F.col(DROPOFF).alias("dropoff_datetime"))
                  .agg(F.min(DURATION).alias("_dur")))
    if key_map is not None:
        keyed = KeyMap(clean.sparkSession, key_map).keyed(pairs)
    elif key_mode == "dense":
        keyed = dense_key(pairs, ["pickup_datetime", "dropoff_datetime"], "datetime_id")
    elif key_mode == "hash":
        keyed = pairs.withColumn("datetime_id", hash_key("pickup_datetime", "dropoff_datetime"))
    else:
        raise ValueError(f"unknown key_mode {key_mode!r}")
    return with_calendar(keyed)


def with_calendar(keyed: DataFrame, *keep: str) -> DataFrame:
    """The dimension's columns from keyed pairs and their duration; ``keep``: more columns, in front."""
    cal = calendar("pickup_datetime")
    return keyed.select(
        *keep, "datetime_id", "pickup_datetime", "dropoff_datetime",
        *[cal[k].alias(k) for k in ("hour", "day", "month", "year", "weekday")],
        F.col("_dur").cast("int").alias("trip_duration_min"))


def dim_location(clean: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """ST2 + SET3: every pickup and dropoff zone once (one scan, no union of
    two scans); attributes from ``zones`` when given, else NULL."""
    ids = (clean.select(F.explode(F.array("PULocationID", "DOLocationID")).alias("location_id"))
                .where(F.col("location_id").isNotNull()).distinct())
    if zones is None:
        return ids.select("location_id", *[F.lit(None).cast("string").alias(c)
                                           for c in ("borough", "zone", "service_zone")])
    return ids.join(zones.select("location_id", "borough", "zone", "service_zone"), "location_id", "left")


def dim_vendor(clean: DataFrame) -> DataFrame:
    """ST3: vendor with its representative store-and-forward flag."""
    r = representative(clean, "VendorID", ["store_and_fwd_flag"])
    return r.select(F.col("VendorID").alias("vendor_id"), "VendorID",
                    F.lit(None).cast("string").alias("vendor_name"),
                    F.col("store_and_fwd_flag").alias("store_fwd_flag"))


def dim_payment(clean: DataFrame, unknown_label: str | None = None) -> DataFrame:
    """ST4: payment type, label, and its representative pair of fees."""
    r = representative(clean, "payment_type", ["congestion_surcharge", "cbd_congestion_fee"])
    return r.select(F.col("payment_type").alias("payment_id"), "payment_type",
                    code_label("payment_type", PAYMENT_LABELS, unknown_label).alias("payment_desc"),
                    money("congestion_surcharge").alias("congestion_surcharge"),
                    money("cbd_congestion_fee").alias("cbd_congestion_fee"))


def dim_rate(clean: DataFrame, unknown_label: str | None = None) -> DataFrame:
    """ST5: rate code, label, and its representative airport fee."""
    r = representative(clean, "RatecodeID", ["Airport_fee"])
    return r.select(F.col("RatecodeID").alias("rate_id"), "RatecodeID",
                    code_label("RatecodeID", RATE_LABELS, unknown_label).alias("rate_desc"),
                    money("Airport_fee").alias("airport_fee"))


def fact_trip(clean: DataFrame, dim_dt: DataFrame | None = None, key_mode: str = "dense",
              money_mode: str = "cast", wide: bool = False) -> DataFrame:
    """ST6 + JN1: one row per cleaned trip with its dimension keys.

    ``clean`` must carry ``trip_id`` (see ``jobs.clean_job(trip_id=True)``)
    or the id is left out. ``wide`` adds the dropoff zone, both congestion fees
    and the airport fee.
    """
    if key_mode == "hash":
        keyed = clean.withColumn("datetime_id", hash_key(PICKUP, DROPOFF))
    else:
        d = dim_dt.select("datetime_id", F.col("pickup_datetime").alias("_p"),
                          F.col("dropoff_datetime").alias("_d"))
        keyed = clean.join(d, (F.col(PICKUP) == F.col("_p")) & (F.col(DROPOFF) == F.col("_d")),
                           "left")
    return keyed.select(*fact_columns(clean, money_mode, wide))


def fact_columns(clean: DataFrame, money_mode: str = "cast", wide: bool = False) -> list:
    """The fact's columns, from trips that carry their ``datetime_id``."""
    extra = [F.col("DOLocationID").alias("dropoff_location_id")] + [
        money(c, money_mode).alias(c.lower()) for c in ("congestion_surcharge", "cbd_congestion_fee", "Airport_fee")]
    ident = [F.col("trip_id")] if "trip_id" in clean.columns else []
    return [
        *ident, F.col("datetime_id"),
        F.col("PULocationID").alias("location_id"),
        F.col("VendorID").alias("vendor_id"),
        F.col("payment_type").alias("payment_id"),
        F.col("RatecodeID").alias("rate_id"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        F.col("trip_distance").cast("float").alias("trip_distance"),
        *[money(c, money_mode).alias(c) for c in FACT_MONEY], *(extra if wide else [])]


def _overflows():
    """Whether a trip has an amount that does not fit decimal(10,2)."""
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() & money(c, "try").isNull() for c in FACT_MONEY])


def fact_rejects(clean: DataFrame) -> DataFrame:
    """H12: trips whose amounts do not fit decimal(10,2)."""
    return clean.where(_overflows())


def fact_accepts(clean: DataFrame) -> DataFrame:
    """The other trips: the fact can be built from them without failing."""
    return clean.where(~_overflows())


def build_star(clean: DataFrame, zones: DataFrame | None = None,
               key_mode: str = "dense", rejects: bool = False,
               unknown_label: str | None = None, key_map: str | None = None) -> dict[str, DataFrame]:
    """PL2's six tables. The datetime dimension is computed once (staged by
    ``dense_key``) and shared by its own output and the fact. With ``rejects``
    trips whose amounts overflow go to a seventh table, ``REJECTED_TRIP``,
    instead of failing the build. ``key_map``: where datetime keys are kept between
    loads."""
    more = {}
    if rejects:
        bad = fact_rejects(clean)
        more, clean = {"REJECTED_TRIP": bad}, fact_accepts(clean)
    dt = dim_datetime(clean, key_mode, key_map)
    return more | {
        "DIM_DATETIME": dt,
        "DIM_LOCATION": dim_location(clean, zones),
        "DIM_VENDOR": dim_vendor(clean),
        "DIM_PAYMENT": dim_payment(clean, unknown_label),
        "DIM_RATE": dim_rate(clean, unknown_label),
        "FACT_TRIP": fact_trip(clean, dt, key_mode),
    }
