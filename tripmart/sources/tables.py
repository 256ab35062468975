"""Driver tables and the trip-shaped view derived from them.

The test data are TPC-H-like tables, not taxi files. ``trips`` maps
``lineitem JOIN orders`` onto the 20-column raw trip schema by fixed rules,
and plants exact duplicates (every line of an order whose key is a multiple of
50 appears twice), NULLs (about one row in 13) and invalid trips.
The duplicate is made with a generator over the single join result instead of
a second scan and join, so the view costs one shuffle at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schema import DROPOFF, PICKUP, RAW_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dbl(v: float) -> Column:
    return F.lit(v).cast("double")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips (schema ``tripmart.schema.RAW``) derived from the driver tables."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey)

    ok, pk, sk, ln = (F.col("l_orderkey"), F.col("l_partkey"),
                      F.col("l_suppkey"), F.col("l_linenumber"))
    opt_null = (ok + ln) % 13 == 0
    null_d = F.lit(None).cast("double")
    pu_zone = pk % 265 + 1
    hour_offset = ((ok * 37 + ln * 101 + pk) % 24) * 60
    pickup = F.timestamp_add("MINUTE", hour_offset.cast("int"), F.col("o_orderdate"))
    cents = F.floor(F.col("l_extendedprice") / _dbl(10))

    base = j.select(
        (sk % 4 + 1).cast("int").alias("VendorID"),
        pickup.alias(PICKUP),
        F.col("l_quantity"),
        F.when(opt_null, null_d).otherwise((ln - 1).cast("double")).alias("passenger_count"),
        F.when(pk % 97 == 0, _dbl(0))
         .otherwise(F.col("l_quantity").cast("double") / _dbl(4)
                    + (pk % 100).cast("double") / _dbl(100)).alias("trip_distance"),
        F.when(opt_null, null_d).when(pk % 41 == 0, _dbl(99))
         .otherwise((sk % 6 + 1).cast("double")).alias("RatecodeID"),
        F.when(opt_null, F.lit(None).cast("string"))
         .when(F.col("l_returnflag") == "R", F.lit("Y")).otherwise(F.lit("N"))
         .alias("store_and_fwd_flag"),
        pu_zone.cast("int").alias("PULocationID"),
        (sk % 265 + 1).cast("int").alias("DOLocationID"),
        (ok % 7).cast("bigint").alias("payment_type"),
        ((cents - 200).cast("double") / _dbl(100)).alias("fare_amount"),
        ((ln % 3).cast("double") / _dbl(2)).alias("extra"),
        _dbl(0.5).alias("mta_tax"),
        (ln.cast("double") * _dbl(0.75)).alias("tip_amount"),
        F.when(ln == 5, _dbl(6.94)).otherwise(_dbl(0)).alias("tolls_amount"),
        _dbl(1).alias("improvement_surcharge"),
        ((cents + ln * 75).cast("double") / _dbl(100)).alias("total_amount"),
        F.when(opt_null, null_d).otherwise(_dbl(2.5)).alias("congestion_surcharge"),
        F.when(opt_null, null_d).when(pu_zone.isin(132, 138), _dbl(1.75))
         .otherwise(_dbl(0)).alias("Airport_fee"),
        F.when(F.col("l_linestatus") == "O", _dbl(0.75)).otherwise(_dbl(0))
         .alias("cbd_congestion_fee"),
        # 1 copy, or 2 copies for the planted exact duplicates
        F.explode(F.sequence(F.lit(1), F.when(ok % 50 == 0, 2).otherwise(1))).alias("_copy"),
    )
    dropoff = F.timestamp_add(
        "SECOND", ((F.col("l_quantity").cast("bigint") - 2) * 60).cast("int"), F.col(PICKUP))
    return base.withColumn(DROPOFF, dropoff).select(*RAW_COLUMNS)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup for the location dimension: location 1..25 = nation + 1,
    zone = nation name, borough = region name."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select((F.col("n_nationkey") + 1).cast("int").alias("location_id"),
                     F.col("r_name").alias("borough"),
                     F.col("n_name").alias("zone"),
                     F.lit(None).cast("string").alias("service_zone")))
