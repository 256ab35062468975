"""Mart analytics over cleaned trips and the star (MA1-MA14).

Group-bys with partial aggregation; windows only over already-aggregated,
small results or partitioned by a key; how a dimension is joined is left to the
optimizer, which knows the real sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.scalar import avg_speed, money
from tripmart.schema import DROPOFF, DURATION, PICKUP


def peak_hour(trips: DataFrame) -> DataFrame:
    """MA1: trips per pickup hour."""
    return (trips.groupBy(F.hour(PICKUP).alias("pickup_hour"))
                 .agg(F.count(F.lit(1)).alias("trips")))




HOURS = list(range(24))
# Money totals: decimal(38,2) holds any sum of decimal(10,2) amounts exactly.
SUM_MONEY = "decimal(38,2)"


def traffic_pattern(trips: DataFrame) -> DataFrame:
    """MA2: trips per weekday and pickup hour."""
    return (trips.groupBy(F.date_format(PICKUP, "EEEE").alias("weekday"),
                          F.hour(PICKUP).alias("pickup_hour"))
                 .agg(F.count(F.lit(1)).alias("trips")))


def avg_duration(trips: DataFrame, digits: int = 6) -> DataFrame:
    """MA3: average trip duration (minutes) per pickup hour."""
    return (trips.groupBy(F.hour(PICKUP).alias("pickup_hour"))
                 .agg(F.count(F.lit(1)).alias("trips"),
                      F.round(F.avg(DURATION), digits).alias("avg_duration_min")))


def revenue_rollup(trips: DataFrame) -> DataFrame:
    """MA4: revenue by year, month, payment type and vendor with rollup
    subtotals; money summed as decimal(10,2), so totals are exact."""
    return (trips.rollup(F.year(PICKUP).alias("pickup_year"), F.month(PICKUP).alias("pickup_month"),
                         F.col("payment_type"), F.col("VendorID").alias("vendor_id"))
                 .agg(F.grouping_id().cast("int").alias("grouping_level"),
                      F.count(F.lit(1)).alias("trips"),
                      F.sum(money("total_amount")).cast(SUM_MONEY).alias("revenue")))


def fare_trend(trips: DataFrame, digits: int = 6) -> DataFrame:
    """MA5: average fare per month and its change from the previous month.

    The ``lag`` window runs over the monthly aggregate (one row per month), so
    its single ordered partition is bounded by the calendar, not the data.
    """
    monthly = (trips.groupBy(F.year(PICKUP).alias("pickup_year"), F.month(PICKUP).alias("pickup_month"))
                    .agg(F.count(F.lit(1)).alias("trips"),
                         F.round(F.avg("fare_amount"), digits).alias("avg_fare")))
    w = Window.orderBy("pickup_year", "pickup_month")
    return monthly.withColumn("fare_change", F.round(F.col("avg_fare") - F.lag("avg_fare").over(w), digits))


def tip_behaviour(trips: DataFrame, digits: int = 6) -> DataFrame:
    """MA6: tip as a share of fare, and share of tipped trips, by payment and hour."""
    ratio = F.try_divide(F.col("tip_amount"), F.col("fare_amount"))
    return (trips.groupBy("payment_type", F.hour(PICKUP).alias("pickup_hour"))
                 .agg(F.count(F.lit(1)).alias("trips"),
                      F.round(F.avg(ratio), digits).alias("avg_tip_ratio"),
                      F.count_if(F.col("tip_amount") > 0).alias("tipped_trips")))


def airport_revenue(trips: DataFrame) -> DataFrame:
    """MA7: trips with an airport fee, their revenue and fees by pickup zone."""
    return (trips.where(F.col("Airport_fee") > 0)
                 .groupBy("PULocationID")
                 .agg(F.count(F.lit(1)).alias("trips"),
                      F.sum(money("total_amount")).cast(SUM_MONEY).alias("revenue"),
                      F.sum(money("Airport_fee")).cast(SUM_MONEY).alias("airport_fees")))


def hotspots(trips: DataFrame, k_sd: float = 2.0, digits: int = 6) -> DataFrame:
    """MA8: (zone, hour) cells whose trip count exceeds the zone's mean hourly
    count by more than ``k_sd`` standard deviations (window over at most 24
    aggregated rows per zone)."""
    cells = (trips.groupBy("PULocationID", F.hour(PICKUP).alias("pickup_hour"))
                  .agg(F.count(F.lit(1)).alias("trips")))
    w = Window.partitionBy("PULocationID")
    stats = cells.select("*", F.avg("trips").over(w).alias("zone_mean"),
                         F.stddev_samp("trips").over(w).alias("zone_sd"))
    hot = stats.where(F.col("trips") > F.col("zone_mean") + F.lit(k_sd) * F.col("zone_sd"))
    return hot.select("PULocationID", "pickup_hour", "trips",
                      F.round("zone_mean", digits).alias("zone_mean"),
                      F.round("zone_sd", digits).alias("zone_sd"))


def active_areas(trips: DataFrame, k: int = 10) -> DataFrame:
    """MA9: top-k zones by pickups + dropoffs (one scan, distributed top-k)."""
    ends = trips.select(F.explode(F.array(
        F.struct(F.col("PULocationID").alias("location_id"), F.lit(1).alias("pu")),
        F.struct(F.col("DOLocationID").alias("location_id"), F.lit(0).alias("pu")))).alias("e"))
    per = (ends.groupBy(F.col("e.location_id").alias("location_id"))
               .agg(F.sum("e.pu").cast("bigint").alias("pickups"),
                    F.sum(1 - F.col("e.pu")).cast("bigint").alias("dropoffs")))
    per = per.withColumn("total", F.col("pickups") + F.col("dropoffs"))
    return per.orderBy(F.desc("total"), "location_id").limit(k)


def trip_flow(trips: DataFrame) -> DataFrame:
    """MA10: origin-destination counts and each pair's share of its origin
    (window over the aggregated pairs, at most #zones rows per origin)."""
    pairs = trips.groupBy("PULocationID", "DOLocationID").agg(F.count(F.lit(1)).alias("trips"))
    w = Window.partitionBy("PULocationID")
    return pairs.withColumn("share_of_origin",
                            F.col("trips").cast("double") / F.sum("trips").over(w).cast("double"))


def demand_heatmap(trips: DataFrame) -> DataFrame:
    """MA11: pickups per zone (rows) and hour (24 columns ``h00``..``h23``).
    The pivot values are given, so Spark needs no extra job to find them."""
    t = trips.withColumn("pickup_hour", F.hour(PICKUP))
    p = t.groupBy("PULocationID").pivot("pickup_hour", HOURS).count()
    return p.select("PULocationID", *[F.coalesce(F.col(str(h)), F.lit(0)).cast("bigint").alias(f"h{h:02d}")
                                      for h in HOURS])


def trip_features(trips: DataFrame) -> DataFrame:
    """MA12 + MA13: pickup hour, day and month, and average speed (mph)."""
    return trips.select(
        "PULocationID", "DOLocationID", PICKUP, DROPOFF, "trip_distance", DURATION,
        F.hour(PICKUP).alias("pickup_hour"), F.dayofmonth(PICKUP).alias("pickup_day"),
        F.month(PICKUP).alias("pickup_month"),
        avg_speed("trip_distance", DURATION).alias("avg_speed"))


def star_slice(star: dict[str, DataFrame]) -> DataFrame:
    """MA14: slice the fact by year, borough, payment and rate with a cube.

    The fact is summed by year and keys before it meets the dimensions, and by
    names before the cube, which expands each row 16 times. Sides are broadcast
    where the optimizer's sizes allow it.
    """
    sums = [F.sum("trips").alias("trips"), F.sum("revenue").alias("revenue")]
    f = (star["FACT_TRIP"].join(star["DIM_DATETIME"].select("datetime_id", "year"), "datetime_id", "left")
         .groupBy("year", "location_id", "payment_id", "rate_id")
         .agg(F.count(F.lit(1)).alias("trips"), F.sum("total_amount").cast(SUM_MONEY).alias("revenue")))
    named = (f.join(star["DIM_LOCATION"].select("location_id", "borough"), "location_id", "left")
              .join(star["DIM_PAYMENT"].select("payment_id", "payment_desc"), "payment_id", "left")
              .join(star["DIM_RATE"].select("rate_id", "rate_desc"), "rate_id", "left")
              .groupBy("year", "borough", "payment_desc", "rate_desc").agg(*sums))
    return (named.cube("year", "borough", "payment_desc", "rate_desc")
             .agg(F.grouping_id().cast("int").alias("grouping_level"),
                  F.sum("trips").alias("trips"), F.sum("revenue").cast(SUM_MONEY).alias("revenue")))
