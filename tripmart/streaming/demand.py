"""Hourly demand by zone as trips arrive (MA1, MA8): event-time windows.

A window of an hour is final, and written once, when the watermark (the latest pickup seen
less ``delay``) has passed its end. The late-data rule: a trip whose window is final when it
arrives is left out of the demand and counted as dropped; trips that are late by less than
the delay are counted in. State holds the open windows alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schema import PICKUP, RAW
from tripmart.streaming.ingest import _trigger

DELAY = "2 hours"
EVENT = "pickup_at"
OPEN_END = "9999-01-01"


def demand(trips: DataFrame) -> DataFrame:
    """Trips and fares by zone and hour; ``trips`` has the event time ``EVENT``."""
    return (trips.groupBy(F.window(EVENT, "1 hour").alias("w"), "PULocationID")
                 .agg(F.count(F.lit(1)).alias("trips"), F.sum(F.col("fare_amount").cast("decimal(12,2)")).alias("fares"))
                 .select(F.col("w.start").cast("timestamp_ntz").alias("hour_start"), "PULocationID", "trips", "fares"))


def demand_stream(spark: SparkSession, source: str, out: str, checkpoint: str, delay: str = DELAY, trigger: str = "availableNow"):
    """Raw trips of one schema (``keyed.conform_stream`` writes such) -> final windows under ``<out>/load=<batch>``."""
    rows = (spark.readStream.schema(RAW).option("recursiveFileLookup", "true").parquet(source)
            .withColumn(EVENT, F.col(PICKUP).cast("timestamp")).withWatermark(EVENT, delay))

    def batch(df, epoch):
        df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/load={epoch:09d}")

    q = demand(rows).writeStream.outputMode("append").foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _trigger(q, trigger).start()


def final_windows(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).drop("load")
