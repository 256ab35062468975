"""Cubes kept up to date (MA4, MA14): each load adds its own partial cube.

Trips and revenue add up, so the cube over all loads is the sum of the loads' cubes by grouping
level and names. A load reads only its own trips; stored are a few rows for each load. A load
that is run again replaces its partial cube.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.mart import SUM_MONEY, star_slice

NAMES = ["year", "borough", "payment_desc", "rate_desc"]


def add_load(star: dict[str, DataFrame], path: str, load: str) -> None:
    """Add the cube of one load's star."""
    (star_slice(star).withColumn("load", F.lit(load)).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(path))


def merged(spark: SparkSession, path: str) -> DataFrame:
    """The cube over all loads, as ``star_slice`` gives it."""
    return (spark.read.parquet(path).groupBy(*NAMES, "grouping_level")
            .agg(F.sum("trips").alias("trips"), F.sum("revenue").cast(SUM_MONEY).alias("revenue")))


def compact(spark: SparkSession, path: str, load: str) -> None:
    """Fold all partial cubes into one, under a new load. Readers must not run meanwhile."""
    from tripmart.plans.jobs import stage
    whole = stage(merged(spark, path), "cube")
    whole.withColumn("load", F.lit(load)).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("load").parquet(path)
