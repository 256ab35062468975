"""Incremental arrival with keyed state (SRC6, PL6).

``streaming.ingest`` knows earlier trips by reading the keys of the touched months back for
every batch, so over a month of arrivals its cost grows with the square of their number. Here
the keys are state of the stream, and a batch costs what the batch holds:

1. ``conform_stream`` takes new trip files as they come (columns and types may differ from
   month to month), casts them, drops copies within the arrival, and writes raw trips of one
   schema with their arrival time: one folder for each batch, overwritten if it is run again.
2. ``keyed_stream`` reads these folders, keeps the first trip of each raw key
   (``dropDuplicatesWithinWatermark``, in RocksDB), cleans it and writes it to the
   month-partitioned table, again into a folder of the batch.

The watermark runs on arrival time, which never falls behind: a trip is never late, however
old its month. ``memory`` is how long a key is remembered after its arrival; a file
delivered again later than that adds its trips anew, and state holds the keys of that span.
Both streams keep their progress in checkpoints: a restart goes on after the last batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import sketches
from tripmart.operators.clean import dedupe, fill_constants, valid_trips, with_duration
from tripmart.operators.keys import RAW_KEY, with_raw_key
from tripmart.schema import CAP_COLUMNS, PICKUP, RAW
from tripmart.session import glob_paths
from tripmart.sources.files import read_files
from tripmart.streaming.ingest import MONTH, _trigger, trip_file_stream

ARRIVED, LOAD = "arrived", "load"
MEMORY = "400 days"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CONFORMED = T.StructType([*RAW.fields, T.StructField(ARRIVED, T.TimestampType())])


def conform_stream(spark: SparkSession, source: str, conformed: str, checkpoint: str, trigger: str = "availableNow",
                   max_files: int | None = None):
    """Trip files -> raw trips of one schema under ``<conformed>/load=<batch>``."""
    def batch(df, epoch):
        paths = [r.path for r in df.collect()]              # file names of one trigger
        if paths:
            rows = dedupe(read_files(df.sparkSession, paths)).withColumn(ARRIVED, F.current_timestamp())
            rows.write.mode("overwrite").parquet(f"{conformed.rstrip('/')}/{LOAD}={epoch:09d}")

    q = (trip_file_stream(spark, source, max_files).writeStream
         .foreachBatch(batch).option("checkpointLocation", checkpoint))
    return _trigger(q, trigger).start()


def first_arrivals(spark: SparkSession, conformed: str, memory: str = MEMORY, max_files: int | None = None) -> DataFrame:
    """The stream of raw trips that have not arrived before, with their key."""
    r = spark.readStream.schema(CONFORMED).option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    rows = with_raw_key(r.parquet(conformed))
    return rows.withWatermark(ARRIVED, memory).dropDuplicatesWithinWatermark(RAW_KEY)


def keyed_stream(spark: SparkSession, conformed: str, cleaned_path: str, checkpoint: str, trigger: str = "availableNow",
                 passenger_policy: str = "drop", memory: str = MEMORY, max_files: int | None = None, summaries: str | None = None):
    """Raw trips -> first of each key -> clean -> ``<cleaned_path>/pickup_month=.../load=<batch>``. With
    ``summaries`` each batch adds its quantile summaries there (``operators.sketches``)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    new = fill_constants(valid_trips(with_duration(first_arrivals(spark, conformed, memory, max_files)), passenger_policy))
    new = new.drop(ARRIVED).withColumn(MONTH, F.date_format(PICKUP, "yyyy-MM"))

    def batch(df, epoch):
        # a batch that is run again writes the same months of the same load
        (df.withColumn(LOAD, F.lit(f"{epoch:09d}")).hint("rebalance", MONTH).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy(MONTH, LOAD).parquet(cleaned_path))
        written = glob_paths(spark, f"{cleaned_path.rstrip('/')}/{MONTH}=*/{LOAD}={epoch:09d}")
        if summaries and written:
            rows = spark.read.parquet(*written)
            sketches.add(sketches.quantile_summary(rows, CAP_COLUMNS, f"{epoch:09d}"), summaries)

    q = new.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _trigger(q, trigger).start()


def read_cleaned(spark: SparkSession, cleaned_path: str) -> DataFrame:
    """The cleaned trips of all loads, with month and raw key."""
    return spark.read.parquet(cleaned_path).drop(LOAD)


def ingest(spark: SparkSession, source: str, work: str, cleaned_path: str, **options) -> dict[str, int]:
    """Both streams over what is there now; state rows and input rows of the last batches."""
    conform_stream(spark, source, f"{work}/conformed", f"{work}/chk-conform").awaitTermination()
    q = keyed_stream(spark, f"{work}/conformed", cleaned_path, f"{work}/chk-keyed", **options)
    q.awaitTermination()
    last = [p for p in q.recentProgress if p["numInputRows"]]
    return {"input_rows": sum(p["numInputRows"] for p in last),
            "new_keys": sum(s["numRowsUpdated"] for p in last for s in p["stateOperators"]),
            "known_keys": max((s["numRowsTotal"] for p in last for s in p["stateOperators"]), default=0)}
