"""Incremental arrival as Structured Streaming (SRC4-SRC6, PL6).

The file source's checkpoint replaces marker files: every trip file is
processed exactly once, an empty poll does nothing, and a retry resumes from
the last committed batch. The stream carries file names; each micro-batch reads
its files (columns and types may differ from month to month), cleans them and
appends to the month-partitioned cleaned table what is not there yet. A trip is
known by a hash of its raw row, so trips that only the fills make alike stay
apart, as in the batch job, and a batch that is run again adds nothing. Only the
hashes of the touched months are read back; ``compact`` merges small files apart
from the stream. Caps and star keys are global to the table, so they are applied
when the star is built from the table, not per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.clean import dedupe, fill_constants, valid_trips, with_duration
from tripmart.operators.keys import RAW_KEY, with_raw_key
from tripmart.schema import DURATION, PICKUP
from tripmart.session import has_data
from tripmart.sources.files import read_files, trip_glob

MONTH = "pickup_month"
FILES = "path string, modificationTime timestamp, length long, content binary"


def trip_file_stream(spark: SparkSession, source: str, max_files: int | None = None) -> DataFrame:
    """SRC4 (stream): paths of new trip files by name pattern; the contents are pruned."""
    r = spark.readStream.format("binaryFile").schema(FILES)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(trip_glob(source)).select("path")


def _trigger(writer, trigger: str):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)      # e.g. "15 minutes" (SRC6)


def upsert_cleaned(raw: DataFrame, cleaned_path: str, passenger_policy: str = "drop") -> None:
    """Add one batch of raw trips to the month-partitioned cleaned table."""
    spark = raw.sparkSession
    month = F.date_format(PICKUP, "yyyy-MM")
    valid = valid_trips(with_duration(raw), passenger_policy)
    months = [r[0] for r in valid.select(month).distinct().collect()]     # bounded by the calendar
    if not months:
        return
    new = valid_trips(with_duration(dedupe(raw)), passenger_policy).drop(DURATION)
    if has_data(spark, cleaned_path):
        # the files are listed here: those that this batch appends are not among them
        known = spark.read.parquet(cleaned_path).where(F.col(MONTH).isin(months)).select(*RAW_KEY)
        new = with_raw_key(new).join(known, RAW_KEY, "left_anti").drop(*RAW_KEY)
    # keys and duration follow from the raw row: they are added behind the shuffle by month
    dealt = new.withColumn(MONTH, month).hint("rebalance", MONTH)
    out = fill_constants(with_duration(with_raw_key(dealt)))
    out.write.mode("append").partitionBy(MONTH).parquet(cleaned_path)


def compact(spark: SparkSession, cleaned_path: str, months: list[str]) -> None:
    """Rewrite months that many small batches have touched; run between batches."""
    from tripmart.plans.jobs import stage

    rows = stage(spark.read.parquet(cleaned_path).where(F.col(MONTH).isin(months)), "compact")
    (rows.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(MONTH).parquet(cleaned_path))


def clean_stream(spark: SparkSession, source: str, cleaned_path: str, checkpoint: str,
                 trigger: str = "availableNow", max_files: int | None = None):
    """PL6 (stream): trip files -> clean -> upsert, one micro-batch at a time."""
    def batch(df, _epoch):
        paths = [r.path for r in df.collect()]         # file names of one trigger
        if paths:
            upsert_cleaned(read_files(df.sparkSession, paths), cleaned_path)

    q = (trip_file_stream(spark, source, max_files).writeStream
         .foreachBatch(batch).option("checkpointLocation", checkpoint))
    return _trigger(q, trigger).start()
