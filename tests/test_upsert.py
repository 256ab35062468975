"""The stateless upsert: one write a batch, each trip once."""
import datetime as dt

from pyspark.sql import functions as F

from conftest import raw_frame, trip
from tripmart.operators.clean import clean_prefix
from tripmart.operators.keys import RAW_KEY, with_raw_key
from tripmart.session import ensure_checkpoint_dir, glob_paths
from tripmart.sources import files as FS
from tripmart.streaming import ingest as ST


def _day(d, month=1, **kw):
    t = dt.datetime(2025, month, d, 10)
    return trip(tpep_pickup_datetime=t, tpep_dropoff_datetime=t + dt.timedelta(minutes=20), **kw)


def test_a_batch_is_written_once(spark, tmp_path):
    table = str(tmp_path / "cleaned")
    first = [_day(1), _day(1), _day(2, tolls_amount=None), _day(3, fare_amount=-1.0)]
    second = [_day(1), _day(2), _day(4), _day(5, month=2), _day(5, month=2)]
    work = f"{ensure_checkpoint_dir(spark)}/*"
    before = glob_paths(spark, work)
    for rows in (first, second, second, [_day(6, trip_distance=0.0)]):
        ST.upsert_cleaned(raw_frame(spark, rows), table)
    assert glob_paths(spark, work) == before                       # no copy of the batch beside the table
    got = spark.read.parquet(table)
    want = clean_prefix(raw_frame(spark, first + second))
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and got.count() == 5
    # the keys are those of the raw rows, not of the filled ones
    keys = with_raw_key(raw_frame(spark, first + second).distinct()).select(*RAW_KEY)
    assert got.select(*RAW_KEY).exceptAll(keys).count() == 0


def test_trip_files_in_two_parts(spark, tmp_path):
    rows = raw_frame(spark, [_day(d, month=m) for m in (1, 2) for d in (1, 2, 3, 4)]).withColumn("_half", F.dayofmonth("tpep_pickup_datetime") % 2)
    names = FS.write_trip_files(rows, str(tmp_path / "files"), split="_half")
    assert names == ["yellow_tripdata_2025-01.parquet", "yellow_tripdata_2025-02.parquet"]
    for n in names:
        for half in (0, 1):
            part = spark.read.parquet(str(tmp_path / "files" / n / f"_half={half}"))
            assert sorted(r[0] for r in part.select(F.dayofmonth("tpep_pickup_datetime")).collect()) == [2 - half, 4 - half]
