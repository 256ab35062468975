"""Ids over three dealings: only rows that share an id with others of their dealing are deduped, and no wrong id is missed."""
import datetime as dt

import pytest
from conftest import raw_frame, trip
from pyspark.sql import functions as F

from tripmart.operators import clean, keys
from tripmart.plans import catalog


@pytest.fixture
def rows(spark):
    start = dt.datetime(2025, 1, 1)
    made = [trip(tpep_pickup_datetime=start + dt.timedelta(minutes=i), VendorID=i % 7, fare_amount=None if i % 5 == 0 else float(i)) for i in range(200)]
    return raw_frame(spark, made + made[:20] + made[:3] + [{}, {}])


def told(spark):
    return [tuple(r) for r in catalog.QUERIES["trip_id_stability"](spark, "").collect()]


def test_rows_with_an_id_of_their_own_are_not_moved_again(spark, rows, monkeypatch):
    given, whole = [], clean.dedupe
    monkeypatch.setattr(catalog, "trips", lambda *a: rows)
    monkeypatch.setattr(clean, "dedupe", lambda df: given.append(df) or whole(df))
    assert told(spark) == [(0, 0)]
    # 45 rows are copies or have some; the bit map lets few others through
    assert len(given) == 3 and all(45 <= df.count() < 60 for df in given)


def test_repeated_and_missing_ids_are_told(spark, rows, monkeypatch):
    calls = []

    def dealt(*a):
        calls.append(1)
        return rows.filter(F.col("fare_amount").isNull() | (F.col("fare_amount") != 77)) if len(calls) == 2 else rows

    monkeypatch.setattr(catalog, "trips", dealt)
    assert told(spark) == [(1, 0)]
    monkeypatch.setattr(catalog, "trips", lambda *a: rows)
    monkeypatch.setattr(keys, "hash_key", lambda *cols: F.xxhash64("VendorID"))
    assert told(spark) == [(0, 7)]


def test_a_full_map_loses_no_key(spark, monkeypatch):
    df = spark.range(3000).select(F.xxhash64("id").alias("k"), "id")
    some = df.filter("id % 10 = 0").select("k")
    assert 300 <= keys.perhaps_in(df, some, "k").count() < 330
    monkeypatch.setattr(keys, "MAP_BITS", 6)
    assert keys.perhaps_in(df, some, "k").count() == 3000
