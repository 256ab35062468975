"""Clustered layout, cubes kept up to date, event-time windows."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripmart.operators import cubes as CB
from tripmart.operators import mart as M
from tripmart.operators import star as S
from tripmart.plans import jobs as P
from tripmart.schema import DROPOFF, PICKUP, RAW
from tripmart.sources import layout as L
from tripmart.sources.tables import trips, zones
from tripmart.streaming import demand as D


# --- layout

def test_interleaved_bits(spark):
    df = spark.createDataFrame([(5, 3), (0, 7), (7, 0)], "a int, b int").select(L.interleaved([F.col("a"), F.col("b")], 3).alias("z"))
    assert [r.z for r in df.collect()] == [0b100111, 0b010101, 0b101010]


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "t")
    rows = P.stage(spark.range(40_000).select(
        (F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 13) % 525_600)).alias("t"),
        F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") * 31) % 265).cast("int").alias("zone"), F.col("id")), "rows")
    L.write_clustered(rows, path, ["t", "zone"], 64)
    return path, rows


def test_slices_read_few_files_and_miss_nothing(spark, clustered):
    path, rows = clustered
    week = (F.lit(dt.datetime(2025, 3, 3)).cast("timestamp_ntz"), F.lit(dt.datetime(2025, 3, 10)).cast("timestamp_ntz"))
    for ranges, share in (({"t": week, "zone": (200, 200)}, 0.1), ({"t": week}, 0.3), ({"zone": (200, 201)}, 0.4), ({"zone": (7, 7)}, 0.7)):
        files, of = L.files_of_slice(spark, path, ranges)
        assert of >= 32 and len(files) <= share * of, (ranges.keys(), len(files), of)
        got = L.read_slice(spark, path, ranges)
        want = rows.where(" and ".join("true" for _ in ranges))
        for c, (lo, hi) in ranges.items():
            want = want.where(F.col(c).between(F.lit(lo), F.lit(hi)))
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count() and want.count() > 0
        assert set(got.inputFiles()) <= {f.replace("file:///", "file:/") for f in files} | set(files) | {f.replace("file:/", "file:///") for f in files}
    assert L.read_slice(spark, path, {"zone": (900, 999)}).count() == 0
    sizes = [r.rows for r in spark.read.parquet(f"{path}/_index").collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 4 * 40_000 / len(sizes)            # a zone with a third of all rows is spread


def test_layout_of_nulls_and_constants(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (1, 2.0), (1, 3.0)], "a int, b double")
    L.write_clustered(rows, str(tmp_path / "t"), ["a", "b"], 2)
    assert L.read_slice(spark, str(tmp_path / "t"), {"a": (1, 1)}).count() == 3
    assert L.read_slice(spark, str(tmp_path / "t"), {"b": (2.5, 9.0)}).count() == 1


# --- cube

def test_cube_of_increments(spark, tmp_path):
    c = P.stage(P.clean_job(trips(spark, SF_SMALL), cap_mode="disc", trip_id=True), "clean")
    z, path = zones(spark, SF_SMALL), str(tmp_path / "cube")
    parts = [c.where(F.year(PICKUP) < 1994), c.where(F.year(PICKUP) >= 1994)]
    for load, rows in (("1", parts[0]), ("2", parts[1]), ("1", parts[0])):           # the first is run again
        CB.add_load(S.build_star(rows, z), path, load)
    want = {str(r.asDict()) for r in M.star_slice(S.build_star(c, z)).select(*CB.NAMES, "grouping_level", "trips", "revenue").collect()}
    got = lambda: {str(r.asDict()) for r in CB.merged(spark, path).select(*CB.NAMES, "grouping_level", "trips", "revenue").collect()}      # noqa: E731
    assert got() == want
    CB.compact(spark, path, "3")
    assert got() == want and spark.read.parquet(path).select("load").distinct().count() == 1


# --- demand

def _trips(spark, rows):
    return spark.createDataFrame([(dt.datetime(2025, 1, 1) + dt.timedelta(minutes=m), z, f) for m, z, f in rows], "t timestamp_ntz, z int, f double").select(
        *[{PICKUP: F.col("t"), DROPOFF: F.col("t"), "PULocationID": F.col("z"), "fare_amount": F.col("f")}.get(f.name, F.lit(None))
          .cast(f.dataType).alias(f.name) for f in RAW.fields])


def test_windows_are_final_and_late_trips_dropped(spark, tmp_path):
    source, out, chk = (str(tmp_path / x) for x in ("in", "out", "chk"))

    def arrive(n, rows):
        _trips(spark, rows).coalesce(1).write.parquet(f"{source}/load={n}")
        D.demand_stream(spark, source, out, chk).awaitTermination()
        return sorted((r.hour_start.hour, r.PULocationID, r.trips, float(r.fares)) for r in D.final_windows(spark, out).collect())

    assert arrive(1, [(10, 1, 5.0), (20, 1, 2.0), (70, 2, 1.0)]) == []                     # watermark 23:10 of the day before
    assert arrive(2, [(250, 1, 9.0)]) == [(0, 1, 2, 7.0), (1, 2, 1, 1.0)]                   # 02:10: hours 0 and 1 are over
    # hour 1 is final: dropped; hour 2 is late by less than the delay: counted
    assert arrive(3, [(80, 2, 3.0), (130, 3, 4.0)]) == [(0, 1, 2, 7.0), (1, 2, 1, 1.0)]
    assert arrive(4, [(10_000, 1, 1.0)]) == [(0, 1, 2, 7.0), (1, 2, 1, 1.0), (2, 3, 1, 4.0), (4, 1, 1, 9.0)]
