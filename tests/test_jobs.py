"""Job entry points end to end on sf0.001: land -> clean -> star -> load."""
import pytest

from conftest import SF_SMALL
from tripmart.operators.checks import star_checks
from tripmart.plans import jobs as P
from tripmart.sources import files as FS
from tripmart.sources import sinks as SK
from tripmart.sources.tables import trips, zones


def test_run_clean_counts_and_month_partitions(spark, tmp_path):
    out = str(tmp_path / "cleaned")
    counts = P.run_clean(trips(spark, SF_SMALL), out, cap_mode="disc")
    assert counts == {"raw_rows": 6116, "cleaned_rows": 4402}
    back = spark.read.parquet(out)
    assert back.count() == 4402 and "pickup_month" in back.columns
    assert back.select("trip_id").distinct().count() == 4402


def test_run_all_commits_checked_star(spark, tmp_path):
    landing, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    FS.write_trip_files(trips(spark, SF_SMALL), landing)
    run = P.run_all(spark, landing, wh, zones(spark, SF_SMALL), cap_mode="disc")
    assert SK.committed_run(spark, wh) == run
    star = {t: SK.read_warehouse(spark, wh, t) for t in SK.STAR_ORDER}
    assert star["FACT_TRIP"].count() == 4402
    assert star_checks(star).where("violations > 0").count() == 0
    run2 = P.run_all(spark, landing, wh, zones(spark, SF_SMALL), cap_mode="disc")
    assert run2 > run and SK.committed_run(spark, wh) == run2     # rerun: new version, no doubling
    assert SK.read_warehouse(spark, wh, "FACT_TRIP").count() == 4402


def test_failed_check_leaves_no_commit(spark, tmp_path):
    from pyspark.sql import functions as F
    wh = str(tmp_path / "wh")
    clean = P.clean_job(trips(spark, SF_SMALL), cap_mode="disc", trip_id=True)
    from tripmart.operators.star import build_star
    star = build_star(clean)
    star["DIM_VENDOR"] = star["DIM_VENDOR"].unionByName(star["DIM_VENDOR"])   # duplicate keys
    with pytest.raises(ValueError):
        SK.load_warehouse(star, wh, check=lambda t: star_checks(t))
    with pytest.raises(Exception):
        SK.committed_run(spark, wh)
    assert F is not None


def test_read_trips_tolerates_missing_column(spark, tmp_path):
    from pyspark.sql import functions as F
    src = str(tmp_path / "src")
    t = trips(spark, SF_SMALL)
    month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    jan, feb = t.where(month == "1995-01"), t.where(month == "1995-02")
    FS.write_trip_files(jan.drop("cbd_congestion_fee"), src)      # an older schema
    FS.write_trip_files(feb, src)
    df = FS.read_trips(spark, src)
    assert df.count() == jan.count() + feb.count()
    assert df.where("cbd_congestion_fee IS NULL").count() == jan.count() > 0


def test_stream_table_to_star(spark, tmp_path):
    """Arrival -> uncapped cleaned table -> star with caps applied at build."""
    from tripmart.streaming import ingest as ST
    import os
    landing, cleaned, ck = str(tmp_path / "l"), str(tmp_path / "c"), str(tmp_path / "ck")
    os.makedirs(cleaned)                      # an existing, empty target folder
    FS.write_trip_files(trips(spark, SF_SMALL), landing)
    ST.clean_stream(spark, landing, cleaned, ck).awaitTermination()
    star = P.star_from_cleaned_table(spark, cleaned, cap_mode="disc")
    batch = P.clean_job(trips(spark, SF_SMALL), cap_mode="disc")
    assert star["FACT_TRIP"].count() == batch.count() == 4402
    caps = star["CAPS"].first()
    assert caps["rows"] == 4402
    assert batch.agg({"fare_amount": "max"}).first()[0] == caps["cap_fare_amount"]
    assert star_checks({k: v for k, v in star.items() if k != "CAPS"}).where("violations > 0").count() == 0


def test_reject_rows_and_parse(spark):
    import datetime as dt

    from conftest import raw_frame, trip
    from tripmart.functions.scalar import parse_timestamps
    from tripmart.operators import clean as C
    from tripmart.operators.star import fact_rejects
    clean = C.cast_int_columns(C.with_duration(raw_frame(spark, [trip(fare_amount=1e9), trip()])))
    assert fact_rejects(clean).count() == 1
    df = spark.createDataFrame([("2025-01-02 03:04:05",)], "t string")
    assert parse_timestamps(df, ["t"]).first()["t"] == dt.datetime(2025, 1, 2, 3, 4, 5)


def test_stream_merges_same_month_across_batches(spark, tmp_path):
    """Part files of one month arrive in two batches, with rows repeated
    across them: the cleaned table holds each trip once."""
    import datetime as dt
    import glob
    import os
    import shutil

    from conftest import raw_frame, trip
    from tripmart.streaming import ingest as ST
    jan = [trip(tpep_pickup_datetime=dt.datetime(2025, 1, d, 9, 0),
                tpep_dropoff_datetime=dt.datetime(2025, 1, d, 9, 25), fare_amount=10.0 + d)
           for d in range(1, 9)]
    first, second = jan[:5], jan[3:]                  # days 4 and 5 arrive twice
    landing, cleaned, ck = str(tmp_path / "l"), str(tmp_path / "c"), str(tmp_path / "ck")
    month = "yellow_tripdata_2025-01.parquet"
    for i, rows in enumerate((first, second)):
        stage = str(tmp_path / f"s{i}")
        FS.write_trip_files(raw_frame(spark, rows), stage)
        os.makedirs(f"{landing}/{month}", exist_ok=True)
        for f in glob.glob(f"{stage}/{month}/part-*.parquet"):
            shutil.move(f, f"{landing}/{month}/b{i}-{os.path.basename(f)}")
        ST.clean_stream(spark, landing, cleaned, ck).awaitTermination()
    out = spark.read.parquet(cleaned)
    assert out.count() == 8 and out.distinct().count() == 8


def test_cleaned_table_prunes_months_and_columns(spark, tmp_path):
    """Readers of the cleaned table scan only the months and columns they use."""
    from pyspark.sql import functions as F

    from tripmart.operators import mart as M
    out = str(tmp_path / "cleaned")
    P.run_clean(trips(spark, SF_SMALL), out, cap_mode="disc")
    df = spark.read.parquet(out).where(F.col("pickup_month") == "1995-01")
    q = M.peak_hour(df)
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        q._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(pickup_month" in plan and "1995-01" in plan
    read_schema = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert read_schema == ["ReadSchema: struct<tpep_pickup_datetime:timestamp_ntz>"]
    assert q.agg(F.sum("trips")).first()[0] == df.count()


def test_recurring_trigger_picks_up_new_files(spark, tmp_path):
    """SRC6: a processing-time trigger keeps polling; a file landing while
    the query runs is cleaned in a later micro-batch, exactly once."""
    import datetime as dt

    from conftest import raw_frame, trip
    from tripmart.streaming import ingest as ST
    landing, cleaned, ck = str(tmp_path / "l"), str(tmp_path / "c"), str(tmp_path / "ck")
    FS.write_trip_files(raw_frame(spark, [trip()]), landing)
    q = ST.clean_stream(spark, landing, cleaned, ck, trigger="1 second")
    try:
        q.processAllAvailable()
        assert spark.read.parquet(cleaned).count() == 1
        FS.write_trip_files(raw_frame(spark, [trip(tpep_pickup_datetime=dt.datetime(2025, 3, 1, 7, 0),
                                                   tpep_dropoff_datetime=dt.datetime(2025, 3, 1, 7, 40))]),
                            landing)
        q.processAllAvailable()
        assert spark.read.parquet(cleaned).count() == 2
        q.processAllAvailable()                                   # idle polls change nothing
        assert spark.read.parquet(cleaned).count() == 2
    finally:
        q.stop()


def test_run_star_parquet_and_failed_write_surfaces(spark, tmp_path):
    from pyspark.sql import functions as F
    clean = P.clean_job(trips(spark, SF_SMALL), cap_mode="disc", trip_id=True)
    paths = P.run_star(clean, str(tmp_path / "star"), csv=False)
    assert spark.read.parquet(paths["FACT_TRIP"]).count() == 4402
    assert spark.read.parquet(paths["DIM_PAYMENT"]).count() == 7
    bad = spark.range(3).select(F.raise_error(F.lit("boom")).alias("x"))
    with pytest.raises(Exception):
        P.stage_all({"OK": spark.range(3), "BAD": bad})
