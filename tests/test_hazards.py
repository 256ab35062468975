"""Edge cases of the cleaning and star rules (hand-made frames, no oracle)."""
import datetime as dt
from decimal import Decimal

import pytest

from conftest import raw_frame, trip
from tripmart.operators import clean as C
from tripmart.operators import impute as I
from tripmart.operators import profile as PR
from tripmart.operators import quantiles as Q
from tripmart.operators import star as S
from tripmart.operators.keys import hash_key
from tripmart.plans import jobs as P


def test_dedupe_treats_null_as_equal(spark):
    rows = [trip(passenger_count=None, RatecodeID=None), trip(passenger_count=None, RatecodeID=None),
            trip(fare_amount=9.0)]
    assert C.dedupe(raw_frame(spark, rows)).count() == 2


def test_duration_ignores_dst_in_any_session_zone(spark):
    df = raw_frame(spark, [trip(tpep_pickup_datetime=dt.datetime(2025, 3, 9, 1, 30),
                                tpep_dropoff_datetime=dt.datetime(2025, 3, 9, 3, 30))])
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("America/New_York", "UTC", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert C.with_duration(df).first()["trip_duration_min"] == 120.0
            gap = raw_frame(spark, [trip(tpep_pickup_datetime=dt.datetime(2025, 3, 9, 2, 30),
                                         tpep_dropoff_datetime=dt.datetime(2025, 3, 9, 3, 30)),
                                    trip(tpep_pickup_datetime=dt.datetime(2025, 3, 9, 1, 30),
                                         tpep_dropoff_datetime=dt.datetime(2025, 3, 9, 2, 30))])
            assert [r[0] for r in C.with_duration(gap).select("trip_duration_min").collect()] == [60.0, 60.0]
            assert [r[0] for r in I.adaptive_duration(gap).select("trip_duration").collect()] == [60.0, 60.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_subsecond_whole_seconds_vs_fractional(spark):
    df = raw_frame(spark, [trip(tpep_pickup_datetime=dt.datetime(2025, 1, 1, 0, 0, 0),
                                tpep_dropoff_datetime=dt.datetime(2025, 1, 1, 0, 0, 1, 900000))])
    assert C.with_duration(df).first()["trip_duration_min"] == pytest.approx(1 / 60)
    assert I.adaptive_duration(df).first()["trip_duration"] == pytest.approx(1.9 / 60)


def test_nan_distance_is_invalid(spark):
    df = C.with_duration(raw_frame(spark, [trip(trip_distance=float("nan")), trip()]))
    assert C.valid_trips(df).count() == 1


def test_filters_name_a_computed_column_once(spark):
    """Pushed below the dedupe, a filter works its column out as often as it names it."""
    raw = raw_frame(spark, [trip(), trip(trip_distance=float("nan")), trip(tpep_dropoff_datetime=None), trip(fare_amount=None)])
    for df in (C.valid_trips(C.with_duration(C.dedupe(raw))), I.adaptive_valid(raw)):
        filters = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x]
        assert "\n".join(filters).count(" - tpep_pickup_datetime") == 1
        assert df.count() == 1


def test_adaptive_clean_writes_the_trips_once(spark, monkeypatch):
    """Fills by constants need no copy of their own; a forward fill, which joins, is still written."""
    names, whole = [], P.stage

    def seen(df, name="stage", observe=None):
        names.append(name)
        return whole(df, name, observe)
    monkeypatch.setattr(P, "stage", seen)
    rows = [trip(fare_amount=float(i), passenger_count=None if i == 3 else 1.0 + i) for i in range(1, 20)]
    out = I.adaptive_clean(raw_frame(spark, rows), mode="exact")
    assert sorted(r.passenger_count for r in out.collect())[9:12] == [11.5, 12.0, 13.0]
    assert out.agg({"fare_amount": "max"}).first()[0] == pytest.approx(18.82)
    assert [n for n in names if n.startswith("adaptive")] == ["adaptive"]
    names.clear()
    day = [dict(r, tpep_dropoff_datetime=None) if i == 4 else r for i, r in enumerate(rows)]
    frame = raw_frame(spark, day).withColumnRenamed("tpep_pickup_datetime", "begin")
    assert I.adaptive_clean(frame, order_by=["fare_amount"]).where("tpep_dropoff_datetime is null").count() == 0
    assert [n for n in names if n.startswith("adaptive")] == ["adaptive", "adaptive-filled"]


def test_later_quantile_passes_read_open_columns_only(spark, monkeypatch):
    plans, whole = [], P.stage

    def seen(df, name="stage", observe=None):
        if name == "digits":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return whole(df, name, observe)
    df = whole(spark.createDataFrame([(2.0, 1 + i / 7, None) for i in range(500)], "a double, b double, c double"))
    monkeypatch.setattr(P, "stage", seen)
    got = Q.quantile_values(df, ["a", "b", "c"], [0.5], "exact")
    assert got == {"a": [2.0], "b": [pytest.approx(1 + 249.5 / 7)], "c": [None]}
    assert "AS c0" in plans[0] and len(plans) > 1 and all("AS c1" in p and "AS c0" not in p and "AS c2" not in p for p in plans[1:])


def test_all_invalid_input_caps_nothing(spark):
    df = raw_frame(spark, [trip(fare_amount=-1.0), trip(trip_distance=0.0)])
    out = P.clean_job(df, cap_mode="disc")
    assert out.count() == 0
    assert Q.thresholds(df.where("false"), ["fare_amount"], 0.99, "disc") == {"fare_amount": None}


def test_fill_skips_absent_column(spark):
    df = raw_frame(spark, [trip(congestion_surcharge=None)]).drop("cbd_congestion_fee")
    out = C.fill_constants(df)
    assert out.first()["congestion_surcharge"] == 0.0
    assert "cbd_congestion_fee" not in out.columns


def test_unmapped_codes_give_null_labels_and_null_keys_drop(spark):
    rows = [trip(payment_type=0, RatecodeID=99.0), trip(payment_type=1, RatecodeID=None),
            trip(payment_type=2, RatecodeID=2.0)]
    clean = C.cast_int_columns(C.fill_constants(C.with_duration(raw_frame(spark, rows))))
    pay = {r.payment_id: r.payment_desc for r in S.dim_payment(clean).collect()}
    assert pay == {0: None, 1: "Credit Card", 2: "Cash"}
    rate = {r.rate_id: r.rate_desc for r in S.dim_rate(clean).collect()}
    assert rate == {99: None, 2: "JFK"}


def test_shared_pair_one_dimension_row_no_fanout(spark):
    p = dt.datetime(2025, 1, 2, 8, 0)
    rows = [trip(tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(minutes=10)),
            trip(tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(minutes=10), fare_amount=20.0),
            trip(tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(minutes=30))]
    clean = C.cast_int_columns(C.with_duration(raw_frame(spark, rows)))
    dim = S.dim_datetime(clean)
    assert sorted(r.datetime_id for r in dim.collect()) == [1, 2]
    fact = S.fact_trip(clean, dim)
    assert fact.count() == 3 and fact.where("datetime_id IS NULL").count() == 0


def test_vendor_representative_is_deterministic(spark):
    t0 = dt.datetime(2025, 1, 1, 9, 0)
    rows = [trip(store_and_fwd_flag="Y", tpep_pickup_datetime=t0),
            trip(store_and_fwd_flag="N", tpep_pickup_datetime=t0),
            trip(store_and_fwd_flag="Y", tpep_pickup_datetime=t0 - dt.timedelta(hours=1),
                 VendorID=2)]
    clean = C.cast_int_columns(C.with_duration(raw_frame(spark, rows)))
    got = {r.vendor_id: r.store_fwd_flag for r in S.dim_vendor(clean).collect()}
    assert got == {1: "N", 2: "Y"}      # tie at the same pickup -> lowest value


def test_decimal_overflow_raises_or_rejects(spark):
    clean = C.cast_int_columns(C.with_duration(raw_frame(spark, [trip(fare_amount=1e9)])))
    with pytest.raises(Exception):
        S.fact_trip(clean, key_mode="hash").collect()
    row = S.fact_trip(clean, key_mode="hash", money_mode="try").first()
    assert row["fare_amount"] is None and row["extra"] == Decimal("0.50")


def test_hash_key_separates_swapped_nulls(spark):
    rows = [trip(congestion_surcharge=None, Airport_fee=1.75), trip(congestion_surcharge=1.75, Airport_fee=None)]
    df = raw_frame(spark, rows).select(hash_key("congestion_surcharge", "Airport_fee").alias("k"))
    assert df.distinct().count() == 2


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, float(i), float(i * 2 + 1)) for i in range(10)], "c double, x double, y double")
    got = {(r.column_a, r.column_b): r.corr for r in PR.correlation_matrix(df).collect()}
    assert got[("c", "x")] is None and got[("c", "c")] is None
    assert got[("x", "y")] == 1.0 and got[("x", "x")] == 1.0


def test_even_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (4.0,), (10.0,)], "v double")
    assert Q.quantile_values(df, ["v"], [0.5], "exact")["v"] == [3.0]


def test_mode_tie_takes_lowest(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), (None,)], "s string")
    assert I.column_mode(df, "s") == "a"


def test_null_share_picks_median_or_zero(spark):
    rows = [(None if i == 0 else float(i), None if i < 2 else float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "a double, b double")
    rules = I.fill_rules(df, I.null_ratios(df))
    assert rules == {"a": "median", "b": "zero"}
    out = {(r.a, r.b) for r in I.adaptive_fill(df).collect()}
    assert (5.0, 0.0) in out and (1.0, 0.0) in out and len(out) == 10


def test_csv_round_trip_keeps_nulls_and_newlines(spark, tmp_path):
    from tripmart.sources.files import read_star_csv
    from tripmart.sources.sinks import write_star_csv
    rows = [(1, None, "two\nlines", None), (2, "Queens", "JFK, \"T4\"", None)]
    df = spark.createDataFrame(rows + [(3, "", "x", None)],
                               "location_id int, borough string, zone string, service_zone string")
    path = str(tmp_path / "loc")
    write_star_csv(df, path, "DIM_LOCATION")
    back = sorted(read_star_csv(spark, path, "DIM_LOCATION").collect())
    # NULL and quoted newlines / quotes survive; an empty string reads back as NULL (H10)
    assert [tuple(r) for r in back] == rows + [(3, None, "x", None)]


def test_landing_files_validation_and_idempotent_land(spark, tmp_path):
    from tripmart.sources import files as FS
    src, raw = str(tmp_path / "src"), str(tmp_path / "raw")
    df = raw_frame(spark, [trip(), trip(tpep_pickup_datetime=dt.datetime(2025, 2, 3, 1, 0),
                                        tpep_dropoff_datetime=dt.datetime(2025, 2, 3, 1, 9))])
    names = FS.write_trip_files(df, src)
    assert names == ["yellow_tripdata_2025-01.parquet", "yellow_tripdata_2025-02.parquet"]
    df.limit(1).write.parquet(str(tmp_path / "src" / "notes"))      # wrong pattern, ignored
    FS.write_trip_files(df.limit(1), src, colour="green")           # other colour (H14)
    m = {r.file_name: (r.colour, r.period, r.valid_name) for r in FS.manifest(spark, src).collect()}
    assert m["yellow_tripdata_2025-02.parquet"] == ("yellow", "2025-02", True)
    assert m["notes"][2] is False and m["green_tripdata_2025-01.parquet"][0] == "green"
    assert FS.read_trips(spark, src).count() == 2                   # yellow files only
    assert FS.validate_landing(spark, src).count() == 2
    with pytest.raises(ValueError):
        FS.validate_landing(spark, src, min_files=3)
    assert FS.validate_landing(spark, src, period="2025-02").count() == 2
    with pytest.raises(ValueError):
        FS.validate_landing(spark, src, period="2025-03")          # run month not landed
    assert FS.land(spark, src, raw) == {"uploaded": 2, "skipped": 0, "failed": 0}
    assert FS.land(spark, src, raw) == {"uploaded": 0, "skipped": 2, "failed": 0}
    assert FS.validate_landing(spark, raw).count() == 2             # the raw zone can be read on
    assert FS.read_trips(spark, raw).count() == 2
    broken = tmp_path / "src" / "yellow_tripdata_2025-04.parquet"
    broken.write_bytes(b"not a Parquet file")
    assert FS.land(spark, src, raw) == {"uploaded": 0, "skipped": 2, "failed": 1}
    assert FS.read_trips(spark, raw).count() == 2                   # nothing of it is seen


def test_load_file_and_as_frame(spark, tmp_path):
    from pyspark.errors import AnalysisException

    from tripmart.sources.files import as_frame, load_file
    with pytest.raises(AnalysisException):
        load_file(spark, str(tmp_path / "nope.parquet")).count()
    df = raw_frame(spark, [trip()])
    assert as_frame(spark, df) is df
    path = str(tmp_path / "one.parquet")
    df.write.parquet(path)
    assert as_frame(spark, path).count() == 1
    with pytest.raises(TypeError):
        as_frame(spark, 42)


def test_new_files_modified_after(spark, tmp_path):
    import os
    import time

    from tripmart.sources import files as FS
    src = str(tmp_path / "src")
    FS.write_trip_files(raw_frame(spark, [trip()]), src)
    old = time.time() - 3600
    for root, _, names in os.walk(src):
        for n in names:
            os.utime(os.path.join(root, n), (old, old))
    cut = time.strftime("%Y-%m-%dT%H:%M:%S", time.localtime(time.time() - 60))
    FS.write_trip_files(raw_frame(spark, [trip(tpep_pickup_datetime=dt.datetime(2025, 5, 1, 8, 0),
                                               tpep_dropoff_datetime=dt.datetime(2025, 5, 1, 8, 30))]), src)
    assert FS.new_files(spark, src).count() == 2
    got = [r.source_file for r in FS.new_files(spark, src, modified_after=cut).select("source_file").collect()]
    assert got == ["yellow_tripdata_2025-05.parquet"]


def test_quality_label_high_for_clean_data(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, s string")
    row = PR.quality(df).first()
    assert row["quality_label"] == "High" and row["quality_pct"] == 100.0
    dup = spark.createDataFrame([(1, "a"), (1, "a")], "x int, s string")
    assert PR.quality(dup).first()["quality_label"] == "Needs Cleaning"


def test_adaptive_fill_forward_fills_timestamps(spark):
    rows = [(1, dt.datetime(2025, 1, 1, 0, 0), 1.0), (2, None, 2.0), (3, None, 3.0),
            (4, dt.datetime(2025, 1, 2, 0, 0), 4.0)]
    df = spark.createDataFrame(rows, "id int, t timestamp_ntz, v double")
    assert I.fill_rules(df, I.null_ratios(df))["t"] == "ffill"
    out = {r.id: r.t for r in I.adaptive_fill(df, order_by=["id"]).collect()}
    assert out[2] == out[3] == dt.datetime(2025, 1, 1, 0, 0)


def test_constant_not_exact_in_binary_has_no_correlation(spark):
    df = spark.range(1000).repartition(5).selectExpr("0.3D as c", "cast(id * 7 % 13 as double) as x")
    got = {(r.column_a, r.column_b): r.corr for r in PR.correlation_matrix(df).collect()}
    assert got[("c", "c")] is None and got[("c", "x")] is None and got[("x", "c")] is None and got[("x", "x")] == 1.0


def test_fill_order_must_be_whole(spark):
    df = raw_frame(spark, [trip(), trip(tpep_pickup_datetime=None), trip(tpep_pickup_datetime=dt.datetime(2025, 1, 3))])
    with pytest.raises(ValueError, match="order by"):
        I.adaptive_fill(df)
    out = I.adaptive_fill(df, order_by=["tpep_dropoff_datetime"])
    assert out.where("tpep_pickup_datetime is null").count() == 0


def test_quantiles_leave_nan_out_in_every_mode(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(float("nan"),)] * 20 + [(None,)], "v double").repartition(4)
    for mode, want in (("disc", 94.0), ("exact", 94.05), ("approx", 94.0)):
        assert Q.thresholds(df, ["v"], 0.95, mode, 0)["v"] == pytest.approx(want)


def test_adaptive_clean_without_a_column(spark):
    rows = [trip(fare_amount=float(i), store_and_fwd_flag=None if i % 2 else "N") for i in range(1, 20)]
    out = I.adaptive_clean(raw_frame(spark, rows).drop("trip_distance", "cbd_congestion_fee"))
    assert out.count() == 19 and "trip_distance" not in out.columns
    assert I.adaptive_clean(raw_frame(spark, rows).drop("fare_amount")).count() == 2


def test_fills_do_not_merge_trips_of_the_stream(spark, tmp_path):
    """Raw trips that only the fills make alike stay two, also after the month is touched again."""
    from tripmart.sources import files as FS
    from tripmart.streaming import ingest as ST
    landing, cleaned, ck = str(tmp_path / "l"), str(tmp_path / "c"), str(tmp_path / "ck")
    for i, rows in enumerate(([trip(Airport_fee=None), trip(Airport_fee=0.0)], [trip(fare_amount=33.0), trip(Airport_fee=0.0)])):
        FS.write_trip_files(raw_frame(spark, rows), str(tmp_path / f"s{i}"))
        import os
        os.makedirs(f"{landing}/yellow_tripdata_2025-01.parquet", exist_ok=True)
        for f in os.listdir(tmp_path / f"s{i}" / "yellow_tripdata_2025-01.parquet"):
            if f.startswith("part-"):
                os.rename(tmp_path / f"s{i}" / "yellow_tripdata_2025-01.parquet" / f,
                          f"{landing}/yellow_tripdata_2025-01.parquet/{f}")
        ST.clean_stream(spark, landing, cleaned, ck).awaitTermination()
    assert spark.read.parquet(cleaned).count() == 3
    ST.compact(spark, cleaned, ["2025-01"])
    assert spark.read.parquet(cleaned).count() == 3


def test_rerun_removes_stale_months(spark, tmp_path):
    from tripmart.sources.sinks import write_cleaned
    feb = trip(tpep_pickup_datetime=dt.datetime(2025, 2, 3, 1, 0), tpep_dropoff_datetime=dt.datetime(2025, 2, 3, 1, 9))
    path = str(tmp_path / "c")
    write_cleaned(raw_frame(spark, [trip(), feb]), path)
    write_cleaned(raw_frame(spark, [feb]), path)
    assert [r.pickup_month for r in spark.read.parquet(path).collect()] == ["2025-02"]


def test_no_machine_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from tripmart.session import ensure_checkpoint_dir
    sc = SimpleNamespace(master="spark://head:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)


def test_months_of_other_types_are_cast(spark, tmp_path):
    from tripmart.sources import files as FS
    from tripmart.streaming import ingest as ST
    src = str(tmp_path / "src")
    feb = trip(tpep_pickup_datetime=dt.datetime(2025, 2, 3, 1, 0), tpep_dropoff_datetime=dt.datetime(2025, 2, 3, 1, 9))
    FS.write_trip_files(raw_frame(spark, [trip()]), src)
    FS.write_trip_files(raw_frame(spark, [feb]).withColumnRenamed("Airport_fee", "airport_fee")
                        .selectExpr("* except (passenger_count, VendorID)", "2L as passenger_count", "7L as VendorID"), src)
    assert sorted((r.VendorID, r.passenger_count, r.Airport_fee) for r in FS.read_trips(spark, src).collect()) == [
        (1, 1.0, 0.0), (7, 2.0, 0.0)]
    ST.clean_stream(spark, src, str(tmp_path / "c"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2
