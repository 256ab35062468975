"""Registered queries: a Spark plan and (where SQL can say it) a DuckDB oracle.

Every query starts from the driver tables in ``sf_dir`` and runs over all of
them. ``register`` keeps the Spark callable and the oracle text side by side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import clean as C
from tripmart.plans import oracle as O
from tripmart.plans import jobs as P
from tripmart.schema import CAP_COLUMNS
from tripmart.sources.tables import trips

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """PL1 with exact discrete caps: the input of star and mart queries."""
    return P.clean_job(trips(spark, sf), cap_mode="disc")


def valid(spark: SparkSession, sf: str) -> DataFrame:
    """Deduped trips with duration that pass all four validity predicates."""
    return C.valid_trips(C.with_duration(C.dedupe(trips(spark, sf))))


# --- Clean: SET1, SET4, AGG1, PRJ1-PRJ5, IMP1-IMP2, AGG5-AGG6, PRJ8-PRJ9, PL1, PL3

@register("dedup_rows", O.with_steps("trips", "dedup") + "SELECT * FROM dedup")
def q_dedup_rows(spark, sf):
    return C.dedupe(trips(spark, sf))


@register("dedup_count", O.with_steps("trips") + """
SELECT CAST(count(*) AS BIGINT) AS raw_rows,
       CAST((SELECT count(*) FROM (SELECT DISTINCT * FROM trips)) AS BIGINT) AS dedup_rows,
       CAST(20 AS INTEGER) AS columns FROM trips""")
def q_dedup_count(spark, sf):
    from tripmart.operators.profile import row_counts
    return row_counts(trips(spark, sf))


@register("duplicate_stats", O.with_steps("trips") + """
SELECT CAST(r - d AS BIGINT) AS duplicate_count,
       CAST(100 AS DOUBLE) * CAST(r - d AS DOUBLE) / CAST(r AS DOUBLE) AS duplicate_pct
FROM (SELECT count(*) AS r, (SELECT count(*) FROM (SELECT DISTINCT * FROM trips)) AS d FROM trips)""")
def q_duplicate_stats(spark, sf):
    from tripmart.operators.profile import duplicate_stats
    return duplicate_stats(trips(spark, sf))


@register("trip_duration", O.with_steps("trips", extra="""
dur_raw AS (SELECT *, CAST(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS DOUBLE)
            / CAST(60 AS DOUBLE) AS trip_duration_min FROM trips)""") + "SELECT * FROM dur_raw")
def q_trip_duration(spark, sf):
    return C.with_duration(trips(spark, sf))


@register("valid_trips", O.with_steps("trips", "dedup", "dur", "valid") + "SELECT * FROM valid")
def q_valid_trips(spark, sf):
    return valid(spark, sf)


@register("valid_trips_fill_policy",
          O.with_steps("trips", "dedup", "dur", "valid_fill") + "SELECT * FROM valid_fill")
def q_valid_trips_fill_policy(spark, sf):
    return C.valid_trips(C.with_duration(C.dedupe(trips(spark, sf))), passenger_policy="fill")


@register("fill_constants", O.with_steps("trips", "dedup", "dur", "valid", "filled")
          + "SELECT * FROM filled")
def q_fill_constants(spark, sf):
    return C.fill_constants(valid(spark, sf))


@register("cast_types", O.with_steps("trips", "dedup", "dur", "valid", "filled", extra=f"""
casted AS (SELECT * REPLACE ({O._INT_CAST}) FROM filled)""") + "SELECT * FROM casted")
def q_cast_types(spark, sf):
    return C.cast_int_columns(C.fill_constants(valid(spark, sf)))


def _capped(spark, sf, mode):
    from tripmart.operators import quantiles
    pre, limits = P.staged_caps(C.fill_constants(valid(spark, sf)), CAP_COLUMNS, mode, 1e-4, "cap-pre")
    return quantiles.cap(pre, limits)


@register("cap_disc", O.with_steps("trips", "dedup", "dur", "valid", "filled", "caps_disc", "capped")
          + "SELECT * FROM capped")
def q_cap_disc(spark, sf):
    return _capped(spark, sf, "disc")


@register("cap_exact", O.with_steps("trips", "dedup", "dur", "valid", "filled", extra=f"""
caps_cont AS ({O._caps('filled', O.CAP3, 'quantile_cont')}),
capped_cont AS (SELECT * REPLACE ({O._cap_replace(O.CAP3, 'caps_cont')}) FROM filled)""")
          + "SELECT * FROM capped_cont")
def q_cap_exact(spark, sf):
    return _capped(spark, sf, "exact")


@register("cap_approx")
def q_cap_approx(spark, sf):
    return _capped(spark, sf, "approx")


@register("clean_job", O.with_steps(*O.CLEAN) + "SELECT * FROM clean")
def q_clean_job(spark, sf):
    return cleaned(spark, sf)


@register("clean_job_early", O.with_steps("trips", "dedup", extra=f"""
dur_e AS (SELECT *, CAST(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS DOUBLE)
          / CAST(60 AS DOUBLE) AS trip_duration FROM dedup),
valid_e AS (SELECT * FROM dur_e WHERE {O._pos('trip_duration')} AND {O._pos('fare_amount')}
            AND {O._pos('trip_distance')}),
filled_e AS (SELECT * REPLACE (coalesce(fare_amount, CAST(0 AS DOUBLE)) AS fare_amount,
             coalesce(trip_distance, CAST(0 AS DOUBLE)) AS trip_distance,
             coalesce(passenger_count, CAST(1 AS DOUBLE)) AS passenger_count) FROM valid_e),
caps_e AS ({O._caps('filled_e', O.CAP2, 'quantile_disc')}),
capped_e AS (SELECT * REPLACE ({O._cap_replace(O.CAP2, 'caps_e')}) FROM filled_e)""")
          + "SELECT * FROM capped_e")
def q_clean_job_early(spark, sf):
    return P.clean_early(trips(spark, sf), cap_mode="disc")


# --- Mart: MA1 (flagship)

@register("peak_hour", O.with_steps("trips", "dedup", "dur", "valid") + """
SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour, CAST(count(*) AS BIGINT) AS trips
FROM valid GROUP BY 1""")
def q_peak_hour(spark, sf):
    from tripmart.operators.mart import peak_hour
    return peak_hour(valid(spark, sf))


# --- Star: ST1-ST6, SET2, SET3, FN2-FN5, JN1, JN2, CHK1-CHK4, PRJ5-PRJ7

from tripmart.operators import star as S  # noqa: E402
from tripmart.operators.checks import star_checks  # noqa: E402
from tripmart.sources.tables import zones  # noqa: E402


@register("dim_datetime", O.with_steps(*O.CLEAN, "dim_datetime") + "SELECT * FROM dim_datetime")
def q_dim_datetime(spark, sf):
    return S.dim_datetime(cleaned(spark, sf))


@register("dim_datetime_hash")
def q_dim_datetime_hash(spark, sf):
    return S.dim_datetime(cleaned(spark, sf), key_mode="hash")


@register("dim_location", O.with_steps(*O.CLEAN, "dim_location") + "SELECT * FROM dim_location")
def q_dim_location(spark, sf):
    return S.dim_location(cleaned(spark, sf))


@register("dim_location_zones", O.with_steps(*O.CLEAN, "dim_location", "zones", "dim_location_zones")
          + "SELECT * FROM dim_location_zones")
def q_dim_location_zones(spark, sf):
    return S.dim_location(cleaned(spark, sf), zones(spark, sf))


@register("dim_vendor", O.with_steps(*O.CLEAN, "dim_vendor") + "SELECT * FROM dim_vendor")
def q_dim_vendor(spark, sf):
    return S.dim_vendor(cleaned(spark, sf))


@register("dim_payment", O.with_steps(*O.CLEAN, "dim_payment") + "SELECT * FROM dim_payment")
def q_dim_payment(spark, sf):
    return S.dim_payment(cleaned(spark, sf))


@register("dim_rate", O.with_steps(*O.CLEAN, "dim_rate") + "SELECT * FROM dim_rate")
def q_dim_rate(spark, sf):
    return S.dim_rate(cleaned(spark, sf))


@register("fact_trip", O.with_steps(*O.STAR) + "SELECT * EXCLUDE (trip_id) FROM fact_trip")
def q_fact_trip(spark, sf):
    c = P.clean_job(trips(spark, sf), cap_mode="disc", trip_id=True)
    return S.fact_trip(c, S.dim_datetime(c)).drop("trip_id")


@register("star_checks", O.star_checks_sql())
def q_star_checks(spark, sf):
    """Checks run on the written star (each table computed once), as a load does."""
    c = P.clean_job(trips(spark, sf), cap_mode="disc", trip_id=True)
    star = P.stage_all(S.build_star(c))
    return star_checks(star, c)


# --- Profile: AGG2-AGG13, SRT1-SRT3, PRJ10, FN7 (over the raw trips)

from tripmart.operators import profile as PR  # noqa: E402

_T = O.with_steps("trips")


@register("column_profile", _T + f"SELECT * FROM {O.column_profile_sql()}")
def q_column_profile(spark, sf):
    return PR.column_profile(trips(spark, sf))


@register("missing_table", _T + f"""SELECT column_name, null_count AS missing_count,
  {O.sround('null_pct', 2)} AS missing_pct FROM {O.column_profile_sql()} WHERE null_count > 0""")
def q_missing_table(spark, sf):
    return PR.missing_table(trips(spark, sf))


@register("summary_stats", _T + f"SELECT * FROM {O.summary_sql()}")
def q_summary_stats(spark, sf):
    return PR.summary_stats(P.stage(trips(spark, sf), "profile-in"), mode="exact")


@register("head_rows", _T + O.head_rows_sql())
def q_head_rows(spark, sf):
    return PR.head_rows(trips(spark, sf))


@register("value_counts", _T + O.value_counts_sql())
def q_value_counts(spark, sf):
    return PR.value_counts(trips(spark, sf))


@register("distinct_counts", _T + O.distinct_counts_sql())
def q_distinct_counts(spark, sf):
    return PR.distinct_counts(trips(spark, sf))


@register("distinct_values", _T + O.distinct_values_sql())
def q_distinct_values(spark, sf):
    return PR.distinct_values(trips(spark, sf))


_corr_cte, _corr_sel = O.correlation_sql()


@register("correlation_matrix", O.with_steps("trips", extra=_corr_cte) + _corr_sel)
def q_correlation_matrix(spark, sf):
    return PR.correlation_matrix(P.stage(trips(spark, sf), "profile-in"))


@register("outlier_stats", _T + O.outlier_sql())
def q_outlier_stats(spark, sf):
    return PR.outlier_stats(P.stage(trips(spark, sf), "profile-in"), mode="exact")


@register("quality_score", _T + O.quality_sql())
def q_quality_score(spark, sf):
    return PR.quality(trips(spark, sf))


@register("full_report", _T + O.full_report_sql())
def q_full_report(spark, sf):
    return PR.full_report_long(P.stage(trips(spark, sf), "profile-in"), mode="exact")


# --- Mart: MA2-MA14 over the cleaned trips and the star

from tripmart.operators import mart as M  # noqa: E402

_C = O.with_steps(*O.CLEAN)
_P = "tpep_pickup_datetime"
_H = f"CAST(hour({_P}) AS INTEGER)"


@register("traffic_pattern", _C + f"""SELECT dayname({_P}) AS weekday, {_H} AS pickup_hour,
  CAST(count(*) AS BIGINT) AS trips FROM clean GROUP BY 1, 2""")
def q_traffic_pattern(spark, sf):
    return M.traffic_pattern(cleaned(spark, sf))


@register("avg_duration", _C + f"""SELECT {_H} AS pickup_hour, CAST(count(*) AS BIGINT) AS trips,
  {O.sround('avg(trip_duration_min)', 6)} AS avg_duration_min FROM clean GROUP BY 1""")
def q_avg_duration(spark, sf):
    return M.avg_duration(cleaned(spark, sf))


@register("revenue_rollup", _C + f"""SELECT CAST(year({_P}) AS INTEGER) AS pickup_year,
  CAST(month({_P}) AS INTEGER) AS pickup_month, payment_type, VendorID AS vendor_id,
  CAST(GROUPING(pickup_year, pickup_month, payment_type, vendor_id) AS INTEGER) AS grouping_level,
  CAST(count(*) AS BIGINT) AS trips, CAST(sum(CAST(total_amount AS DECIMAL(10,2))) AS DECIMAL(38,2)) AS revenue
FROM clean GROUP BY ROLLUP (pickup_year, pickup_month, payment_type, vendor_id)""")
def q_revenue_rollup(spark, sf):
    return M.revenue_rollup(cleaned(spark, sf))


@register("fare_trend", _C + f"""SELECT *, {O.sround('avg_fare - lag(avg_fare) OVER (ORDER BY pickup_year, pickup_month)', 6)}
  AS fare_change FROM (SELECT CAST(year({_P}) AS INTEGER) AS pickup_year, CAST(month({_P}) AS INTEGER) AS pickup_month,
  CAST(count(*) AS BIGINT) AS trips, {O.sround('avg(fare_amount)', 6)} AS avg_fare FROM clean GROUP BY 1, 2)""")
def q_fare_trend(spark, sf):
    return M.fare_trend(cleaned(spark, sf))


@register("tip_behaviour", _C + f"""SELECT payment_type, {_H} AS pickup_hour, CAST(count(*) AS BIGINT) AS trips,
  {O.sround('avg(CASE WHEN fare_amount = 0 THEN NULL ELSE tip_amount / fare_amount END)', 6)} AS avg_tip_ratio,
  CAST(count_if(tip_amount > 0) AS BIGINT) AS tipped_trips FROM clean GROUP BY 1, 2""")
def q_tip_behaviour(spark, sf):
    return M.tip_behaviour(cleaned(spark, sf))


@register("airport_revenue", _C + """SELECT PULocationID, CAST(count(*) AS BIGINT) AS trips,
  CAST(sum(CAST(total_amount AS DECIMAL(10,2))) AS DECIMAL(38,2)) AS revenue, CAST(sum(CAST(Airport_fee AS DECIMAL(10,2))) AS DECIMAL(38,2)) AS airport_fees
FROM clean WHERE Airport_fee > 0 GROUP BY 1""")
def q_airport_revenue(spark, sf):
    return M.airport_revenue(cleaned(spark, sf))


@register("hotspots", _C + f"""SELECT PULocationID, pickup_hour, trips, {O.sround('zone_mean', 6)} AS zone_mean,
  {O.sround('zone_sd', 6)} AS zone_sd FROM (
  SELECT *, avg(trips) OVER (PARTITION BY PULocationID) AS zone_mean,
         stddev_samp(trips) OVER (PARTITION BY PULocationID) AS zone_sd
  FROM (SELECT PULocationID, {_H} AS pickup_hour, CAST(count(*) AS BIGINT) AS trips FROM clean GROUP BY 1, 2))
WHERE trips > zone_mean + CAST(2 AS DOUBLE) * zone_sd""")
def q_hotspots(spark, sf):
    return M.hotspots(cleaned(spark, sf))


@register("active_areas", _C + """SELECT location_id, pickups, dropoffs, pickups + dropoffs AS total FROM (
  SELECT location_id, CAST(sum(pu) AS BIGINT) AS pickups, CAST(sum(1 - pu) AS BIGINT) AS dropoffs FROM (
    SELECT PULocationID AS location_id, 1 AS pu FROM clean UNION ALL SELECT DOLocationID, 0 FROM clean)
  GROUP BY 1) ORDER BY total DESC, location_id LIMIT 10""")
def q_active_areas(spark, sf):
    return M.active_areas(cleaned(spark, sf))


@register("trip_flow", _C + """SELECT PULocationID, DOLocationID, trips,
  CAST(trips AS DOUBLE) / CAST(sum(trips) OVER (PARTITION BY PULocationID) AS DOUBLE) AS share_of_origin
FROM (SELECT PULocationID, DOLocationID, CAST(count(*) AS BIGINT) AS trips FROM clean GROUP BY 1, 2)""")
def q_trip_flow(spark, sf):
    return M.trip_flow(cleaned(spark, sf))


@register("demand_heatmap", _C + "SELECT PULocationID, " + ", ".join(
    f"CAST(count_if(hour({_P}) = {h}) AS BIGINT) AS h{h:02d}" for h in range(24))
    + " FROM clean GROUP BY 1")
def q_demand_heatmap(spark, sf):
    return M.demand_heatmap(cleaned(spark, sf))


@register("trip_features", _C + f"""SELECT PULocationID, DOLocationID, {_P}, tpep_dropoff_datetime, trip_distance,
  trip_duration_min, {_H} AS pickup_hour, CAST(day({_P}) AS INTEGER) AS pickup_day,
  CAST(month({_P}) AS INTEGER) AS pickup_month,
  CASE WHEN trip_duration_min / CAST(60 AS DOUBLE) = 0 THEN NULL
       ELSE trip_distance / (trip_duration_min / CAST(60 AS DOUBLE)) END AS avg_speed FROM clean""")
def q_trip_features(spark, sf):
    return M.trip_features(cleaned(spark, sf))


@register("star_slice", O.with_steps(*O.STAR, "zones", "dim_location_zones") + """
SELECT dt.year, z.borough, p.payment_desc, r.rate_desc,
  CAST(GROUPING(dt.year, z.borough, p.payment_desc, r.rate_desc) AS INTEGER) AS grouping_level,
  CAST(count(*) AS BIGINT) AS trips, CAST(sum(f.total_amount) AS DECIMAL(38,2)) AS revenue
FROM fact_trip f LEFT JOIN dim_datetime dt USING (datetime_id)
  LEFT JOIN dim_location_zones z USING (location_id)
  LEFT JOIN dim_payment p USING (payment_id) LEFT JOIN dim_rate r USING (rate_id)
GROUP BY CUBE (dt.year, z.borough, p.payment_desc, r.rate_desc)""")
def q_star_slice(spark, sf):
    c = P.clean_job(trips(spark, sf), cap_mode="disc", trip_id=True)
    return M.star_slice(S.build_star(c, zones(spark, sf)))


# --- Imputation: IMP3-IMP7, PL4, PL5

from tripmart.operators import impute as I  # noqa: E402
from tripmart.sources.tables import table  # noqa: E402


def adaptive_valid(spark, sf):
    return P.stage(I.adaptive_valid(trips(spark, sf)), "adaptive")


@register("null_ratio", O.with_steps(*O.AD_STEPS, "ad_valid") + O.null_ratio_sql())
def q_null_ratio(spark, sf):
    return I.null_ratio_table(adaptive_valid(spark, sf))


@register("impute_mode", O.with_steps(*O.AD_STEPS, "ad_valid") + O.mode_sql())
def q_impute_mode(spark, sf):
    v = adaptive_valid(spark, sf)
    return I.mode_table(v, PR.string_columns(v))


@register("impute_median", O.with_steps(*O.AD_STEPS, "ad_valid") + O.median_sql())
def q_impute_median(spark, sf):
    v = adaptive_valid(spark, sf)
    return I.median_table(v, PR.numeric_columns(v), mode="exact")


# The zero rule needs a column at or above the null-share threshold; the trip
# view's nullable columns are ~8 % NULL, so this query sets the threshold to 5 %.
@register("impute_zero", O.with_steps(*O.AD_STEPS, "ad_valid",
                                      extra=O.adaptive_fill_sql("ad_zero", "ad_valid", 0.05))
          + "SELECT * FROM ad_zero")
def q_impute_zero(spark, sf):
    return I.adaptive_fill(adaptive_valid(spark, sf), median_below=0.05, mode="exact")


@register("adaptive_clean", O.adaptive_clean_sql())
def q_adaptive_clean(spark, sf):
    return I.adaptive_clean(trips(spark, sf), mode="exact")


def _events_with_gaps(spark, sf):
    ev = table(spark, sf, "events")
    gap = (F.col("event_id") % 4 == 0) | (F.col("event_type") == "error")
    return ev.select("event_id", "user_id", "ts", "event_type",
                     F.when(gap, F.lit(None).cast("double")).otherwise(F.col("value")).alias("value"))


@register("forward_fill", """SELECT event_id, user_id, ts, event_type, value,
  last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value_filled
FROM (SELECT event_id, user_id, ts, event_type,
        CASE WHEN event_id % 4 = 0 OR event_type = 'error' THEN NULL ELSE value END AS value FROM events)""")
def q_forward_fill(spark, sf):
    ev = _events_with_gaps(spark, sf).withColumn("value_filled", F.col("value"))
    return I.forward_fill(ev, ["value_filled"], ["ts", "event_id"], ["user_id"])


@register("forward_fill_global", """SELECT event_id, ts, value,
  last_value(value IGNORE NULLS) OVER (ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value_filled
FROM (SELECT event_id, ts, CASE WHEN event_id % 4 = 0 OR event_type = 'error' THEN NULL ELSE value END AS value
      FROM events)""")
def q_forward_fill_global(spark, sf):
    ev = _events_with_gaps(spark, sf).select("event_id", "ts", "value",
                                              F.col("value").alias("value_filled"))
    return I.forward_fill(ev, ["value_filled"], ["ts", "event_id"])


@register("clean_and_profile", O.adaptive_clean_sql(O.full_report_sql("ad_capped", O.adaptive_schema())))
def q_clean_and_profile(spark, sf):
    """PL5: load -> adaptive clean -> full report."""
    return PR.full_report_long(P.stage(I.adaptive_clean(trips(spark, sf), mode="exact"), "profile-in"), mode="exact")


# --- Sources, sinks, streaming: SRC1-SRC9, SNK1-SNK5, FN6, PL6

from tripmart.session import work_dir  # noqa: E402
from tripmart.sources import files as FS  # noqa: E402
from tripmart.sources import sinks as SK  # noqa: E402
from tripmart.streaming import ingest as ST  # noqa: E402


@register("landing_manifest", O.with_steps("trips") + """SELECT
  'yellow_tripdata_' || strftime(tpep_pickup_datetime, '%Y-%m') || '.parquet' AS file_name,
  'yellow' AS colour, strftime(tpep_pickup_datetime, '%Y-%m') AS period, true AS valid_name,
  CAST(count(*) AS BIGINT) AS trips FROM trips GROUP BY 1, 2, 3, 4""")
def q_landing_manifest(spark, sf):
    """SRC7/SRC8: land the trips as monthly files, validate the zone, and list
    every file with its name parts and the trips it holds."""
    landing = work_dir(spark, "landing")
    FS.write_trip_files(trips(spark, sf), landing)
    FS.validate_landing(spark, landing, min_files=1)
    return FS.file_counts(spark, landing)


def _after(dedup_from: str, *steps: str, first: str) -> str:
    """Oracle steps over another view of the trips: ``first`` defines it."""
    return O.with_steps("trips", extra=",\n".join(
        [first, f"dedup AS (SELECT DISTINCT * FROM {dedup_from})", *[O.STEPS[s] for s in steps]]))


# Trips whose tolls are a gap in one raw row and 0 in another: alike after the fills only.
_TWINS = """trips_t AS (SELECT * FROM trips UNION ALL
  SELECT * REPLACE (CAST(NULL AS DOUBLE) AS tolls_amount) FROM trips WHERE payment_type = 3 AND tolls_amount = 0)"""


def _with_twins(spark, sf):
    t = trips(spark, sf)
    gap = t.where("payment_type = 3 and tolls_amount = 0").withColumn("tolls_amount", F.lit(None).cast("double"))
    return t.unionByName(gap)


@register("incremental_ingest", _after("trips_t", "dur", "valid", "filled", first=_TWINS) + "SELECT * FROM filled")
def q_incremental_ingest(spark, sf):
    """Two arrivals through the file stream, every month split over both and raw
    copies too; the cleaned table must equal the batch clean (before caps)."""
    landing, cleaned_path, ckpt = (work_dir(spark, n) for n in ("landing", "cleaned", "stream-ckpt"))
    every = _with_twins(spark, sf).withColumn("_half", F.monotonically_increasing_id() % 2)
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hpath(landing).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    arrivals = work_dir(spark, "arrivals")
    names = FS.write_trip_files(every, arrivals, split="_half")
    for half in (0, 1):
        for n in names:
            parts = fs.globStatus(hpath(f"{arrivals}/{n}/_half={half}/part-*"))
            if parts:
                fs.mkdirs(hpath(f"{landing}/{n}"))
            for st in parts or []:
                # a task that has rows of both halves gives both files one name
                if not fs.rename(st.getPath(), hpath(f"{landing}/{n}/h{half}-{st.getPath().getName()}")):
                    raise OSError(f"could not move {st.getPath()}")
        ST.clean_stream(spark, landing, cleaned_path, ckpt).awaitTermination()
    return spark.read.parquet(cleaned_path).drop(ST.MONTH, *ST.RAW_KEY)


@register("recurring_ingest", O.with_steps("trips", "dedup", "dur", "valid", "filled") + "SELECT * FROM filled")
def q_recurring_ingest(spark, sf):
    """SRC6: the same stream on a recurring trigger, stopped when it has caught up."""
    landing, cleaned_path, ckpt = (work_dir(spark, n) for n in ("landing", "cleaned", "stream-ckpt"))
    FS.write_trip_files(trips(spark, sf), landing)
    q = ST.clean_stream(spark, landing, cleaned_path, ckpt, trigger="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.parquet(cleaned_path).drop(ST.MONTH, *ST.RAW_KEY)


@register("land_validate_clean", _after("trips_d", "dur", "valid", "filled", first="""trips_d AS (
  SELECT * REPLACE (CASE WHEN month(tpep_pickup_datetime) % 2 = 0 THEN cbd_congestion_fee END AS cbd_congestion_fee)
  FROM trips)""") + "SELECT * FROM filled")
def q_land_validate_clean(spark, sf):
    """PL6 up to the clean: files are landed under their names, the raw zone is
    validated and cleaned. Odd months hold counts and codes as INT64 and lack a fee."""
    source, raw = work_dir(spark, "source"), work_dir(spark, "raw-zone")
    t = trips(spark, sf)
    odd = F.month("tpep_pickup_datetime") % 2 == 1
    FS.write_trip_files(t.where(odd).drop("cbd_congestion_fee").withColumns(
        {c: F.col(c).cast("long") for c in ("passenger_count", "RatecodeID", "VendorID")}), source)
    FS.write_trip_files(t.where(~odd), source)
    FS.land(spark, source, raw)
    FS.validate_landing(spark, raw)
    return C.clean_prefix(FS.read_trips(spark, raw))


@register("clean_rerun", _after("trips_r", *O.CLEAN[2:], first="""trips_r AS (
  SELECT * FROM trips WHERE year(tpep_pickup_datetime) < 1996)""") + "SELECT * FROM clean")
def q_clean_rerun(spark, sf):
    """SNK1: the clean job over all trips, then over the earlier years only; the
    table holds the second run and nothing of the first."""
    out, t = work_dir(spark, "cleaned"), trips(spark, sf)
    P.run_clean(t, out, cap_mode="disc")
    P.run_clean(t.where(F.year("tpep_pickup_datetime") < 1996), out, cap_mode="disc")
    return spark.read.parquet(out).drop("trip_id", "pickup_month")


@register("load_file", """SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines
FROM lineitem GROUP BY 1""")
def q_load_file(spark, sf):
    """SRC2: one file or folder by path."""
    return (FS.load_file(spark, f"{sf}/lineitem.parquet").groupBy("l_returnflag")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines")))


@register("report_from_path", """SELECT CAST(count(*) AS BIGINT) AS raw_rows,
  CAST((SELECT count(*) FROM (SELECT DISTINCT * FROM events)) AS BIGINT) AS dedup_rows,
  (SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE events)) AS columns FROM events""")
def q_report_from_path(spark, sf):
    """SRC3: the full report of the table at a path; its shape."""
    return PR.full_report(f"{sf}/events.parquet", spark=spark)["shape"]


@register("full_report_from_path", _T + O.full_report_sql())
def q_full_report_from_path(spark, sf):
    """SRC3 + AGG13: the whole report, of the Parquet folder at a path."""
    path = work_dir(spark, "report-in") + "/trips"
    trips(spark, sf).write.parquet(path)
    return PR.full_report_long(path, mode="exact", spark=spark)


@register("parse_timestamps", "SELECT o_orderkey, date_trunc('second', o_orderdate)::TIMESTAMP AS o_orderdate FROM orders")
def q_parse_timestamps(spark, sf):
    """FN8: text timestamps back to zone-less ones."""
    from tripmart.functions.scalar import parse_timestamps
    text = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"))
    return parse_timestamps(text, ["o_orderdate"])


@register("date_summary", _T + " UNION ALL ".join(f"""SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count,
  TIMESTAMP '1970-01-01' + to_seconds(CAST(sum(epoch_us({c})) // count({c}) // 1000000 AS BIGINT)) AS mean,
  min({c}) AS first, max({c}) AS last FROM trips""" for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")))
def q_date_summary(spark, sf):
    return PR.date_summary(trips(spark, sf))


@register("cap_approx_check", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, true AS rank_within_error, true AS capped_at_threshold" for c in O.CAP3))
def q_cap_approx_check(spark, sf, rel_error: float = 1e-4):
    """AGG5: approximate thresholds lie within the error of the wanted rank, and
    no capped value lies above them."""
    from tripmart.operators import quantiles
    pre, limits = P.staged_caps(C.fill_constants(valid(spark, sf)), CAP_COLUMNS, "approx", rel_error, "cap-pre")
    n, k = F.count(F.lit(1)), F.ceil(F.count(F.lit(1)) * F.lit(0.99)) - 1
    both = quantiles.cap(pre.select(*CAP_COLUMNS, *[F.col(c).alias(f"_{c}") for c in CAP_COLUMNS]),
                         {f"_{c}": v for c, v in limits.items()})
    agg = both.agg(*[x for i, c in enumerate(CAP_COLUMNS) for x in (
        ((F.count_if(F.col(c) < limits[c]) - F.lit(rel_error) * n <= k)
         & (k < F.count_if(F.col(c) <= limits[c]) + F.lit(rel_error) * n)).alias(f"_r{i}"),
        (F.max(f"_{c}") <= limits[c]).alias(f"_m{i}"))])
    rows = [x for i, c in enumerate(CAP_COLUMNS) for x in (F.lit(c), F.col(f"_r{i}"), F.col(f"_m{i}"))]
    return agg.select(F.stack(F.lit(len(CAP_COLUMNS)), *rows).alias("column_name", "rank_within_error", "capped_at_threshold"))


@register("trip_id_stability", "SELECT CAST(0 AS BIGINT) AS unstable_ids, CAST(0 AS BIGINT) AS repeated_ids")
def q_trip_id_stability(spark, sf):
    """FN5: ids of the deduped trips, from the rows dealt over three numbers of
    partitions: ids not in all three, and ids on more than one trip. The numbers
    grow with the session's, so that no task holds more than its share.

    Equal rows have equal ids. So an id that one row of each dealing has is in all
    three and on one trip, with or without the dedupe; the rows of all other ids
    are deduped, and only these are moved again as a whole."""
    from functools import reduce

    from tripmart.operators.keys import RAW_KEY, perhaps_in, with_raw_key
    whole = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def told(dealings):
        ids = reduce(DataFrame.unionByName, [d.select("trip_id", F.lit(1 << i).alias("run")) for i, d in enumerate(dealings)])
        return ids.groupBy("trip_id").agg(F.bit_count(F.bit_or("run")).alias("runs"), F.count(F.lit(1)).alias("n"))

    dealt = [with_raw_key(trips(spark, sf).repartition(whole + n)) for n in (0, 3, 12)]
    open_ids = told(dealt).filter((F.col("runs") < 3) | (F.col("n") > 3)).select("trip_id")
    per = told([with_raw_key(C.dedupe(perhaps_in(d, open_ids, "trip_id").drop(*RAW_KEY))) for d in dealt])
    return per.agg(F.count_if(F.col("runs") < 3).alias("unstable_ids"), F.count_if(F.col("n") > 3).alias("repeated_ids"))


@register("dim_payment_labelled", O.with_steps(*O.CLEAN, "dim_payment")
          + "SELECT * REPLACE (coalesce(payment_desc, 'Other') AS payment_desc) FROM dim_payment")
def q_dim_payment_labelled(spark, sf):
    """H6: unmapped codes under a label of their own."""
    return S.dim_payment(cleaned(spark, sf), unknown_label="Other")


_WIDE = O.STEPS["fact_trip"].replace("fact_trip AS (", "fact_wide AS (").replace("c.trip_id, ", "").replace(
    "FROM clean_id c", """, c.DOLocationID AS dropoff_location_id,
    CAST(c.congestion_surcharge AS DECIMAL(10,2)) AS congestion_surcharge,
    CAST(c.cbd_congestion_fee AS DECIMAL(10,2)) AS cbd_congestion_fee, CAST(c.Airport_fee AS DECIMAL(10,2)) AS airport_fee
  FROM clean c""")


@register("fact_trip_wide", O.with_steps(*O.CLEAN, "dim_datetime", extra=_WIDE) + "SELECT * FROM fact_wide")
def q_fact_trip_wide(spark, sf):
    c = cleaned(spark, sf)
    return S.fact_trip(c, S.dim_datetime(c), wide=True)


@register("rejected_trips", O.with_steps(*O.CLEAN) + """SELECT CAST(count_if(payment_type = 6) AS BIGINT) AS rejected,
  CAST(count_if(payment_type <> 6) AS BIGINT) AS loaded FROM clean""")
def q_rejected_trips(spark, sf):
    """H12: amounts beyond decimal(10,2) (planted for one payment type) go to the reject table."""
    c = cleaned(spark, sf).withColumn("total_amount", F.when(F.col("payment_type") == 6, 1e9).otherwise(F.col("total_amount")))
    star = S.build_star(c, key_mode="hash", rejects=True)
    both = star["REJECTED_TRIP"].select(F.lit(1).alias("r")).unionByName(star["FACT_TRIP"].select(F.lit(0).alias("r")))
    return both.agg(F.sum("r").alias("rejected"), F.sum(1 - F.col("r")).alias("loaded"))


@register("csv_round_trip", O.with_steps(*O.STAR) + "SELECT * EXCLUDE (trip_id) FROM fact_trip")
def q_csv_round_trip(spark, sf):
    c = P.clean_job(trips(spark, sf), cap_mode="disc", trip_id=True)
    paths = P.run_star(c, work_dir(spark, "star"))
    return FS.read_star_csv(spark, paths["FACT_TRIP"], "FACT_TRIP").drop("trip_id")


@register("warehouse_load", O.with_steps(*O.STAR) + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t.lower()}"
    for t in ["DIM_DATETIME", "DIM_LOCATION", "DIM_VENDOR", "DIM_PAYMENT", "DIM_RATE", "FACT_TRIP"]))
def q_warehouse_load(spark, sf):
    from functools import reduce

    from pyspark.sql import DataFrame as _DF
    c = P.clean_job(trips(spark, sf), cap_mode="disc", trip_id=True)
    wh = work_dir(spark, "warehouse")
    run = SK.load_warehouse(S.build_star(c), wh, check=lambda t: star_checks(t))
    parts = [SK.read_warehouse(spark, wh, t, run).agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(t).alias("table_name"), "row_count") for t in SK.STAR_ORDER]
    return reduce(_DF.unionByName, parts)

from tripmart.plans import upkeep  # noqa: E402,F401 - registers its queries
