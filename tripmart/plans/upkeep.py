"""Registered queries on upkeep: what a warehouse that is loaded again and again needs.

Co-located tables, keys that outlast a load, state in the stream, sketches and cubes that
are merged instead of recomputed, content-aware landing, clustered layout, event-time windows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators import colocated as CO
from tripmart.operators import star as S
from tripmart.plans import jobs as P
from tripmart.plans import oracle as O
from tripmart.plans.catalog import cleaned, register, valid
from tripmart.session import work_dir
from tripmart.sources.tables import trips

_P, _D = "tpep_pickup_datetime", "tpep_dropoff_datetime"


# --- JN1, CHK2, CHK3: the co-located star

@register("colocated_fact", O.with_steps(*O.STAR) + "SELECT * EXCLUDE (trip_id) FROM fact_trip")
def q_colocated_fact(spark, sf):
    """The fact from bucketed tables: one shuffle of the trips, none of the fact."""
    star = CO.build_star(P.clean_job(trips(spark, sf), cap_mode="disc", trip_id=True))
    return star["FACT_TRIP"].drop("trip_id", CO.PART)


@register("colocated_checks", O.star_checks_sql())
def q_colocated_checks(spark, sf):
    """The contract of the co-located star, checked within buckets."""
    return CO.checks(CO.build_star(P.clean_job(trips(spark, sf), cap_mode="disc", trip_id=True)))


# --- ST1, FN5: datetime keys that outlast a load

@register("lasting_datetime_keys", O.with_steps("trips", "dedup", "dur", "valid", extra=f"""
pairs AS (SELECT {_P} AS p, {_D} AS d, min(year({_P})) < 1996 AS early FROM valid GROUP BY 1, 2),
keyed AS (SELECT p, d, early, row_number() OVER (PARTITION BY early ORDER BY p, d) AS i FROM pairs)""") + """
SELECT CASE WHEN early THEN i ELSE i + (SELECT count(*) FROM pairs WHERE early) END AS datetime_id,
       p AS pickup_datetime, d AS dropoff_datetime, CASE WHEN early THEN 1 ELSE 2 END AS first_load FROM keyed""")
def q_lasting_datetime_keys(spark, sf):
    """Two loads over one key map: trips up to 1995, then all trips. The second keeps the
    first one's keys and numbers the new pairs from the high-water mark on."""
    path, t = work_dir(spark, "key-map"), P.stage(valid(spark, sf), "valid")
    first = S.dim_datetime(t.where(F.year(_P) < 1996), key_map=path)
    second = S.dim_datetime(t, key_map=path)
    known = P.stage(first.select("datetime_id", F.lit(1).alias("first_load")), "first-load")
    return (second.join(known, "datetime_id", "left")
            .select("datetime_id", "pickup_datetime", "dropoff_datetime", F.coalesce("first_load", F.lit(2)).alias("first_load")))


# --- PL6, SRC6: arrivals with keyed state

from tripmart.sources import files as FS  # noqa: E402
from tripmart.streaming import keyed as KS  # noqa: E402
from tripmart.streaming.ingest import MONTH  # noqa: E402
from tripmart.operators.keys import RAW_KEY  # noqa: E402


def _arrive(spark, names: list[str], drop: str, landing: str, suffix: str) -> None:
    """Move monthly files of ``drop`` into the landing zone as one delivery."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hpath(landing).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in names:
        fs.mkdirs(hpath(f"{landing}/{name}"))
        for st in fs.globStatus(hpath(f"{drop}/{name}/part-*")):
            fs.rename(st.getPath(), hpath(f"{landing}/{name}/{suffix}-{st.getPath().getName()}"))


@register("keyed_ingest", O.with_steps("trips", "dedup", "dur", "valid", "filled") + "SELECT * FROM filled")
def q_keyed_ingest(spark, sf):
    """Three deliveries through the keyed stream, started anew for each: later years first, then the
    earlier ones (late months), then all files of the first again. The table equals the batch clean."""
    landing, work, out = (work_dir(spark, n) for n in ("landing", "keyed", "cleaned"))
    drop = work_dir(spark, "delivery")
    months = FS.write_trip_files(trips(spark, sf).where(F.col(_P).isNotNull()), drop)
    late = [m for m in months if int(m.split("_tripdata_")[1].rsplit("-", 1)[0]) < 1996]
    first = [m for m in months if m not in late]
    for i, part in enumerate((first, late, first)):
        if i == 2 and first:
            # the files that the first delivery has brought, under other names: the rows lie by month already
            drop = work_dir(spark, "delivery")
            FS.write_trip_files(spark.read.parquet(*[f"{landing}/{m}" for m in first]), drop, by_month=True)
        _arrive(spark, part, drop, landing, f"d{i}")
        KS.ingest(spark, landing, work, out)
    return KS.read_cleaned(spark, out).drop(MONTH, *RAW_KEY)


# --- AGG5, AGG7, PL6: summaries by month, merged

from tripmart.operators import clean as C  # noqa: E402
from tripmart.operators import sketches as SK  # noqa: E402
from tripmart.schema import CAP_COLUMNS  # noqa: E402

# loads of the queries below: earlier years, later ones, and one payment type that comes late
_LOAD = f"CASE WHEN payment_type = 6 THEN 3 WHEN year({_P}) < 1995 THEN 1 ELSE 2 END"
SUMMARY_SIZE = 200          # few cuts, so that the small tables of the tests show a rank error


def _loads(df: DataFrame) -> list[tuple[str, DataFrame]]:
    return [(str(i), df.where(F.expr(_LOAD) == i)) for i in (1, 2, 3)]


@register("incremental_caps", O.with_steps("trips", "dedup", "dur", "valid", "filled", extra=f"""
vals AS (SELECT {_LOAD} AS load, strftime({_P}, '%Y-%m') AS month, column_name, value FROM (
  UNPIVOT filled ON {', '.join(CAP_COLUMNS)} INTO NAME column_name VALUE value)),
hist AS (SELECT load, month, column_name, value, count(*) AS n FROM vals GROUP BY ALL),
run AS (SELECT *, sum(n) OVER (PARTITION BY load, month, column_name ORDER BY value) AS upto,
          sum(n) OVER (PARTITION BY load, month, column_name) AS rows FROM hist),
cuts AS (SELECT *, CAST(ceil(rows / {SUMMARY_SIZE}) AS BIGINT) AS step FROM run
  WHERE upto // CAST(ceil(rows / {SUMMARY_SIZE}) AS BIGINT) > (upto - n) // CAST(ceil(rows / {SUMMARY_SIZE}) AS BIGINT) OR upto = rows),
inc AS (SELECT *, upto - coalesce(lag(upto) OVER (PARTITION BY load, month, column_name ORDER BY value), 0) AS inc FROM cuts),
whole AS (SELECT column_name, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(step - 1) AS BIGINT) AS rank_slack,
    CAST(ceil(CAST(0.99 AS DOUBLE) * CAST(sum(rows) AS DOUBLE)) AS BIGINT) AS rank_wanted
  FROM (SELECT DISTINCT load, month, column_name, rows, step FROM cuts) GROUP BY 1),
total AS (SELECT column_name, value, sum(inc) OVER (PARTITION BY column_name ORDER BY value) AS upto
  FROM (SELECT column_name, value, sum(inc) AS inc FROM inc GROUP BY 1, 2)),
hit AS (SELECT t.column_name, min(value) AS threshold FROM total t JOIN whole w USING (column_name) WHERE upto >= rank_wanted GROUP BY 1)""") + """
SELECT w.column_name, w.rows, h.threshold, w.rank_wanted, w.rank_slack,
  CAST((SELECT count(*) FROM vals v WHERE v.column_name = w.column_name AND v.value < h.threshold) AS BIGINT) AS table_below,
  CAST((SELECT count(*) FROM vals v WHERE v.column_name = w.column_name AND v.value <= h.threshold) AS BIGINT) AS table_upto,
  true AS within_bound
FROM whole w JOIN hit h USING (column_name)""")
def q_incremental_caps(spark, sf):
    """Three loads add their summaries; the caps come from these alone. Then, as a check, the
    ranks of the thresholds are counted in the whole table."""
    path = work_dir(spark, "summaries") + "/quantiles"
    t = P.stage(C.fill_constants(valid(spark, sf)), "filled")
    for load, rows in _loads(t):
        SK.add(SK.quantile_summary(rows, CAP_COLUMNS, load, SUMMARY_SIZE), path)
    caps = P.stage(SK.merged_quantile(SK.stored(spark, path)), "caps")
    limit = {r.column_name: r.threshold for r in caps.collect()}                # one row a column
    told = t.agg(*[x for i, c in enumerate(CAP_COLUMNS) for x in (
        F.count_if(F.col(c) < limit[c]).alias(f"b{i}"), F.count_if(F.col(c) <= limit[c]).alias(f"u{i}"))])
    told = told.select(F.stack(F.lit(len(CAP_COLUMNS)), *[x for i, c in enumerate(CAP_COLUMNS) for x in (F.lit(c), F.col(f"b{i}"), F.col(f"u{i}"))])
                       .alias("column_name", "table_below", "table_upto"))
    ok = (F.col("table_upto") >= F.col("rank_wanted")) & (F.col("table_below") <= F.col("rank_wanted") - 1 + F.col("rank_slack"))
    return caps.join(told, "column_name").select("*", ok.alias("within_bound"))


DISTINCT_COLUMNS = ["PULocationID", "DOLocationID", _P, "fare_amount", "total_amount", "store_and_fwd_flag"]


@register("merged_distinct_counts", O.with_steps("trips") + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CAST(count(DISTINCT ({_LOAD}, strftime({_P}, '%Y-%m'))) AS BIGINT) AS sketches,
  CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_count, true AS within_error FROM trips""" for c in DISTINCT_COLUMNS))
def q_merged_distinct_counts(spark, sf):
    """Three loads add their sketches by month; their union against the exact distinct counts."""
    path = work_dir(spark, "summaries") + "/distinct"
    t = P.stage(trips(spark, sf), "raw")
    for load, rows in _loads(t):
        SK.add(SK.distinct_summary(rows, DISTINCT_COLUMNS, load), path)
    exact = t.agg(*[F.count_distinct(c).alias(f"d{i}") for i, c in enumerate(DISTINCT_COLUMNS)])
    exact = exact.select(F.stack(F.lit(len(DISTINCT_COLUMNS)), *[x for i, c in enumerate(DISTINCT_COLUMNS) for x in (F.lit(c), F.col(f"d{i}"))])
                         .alias("column_name", "distinct_count"))
    both = SK.distinct_estimate(SK.stored(spark, path)).join(exact, "column_name")
    off = F.abs(F.col("estimate") - F.col("distinct_count"))
    return both.select("column_name", "sketches", "distinct_count",
                       (off <= F.greatest(F.lit(1.0), SK.HLL_ERROR * F.col("distinct_count"))).alias("within_error"))


# --- SRC4, SRC5: landing by content

from tripmart.sources import landing as LD  # noqa: E402

_MONTH = f"strftime({_P}, '%Y-%m')"
_SWAPPED, _TOUCHED = "1993-05", "1992-08"


def _put(spark, rows: DataFrame, folder: str) -> None:
    """Write trips as monthly files and swap them into ``folder``."""
    drop, old = work_dir(spark, "delivery"), work_dir(spark, "outdated")
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hpath(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in FS.write_trip_files(rows, drop):
        if fs.exists(hpath(f"{folder}/{name}")):
            fs.rename(hpath(f"{folder}/{name}"), hpath(f"{old}/{name}"))
        fs.rename(hpath(f"{drop}/{name}"), hpath(f"{folder}/{name}"))


@register("landing_arrivals", O.with_steps("trips", extra=f"""
files AS (SELECT {_MONTH} AS month, count(*) AS trips, count_if(payment_type <> 6) AS swapped,
            year({_P}) < 1994 AS old FROM trips WHERE year({_P}) < 1996 GROUP BY 1, 4),
told AS (
  SELECT 1 AS arrival, 'uploaded' AS status, trips FROM files WHERE old
  UNION ALL SELECT 2, CASE WHEN month = '{_SWAPPED}' THEN 'quarantined' WHEN old THEN 'skipped' ELSE 'uploaded' END,
    CASE WHEN month = '{_SWAPPED}' THEN swapped ELSE trips END FROM files
  UNION ALL SELECT 3, CASE WHEN month = '{_SWAPPED}' THEN 'replaced' ELSE 'skipped' END,
    CASE WHEN month = '{_SWAPPED}' THEN swapped ELSE trips END FROM files
  UNION ALL SELECT a, 'failed', 0 FROM (VALUES (2), (3)) v(a)
  UNION ALL SELECT 4, 'in the zone', CASE WHEN month = '{_SWAPPED}' THEN swapped ELSE trips END FROM files)""") + """
SELECT arrival, status, CAST(count(*) AS BIGINT) AS files, CAST(sum(trips) AS BIGINT) AS trips FROM told GROUP BY 1, 2""")
def q_landing_arrivals(spark, sf):
    """Three arrivals: old months; then newer ones as well, an old file swapped under its name, one
    written anew with the same trips and one that is no Parquet file; then the same again under
    the rule that swapped files replace the landed ones. Last row: what the zone holds."""
    source, raw = work_dir(spark, "source"), work_dir(spark, "raw-zone")
    t = P.stage(trips(spark, sf).where(F.year(_P) < 1996), "raw")
    month = F.date_format(_P, "yyyy-MM")
    _put(spark, t.where(F.year(_P) < 1994), source)
    runs = [LD.land_checked(spark, source, raw)]
    _put(spark, t.where(F.year(_P) >= 1994), source)
    _put(spark, t.where((month == _SWAPPED) & (F.col("payment_type") != 6)), source)
    _put(spark, t.where(month == _TOUCHED).repartition(3), source)
    spark.createDataFrame([("no trips in here",)], "value string").coalesce(1).write.text(f"{source}/yellow_tripdata_1999-01.parquet")
    runs += [LD.land_checked(spark, source, raw), LD.land_checked(spark, source, raw, on_change="replace")]
    told = reduce(DataFrame.unionByName, [
        r.groupBy("status").agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("trips"))
         .select(F.lit(i).alias("arrival"), "status", "files", "trips") for i, r in enumerate(runs, 1)])
    zone = FS.file_counts(spark, raw).agg(F.count(F.lit(1)).alias("files"), F.sum("trips").alias("trips"))
    return told.unionByName(zone.select(F.lit(4).alias("arrival"), F.lit("in the zone").alias("status"), "files", "trips"))


# --- MA14, SRC1: clustered layout

from tripmart.sources import layout as LY  # noqa: E402

_ZONE, _FROM, _TO = 132, "1995-03-06 00:00:00", "1995-03-12 23:59:59"
SLICE_FILES = 64
# (slice, zones, times, largest share of the files it may read)
_SLICES = [("zone and week", True, True, 1 / 8), ("week", False, True, 1 / 4), ("zone", True, False, 1 / 2)]


def _slice_sql(name: str, zone: bool, week: bool) -> str:
    cond = " AND ".join([f"PULocationID = {_ZONE}"] * zone + [f"{_P} BETWEEN TIMESTAMP '{_FROM}' AND TIMESTAMP '{_TO}'"] * week)
    return (f"SELECT '{name}' AS slice, CAST(count(*) AS BIGINT) AS trips, CAST(sum(CAST(total_amount AS DECIMAL(10,2))) AS DECIMAL(38,2)) AS revenue, "
            f"true AS few_files FROM valid WHERE {cond}")


@register("clustered_slices", O.with_steps("trips", "dedup", "dur", "valid") + " UNION ALL ".join(_slice_sql(*s[:3]) for s in _SLICES))
def q_clustered_slices(spark, sf):
    """Trips and revenue of a zone, a week and both, from trips stored along a curve through time and
    zone; ``few_files``: no more than the stated share of the files was opened."""
    path = work_dir(spark, "clustered") + "/trips"
    LY.write_clustered(P.stage(valid(spark, sf), "valid"), path, [_P, "PULocationID"], SLICE_FILES)
    out = []
    for name, zone, week, share in _SLICES:
        ranges = ({"PULocationID": (_ZONE, _ZONE)} if zone else {}) | (
            {_P: tuple(F.lit(x).cast("timestamp_ntz") for x in (_FROM, _TO))} if week else {})
        files, of = LY.files_of_slice(spark, path, ranges)
        rows = LY.read_slice(spark, path, ranges)
        out.append(rows.agg(F.count(F.lit(1)).alias("trips"), F.sum(F.col("total_amount").cast("decimal(10,2)")).cast("decimal(38,2)").alias("revenue"))
                   .select(F.lit(name).alias("slice"), "trips", "revenue", F.lit(len(files) <= share * of).alias("few_files")))
    return reduce(DataFrame.unionByName, out)


# --- MA4, MA14: cubes kept up to date

from tripmart.operators import cubes as CB  # noqa: E402
from tripmart.plans.catalog import ORACLE  # noqa: E402
from tripmart.sources.tables import zones  # noqa: E402


@register("maintained_cube", ORACLE["star_slice"])
def q_maintained_cube(spark, sf):
    """The cube after three loads, each adding its own; it equals the cube from scratch."""
    path, keys = work_dir(spark, "cube") + "/cube", work_dir(spark, "key-map")
    c = P.stage(P.clean_job(trips(spark, sf), cap_mode="disc", trip_id=True), "clean")
    for load, rows in _loads(c):
        CB.add_load(S.build_star(rows, zones(spark, sf), key_map=keys), path, load)
    return CB.merged(spark, path)


# --- MA1, MA8: hourly demand as trips arrive

from tripmart.schema import RAW_COLUMNS  # noqa: E402
from tripmart.streaming import demand as DM  # noqa: E402

_ARRIVAL = f"CASE WHEN year({_P}) <= 1993 THEN 1 WHEN year({_P}) <= 1995 THEN 2 ELSE 3 END"
_LATE = f"CASE WHEN payment_type = 6 THEN least(3, 1 + {_ARRIVAL}) ELSE {_ARRIVAL} END"


@register("hourly_demand", O.with_steps("trips", "dedup", "dur", "valid", extra=f"""
arrived AS (SELECT {_P} AS p, date_trunc('hour', {_P}) AS h, PULocationID, fare_amount, {_LATE} AS arrival FROM valid),
marks AS (SELECT a.arrival, max(b.p) - INTERVAL 2 HOUR AS mark FROM (SELECT DISTINCT arrival FROM arrived) a
  JOIN arrived b ON b.arrival < a.arrival GROUP BY 1),
told AS (SELECT t.*, mark IS NOT NULL AND h + INTERVAL 1 HOUR <= mark AS late FROM arrived t LEFT JOIN marks USING (arrival))""") + """
SELECT 'window' AS kind, CAST(h AS TIMESTAMP) AS hour_start, PULocationID, CAST(count(*) AS BIGINT) AS trips,
  CAST(sum(CAST(fare_amount AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS fares FROM told WHERE NOT late GROUP BY ALL
UNION ALL SELECT 'dropped', NULL, NULL, CAST(count_if(late) AS BIGINT), CAST(coalesce(sum(CASE WHEN late THEN CAST(fare_amount AS DECIMAL(12,2)) END), 0) AS DECIMAL(22,2)) FROM told""")
def q_hourly_demand(spark, sf):
    """Valid trips in three arrivals, one payment type an arrival late. Final windows, and the late trips that
    were dropped: what arrived less what was counted. A row of the year 2100 closes the last windows."""
    source, out, chk = (work_dir(spark, n) for n in ("arrivals", "demand", "demand-chk"))
    t = P.stage(valid(spark, sf), "valid")
    for i in (1, 2, 3):
        t.where(F.expr(_LATE) == i).select(*RAW_COLUMNS).write.parquet(f"{source}/load={i}")
        DM.demand_stream(spark, source, out, chk).awaitTermination()
    end = F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")
    t.limit(1).select(*RAW_COLUMNS).withColumns({_P: end, _D: end}).write.parquet(f"{source}/load=4")
    DM.demand_stream(spark, source, out, chk).awaitTermination()
    done = DM.final_windows(spark, out)
    money = F.coalesce(F.sum("fares"), F.lit(0)).cast("decimal(22,2)").alias("fares")
    windows = done.select(F.lit("window").alias("kind"), "hour_start", "PULocationID", "trips", F.col("fares").cast("decimal(22,2)").alias("fares"))
    both = (t.select(F.lit(1).cast("long").alias("trips"), F.col("fare_amount").cast("decimal(12,2)").alias("fares"))
            .unionByName(done.select((-F.col("trips")).alias("trips"), (-F.col("fares")).alias("fares"))))
    dropped = both.agg(F.sum("trips").alias("trips"), money).select(
        F.lit("dropped").alias("kind"), F.lit(None).cast("timestamp_ntz").alias("hour_start"), F.lit(None).cast("int").alias("PULocationID"), "trips", "fares")
    return windows.unionByName(dropped)
