"""End-to-end jobs: clean (PL1), early clean (PL3), star (PL2).

Stage tables are written as Parquet under the shared work folder and read back:
that cuts lineage (a lost executor recomputes from the stage files, not from
the raw scan and the dedupe shuffle) and lets later passes read only the
columns they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmart.operators import clean as C
from tripmart.operators.keys import with_raw_key
from tripmart.schema import CAP_COLUMNS, EARLY_CAP_COLUMNS
from tripmart.session import work_dir


def write_concurrently(jobs: dict, max_workers: int = 4) -> dict:
    """Run independent write jobs from a small thread pool; small tables (few
    tasks each) then share the cluster instead of running one after another."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        futures = {k: pool.submit(fn) for k, fn in jobs.items()}
        return {k: f.result() for k, f in futures.items()}


def stage_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage several tables at once (see ``stage``)."""
    return write_concurrently({n: (lambda df=df, n=n: stage(df, n.lower())) for n, df in tables.items()})


def stage(df: DataFrame, name: str = "stage", observe: list | None = None):
    """Write ``df`` to a fresh folder in the shared work area and read it back.

    With ``observe`` (aggregate expressions) the aggregates are computed during
    the write itself and returned as well: ``(frame, {name: value})``.
    """
    import uuid

    from pyspark.sql import Observation

    spark = df.sparkSession
    path = work_dir(spark, name)
    obs = None
    if observe:
        obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        df = df.observe(obs, *observe)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    return (out, obs.get) if observe else out


def staged_caps(df: DataFrame, cols: list[str], mode: str, rel_error: float, name: str,
                q: float = 0.99):
    """Stage ``df`` and get its cap thresholds from the written columns."""
    from tripmart.operators import quantiles
    staged = stage(df, name)
    return staged, quantiles.thresholds(staged, [c for c in cols if c in df.columns], q, mode, rel_error)


def clean_job(raw: DataFrame, cap_mode: str = "approx", rel_error: float = 1e-4,
              passenger_policy: str = "drop", fills: dict | None = None,
              cast: bool = True, trip_id: bool = False) -> DataFrame:
    """PL1: dedupe -> duration -> filter -> fill -> cap (3 columns) -> casts.

    One pass writes the deduped, valid, filled trips; the quantile passes and
    the result read that stage table. ``trip_id`` adds a 64-bit hash of the raw
    columns, taken right after the dedupe (fills, caps and casts may later make
    rows equal): the same on every run; CHK2 checks that it is unique.
    """
    from tripmart.operators import quantiles
    rows = C.dedupe(raw)
    if trip_id:
        rows = with_raw_key(rows).drop("raw_check")
    pre = C.fill_constants(C.valid_trips(C.with_duration(rows), passenger_policy), fills)
    pre, limits = staged_caps(pre, CAP_COLUMNS, cap_mode, rel_error, "clean-pre")
    out = quantiles.cap(pre, limits)
    return C.cast_int_columns(out) if cast else out


def clean_early(raw: DataFrame, cap_mode: str = "approx", rel_error: float = 1e-4) -> DataFrame:
    """PL3: the early Spark cleaner - fill policy for passengers, caps on fare
    and distance only, no casts; duration column named ``trip_duration``."""
    from tripmart.operators import quantiles
    pre, limits = staged_caps(C.clean_early_prefix(raw), EARLY_CAP_COLUMNS, cap_mode, rel_error,
                              "clean-early")
    return quantiles.cap(pre, limits)


def run_clean(raw: DataFrame, out_path: str, cap_mode: str = "approx", rel_error: float = 1e-4,
              passenger_policy: str = "drop") -> dict[str, int]:
    """PL1 as a job: clean and write; raw and cleaned row counts are observed
    during the jobs that run anyway (no extra count passes)."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from tripmart.sources.sinks import write_cleaned

    seen_raw, seen_out = Observation("raw"), Observation("cleaned")
    raw = raw.observe(seen_raw, F.count(F.lit(1)).alias("rows"))
    out = clean_job(raw, cap_mode, rel_error, passenger_policy, trip_id=True)
    out = out.observe(seen_out, F.count(F.lit(1)).alias("rows"))
    write_cleaned(out, out_path)
    return {"raw_rows": seen_raw.get["rows"], "cleaned_rows": seen_out.get["rows"]}


def run_star(clean: DataFrame, star_dir: str, zones: DataFrame | None = None,
             key_mode: str = "dense", csv: bool = True, rejects: bool = False, key_map: str | None = None) -> dict[str, str]:
    """PL2: build the six tables, write them (as CSV, or as Parquet). With
    ``rejects`` trips whose amounts overflow are written as a seventh table; with
    ``key_map`` datetime keys outlast the run."""
    from tripmart.operators.star import build_star
    from tripmart.sources.sinks import write_star_csv

    star = build_star(clean, zones, key_mode, rejects, key_map=key_map)
    paths = {name: f"{star_dir.rstrip('/')}/{name}" for name in star}

    def job(name):
        if csv:
            return lambda: write_star_csv(star[name], paths[name], name)
        return lambda: star[name].write.mode("overwrite").parquet(paths[name])
    write_concurrently({name: job(name) for name in star})
    return paths


def run_all(spark, source: str, warehouse: str, zones: DataFrame | None = None,
            cap_mode: str = "approx", raw_zone: str | None = None, key_map: str | None = None) -> str:
    """PL6 (batch): land -> validate the raw zone -> clean it -> star -> checked
    warehouse load. The raw zone is ``<warehouse>/_raw`` unless given. With ``key_map``
    datetime keys are those of earlier loads."""
    from tripmart.operators.checks import star_checks
    from tripmart.operators.star import build_star
    from tripmart.sources.files import read_trips, validate_landing
    from tripmart.sources.landing import land_checked
    from tripmart.sources.sinks import load_warehouse

    raw = raw_zone or f"{warehouse.rstrip('/')}/_raw"
    failed = land_checked(spark, source, raw).where("status = 'failed'").collect()
    if failed:
        raise RuntimeError(f"{len(failed)} trip file(s) could not be landed from {source}: {[(r.file_name, r.reason) for r in failed]}")
    validate_landing(spark, raw)
    clean = clean_job(read_trips(spark, raw), cap_mode=cap_mode, trip_id=True)
    star = build_star(clean, zones, key_map=key_map)
    return load_warehouse(star, warehouse, check=lambda t: star_checks(t))


def star_from_cleaned_table(spark, cleaned_path: str, zones: DataFrame | None = None,
                            cap_mode: str = "approx", key_mode: str = "dense", summaries: str | None = None,
                            key_map: str | None = None) -> dict:
    """Build the star from the uncapped, month-partitioned cleaned table the
    stream maintains: caps (global to the table) and casts are applied here,
    and the thresholds used are returned as a one-row ``CAPS`` table. With
    ``summaries``, the path of stored quantile summaries, caps come from these and
    no pass over the table is made for them; ``key_map`` as in ``build_star``."""
    from pyspark.sql import functions as F

    from tripmart.operators import quantiles, sketches
    from tripmart.operators.star import build_star

    table = spark.read.parquet(cleaned_path).drop("pickup_month", "raw_check", "load")
    limits = (sketches.thresholds(sketches.stored(spark, summaries)) if summaries
              else quantiles.thresholds(table, CAP_COLUMNS, 0.99, cap_mode))
    capped = C.cast_int_columns(quantiles.cap(table, limits))
    star = build_star(capped, zones, key_mode, key_map=key_map)
    star["CAPS"] = table.agg(F.count(F.lit(1)).alias("rows")).select(
        *[F.lit(v).cast("double").alias(f"cap_{c}") for c, v in limits.items()], "rows")
    return star
