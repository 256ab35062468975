"""Sinks: cleaned Parquet, star CSV, and an all-or-nothing warehouse (SNK1-SNK5).

Writes are parallel (one file per task); only small dimensions are coalesced
to one CSV file. The warehouse load writes every table of a run to its own
folder and commits the run with a marker only after all tables pass the
contract checks, so readers never see half a load and reruns are idempotent.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.schema import PICKUP, STAR, STAR_ORDER
from tripmart.session import has_data

SMALL_TABLES = {"DIM_LOCATION", "DIM_VENDOR", "DIM_PAYMENT", "DIM_RATE"}


def write_cleaned(df: DataFrame, path: str, partition_by_month: bool = True) -> None:
    """SNK1: overwrite the cleaned trips, all of them: months that the run does
    not have are gone afterwards. Partitioned by pickup month so later readers
    prune by time (incremental runs append, see ``streaming.ingest``)."""
    if partition_by_month:
        df = df.withColumn("pickup_month", F.date_format(PICKUP, "yyyy-MM"))
        # rebalance by month: few files per month, and AQE splits a hot month
        # over several tasks by size instead of one task per month
        (df.hint("rebalance", "pickup_month").write.mode("overwrite")
           .option("partitionOverwriteMode", "static").partitionBy("pickup_month").parquet(path))
    else:
        df.write.mode("overwrite").parquet(path)


def write_star_csv(df: DataFrame, path: str, table: str) -> None:
    """SNK2: one headed CSV per table; a single file only for small dimensions."""
    out = df.coalesce(1) if table in SMALL_TABLES else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """SNK5: column set, order and types of the target contract."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns for the target table: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_warehouse(star: dict[str, DataFrame], warehouse: str, run_id: str | None = None,
                   check=None, jdbc_url: str | None = None, jdbc_props: dict | None = None,
                   batchsize: int = 1000) -> str:
    """SNK3 + SNK4: load the six tables, dimensions first, all or nothing.

    Each table is written (conformed to its contract) under
    ``<warehouse>/_runs/<run_id>/<TABLE>``; ``check`` (a function of the
    written tables returning a violations frame) must find no violation before
    ``<warehouse>/_commits/run=<run_id>`` is written. With ``jdbc_url`` the
    tables also replace those of a database, before the commit marker. Of two loads that
    start from the same committed run the first to commit wins; the other one raises and
    leaves no marker.
    """
    spark = next(iter(star.values())).sparkSession
    run_id = run_id or new_run_id()
    started_from = latest_run(spark, warehouse)
    base = f"{warehouse.rstrip('/')}/_runs/{run_id}"
    from tripmart.plans.jobs import write_concurrently

    def job(name):
        df = star[name]
        schema = STAR[name] if "trip_id" in df.columns or name != "FACT_TRIP" else T.StructType(
            [f for f in STAR[name].fields if f.name != "trip_id"])
        return lambda: conform(df, schema).write.mode("overwrite").parquet(f"{base}/{name}")
    # Parquet tables land concurrently; the commit marker (below) makes them
    # visible together, so write order does not matter here.
    write_concurrently({name: job(name) for name in STAR_ORDER})
    written = {n: spark.read.parquet(f"{base}/{n}") for n in STAR_ORDER}
    if check is not None:      # one row per check of the contract
        bad = check(written).where(F.col("violations") > 0).collect()
        if bad:
            raise ValueError(f"run {run_id} not committed, contract violations: {bad}")
    if jdbc_url:
        load_jdbc(written, jdbc_url, jdbc_props or {}, batchsize)
    _commit(spark, warehouse, run_id, started_from)
    return run_id


def _commit(spark: SparkSession, warehouse: str, run_id: str, after: str | None) -> None:
    """Write the marker of a run if ``after`` is still the latest one. The successor of a run is claimed by
    creating one file exclusively; the marker is ready by then and appears by a rename, which the next
    load makes up for if this one dies in between."""
    root = warehouse.rstrip("/")
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hpath(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    spark.createDataFrame([(run_id,)], "run_id string").coalesce(1).write.mode("overwrite").parquet(f"{root}/_pending/run={run_id}")
    claim = hpath(f"{root}/_claims/after={after or 'nothing'}")
    fs.mkdirs(claim.getParent())
    fs.mkdirs(hpath(f"{root}/_commits"))
    try:
        out = fs.create(claim, False)
    except Py4JJavaError as e:
        winner = spark.read.text(f"{root}/_claims/after={after or 'nothing'}").first()
        if winner and fs.exists(hpath(f"{root}/_pending/run={winner[0]}")):
            fs.rename(hpath(f"{root}/_pending/run={winner[0]}"), hpath(f"{root}/_commits/run={winner[0]}"))
        raise RuntimeError(f"run {run_id} not committed: another load has committed after {after or 'the start'}") from e
    out.writeBytes(run_id)
    out.close()
    if not fs.rename(hpath(f"{root}/_pending/run={run_id}"), hpath(f"{root}/_commits/run={run_id}")):
        raise RuntimeError(f"run {run_id}: the marker could not be placed")


def latest_run(spark: SparkSession, warehouse: str) -> str | None:
    """Latest committed run; None if there is none yet."""
    return committed_run(spark, warehouse) if has_data(spark, f"{warehouse.rstrip('/')}/_commits") else None


def load_jdbc(tables: dict[str, DataFrame], url: str, props: dict, batchsize: int) -> None:
    """Replace the star tables of a database, so a rerun does not double them.

    Executors write each table in batches to ``<TABLE>_STAGE``; then a single
    transaction empties the targets (fact first) and fills them from the staging
    tables (dimensions first). Until it commits, readers see the former load.
    """
    spark = next(iter(tables.values())).sparkSession
    for name in STAR_ORDER:
        tables[name].write.jdbc(url, f"{name}_STAGE", mode="overwrite", properties={**props, "batchsize": str(batchsize)})
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for k, v in props.items():
        properties.setProperty(k, v)
    con = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        con.setAutoCommit(False)
        run = con.createStatement()
        for name in reversed(STAR_ORDER):
            run.executeUpdate(f"DELETE FROM {name}")
        for name in STAR_ORDER:
            cols = ", ".join(tables[name].columns)
            run.executeUpdate(f"INSERT INTO {name} ({cols}) SELECT {cols} FROM {name}_STAGE")
        con.commit()
    finally:
        con.close()          # closing without a commit undoes the transaction


def new_run_id() -> str:
    """Run ids sort by time: UTC timestamp, then a random suffix."""
    return time.strftime("%Y%m%dT%H%M%S", time.gmtime()) + f"{time.time_ns() % 10**9:09d}-{uuid.uuid4().hex[:8]}"


def committed_run(spark: SparkSession, warehouse: str) -> str:
    """Latest committed run of a warehouse folder."""
    runs = spark.read.parquet(f"{warehouse.rstrip('/')}/_commits").select("run").distinct()
    latest = runs.orderBy(F.desc("run")).limit(1).collect()
    if not latest:
        raise ValueError(f"no committed run in {warehouse}")
    return latest[0]["run"]


def read_warehouse(spark: SparkSession, warehouse: str, table: str, run_id: str | None = None) -> DataFrame:
    """A table of the given (default: latest committed) run."""
    run_id = run_id or committed_run(spark, warehouse)
    return spark.read.parquet(f"{warehouse.rstrip('/')}/_runs/{run_id}/{table}")
