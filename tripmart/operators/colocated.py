"""Co-located star: trips, datetime dimension and fact in bucketed, sorted tables.

The datetime dimension is about as long as the fact, so in the plain star the fact is
shuffled for its join, for the check of its datetime key and for the check of its primary
key. Here the cleaned trips are shuffled once, when they are written into buckets by
``dt_part`` (``PART_BITS`` bits of the hash of pickup and dropoff). From there on

* the pairs of the dimension are grouped within buckets,
* the fact joins the dimension bucket by bucket (JN1),
* its datetime key is checked by an anti join within buckets (CHK3), and
* its primary key is counted within buckets (CHK2): the upper bits of ``trip_id`` are
  ``dt_part``, so equal ids lie in one bucket.

Both tables keep ``dt_part``; later queries over the stored star gain the same way. The
bucket counts live in the catalog, so ``attach`` registers stored tables in a new session.

A hot pair would fill one bucket, which a bucketed scan can't split. ``build_star`` looks at
the rows of each bucket first; beyond ``HOT`` times the mean it builds the plain star, whose
joins adaptive execution splits. Tables are the same either way.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import star as S
from tripmart.operators.checks import star_checks
from tripmart.operators.keys import dense_key, hash_key
from tripmart.schema import DROPOFF, PICKUP
from tripmart.session import work_dir

PART, PART_BITS = "dt_part", 20
HOT = 8
SORT = {"CLEAN": [PART, PICKUP, DROPOFF], "DIM_DATETIME": [PART, "datetime_id"], "FACT_TRIP": [PART, "datetime_id"]}


def pair_part(pickup: str = PICKUP, dropoff: str = DROPOFF) -> Column:
    return F.shiftrightunsigned(hash_key(pickup, dropoff), 64 - PART_BITS).cast("int")


def with_part(clean: DataFrame) -> DataFrame:
    """Add ``dt_part`` and put it into the upper bits of ``trip_id``, whose lower bits stay:
    ids of one part differ in 44 bits, so ids are as apart as with 64 bits over all parts."""
    out = clean.withColumn(PART, pair_part())
    if "trip_id" not in clean.columns:
        return out
    low = F.col("trip_id").bitwiseAND(F.lit((1 << (64 - PART_BITS)) - 1))
    return out.withColumn("trip_id", F.shiftleft(F.col(PART).cast("long"), 64 - PART_BITS).bitwiseOR(low))


def write_bucketed(df: DataFrame, path: str, buckets: int, sort: list[str], deal: bool = True) -> DataFrame:
    """Write ``df`` into ``buckets`` files by ``dt_part``, sorted, and return the table. With
    ``deal=False`` the frame comes out of such buckets, one a task, and is not shuffled."""
    name = f"tripmart_{uuid.uuid4().hex[:12]}"
    ((df.repartition(buckets, PART) if deal else df).write.format("parquet").mode("overwrite").option("path", path)
       .bucketBy(buckets, PART).sortBy(*sort).saveAsTable(name))
    return df.sparkSession.table(name)


def attach(spark: SparkSession, path: str, buckets: int, sort: list[str]) -> DataFrame:
    """A table that ``write_bucketed`` has stored, registered anew (in another session, say)."""
    name = f"tripmart_{uuid.uuid4().hex[:12]}"
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({PART}) SORTED BY ({', '.join(sort)}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def is_hot(parted: DataFrame, buckets: int) -> bool:
    """Whether a bucket holds over ``HOT`` times the mean. The hash is the bucketing's own."""
    per = parted.groupBy(F.pmod(F.hash(PART), F.lit(buckets)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    r = per.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    return bool(r["rows"]) and r["most"] * buckets > HOT * r["rows"] and r["most"] > 100_000


def dim_datetime(clean: DataFrame) -> DataFrame:
    """ST1 from trips in buckets: pairs are found without a shuffle, keys are dense."""
    pairs = (clean.groupBy(PART, F.col(PICKUP).alias("pickup_datetime"), F.col(DROPOFF).alias("dropoff_datetime"))
                  .agg(F.min("trip_duration_min").alias("_dur")))
    keyed = dense_key(pairs, ["pickup_datetime", "dropoff_datetime"], "datetime_id")
    return S.with_calendar(keyed, PART)


def fact_trip(clean: DataFrame, dim: DataFrame) -> DataFrame:
    """ST6 + JN1 from trips and dimension in buckets: no side is shuffled."""
    d = dim.select(F.col(PART).alias("_part"), "datetime_id", F.col("pickup_datetime").alias("_p"), F.col("dropoff_datetime").alias("_d"))
    keyed = clean.join(d, (F.col(PART) == F.col("_part")) & (F.col(PICKUP) == F.col("_p")) & (F.col(DROPOFF) == F.col("_d")), "left")
    return keyed.select(PART, *S.fact_columns(clean))


def build_star(clean: DataFrame, root: str | None = None, buckets: int | None = None,
               zones: DataFrame | None = None) -> dict[str, DataFrame]:
    """PL2 with ``CLEAN``, ``DIM_DATETIME`` and ``FACT_TRIP`` stored in buckets under ``root`` (a
    fresh work folder unless given); the small dimensions are as in the plain star. Trips are read twice, for
    the rows of each bucket (pickup and dropoff only) and to be dealt: pass a materialised frame."""
    from tripmart.plans.jobs import stage

    spark = clean.sparkSession
    root = (root or work_dir(spark, "colocated")).rstrip("/")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parted = with_part(clean)
    if is_hot(parted, buckets):
        plain = stage(parted, "parted").drop(PART)
        return {"CLEAN": plain, **S.build_star(plain, zones)}
    # the keys of pair equality and dt_part are joined together, tables are bucketed by the latter
    with join_within_buckets(spark):
        trips = write_bucketed(parted, f"{root}/CLEAN", buckets, SORT["CLEAN"])
        dim = write_bucketed(dim_datetime(trips), f"{root}/DIM_DATETIME", buckets, SORT["DIM_DATETIME"])
        fact = write_bucketed(fact_trip(trips, dim), f"{root}/FACT_TRIP", buckets, SORT["FACT_TRIP"], deal=False)
    return {"CLEAN": trips, "DIM_DATETIME": dim, "DIM_LOCATION": S.dim_location(trips, zones), "DIM_VENDOR": S.dim_vendor(trips),
            "DIM_PAYMENT": S.dim_payment(trips), "DIM_RATE": S.dim_rate(trips), "FACT_TRIP": fact}


class join_within_buckets:
    """Spark's rule that a join's sides be split by all of its keys is off inside the block: being
    split by ``dt_part``, one of them, is enough. Plans are made when they run, so run them inside."""

    KEY = "spark.sql.requireAllClusterKeysForCoPartition"

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.before = self.spark.conf.get(self.KEY)
        self.spark.conf.set(self.KEY, "false")

    def __exit__(self, *_):
        self.spark.conf.set(self.KEY, self.before)


def checks(star: dict[str, DataFrame]) -> DataFrame:
    """CHK1-CHK4 and JN2 of a co-located star, staged: the fact is not shuffled."""
    from tripmart.plans.jobs import stage

    within = PART if PART in star["FACT_TRIP"].columns else None
    with join_within_buckets(star["FACT_TRIP"].sparkSession):
        return stage(star_checks({t: df for t, df in star.items() if t != "CLEAN"}, star["CLEAN"], within), "checks")
