"""Surrogate keys that stay stable on a cluster.

``dense_key`` equals ``row_number() OVER (ORDER BY cols)`` without moving all
rows into one partition: rows are range-partitioned and sorted, numbered inside
each partition, written once (so a retry or a second reader sees the same
numbers), and shifted by the row count of the earlier partitions. The offsets
table has one row per partition, so broadcasting it is bounded by the
partition count, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.schema import RAW_COLUMNS

MAP_BITS = 26   # bits of a map of keys: at most 2**20 rows of 64 are broadcast
_ROW_BITS = 33  # monotonically_increasing_id: partition index << 33 | row in partition


def dense_key(df: DataFrame, cols: list[str], name: str,
              num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based global rank of each row by ``cols`` (rows unique on ``cols``)."""
    from tripmart.plans.jobs import stage

    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = stage(ranged, "dense-key")
    pid = F.shiftright("_mid", _ROW_BITS)
    row = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    counts = tagged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), pid == F.col("_pid"))
    return out.select(*df.columns, (F.col("_off") + row + 1).cast("bigint").alias(name))


def hash_key(*cols: str) -> Column:
    """64-bit hash key; needs no sort and no join, check uniqueness with CHK2.

    ``xxhash64`` skips NULL inputs, so (NULL, x) and (x, NULL) would collide:
    null flags are hashed along with the values.
    """
    parts = []
    for c in cols:
        parts += [F.col(c), F.isnull(F.col(c))]
    return F.xxhash64(*parts)


RAW_KEY = ["trip_id", "raw_check"]


def with_raw_key(df: DataFrame) -> DataFrame:
    """Add two independent 64-bit hashes of the raw columns a frame has: together
    they name a raw row. Equal on every run and for any partitioning."""
    cols = [c for c in RAW_COLUMNS if c in df.columns]
    flags = [x for c in cols for x in (F.col(c), F.isnull(F.col(c)))]
    return df.withColumns({RAW_KEY[0]: hash_key(*cols), RAW_KEY[1]: F.xxhash64(F.lit(1), *flags)})


def perhaps_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose 64-bit hash ``key`` is in ``keys`` (one column of that name), and perhaps others: they are told by a
    bit map of fixed size, so that no other row is moved. A map that fills up lets more rows through, it loses none."""
    place = F.shiftrightunsigned(key, 64 - MAP_BITS)
    at = [F.shiftright(place, 6).alias("_cell"), place.bitwiseAND(F.lit(63)).cast("int").alias("_at")]
    bits = keys.select(*at).groupBy("_cell").agg(F.expr("bit_or(shiftleft(1L, _at))").alias("_bits"))
    return (df.select("*", *at).join(F.broadcast(bits), "_cell").filter(F.expr("getbit(_bits, _at) = 1"))
              .drop("_cell", "_at", "_bits"))
