"""Clustered layout of the fact for slices by time and zone (MA14, SRC1).

Rows are ordered along a space-filling curve (the bits of the time's and the zone's place
interleaved), so each file holds a small box of both and a slice by either or both reads
few files. An index of the files' smallest and largest values is kept beside them, under
``_index``: ``read_slice`` looks the files up there and opens no other.

Places are equal steps between the column's smallest and largest value; files are cut by range
partitioning on the curve, so they are about equally long however uneven the zones are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 10


def _number(c: str, df: DataFrame) -> Column:
    """A column as a number to place it by (zone-less times as seconds)."""
    if df.schema[c].dataType.simpleString() == "timestamp_ntz":
        return F.unix_timestamp(F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
    return F.col(c).cast("double")


def interleaved(places: list[Column], bits: int = BITS) -> Column:
    """The places' bits in turn, highest first, as one number."""
    k = len(places)
    parts = [F.shiftleft(F.shiftright(p, b).bitwiseAND(F.lit(1)).cast("long"), b * k + k - 1 - i)
             for i, p in enumerate(places) for b in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def curve(df: DataFrame, cols: list[str], bits: int = BITS) -> Column:
    """Place on the curve through ``cols``; NULL stands first."""
    num = {c: _number(c, df).cast("double") for c in cols}
    r = df.agg(*[f(num[c]).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    top = (1 << bits) - 1
    places = []
    for i, c in enumerate(cols):
        lo, hi = r[f"lo{i}"], r[f"hi{i}"]
        step = (hi - lo) / top if lo is not None and hi > lo else 1.0
        at = F.floor((num[c] - F.lit(lo or 0.0)) / F.lit(step)).cast("int")
        places.append(F.coalesce(F.least(F.greatest(at, F.lit(0)), F.lit(top)), F.lit(0)))
    return interleaved(places, bits)


def write_clustered(df: DataFrame, path: str, cols: list[str], files: int) -> None:
    """Write ``df`` (materialised: it is read for the bounds of ``cols`` first) along the curve into
    about ``files`` files, with their index."""
    spark = df.sparkSession
    (df.withColumn("_z", curve(df, cols)).repartitionByRange(files, "_z", cols[0]).sortWithinPartitions("_z")
       .drop("_z").write.mode("overwrite").parquet(path))
    back = spark.read.parquet(path)
    index = back.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))])
    index.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/_index")


def files_of_slice(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> tuple[list[str], int]:
    """Files that may hold rows with every column in its (low, high) range, ends included, and how many there are."""
    index = spark.read.parquet(f"{path.rstrip('/')}/_index")
    hit = reduce(lambda a, b: a & b, [(F.col(f"max_{c}") >= F.lit(lo)) & (F.col(f"min_{c}") <= F.lit(hi)) for c, (lo, hi) in ranges.items()])
    rows = index.select("file", hit.alias("hit")).collect()               # names of files
    return sorted(r.file for r in rows if r.hit), len(rows)


def read_slice(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> DataFrame:
    """Rows with every column in its range, from the files that may hold any."""
    files, _ = files_of_slice(spark, path, ranges)
    whole = spark.read.parquet(path)
    rows = spark.read.schema(whole.schema).parquet(*files) if files else whole.limit(0)
    return rows.where(reduce(lambda a, b: a & b, [F.col(c).between(F.lit(lo), F.lit(hi)) for c, (lo, hi) in ranges.items()]))
