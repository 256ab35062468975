"""Trip file sources: scans, landing-zone manifest and validation (SRC1-SRC9).

Listings are DataFrames built from Spark's own file metadata (``binaryFile``
with only metadata columns selected, so file contents are never read), so a
landing zone with many files is listed in parallel and checked with
aggregates, not a driver loop.
"""

from __future__ import annotations

import uuid
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.schema import RAW, STAR, TRIPDATA_PATTERN

FILE_GLOB = "*_tripdata_*.parquet"


def trip_glob(path: str, colour: str = "yellow") -> str:
    """Trip files of one colour under ``path``: single Parquet files or
    Spark-written folders of part files, named ``<colour>_tripdata_<YYYY-MM>.parquet``."""
    return f"{path.rstrip('/')}/{colour}_tripdata_*.parquet"


def entry_name(path_col: str = "_metadata.file_path"):
    """Top-level trip file (or folder) name of a scanned row's file."""
    return F.regexp_extract(F.col(path_col), r"/([^/]*_tripdata_[^/]*\.parquet)(/[^/]*)?$", 1)


def trip_entries(spark: SparkSession, path: str, colour: str = "yellow") -> list[str]:
    """Paths of the trip files or folders of one colour (one per month)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(trip_glob(path, colour))
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(st.getPath().toString() for st in found or [])


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, cast; absent ones NULL; names in any case."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])


def read_files(spark: SparkSession, paths: list[str], schema: T.StructType = RAW, keep: list | None = None) -> DataFrame:
    """Parquet files that may differ in columns and types: each is read with its
    own schema and cast. Files with the same schema share one scan, so the plan
    grows with the number of schemas, not of files. ``keep``: further columns."""
    from tripmart.plans.jobs import write_concurrently

    own = write_concurrently({p: (lambda p=p: spark.read.parquet(p).schema) for p in paths}, 8)   # footers only
    alike: dict[str, list[str]] = {}
    for p in paths:
        alike.setdefault(own[p].simpleString(), []).append(p)
    keep = keep or []
    extra = T.StructType([T.StructField(n, t) for n, t, _ in keep])
    parts = []
    for same in alike.values():
        df = spark.read.schema(own[same[0]]).parquet(*same)
        if keep:
            df = df.select("*", *[c.alias(n) for n, _, c in keep])
        parts.append(conformed(df, T.StructType([*schema.fields, *extra.fields])))
    return reduce(DataFrame.unionByName, parts)


def read_trips(spark: SparkSession, path: str, schema: T.StructType = RAW,
               colour: str = "yellow", with_file: bool = False) -> DataFrame:
    """SRC1: scan the ``<colour>_tripdata_*.parquet`` files of a folder. Only the
    colour whose columns the schema names is read (other colours name their
    timestamps differently). Months that lack a column or hold it in another
    type (INT64 counts and codes, say) are cast to ``schema``. ``with_file``
    adds the file's name as ``source_file``."""
    paths = trip_entries(spark, path, colour)
    if not paths:       # raises PATH_NOT_FOUND, as a scan of the pattern does
        return spark.read.schema(schema).parquet(trip_glob(path, colour))
    return read_files(spark, paths, schema, [("source_file", T.StringType(), entry_name())] if with_file else None)


def load_file(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC2: one Parquet file or folder; a missing path raises PATH_NOT_FOUND."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.parquet(path)


def as_frame(spark: SparkSession, data) -> DataFrame:
    """SRC3: accept a DataFrame or a path; anything else raises TypeError."""
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, (str, Path)):
        return load_file(spark, str(data))
    raise TypeError("Input must be a DataFrame or a valid file path")


def new_files(spark: SparkSession, path: str, modified_after: str | None = None) -> DataFrame:
    """SRC4 (batch): trip files by name pattern, newer than the last run
    (``modified_after`` as 'YYYY-MM-DDTHH:MM:SS')."""
    r = spark.read.format("binaryFile")
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    paths = [r_.path for r_ in r.load(trip_glob(path)).select("path").collect()]    # names only
    if not paths:
        return spark.createDataFrame([], RAW).withColumn("source_file", F.lit(None).cast("string"))
    return read_files(spark, paths, keep=[("source_file", T.StringType(), entry_name())])


def _qualified(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Top-level entries under ``path`` (a file, or a folder of part files)
    with their total size, file count and last change; contents are pruned."""
    root = _qualified(spark, path).rstrip("/") + "/"
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                  .load(path).select("path", "length", "modificationTime"))
    rel = F.expr(f"substring(path, {len(root) + 1})")
    top = F.split(rel, "/").getItem(0)
    return (files.where(~rel.startswith("_") & ~rel.startswith("."))
                 .groupBy(top.alias("file_name"))
                 .agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"),
                      F.max("modificationTime").alias("modified"))
                 .withColumn("path", F.concat(F.lit(root), F.col("file_name"))))


def with_name_parts(files: DataFrame) -> DataFrame:
    """SRC8: colour and period from ``<colour>_tripdata_<YYYY-MM>.parquet``."""
    stem = F.regexp_replace("file_name", r"\.parquet$", "")
    return files.select(
        "*", F.col("file_name").rlike(TRIPDATA_PATTERN).alias("valid_name"),
        F.regexp_extract(stem, r"^(.*)_tripdata_", 1).alias("colour"),
        F.when(F.col("file_name").contains("_tripdata_"),
               F.regexp_extract(stem, r"_tripdata_(.*)$", 1)).otherwise(F.lit("?")).alias("period"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Landing manifest: one row per file with its name parts."""
    return with_name_parts(listing(spark, path))


def validate_landing(spark: SparkSession, path: str, min_files: int = 1,
                     colour: str | None = "yellow", period: str | None = None) -> DataFrame:
    """SRC7: the landing zone exists, names match, at least ``min_files`` valid
    files, and - when ``period`` ('YYYY-MM', e.g. the run date's month) is
    given - a file for that period. Raises on failure; returns the per-period
    summary otherwise."""
    m = manifest(spark, path)                       # PATH_NOT_FOUND if missing
    valid = m.where("valid_name")
    if colour:
        valid = valid.where(F.col("colour") == colour)
    per_period = valid.groupBy("colour", "period").agg(F.count(F.lit(1)).alias("files"),
                                                       F.sum("bytes").alias("bytes"))
    total = valid.count()
    if total < min_files:
        raise ValueError(f"expected >= {min_files} valid trip file(s) in {path}, found {total}")
    if period is not None and valid.where(F.col("period") == period).limit(1).count() == 0:
        raise ValueError(f"no {colour or ''} trip file for period {period} in {path}")
    return per_period


def file_counts(spark: SparkSession, path: str, colour: str = "yellow") -> DataFrame:
    """Manifest of the trip files with the trips each holds (one scan of the
    files, grouped by file): the per-period check of the landing zone."""
    rows = (read_trips(spark, path, colour=colour, with_file=True)
            .groupBy(F.col("source_file").alias("file_name")).agg(F.count(F.lit(1)).alias("trips")))
    return with_name_parts(rows).select("file_name", "colour", "period", "valid_name", "trips")


def land(spark: SparkSession, source: str, raw_zone: str, colour: str = "yellow") -> dict[str, int]:
    """SRC5: land files of one colour not already in the raw zone; counts by status.

    Files keep their names, columns and types. The landed set is the raw zone's
    own listing, so re-running lands nothing twice. A file is written under a
    hidden run folder first and appears in the zone by one rename: a broken copy
    counts as ``failed``, is not seen by readers and is landed by the next run.
    """
    from tripmart.plans.jobs import write_concurrently

    src = manifest(spark, source).where(F.col("valid_name") & (F.col("colour") == colour))
    landed = landed_files(spark, raw_zone)
    names = [r.file_name for r in src.join(landed, "file_name", "left_anti")
                                     .select("file_name").collect()]     # file names only
    skipped = src.join(landed, "file_name", "left_semi").count()
    root = raw_zone.rstrip("/")
    run = f"{root}/_land-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path
    fs = hpath(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hpath(root))

    def copy(name):
        try:
            spark.read.parquet(f"{source.rstrip('/')}/{name}").write.parquet(f"{run}/{name}")
            return bool(fs.rename(hpath(f"{run}/{name}"), hpath(f"{root}/{name}")))
        except Exception:  # noqa: BLE001 - reported by count; the file stays out of the zone
            return False
    done = write_concurrently({n: (lambda n=n: copy(n)) for n in names})
    fs.delete(hpath(run), True)
    return {"uploaded": sum(done.values()), "skipped": skipped, "failed": len(names) - sum(done.values())}


def write_trip_files(trips: DataFrame, folder: str, colour: str = "yellow", split: str | None = None, by_month: bool = False) -> list[str]:
    """Write trips in the landing layout: one ``<colour>_tripdata_<YYYY-MM>.parquet``
    per pickup month, each a folder of part files. Rows are rebalanced by month
    (AQE splits a large month over several tasks by size), so no month goes
    through one task and each folder holds few files. ``split``: a column that parts
    each month's folder further (``<file>/<split>=<value>``). ``by_month``: the rows lie by month already
    (they come from such files), so they are written from where they lie."""
    spark = trips.sparkSession
    tmp = f"{folder.rstrip('/')}/_tmp"
    period = F.date_format(F.col("tpep_pickup_datetime"), "yyyy-MM")
    rows = trips.withColumn("_period", period)
    ((rows if by_month else rows.hint("rebalance", "_period"))
          .write.mode("overwrite").partitionBy("_period", *([split] if split else [])).parquet(tmp))
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path
    fs = hpath(tmp).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = []
    for st in fs.globStatus(hpath(f"{tmp}/_period=*")):      # one rename per month folder
        name = f"{colour}_tripdata_{st.getPath().getName().split('=', 1)[1]}.parquet"
        fs.rename(st.getPath(), hpath(f"{folder.rstrip('/')}/{name}"))
        names.append(name)
    fs.delete(hpath(tmp), True)
    return sorted(names)


def landed_files(spark: SparkSession, raw_zone: str) -> DataFrame:
    """Names of the trip files already in the raw zone."""
    from tripmart.session import has_data
    if not has_data(spark, raw_zone):          # nothing landed yet
        return spark.createDataFrame([], "file_name string")
    return manifest(spark, raw_zone).where("valid_name").select("file_name")


def read_star_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """SRC9: a star table written as headed CSV, read back with its schema. The
    small dimensions hold free text, where ``multiLine`` keeps quoted newlines
    inside one record; the others have none and stay splittable."""
    from tripmart.sources.sinks import SMALL_TABLES
    return (spark.read.schema(STAR[table]).option("header", True).option("multiLine", table in SMALL_TABLES)
                 .option("escape", '"').csv(path))
