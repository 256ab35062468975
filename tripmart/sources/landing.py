"""Content-aware landing (SRC4, SRC5): a manifest knows what every landed file held.

Testing by name alone misses a file that its owner has replaced. Here each run compares the
source with the manifest of earlier runs under ``<raw zone>/_manifest``:

* size and change time as recorded: skipped, without being read;
* a new name, size or time: the file is copied into a hidden folder of the run, and its
  content checksum (rows, and the sum of the rows' hashes, whatever their order) is taken while
  it is copied;
* the checksum of the landed version: skipped (it was only touched);
* another checksum under a landed name: **changed**. ``on_change="quarantine"`` keeps the landed
  version and puts the new one under ``_quarantine/<run>``; ``"replace"`` swaps it in and puts the
  landed one under ``_replaced/<run>``;
* unreadable: **failed**, with the reason; the next run tries again.

Files appear in the zone by one rename. A run that dies before it writes its manifest leaves
files the next run finds in the zone: they are compared by content as well (**adopted** if alike).
The manifest also holds the discovery mark, the latest change time seen.
"""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.session import has_data
from tripmart.sources.files import manifest as listing_with_names

RECORD = ("run string, file_name string, status string, reason string, bytes long, modified timestamp, rows long, checksum string")
IN_QUARANTINE = "in quarantine"
LANDED = ("uploaded", "replaced", "adopted")


def records(spark: SparkSession, raw_zone: str) -> DataFrame:
    """All records of all runs."""
    path = f"{raw_zone.rstrip('/')}/_manifest"
    if not has_data(spark, path):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).option("recursiveFileLookup", "true").parquet(path)


def _latest(rec: DataFrame, suffix: str) -> DataFrame:
    """The newest of some records of each file."""
    first = Window.partitionBy("file_name").orderBy(F.desc("run"))
    return (rec.withColumn("_i", F.row_number().over(first)).where("_i = 1").select("file_name", *[F.col(c).alias(f"{c}_{suffix}") for c in ("status", "reason", "bytes", "modified", "rows", "checksum")]))


def discovery_mark(spark: SparkSession, raw_zone: str):
    """The latest change time of any file seen; None before the first run."""
    return records(spark, raw_zone).agg(F.max("modified")).first()[0]


def _copied(spark: SparkSession, src: str, dst: str | None) -> tuple[int, str]:
    """Rows and checksum of a trip file, taken while it is written to ``dst`` (or only read)."""
    df = spark.read.parquet(src)
    cols = sorted(df.columns)
    flags = [x for c in cols for x in (F.col(f"`{c}`"), F.isnull(F.col(f"`{c}`")))]
    stats = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*flags).cast("decimal(38,0)")).alias("h")]
    if dst is None:
        got = df.agg(*stats).first().asDict()
    else:
        seen = Observation(uuid.uuid4().hex)
        df.observe(seen, *stats).write.parquet(dst)
        got = seen.get
    names = ",".join(f"{c}:{df.schema[c].dataType.simpleString()}" for c in cols)
    return got["n"], f"{got['n']}:{got['h']}:{zlib.crc32(names.encode()):08x}"


def _reason(e: Exception) -> str:
    """The innermost cause that the error's text names."""
    lines = str(e).splitlines() or [""]
    causes = [x.removeprefix("Caused by: ") for x in lines if x.startswith("Caused by: ")]
    return (causes[-1] if causes else f"{type(e).__name__}: {lines[0]}")[:300]


def land_checked(spark: SparkSession, source: str, raw_zone: str, colour: str = "yellow",
                 on_change: str = "quarantine") -> DataFrame:
    """Land the files of one colour; the records of this run (``RECORD``), one per source file."""
    if on_change not in ("quarantine", "replace"):
        raise ValueError(f"unknown rule {on_change!r}")
    from tripmart.plans.jobs import write_concurrently
    from tripmart.sources.sinks import new_run_id

    root, run = raw_zone.rstrip("/"), new_run_id()
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hpath(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hpath(root))
    rec = records(spark, raw_zone)
    in_zone = {r.file_name for r in listing_with_names(spark, root).select("file_name").collect()} if has_data(spark, root) else set()   # names only
    src = listing_with_names(spark, source).where(F.col("valid_name") & (F.col("colour") == colour))
    rows = (src.select("file_name", "bytes", "modified")
            .join(_latest(rec.where(F.col("status").isin(*LANDED)), "landed"), "file_name", "left")
            .join(_latest(rec.where("status <> 'failed'"), "seen"), "file_name", "left").collect())     # one row a file
    hidden = f"{root}/_land-{run}"

    def move(a, b):
        fs.mkdirs(hpath(b).getParent())
        if not fs.rename(hpath(a), hpath(b)):
            raise OSError(f"could not move {a} to {b}")

    def one(r):
        name = r.file_name
        out = {"run": run, "file_name": name, "bytes": r.bytes, "modified": r.modified, "reason": None}
        shut = r.status_seen == "quarantined" or r.reason_seen == IN_QUARANTINE
        if r.bytes == r.bytes_seen and r.modified == r.modified_seen and not (shut and on_change == "replace"):
            return {**out, "status": "skipped", "reason": IN_QUARANTINE if shut else "as recorded", "rows": r.rows_seen, "checksum": r.checksum_seen}
        try:
            n, check = _copied(spark, f"{source.rstrip('/')}/{name}", f"{hidden}/{name}")
            out |= {"rows": n, "checksum": check}
            landed = r.checksum_landed
            if landed is None and name in in_zone:            # left by a run that wrote no manifest
                landed = _copied(spark, f"{root}/{name}", None)[1]
                if landed == check:
                    return {**out, "status": "adopted"}
            if landed is None:
                move(f"{hidden}/{name}", f"{root}/{name}")
                return {**out, "status": "uploaded"}
            if landed == check:
                return {**out, "status": "skipped", "reason": "same content"}
            if on_change == "quarantine":
                if shut and r.checksum_seen == check:
                    return {**out, "status": "skipped", "reason": IN_QUARANTINE}
                move(f"{hidden}/{name}", f"{root}/_quarantine/{run}/{name}")
                return {**out, "status": "quarantined", "reason": "content differs from the landed file"}
            move(f"{root}/{name}", f"{root}/_replaced/{run}/{name}")
            move(f"{hidden}/{name}", f"{root}/{name}")
            return {**out, "status": "replaced", "reason": "content differs from the landed file"}
        except Exception as e:  # noqa: BLE001 - recorded with its reason; the other files go on
            return {**out, "status": "failed", "reason": _reason(e), "rows": None, "checksum": None}

    done = write_concurrently({r.file_name: (lambda r=r: one(r)) for r in rows})
    fs.delete(hpath(hidden), True)
    fields = [f.split()[0] for f in RECORD.split(", ")]
    told = spark.createDataFrame([tuple(d[c] for c in fields) for d in done.values()], RECORD)
    told.coalesce(1).write.parquet(f"{root}/_manifest/{run}")
    return told


def counts(run: DataFrame) -> dict[str, int]:
    """Files of a run by outcome: uploaded (with adopted), skipped, changed, failed."""
    got = {r.status: r["count"] for r in run.groupBy("status").count().collect()}
    return {"uploaded": got.get("uploaded", 0) + got.get("adopted", 0), "skipped": got.get("skipped", 0),
            "changed": got.get("quarantined", 0) + got.get("replaced", 0), "failed": got.get("failed", 0)}
