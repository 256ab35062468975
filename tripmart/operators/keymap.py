"""Datetime keys that outlast a load (ST1, FN5).

A key map is a folder of segments, one for each load that met new pairs of pickup and
dropoff, and of commits:

    <path>/segments/load=<id>/pickup_month=2025-03/...   (pickup, dropoff, datetime_id)
    <path>/commits/000002                                "<id> <high-water mark> <whole>"

A load's new pairs are found by an anti join with the stored ones of the months it touches
and numbered in order from the high-water mark on, without a single-partition window. Keys
are dense and unique over all loads and never change. A segment counts only once a commit
names it; the commit file is created exclusively, so of two loads that extend one version at
the same time one fails and can be run again. ``compact`` folds all segments into one
(``whole``), which readers then start from.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.keys import dense_key

PAIR = ["pickup_datetime", "dropoff_datetime"]
MONTH = "pickup_month"
SCHEMA = f"pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, datetime_id bigint, load string, {MONTH} string"


class KeyMap:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hpath(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def commits(self) -> list[tuple[int, str, int, bool]]:
        """(version, segment, high-water mark, whole) of every commit, oldest first."""
        if not self._fs.globStatus(self._hpath(f"{self.path}/commits/*")):
            return []
        rows = self.spark.read.text(f"{self.path}/commits").select(F.element_at(F.split("_metadata.file_path", "/"), -1), "value").collect()
        return sorted((int(v), *self._parsed(line)) for v, line in rows)

    @staticmethod
    def _parsed(line: str) -> tuple[str, int, bool]:
        load, mark, whole = line.split()
        return load, int(mark), whole == "1"

    def high_water(self) -> int:
        """The largest key given so far."""
        done = self.commits()
        return done[-1][2] if done else 0

    def read(self, months: list[str] | None = None) -> DataFrame:
        """The committed keys (pickup, dropoff, datetime_id, month), of all months or of some."""
        done = self.commits()
        since = max((i for i, c in enumerate(done) if c[3]), default=0)
        paths = [f"{self.path}/segments/load={c[1]}" for c in done[since:]]
        if not paths:
            return self.spark.createDataFrame([], SCHEMA).drop("load")
        rows = self.spark.read.schema(SCHEMA).option("basePath", f"{self.path}/segments").parquet(*paths).drop("load")
        return rows if months is None else rows.where(F.col(MONTH).isin(months))

    def extend(self, pairs: DataFrame) -> list[str]:
        """Give keys to the pairs that have none; the months of all of them."""
        from tripmart.plans.jobs import stage

        rows = stage(pairs.select(*PAIR).distinct().withColumn(MONTH, F.date_format(PAIR[0], "yyyy-MM")), "pairs")
        months = sorted(r[0] for r in rows.select(MONTH).distinct().collect())          # bounded by the calendar
        done = self.commits()
        new, seen = stage(rows.join(self.read(months).select(*PAIR), PAIR, "left_anti"), "new-pairs",
                          observe=[F.count(F.lit(1)).alias("n")])
        if seen["n"]:
            high = done[-1][2] if done else 0
            keyed = dense_key(new, PAIR, "datetime_id").withColumn("datetime_id", F.col("datetime_id") + F.lit(high))
            self._add(keyed, done[-1][0] + 1 if done else 1, high + seen["n"], False)
        return months

    def compact(self) -> None:
        """Fold all segments into one; keys stay."""
        done = self.commits()
        if done:
            self._add(self.read(), done[-1][0] + 1, done[-1][2], True)

    def _add(self, keyed: DataFrame, version: int, mark: int, whole: bool) -> None:
        load = uuid.uuid4().hex[:16]
        keyed.hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(f"{self.path}/segments/load={load}")
        marker = self._hpath(f"{self.path}/commits/{version:06d}")
        self._fs.mkdirs(marker.getParent())
        try:
            out = self._fs.create(marker, False)
        except Py4JJavaError as e:
            raise RuntimeError(f"version {version} of {self.path} is taken: run the load again") from e
        out.writeBytes(f"{load} {mark} {int(whole)}\n")
        out.close()

    def keyed(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with their ``datetime_id``, new ones included."""
        from tripmart.plans.jobs import stage

        pairs = stage(pairs, "pairs")
        months = self.extend(pairs)
        return pairs.join(self.read(months).drop(MONTH), PAIR)
