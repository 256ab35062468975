"""Landing by content: replaced, touched, broken and half-landed files."""
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tripmart.schema import RAW
from tripmart.sources import landing as L

NAME = "yellow_tripdata_2025-{:02d}.parquet"


def _rows(spark, month, n, fare=1.0):
    cols = {"VendorID": F.lit(1), "fare_amount": F.lit(fare), "tpep_pickup_datetime": F.lit(f"2025-{month:02d}-03 10:00:00")}
    return spark.range(n).select(*[cols.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) if f.name != "PULocationID"
                                   else F.col("id").cast("int").alias("PULocationID") for f in RAW.fields])


def _put(spark, source, month, n, fare=1.0, parts=1, tmp=[0]):
    path = f"{source}/{NAME.format(month)}"
    if os.path.exists(path):
        tmp[0] += 1
        shutil.move(path, f"{source}-old{tmp[0]}")
    _rows(spark, month, n, fare).repartition(parts).write.parquet(path)


def _statuses(run):
    return {r.file_name[-10:-8]: r.status for r in run.collect()}


@pytest.fixture()
def zones(tmp_path):
    source, raw = str(tmp_path / "source"), str(tmp_path / "raw")
    os.makedirs(source)
    return source, raw


def test_arrivals_by_content(spark, zones):
    source, raw = zones
    for m in (1, 2, 3):
        _put(spark, source, m, 20)
    assert L.discovery_mark(spark, raw) is None
    assert L.counts(L.land_checked(spark, source, raw)) == {"uploaded": 3, "skipped": 0, "changed": 0, "failed": 0}
    run = L.land_checked(spark, source, raw)                      # nothing has changed: nothing is read
    assert {r.reason for r in run.collect()} == {"as recorded"} and L.counts(run)["skipped"] == 3
    _put(spark, source, 1, 20, parts=3)                             # the same trips in other files and another order
    _put(spark, source, 2, 20, fare=2.0)                            # same rows and size, other content
    _put(spark, source, 4, 5)
    with open(f"{source}/{NAME.format(5)}", "w") as f:
        f.write("not a trip file")
    run = L.land_checked(spark, source, raw)
    assert _statuses(run) == {"01": "skipped", "02": "quarantined", "03": "skipped", "04": "uploaded", "05": "failed"}
    said = {r.file_name[-10:-8]: r.reason for r in run.collect()}
    assert said["01"] == "same content" and "not a Parquet file" in said["05"]
    fares = lambda m: spark.read.parquet(f"{raw}/{NAME.format(m)}").agg(F.max("fare_amount")).first()[0]      # noqa: E731
    assert fares(2) == 1.0 and not os.path.exists(f"{raw}/{NAME.format(5)}")
    for _ in range(2):                                            # quarantined once, not again and again
        run = L.land_checked(spark, source, raw)
        assert _statuses(run) == {"01": "skipped", "02": "skipped", "03": "skipped", "04": "skipped", "05": "failed"}
    assert len(os.listdir(f"{raw}/_quarantine")) == 1
    run = L.land_checked(spark, source, raw, on_change="replace")
    assert _statuses(run)["02"] == "replaced" and fares(2) == 2.0
    assert L.counts(L.land_checked(spark, source, raw))["changed"] == 0
    kept = [f"{raw}/_replaced/{r}" for r in os.listdir(f"{raw}/_replaced")]
    assert spark.read.parquet(f"{kept[0]}/{NAME.format(2)}").agg(F.max("fare_amount")).first()[0] == 1.0      # the former version is kept
    mark = max(r.modified for r in L.records(spark, raw).collect())
    assert L.discovery_mark(spark, raw) == mark


def test_a_run_without_a_manifest_is_taken_up(spark, zones):
    source, raw = zones
    for m in (1, 2):
        _put(spark, source, m, 10)
    L.land_checked(spark, source, raw)
    shutil.move(f"{raw}/_manifest", f"{raw}-manifest")              # died before it wrote down what it did
    _put(spark, source, 2, 10, fare=9.0)
    assert _statuses(L.land_checked(spark, source, raw)) == {"01": "adopted", "02": "quarantined"}


def test_types_and_nulls_are_content(spark, zones):
    source, raw = zones
    _put(spark, source, 1, 10)
    L.land_checked(spark, source, raw)
    again = _rows(spark, 1, 10).withColumn("VendorID", F.col("VendorID").cast("long"))
    shutil.move(f"{source}/{NAME.format(1)}", f"{source}-was")
    again.write.parquet(f"{source}/{NAME.format(1)}")
    assert _statuses(L.land_checked(spark, source, raw)) == {"01": "quarantined"}
    b = _rows(spark, 1, 1).withColumns({"extra": F.lit(1.0), "fare_amount": F.lit(None).cast("double")})
    swapped = b.withColumns({"extra": F.lit(None).cast("double"), "fare_amount": F.lit(1.0)})
    checks = []
    for i, df in enumerate((b, swapped)):
        df.write.parquet(f"{source}-x{i}")
        checks.append(L._copied(spark, f"{source}-x{i}", None)[1])
    assert checks[0] != checks[1]


def test_empty_source_and_unknown_rule(spark, zones):
    source, raw = zones
    assert L.land_checked(spark, source, raw).count() == 0
    with pytest.raises(ValueError):
        L.land_checked(spark, source, raw, on_change="ignore")
