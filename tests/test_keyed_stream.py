"""Arrivals with keyed state: repeated and late files, restarts, cost of a batch."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripmart.operators.clean import clean_prefix
from tripmart.operators import sketches as SK
from tripmart.operators.keys import RAW_KEY
from tripmart.plans import jobs as P
from tripmart.sources import files as FS
from tripmart.sources.tables import trips
from tripmart.streaming import keyed as K

PICKUP = "tpep_pickup_datetime"


@pytest.fixture(scope="module")
def months(spark):
    t = P.stage(trips(spark, SF_SMALL).where(F.date_format(PICKUP, "yyyy-MM").isin("1995-01", "1995-02", "1995-03")), "few")
    return {m: t.where(F.month(PICKUP) == m) for m in (1, 2, 3)}


def _deliver(rows, landing, tmp_path, n):
    """Files of one delivery, part files under names of their own."""
    import os
    import shutil
    src = str(tmp_path / f"delivery{n}")
    for name in FS.write_trip_files(rows, src):
        os.makedirs(f"{landing}/{name}", exist_ok=True)
        for f in os.listdir(f"{src}/{name}"):
            if f.startswith("part-"):
                shutil.copy(f"{src}/{name}/{f}", f"{landing}/{name}/d{n}-{f}")


def _same(a, b):
    return a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_repeated_and_late_files_and_restarts(spark, months, tmp_path):
    landing, work, out = (str(tmp_path / x) for x in ("landing", "work", "cleaned"))
    everything = months[1].unionByName(months[2]).unionByName(months[3])
    _deliver(months[2], landing, tmp_path, 0)
    one = K.ingest(spark, landing, work, out)
    distinct = months[2].distinct().count()
    assert one == {"input_rows": distinct, "new_keys": distinct, "known_keys": distinct}
    assert K.ingest(spark, landing, work, out) == {"input_rows": 0, "new_keys": 0, "known_keys": 0}      # nothing new, a restart
    _deliver(months[2], landing, tmp_path, 1)                       # all of it again, under new names
    again = K.ingest(spark, landing, work, out)
    assert again["input_rows"] == distinct and again["new_keys"] == 0 and again["known_keys"] == distinct
    _deliver(months[1].unionByName(months[3]).unionByName(months[2].limit(50)), landing, tmp_path, 2)     # an older month, a newer one, old trips
    last = K.ingest(spark, landing, work, out)
    n = months[1].distinct().count() + months[3].distinct().count()
    assert last["new_keys"] == n and last["known_keys"] == n + distinct
    # the cost of a batch follows the batch: it reads what has arrived, whatever the table holds
    assert n <= last["input_rows"] <= n + 50
    got = K.read_cleaned(spark, out).drop(K.MONTH, *RAW_KEY)
    want = clean_prefix(everything)
    assert _same(got.select(want.columns), want)


def test_a_batch_run_again_writes_the_same(spark, months, tmp_path):
    """A crash after the write and before the checkpoint's commit: the batch is run again."""
    import os
    landing, work, out = (str(tmp_path / x) for x in ("landing", "work", "cleaned"))
    _deliver(months[1], landing, tmp_path, 0)
    sums = str(tmp_path / "summaries")
    K.ingest(spark, landing, work, out, summaries=sums)
    assert SK.merged_quantile(SK.stored(spark, sums)).first().rows == K.read_cleaned(spark, out).count()
    before = sorted(map(str, K.read_cleaned(spark, out).collect()))
    for chk in ("chk-conform", "chk-keyed"):
        done = f"{work}/{chk}/commits"
        last = max((f for f in os.listdir(done) if f.isdigit()), key=int)
        os.rename(f"{done}/{last}", str(tmp_path / f"{chk}-{last}"))
        crc = f"{done}/.{last}.crc"
        if os.path.exists(crc):
            os.rename(crc, str(tmp_path / f"{chk}-{last}.crc"))
    K.ingest(spark, landing, work, out, summaries=sums)
    assert sorted(map(str, K.read_cleaned(spark, out).collect())) == before
    assert SK.merged_quantile(SK.stored(spark, sums)).first().rows == len(before)


def test_keys_are_forgotten_after_their_time(spark, tmp_path):
    """The watermark follows arrival: a key older than ``memory`` leaves the state, and no trip is late."""
    rows = spark.range(3).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name != "VendorID" else F.col("id").cast("int").alias("VendorID")
                                   for f in K.RAW.fields])
    folder, work = str(tmp_path / "conformed"), str(tmp_path / "chk")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", K.ROCKSDB)

    def arrive(n, day):
        rows.withColumn(K.ARRIVED, F.lit(day).cast("timestamp")).write.parquet(f"{folder}/load={n:09d}")
        q = (K.first_arrivals(spark, folder, "10 days").writeStream.format("noop").outputMode("append")
             .option("checkpointLocation", work).trigger(availableNow=True).start())
        q.awaitTermination()
        ops = [s for p in q.recentProgress for s in p["stateOperators"]]
        return sum(s["numRowsUpdated"] for s in ops), sum(s["numRowsDroppedByWatermark"] for s in ops)

    assert arrive(0, "2025-01-01") == (3, 0) and arrive(1, "2025-01-05") == (0, 0)
    assert arrive(2, "2025-03-01")[1] == 0 and arrive(3, "2025-03-20") == (3, 0)
