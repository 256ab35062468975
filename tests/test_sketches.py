"""Summaries by month: bounds of merged quantiles and distinct counts."""
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripmart.operators import clean as C
from tripmart.operators import sketches as K
from tripmart.plans import jobs as P
from tripmart.schema import CAP_COLUMNS, PICKUP
from tripmart.sources.tables import trips


def _rows(seed=5, n=3000):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        day = dt.datetime(2025, 1 + i % 5, 1 + i % 28, 3)
        hot = 12.5 if rnd.random() < 0.35 else round(rnd.lognormvariate(2, 1), 2)
        out.append((day, hot, rnd.choice([1.0, 2.0, 3.0]), rnd.choice([None, float("nan"), rnd.random()])))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(_rows(), f"{PICKUP} timestamp_ntz, a double, b double, c double").repartition(7)


@pytest.mark.parametrize("size", [1, 7, 100, 10 ** 6])
def test_merged_quantiles_keep_their_bound(spark, table, size):
    cols = ["a", "b", "c"]
    parts = [K.quantile_summary(table.where(F.day(PICKUP) % 3 == i), cols, f"l{i}", size) for i in range(3)]
    every = P.stage(parts[0].unionByName(parts[1]).unionByName(parts[2]), "summaries")
    folded = K.fold(every, "f", size)
    assert every.groupBy(*K.KEYS).count().agg(F.max("count")).first()[0] <= size + 1
    values = {c: sorted(r[i] for r in _rows() if r[i] is not None and not math.isnan(r[i])) for i, c in enumerate(cols, 1)}
    for summaries in (every, folded):
        for q in (0.0, 0.01, 0.5, 0.99, 1.0):
            for r in K.merged_quantile(summaries, q).collect():
                v = values[r.column_name]
                assert r.rows == len(v) and r.rank_wanted == max(1, math.ceil(q * len(v)))
                below, upto = sum(x < r.threshold for x in v), sum(x <= r.threshold for x in v)
                assert upto >= r.rank_wanted and below <= r.rank_wanted - 1 + r.rank_slack
                if size == 10 ** 6:
                    assert r.rank_slack == 0 and r.threshold == v[r.rank_wanted - 1]
        assert summaries.where("slack < 0").count() == 0


def test_slack_follows_the_size(spark, table):
    for size in (10, 100):
        rows = K.merged_quantile(K.quantile_summary(table, ["a"], "x", size)).first()
        assert rows.rank_slack <= rows.rows / size


def test_a_load_that_is_run_again_replaces_itself(spark, table, tmp_path):
    path = str(tmp_path / "q")
    with pytest.raises(ValueError):
        K.stored(spark, path)
    for load, m in (("000000001", 1), ("000000002", 2), ("000000001", 1)):
        K.add(K.quantile_summary(table.where(F.month(PICKUP) == m), ["a"], load, 50), path)
    got = K.stored(spark, path)
    assert {int(r.load) for r in got.select("load").distinct().collect()} == {1, 2}
    n = table.where(F.month(PICKUP) <= 2).count()
    assert K.merged_quantile(got).first().rows == n
    assert K.merged_quantile(K.stored(spark, path, ["2025-02"])).first().rows == table.where(F.month(PICKUP) == 2).count()
    assert K.thresholds(got, ["a", "none"])["none"] is None


def test_empty_and_missing_values(spark, table):
    assert K.merged_quantile(K.quantile_summary(table.limit(0), ["a"], "x")).count() == 0
    assert K.quantile_summary(table.withColumn("a", F.lit(None).cast("double")), ["a"], "x").count() == 0
    none = K.distinct_summary(table.withColumn("a", F.lit(None).cast("double")), ["a"], "x")
    assert K.distinct_estimate(none).first().estimate == 0


def test_union_of_distinct_sketches(spark, tmp_path):
    df = spark.range(120_000).select((F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz")
                                      + F.make_dt_interval(F.col("id") % 150)).alias(PICKUP), (F.col("id") % 50_000).alias("k"))
    path = str(tmp_path / "d")
    for load in range(3):
        K.add(K.distinct_summary(df.where(F.col("id") % 3 == load), ["k"], str(load)), path)
    r = K.distinct_estimate(K.stored(spark, path)).first()
    assert r.sketches == 15 and abs(r.estimate - 50_000) <= K.HLL_ERROR * 50_000


def test_star_takes_caps_from_summaries(spark, tmp_path):
    pre = C.clean_prefix(trips(spark, SF_SMALL))
    cleaned, path = str(tmp_path / "cleaned"), str(tmp_path / "q")
    pre.withColumn("pickup_month", F.date_format(PICKUP, "yyyy-MM")).write.partitionBy("pickup_month").parquet(cleaned)
    K.add(K.quantile_summary(pre, CAP_COLUMNS, "1", 10 ** 6), path)
    exact = P.star_from_cleaned_table(spark, cleaned, cap_mode="disc")["CAPS"].first()
    summed = P.star_from_cleaned_table(spark, cleaned, summaries=path)["CAPS"].first()
    assert exact == summed
