"""Invariants at small scale: star integrity, partition-count independence,
exact quantiles digit by digit, skew-safe forward fill."""
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripmart.operators import clean as C
from tripmart.operators import impute as I
from tripmart.operators import profile as PR
from tripmart.operators import quantiles as Q
from tripmart.operators import star as S
from tripmart.operators.checks import star_checks
from tripmart.operators.keys import dense_key
from tripmart.plans import jobs as P
from tripmart.sources.tables import trips


@pytest.fixture(scope="module")
def clean(spark):
    return P.clean_job(trips(spark, SF_SMALL), cap_mode="disc", trip_id=True)


def test_fixture_counts(spark, clean):
    raw = trips(spark, SF_SMALL)
    assert raw.count() == 6116
    assert C.dedupe(raw).count() == 6000
    assert clean.count() == 4402


def test_star_integrity(spark, clean):
    star = S.build_star(clean)
    assert star["FACT_TRIP"].count() == clean.count()
    bad = star_checks(star, clean).where("violations > 0").collect()
    assert bad == []


def test_caps_hold(spark, clean):
    from tripmart.schema import CAP_COLUMNS
    limits = Q.thresholds(P.stage(C.clean_prefix(trips(spark, SF_SMALL))), CAP_COLUMNS, 0.99, "disc")
    maxima = clean.agg(*[F.max(c).alias(c) for c in CAP_COLUMNS]).first()
    for c in CAP_COLUMNS:
        assert maxima[c] == limits[c]          # capped at the threshold, which is a data value


def test_dedupe_filter_idempotent(spark):
    once = C.valid_trips(C.with_duration(C.dedupe(trips(spark, SF_SMALL))))
    twice = C.valid_trips(C.dedupe(once))
    assert once.count() == twice.count()


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_dense_key_equals_row_number(spark, parts):
    pairs = (trips(spark, SF_SMALL).select("tpep_pickup_datetime", "tpep_dropoff_datetime").distinct())
    ours = dense_key(pairs, ["tpep_pickup_datetime", "tpep_dropoff_datetime"], "k", num_partitions=parts)
    ref = pairs.withColumn("k", F.row_number().over(
        Window.orderBy("tpep_pickup_datetime", "tpep_dropoff_datetime")))
    assert ours.exceptAll(ref).count() == 0 and ours.count() == ref.count()


@pytest.mark.parametrize("few", [0, 1 << 17])
def test_exact_quantiles_digit_by_digit(spark, monkeypatch, few):
    """All four digits are walked, or the values of small bins are told at once; compare with
    Spark's exact percentile functions."""
    monkeypatch.setattr(Q, "FEW", few)
    rnd = random.Random(7)
    vals = [rnd.random() * 1000 for _ in range(12000)] + [500.0] * 7000                     # a hot value
    vals += [-rnd.random() * 10 ** rnd.randint(-300, 300) for _ in range(3000)] + [0.0, -0.0, 1.0, 1.0 + 2 ** -52, float("inf")]
    df = spark.createDataFrame([(v, None if v < 0 else -v, float("nan")) for v in vals] + [(None, None, None), (float("nan"),) * 3],
                               "v double, w double, none double").repartition(6)
    ps = [0.0, 0.01, 0.5, 0.99, 1.0]
    for c in ("v", "w"):
        ok = df.where(f"{c} is not null and not isnan({c})")
        ref = ok.agg(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {c})").alias(f"d{i}") for i, p in enumerate(ps)],
                     F.expr(f"percentile({c}, 0.37)").alias("c")).first()
        assert Q.quantile_values(df, [c, "none"], ps, "disc") == {c: [ref[f"d{i}"] for i in range(len(ps))], "none": [None] * len(ps)}
        assert Q.quantile_values(df, [c], [0.37], "exact")[c][0] == pytest.approx(ref["c"], rel=1e-12)
        n = ok.count()
        for p, v in zip(ps, Q.quantile_values(df, [c], ps, "approx", 0.01)[c], strict=True):
            k = max(0, math.ceil(p * n) - 1)
            assert ok.where(F.col(c) < v).count() - 0.01 * n <= k < ok.where(F.col(c) <= v).count() + 0.01 * n


def test_bits_order_like_the_values():
    import numpy as np
    x = np.array([float("-inf"), -1e300, -1.0, -1e-320, 0.0, 1e-320, 1.0, 1.0 + 2 ** -52, float("inf")])
    u = Q.ordered_bits(x)
    assert (np.diff(u.astype(object)) > 0).all() and (Q.from_bits(u) == x).all() and Q.ordered_bits(np.array([-0.0]))[0] == Q.ordered_bits(np.array([0.0]))[0]


def test_moments_merge_over_partitions(spark):
    rnd = random.Random(2)
    rows = [(1e9 + rnd.random(), None if i % 3 else i, 4.0, None) for i in range(5000)] + [(float("nan"), None, 4.0, None)]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double").repartition(9)
    got = {r.column_name: r for r in PR.summary_stats(df, "exact").collect()}
    for c in "abc":
        ref = df.where(f"{c} is not null and not isnan({c})").agg(F.count(c), F.round(F.avg(c), 2), F.round(F.stddev_samp(c), 2),
                                                                  F.round(F.min(c).cast("double"), 2), F.round(F.max(c).cast("double"), 2)).first()
        assert (got[c]["count"], got[c]["mean"], got[c]["std"], got[c]["min"], got[c]["max"]) == tuple(ref)
    assert tuple(got["d"])[1:] == (0,) + (None,) * 7
    one = PR.summary_stats(df.limit(1).select("c"), "exact").first()
    assert one["std"] is None and one["mean"] == 4.0


def test_forward_fill_hot_key(spark):
    """One user holds most rows and spans many range partitions; the result
    equals a plain per-user window."""
    rnd = random.Random(3)
    rows = []
    for i in range(6000):
        user = 1 if i % 3 else rnd.randint(2, 40)
        val = None if rnd.random() < 0.4 else float(i)
        rows.append((i, user, i * 10, val))
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts long, value double")
    ours = I.forward_fill(df, ["value"], ["ts", "event_id"], ["user_id"], num_partitions=7)
    w = (Window.partitionBy("user_id").orderBy("ts", "event_id")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ref = df.withColumn("value", F.last("value", ignorenulls=True).over(w))
    assert ours.exceptAll(ref).count() == 0 and ours.count() == ref.count()


def test_same_clean_for_any_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    outs = []
    try:
        for n in ("1", "5"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            outs.append(P.clean_job(trips(spark, SF_SMALL), cap_mode="disc"))
        assert outs[0].exceptAll(outs[1]).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_approx_cap_rank_within_error(spark):
    """cap_approx has no SQL oracle: its threshold's rank must be within the
    sketch's rank error of the exact 99th percentile."""
    from tripmart.schema import CAP_COLUMNS
    pre = P.stage(C.fill_constants(C.valid_trips(C.with_duration(C.dedupe(trips(spark, SF_SMALL))))))
    n = pre.count()
    rel = 1e-3
    approx = Q.thresholds(pre, CAP_COLUMNS, 0.99, "approx", rel_error=rel)
    for c, v in approx.items():
        below = pre.where(F.col(c) < v).count()
        at_most = pre.where(F.col(c) <= v).count()
        target = 0.99 * n
        assert below - rel * n - 1 <= target <= at_most + rel * n + 1, c


def test_hash_keys_unique_and_resolve(spark, clean):
    dim = S.dim_datetime(clean, key_mode="hash")
    assert dim.select("datetime_id").distinct().count() == dim.count()
    fact = S.fact_trip(clean, key_mode="hash")
    orphans = fact.join(dim, "datetime_id", "left_anti").count()
    assert orphans == 0 and fact.count() == clean.count()


def test_forward_fill_null_key_crosses_segments(spark):
    rows = [(i, None if i % 2 else 7, i, (float(i) if i in (0, 1) else None)) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts long, value double")
    ours = I.forward_fill(df, ["value"], ["ts", "event_id"], ["user_id"], num_partitions=5)
    w = (Window.partitionBy("user_id").orderBy("ts", "event_id")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ref = df.withColumn("value", F.last("value", ignorenulls=True).over(w))
    assert ours.exceptAll(ref).count() == 0 and ours.where("value IS NULL").count() == 0


def test_hash_trip_id_is_stable_and_unique(spark):
    a = P.clean_job(trips(spark, SF_SMALL), cap_mode="disc", trip_id=True)
    assert a.select("trip_id").distinct().count() == a.count() == 4402
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "4", "13"):                    # the same across reruns and partitionings
            spark.conf.set("spark.sql.shuffle.partitions", n)
            b = P.clean_job(trips(spark, SF_SMALL), cap_mode="disc", trip_id=True)
            assert a.select("trip_id").exceptAll(b.select("trip_id")).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert star_checks(S.build_star(a)).where("violations > 0").count() == 0
