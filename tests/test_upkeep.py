"""Upkeep of a warehouse that is loaded again and again."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripmart.operators import colocated as CO
from tripmart.operators import star as S
from tripmart.operators.checks import foreign_key, primary_key, star_checks
from tripmart.operators.keymap import PAIR, KeyMap
from tripmart.plans import jobs as P
from tripmart.sources.tables import trips


@pytest.fixture(scope="module")
def clean(spark):
    return P.stage(P.clean_job(trips(spark, SF_SMALL), cap_mode="disc", trip_id=True), "clean")


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- co-located star

def test_colocated_fact_is_never_shuffled(spark, clean, no_broadcast):
    star = CO.build_star(clean, buckets=8)
    fact, dim = star["FACT_TRIP"], star["DIM_DATETIME"]
    assert CO.PART in fact.columns and len({f.rsplit("_", 1)[1] for f in fact.inputFiles()}) <= 8 >= len(fact.inputFiles())
    with CO.join_within_buckets(spark):
        build = _plan(CO.fact_trip(star["CLEAN"], dim))
        pairs = _plan(star["CLEAN"].groupBy(CO.PART, CO.PICKUP, CO.DROPOFF).count())
        fk = _plan(foreign_key(fact, "datetime_id", dim, "datetime_id", "FACT_TRIP", CO.PART))
        pk = _plan(primary_key(fact, "FACT_TRIP", "trip_id", CO.PART))
    assert "SortMergeJoin" in build and "hashpartitioning" not in build and "hashpartitioning" not in pairs
    assert "LeftAnti" in fk and "hashpartitioning" not in fk and "hashpartitioning" not in pk
    assert "hashpartitioning" in _plan(primary_key(fact, "FACT_TRIP", "trip_id"))       # the plain check does
    assert CO.checks(star).where("violations > 0").count() == 0
    assert spark.conf.get(CO.join_within_buckets.KEY) == "true"


def test_colocated_star_equals_the_plain_one(spark, clean):
    star, plain = CO.build_star(clean), S.build_star(clean)
    for t in ("DIM_DATETIME", "FACT_TRIP"):
        cols = [c for c in plain[t].columns if c != "trip_id"]
        assert star[t].select(cols).exceptAll(plain[t].select(cols)).count() == 0 == plain[t].select(cols).exceptAll(star[t].select(cols)).count()
    assert star["FACT_TRIP"].select("trip_id").distinct().count() == clean.count()


def test_colocated_checks_find_what_is_wrong(spark, clean):
    star = CO.build_star(clean, buckets=4)
    fact = star["FACT_TRIP"]
    two = fact.limit(2)
    broken = fact.unionByName(two).unionByName(fact.limit(3).withColumn("datetime_id", F.lit(10 ** 9)).withColumn("trip_id", F.lit(None).cast("long")))
    bad = {**star, "FACT_TRIP": broken}
    got = {(r.check_name, r.column_name): r.violations for r in CO.checks(bad).where("table_name = 'FACT_TRIP'").collect()}
    want = {(r.check_name, r.column_name): r.violations for r in star_checks(
        {k: v for k, v in bad.items() if k != "CLEAN"}, clean).where("table_name = 'FACT_TRIP'").collect()}
    assert got == want and got["primary_key", "trip_id"] == 2 and got["foreign_key", "datetime_id"] == 3 and got["row_count", "*"] == 5


def test_hot_pair_takes_the_plain_way(spark, clean, monkeypatch):
    hot = clean.withColumns({CO.PICKUP: F.lit(dt.datetime(2029, 12, 31)).cast("timestamp_ntz"),
                             CO.DROPOFF: F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz")})
    assert not CO.is_hot(CO.with_part(hot), 16)                       # small tables are left alone
    many = CO.with_part(clean).crossJoin(spark.range(60)).withColumn(CO.PART, F.lit(3))
    assert CO.is_hot(many, 16) and not CO.is_hot(CO.with_part(clean).crossJoin(spark.range(60)), 16)
    monkeypatch.setattr(CO, "is_hot", lambda *_: True)
    star = CO.build_star(hot)
    assert CO.PART not in star["FACT_TRIP"].columns and star["DIM_DATETIME"].count() == 1
    assert CO.checks(star).where("violations > 0").count() == 0


def test_attached_table_is_bucketed_again(spark, clean, tmp_path, no_broadcast):
    star = CO.build_star(clean, str(tmp_path / "star"), 4)
    again = CO.attach(spark, str(tmp_path / "star" / "FACT_TRIP"), 4, CO.SORT["FACT_TRIP"])
    assert again.count() == star["FACT_TRIP"].count() and "hashpartitioning" not in _plan(primary_key(again, "F", "trip_id", CO.PART))


# --- key map

def _pairs(spark, *days):
    rows = [(dt.datetime(2025, 1, 1) + dt.timedelta(days=d, hours=h), dt.datetime(2025, 1, 1, 1) + dt.timedelta(days=d, hours=h))
            for d in days for h in range(3)]
    return spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz")


def _keys(m):
    return {(r.pickup_datetime, r.dropoff_datetime): r.datetime_id for r in m.read().collect()}


def test_keys_stay_and_new_ones_follow(spark, tmp_path):
    m = KeyMap(spark, str(tmp_path / "map"))
    assert m.high_water() == 0 and m.read().count() == 0
    m.extend(_pairs(spark, 40, 41))
    first = _keys(m)
    assert sorted(first.values()) == list(range(1, 7)) and first[min(first)] == 1
    assert m.extend(_pairs(spark, 1, 40)) == ["2025-01", "2025-02"]       # an older month arrives late
    second = _keys(m)
    assert {k: second[k] for k in first} == first and sorted(second.values()) == list(range(1, 10))
    m.extend(_pairs(spark, 1, 41))                                       # nothing new: no version
    assert len(m.commits()) == 2 and m.high_water() == 9
    m.compact()
    assert _keys(m) == second and m.commits()[-1][3]
    m.extend(_pairs(spark, 99))
    assert sorted(_keys(m).values()) == list(range(1, 13))
    assert m.read(["2025-01"]).count() == 3


def test_failed_and_racing_loads_leave_the_map_whole(spark, tmp_path, monkeypatch):
    m = KeyMap(spark, str(tmp_path / "map"))
    m.extend(_pairs(spark, 1))
    with monkeypatch.context() as mp:                                    # dies between segment and commit
        def dies(self, keyed, version, mark, whole):
            keyed.write.partitionBy("pickup_month").parquet(f"{self.path}/segments/load=dead")
            raise OSError("lost")
        mp.setattr(KeyMap, "_add", dies)
        with pytest.raises(OSError):
            m.extend(_pairs(spark, 2))
    assert m.read().count() == 3 and m.high_water() == 3
    stale = m.commits()
    m.extend(_pairs(spark, 3))
    monkeypatch.setattr(m, "commits", lambda: stale)                      # a load that started from version 1 as well
    with pytest.raises(RuntimeError, match="run the load again"):
        m.extend(_pairs(spark, 4))
    monkeypatch.undo()
    assert sorted(_keys(m).values()) == list(range(1, 7))
    m.extend(_pairs(spark, 2, 4))
    assert sorted(_keys(m).values()) == list(range(1, 13))


def test_star_over_a_key_map(spark, clean, tmp_path):
    path = str(tmp_path / "map")
    half = clean.where(F.year(CO.PICKUP) < 1996)
    one = S.build_star(half, key_map=path)
    two = S.build_star(clean, key_map=path)
    assert star_checks(one, half).where("violations > 0").count() == 0 == star_checks(two, clean).where("violations > 0").count()
    kept = one["DIM_DATETIME"].select("datetime_id", *PAIR)
    assert kept.join(two["DIM_DATETIME"].select("datetime_id", *PAIR), ["datetime_id", *PAIR]).count() == kept.count()


# --- warehouse

def test_of_two_racing_loads_one_commits(spark, clean, tmp_path, monkeypatch):
    from tripmart.sources import sinks as W
    wh, star = str(tmp_path / "wh"), P.stage_all(S.build_star(clean))
    first = W.load_warehouse(star, wh)
    monkeypatch.setattr(W, "latest_run", lambda *_: first)              # both loads start from the first run
    a = W.load_warehouse(star, wh)
    with pytest.raises(RuntimeError, match="another load has committed"):
        W.load_warehouse(star, wh)
    monkeypatch.undo()
    assert W.committed_run(spark, wh) == a
    b = W.load_warehouse(star, wh)                                      # run again: it starts from the winner
    assert W.committed_run(spark, wh) == b > a


def test_a_load_that_dies_while_it_commits_is_made_up_for(spark, clean, tmp_path):
    import os
    import shutil

    from tripmart.sources import sinks as W
    wh, star = str(tmp_path / "wh"), P.stage_all(S.build_star(clean))
    dead = W.load_warehouse(star, wh)
    shutil.move(f"{wh}/_commits/run={dead}", f"{wh}/_pending/run={dead}")     # claimed, and not placed yet
    with pytest.raises(RuntimeError):
        W.load_warehouse(star, wh)
    assert W.committed_run(spark, wh) == dead and os.path.exists(f"{wh}/_commits/run={dead}")
    assert W.load_warehouse(star, wh) > dead


def test_colocated_trips_are_written_once_into_their_buckets(clean, monkeypatch):
    """The cleaned trips are dealt as they are read, without a stage of their own in between."""
    staged, real = [], P.stage
    monkeypatch.setattr(P, "stage", lambda df, name="stage", observe=None: (staged.append(name), real(df, name, observe))[1])
    star = CO.build_star(clean, buckets=4)
    assert "parted" not in staged and star["FACT_TRIP"].count() == clean.count() > 0


def test_a_delivery_again_is_not_shuffled_by_month(spark, monkeypatch):
    """Trips become monthly files once; the third delivery writes the first one's files as they lie."""
    from tripmart.plans.catalog import QUERIES
    from tripmart.sources import files as FS
    calls, real = [], FS.write_trip_files
    monkeypatch.setattr(FS, "write_trip_files", lambda *a, **k: (calls.append(k.get("by_month", False)), real(*a, **k))[1])
    assert QUERIES["keyed_ingest"](spark, SF_SMALL).count() > 0 and calls == [False, True]
