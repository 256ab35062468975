"""Ids are told over three dealings of the rows, none of them through few tasks."""
import re

from conftest import SF_SMALL
from tripmart.plans.catalog import QUERIES


def test_rows_are_dealt_over_the_sessions_partitions(spark):
    df = QUERIES["trip_id_stability"](spark, SF_SMALL)
    dealt = sorted({int(n) for n in re.findall(r"RoundRobinPartitioning\((\d+)\)", df._jdf.queryExecution().toString())})
    assert len(dealt) == 3 and dealt[0] >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [tuple(r) for r in df.collect()] == [(0, 0)]
