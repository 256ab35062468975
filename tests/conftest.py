import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tripmart.session import get_session
    s = get_session("tripmart-tests", master="local[4]", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


def raw_frame(spark, rows):
    """Raw trip rows given as dicts (missing keys -> NULL)."""
    from tripmart.schema import RAW
    return spark.createDataFrame([tuple(r.get(f.name) for f in RAW.fields) for r in rows], RAW)


def trip(**kw):
    """One valid raw trip; keyword arguments override fields."""
    import datetime as dt
    base = dict(VendorID=1, tpep_pickup_datetime=dt.datetime(2025, 1, 1, 10, 0),
                tpep_dropoff_datetime=dt.datetime(2025, 1, 1, 10, 20), passenger_count=1.0,
                trip_distance=3.0, RatecodeID=1.0, store_and_fwd_flag="N", PULocationID=10,
                DOLocationID=20, payment_type=1, fare_amount=15.0, extra=0.5, mta_tax=0.5,
                tip_amount=2.0, tolls_amount=0.0, improvement_surcharge=1.0, total_amount=19.0,
                congestion_surcharge=2.5, Airport_fee=0.0, cbd_congestion_fee=0.75)
    base.update(kw)
    return base
