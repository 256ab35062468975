"""tripmart: Spark-native trip analytics.

Cleaning, star-schema building, profiling and mart queries for taxi-style trip
records, written as DataFrame plans so Catalyst and AQE pick the physical
strategy. Every operator is a ``DataFrame -> DataFrame`` function usable with
``df.transform``.
"""

from tripmart.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
