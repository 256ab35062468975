"""Column functions used across operators (all built-in Spark expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_label(col: str | Column, labels: dict[int, str], unknown_label: str | None = None) -> Column:
    """FN4: code -> label through a map literal. An unmapped code gives
    ``unknown_label`` (NULL by default), a NULL code NULL."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    c = F.col(col) if isinstance(col, str) else col
    label = F.create_map(*pairs)[c]
    return label if unknown_label is None else F.when(c.isNotNull(), F.coalesce(label, F.lit(unknown_label)))


def calendar(ts: str) -> dict[str, Column]:
    """FN2/FN3: hour, day of month, month, year and full weekday name."""
    c = F.col(ts)
    return {"hour": F.hour(c), "day": F.dayofmonth(c), "month": F.month(c),
            "year": F.year(c), "weekday": F.date_format(c, "EEEE")}


def money(col: str | Column, mode: str = "cast") -> Column:
    """PRJ5: amount as decimal(10,2), rounded HALF_UP.

    ``cast`` raises on overflow (ANSI); ``try`` gives NULL instead so the row
    can be routed to a reject table.
    """
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("decimal(10,2)") if mode == "try" else c.cast("decimal(10,2)")


def avg_speed(distance: str, minutes: str) -> Column:
    """MA13: distance per hour; NULL when the duration is zero or NULL."""
    return F.try_divide(F.col(distance), F.col(minutes) / F.lit(60.0))


def parse_timestamps(df, cols: list[str], fmt: str | None = None):
    """FN8: string columns -> zone-less timestamps (``to_timestamp_ntz``);
    columns already of a timestamp type are left alone."""
    from pyspark.sql import types as T
    out = df
    for c in cols:
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType):
            parsed = F.to_timestamp_ntz(F.col(c), F.lit(fmt)) if fmt else F.to_timestamp_ntz(F.col(c))
            out = out.withColumn(c, parsed)
    return out
