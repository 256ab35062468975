"""Warehouse contract checks on the star (CHK1-CHK4, JN2).

Violation counts in long form ``(table_name, check_name, column_name,
violations)``, in one frame so one action runs them. Everything a table's row can
tell on its own is one aggregate per table; for the fact that pass also joins the
keys of the small dimensions and counts rows, so foreign keys, NOT NULL and the
row count are a single scan. Apart from it are the primary keys and the foreign
key to the datetime dimension, which is as long as the fact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.schema import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, STRING_WIDTHS

LONG = ["table_name", "check_name", "column_name", "violations"]


def _counted(df: DataFrame, table: str, checks: list[tuple]) -> DataFrame:
    """Rows that meet each (check, column, condition), in one pass."""
    agg = df.agg(*[F.count_if(cond).alias(f"_v{i}") for i, (_, _, cond) in enumerate(checks)])
    rows = [x for i, (check, c, _) in enumerate(checks)
            for x in (F.lit(table), F.lit(check), F.lit(c), F.col(f"_v{i}").cast("bigint"))]
    return agg.select(F.stack(F.lit(len(checks)), *rows).alias(*LONG))


def _column_conditions(cols: list[str], widths: dict[str, int]) -> list[tuple]:
    return ([("not_null", c, F.col(c).isNull()) for c in cols]
            + [("string_width", c, F.length(c) > n) for c, n in widths.items()])


def column_checks(df: DataFrame, table: str, not_null_cols: list[str],
                  widths: dict[str, int] | None = None) -> DataFrame:
    """CHK1 + CHK4: NULLs in NOT NULL columns and values wider than the
    declared VARCHAR / CHAR width; one aggregate per table, unpivoted."""
    return _counted(df, table, _column_conditions(not_null_cols, widths or {}))


def primary_key(df: DataFrame, table: str, key: str, within: str | None = None) -> DataFrame:
    """CHK2: keys that occur more than once (NULL keys are CHK1's concern). ``within``: a
    column that equal keys agree in, by which the table is stored."""
    dup = df.where(F.col(key).isNotNull()).groupBy(*([within] if within else []), key).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(table).alias(LONG[0]), F.lit("primary_key").alias(LONG[1]), F.lit(key).alias(LONG[2]), F.col("n").alias(LONG[3]))


def foreign_key(fact: DataFrame, col: str, dim: DataFrame, dim_key: str, table: str, within: str | None = None) -> DataFrame:
    """CHK3: non-NULL fact keys with no dimension row (one anti join). ``within``: a column
    by which both are stored and in which a fact row agrees with its dimension row."""
    more = [within] if within else []
    keys = dim.select(F.col(dim_key).alias("_k"), *[F.col(c).alias("_w") for c in more])
    same = F.col(col) == F.col("_k")
    orphans = (fact.select(col, *more).where(F.col(col).isNotNull())
               .join(keys, same & (F.col(within) == F.col("_w")) if within else same, "left_anti"))
    return _counted(orphans, table, [("foreign_key", col, F.lit(True))])


def fact_checks(star: dict[str, DataFrame], count_rows: bool) -> DataFrame:
    """CHK1, CHK3 and the row count of the fact in one scan of it."""
    fact = star["FACT_TRIP"]
    checks = _column_conditions([c for c in NOT_NULL["FACT_TRIP"] if c in fact.columns],
                                STRING_WIDTHS.get("FACT_TRIP", {}))
    for i, (col, dim) in enumerate(FOREIGN_KEYS):
        if dim != "DIM_DATETIME":
            keys = star[dim].select(F.col(PRIMARY_KEYS[dim]).alias(f"_k{i}")).distinct()
            fact = fact.join(keys, F.col(col) == F.col(f"_k{i}"), "left")
            checks.append(("foreign_key", col, F.col(col).isNotNull() & F.col(f"_k{i}").isNull()))
    if count_rows:
        checks.append(("row_count", "*", F.lit(True)))
    return _counted(fact, "FACT_TRIP", checks)


def star_checks(star: dict[str, DataFrame], clean: DataFrame | None = None, within: str | None = None) -> DataFrame:
    """All contract checks of the star in one frame. With ``clean`` also JN2: the
    fact has exactly one row per cleaned trip (no join fan-out). ``within``: the column by
    which a co-located star stores fact and datetime dimension."""
    parts = [fact_checks(star, clean is not None)]
    for table in PRIMARY_KEYS:
        df = star[table]
        cols = [c for c in NOT_NULL[table] if c in df.columns]
        widths = STRING_WIDTHS.get(table, {})
        if table != "FACT_TRIP" and (cols or widths):
            parts.append(column_checks(df, table, cols, widths))
        if PRIMARY_KEYS[table] in df.columns:
            parts.append(primary_key(df, table, PRIMARY_KEYS[table], within if table == "FACT_TRIP" else None))
    parts.append(foreign_key(star["FACT_TRIP"], "datetime_id", star["DIM_DATETIME"], "datetime_id", "FACT_TRIP", within))
    if clean is not None:      # rows of the fact less rows of the input
        rows = _counted(clean, "FACT_TRIP", [("row_count", "*", F.lit(True))])
        parts.append(rows.withColumn("violations", -F.col("violations")))
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy(*LONG[:3]).agg(F.abs(F.sum("violations")).cast("bigint").alias("violations"))
