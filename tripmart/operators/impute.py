"""Adaptive imputation (IMP3-IMP7) and the adaptive cleaner (PL4).

Statistics for every column come from one aggregate (null shares) plus
distributed top-1 (mode) and exact quantile passes (median); the fills are one
projection. Forward fill is skew-safe: a key holding a third of all rows is
spread over many range partitions and stitched with per-partition carries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import quantiles
from tripmart.operators.clean import dedupe, elapsed, positive
from tripmart.operators.profile import missing
from tripmart.schema import DROPOFF, MEDIAN_NULL_SHARE, PICKUP

UNKNOWN = "Unknown"


def null_ratios(df: DataFrame) -> dict[str, float]:
    """IMP6: share of missing cells per column, all columns in one pass."""
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(missing(df, c)).alias(f"_m{i}") for i, c in enumerate(df.columns)]).first()
    n = row["_n"]
    return {c: (row[f"_m{i}"] / n if n else 0.0) for i, c in enumerate(df.columns)}


def fill_rules(df: DataFrame, ratios: dict[str, float],
               median_below: float = MEDIAN_NULL_SHARE) -> dict[str, str]:
    """Which rule fills each column: none / mode / median / zero / ffill."""
    rules = {}
    for f in df.schema.fields:
        r = ratios[f.name]
        if r == 0:
            rules[f.name] = "none"
        elif isinstance(f.dataType, T.StringType):
            rules[f.name] = "mode"
        elif isinstance(f.dataType, T.NumericType):
            rules[f.name] = "median" if r < median_below else "zero"
        else:
            rules[f.name] = "ffill"
    return rules


def column_modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """IMP3: (c, v) with the most frequent non-NULL value of each column, lowest
    on ties, ``c`` being the place in ``cols``; all columns in one pass."""
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).alias("v"))
                                          for i, c in enumerate(cols)])).alias("x")).select("x.*")
    counts = cells.where("v is not null").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("m")).select("c", "m.v")


def column_mode(df: DataFrame, c: str):
    """IMP3 for one column; None without a value."""
    top = column_modes(df, [c]).collect()
    return top[0]["v"] if top else None


def fill_values(df: DataFrame, rules: dict[str, str], mode: str = "approx") -> dict:
    """IMP3-IMP5: the constant each filled column receives; one pass for all
    modes, shared passes for all medians."""
    by = {r: [c for c, x in rules.items() if x == r] for r in ("mode", "median", "zero")}
    values = dict.fromkeys(by["zero"], 0)
    if by["median"]:
        values |= {c: v[0] for c, v in quantiles.quantile_values(df, by["median"], [0.5], mode).items()}
    if by["mode"]:
        found = {by["mode"][r["c"]]: r["v"] for r in column_modes(df, by["mode"]).collect()}
        values |= {c: found.get(c, UNKNOWN) for c in by["mode"]}
    return values


def apply_fills(df: DataFrame, values: dict) -> DataFrame:
    """Replace missing cells (NULL, or NaN in floating columns) by constants."""
    def filled(c, v):
        lit = F.lit(v).cast(df.schema[c].dataType)
        return F.when(missing(df, c), lit).otherwise(F.col(c)).alias(c)
    return df.select(*[filled(c, values[c]) if c in values else F.col(c) for c in df.columns])


def _fill_sorted(cols: list[str], keys: list[str]):
    """``mapInArrow`` function over rows sorted by key and order: ``cols`` carry
    their last non-NULL value on within a key. One pass; the state between
    batches is one row."""
    import numpy as np
    import pyarrow as pa

    def fill(batches):
        last = None                                   # (key, last filled row of cols)
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            names = b.schema.names
            key = [b.column(names.index(k)) for k in keys]
            new = np.zeros(n, bool)
            for k in key:
                code = k.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
                new[1:] |= code[1:] != code[:-1]
            head = tuple(k[0].as_py() for k in key)
            same = last is not None and last[0] == head
            # row 0 of every padded column is the carried row; a group starts at `begin`
            begin = np.where(new, np.arange(1, n + 1), 0)
            begin[0] = 0 if same else 1
            begin = np.maximum.accumulate(begin)
            out = list(b.columns)
            carried = []
            for c in cols:
                i = names.index(c)
                pad = last[1][len(carried)] if same else pa.nulls(1, b.column(i).type)
                arr = pa.concat_arrays([pad, b.column(i)])
                have = np.asarray(arr.is_valid())
                at = np.maximum.accumulate(np.where(have, np.arange(n + 1), -1))[1:]
                out[i] = arr.take(pa.array(np.where(at >= begin, at, 0), mask=at < begin))
                carried.append(out[i].slice(n - 1, 1))
            last = (tuple(k[n - 1].as_py() for k in key), carried)
            yield pa.RecordBatch.from_arrays(out, schema=b.schema)
    return fill


def forward_fill(df: DataFrame, cols: list[str], order_by: list[str],
                 partition_by: list[str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """IMP7: carry the last non-NULL value forward within each key, in the
    given order (explicit keys: Spark has no row order). The order must not hold
    a filled column: its gaps have no place in the order.

    Rows are range-partitioned by (keys, order), so one huge key spans many
    partitions; each is filled where it lies, which costs no second shuffle. The
    last value of every (partition, key) segment is carried into the following
    segments of the same key through a small table (one row per segment).
    """
    from tripmart.plans.jobs import stage

    clash = sorted(set(cols) & set(order_by))
    if clash:
        raise ValueError(f"cannot order by the column(s) to fill: {clash}")
    keys = list(partition_by or [])
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = keys + list(order_by)
    # _seg is the partition, _ord grows with (keys, order) inside it; the stage write fixes both
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("_seg", F.spark_partition_id())
                .withColumn("_ord", F.monotonically_increasing_id()))
    local = stage(ranged.mapInArrow(_fill_sorted(cols, keys), ranged.schema), "ffill")
    seg_keys = ["_seg"] + keys
    # last value of every segment (hash aggregate: long ordering key)
    ends = local.groupBy(*seg_keys).agg(*[F.max_by(F.col(c), F.col("_ord")).alias(f"_end_{c}") for c in cols])
    kw = (Window.partitionBy(*keys).orderBy("_seg")
                .rowsBetween(Window.unboundedPreceding, -1)) if keys else \
        Window.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carries = ends.select(*[F.col(k).alias(f"_ck_{k}") for k in seg_keys],
                          *[F.last(f"_end_{c}", ignorenulls=True).over(kw).alias(f"_in_{c}") for c in cols])
    on = [F.col(k).eqNullSafe(F.col(f"_ck_{k}")) for k in seg_keys]   # a NULL key is a key too
    return local.join(carries, on, "left").select(
        *[F.coalesce(F.col(c), F.col(f"_in_{c}")).alias(c) if c in cols else F.col(c) for c in df.columns])


def adaptive_duration(df: DataFrame, name: str = "trip_duration") -> DataFrame:
    """Duration in minutes keeping fractions of a second."""
    return df.withColumn(name, elapsed().cast("decimal(20,6)").cast("double") / F.lit(60.0))


def adaptive_valid(df: DataFrame) -> DataFrame:
    """PL4 steps 1-3: dedupe, duration, positive duration / fare / distance. A
    column the frame lacks takes no part."""
    from tripmart.functions.scalar import parse_timestamps
    d = parse_timestamps(dedupe(df), [PICKUP, DROPOFF])
    if PICKUP in d.columns and DROPOFF in d.columns:
        d = adaptive_duration(d)
    for c in ("trip_duration", "fare_amount", "trip_distance"):
        if c in d.columns:
            d = d.where(positive(c))
    return d


def adaptive_fill(df: DataFrame, median_below: float = MEDIAN_NULL_SHARE, order_by: list[str] | None = None,
                  mode: str = "approx", ratios: dict[str, float] | None = None) -> DataFrame:
    """IMP3-IMP7 by column type and null share (``ratios`` if already known).
    Forward fills go by ``order_by``, or by pickup and dropoff if those are whole."""
    rules = fill_rules(df, ratios or null_ratios(df), median_below)
    out = apply_fills(df, fill_values(df, rules, mode))
    ff = [c for c, r in rules.items() if r == "ffill"]
    if ff:
        out = forward_fill(out, ff, order_by or [c for c in (PICKUP, DROPOFF) if c in df.columns])
    return out


def adaptive_clean(raw: DataFrame, mode: str = "approx", order_by: list[str] | None = None) -> DataFrame:
    """PL4: dedupe -> duration -> 3-predicate filter -> adaptive fills -> caps
    at the 0.99 quantile (interpolated) of duration, fare and distance. Null
    shares are observed while the valid rows are written; fills by constants are a projection
    of these rows, so no second copy is written for the caps unless a forward fill joins."""
    from tripmart.plans.jobs import stage

    rows = adaptive_valid(raw)
    valid, seen = stage(rows, "adaptive", observe=[F.count(F.lit(1)).alias("_n")] + [
        F.count_if(missing(rows, c)).alias(f"_m{i}") for i, c in enumerate(rows.columns)])
    n = seen["_n"]
    ratios = {c: (seen[f"_m{i}"] / n if n else 0.0) for i, c in enumerate(rows.columns)}
    filled = adaptive_fill(valid, order_by=order_by, mode=mode, ratios=ratios)
    if "ffill" in fill_rules(valid, ratios).values():
        filled = stage(filled, "adaptive-filled")
    capped = [c for c in ("trip_duration", "fare_amount", "trip_distance") if c in filled.columns]
    return quantiles.cap(filled, quantiles.thresholds(filled, capped, 0.99, mode))


def null_ratio_table(df: DataFrame, median_below: float = MEDIAN_NULL_SHARE) -> DataFrame:
    """IMP6 as a table: null share and the rule it selects, per column."""
    from tripmart.operators.profile import _stack
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(missing(df, c)).alias(f"_m{i}") for i, c in enumerate(df.columns)])
    rows = []
    for i, f in enumerate(df.schema.fields):
        r = F.col(f"_m{i}").cast("double") / F.col("_n").cast("double")
        if isinstance(f.dataType, T.StringType):
            kind = F.lit("mode")
        elif isinstance(f.dataType, T.NumericType):
            kind = F.when(r < F.lit(median_below), F.lit("median")).otherwise(F.lit("zero"))
        else:
            kind = F.lit("ffill")
        rows.append([F.lit(f.name), r, F.when(F.col(f"_m{i}") == 0, F.lit("none")).otherwise(kind)])
    return agg.select(_stack(rows, ["column_name", "null_ratio", "fill_rule"]))


def mode_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """IMP3 as a table: the fill value (mode, else "Unknown") per text column."""
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "c int, column_name string")
    return (names.join(column_modes(df, cols), "c", "left")
                 .select("column_name", F.coalesce("v", F.lit(UNKNOWN)).alias("mode_value")))


def median_table(df: DataFrame, cols: list[str], mode: str = "approx") -> DataFrame:
    """IMP4 as a table: the (interpolated) median per numeric column."""
    from tripmart.operators.profile import _stack
    meds = quantiles.quantile_values(df, cols, [0.5], mode)
    rows = [[F.lit(c), F.lit(meds[c][0]).cast("double")] for c in cols]
    return df.agg(F.count(F.lit(1)).alias("_n")).select(_stack(rows, ["column_name", "median"]))
