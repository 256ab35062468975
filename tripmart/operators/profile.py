"""Data profiling: counts, duplicates, null tables, summaries, correlations.

Every statistic over many columns is one aggregate (one pass, partial
aggregation on the map side), then reshaped to long form with ``stack``; no
per-column job loops and no collect of data rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import quantiles


def row_counts(df: DataFrame) -> DataFrame:
    """AGG1 + SET1: raw rows, rows after full-row dedupe, column count.

    One shuffle: grouping by every column keeps each distinct row with its
    multiplicity, so both counts come from the same aggregate. Copies of a hot
    row are combined map-side before the shuffle.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.sum("_n").cast("bigint").alias("raw_rows"),
                      F.count(F.lit(1)).cast("bigint").alias("dedup_rows"),
                      F.lit(len(df.columns)).alias("columns"))


def duplicate_stats(df: DataFrame) -> DataFrame:
    """SET4: rows that repeat an earlier row, and their share in percent."""
    c = row_counts(df)
    dup = F.col("raw_rows") - F.col("dedup_rows")
    return c.select(dup.alias("duplicate_count"),
                    (F.lit(100.0) * dup.cast("double") / F.col("raw_rows").cast("double"))
                    .alias("duplicate_pct"))





SUMMARY_PS = [0.25, 0.5, 0.75]


def numeric_columns(df: DataFrame) -> list[str]:
    """PRJ10: numeric columns (pandas ``select_dtypes(include=number)``)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    """PRJ10: text columns (pandas ``object``)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def missing(df: DataFrame, c: str):
    """A missing cell: NULL, or NaN in a floating column (as pandas counts it)."""
    dt = df.schema[c].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def _stack(cols_per_row: list[list], names: list[str]) -> "F.Column":
    flat = [x for row in cols_per_row for x in row]
    return F.stack(F.lit(len(cols_per_row)), *flat).alias(*names)


def column_profile(df: DataFrame) -> DataFrame:
    """AGG2: per column type, non-null and null counts and percentages (one pass)."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(missing(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)])
    rows = [[F.lit(i + 1), F.lit(c), F.lit(df.schema[c].dataType.simpleString()), F.col(f"_m{i}")]
            for i, c in enumerate(cols)]
    long = agg.select("_rows", _stack(rows, ["ordinal", "column_name", "dtype", "null_count"]))
    n = F.col("_rows").cast("double")
    non_null = F.col("_rows") - F.col("null_count")
    return long.select(
        "ordinal", "column_name", "dtype",
        non_null.alias("non_null"),
        (non_null.cast("double") / n * F.lit(100.0)).alias("non_null_pct"),
        F.col("null_count"),
        (F.col("null_count").cast("double") / n * F.lit(100.0)).alias("null_pct"))


def missing_table(df: DataFrame) -> DataFrame:
    """AGG3 + SRT1: columns with gaps, percent rounded to 2, most missing first."""
    return _gaps(column_profile(df))


def _gaps(profile: DataFrame) -> DataFrame:
    p = profile.where(F.col("null_count") > 0)
    return (p.select("column_name", F.col("null_count").alias("missing_count"),
                     F.round("null_pct", 2).alias("missing_pct"))
             .orderBy(F.desc("missing_count"), "column_name"))


def summary_stats(df: DataFrame, mode: str = "approx", rel_error: float = 1e-4) -> DataFrame:
    """AGG4 + FN7: count, mean, sample std, min, quartiles, max per numeric
    column, rounded to 2 (pandas ``describe().round(2)``). Quartiles are within
    ``rel_error`` of their rank; ``mode="exact"`` interpolates the exact ones."""
    cols = numeric_columns(df)
    qs = quantiles.quantile_values(df, cols, SUMMARY_PS, mode, rel_error)
    r2 = lambda x: F.round(x, 2)
    told = F.create_map(*[x for i, c in enumerate(cols) for x in (
        F.lit(i), F.array(*[F.lit(v).cast("double") for v in qs[c]]))])[F.col("i")]
    names = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(i), F.lit(c))])[F.col("i")]
    std = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return moments(df, cols).select(
        names.alias("column_name"), F.col("n").alias("count"), r2("mean").alias("mean"), r2(std).alias("std"), r2("lo").alias("min"),
        *[r2(told[j]).alias(f"q{int(p * 100)}") for j, p in enumerate(SUMMARY_PS)], r2("hi").alias("max"))


def moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """(i, n, mean, m2, lo, hi) for each numeric column by its number: values, mean, sum of squared
    differences from it, smallest and largest; NULL and NaN take no part. Each partition tells one row a
    column (five aggregates a column would be beyond whole-stage codegen); they are merged by
    the parallel formulas."""
    import numpy as np
    import pyarrow as pa

    from tripmart.plans.jobs import stage

    def tell(batches):
        acc = None
        for b in batches:
            rows = []
            for i in range(len(cols)):
                x = b.column(i).drop_null().to_numpy(zero_copy_only=False)
                x = x[~np.isnan(x)]
                m = x.mean() if len(x) else 0.0
                rows.append((len(x), m, ((x - m) ** 2).sum(), x.min(initial=np.inf), x.max(initial=-np.inf)))
            n, m, m2, lo, hi = (np.array(v, np.float64) for v in zip(*rows, strict=True))
            if acc is not None:
                an, am, am2, alo, ahi = acc
                t = np.maximum(an + n, 1.0)
                d = m - am
                m, m2, lo, hi = am + d * n / t, am2 + m2 + d * d * an * n / t, np.minimum(lo, alo), np.maximum(hi, ahi)
                n = n + an
            acc = (n, m, m2, lo, hi)
        if acc is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cols), dtype=np.int32)), pa.array(acc[0].astype(np.int64)),
                                              *map(pa.array, acc[1:])], ["i", "n", "mean", "m2", "lo", "hi"])

    parts = stage(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
                  .mapInArrow(tell, "i int, n long, mean double, m2 double, lo double, hi double"), "moments")
    whole = parts.groupBy("i").agg(F.sum("n").alias("n"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("g"),
                                   F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    spread = (parts.select("i", F.col("n").alias("k"), "mean", "m2").join(whole.select("i", "g"), "i")
              .groupBy("i").agg(F.sum(F.col("m2") + F.col("k") * F.pow(F.col("mean") - F.col("g"), 2)).alias("m2")))
    some = F.col("n") > 0
    return whole.join(spread, "i").select("i", "n", F.col("g").alias("mean"), "m2", *[F.when(some, F.col(c)).alias(c) for c in ("lo", "hi")])


def date_summary(df: DataFrame) -> DataFrame:
    """AGG4 for timestamp columns: count, mean (to the second), first and last
    value; zone-less, whatever the session's zone."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))]
    zero = F.lit("1970-01-01").cast("timestamp_ntz")
    ts = {c: F.col(c).cast("timestamp_ntz") for c in cols}
    seconds = {c: (ts[c] - zero).cast("interval second").cast("decimal(20,6)") for c in cols}
    agg = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.count(c).alias(f"_n{i}"), F.avg(seconds[c]).cast("bigint").alias(f"_a{i}"),
        F.min(ts[c]).alias(f"_lo{i}"), F.max(ts[c]).alias(f"_hi{i}"))])
    rows = [[F.lit(c), F.col(f"_n{i}"), F.timestamp_add("SECOND", F.col(f"_a{i}"), zero),
             F.col(f"_lo{i}"), F.col(f"_hi{i}")] for i, c in enumerate(cols)]
    return agg.select(_stack(rows, ["column_name", "count", "mean", "first", "last"]))


def head_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """SRT2: first ``n`` rows in an explicit total order (all columns)."""
    return df.orderBy(*df.columns).limit(n)


def value_counts(df: DataFrame, k: int = 5, cols: list[str] | None = None) -> DataFrame:
    """SRT3: top ``k`` values by frequency per text column (NULL excluded),
    ties by value. Each column is a distributed top-k (TakeOrderedAndProject),
    never a whole column's distinct values in one task."""
    cols = string_columns(df) if cols is None else cols
    parts = []
    for c in cols:
        top = (df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value"))
                 .agg(F.count(F.lit(1)).alias("count"))
                 .orderBy(F.desc("count"), "value").limit(k))
        parts.append(top.select(F.lit(c).alias("column_name"), "value", "count"))
    return reduce(DataFrame.unionByName, parts)


def distinct_counts(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """AGG7: distinct non-NULL values per text column, one aggregate."""
    cols = string_columns(df) if cols is None else cols
    fn = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    agg = df.agg(*[fn(c).alias(f"_d{i}") for i, c in enumerate(cols)])
    return agg.select(_stack([[F.lit(c), F.col(f"_d{i}")] for i, c in enumerate(cols)],
                             ["column_name", "distinct_count"]))


def distinct_values(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """AGG8: the distinct values of each text column, NULL included."""
    cols = string_columns(df) if cols is None else cols
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                   F.col(c).alias("value")) for c in cols]))
                      .alias("p")).select("p.*")
    return pairs.distinct()


_MOMENTS = ("n", "mx", "my", "m2x", "m2y", "cxy", "lox", "hix", "loy", "hiy")


def _pair_moments(k: int):
    """Per-partition co-moments of every column pair over rows where both are
    present: three k x k matrix products per Arrow batch, batches merged with
    the parallel (Chan) formulas, one output row per pair per partition."""
    import numpy as np
    import pandas as pd

    def merge(a, b):
        if a is None:
            return b
        n = a[0] + b[0]
        safe = np.where(n > 0, n, 1.0)
        dx, dy = b[1] - a[1], b[2] - a[2]
        w = a[0] * b[0] / safe
        return (n, a[1] + dx * b[0] / safe, a[2] + dy * b[0] / safe,
                a[3] + b[3] + dx * dx * w, a[4] + b[4] + dy * dy * w, a[5] + b[5] + dx * dy * w,
                np.fmin(a[6], b[6]), np.fmax(a[7], b[7]), np.fmin(a[8], b[8]), np.fmax(a[9], b[9]))

    def batch_moments(x):
        m = ~np.isnan(x)
        mf = m.astype(np.float64)
        shift = np.nan_to_num(np.nanmean(np.where(m, x, np.nan), axis=0)) if m.any() else 0.0
        z = np.where(m, x - shift, 0.0)
        n = mf.T @ mf                       # rows where both i and j are present
        sx = z.T @ mf                       # sum of shifted x_i over those rows
        sxx = (z * z).T @ mf
        sxy = z.T @ z
        safe = np.where(n > 0, n, 1.0)
        mx = sx / safe                      # shifted mean of i over pair rows
        # smallest and largest x_i over the rows where j is present too
        lo, hi = np.full((k, k), np.nan), np.full((k, k), np.nan)
        for j in range(k):
            both = x[m[:, j]]
            if len(both):
                lo[:, j], hi[:, j] = np.fmin.reduce(both, axis=0), np.fmax.reduce(both, axis=0)
        return (n, mx + shift[:, None] * (n > 0), mx.T + shift[None, :] * (n > 0),
                sxx - sx * mx, (sxx - sx * mx).T, sxy - sx * mx.T, lo, hi, lo.T, hi.T)

    iu = np.triu_indices(k)

    def fn(batches):
        acc = None
        for pdf in batches:
            x = pdf.to_numpy(dtype=np.float64, na_value=np.nan)
            if len(x):
                acc = merge(acc, batch_moments(x))
        if acc is None:
            return
        out = {"i": iu[0].astype(np.int32), "j": iu[1].astype(np.int32)}
        for name, mat in zip(_MOMENTS, acc):
            out[name] = mat[iu]
        yield pd.DataFrame(out)
    return fn


def correlation_matrix(df: DataFrame, cols: list[str] | None = None, digits: int = 6) -> DataFrame:
    """AGG9: Pearson correlation of every numeric pair over rows where both are
    present (pandas ``corr``), NULL for a constant column; long form.

    Hundreds of per-pair aggregate columns fall out of whole-stage codegen, so
    the co-moments are computed per partition with numpy (``mapInPandas``), once,
    and written: pairs x partitions rows, merged by pair in Spark. A column is
    constant over a pair's rows if its smallest and largest value agree, which
    no rounding blurs.
    """
    from tripmart.plans.jobs import stage

    cols = numeric_columns(df) if cols is None else cols
    k = len(cols)
    schema = "i int, j int, " + ", ".join(f"{m} double" for m in _MOMENTS)
    parts = stage(df.select(*[F.col(c).cast("double") for c in cols]).mapInPandas(_pair_moments(k), schema), "moments")
    # global pair means first, then the spread of the partition means around them
    g = parts.groupBy("i", "j").agg(
        F.try_divide(F.sum(F.col("n") * F.col("mx")), F.sum("n")).alias("g_mx"),
        F.try_divide(F.sum(F.col("n") * F.col("my")), F.sum("n")).alias("g_my"))
    j = parts.join(g, ["i", "j"])
    dx = F.coalesce(F.col("mx") - F.col("g_mx"), F.lit(0.0))
    dy = F.coalesce(F.col("my") - F.col("g_my"), F.lit(0.0))
    real = lambda c: F.when(~F.isnan(c), F.col(c))                     # noqa: E731
    tot = j.groupBy("i", "j").agg(
        F.sum(F.col("m2x") + F.col("n") * dx * dx).alias("t_m2x"),
        F.sum(F.col("m2y") + F.col("n") * dy * dy).alias("t_m2y"),
        F.sum(F.col("cxy") + F.col("n") * dx * dy).alias("t_cxy"),
        (F.min(real("lox")) < F.max(real("hix"))).alias("vary_x"), (F.min(real("loy")) < F.max(real("hiy"))).alias("vary_y"))
    corr = F.round(F.try_divide(F.col("t_cxy"), F.sqrt(F.col("t_m2x") * F.col("t_m2y"))), digits)
    names = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(i), F.lit(c))])
    one = F.struct(names[F.col("i")].alias("column_a"), names[F.col("j")].alias("column_b"))
    two = F.struct(names[F.col("j")].alias("column_a"), names[F.col("i")].alias("column_b"))
    pairs = F.when(F.col("i") == F.col("j"), F.array(one)).otherwise(F.array(one, two))
    return tot.select(F.explode(pairs).alias("p"), F.when(F.col("vary_x") & F.col("vary_y"), corr).alias("corr")).select(
        "p.column_a", "p.column_b", "corr")


def outlier_stats(df: DataFrame, cols: list[str] | None = None, mode: str = "approx") -> DataFrame:
    """AGG10: box-plot numbers for the first six numeric columns: quartiles,
    1.5 x IQR fences, whisker ends and outlier counts."""
    cols = numeric_columns(df)[:6] if cols is None else cols
    qs = quantiles.quantile_values(df, cols, SUMMARY_PS, mode)
    fences = {}
    for c in cols:
        q1, _, q3 = qs[c]
        iqr = None if q1 is None else q3 - q1
        fences[c] = (None, None) if q1 is None else (q1 - 1.5 * iqr, q3 + 1.5 * iqr)
    aggs = []
    for i, c in enumerate(cols):
        lo, hi = fences[c]
        x = F.when(~missing(df, c), F.col(c).cast("double"))
        aggs += [F.min(F.when(x >= F.lit(lo), x)).alias(f"_wl{i}"),
                 F.max(F.when(x <= F.lit(hi), x)).alias(f"_wh{i}"),
                 F.count_if((x < F.lit(lo)) | (x > F.lit(hi))).alias(f"_o{i}")]
    agg = df.agg(*aggs)
    d = lambda v: F.lit(v).cast("double")
    rows = [[F.lit(c), d(qs[c][0]), d(qs[c][1]), d(qs[c][2]),
             d(None if qs[c][0] is None else qs[c][2] - qs[c][0]),
             d(fences[c][0]), d(fences[c][1]), F.col(f"_wl{i}"), F.col(f"_wh{i}"),
             F.col(f"_o{i}")] for i, c in enumerate(cols)]
    return agg.select(_stack(rows, ["column_name", "q1", "median", "q3", "iqr", "lower_fence",
                                    "upper_fence", "whisker_low", "whisker_high", "outliers"]))


def quality(df: DataFrame) -> DataFrame:
    """AGG11 + AGG12 (+ SET4): share of filled cells and the quality label.

    One shuffle: distinct rows carry their multiplicity, and a row's missing
    cells are a function of its values.
    """
    cols = df.columns
    nulls_in_row = reduce(lambda a, b: a + b, [missing(df, c).cast("int") for c in cols])
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    t = groups.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("_distinct"),
                   F.sum(F.col("_n") * nulls_in_row).alias("missing_cells"))
    cells = F.col("rows") * F.lit(len(cols))
    dup = F.col("rows") - F.col("_distinct")
    return t.select(
        F.col("rows").cast("bigint").alias("rows"), F.lit(len(cols)).alias("columns"),
        cells.cast("bigint").alias("cells"),
        F.coalesce(F.col("missing_cells"), F.lit(0)).cast("bigint").alias("missing_cells"),
        dup.cast("bigint").alias("duplicate_rows"),
        ((cells - F.col("missing_cells")).cast("double") / cells.cast("double") * F.lit(100.0))
        .alias("quality_pct"),
        F.when((dup == 0) & (F.col("missing_cells") == 0), F.lit("High"))
         .otherwise(F.lit("Needs Cleaning")).alias("quality_label"))


def full_report(data, mode: str = "approx", spark: SparkSession | None = None) -> dict[str, DataFrame]:
    """AGG13: every part of the report of a DataFrame, or of the Parquet file or
    folder at a path, as a named frame. Shape, duplicates and quality come from
    one full-row pass, columns and gaps from one profile."""
    from tripmart.plans.jobs import stage
    from tripmart.sources.files import as_frame

    df = as_frame(spark or SparkSession.getActiveSession(), data)
    q, profile = stage(quality(df), "quality"), stage(column_profile(df), "profile")
    dup = F.col("duplicate_rows")
    return {"shape": q.select(F.col("rows").alias("raw_rows"), (F.col("rows") - dup).alias("dedup_rows"), "columns"),
            "columns": profile, "head": head_rows(df), "summary": summary_stats(df, mode), "dates": date_summary(df),
            "missing": _gaps(profile),
            "duplicates": q.select(dup.alias("duplicate_count"),
                                   (F.lit(100.0) * dup.cast("double") / F.col("rows").cast("double")).alias("duplicate_pct")),
            "quality": q}


def full_report_long(data, mode: str = "approx", spark: SparkSession | None = None) -> DataFrame:
    """AGG13 flattened to ``(section, item, metric, value)`` with numeric values: the columns, summary
    and quality frames of ``full_report``."""
    from tripmart.sources.files import as_frame

    def melt(frame: DataFrame, section: str, item_col: str | None, metrics: list[str]) -> DataFrame:
        item = F.col(item_col) if item_col else F.lit("*")
        rows = [[F.lit(m), F.col(m).cast("double")] for m in metrics]
        return frame.select(F.lit(section).alias("section"), item.alias("item"),
                            _stack(rows, ["metric", "value"]))

    df = as_frame(spark or SparkSession.getActiveSession(), data)
    report = full_report(df, mode)
    q = (report["quality"].withColumn("quality_high", (F.col("quality_label") == "High").cast("int"))
         .withColumn("numeric_columns", F.lit(len(numeric_columns(df)))).withColumn("categorical_columns", F.lit(len(string_columns(df))))
         .withColumn("duplicate_pct", F.col("duplicate_rows").cast("double") / F.col("rows").cast("double") * F.lit(100.0)))
    return reduce(DataFrame.unionByName, [
        melt(report["columns"], "columns", "column_name", ["non_null", "non_null_pct", "null_count", "null_pct"]),
        melt(report["summary"], "summary", "column_name", ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]),
        melt(q, "dataset", None, ["rows", "columns", "cells", "missing_cells", "duplicate_rows", "duplicate_pct", "quality_pct",
                                  "quality_high", "numeric_columns", "categorical_columns"])])
