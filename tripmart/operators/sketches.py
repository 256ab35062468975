"""Summaries that are stored by month and merged: quantiles (AGG5, PL6) and distinct counts (AGG7).

*Quantiles.* A month's summary of a column holds its value at every ``ceil(n / SIZE)``-th rank
with the exact number of values up to it. Counts are added over months and loads: the sum of
what the summaries have up to v is at most ``slack`` (the sum of their steps less one)
below the true number, so the smallest stored value whose sum reaches rank k has

    values below it  <=  k - 1 + slack          values up to it  >=  k

and slack is at most rows / SIZE. No sketch theory and no luck is involved. Summaries
are made from the distinct values of what is added (a value a third of all trips
have is one row) and take a few ten thousand rows for each month and column; later loads
read only these.

*Distinct counts.* One HyperLogLog sketch (``LG_K`` bits, a few KB) for each month and column;
their union estimates the distinct values of any set of months within ``HLL_ERROR`` (three
standard errors).

Both tables are written by load, so a load that is run again replaces its own rows. NULL and
NaN take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.schema import CAP_COLUMNS, CAP_QUANTILE, PICKUP
from tripmart.session import has_data

SIZE = 20_000
LG_K = 14
HLL_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
MONTH = "pickup_month"
KEYS = ["load", MONTH, "column_name"]


def _long(df: DataFrame, cols: list[str], load: str, month: str) -> DataFrame:
    """(load, month, column_name, value) of the valid values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in cols])
    return (df.select(F.lit(load).alias("load"), F.date_format(month, "yyyy-MM").alias(MONTH), F.explode(pairs).alias("p"))
              .select("load", MONTH, "p.*").where("value is not null and not isnan(value)"))


def _cuts(hist: DataFrame, size: int, slack) -> DataFrame:
    """Cuts of histograms (keys, value, n): values at which the count passes a multiple of the step, and the
    last. ``slack``: column with what the counts may lack already. Values are range-partitioned and summed
    by partition, so a month of any length is spread."""
    from tripmart.plans.jobs import stage

    spread = stage(hist.repartitionByRange(*KEYS, "value").withColumn("part", F.spark_partition_id()), "histogram")
    inside = Window.partitionBy("part", *KEYS).orderBy("value")
    sums = spread.groupBy("part", *KEYS).agg(F.sum("n").alias("n"))
    before = sums.select("part", *KEYS, (F.sum("n").over(Window.partitionBy(*KEYS).orderBy("part")) - F.col("n")).alias("before"),
                         F.sum("n").over(Window.partitionBy(*KEYS)).alias("rows"))
    run = (spread.withColumn("upto", F.sum("n").over(inside)).join(before, ["part", *KEYS])
           .withColumn("upto", F.col("upto") + F.col("before")))
    step = F.ceil(F.col("rows") / size)
    passes = (F.floor(F.col("upto") / step) > F.floor((F.col("upto") - F.col("n")) / step)) | (F.col("upto") == F.col("rows"))
    return run.where(passes).select(*KEYS, "value", "upto", "rows", (step - 1 + slack).cast("bigint").alias("slack"))


def quantile_summary(df: DataFrame, cols: list[str], load: str, size: int = SIZE, month: str = PICKUP) -> DataFrame:
    """(load, pickup_month, column_name, value, upto, rows, slack) of every month in ``df``."""
    hist = _long(df, cols, load, month).groupBy(*KEYS, "value").agg(F.count(F.lit(1)).alias("n"))
    return _cuts(hist, size, F.lit(0))


def distinct_summary(df: DataFrame, cols: list[str], load: str, month: str = PICKUP) -> DataFrame:
    """(load, pickup_month, column_name, sketch) of every month in ``df``."""
    hashed = df.select(F.date_format(month, "yyyy-MM").alias(MONTH), *[F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(c) for c in cols])
    per = hashed.groupBy(MONTH).agg(*[F.hll_sketch_agg(c, LG_K).alias(f"s{i}") for i, c in enumerate(cols)])
    rows = [x for i, c in enumerate(cols) for x in (F.lit(c), F.col(f"s{i}"))]
    return per.select(F.lit(load).alias("load"), MONTH, F.stack(F.lit(len(cols)), *rows).alias("column_name", "sketch"))


def add(summary: DataFrame, path: str) -> None:
    """Store a load's summaries; those of a former attempt of the same load are replaced."""
    (summary.hint("rebalance", "load", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("load", MONTH).parquet(path))


def stored(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """The summaries under ``path``, of all months or some."""
    if not has_data(spark, path):
        raise ValueError(f"no summaries under {path}")
    rows = spark.read.parquet(path).withColumns({"load": F.col("load").cast("string"), MONTH: F.col(MONTH).cast("string")})
    return rows if months is None else rows.where(F.col(MONTH).isin(months))


def merged_quantile(summaries: DataFrame, q: float = CAP_QUANTILE) -> DataFrame:
    """(column_name, rows, threshold, rank_wanted, rank_slack): the discrete quantile of all that the
    summaries cover. Works on the stored cuts alone."""
    inc = F.col("upto") - F.coalesce(F.lag("upto").over(Window.partitionBy(*KEYS).orderBy("value")), F.lit(0))
    at = summaries.withColumn("inc", inc).groupBy("column_name", "value").agg(F.sum("inc").alias("inc"))
    whole = (summaries.groupBy(*KEYS).agg(F.max("rows").alias("rows"), F.max("slack").alias("slack"))
             .groupBy("column_name").agg(F.sum("rows").alias("rows"), F.sum("slack").alias("rank_slack"))
             .withColumn("rank_wanted", F.greatest(F.lit(1), F.ceil(F.lit(float(q)) * F.col("rows")))))
    upto = at.withColumn("upto", F.sum("inc").over(Window.partitionBy("column_name").orderBy("value")))     # rows: cuts, not trips
    hit = upto.join(whole, "column_name").where("upto >= rank_wanted").groupBy("column_name").agg(F.min("value").alias("threshold"))
    return whole.join(hit, "column_name").select("column_name", "rows", "threshold", "rank_wanted", "rank_slack")


def thresholds(summaries: DataFrame, cols: list[str] | None = None, q: float = CAP_QUANTILE) -> dict[str, float | None]:
    """Cap limits by column from stored summaries (one row a column is collected)."""
    got = {r.column_name: r.threshold for r in merged_quantile(summaries, q).collect()}
    return {c: got.get(c) for c in (CAP_COLUMNS if cols is None else cols)}


def fold(summaries: DataFrame, load: str, size: int = SIZE) -> DataFrame:
    """Summaries of several loads of a month as one, under a new load: what many small arrivals
    have left. Slacks add up."""
    inc = F.col("upto") - F.coalesce(F.lag("upto").over(Window.partitionBy(*KEYS).orderBy("value")), F.lit(0))
    keys = [F.lit(load).alias("load"), MONTH, "column_name"]
    hist = summaries.withColumn("inc", inc).groupBy(*keys, "value").agg(F.sum("inc").alias("n"))
    had = (summaries.groupBy(*KEYS).agg(F.max("slack").alias("slack")).groupBy(*keys).agg(F.sum("slack").alias("had")))
    cuts = _cuts(hist, size, F.lit(0))
    return cuts.join(had, KEYS).select(*KEYS, "value", "upto", "rows", (F.col("slack") + F.col("had")).alias("slack"))


def distinct_estimate(summaries: DataFrame) -> DataFrame:
    """(column_name, sketches, estimate) over all months of the summaries."""
    return summaries.groupBy("column_name").agg(F.count(F.lit(1)).alias("sketches"),
                                                F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
