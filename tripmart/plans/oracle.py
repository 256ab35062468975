"""DuckDB SQL for the correctness gate.

Each oracle is ``WITH <named steps> SELECT ...`` over the driver's views. The
steps mirror the Spark operators one to one, so a mismatch points at a step.
Integer aggregates are cast to BIGINT (DuckDB sums to HUGEINT), ``hour()`` and
friends to INTEGER, and double -> integer casts truncate first (DuckDB rounds).
"""

from __future__ import annotations

from tripmart.schema import FILL_VALUES, PAYMENT_LABELS, RATE_LABELS

_OPT_NULL = "((l_orderkey + l_linenumber) % 13 = 0)"

TRIPS = f"""
trips_j AS (
  SELECT l.*, o.o_orderdate,
         o.o_orderdate + to_minutes(CAST(((l_orderkey*37 + l_linenumber*101 + l_partkey) % 24) * 60 AS BIGINT)) AS pu
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
trips_b AS (
  SELECT
    CAST(l_suppkey % 4 + 1 AS INT) AS VendorID,
    pu AS tpep_pickup_datetime,
    pu + to_seconds((CAST(l_quantity AS BIGINT) - 2) * 60) AS tpep_dropoff_datetime,
    CASE WHEN {_OPT_NULL} THEN NULL ELSE CAST(l_linenumber - 1 AS DOUBLE) END AS passenger_count,
    CASE WHEN l_partkey % 97 = 0 THEN CAST(0 AS DOUBLE)
         ELSE CAST(l_quantity AS DOUBLE) / CAST(4 AS DOUBLE) + CAST(l_partkey % 100 AS DOUBLE) / CAST(100 AS DOUBLE) END AS trip_distance,
    CASE WHEN {_OPT_NULL} THEN NULL WHEN l_partkey % 41 = 0 THEN CAST(99 AS DOUBLE)
         ELSE CAST(l_suppkey % 6 + 1 AS DOUBLE) END AS RatecodeID,
    CASE WHEN {_OPT_NULL} THEN NULL WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(l_partkey % 265 + 1 AS INT) AS PULocationID,
    CAST(l_suppkey % 265 + 1 AS INT) AS DOLocationID,
    CAST(l_orderkey % 7 AS BIGINT) AS payment_type,
    CAST(floor(l_extendedprice / CAST(10 AS DOUBLE)) - 200 AS DOUBLE) / CAST(100 AS DOUBLE) AS fare_amount,
    CAST(l_linenumber % 3 AS DOUBLE) / CAST(2 AS DOUBLE) AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    CAST(l_linenumber AS DOUBLE) * CAST(0.75 AS DOUBLE) AS tip_amount,
    CASE WHEN l_linenumber = 5 THEN CAST(6.94 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tolls_amount,
    CAST(1 AS DOUBLE) AS improvement_surcharge,
    CAST(floor(l_extendedprice / CAST(10 AS DOUBLE)) + 75 * l_linenumber AS DOUBLE) / CAST(100 AS DOUBLE) AS total_amount,
    CASE WHEN {_OPT_NULL} THEN NULL ELSE CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
    CASE WHEN {_OPT_NULL} THEN NULL WHEN l_partkey % 265 + 1 IN (132, 138) THEN CAST(1.75 AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS Airport_fee,
    CASE WHEN l_linestatus = 'O' THEN CAST(0.75 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS cbd_congestion_fee,
    l_orderkey
  FROM trips_j
),
trips AS (
  SELECT * EXCLUDE (l_orderkey) FROM trips_b
  UNION ALL
  SELECT * EXCLUDE (l_orderkey) FROM trips_b WHERE l_orderkey % 50 = 0
)"""


def qcont(x: str, q: float, src: str, valid: str | None = None) -> str:
    """Exact interpolated quantile as a scalar subquery: values at ranks
    floor(p) and ceil(p), p = q * (n - 1), joined by lo + (hi - lo) * d."""
    cond = valid or f"{x} IS NOT NULL AND NOT isnan(CAST({x} AS DOUBLE))"
    return (f"(SELECT CASE WHEN lo = hi THEN lo ELSE lo + (hi - lo) * d END FROM ("
            f"SELECT max(CASE WHEN rk = fl THEN v END) AS lo, max(CASE WHEN rk = ce THEN v END) AS hi, "
            f"any_value(d) AS d FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS rk, floor(p) AS fl, "
            f"ceil(p) AS ce, p - floor(p) AS d FROM (SELECT v, CAST({q} AS DOUBLE) * "
            f"CAST(count(*) OVER () - 1 AS DOUBLE) AS p FROM (SELECT CAST({x} AS DOUBLE) AS v FROM {src} "
            f"WHERE {cond}))) WHERE rk = fl OR rk = ce))")


def _pos(c: str) -> str:
    return f"({c} > 0 AND NOT isnan({c}))"


def _fill_replace(values: dict) -> str:
    parts = []
    for c, v in values.items():
        lit = f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)"
        parts.append(f"coalesce({c}, {lit}) AS {c}")
    return ", ".join(parts)


def _cap_replace(cols: list[str], caps_alias: str = "caps") -> str:
    return ", ".join(f"CASE WHEN {c} > (SELECT q_{c} FROM {caps_alias}) "
                     f"THEN (SELECT q_{c} FROM {caps_alias}) ELSE {c} END AS {c}" for c in cols)


def _caps(src: str, cols: list[str], fn: str) -> str:
    if fn == "quantile_cont":
        return "SELECT " + ", ".join(f"{qcont(c, 0.99, src)} AS q_{c}" for c in cols)
    return "SELECT " + ", ".join(f"{fn}({c}, 0.99) AS q_{c}" for c in cols) + f" FROM {src}"


_INT_CAST = ", ".join(f"CAST(trunc({c}) AS INTEGER) AS {c}" for c in
                      ["passenger_count", "PULocationID", "DOLocationID", "RatecodeID",
                       "payment_type", "VendorID"])
CAP3 = ["fare_amount", "trip_distance", "trip_duration_min"]
CAP2 = ["fare_amount", "trip_distance"]

STEPS = {
    "trips": TRIPS,
    "dedup": "dedup AS (SELECT DISTINCT * FROM trips)",
    "dur": ("dur AS (SELECT *, CAST(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime)"
            " AS DOUBLE) / CAST(60 AS DOUBLE) AS trip_duration_min FROM dedup)"),
    "valid": (f"valid AS (SELECT * FROM dur WHERE {_pos('trip_duration_min')} AND {_pos('fare_amount')}"
              f" AND {_pos('trip_distance')} AND {_pos('passenger_count')})"),
    "valid_fill": (f"valid_fill AS (SELECT * FROM dur WHERE {_pos('trip_duration_min')}"
                   f" AND {_pos('fare_amount')} AND {_pos('trip_distance')})"),
    "filled": f"filled AS (SELECT * REPLACE ({_fill_replace(FILL_VALUES)}) FROM valid)",
    "caps_disc": f"caps_disc AS ({_caps('filled', CAP3, 'quantile_disc')})",
    "capped": f"capped AS (SELECT * REPLACE ({_cap_replace(CAP3, 'caps_disc')}) FROM filled)",
    "clean": f"clean AS (SELECT * REPLACE ({_INT_CAST}) FROM capped)",
}


def with_steps(*names: str, extra: str = "") -> str:
    """``WITH`` clause holding the named steps (in order) and extra CTE text."""
    parts = [STEPS[n].strip() for n in names]
    if extra:
        parts.append(extra.strip())
    return "WITH " + ",\n".join(parts) + "\n"


CLEAN = ("trips", "dedup", "dur", "valid", "filled", "caps_disc", "capped", "clean")


def map_case(col: str, labels: dict[int, str]) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {k} THEN '{v}'" for k, v in labels.items()) + " END"


PAYMENT_CASE = map_case("payment_type", PAYMENT_LABELS)
RATE_CASE = map_case("RatecodeID", RATE_LABELS)

_NULL_S = "CAST(NULL AS VARCHAR)"
STEPS.update({
    "clean_id": "clean_id AS (SELECT *, row_number() OVER () AS trip_id FROM clean)",
    "dim_datetime": """dim_datetime AS (
  SELECT row_number() OVER (ORDER BY p, d) AS datetime_id, p AS pickup_datetime, d AS dropoff_datetime,
         CAST(hour(p) AS INTEGER) AS hour, CAST(day(p) AS INTEGER) AS day,
         CAST(month(p) AS INTEGER) AS month, CAST(year(p) AS INTEGER) AS year,
         dayname(p) AS weekday, CAST(trunc(dur) AS INTEGER) AS trip_duration_min
  FROM (SELECT tpep_pickup_datetime AS p, tpep_dropoff_datetime AS d, min(trip_duration_min) AS dur
        FROM clean GROUP BY 1, 2))""",
    "dim_location": f"""dim_location AS (
  SELECT location_id, {_NULL_S} AS borough, {_NULL_S} AS zone, {_NULL_S} AS service_zone
  FROM (SELECT PULocationID AS location_id FROM clean UNION SELECT DOLocationID FROM clean)
  WHERE location_id IS NOT NULL)""",
    "zones": f"""zones AS (
  SELECT CAST(n_nationkey + 1 AS INTEGER) AS location_id, r_name AS borough, n_name AS zone,
         {_NULL_S} AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "dim_location_zones": """dim_location_zones AS (
  SELECT d.location_id, z.borough, z.zone, z.service_zone
  FROM (SELECT DISTINCT location_id FROM dim_location) d LEFT JOIN zones z USING (location_id))""",
    "dim_vendor": f"""dim_vendor AS (
  SELECT VendorID AS vendor_id, VendorID, {_NULL_S} AS vendor_name, store_and_fwd_flag AS store_fwd_flag
  FROM (SELECT *, row_number() OVER (PARTITION BY VendorID
          ORDER BY tpep_pickup_datetime, store_and_fwd_flag NULLS FIRST) AS rn
        FROM clean WHERE VendorID IS NOT NULL) WHERE rn = 1)""",
    "dim_payment": f"""dim_payment AS (
  SELECT payment_type AS payment_id, payment_type, {PAYMENT_CASE} AS payment_desc,
         CAST(congestion_surcharge AS DECIMAL(10,2)) AS congestion_surcharge,
         CAST(cbd_congestion_fee AS DECIMAL(10,2)) AS cbd_congestion_fee
  FROM (SELECT *, row_number() OVER (PARTITION BY payment_type ORDER BY tpep_pickup_datetime,
          congestion_surcharge NULLS FIRST, cbd_congestion_fee NULLS FIRST) AS rn
        FROM clean WHERE payment_type IS NOT NULL) WHERE rn = 1)""",
    "dim_rate": f"""dim_rate AS (
  SELECT RatecodeID AS rate_id, RatecodeID, {RATE_CASE} AS rate_desc,
         CAST(Airport_fee AS DECIMAL(10,2)) AS airport_fee
  FROM (SELECT *, row_number() OVER (PARTITION BY RatecodeID
          ORDER BY tpep_pickup_datetime, Airport_fee NULLS FIRST) AS rn
        FROM clean WHERE RatecodeID IS NOT NULL) WHERE rn = 1)""",
    "fact_trip": """fact_trip AS (
  SELECT c.trip_id, dt.datetime_id, c.PULocationID AS location_id, c.VendorID AS vendor_id,
         c.payment_type AS payment_id, c.RatecodeID AS rate_id,
         CAST(c.passenger_count AS INTEGER) AS passenger_count,
         CAST(c.trip_distance AS FLOAT) AS trip_distance,
         CAST(c.fare_amount AS DECIMAL(10,2)) AS fare_amount, CAST(c.extra AS DECIMAL(10,2)) AS extra,
         CAST(c.mta_tax AS DECIMAL(10,2)) AS mta_tax, CAST(c.tip_amount AS DECIMAL(10,2)) AS tip_amount,
         CAST(c.tolls_amount AS DECIMAL(10,2)) AS tolls_amount,
         CAST(c.improvement_surcharge AS DECIMAL(10,2)) AS improvement_surcharge,
         CAST(c.total_amount AS DECIMAL(10,2)) AS total_amount
  FROM clean_id c LEFT JOIN dim_datetime dt
    ON c.tpep_pickup_datetime = dt.pickup_datetime AND c.tpep_dropoff_datetime = dt.dropoff_datetime)""",
})
STAR = CLEAN + ("clean_id", "dim_datetime", "dim_location", "dim_vendor", "dim_payment",
                "dim_rate", "fact_trip")


def star_checks_sql() -> str:
    """The same violation counts as ``checks.star_checks``, over the star CTEs."""
    from tripmart.schema import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, STRING_WIDTHS
    cte = {"DIM_DATETIME": "dim_datetime", "DIM_LOCATION": "dim_location",
           "DIM_VENDOR": "dim_vendor", "DIM_PAYMENT": "dim_payment", "DIM_RATE": "dim_rate",
           "FACT_TRIP": "fact_trip"}

    def row(t, chk, col, expr, src):
        return (f"SELECT '{t}' AS table_name, '{chk}' AS check_name, '{col}' AS column_name, "
                f"CAST({expr} AS BIGINT) AS violations FROM {src}")

    parts = []
    for t, src in cte.items():
        for c in NOT_NULL[t]:
            parts.append(row(t, "not_null", c, f"coalesce(count_if({c} IS NULL), 0)", src))
        pk = PRIMARY_KEYS[t]
        parts.append(row(t, "primary_key", pk, "count(*)",
                         f"(SELECT {pk} FROM {src} WHERE {pk} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"))
        for c, n in STRING_WIDTHS.get(t, {}).items():
            parts.append(row(t, "string_width", c, f"coalesce(count_if(length({c}) > {n}), 0)", src))
    for col, dim in FOREIGN_KEYS:
        pk = PRIMARY_KEYS[dim]
        parts.append(row("FACT_TRIP", "foreign_key", col, "count(*)",
                         f"(SELECT {col} FROM fact_trip f WHERE {col} IS NOT NULL AND NOT EXISTS "
                         f"(SELECT 1 FROM {cte[dim]} d WHERE d.{pk} = f.{col}))"))
    parts.append(row("FACT_TRIP", "row_count", "*",
                     "abs((SELECT count(*) FROM fact_trip) - (SELECT count(*) FROM clean))",
                     "(SELECT 1)"))
    return with_steps(*STAR) + "\nUNION ALL\n".join(parts)


# --- Profile oracles over the raw trips -------------------------------------

def sround(x: str, n: int) -> str:
    """Spark's ``round`` on doubles (HALF_UP on the decimal digits) in DuckDB."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def _raw_meta(schema=None):
    """Columns, numeric / text / floating columns of ``schema`` (default RAW)."""
    from pyspark.sql import types as T

    from tripmart.schema import RAW
    schema = RAW if schema is None else schema
    cols = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    num = [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)]
    txt = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    flt = {f.name for f in schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return cols, num, txt, flt


def adaptive_schema():
    """Schema of the adaptive cleaner's output: raw columns + trip_duration."""
    from pyspark.sql import types as T

    from tripmart.schema import RAW
    return T.StructType(RAW.fields + [T.StructField("trip_duration", T.DoubleType())])


def _miss(c: str, flt: set) -> str:
    return f"({c} IS NULL OR isnan({c}))" if c in flt else f"({c} IS NULL)"


def column_profile_sql(src: str = "trips", schema=None) -> str:
    cols, _, _, flt = _raw_meta(schema)
    parts = []
    for i, (c, t) in enumerate(cols):
        m = f"count_if({_miss(c, flt)})"
        parts.append(
            f"SELECT {i + 1} AS ordinal, '{c}' AS column_name, '{t}' AS dtype, "
            f"CAST(count(*) - {m} AS BIGINT) AS non_null, "
            f"CAST(count(*) - {m} AS DOUBLE) / CAST(count(*) AS DOUBLE) * CAST(100 AS DOUBLE) AS non_null_pct, "
            f"CAST({m} AS BIGINT) AS null_count, "
            f"CAST({m} AS DOUBLE) / CAST(count(*) AS DOUBLE) * CAST(100 AS DOUBLE) AS null_pct FROM {src}")
    return "(" + " UNION ALL ".join(parts) + ")"


def summary_sql(src: str = "trips", schema=None) -> str:
    _, num, _, flt = _raw_meta(schema)
    parts = []
    for c in num:
        x = f"CASE WHEN NOT {_miss(c, flt)} THEN CAST({c} AS DOUBLE) END"
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(count_if(NOT {_miss(c, flt)}) AS BIGINT) AS count, "
            f"{sround(f'avg({x})', 2)} AS mean, {sround(f'stddev_samp({x})', 2)} AS std, "
            f"{sround(f'min({x})', 2)} AS min, "
            + ", ".join(f"{sround(qcont(c, p, src, 'NOT ' + _miss(c, flt)), 2)} AS q{int(p * 100)}"
                        for p in (0.25, 0.5, 0.75))
            + f", {sround(f'max({x})', 2)} AS max FROM {src}")
    return "(" + " UNION ALL ".join(parts) + ")"


def head_rows_sql(src: str = "trips", n: int = 5) -> str:
    cols, _, _, _ = _raw_meta()
    order = ", ".join(f"{c} NULLS FIRST" for c, _ in cols)
    return f"SELECT * FROM {src} ORDER BY {order} LIMIT {n}"


def value_counts_sql(src: str = "trips", k: int = 5) -> str:
    _, _, txt, _ = _raw_meta()
    return " UNION ALL ".join(
        f"(SELECT '{c}' AS column_name, value, count FROM (SELECT {c} AS value, "
        f"CAST(count(*) AS BIGINT) AS count FROM {src} WHERE {c} IS NOT NULL GROUP BY 1 "
        f"ORDER BY count DESC, value LIMIT {k}))" for c in txt)


def distinct_counts_sql(src: str = "trips") -> str:
    _, _, txt, _ = _raw_meta()
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) "
                              f"AS distinct_count FROM {src}" for c in txt)


def distinct_values_sql(src: str = "trips") -> str:
    _, _, txt, _ = _raw_meta()
    return " UNION ".join(f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM {src}"
                          for c in txt)


def correlation_sql(src: str = "trips") -> str:
    _, num, _, _ = _raw_meta()
    pairs = [(a, b) for i, a in enumerate(num) for b in num[i:]]
    aggs = []
    for j, (a, b) in enumerate(pairs):
        both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
        xa, xb = (f"CASE WHEN {both} THEN CAST({a} AS DOUBLE) END",
                  f"CASE WHEN {both} THEN CAST({b} AS DOUBLE) END")
        aggs.append(f"covar_pop({xa}, {xb}) AS cv{j}, stddev_pop({xa}) AS sa{j}, stddev_pop({xb}) AS sb{j}")
    cte = f"corr_agg AS (SELECT {', '.join(aggs)} FROM {src})"
    sel = []
    for j, (a, b) in enumerate(pairs):
        v = sround(f"CASE WHEN sa{j} * sb{j} = 0 THEN NULL ELSE cv{j} / (sa{j} * sb{j}) END", 6)
        sel.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, {v} AS corr FROM corr_agg")
        if a != b:
            sel.append(f"SELECT '{b}' AS column_a, '{a}' AS column_b, {v} AS corr FROM corr_agg")
    return cte, " UNION ALL ".join(sel)


def outlier_sql(src: str = "trips") -> str:
    _, num, _, flt = _raw_meta()
    parts = []
    for c in num[:6]:
        x = f"(CASE WHEN NOT {_miss(c, flt)} THEN CAST({c} AS DOUBLE) END)"
        ok = "NOT " + _miss(c, flt)
        q = (f"(SELECT {qcont(c, 0.25, src, ok)} AS q1, {qcont(c, 0.5, src, ok)} AS med, "
             f"{qcont(c, 0.75, src, ok)} AS q3)")
        f = (f"(SELECT q1, med, q3, q3 - q1 AS iqr, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lo, "
             f"q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS hi FROM {q})")
        parts.append(
            f"SELECT '{c}' AS column_name, q1, med AS median, q3, iqr, lo AS lower_fence, "
            f"hi AS upper_fence, (SELECT min({x}) FROM {src} WHERE {x} >= lo) AS whisker_low, "
            f"(SELECT max({x}) FROM {src} WHERE {x} <= hi) AS whisker_high, "
            f"(SELECT CAST(count(*) AS BIGINT) FROM {src} WHERE {x} < lo OR {x} > hi) AS outliers FROM {f}")
    return " UNION ALL ".join(parts)


def quality_sql(src: str = "trips", schema=None) -> str:
    cols, _, _, flt = _raw_meta(schema)
    nulls = " + ".join(f"CAST({_miss(c, flt)} AS INTEGER)" for c, _ in cols)
    n = len(cols)
    return (f"SELECT rows, {n} AS columns, cells, missing_cells, duplicate_rows, "
            f"CAST(cells - missing_cells AS DOUBLE) / CAST(cells AS DOUBLE) * CAST(100 AS DOUBLE) AS quality_pct, "
            f"CASE WHEN duplicate_rows = 0 AND missing_cells = 0 THEN 'High' ELSE 'Needs Cleaning' END AS quality_label "
            f"FROM (SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) * {n} AS BIGINT) AS cells, "
            f"CAST(coalesce(sum({nulls}), 0) AS BIGINT) AS missing_cells, "
            f"CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {src})) AS BIGINT) AS duplicate_rows "
            f"FROM {src})")


def full_report_sql(src: str = "trips", schema=None) -> str:
    _, num, txt, _ = _raw_meta(schema)

    def melt(q: str, section: str, item: str | None, metrics: list[str]) -> str:
        it = item or "'*'"
        return " UNION ALL ".join(
            f"SELECT '{section}' AS section, {it} AS item, '{m}' AS metric, CAST({m} AS DOUBLE) AS value "
            f"FROM ({q})" for m in metrics)
    ds = (f"SELECT *, CAST(quality_label = 'High' AS INTEGER) AS quality_high, {len(num)} AS numeric_columns, "
          f"{len(txt)} AS categorical_columns, CAST(duplicate_rows AS DOUBLE) / CAST(rows AS DOUBLE) "
          f"* CAST(100 AS DOUBLE) AS duplicate_pct FROM ({quality_sql(src, schema)})")
    return " UNION ALL ".join([
        melt(f"SELECT * FROM {column_profile_sql(src, schema)}", "columns", "column_name",
             ["non_null", "non_null_pct", "null_count", "null_pct"]),
        melt(f"SELECT * FROM {summary_sql(src, schema)}", "summary", "column_name",
             ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]),
        melt(ds, "dataset", None, ["rows", "columns", "cells", "missing_cells", "duplicate_rows",
                                   "duplicate_pct", "quality_pct", "quality_high",
                                   "numeric_columns", "categorical_columns"]),
    ])


# --- Imputation oracles -------------------------------------------------------

AD_STEPS = ("trips", "dedup")
STEPS.update({
    "ad_valid": """ad_valid AS (
  SELECT * FROM (SELECT *, CAST(date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) AS DOUBLE)
                 / CAST(1000000 AS DOUBLE) / CAST(60 AS DOUBLE) AS trip_duration FROM dedup)
  WHERE trip_duration > 0 AND NOT isnan(trip_duration) AND fare_amount > 0 AND NOT isnan(fare_amount)
    AND trip_distance > 0 AND NOT isnan(trip_distance))""",
})


_DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT"}


def _ad_meta():
    cols, num, txt, flt = _raw_meta()
    return [c for c, _ in cols] + ["trip_duration"], num + ["trip_duration"], txt, flt | {"trip_duration"}


def _ad_types() -> dict[str, str]:
    cols, _, _, _ = _raw_meta()
    return {**dict(cols), "trip_duration": "double"}


def adaptive_fill_sql(name: str, src: str, median_below: float) -> str:
    """CTE ``name``: the adaptive fills of ``src`` with the rules decided in SQL."""
    cols, num, txt, flt = _ad_meta()
    rep = []
    for c in cols:
        ratio = f"(SELECT avg(CAST({_miss(c, flt)} AS DOUBLE)) FROM {src})"
        if c in txt:
            mode = (f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} "
                    f"ORDER BY count(*) DESC, {c} LIMIT 1)")
            val = f"coalesce({mode}, 'Unknown')"
        elif c in num:
            med = qcont(c, 0.5, src, "NOT " + _miss(c, flt))
            val = f"CASE WHEN {ratio} < {median_below} THEN {med} ELSE CAST(0 AS DOUBLE) END"
            t = _DUCK_TYPES[_ad_types()[c]]
            val = f"CAST({val} AS {t})" if c in flt else f"CAST(trunc({val}) AS {t})"
        else:
            continue
        rep.append(f"CASE WHEN {_miss(c, flt)} THEN {val} ELSE {c} END AS {c}")
    return f"{name} AS (SELECT * REPLACE ({', '.join(rep)}) FROM {src})"


def null_ratio_sql(src: str = "ad_valid", median_below: float = 0.2) -> str:
    cols, num, txt, flt = _ad_meta()
    parts = []
    for c in cols:
        r = f"CAST(count_if({_miss(c, flt)}) AS DOUBLE) / CAST(count(*) AS DOUBLE)"
        kind = ("'mode'" if c in txt else
                f"CASE WHEN {r} < {median_below} THEN 'median' ELSE 'zero' END" if c in num else "'ffill'")
        parts.append(f"SELECT '{c}' AS column_name, {r} AS null_ratio, "
                     f"CASE WHEN count_if({_miss(c, flt)}) = 0 THEN 'none' ELSE {kind} END AS fill_rule FROM {src}")
    return " UNION ALL ".join(parts)


def mode_sql(src: str = "ad_valid") -> str:
    _, _, txt, _ = _ad_meta()
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, coalesce((SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} "
        f"ORDER BY count(*) DESC, {c} LIMIT 1), 'Unknown') AS mode_value" for c in txt)


def median_sql(src: str = "ad_valid") -> str:
    _, num, _, flt = _ad_meta()
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {qcont(c, 0.5, src, 'NOT ' + _miss(c, flt))} AS median" for c in num)


def adaptive_clean_sql(select: str = "SELECT * FROM ad_capped") -> str:
    fill = adaptive_fill_sql("ad_filled", "ad_valid", 0.2)
    caps = f"ad_caps AS ({_caps('ad_filled', ['trip_duration', 'fare_amount', 'trip_distance'], 'quantile_cont')})"
    capped = ("ad_capped AS (SELECT * REPLACE ("
              + _cap_replace(["trip_duration", "fare_amount", "trip_distance"], "ad_caps") + ") FROM ad_filled)")
    return with_steps(*AD_STEPS, "ad_valid", extra=",\n".join([fill, caps, capped])) + select
