"""Raw and star schemas, code lists and column groups."""

from __future__ import annotations

from pyspark.sql import types as T

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
DURATION = "trip_duration_min"

# Raw trip file schema: 20 columns, zone-less timestamps.
RAW = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField(PICKUP, T.TimestampNTZType()),
    T.StructField(DROPOFF, T.TimestampNTZType()),
    T.StructField("passenger_count", T.DoubleType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("RatecodeID", T.DoubleType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("payment_type", T.LongType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("Airport_fee", T.DoubleType()),
    T.StructField("cbd_congestion_fee", T.DoubleType()),
])
RAW_COLUMNS = [f.name for f in RAW.fields]

# --- Fixed values: must equal the reference for the same results -------------
# Constant fills of the clean job.
FILL_VALUES = {
    "passenger_count": 1,
    "trip_distance": 0.0,
    "fare_amount": 0.0,
    "extra": 0.0,
    "mta_tax": 0.0,
    "tip_amount": 0.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.0,
    "congestion_surcharge": 0.0,
    "Airport_fee": 0.0,
    "cbd_congestion_fee": 0.0,
    "store_and_fwd_flag": "N",
}
# Constant fills of the early Spark cleaner.
EARLY_FILL_VALUES = {"fare_amount": 0, "trip_distance": 0, "passenger_count": 1}
# Columns capped at the 99th percentile, and the quantile.
CAP_COLUMNS = ["fare_amount", "trip_distance", DURATION]
EARLY_CAP_COLUMNS = ["fare_amount", "trip_distance"]
CAP_QUANTILE = 0.99
# Columns cast to integer by the clean job.
INT_COLUMNS = ["passenger_count", "PULocationID", "DOLocationID", "RatecodeID",
               "payment_type", "VendorID"]
# Payment and rate code labels.
PAYMENT_LABELS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute",
                  5: "Unknown", 6: "Voided"}
RATE_LABELS = {1: "Standard", 2: "JFK", 3: "Newark", 4: "Nassau",
               5: "Negotiated", 6: "Group"}
# Money columns of the fact, decimal(10,2) in the warehouse.
FACT_MONEY = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
              "improvement_surcharge", "total_amount"]
# Landing file names.
TRIPDATA_PATTERN = r"^(yellow|green)_tripdata_\d{4}-\d{2}\.parquet$"
# Adaptive imputation: numeric columns under this null share get the median.
MEDIAN_NULL_SHARE = 0.2
# -----------------------------------------------------------------------------

MONEY = T.DecimalType(10, 2)

DIM_DATETIME = T.StructType([
    T.StructField("datetime_id", T.LongType(), False),
    T.StructField("pickup_datetime", T.TimestampNTZType(), False),
    T.StructField("dropoff_datetime", T.TimestampNTZType(), False),
    T.StructField("hour", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("weekday", T.StringType()),
    T.StructField("trip_duration_min", T.IntegerType()),
])
DIM_LOCATION = T.StructType([
    T.StructField("location_id", T.IntegerType(), False),
    T.StructField("borough", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])
DIM_VENDOR = T.StructType([
    T.StructField("vendor_id", T.IntegerType(), False),
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("vendor_name", T.StringType()),
    T.StructField("store_fwd_flag", T.StringType()),
])
DIM_PAYMENT = T.StructType([
    T.StructField("payment_id", T.IntegerType(), False),
    T.StructField("payment_type", T.IntegerType()),
    T.StructField("payment_desc", T.StringType()),
    T.StructField("congestion_surcharge", MONEY),
    T.StructField("cbd_congestion_fee", MONEY),
])
DIM_RATE = T.StructType([
    T.StructField("rate_id", T.IntegerType(), False),
    T.StructField("RatecodeID", T.IntegerType()),
    T.StructField("rate_desc", T.StringType()),
    T.StructField("airport_fee", MONEY),
])
FACT_TRIP = T.StructType(
    [T.StructField("trip_id", T.LongType(), False),
     T.StructField("datetime_id", T.LongType()),
     T.StructField("location_id", T.IntegerType()),
     T.StructField("vendor_id", T.IntegerType()),
     T.StructField("payment_id", T.IntegerType()),
     T.StructField("rate_id", T.IntegerType()),
     T.StructField("passenger_count", T.IntegerType()),
     T.StructField("trip_distance", T.FloatType())]
    + [T.StructField(c, MONEY) for c in FACT_MONEY])

STAR = {
    "DIM_DATETIME": DIM_DATETIME,
    "DIM_LOCATION": DIM_LOCATION,
    "DIM_VENDOR": DIM_VENDOR,
    "DIM_PAYMENT": DIM_PAYMENT,
    "DIM_RATE": DIM_RATE,
    "FACT_TRIP": FACT_TRIP,
}
# Load order: dimensions before the fact.
STAR_ORDER = ["DIM_DATETIME", "DIM_LOCATION", "DIM_VENDOR", "DIM_PAYMENT",
              "DIM_RATE", "FACT_TRIP"]

# Warehouse contract (SNK5): primary keys, NOT NULL columns, string widths and
# foreign keys of the star.
PRIMARY_KEYS = {
    "DIM_DATETIME": "datetime_id", "DIM_LOCATION": "location_id",
    "DIM_VENDOR": "vendor_id", "DIM_PAYMENT": "payment_id",
    "DIM_RATE": "rate_id", "FACT_TRIP": "trip_id",
}
NOT_NULL = {
    "DIM_DATETIME": ["datetime_id", "pickup_datetime", "dropoff_datetime"],
    "DIM_LOCATION": ["location_id"], "DIM_VENDOR": ["vendor_id"],
    "DIM_PAYMENT": ["payment_id"], "DIM_RATE": ["rate_id"],
    "FACT_TRIP": ["trip_id"],
}
STRING_WIDTHS = {
    "DIM_DATETIME": {"weekday": 10},
    "DIM_LOCATION": {"borough": 50, "zone": 100, "service_zone": 50},
    "DIM_VENDOR": {"vendor_name": 50, "store_fwd_flag": 1},
    "DIM_PAYMENT": {"payment_desc": 20},
    "DIM_RATE": {"rate_desc": 30},
}
FOREIGN_KEYS = [
    ("datetime_id", "DIM_DATETIME"), ("location_id", "DIM_LOCATION"),
    ("vendor_id", "DIM_VENDOR"), ("payment_id", "DIM_PAYMENT"),
    ("rate_id", "DIM_RATE"),
]
