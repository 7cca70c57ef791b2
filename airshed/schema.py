"""Declared schemas of the layers."""

from pyspark.sql import types as T

# Raw measurement columns, in file order, with the type each one is read as.
RAW_FIELDS = (
    ("date", T.StringType()),
    ("location", T.StringType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("site_type", T.StringType()),
    ("zone", T.StringType()),
    ("pollutant_type", T.StringType()),
    ("value", T.DoubleType()),
    ("unit", T.StringType()),
    ("status", T.StringType()),
)
RAW_COLUMNS = tuple(n for n, _ in RAW_FIELDS)
NUMERIC_RAW_COLUMNS = tuple(n for n, t in RAW_FIELDS if isinstance(t, T.DoubleType))

RAW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_FIELDS])

METADATA_FIELDS = (
    ("ingestion_timestamp", T.TimestampType()),
    ("source_file", T.StringType()),
)

BRONZE_SCHEMA = T.StructType(
    [T.StructField(n, t, True) for n, t in RAW_FIELDS + METADATA_FIELDS])

# Silver: Bronze without the text date, with the parsed DATE as last column.
SILVER_SCHEMA = T.StructType(
    [f for f in BRONZE_SCHEMA.fields if f.name != "date"]
    + [T.StructField("date", T.DateType(), True)])

GOLD_KEYS = ("date", "location", "pollutant_type", "zone")
GOLD_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("pollutant_type", T.StringType(), True),
    T.StructField("zone", T.StringType(), True),
    T.StructField("avg_value", T.DoubleType(), True),
    T.StructField("max_value", T.DoubleType(), True),
    T.StructField("min_value", T.DoubleType(), True),
    T.StructField("record_count", T.LongType(), True),
])

# Run history used by the monitoring queries.
RUNS_SCHEMA = T.StructType([
    T.StructField("pipeline_name", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("time_generated", T.TimestampType(), True),
])
