"""Schemas of the messages and tables the pipelines exchange."""

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# One device message; ``timestamp`` is epoch seconds. A field declared
# non-nullable is required: JSON parsing itself does not enforce it.
DEVICE_MESSAGE = StructType(
    [
        StructField("timestamp", LongType(), False),
        StructField("id", StringType(), False),
        StructField("antenna_id", StringType(), False),
        StructField("bytes", LongType(), False),
        StructField("app", StringType(), False),
    ]
)

DATE_PARTS = ("year", "month", "day", "hour")

LANDED_MESSAGE = StructType(
    DEVICE_MESSAGE.fields + [StructField(name, IntegerType(), True) for name in DATE_PARTS]
)

USER_METADATA = StructType(
    [
        StructField("id", StringType()),
        StructField("name", StringType()),
        StructField("email", StringType()),
        StructField("quota", LongType()),
    ]
)

METRIC = StructType(
    [
        StructField("timestamp", TimestampType()),
        StructField("id", StringType()),
        StructField("value", LongType()),
        StructField("type", StringType()),
    ]
)

QUOTA_ALERT = StructType(
    [
        StructField("email", StringType()),
        StructField("usage", LongType()),
        StructField("quota", LongType()),
        StructField("timestamp", TimestampType()),
    ]
)
