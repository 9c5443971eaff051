"""Row shapes shared by all stages."""

from pyspark.sql import types as T

RAW_MESSAGE = T.StructType([
    T.StructField("source", T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("base", T.DoubleType()),
    ])),
    T.StructField("eventtime", T.LongType()),
    T.StructField("variation", T.DoubleType()),
    T.StructField("isanomaly", T.DoubleType()),
])

DEVICE_EVENT = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("eventtime", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("base", T.DoubleType()),
])

READING = T.StructType([
    T.StructField("device_id", T.IntegerType()),
    T.StructField("eventtime", T.LongType()),
    T.StructField("value", T.IntegerType()),
    T.StructField("distance", T.FloatType()),
])

MODEL = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("model", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("s", T.LongType()),
    T.StructField("ss", T.DecimalType(28, 0)),
    T.StructField("centroid", T.DoubleType()),
    T.StructField("radius", T.DoubleType()),
    T.StructField("trained_at", T.LongType()),
])

TRAINING_ROW = T.StructType([
    T.StructField("device_id", T.IntegerType()),
    T.StructField("value", T.IntegerType()),
    T.StructField("eventtime", T.LongType()),
    T.StructField("timestamp", T.DoubleType()),
])

LOADED_ROW = T.StructType([
    T.StructField("device_id", T.IntegerType()),
    T.StructField("value", T.IntegerType()),
    T.StructField("eventtime", T.LongType()),
    T.StructField("collected_at", T.TimestampType()),
    T.StructField("loaded_at", T.TimestampType()),
    T.StructField("chunk", T.IntegerType()),
])

LINE = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("line", T.StringType()),
])

REJECT = T.StructType([
    T.StructField("data", T.BinaryType()),
    T.StructField("reason", T.StringType()),
])

LATEST_READING = T.StructType([
    T.StructField("device_id", T.IntegerType()),
    T.StructField("eventtime", T.LongType()),
    T.StructField("value", T.IntegerType()),
])

LATE_ROW = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("eventtime", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("window_start", T.LongType()),
    T.StructField("watermark", T.LongType()),
])

PROGRESS = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("batch", T.LongType()),
    T.StructField("messages", T.LongType()),
    T.StructField("events", T.LongType()),
    T.StructField("rejects", T.LongType()),
    T.StructField("late", T.LongType()),
    T.StructField("last_eventtime", T.LongType()),
])

TRIGGER = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("eventtime", T.LongType()),
])

PANE_ROW = T.StructType([
    *TRIGGER.fields,
    T.StructField("firing", T.StringType()),
    T.StructField("window_start", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("watermark", T.LongType()),
])

ALERT_RECORD = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("eventtime", T.LongType()),
    T.StructField("notified_at", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("base", T.DoubleType()),
    T.StructField("distance", T.DoubleType()),
])
