"""Schemas of the raw tables and messages, and column selection from a schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fabspark import constants as K

# Names that are not sensors in a raw table.
NOT_SENSORS = {"Time", "Target", "Pass/Fail"}


def sensor_names(n: int = K.SENSOR_COUNT) -> list[str]:
    return [str(i) for i in range(n)]


def raw_schema(sensors: Sequence[str]) -> T.StructType:
    """Raw readings: time, one double per sensor, label."""
    return T.StructType(
        [T.StructField("Time", T.TimestampNTZType())]
        + [T.StructField(s, T.DoubleType()) for s in sensors]
        + [T.StructField("Pass/Fail", T.LongType())])


def landing_schema(sensors: Sequence[str]) -> T.StructType:
    """A batch file; the line and the generation day are path keys."""
    return T.StructType(raw_schema(sensors).fields + [
        T.StructField("tester_id", T.StringType()),
        T.StructField("shift", T.StringType()),
        T.StructField("lot_id", T.StringType()),
        T.StructField("is_synthetic", T.BooleanType()),
        T.StructField("generation_timestamp", T.TimestampType()),
        T.StructField("applied_drift_features", T.StringType()),
        T.StructField("line_id", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("day", T.StringType()),
    ])


EVENT_MESSAGE = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("batch_size", T.LongType()),
    T.StructField("line_id", T.StringType()),
    T.StructField("tester_id", T.StringType()),
    T.StructField("shift", T.StringType()),
    T.StructField("lot_id", T.StringType()),
    T.StructField("is_synthetic", T.BooleanType()),
    T.StructField("generation_timestamp", T.StringType()),
    T.StructField("applied_drift_features", T.MapType(T.StringType(), T.DoubleType())),
])

EVENT_LOG = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("line_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
])


def sensor_columns(df: DataFrame, other: Sequence[str] = ()) -> list[str]:
    """Numeric columns that hold readings: all but time, label and the ``other`` ones named (keys, counters)."""
    drop = NOT_SENSORS | set(other)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in drop]


def shared_sensors(a: DataFrame, b: DataFrame, other: Sequence[str] = ()) -> list[str]:
    """Sensor columns of ``a`` that ``b`` has too, in ``a``'s order."""
    there = set(sensor_columns(b, other))
    return [c for c in sensor_columns(a, other) if c in there]
