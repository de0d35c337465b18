"""Inertial streams from JSON and CSV with many spellings of their columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings of the columns, the first that is there counts.
TIME_ALIASES = (("timestamp_ns", 1.0), ("time_ns", 1.0), ("timestamp_us", 1e3), ("timestamp_ms", 1e6), ("epoch_ms", 1e6), ("timestamp", 1e9), ("timestamp_s", 1e9), ("t", 1e9))
VECTOR_ALIASES = {"gyro": ("gyro", "gyroscope", "angular_velocity"), "accel": ("accel", "accelerometer", "acceleration"), "mag": ("mag", "magnetometer", "magnetic_field")}
SCALAR_ALIASES = {"temp_c": ("temp_c", "temperature_c", "temperature", "temp"), "frame": ("nearest_video_frame", "frame_idx", "frame")}
WRAPPERS = ("samples", "imu", "records", "data")


def number(value: Column) -> Column:
    """A finite number or null."""
    x = value.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def timestamp_ns(record: Column) -> Column:
    """Of a variant of text by name (a map), by the first spelling that holds a number."""
    return F.coalesce(*(number(record[name]) * factor for name, factor in TIME_ALIASES)).cast("long")


def vector(record: Column, names: tuple[str, ...]) -> Column:
    """Three numbers from an array, an object with x, y, z, or columns like gyro_x, gyro.x, gyroX; null if one is missing."""
    found = []
    for name in names:
        text = record[name]
        listed = F.from_json(text, "array<double>")
        item = F.from_json(text, "struct<x:double,y:double,z:double>")
        found.append(F.when(F.size(listed) >= 3, F.slice(listed, 1, 3)))
        found.append(F.when(item.isNotNull() & item["x"].isNotNull() & item["y"].isNotNull() & item["z"].isNotNull(), F.array(item["x"], item["y"], item["z"])))
        for spelling in ("{}_{}", "{}.{}"):
            parts = [number(record[spelling.format(name, a)]) for a in "xyz"]
            found.append(F.when(parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull(), F.array(*parts)))
        parts = [number(record[f"{name}{a}"]) for a in "XYZ"]
        found.append(F.when(parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull(), F.array(*parts)))
    return F.coalesce(*found)


def columnar(records: DataFrame, record: str, keys: list[str] = ()) -> DataFrame:
    """keys, timestamp_ns, gyro, accel, mag, temp_c, frame from records as maps of text; those without a gyro reading are left out.

    An accelerometer axis that isn't there is 0; mag, temperature and frame stay unknown.
    """
    r = F.col(record)
    out = records.select(*keys, timestamp_ns(r).alias("timestamp_ns"), *(vector(r, names).alias(c) for c, names in VECTOR_ALIASES.items()), *(F.coalesce(*(number(r[n]) for n in names)).alias(c) for c, names in SCALAR_ALIASES.items()))
    return out.filter("gyro is not null").withColumn("accel", F.coalesce("accel", F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0))))


def read_json(spark: SparkSession, path: str, source: str = "source") -> DataFrame:
    """source, record: the objects of a list, or of the list an object wraps; files are read whole."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias(source), F.col("value"))
    as_list = F.from_json("value", "array<map<string,string>>")
    wrapped = F.coalesce(*(F.from_json(F.get_json_object("value", f"$.{w}"), "array<map<string,string>>") for w in WRAPPERS))
    records = F.when(F.trim("value").startswith("["), as_list).otherwise(wrapped)
    return text.select(source, F.explode(records).alias("record")).filter("record is not null")


def read_csv(spark: SparkSession, path: str, source: str = "source") -> DataFrame:
    """source, record as a map of text."""
    rows = spark.read.csv(path, header=True)
    names = rows.columns
    pairs = F.map_from_arrays(F.array(*(F.lit(n) for n in names)), F.array(*(F.col(f"`{n}`") for n in names)))
    return rows.select(F.input_file_name().alias(source), pairs.alias("record"))


def ambiguous(files: DataFrame, key: str) -> DataFrame:
    """Keys with more than one stream file, with all their names."""
    return files.groupBy(key).agg(F.array_sort(F.collect_list("path")).alias("paths")).filter(F.size("paths") > 1)
