"""Files of a session: listings, layouts, declared streams, video choice, cameras, raw arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motolake.functions.geometry import pinhole


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, length of files; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modificationTime")


def content_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("content_hash"))


def glob_regex(pattern: Column) -> Column:
    """A file pattern with * and ? as a regular expression."""
    quoted = F.regexp_replace(pattern, r"([.+^$(){}|\[\]\\])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))


def stream_problems(files: DataFrame, streams: DataFrame, key: str) -> DataFrame:
    """Declared streams of a key that are missing (if required) or ambiguous, and sensor files that nothing declares.

    files: key, name. streams: key, stream, pattern, required; one row per pattern.
    """
    matched = streams.join(files, key).filter(F.rlike("name", glob_regex(F.col("pattern")))).select(key, "stream", "name").distinct()
    counts = streams.select(key, "stream", "required").distinct().join(matched.groupBy(key, "stream").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("name")).alias("names")), [key, "stream"], "left")
    missing = counts.filter("required and n is null").select(key, F.lit("missing").alias("problem"), F.col("stream").alias("subject"))
    twice = counts.filter("n > 1").select(key, F.lit("ambiguous").alias("problem"), F.col("stream").alias("subject"))
    patterns = F.broadcast(streams.select(F.col("pattern").alias("any_pattern")).distinct())
    sensors = files.join(patterns, F.rlike("name", glob_regex(F.col("any_pattern")))).select(key, "name").distinct()
    stray = sensors.join(matched.select(key, "name"), [key, "name"], "left_anti").select(key, F.lit("undeclared").alias("problem"), F.col("name").alias("subject"))
    return missing.unionByName(twice).unionByName(stray)


def layout(files: DataFrame, key: str, aspect: str) -> DataFrame:
    """Layout of a key by its files: stereo, multi_view, video_imu, video or unknown. aspect is the width over the height of its video."""
    video, sensor = F.lower("name").rlike(r"\.(mp4|mov|avi|mkv)$"), F.lower("name").rlike(r"imu.*\.(json|csv)$")
    out = files.groupBy(key).agg(F.count_if(video).alias("videos"), F.count_if(sensor).alias("sensors"), F.max(aspect).alias("_aspect"))
    return out.withColumn("layout", F.when((F.col("videos") == 1) & (F.col("_aspect") >= 1.9), "stereo").when(F.col("videos") > 1, "multi_view").when((F.col("videos") == 1) & (F.col("sensors") > 0), "video_imu").when(F.col("videos") == 1, "video").otherwise("unknown")).drop("_aspect")


def rig(layout_: Column) -> Column:
    return F.when(layout_ == "stereo", "stereo_head").when(layout_ == "multi_view", "multi_view").when(layout_.isin("video_imu", "video"), "head_mounted")


def preferred_video(files: DataFrame, key: str) -> DataFrame:
    """The redacted video of a key, else the compressed, else the raw, else the first by name."""
    rank = F.when(F.col("name") == "redacted_compressed.mp4", 0).when(F.col("name") == "compressed.mp4", 1).when(F.col("name") == "raw.mp4", 2).otherwise(3)
    return files.filter(F.lower("name").endswith(".mp4")).groupBy(key).agg(F.min_by("name", F.struct(rank, F.col("name"))).alias("video"))


def intrinsics(sessions: DataFrame, measured: DataFrame, key: str = "device_id") -> DataFrame:
    """Sessions with fx, fy, cx, cy and their source: measured for the device, or from the field of view. Measured ones that aren't finite and positive don't count."""
    sound = measured.filter((F.col("fx") > 0) & (F.col("fy") > 0) & (F.col("fx") < float("inf")) & (F.col("fy") < float("inf")))
    own = sound.select(key, *(F.col(c).alias(f"_{c}") for c in ("fx", "fy", "cx", "cy")))
    guess = pinhole(F.col("width"), F.col("height"))
    out = sessions.join(own, key, "left").withColumn("_guess", guess)
    return out.select(*sessions.columns, *(F.coalesce(f"_{c}", F.col(f"_guess.{c}")).alias(c) for c in ("fx", "fy", "cx", "cy")), F.when(F.col("_fx").isNotNull(), "measured").otherwise("field_of_view").alias("intrinsics_source"))


def fps_of(rate: Column) -> Column:
    """'30000/1001' or '30' as a number; null for a zero denominator."""
    parts = F.split(rate, "/")
    return F.try_divide(F.get(parts, 0).try_cast("double"), F.coalesce(F.get(parts, 1).try_cast("double"), F.lit(1.0)))


def claim_problems(claims: DataFrame) -> DataFrame:
    """Manifests whose size is off by more than a tenth or whose frames aren't as many as were perceived."""
    size = F.abs(F.col("claimed_bytes") - F.col("size_bytes")) > 0.1 * F.col("size_bytes")
    frames = F.col("claimed_frames") != F.col("perceived_frames")
    return claims.withColumn("problems", F.filter(F.array(F.when(size, F.lit("size")), F.when(frames, F.lit("frames"))), lambda x: x.isNotNull())).filter(F.size("problems") > 0)


def raw_cubes(spark: SparkSession, path: str, shape: tuple[int, int]) -> DataFrame:
    """path, frame_idx, values: frames of height x width float32 numbers of raw files; a file that holds no whole number of frames has one row of nulls."""
    size = 4 * shape[0] * shape[1]

    def run(batches):
        import numpy as np
        import pandas as pd

        for pdf in batches:
            rows = []
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                if not len(content) or len(content) % size:
                    rows.append((name, None, None))
                else:
                    cube = np.frombuffer(content, "<f4").reshape(-1, shape[0] * shape[1])
                    rows += [(name, i, frame.tolist()) for i, frame in enumerate(cube)]
            yield pd.DataFrame(rows, columns=["path", "frame_idx", "values"]).astype({"frame_idx": "Int32"})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, frame_idx int, values array<float>")


def read_hdf5(spark: SparkSession, path: str, datasets: list[str]) -> DataFrame:
    """path, dataset, row, values of numeric datasets of HDF5 files, if h5py is there to read them."""

    def run(batches):
        import io

        import h5py
        import numpy as np
        import pandas as pd

        for pdf in batches:
            rows = []
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                with h5py.File(io.BytesIO(content)) as f:
                    for d in datasets:
                        if d in f:
                            rows += [(name, d, i, np.atleast_1d(x).astype(float).tolist()) for i, x in enumerate(f[d][:])]
            yield pd.DataFrame(rows, columns=["path", "dataset", "row", "values"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, dataset string, row long, values array<double>")


def with_fallback(first: DataFrame, second: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of both by key, each column of the first where it is known, else of the second."""
    a = first.select(key, *(F.col(c).alias(f"_a_{c}") for c in columns))
    b = second.select(key, *(F.col(c).alias(f"_b_{c}") for c in columns))
    return a.join(b, key, "full").select(key, *(F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in columns))
