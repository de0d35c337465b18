"""Writing: tables by key, canonical episodes, gated deliveries, small documents."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motolake.functions.strings import safe_prefix, sorted_json
from motolake.operators.package import refusals
from motolake.settings import DEFAULT, Settings


def clean_key(key: str) -> str:
    """A relative key; absolute ones and those that climb are refused."""
    if key.startswith("/") or ".." in key.split("/"):
        raise ValueError(f"bad key {key!r}")
    return "/".join(p for p in key.split("/") if p not in ("", "."))


def write_partitions(df: DataFrame, path: str, keys: list[str]) -> None:
    """Replace the partitions that df has, leave the others: writing again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*keys).parquet(path)


def write_episodes(frames: DataFrame, path: str) -> None:
    """Canonical frames, by episode and version, with maps of text as JSON with sorted keys beside them."""
    extra = [c for c in ("confidence", "provenance") if c in frames.columns]
    write_partitions(frames.select("*", *(sorted_json(F.col(c)).alias(f"{c}_json") for c in extra)), path, ["episode_id", "version"])


def read_episodes(spark: SparkSession, path: str, episode_id: str | None = None, version: int | None = None) -> DataFrame:
    """Both filters prune directories."""
    df = spark.read.parquet(path)
    if episode_id is not None:
        df = df.filter(F.col("episode_id") == episode_id)
    return df.filter(F.col("version") == version) if version is not None else df


def merge_metadata(left: DataFrame, right: DataFrame, key: str, col: str) -> DataFrame:
    """Maps by key put together, the right one's entries winning."""
    r = right.select(key, F.col(col).alias("_new"))
    kept = F.map_filter(col, lambda k, v: ~F.array_contains(F.coalesce(F.map_keys("_new"), F.array().cast("array<string>")), k))
    return left.join(r, key, "left").withColumn(col, F.when(F.col("_new").isNull(), F.col(col)).otherwise(F.map_concat(F.coalesce(kept, F.create_map().cast(left.schema[col].dataType)), "_new"))).drop("_new")


def measured_columns(df: DataFrame, optional: list[str]) -> DataFrame:
    """Without the optional columns that have no value at all."""
    counts = df.agg(*(F.count(c).alias(c) for c in optional)).first()
    return df.drop(*(c for c in optional if not counts[c]))


class DeliveryRefused(RuntimeError):
    pass


def deliver(rows: DataFrame, episodes: DataFrame, path: str, ledger: str, customer: str, name: str, s: Settings = DEFAULT) -> int:
    """Write rows of episodes and a line in the ledger, after every episode has passed the gates; otherwise nothing is written."""
    refused = refusals(episodes, s).select("episode_id", "reason").limit(20).collect()
    if refused:
        raise DeliveryRefused("; ".join(f"{r['episode_id']}: {r['reason']}" for r in refused))
    rows.join(episodes.select("episode_id"), "episode_id", "left_semi").write.mode("errorifexists").parquet(path)
    n = episodes.count()
    spark = rows.sparkSession
    spark.createDataFrame([(customer, name, path, n)], "customer string, name string, uri string, episodes long").withColumn("delivered_at", F.current_timestamp()).write.mode("append").parquet(ledger)
    return n


def upsert(existing: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    return existing.join(changes.select(*keys), keys, "left_anti").unionByName(changes)


def depth_refs(depth: DataFrame, keys: list[str], frame: str) -> DataFrame:
    """Place of each frame's raster in its chunk file; it is an error if a key's rasters differ in shape."""
    from pyspark.sql import Window

    shapes = depth.groupBy(*keys).agg(F.count_distinct("height", "width").alias("_shapes"))
    checked = depth.join(shapes, keys).withColumn("_ok", F.when(F.col("_shapes") > 1, F.raise_error(F.lit("rasters differ in shape"))).otherwise(F.lit(None).cast("string")))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(frame)) - 1
    return checked.withColumn("chunk_index", F.when(F.col("_ok").isNull(), place)).drop("_shapes", "_ok")


def to_document(df: DataFrame) -> str:
    """A small result as JSON."""
    return json.dumps([json.loads(x) for x in df.toJSON().collect()], sort_keys=True)


__all__ = ["DeliveryRefused", "clean_key", "deliver", "depth_refs", "measured_columns", "merge_metadata", "read_episodes", "safe_prefix", "to_document", "upsert", "write_episodes", "write_partitions"]
