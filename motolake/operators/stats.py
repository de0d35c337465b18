"""Statistics: percentiles, renormalised means, weighted medians, two-pass checks, histograms of labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motolake.settings import PERCENTILES


def first_on_ties(df: DataFrame, keys: list[str], label: str, ordinal: str, out: str) -> DataFrame:
    """The most frequent label of each key, the one seen first of equally frequent ones; nulls don't count."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_n"), F.min(ordinal).alias("_first"))
    return counts.groupBy(*keys).agg(F.max_by(label, F.struct("_n", -F.col("_first"))).alias(out))


def exact_mean(column: str) -> Column:
    """Mean of doubles by their decimal digits (18 after the point): the same in every order of the rows, so a mean of just a threshold stays there. Where a value is 1e9 or more, infinite or NaN, the plain mean."""
    x = F.col(column).cast("double")
    small = F.abs(x) < 1e9
    plain = F.coalesce(F.bool_and(small), F.lit(True))
    return F.when(plain, F.avg(F.when(small, x).cast("decimal(38,18)")).cast("double")).otherwise(F.avg(x))


def renormalised(components: dict[str, float], scale: tuple[float, float] = (0.0, 1.0)) -> Column:
    """Weighted mean over the components that are known, put on a scale; null if none is."""
    total = sum((F.when(F.col(c).isNotNull(), w * F.col(c)).otherwise(0.0) for c, w in components.items()), F.lit(0.0))
    weight = sum((F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(0.0) for c, w in components.items()), F.lit(0.0))
    return F.when(weight > 0, scale[0] + (scale[1] - scale[0]) * F.try_divide(total, weight))


def beside(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One-row tables put beside each other, or each row of the first beside the single rows of the others."""
    out = first.withColumn("_one", F.lit(1))
    for other in others:
        out = out.join(F.broadcast(other.withColumn("_one", F.lit(1))), "_one")
    return out.drop("_one")


def weighted_median(df: DataFrame, keys: list[str], value: str, weight: str, out: str) -> DataFrame:
    """The first value, in order, at which the weights so far reach half of all; rows without weight don't count."""
    rows = df.filter((F.col(weight) > 0) & F.col(value).isNotNull())
    w = Window.partitionBy(*keys).orderBy(value).rangeBetween(Window.unboundedPreceding, 0)
    marked = rows.withColumn("_sum", F.sum(weight).over(w)).withColumn("_all", F.sum(weight).over(Window.partitionBy(*keys)))
    return marked.filter(F.col("_sum") >= F.col("_all") / 2).groupBy(*keys).agg(F.min(value).alias(out))


def field_stats(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Per dimension of a vector column: nine percentiles, mean and population deviation."""
    values = df.select(*keys, F.posexplode(vector).alias("dim", "x")).withColumn("x", F.col("x").cast("double"))
    out = values.groupBy(*keys, "dim").agg(F.percentile("x", F.array(*(F.lit(p) for p in PERCENTILES))).alias("p"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))
    names = [f"p{round(100 * p):02d}" for p in PERCENTILES]
    return out.select(*keys, "dim", *(F.col("p")[i].alias(n) for i, n in enumerate(names)), "mean", "std")


def normalised(x: Column, low: Column, high: Column) -> Column:
    """Into [-1, 1] between two percentiles; a span of nothing counts as 1."""
    span = F.when(high - low < 1e-8, F.lit(1.0)).otherwise(high - low)
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 2 * (x - low) / span - 1))


def denormalised(x: Column, low: Column, high: Column) -> Column:
    span = F.when(high - low < 1e-8, F.lit(1.0)).otherwise(high - low)
    return (x + 1) / 2 * span + low


def round_trip_errors(df: DataFrame, x: str, low: str, high: str, atol: float) -> DataFrame:
    """Values inside the percentiles that don't come back within atol."""
    back = denormalised(normalised(F.col(x), F.col(low), F.col(high)), F.col(low), F.col(high))
    inside = F.col(x).between(F.col(low), F.col(high))
    return df.withColumn("error", F.abs(back - F.col(x))).filter(inside & ((F.col("error") > atol) | F.isnan("error")))


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """Largest over smallest class; null with fewer than two classes."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).count().filter("count > 0")
    return counts.agg(F.when(F.count("*") >= 2, F.max("count") / F.min("count")).alias("ratio"), F.count("*").alias("classes"))


def affine_fit(df: DataFrame, keys: list[str], y: str, x: str) -> DataFrame:
    """Least-squares scale and shift."""
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("scale"), F.regr_intercept(y, x).alias("shift"), F.regr_count(y, x).alias("n"))


def cost_rollup(df: DataFrame, keys: list[str], cost: str, seconds: str) -> DataFrame:
    """Total and mean cost, and cost per hour where there is any time."""
    hours = F.sum(seconds) / 3600
    return df.groupBy(*keys).agg(F.sum(cost).alias("total"), F.avg(cost).alias("mean"), F.when(hours > 0, F.sum(cost) / hours).alias("per_hour"))
