"""As-of operators on a key's time axis: neighbours, linear interpolation, nearest event, gaps.

Samples and probes are put together and sorted once per key; no range join. Ties of a probe and a sample
count as an exact hit. Null samples are left out beforehand by the caller or by the function's docstring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def neighbours(probes: DataFrame, samples: DataFrame, keys: list[str], t: str, sample_t: str, carry: list[str]) -> DataFrame:
    """Probes with before and after: the last sample at or before, the first at or after, as structs of t and the carried columns; null where there is none."""
    struct = F.struct(F.col(sample_t).cast("double").alias("t"), *(F.col(c).alias(c) for c in carry))
    kinds = samples.select(struct.alias("s")).schema["s"].dataType
    left = samples.filter(F.col(sample_t).isNotNull()).select(*keys, F.col(sample_t).cast("double").alias("_t"), struct.alias("_s"), F.lit(None).cast(probes.select(F.struct("*").alias("p")).schema["p"].dataType).alias("_p"))
    right = probes.select(*keys, F.col(t).cast("double").alias("_t"), F.lit(None).cast(kinds).alias("_s"), F.struct("*").alias("_p"))
    both = left.unionByName(right)
    probe = F.col("_p").isNotNull()
    ahead = Window.partitionBy(*keys).orderBy("_t", probe).rowsBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy(*keys).orderBy(F.desc("_t"), probe).rowsBetween(Window.unboundedPreceding, 0)
    marked = both.withColumn("before", F.last("_s", ignorenulls=True).over(ahead)).withColumn("after", F.last("_s", ignorenulls=True).over(behind))
    return marked.filter(probe).select("_p.*", "before", "after")


def lerp(t: Column, value: str) -> Column:
    """Linear interpolation between before and after, held constant beyond the ends, null without samples."""
    b, a = F.col("before"), F.col("after")
    between = b[value] + (a[value] - b[value]) * (t - b["t"]) / (a["t"] - b["t"])
    return F.when(b.isNull(), a[value]).when(a.isNull(), b[value]).when(a["t"] == b["t"], a[value]).otherwise(between)


def interpolate(probes: DataFrame, samples: DataFrame, keys: list[str], t: str, sample_t: str, values: list[str]) -> DataFrame:
    """Probes with values interpolated from samples."""
    found = neighbours(probes, samples, keys, t, sample_t, values)
    return found.select("*", *(lerp(F.col(t).cast("double"), v).alias(v) for v in values)).drop("before", "after")


def interpolate_measured(probes: DataFrame, samples: DataFrame, keys: list[str], t: str, sample_t: str, value: str) -> DataFrame:
    """The same from the samples that have a finite value; null where a key has none."""
    finite = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & (F.abs(F.col(value)) < float("inf"))
    return interpolate(probes, samples.filter(finite), keys, t, sample_t, [value])


def distance(t: Column) -> Column:
    """To the nearest sample."""
    return F.least(F.abs(t - F.col("before.t")), F.abs(F.col("after.t") - t))


def nearest(probes: DataFrame, samples: DataFrame, keys: list[str], t: str, sample_t: str, out: str = "nearest") -> DataFrame:
    """Time of the nearest sample; of two equally near the later; null if the key has none."""
    found = neighbours(probes, samples, keys, t, sample_t, [])
    x = F.col(t).cast("double")
    pick = F.when(F.col("before").isNull(), F.col("after.t")).when(F.col("after").isNull(), F.col("before.t")).when(F.col("after.t") - x <= x - F.col("before.t"), F.col("after.t")).otherwise(F.col("before.t"))
    return found.withColumn(out, pick).drop("before", "after")


def fill_missing(df: DataFrame, keys: list[str], index: str, value: str, out: str) -> DataFrame:
    """Null values interpolated linearly over index, the ends held."""
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(index).cast("double").alias("t"), F.col(value).cast("double").alias(value)))
    ahead = Window.partitionBy(*keys).orderBy(index).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*keys).orderBy(index).rowsBetween(0, Window.unboundedFollowing)
    marked = df.withColumn("before", F.last(known, ignorenulls=True).over(ahead)).withColumn("after", F.first(known, ignorenulls=True).over(after))
    return marked.withColumn(out, lerp(F.col(index).cast("double"), value)).drop("before", "after")


def with_gaps(samples: DataFrame, keys: list[str], t: str) -> DataFrame:
    """Samples with gap: the time to the next."""
    return samples.withColumn("gap", F.lead(t).over(Window.partitionBy(*keys).orderBy(t)) - F.col(t))
