"""Ordered operators per key: runs, hysteresis, dwell, short runs, sessions, folds.

keys partition, order is a total order inside a key. Every function plans one exchange on the keys at
most; functions that take the same keys and order share it and its sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def over(keys: list[str], order: list[str | Column]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def rows(keys: list[str], order: list[str | Column], start: int, end: int) -> WindowSpec:
    return over(keys, order).rowsBetween(start, end)


def upto(keys: list[str], order: list[str | Column], last: int = 0) -> WindowSpec:
    return over(keys, order).rowsBetween(Window.unboundedPreceding, last)


def run_id(df: DataFrame, keys: list[str], order: list[str], label: str, out: str = "run") -> DataFrame:
    """Number of the run of equal labels, from 1; nulls form runs of their own."""
    before = F.lag(label).over(over(keys, order))
    first = F.row_number().over(over(keys, order)) == 1
    change = F.when(first | ~F.col(label).eqNullSafe(before), 1).otherwise(0)
    return df.withColumn("_change", change).withColumn(out, F.sum("_change").over(upto(keys, order))).drop("_change")


def runs(df: DataFrame, keys: list[str], order: list[str], label: str, aggregates: list[Column] = ()) -> DataFrame:
    """A row per run: keys, run, label, n and further aggregates."""
    return run_id(df, keys, order, label).groupBy(*keys, "run").agg(F.first(label).alias(label), F.count(F.lit(1)).alias("n"), *aggregates)


def hysteresis(df: DataFrame, keys: list[str], order: list[str], value: str, high: float, low: float, out: str = "on") -> DataFrame:
    """On from the first value of at least high until one under low; a null value is off and leaves the state as it was."""
    if low > high:
        raise ValueError("low must not exceed high")
    decision = F.when(F.col(value) >= high, True).when(F.col(value) < low, False)
    state = F.coalesce(F.last(decision, ignorenulls=True).over(upto(keys, order)), F.lit(False))
    return df.withColumn(out, F.col(value).isNotNull() & state)


def min_duration(df: DataFrame, keys: list[str], order: list[str], flag: str, least: int, out: str) -> DataFrame:
    """True runs shorter than least become false; a null flag is false."""
    known = df.withColumn("_flag", F.coalesce(F.col(flag), F.lit(False)))
    known = run_id(known, keys, order, "_flag", "_run")
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys, "_run"))
    return known.withColumn(out, F.col("_flag") & (size >= least)).drop("_flag", "_run")


def _relabel(df: DataFrame, keys: list[str], order: list[str], label: str, out: str, decide) -> DataFrame:
    marked = run_id(df, keys, order, label, "_run")
    by_run = marked.groupBy(*keys, "_run").agg(F.first(label).alias("_label"), F.count(F.lit(1)).alias("_n"))
    decided = decide(by_run, over(keys, ["_run"]), upto(keys, ["_run"]))
    return marked.join(decided.select(*keys, "_run", F.col("_new").alias(out)), [*keys, "_run"]).drop("_run")


def dwell(df: DataFrame, keys: list[str], order: list[str], label: str, least: int, out: str = "state") -> DataFrame:
    """Runs shorter than least that stand between two others take the label before them, as long as that changes anything."""

    def decide(by_run: DataFrame, w: WindowSpec, so_far: WindowSpec) -> DataFrame:
        edge = F.lag("_run").over(w).isNull() | F.lead("_run").over(w).isNull()
        kept = F.when(edge | (F.col("_n") >= least), F.struct("_label"))
        return by_run.withColumn("_kept", kept).withColumn("_new", F.last("_kept", ignorenulls=True).over(so_far)["_label"])

    return _relabel(df, keys, order, label, out, decide)


def fill_short_runs(df: DataFrame, keys: list[str], order: list[str], label: str, least: int, out: str = "label", only: str = "idle") -> DataFrame:
    """Runs shorter than least take the label on their left; before the first long run that is the second run's, or only if there is just one."""

    def decide(by_run: DataFrame, w: WindowSpec, so_far: WindowSpec) -> DataFrame:
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        second = F.coalesce(F.nth_value("_label", 2).over(whole), F.lit(only))
        long = F.last(F.when(F.col("_n") >= least, F.col("_label")), ignorenulls=True).over(so_far)
        return by_run.withColumn("_new", F.coalesce(long, second))

    return _relabel(df, keys, order, label, out, decide)


def fill_gaps(runs_: DataFrame, keys: list[str], label: str, least: int) -> DataFrame:
    """Runs (keys, run, label, n) with short runs between two of one label merged into them, from left to right.

    A run made by a merge is no gap any more, so the result depends on the order: a fold with a stack
    over the array of a key's runs. Returns keys, run (new number), label, n.
    """
    item = F.array_sort(F.collect_list(F.struct(F.col("run").alias("r"), F.col(label).alias("x"), F.col("n").cast("long").alias("n"))))
    empty = F.array().cast("array<struct<x:string,n:bigint,o:boolean>>")

    def step(stack: Column, e: Column) -> Column:
        top, under = F.try_element_at(stack, F.lit(-1)), F.try_element_at(stack, F.lit(-2))
        closes = (F.size(stack) >= 2) & top["o"] & (top["n"] < least) & (under["x"] == e["x"])
        merged = F.struct(e["x"].alias("x"), (under["n"] + top["n"] + e["n"]).alias("n"), F.lit(False).alias("o"))
        pushed = F.struct(e["x"].alias("x"), e["n"].alias("n"), F.lit(True).alias("o"))
        return F.when(closes, F.concat(F.slice(stack, 1, F.greatest(F.size(stack) - 2, F.lit(0))), F.array(merged))).otherwise(F.concat(stack, F.array(pushed)))

    folded = runs_.groupBy(*keys).agg(F.aggregate(item, empty, step).alias("stack"))
    return folded.select(*keys, F.posexplode("stack").alias("run", "e")).select(*keys, (F.col("run") + 1).alias("run"), F.col("e.x").alias(label), F.col("e.n").alias("n"))


def sessions(segments: DataFrame, keys: list[str], order: list[str], is_gap: Column, out: str = "group") -> DataFrame:
    """Segments without the separating ones, numbered from 0 by the group between separators; groups without segments get no number."""
    marked = segments.withColumn("_gap", F.coalesce(is_gap, F.lit(False)))
    marked = marked.withColumn("_cut", F.sum(F.col("_gap").cast("int")).over(upto(keys, order))).filter(~F.col("_gap"))
    return marked.withColumn(out, F.dense_rank().over(Window.partitionBy(*keys).orderBy("_cut")) - 1).drop("_gap", "_cut")


def edges(df: DataFrame, keys: list[str], order: list[str], state: str) -> DataFrame:
    """onset and release of a boolean state that only advances on rows where it is known; before the first it was false."""
    before = F.coalesce(F.last(state, ignorenulls=True).over(upto(keys, order, -1)), F.lit(False))
    now = F.col(state)
    return df.withColumn("_before", before).withColumn("onset", F.coalesce(now & ~F.col("_before"), F.lit(False))).withColumn("release", F.coalesce(~now & F.col("_before"), F.lit(False))).drop("_before")


def segments(df: DataFrame, keys: list[str], frame: str, label: str, t: str, confidence: str | None = None) -> DataFrame:
    """Runs of a per-frame label: phase, start and end frame and second, frames, mean confidence."""
    more = [F.min(frame).alias("start_frame"), F.max(frame).alias("end_frame"), F.round(F.min(t), 4).alias("start_sec"), F.round(F.max(t), 4).alias("end_sec")]
    if confidence:
        more.append(F.avg(confidence).alias("mean_confidence"))
    return runs(df, keys, [frame], label, more).withColumnRenamed("n", "duration_frames").withColumnRenamed(label, "phase")


def gap_merge(segs: DataFrame, keys: list[str], label: str, start: str, end: str, most: int, out: str = "part") -> DataFrame:
    """Neighbouring segments of one label that at most most frames part, merged."""
    w = over(keys, [start])
    new = F.coalesce((F.lag(label).over(w) != F.col(label)) | (F.col(start) - F.lag(end).over(w) > most), F.lit(True))
    marked = segs.withColumn("_new", new.cast("int")).withColumn(out, F.sum("_new").over(upto(keys, [start])))
    return marked.groupBy(*keys, out).agg(F.first(label).alias(label), F.min(start).alias(start), F.max(end).alias(end))


def ordered_fold(df: DataFrame, keys: list[str], order: list[str], columns: list[str], zero: Column, step, finish=None, out: str = "folded") -> DataFrame:
    """Left fold over a key's rows in order, for results that depend on earlier results."""
    item = F.array_sort(F.collect_list(F.struct(*dict.fromkeys([*order, *columns]))))
    args = (item, zero, step) if finish is None else (item, zero, step, finish)
    return df.groupBy(*keys).agg(F.aggregate(*args).alias(out))


def flicker_count(df: DataFrame, keys: list[str], order: list[str], label: str) -> DataFrame:
    """Rows that differ from the one before and the one after."""
    w = over(keys, order)
    lone = (F.col(label) != F.lag(label).over(w)) & (F.col(label) != F.lead(label).over(w))
    return df.withColumn("_lone", F.coalesce(lone, F.lit(False)).cast("int")).groupBy(*keys).agg(F.sum("_lone").alias("flickers"))
