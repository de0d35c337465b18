"""Streaming forms of ordered operators. Each gives on a finished stream what its batch form gives.

Lateness: a watermark of the grace that the caller names; rows later than
it are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motolake.operators.stats import exact_mean
from motolake.settings import DEFAULT, Settings


def tumbling(df: DataFrame, ts: str, keys: list[str], value: str, width: str = "1 second", late: str = "10 seconds") -> DataFrame:
    """Mean and number per window and key."""
    w = F.window(ts, width)
    return df.withWatermark(ts, late).groupBy(w, *keys).agg(exact_mean(value).alias("mean"), F.count(F.lit(1)).alias("n")).select(*keys, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "mean", "n")


def low_windows(df: DataFrame, ts: str, keys: list[str], value: str, s: Settings = DEFAULT, late: str = "10 seconds") -> DataFrame:
    return tumbling(df, ts, keys, value, f"{s.mistake_window_s} seconds", late).filter(F.col("mean") < s.mistake_floor)


def sessions(df: DataFrame, ts: str, keys: list[str], gap: str = "8 seconds", late: str = "10 seconds") -> DataFrame:
    """Spans of activity that a gap ends."""
    w = F.session_window(ts, gap)
    return df.withWatermark(ts, late).groupBy(w, *keys).agg(F.count(F.lit(1)).alias("n")).select(*keys, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def stateful(df: DataFrame, keys: list[str], step, out_schema: str, state_schema: str) -> DataFrame:
    """step(key, rows of a batch in arrival order, state or None) gives (result, state) per key and micro-batch."""

    def run(key, batches: Iterator, state):
        import pandas as pd

        rows = pd.concat(list(batches))
        result, new = step(key, rows, state.get if state.exists else None)
        state.update(new)
        yield result

    return df.groupBy(*keys).applyInPandasWithState(run, out_schema, state_schema, "append", "NoTimeout")


def hysteresis(df: DataFrame, key: str, order: str, value: str, high: float, low: float) -> DataFrame:
    """On and off by two thresholds, the state kept between micro-batches. Rows of a key must arrive in order over batches."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def step(k, rows, state):
        rows = rows.sort_values(order)
        on, out = bool(state[0]) if state else False, []
        for v in rows[value]:
            if v is None or v != v:
                out.append(False)
                continue
            on = v >= low if on else v >= high
            out.append(on)
        return rows[[key, order, value]].assign(on=out), (on,)

    return stateful(df, [key], step, f"{key} {kinds[key]}, {order} {kinds[order]}, {value} {kinds[value]}, on boolean", "on boolean")


def regions(df: DataFrame, key: str, order: str, seen: str, s: Settings = DEFAULT) -> DataFrame:
    """Whether a region is still covered, by the last place it was seen, kept between micro-batches and forgotten after the grace."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def step(k, rows, state):
        rows = rows.sort_values(order)
        last, out = state[0] if state else None, []
        for at, hit in zip(rows[order], rows[seen], strict=True):
            last = int(at) if hit else last
            out.append(last is not None and at - last <= s.ocr_grace)
        if last is not None and rows[order].iloc[-1] - last > s.ocr_grace:
            last = None
        return rows[[key, order]].assign(active=out), (last,)

    return stateful(df, [key], step, f"{key} {kinds[key]}, {order} {kinds[order]}, active boolean", "last bigint")


def gaps(df: DataFrame, key: str, t: str, late_s: float = 0.2) -> DataFrame:
    """Rows that come more than late_s after the one before, the last time kept between micro-batches."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def step(k, rows, state):
        rows = rows.sort_values(t)
        before = rows[t].shift()
        if state and len(rows):
            before.iloc[0] = state[0]
        return rows[[key, t]].assign(gap=rows[t] - before)[lambda x: x["gap"] > late_s], (float(rows[t].iloc[-1]),)

    return stateful(df, [key], step, f"{key} {kinds[key]}, {t} {kinds[t]}, gap double", "last double")
