"""Checks over a whole batch: duplicates, splits, balance, diversity, nearest vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motolake.operators.windows import ordered_fold
from motolake.settings import DEFAULT, Settings


def similarity(a: Column, b: Column, bits: int = 64) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / bits


def greedy_duplicates(df: DataFrame, keys: list[str], item: str, ordinal: str, hash_col: str, s: Settings = DEFAULT) -> DataFrame:
    """keys, item, duplicate_of, similarity: each item, in order, is a duplicate of the most similar item kept so far if similar enough, the earliest of equals; else it is kept (null).

    The decision needs the decisions before it, so a key is a fold over its items; a key is a batch.
    """
    kind = df.schema[item].dataType.simpleString()
    zero = F.array().cast(f"array<struct<i:{kind},x:bigint,d:{kind},s:double>>")
    least = F.lit(s.duplicate_similarity)

    def step(state: Column, e: Column) -> Column:
        kept = F.filter(state, lambda k: k["d"].isNull())
        alike = F.filter(F.transform(kept, lambda k, n: F.struct((-similarity(k["x"], e[hash_col], s.hash_bits)).alias("s"), n.alias("n"), k["i"].alias("i"))), lambda k: -k["s"] >= least)
        best = F.array_min(alike)
        return F.concat(state, F.array(F.struct(e[item].alias("i"), e[hash_col].cast("long").alias("x"), best["i"].alias("d"), (-best["s"]).alias("s"))))

    folded = ordered_fold(df, keys, [ordinal], [item, hash_col], zero, step)
    return folded.select(*keys, F.explode("folded").alias("r")).select(*keys, F.col("r.i").alias(item), F.col("r.d").alias("duplicate_of"), F.col("r.s").alias("similarity"))


def greedy_duplicates_of_all(df: DataFrame, item: str, hash_col: str, s: Settings = DEFAULT, block: int = 65536) -> DataFrame:
    """df's rows with duplicate_of and similarity: greedy_duplicates over all rows as one batch, in the order of item, whole numbers.

    A copy of an earlier hash is never kept, and what is like a kept hash isn't either. So each round takes, of the first items
    of each hash, the first block ones in order that are unlike all kept before, and decides them on the driver; the kept
    hashes then meet all rows, 16 bytes each on driver and executors. Kept hashes differ in more than m bits (those alike in at
    most m), so they are at most 2^bits over the size of a ball of radius m / 2: 782,468 for 32 bits and 0.8. Rows of one item are in the order
    of their hash; rows without a hash are kept and like no other. A null item is the first.
    """
    most = max((d for d in range(s.hash_bits + 1) if 1 - d / s.hash_bits >= s.duplicate_similarity), default=-1)
    kind, bits, lowest = df.schema[item].dataType.simpleString(), s.hash_bits, -(1 << 63)
    order = F.coalesce(F.col(item).cast("long"), F.lit(lowest))
    context = df.sparkSession.sparkContext
    differing = lambda a, b: np.bitwise_count((a ^ b).view(np.uint64))
    items, hashes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def unlike(kept):
        @F.pandas_udf("boolean")
        def test(h: pd.Series) -> pd.Series:
            x, left = h.to_numpy(np.int64), np.arange(len(h))
            for k in range(0, len(kept.value), 512):
                left = left[(differing(x[left, None], kept.value[None, k : k + 512]) > most).all(1)]
            out = np.zeros(len(x), bool)
            out[left] = True
            return pd.Series(out)

        return test

    firsts = df.select(order.alias("o"), F.col(hash_col).cast("long").alias("x")).filter("x is not null").groupBy("x").agg(F.min("o").alias("o"))
    while True:
        rest = firsts.filter(unlike(context.broadcast(hashes))("x")) if len(hashes) else firsts
        rows = rest.orderBy("o", "x").limit(block).collect()
        new = np.zeros(len(rows), np.int64)
        at = []
        for i, r in enumerate(rows):
            if not len(at) or not (differing(new[: len(at)], np.int64(r["x"])) <= most).any():
                new[len(at)] = r["x"]
                at.append(i)
        items = np.concatenate([items, np.array([rows[i]["o"] for i in at], np.int64)])
        hashes = np.concatenate([hashes, new[: len(at)]])
        if len(rows) < block:
            break
    kept = context.broadcast((items, hashes))

    @F.pandas_udf("i long, d int")
    def best(o: pd.Series, h: pd.Series, n: pd.Series) -> pd.DataFrame:
        ids, x = kept.value
        o, h, n = o.to_numpy(np.int64), h.to_numpy(np.int64), n.to_numpy(np.int64)
        found, apart = np.zeros(len(o), np.int64), np.full(len(o), bits + 1)
        step = max(1, (1 << 21) // max(len(x), 1))
        for k in range(0, len(o), step) if len(x) else ():
            p, q = o[k : k + step, None], h[k : k + step, None]
            away = differing(q, x[None, :]).astype(np.int16)
            before = (ids[None, :] < p) | ((ids[None, :] == p) & ((x[None, :] < q) | ((x[None, :] == q) & (n[k : k + step, None] > 1))))
            away[~before | (away > most)] = bits + 1
            at = away.argmin(1)
            found[k : k + step], apart[k : k + step] = ids[at], away[np.arange(len(at)), at]
        return pd.DataFrame({"i": found, "d": apart.astype(np.int32)})

    # rows equal in item and hash come one after another
    out = df.withColumn("_n", F.row_number().over(Window.partitionBy(item, hash_col).orderBy(F.lit(0))))
    out = out.withColumn("_r", best(order, F.coalesce(F.col(hash_col).cast("long"), F.lit(0)), F.col("_n")))
    known = F.col(hash_col).isNotNull() & (F.col("_r.d") <= most)
    out = out.withColumn("duplicate_of", F.when(known, F.nullif(F.col("_r.i"), F.lit(lowest))).cast(kind))
    return out.withColumn("similarity", F.when(known, 1 - F.col("_r.d") / bits)).drop("_n", "_r")


def pairs_within(df: DataFrame, item: str, hash_col: str, most: int, bits: int = 64) -> DataFrame:
    """Pairs of items whose hashes differ in at most most bits, exactly: hashes are cut into most + 1 bands, of which a pair shares one."""
    bands = most + 1
    width = -(-bits // bands)
    parts = F.array(*(F.struct(F.lit(i).alias("band"), F.shiftrightunsigned(F.col(hash_col), i * width).bitwiseAND(F.lit((1 << min(width, bits - i * width)) - 1 if width < 64 else -1)).alias("bits")) for i in range(bands) if i * width < bits))
    banded = df.select(F.col(item).alias("a"), F.col(hash_col).alias("x"), F.explode(parts).alias("p")).select("a", "x", "p.*")
    other = banded.select(F.col("a").alias("b"), F.col("x").alias("y"), "band", "bits")
    near = banded.join(other, ["band", "bits"]).filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= most))
    return near.select("a", "b", F.bit_count(F.col("x").bitwiseXOR(F.col("y"))).alias("distance")).distinct()


def stratified_split(df: DataFrame, item: str, stratum: str, s: Settings = DEFAULT) -> DataFrame:
    """split of each item: per stratum, by item, at rounded (half to even) cumulated shares; the last takes the rest."""
    w = Window.partitionBy("_stratum")
    out = df.withColumn("_stratum", F.coalesce(F.col(stratum).cast("string"), F.lit("unknown")))
    out = out.withColumn("_place", F.row_number().over(w.orderBy(item))).withColumn("_n", F.count(F.lit(1)).over(w))
    split, total = F.lit(s.split[-1][0]), 0.0
    bounds = []
    for name, ratio in s.split[:-1]:
        total += ratio
        bounds.append((name, F.bround(F.lit(total) * F.col("_n"))))
    for name, bound in reversed(bounds):
        split = F.when(F.col("_place") <= bound, F.lit(name)).otherwise(split)
    return out.withColumn("split", split).drop("_stratum", "_place", "_n")


def diversity(df: DataFrame, label: str, worker: str) -> DataFrame:
    """Different labels and workers, sorted, without nulls."""
    return df.agg(F.array_sort(F.collect_set(label)).alias("classes"), F.array_sort(F.collect_set(worker)).alias("workers"), F.count_distinct(label).alias("n_classes"), F.count_distinct(worker).alias("n_workers"))


def object_counts(tracks: DataFrame, keys: list[str]) -> DataFrame:
    return tracks.select(*keys, F.explode("objects").alias("o")).filter("o.class_label is not null").groupBy(*keys, F.col("o.class_label").alias("class_label")).agg(F.count(F.lit(1)).alias("n"))


def content_groups(df: DataFrame, item: str, content: str) -> DataFrame:
    """Items by the hash of their content: hash, items, first item. Null content has no group."""
    return df.filter(F.col(content).isNotNull()).groupBy(F.sha2(F.col(content).cast("binary"), 256).alias("content_hash")).agg(F.count(F.lit(1)).alias("items"), F.min(item).alias("first_item"))


def cosine(a: Column, b: Column) -> Column:
    product = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(product(a, b), F.sqrt(product(a, a)) * F.sqrt(product(b, b)))


def nearest_vectors(df: DataFrame, item: str, vector: str, model: str | None = None, parts: int | None = None, block: int = 1024) -> DataFrame:
    """item, nearest, similarity: the other item of largest cosine (of the same model), the smaller id of equals.

    Exact, in blocks of rows: every part of the items (of some 4096, unless their number is given) meets every
    other one as a matrix product in a task that holds two parts; a window keeps the best of each item's candidates.
    """
    by = [model] if model else []
    parts = parts or max(1, -(-df.count() // 4096))
    rows = df.select(F.col(item).alias("i"), F.col(vector).cast("array<double>").alias("v"), *by).filter("v is not null")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("i"), F.lit(parts)).cast("int"))
    left = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = rows.withColumn("other", F.col("part")).drop("part").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def best(a, b):
        out: dict[str, list] = {"i": [], "j": [], "s": []}
        if len(a) and len(b):
            x, y = np.stack(a["v"].to_numpy()), np.stack(b["v"].to_numpy())
            x, y = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300) for m in (x, y))
            p, q = a["i"].to_numpy(), b["i"].to_numpy()
            order = np.argsort(q)
            y, q = y[order], q[order]
            for k in range(0, len(x), block):
                like = x[k : k + block] @ y.T
                like[p[k : k + block][:, None] == q[None, :]] = -np.inf
                at = like.argmax(1)
                top = like[np.arange(len(at)), at]
                known = np.isfinite(top)
                out["i"] += p[k : k + block][known].tolist()
                out["j"] += q[at][known].tolist()
                out["s"] += top[known].tolist()
        return pd.DataFrame({"i": pd.Series(out["i"], dtype=p.dtype if len(a) and len(b) else "int64"), "j": pd.Series(out["j"], dtype=p.dtype if len(a) and len(b) else "int64"), "s": pd.Series(out["s"], dtype="float64")})

    kind = df.schema[item].dataType.simpleString()
    keys = [*by, "part", "other"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(best, f"i {kind}, j {kind}, s double")
    place = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("s"), "j"))
    return found.withColumn("_p", place).filter("_p = 1").select(F.col("i").alias(item), F.col("j").alias("nearest"), F.col("s").alias("similarity"))


def batch_report(tasks: DataFrame, duplicates: DataFrame, splits: DataFrame, label: str) -> DataFrame:
    """One row: episodes, classes, largest over smallest class, duplicates, sizes of the splits as a map."""
    from motolake.operators.stats import beside, imbalance

    sizes = splits.groupBy("split").count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("split", "count")))).alias("splits"))
    copies = duplicates.agg(F.count("duplicate_of").alias("duplicates"))
    return beside(tasks.agg(F.count(F.lit(1)).alias("episodes")), imbalance(tasks, label), copies, sizes)
