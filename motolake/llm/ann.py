"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

Equal vectors become one point with its smallest ids, as many as a result can hold, so a vector that a
third of all rows repeat is one point. Points of a length go to shards of at most ``shard_points`` (or ``shard_values`` components) on average by a hash. A shard
adds a coordinate that puts its points on a sphere, on which the largest inner product is the nearest
point; draws a level for each point; and links each point on each level to near points in different
directions, chosen among its ``candidates`` nearest ones of the level, and to points that chose it. A
shard is one row of flat arrays: vectors, neighbour lists of each level, members. A search descends from
the top level and keeps the best ``ef`` points of a block of queries on the lowest one. Graphs hold vectors scaled to their shard's largest
component, in single precision; inner products of what a search finds are taken in double precision on the original vectors. Every query meets every
shard of its length, in blocks of bounded size; a query's rows of all shards are merged by a window that keeps ``k``
of them before the shuffle.

All shards are asked because near points of a query may be anywhere: of vectors without clusters, as those of
the test tables, the 8 of 16 nearest cells of a k-means partition hold 81 % of the 20 nearest neighbours only. So the
search costs queries times shards; larger shards mean fewer searches and a dearer build, which is linear in the points.

Vectors that are null, empty, zero, or hold null or non-finite numbers take no part, neither do null ids.
A vector's inner product with one of another length isn't defined: each length has shards of its own, and a
query meets those of its length. Products that overflow are infinite; those that aren't a number come last. Rows that repeat both id and vector count once; a query is never its
own neighbour. Ties go to the smaller id. Fewer than k other points give fewer rows; an empty table gives
none. Other columns are ignored.
"""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motolake.llm.common import begin, materialize, mix64

LEVEL_RATIO = 16


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, vector, dim of the rows that take part."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.coalesce(sound, F.lit(False)))
    return rows.withColumn("dim", F.size("vector"))


# ---------------------------------------------------------------- graph
def choose(near: np.ndarray, like: np.ndarray, points: np.ndarray, width: int) -> np.ndarray:
    """Of each row of candidates (nearest first, with their similarity) those that no chosen one is nearer to, filled up with the nearest left over; -1 where there is none."""
    rows, n = near.shape
    own = points[near]
    between = np.matmul(own, own.transpose(0, 2, 1))
    taken = np.zeros((rows, n), bool)
    number = np.zeros(rows, np.int64)
    closest = np.full((rows, n), -np.inf, np.float32)  # similarity of each candidate to the chosen ones
    for j in range(n):
        ok = (number < width) & (like[:, j] > closest[:, j]) & np.isfinite(like[:, j])
        taken[:, j] = ok
        number += ok
        np.maximum(closest, np.where(ok[:, None], between[:, :, j], -np.inf), out=closest)
    rank = np.where(taken, 0, n) + np.arange(n) + np.where(np.isfinite(like), 0, 4 * n)
    order = np.argsort(rank, axis=1, kind="stable")[:, :width]
    out = np.take_along_axis(near, order, axis=1)
    out[~np.isfinite(np.take_along_axis(like, order, axis=1))] = -1
    return out


def link(points: np.ndarray, members: np.ndarray, width: int, candidates: int, block: int = 512) -> np.ndarray:
    """Neighbours (len(members) x 2 width, as places in points) of one level's points."""
    n = len(members)
    own = points[members]
    most = min(candidates, n - 1)
    out = np.full((n, 2 * width), -1, np.int32)
    if most < 1:
        return out
    forward = np.full((n, width), -1, np.int64)
    likeness = np.full((n, width), -np.inf, np.float32)
    for a in range(0, n, block):
        like = own[a : a + block] @ own.T
        like[np.arange(len(like)), np.arange(a, a + len(like))] = -np.inf
        near = np.argpartition(-like, most - 1, axis=1)[:, :most]
        value = np.take_along_axis(like, near, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        near, value = np.take_along_axis(near, order, axis=1), np.take_along_axis(value, order, axis=1)
        chosen = choose(near, value, own, width)
        forward[a : a + block, : chosen.shape[1]] = chosen
        likeness[a : a + block, : chosen.shape[1]] = np.where(chosen >= 0, np.take_along_axis(like, np.maximum(chosen, 0), axis=1), -np.inf)
    out[:, :width] = np.where(forward >= 0, members[np.maximum(forward, 0)], -1)
    # those that chose a point, the most similar first, as far as there is room
    start, slot = np.nonzero(forward >= 0)
    end, like = forward[start, slot], likeness[start, slot]
    order = np.lexsort((-like, end))
    start, end = start[order], end[order]
    first = np.searchsorted(end, np.arange(n))
    place = np.arange(len(end)) - first[end]
    fits = place < width
    out[end[fits], width + place[fits]] = members[start[fits]]
    return out


def build(vectors: np.ndarray, *, width: int = 24, candidates: int = 64, seed: int = 10) -> dict[str, np.ndarray]:
    """Flat arrays of a shard's graph."""
    n = len(vectors)
    scaled = vectors / np.abs(vectors).max()  # squares neither overflow nor vanish
    norm = (scaled**2).sum(1)
    sphere = np.hstack([scaled, np.sqrt(np.maximum(norm.max() - norm, 0))[:, None]]).astype(np.float32)
    draw = mix64(np.arange(n, dtype=np.uint64) + np.uint64(seed << 32)).astype(np.float64) / 2.0**64
    level = np.minimum(np.floor(-np.log(np.maximum(draw, 1e-18)) / np.log(LEVEL_RATIO)), 8).astype(np.int64)
    graph = {"vectors": scaled.astype(np.float32), "exact": vectors}
    top = int(level.max())
    while top and (level >= top).sum() < 1:
        top -= 1
    for l in range(top + 1):
        members = np.flatnonzero(level >= l)
        graph[f"members{l}"] = members.astype(np.int32)
        graph[f"links{l}"] = link(sphere, members, width, candidates)
    return graph


def search(graph: dict[str, np.ndarray], queries: np.ndarray, *, ef: int = 192, expand: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(points, inner products): the best ef points found for each query, -1 where there are fewer."""
    vectors = graph["vectors"]
    n, rows = len(vectors), len(queries)
    top = max(int(k[5:]) for k in graph if k.startswith("links"))
    beam = np.full((rows, 1), graph[f"members{top}"][0], np.int64)
    for l in range(top, -1, -1):
        keep = ef if l == 0 else min(ef, 16)
        slot = np.full(n, -1, np.int64)
        slot[graph[f"members{l}"]] = np.arange(len(graph[f"members{l}"]))
        links = graph[f"links{l}"]
        if l == top:  # the top level is small: start from all of it, up to some hundred points
            start = graph[f"members{l}"][:256].astype(np.int64)
            beam = np.broadcast_to(start, (rows, len(start))).copy()
        seen = np.zeros((rows, n + 1), bool)
        np.put_along_axis(seen, np.where(beam < 0, n, beam), True, axis=1)
        like = products(vectors, queries, beam)
        beam, like = best(beam, like, keep)
        done = np.zeros(beam.shape, bool)
        while True:
            rank = np.where(done | (beam < 0), -np.inf, like)
            pick = np.argsort(-rank, axis=1, kind="stable")[:, :expand]
            open_ = np.isfinite(np.take_along_axis(rank, pick, axis=1))
            active = np.flatnonzero(open_.any(1))
            if not len(active):
                break
            flags = np.take_along_axis(done, pick, axis=1) | open_
            np.put_along_axis(done, pick, flags, axis=1)
            at = np.where(open_, np.take_along_axis(beam, pick, axis=1), -1)[active]
            near = np.where((at >= 0)[:, :, None], links[slot[np.maximum(at, 0)]], -1).reshape(len(active), -1).astype(np.int64)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            place = np.where(near < 0, n, near)
            known = np.take_along_axis(seen[active], place, axis=1)
            seen[active[:, None], place] = True
            near[known | (near < 0)] = -1
            value = products(vectors, queries[active], near)
            both = np.concatenate([beam[active], near], axis=1)
            values = np.concatenate([like[active], value], axis=1)
            states = np.concatenate([done[active], np.zeros(near.shape, bool)], axis=1)
            order = np.argpartition(-values, min(keep, values.shape[1]) - 1, axis=1)[:, :keep]
            new, new_like, new_done = (np.take_along_axis(x, order, axis=1) for x in (both, values, states))
            if new.shape[1] > beam.shape[1]:
                grow = new.shape[1] - beam.shape[1]
                beam = np.pad(beam, ((0, 0), (0, grow)), constant_values=-1)
                like = np.pad(like, ((0, 0), (0, grow)), constant_values=-np.inf)
                done = np.pad(done, ((0, 0), (0, grow)))
            beam[active], like[active], done[active] = new, new_like, new_done
    return beam, like


def products(vectors: np.ndarray, queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    value = np.matmul(vectors[np.maximum(points, 0)], queries[:, :, None])[:, :, 0]
    value[points < 0] = -np.inf
    return value


def best(points: np.ndarray, like: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    if points.shape[1] <= keep:
        return points, like
    order = np.argpartition(-like, keep - 1, axis=1)[:, :keep]
    return np.take_along_axis(points, order, axis=1), np.take_along_axis(like, order, axis=1)


# ---------------------------------------------------------------- operators
def stack(column) -> np.ndarray:
    """Rows of equal length of an Arrow list column as a matrix."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def build_index(vectors: DataFrame, *, k: int = 20, shard_points: int = 16_384, shard_values: int = 1 << 23, width: int = 24, candidates: int = 64) -> DataFrame:
    """dim, shard, shards (of that length), graph (flat arrays), written to the shared folder; vectors: vec_id, vector, dim."""
    order = Window.partitionBy("vector").orderBy("vec_id")
    points = vectors.distinct().withColumn("copy", F.row_number().over(order)).filter(F.col("copy") <= k + 1)
    points = points.groupBy("dim", "vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    points = materialize(points, "ann-points")
    most = F.greatest(F.least(F.lit(shard_points), F.floor(F.lit(shard_values) / F.col("dim"))), F.lit(1))
    shards = points.groupBy("dim").agg(F.count("*").alias("n")).select("dim", F.ceil(F.col("n") / most).cast("int").alias("shards"))

    def run(table):
        import pyarrow as pa

        begin(__name__)
        ids = table.column("ids").to_pylist()
        order = np.argsort([i[0] for i in ids], kind="stable")
        graph = build(stack(table.column("vector"))[order], width=width, candidates=candidates)
        ids = [ids[i] for i in order]
        graph["id_ends"] = np.cumsum([len(i) for i in ids])
        graph["ids"] = np.array([x for i in ids for x in i], np.int64)
        out = io.BytesIO()
        np.savez(out, **graph)
        return pa.table({c: table.column(c)[:1] for c in ("dim", "shard", "shards")} | {"graph": pa.array([out.getvalue()], pa.binary())})

    shard = F.pmod(F.xxhash64(F.col("ids")[0]), F.col("shards")).cast("int").alias("shard")
    placed = points.join(shards, "dim").select("dim", shard, "shards", "ids", "vector")
    return materialize(placed.groupBy("dim", "shard").applyInArrow(run, "dim int, shard int, shards int, graph binary"), "ann-index")


def nearest(index: DataFrame, queries: DataFrame, *, k: int = 20, ef: int = 256, block: int = 256, part_queries: int = 65_536) -> DataFrame:
    """query_id, rank, vec_id, score of each row of queries (vec_id, vector, dim)."""
    keys = ["dim", "shard", "part"]
    sizes = queries.groupBy("dim").agg(F.ceil(F.count("*") / part_queries).cast("int").alias("parts"))
    plan = materialize(sizes.join(index.groupBy("dim").agg(F.max("shards").alias("number")), "dim"), "ann-plan")
    left = index.join(plan, "dim").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*keys, "graph")
    right = queries.join(plan, "dim").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    right = right.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("number") - 1))).select(*keys, "vec_id", "vector")

    def run(graphs, asked):
        import pyarrow as pa

        begin(__name__)
        kinds = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        if not len(graphs) or not len(asked):
            return pa.table({c: pa.array([], kind) for c, kind in kinds.items()})
        graph = dict(np.load(io.BytesIO(graphs.column("graph")[0].as_py())))
        ends, ids, exact = graph["id_ends"], graph["ids"], graph["exact"]
        starts = np.concatenate(([0], ends[:-1]))
        own, vectors = asked.column("vec_id").to_numpy(), stack(asked.column("vector"))
        out: list[tuple[np.ndarray, ...]] = []
        for a in range(0, len(own), block):
            wanted = vectors[a : a + block]
            points, _ = search(graph, (wanted / np.abs(wanted).max(1, keepdims=True)).astype(np.float32), ef=max(ef, 2 * k))
            for q, row, vector in zip(own[a : a + block], points, wanted, strict=True):
                row = row[row >= 0]
                with np.errstate(over="ignore", invalid="ignore"):
                    score = (exact[row] * vector).sum(1)
                counts = ends[row] - starts[row]
                place = np.repeat(starts[row], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                member, score = ids[place], np.repeat(score, counts)
                other = member != q
                member, score = member[other], score[other]
                order = np.lexsort((member, -score))[:k]
                out.append((np.full(len(order), q), member[order], score[order]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.table({c: pa.array(x, kind) for (c, kind), x in zip(kinds.items(), columns, strict=True)})

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.isnan("score"), F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_ann(spark, sf_dir: str) -> DataFrame:
    vectors = valid_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return nearest(build_index(vectors), vectors.filter("vec_id % 20 = 0"))
