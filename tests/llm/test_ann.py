import numpy as np
import pytest

from motolake.llm import ann


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, 2, "x", 3) for i, v in rows], f"vec_id long, embedding array<{kind}>, rank int, shard int, ids string, dim int")


def exact(vectors, q, k):
    score = vectors[q] @ np.stack(list(vectors.values())).T
    order = sorted((-s, i) for s, i in zip(score.tolist(), vectors, strict=True) if i != q)
    return [i for _, i in order[:k]]


def search(df, k, **index):
    v = ann.valid_vectors(df)
    return ann.nearest(ann.build_index(v, k=k, **index), v.filter("vec_id % 20 = 0"), k=k)


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 32)).astype(np.float32)
    vectors = dict(enumerate(x.astype(np.float64)))
    out = search(table(spark, [(i, v.tolist()) for i, v in enumerate(x)]), 20, shard_points=1000).collect()
    found: dict = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["score"] == pytest.approx(float(vectors[r["query_id"]] @ vectors[r["vec_id"]]), abs=1e-12)
    assert len(found) == 150 and all(len(v) == 20 for v in found.values())
    recall = np.mean([len(set(v) & set(exact(vectors, q, 20))) / 20 for q, v in found.items()])
    assert recall > 0.95


def test_copies_and_ties_by_id(spark):
    rows = [(i, [1.0, 0.0]) for i in range(100)] + [(i, [0.0, 1.0]) for i in range(100, 140)] + [(200, [2.0, 0.0])]
    out = search(table(spark, rows), 5, shard_points=1).collect()
    mine = [r["vec_id"] for r in sorted((r for r in out if r["query_id"] == 0), key=lambda r: r["rank"])]
    assert mine == [200, 1, 2, 3, 4]
    other = [r["vec_id"] for r in sorted((r for r in out if r["query_id"] == 120), key=lambda r: r["rank"])]
    assert other == [100, 101, 102, 103, 104]


def test_unsound_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (80, [inf, 1.0]), (1, [None, 1.0]), (2, [1.0]), (3, [3.0, 1.0]), (3, [3.0, 1.0]), (None, [9.0, 9.0]), (4, [])]
    out = search(table(spark, rows), 20).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out] == [(0, 1, 3, 5.0)]


def test_doubles_keep_their_digits_and_their_range(spark):
    rows = [(0, [0.1, 0.2]), (1, [0.3, 0.7]), (2, [1e300, 1e300]), (3, [1e-300, -1e-300]), (20, [1e300, 1e300])]
    out = {(r["query_id"], r["vec_id"]): r["score"] for r in search(table(spark, rows, "double"), 5).collect()}
    assert out[0, 1] == 0.1 * 0.3 + 0.2 * 0.7 and out[0, 2] == 1e300 * 0.1 + 1e300 * 0.2 and out[0, 3] == 0.1 * 1e-300 - 0.2 * 1e-300
    assert out[20, 2] == float("inf") and len(out) == 8


def test_each_length_has_its_own_neighbours(spark):
    rng = np.random.default_rng(3)
    lengths = {i: 3 if i % 3 else 5 for i in range(200)}
    vectors = {i: rng.normal(size=n) for i, n in lengths.items()}
    out = search(table(spark, [(i, v.tolist()) for i, v in vectors.items()], "double"), 6, shard_points=30).collect()
    for n in (3, 5):
        mine = {i: v for i, v in vectors.items() if lengths[i] == n}
        for q in (i for i in mine if i % 20 == 0):
            assert [r["vec_id"] for r in sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])] == exact(mine, q, 6)


def test_few_and_none(spark):
    assert search(table(spark, []), 20).count() == 0
    assert search(table(spark, [(20, [1.0])]), 20).count() == 0
    assert search(table(spark, [(1, [1.0]), (2, [2.0])]), 20).count() == 0


def test_graph_of_all_points_is_exact_for_wide_beams():
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(500, 8)) * rng.uniform(0.1, 3, (500, 1))).astype(np.float32)
    graph = ann.build(x, width=16, candidates=48)
    q = rng.normal(size=(20, 8)).astype(np.float32)
    points, like = ann.search(graph, q, ef=200)
    top = np.take_along_axis(points, np.argsort(-like, axis=1)[:, :10], axis=1)
    want = np.argsort(-(q @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(top, want, strict=True)]) > 0.99
    assert graph["links0"].shape == (500, 32) and graph["links0"].max() < 500
