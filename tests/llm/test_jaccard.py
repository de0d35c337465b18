import re
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest

from motolake.llm import jaccard
from motolake.llm.components import connected_components
from tests.oracle import same


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def expected(rows, percent=80):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        union = len(sets[a] | sets[b])
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * union:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return sorted((i, len(s), find(i)) for i, s in sets.items())


def got(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def near_copies(seed, groups=12, n=160):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choice(words, 12))
    bases = [list(rng.choice(words, rng.integers(6, 160))) for _ in range(groups)]
    out = []
    for i in range(n):
        t = list(bases[rng.integers(groups)])
        for _ in range(rng.integers(0, 5)):
            t[rng.integers(len(t))] = str(rng.choice(words))
        out.append((int(rng.integers(1, 50)) * 1000 + i, (line + " " if i % 2 else "") + " ".join(t)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_components_are_those_of_all_pairs(make, seed):
    rows = near_copies(seed)
    assert got(jaccard.near_duplicates(make(rows))) == expected(rows)


def test_heavy_clusters_are_cut_into_blocks(make):
    rows = near_copies(7, groups=2, n=120)
    assert got(jaccard.near_duplicates(make(rows), cluster_shingles=1500, frequent=50, block_bytes=4000)) == expected(rows)


def test_ties_at_the_threshold(make):
    # 9 shingles, of which 8 are shared with the one of 9 (8 of 10: a link) and 7 with the next (7 of 11: none)
    base = [f"a{i}" for i in range(13)]
    rows = [(3, " ".join(base)), (2, " ".join([*base[:12], "x"])), (1, " ".join([*base[:11], "y", "z"])), (9, "a b c"), (8, "A\tB c"), (7, "a b"), (6, "ab c")]
    assert got(jaccard.near_duplicates(make(rows))) == expected(rows)


def test_white_space_and_capitals(make):
    rows = [(1, "ONE two\x0bthree four\rfive"), (2, "one TWO three\nfour  five "), (3, "one two three four five"), (4, "Éa b c d e"), (5, "éa b c d e"), (6, "")]
    assert got(jaccard.near_duplicates(make(rows))) == expected(rows)


def test_nulls_empty_and_repeated_rows(make):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (6, "q " * 30_000)]
    out = jaccard.near_duplicates(make([*rows, (None, "a b c d e f"), (None, "p q r")])).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out if r["doc_id"] is not None) == sorted([*expected(rows), (5, 2, 4)])
    assert sorted((r["n_shingles"], r["component_id"] or 0) for r in out if r["doc_id"] is None) == [(1, 0), (2, 4)]
    assert jaccard.near_duplicates(make([])).count() == 0


def test_rows_that_repeat_an_id_keep_their_own_links(make):
    rng = np.random.default_rng(9)
    rows, links = [], set()
    for g in range(8):
        x, y = ([f"g{g}{c}{rng.integers(1000)}" for _ in range(60)] for c in "xy")
        at = 10 * g
        rows += [(at + 1, x), (at + 1, y), (at + 5, x), (at + 7, [*x[:-1], "u"]), (at + 8, y), (at + 9, [*y[:-1], "v"])]
        links |= {(at + 5, at + 1), (at + 7, at + 1), (at + 8, at + 1), (at + 9, at + 1)}
    out = jaccard.near_duplicates(make([(i, " ".join(t)) for i, t in rows]))
    assert sorted((r["doc_id"], r["component_id"]) for r in out.collect()) == sorted([*links, *[(10 * g + 1, 10 * g + 1) for g in range(8)] * 2])


def test_columns_of_one_batch_go_once_and_of_others_are_counted():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.choice(300, rng.integers(0, 40))).astype(np.uint64) << np.uint64(32) for _ in range(40)]
    held = {}
    for s in sets:
        for x in s.tolist():
            held[x] = held.get(x, 0) + 1
    shared, sent, announced = np.zeros(40, np.int64), {}, jaccard.Announced(100)
    for b in range(4):
        for p, ids, counts, keys, several, documents, _ in jaccard.split_columns(np.arange(10 * b, 10 * b + 10), sets[10 * b : 10 * b + 10], 5, b, None, announced if b < 2 else None):
            sent.setdefault(p, []).append((np.frombuffer(ids, "<i8"), np.frombuffer(counts, "<i4"), np.frombuffer(keys, "<u4"), np.frombuffer(several, jaccard.SEVERAL)))
            about = np.frombuffer(documents, jaccard.DOCUMENT)
            shared[about["id"]] += about["local"]
    for rows in sent.values():
        seen = {}
        for _, _, keys, several in rows:
            for k, n in [*((k, 1) for k in keys.tolist()), *several.tolist()]:
                seen[k] = seen.get(k, 0) + n
        for ids, counts, keys, several in rows:
            assert len(set(keys.tolist()) & set(several["key"].tolist())) == 0
            shared += np.bincount(np.repeat(ids, counts), [seen[k] > 1 for k in keys.tolist()], 40).astype(np.int64)
    assert shared.tolist() == [sum(held[x] > 1 for x in s.tolist()) for s in sets]


def test_phrases_of_several_documents_do_not_join_clusters(make, monkeypatch):
    rng = np.random.default_rng(8)
    phrases = [" ".join(f"p{k}x{j}" for j in range(5)) for k in range(30)]
    rows = []
    for g in range(40):
        text = [f"g{g}w{j}" for j in range(120)]
        for at, k in enumerate(rng.choice(30, 5, replace=False)):
            text.insert(20 * at, phrases[k])
        rows += [(2 * g, " ".join(text)), (2 * g + 1, " ".join([*text[:-1], "end"]))]
    found, materialize = {}, jaccard.materialize

    def kept(df, name):
        out = materialize(df, name)
        if name == "jaccard-clusters":
            found.update((r["cluster"], r["count"]) for r in out.groupBy("cluster").count().collect())
        return out

    monkeypatch.setattr(jaccard, "materialize", kept)
    assert got(jaccard.near_duplicates(make(rows))) == expected(rows)
    assert sorted(found.values()) == [2] * 40


def test_waves_copy_a_row_a_bounded_number_of_times(make, monkeypatch):
    rows, tables, materialize = near_copies(3, groups=2, n=120), [], jaccard.materialize

    def kept(df, name):
        tables.append(name)
        return materialize(df, name)

    monkeypatch.setattr(jaccard, "materialize", kept)
    assert got(jaccard.near_duplicates(make(rows), cluster_shingles=800, copies=2)) == expected(rows)
    assert tables.count("jaccard-links") > 2


def test_scratch_tables_of_near_copies_stay_near_the_size_of_their_texts(make, monkeypatch):
    rng = np.random.default_rng(12)
    words = np.array([f"w{i}" for i in range(3000)])
    rows = []
    for g in range(40):
        text = list(rng.choice(words, 500))
        for c in range(5):
            text[int(rng.integers(500))] = f"copy{c}"
            rows.append((5 * g + c, " ".join(text)))
    docs, size = make(rows, clashes=False), sum(len(t) for _, t in rows)
    tables, most, materialize, release = {}, [0], jaccard.materialize, jaccard.release

    def kept(df, name):
        out = materialize(df, name)
        tables[out.scratch] = sum(x.stat().st_size for x in Path(out.scratch.removeprefix("file://")).glob("*.parquet"))
        most[0] = max(most[0], sum(tables.values()))
        return out

    def gone(df):
        tables.pop(df.scratch, None)
        release(df)

    monkeypatch.setattr(jaccard, "materialize", kept)
    monkeypatch.setattr(jaccard, "release", gone)
    out = jaccard.near_duplicates(docs).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in out) == [(i, i - i % 5) for i in range(200)]
    assert most[0] < 2.5 * size


def test_more_blocks_of_columns_send_no_more_bytes():
    rng = np.random.default_rng(13)
    sets = [np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64)) for _ in range(60)]
    few, many = (sum(len(x) for r in jaccard.split_rows(np.arange(60), sets, parts, 0) for x in r if isinstance(x, bytes)) for parts in (8, 1024))
    assert many < 1.1 * few < 1.1 * 60 * 500 * 5.2
    assert jaccard.from_gaps(jaccard.gaps(np.array([0, 0, 3, 70_000]))).tolist() == [0, 0, 3, 70_000]


def test_levels_keep_the_order_of_counts():
    levels = jaccard.levels_of(np.arange(1, 100_000))
    assert levels[:128].tolist() == list(range(1, 129))
    assert (np.diff(levels.astype(int)) >= 0).all()
    assert jaccard.levels_of(np.array([1 << 40])).tolist() == [255]


def test_shuffle_files_go_with_the_step_that_wrote_them(spark):
    import time

    from motolake.llm.common import materialize

    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {x for x in files.splitlines() if "shuffle_" in x}

    before = shuffles()
    materialize(spark.range(10_000).repartition(7, "id"), "shuffled")
    end = time.time() + 20
    while (left := shuffles() - before) and time.time() < end:
        time.sleep(0.2)
    assert not left


def test_product_equals_pairs():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.choice(60, rng.integers(1, 40))).astype(np.uint64) for _ in range(60)]
    label = jaccard.product_components(sets, 50)
    parent = list(range(60))
    for a, b in combinations(range(60), 2):
        o = len(np.intersect1d(sets[a], sets[b]))
        if o and 100 * o >= 50 * (len(sets[a]) + len(sets[b]) - o):
            low, high = sorted((parent[a], parent[b]))
            parent = [low if p == high else p for p in parent]
    assert label.tolist() == parent


def test_components_of_paths_and_stars(spark):
    rng = np.random.default_rng(6)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(5, 5)]
    ids = rng.permutation(200)
    df = spark.createDataFrame([(int(ids[a]), int(ids[b])) for a, b in links], "a long, b long")
    out = {r["node"]: r["component"] for r in connected_components(df).collect()}
    path, star = {int(ids[i]) for i in range(41)}, {int(ids[i]) for i in range(100, 140)}
    assert out == {n: min(path) for n in path} | {n: min(star) for n in star}
    assert {r["node"]: r["component"] for r in connected_components(df, hub=20).collect()} == out
    assert connected_components(df.limit(0)).count() == 0


def test_query_gives_what_sql_gives(spark, sf_dir):
    same(jaccard.op9_jaccard(spark, sf_dir), jaccard.ORACLE_SQL, sf_dir)
