import re
from collections import Counter
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from motolake.llm import mixing
from tests.oracle import same


def test_query_gives_what_sql_gives(spark, sf_dir):
    same(mixing.op7_mixing(spark, sf_dir), mixing.ORACLE_SQL, sf_dir)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12))
def test_targets_share_all_words(totals):
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(totals))]
    out = [Fraction(*t) for t in mixing.water_fill(totals, weights, 3)]
    assert sum(out) == sum(totals)
    assert all(t <= 3 * total for t, total in zip(out, totals, strict=True))
    open_ = [t / w for t, w, total in zip(out, weights, totals, strict=True) if t < 3 * total]
    assert len(set(open_)) <= 1
    assert all(t / w <= open_[0] for t, w in zip(out, weights, strict=True)) if open_ else True


def test_tree_keeps_quotas_and_slots():
    quotas = [100, 37, 0, 3]
    tree = mixing.SplittingTree(quotas, 7, seed=3)
    shards = [[tree.walk(s, r) for r in range(q)] for s, q in enumerate(quotas)]
    sizes = Counter(x for s in shards for x in s)
    assert sorted(sizes.values()) == [20] * 7
    assert shards == [[mixing.SplittingTree(quotas, 7, seed=3).walk(s, r) for r in range(q)] for s, q in enumerate(quotas)]


def test_left_draws_are_multivariate_hypergeometric():
    draws = np.array([mixing.SplittingTree([30, 10], 2, seed=s).split(0, 2, (30, 10))[0] for s in range(3000)])
    assert (draws.sum(1) == 20).all() and abs(draws[:, 0].mean() - 15) < 0.1
    assert abs(draws[:, 0].var() - 20 * 0.75 * 0.25 * 20 / 39) < 0.2


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 300), st.integers(0, 9))
def test_permutation_is_a_bijection(n, seed):
    assert sorted(mixing.permuted(i, n, str(seed)) for i in range(n)) == list(range(n))


def test_draws_are_disjoint_and_complete(make):
    rows = [(i, "w " * (i % 40 + (i == 3) * 3000), None, s) for i, s in enumerate(["a"] * 60 + ["b"] * 25 + [None] * 10 + ["c"])] + [(200, None, None, "a"), (201, "", None, "z"), (201, " \t\n", None, "z")]
    documents, draws = mixing.mix(make(rows), block_words=64, shard_blocks=4, seed=5)
    docs = mixing.taken(documents, draws).collect()
    assert len(docs) == len(rows)
    word = re.compile(r"[^\x20\x09-\x0D]+")
    assert sum(r["size"] for r in docs) == sum(len(word.findall(r[1] or "")) for r in rows)
    got = Counter()
    for r in docs:
        assert 0 <= r["taken"] <= 3 * r["size"]
        got[r["source"]] += r["taken"]
    for source in {r["source"] for r in docs}:
        target = next(r["target"] for r in docs if r["source"] == source)
        assert abs(got[source] - target) <= 0.5
    taken = [(r["source_index"], r["block"]) for r in draws.select("source_index", "block", "shard").distinct().collect()]
    assert len(taken) == len(set(taken))
    again = mixing.taken(*mixing.mix(make(rows), block_words=64, shard_blocks=4, seed=5)).collect()
    assert sorted((r["place"], r["source"] or "", r["taken"]) for r in docs) == sorted((r["place"], r["source"] or "", r["taken"]) for r in again)


def test_shards_of_the_output_have_the_tree_s_quotas(make):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(rng.integers(1, 60))), None, "abc"[i % 10 % 3]) for i in range(400)]
    options = {"block_words": 64, "shard_blocks": 8, "seed": 4}
    documents, draws, shards = mixing.draw(make(rows), **options)
    info = {r["source_index"]: (r["quota"], r["source_size"]) for r in documents.collect()}
    quotas = [-(-info[s][0] // 64) for s in sorted(info)]
    tree = mixing.SplittingTree(quotas, shards, seed=4)
    assert shards > 4 and [sum(q) for q in zip(*(tree.quota(s) for s in range(shards)), strict=True)] == quotas
    blocks = {(r["source_index"], r["block"]): r["shard"] for r in draws.collect()}
    for shard in range(shards):
        assert tuple(sum(x == shard for (s, _), x in blocks.items() if s == k) for k in range(len(quotas))) == tree.quota(shard)

    out = mixing.mixture(make(rows), keep=("source",), partition_shards=3, **options)
    got = [(r["doc_id"], r["text"], r["shard"], r["epoch"], r["p"]) for r in out.withColumn("p", __import__("pyspark").sql.functions.spark_partition_id()).collect()]
    assert all(shard // 3 == p for *_, shard, _, p in got) and len({p for *_, p in got}) == -(-shards // 3)
    # a turn is in the shard of the block where it begins, in the order of that shard's blocks
    order, place = {}, {}
    for r in draws.orderBy("block").collect():
        place.setdefault((r["doc_id"], r["epoch"]), (r["shard"], r["shard_order"], r["epoch"], r["place"]))
    by_part = {}
    for doc, _, shard, epoch, p in got:
        assert place[doc, epoch][0] == shard
        by_part.setdefault(p, []).append(place[doc, epoch])
    assert all(x == sorted(x) for x in by_part.values())
    assert sorted((d, e) for d, _, _, e, _ in got) == sorted(place)
    texts = {i: t for i, t, *_ in rows}
    short = [d for d, t, *_ in got if t != texts[d]]
    assert len(short) <= 3 and all(texts[d].startswith(t) for d, t, *_ in got)
    words = sum(len(t.split()) for t in texts.values())
    assert abs(sum(len(t.split()) for _, t, *_ in got) - words) <= 3


def test_empty_table_and_repeated_ids(make):
    assert mixing.taken(*mixing.mix(make([]))).count() == 0
    out = mixing.taken(*mixing.mix(make([(1, "a b c", None, "s"), (1, "a b c", None, "s"), (None, "d", None, "s")]))).collect()
    assert len(out) == 3 and sum(r["taken"] for r in out) == 7
