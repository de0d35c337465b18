import math
import zlib

import numpy as np
import pytest

from motolake.llm import toxicity

NICE, BAD = "tree river stone cloud bread table window garden".split(), "vilex vilor vilan grubo".split()


def corpus(seed, n, toxic_share=0.3, first=0):
    rng = np.random.default_rng(seed)
    docs, labels = [], []
    for i in range(first, first + n):
        words = list(rng.choice(NICE, rng.integers(10, 60)))
        bad = bool(rng.random() < toxic_share)
        if bad:
            words += list(rng.choice(BAD, max(1, len(words) // 15)))
            rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


def label_table(spark, labels):
    return spark.createDataFrame([(i, None, t, "x") for i, t in labels], "doc_id long, quality int, toxic int, text string")


def test_held_out_documents_are_told_apart(spark, make):
    docs, labels = corpus(0, 600)
    out = toxicity.score_documents(make(docs), label_table(spark, labels)).collect()
    truth = dict(labels)
    assert len(out) == 600 and all(0 <= r["score"] <= 1 for r in out)
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_labels_of_held_out_documents_teach_nothing(spark, make):
    docs, labels = corpus(1, 200)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    a, b = (toxicity.score_documents(make(docs), label_table(spark, x)).collect() for x in (labels, flipped))
    assert sorted((r["doc_id"], r["score"]) for r in a) == sorted((r["doc_id"], r["score"]) for r in b)


def beginning(word, n):
    return word[:n] + "*" if len(word) > n else word


def plain_models(rows, discount, significance, factor):
    """Log-likelihood ratio of a word by two Kneser-Ney models, in plain loops."""
    seen = set()
    for text, c in rows:
        words = toxicity.words_of(text)
        for i, w in enumerate(words):
            seen.add((tuple(([None, None] + words)[i : i + 2]), w, c))
    counts = {}
    for _, w, c in seen:
        counts.setdefault(w, [0, 0])[c] += 1
    totals = [sum(n[c] for n in counts.values()) for c in (0, 1)]
    prior = totals[1] / sum(totals)
    p_of, tie, up_level = [], [], None
    for level in (4, 5, 6, None):
        own, up = {}, {}
        for w, n in counts.items():
            e = w if level is None else beginning(w, level)
            up[e] = beginning(w, up_level or 4)
            old = own.setdefault(e, [0, 0])
            own[e] = [old[0] + n[0], old[1] + n[1]]
        below = {}
        for e, n in own.items():
            if level == 4:
                below[e] = [sum(n) / sum(totals)] * 2
            else:
                whole = sum(sum(m) for x, m in own.items() if up[x] == up[e])
                below[e] = [q * sum(n) / whole for q in p_of[-1][up[e]]]
        reserved = [discount * sum(n[c] > 0 for n in own.values()) / totals[c] for c in (0, 1)]
        kept = {}
        for e, n in own.items():
            q = below[e]
            s = prior * q[1] / (prior * q[1] + (1 - prior) * q[0])
            test = 2 * sum(x * math.log(x / (sum(n) * y)) for x, y in ((n[1], s), (n[0], 1 - s)) if x)
            odds = math.log(max(n[1], 0.01) / max(n[0], 0.01) * (1 - s) / s)
            if test >= significance and abs(odds) >= math.log(factor):
                kept[e] = [max(n[c] - discount, 0) / totals[c] + reserved[c] * q[c] for c in (0, 1)]
        b = [(1 - sum(k[c] for k in kept.values())) / (1 - sum(below[e][c] for e in kept)) for c in (0, 1)]
        p_of.append({e: kept.get(e) or [b[c] * below[e][c] for c in (0, 1)] for e in own})
        assert sum(p[0] for p in p_of[-1].values()) == pytest.approx(1) == sum(p[1] for p in p_of[-1].values())
        tie.append(math.log(b[1] / b[0]))
        up_level = level

    def ratio(word):
        rest = 0.0
        for found, shift, level in zip(reversed(p_of), reversed(tie), (None, 6, 5, 4), strict=True):
            e = word if level is None else beginning(word, level)
            if e in found:
                return rest + math.log(found[e][1] / found[e][0])
            rest += shift
        return rest

    return ratio


@pytest.mark.parametrize("significance", [20.0, 8.0])
def test_ratios_are_those_of_two_kneser_ney_models(spark, make, significance):
    docs, labels = corpus(2, 400)
    rng = np.random.default_rng(2)
    docs = [(i, t + " calm" * (not y) + " grubo" + "".join(rng.choice(list("abcde"), 3)) * y) for (i, t), (_, y) in zip(docs, labels, strict=True)]
    rows = [(t, y) for (_, t), (_, y) in zip(docs, labels, strict=True)]
    frame = spark.createDataFrame(rows + rows[:50], "text string, toxic int")  # copies count once
    model = toxicity.score_table(toxicity.count_words(frame, flush=40, parts=3), significance=significance)
    gains = toxicity.Gains({r["expression"]: r["gain"] for r in model.table.collect()}, keep=3)
    expected = plain_models(rows, 0.75, significance, 2.0)
    for word in (*NICE, *BAD, "calm", "unheard", "grubozzz", "vilexx", "grub", "vil", "treetop"):
        assert model.base + gains[word] == pytest.approx(expected(word), abs=1e-9)
    # evidence counts for both classes, and new words back off to their beginnings
    assert gains["grubozzz"] > 1.5 and gains["calm"] < -1.5 and gains["unheard"] == 0 and len(gains) <= 4


def test_joined_scores_equal_broadcast_scores(spark, make):
    docs, labels = corpus(3, 300)
    docs += [(900, None), (901, ""), (902, "1 2 3"), (903, "vilex"), (903, "vilex")]
    model, _ = toxicity.train(make(docs), label_table(spark, labels))
    a = toxicity.differences(make(docs), model).collect()
    b = toxicity.differences(make(docs), model, broadcast_entries=1).collect()
    assert len(a) == len(b) == len(docs)
    assert {r["difference"] for r in a if r["doc_id"] in (900, 901, 902)} == {model.base}
    for x, y in zip(sorted(map(tuple, a)), sorted(map(tuple, b)), strict=True):
        assert x[0] == y[0] and x[1] == pytest.approx(y[1], abs=1e-9)


def test_counts_are_of_different_histories(spark, make):
    rows = spark.createDataFrame([("a b c", 1), ("A b c", 1), ("x b c", 1), ("a b c", 0), ("", 0), (None, 1), ("c", 0)], "text string, toxic int")
    out = {r["word"]: (r["ordinary"], r["toxic"]) for r in toxicity.count_words(rows, flush=1).collect()}
    assert out == {"a": (1, 1), "x": (0, 1), "b": (1, 2), "c": (2, 2)}


def test_labels_too_many_to_send_are_shuffled(spark, make):
    docs, labels = corpus(4, 50)
    a, b = (toxicity.learning_rows(make(docs), label_table(spark, labels), broadcast_labels=n).collect() for n in (10, 100))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) > 30


def test_nothing_to_learn(spark, make):
    docs = make([(1, "x"), (2, None), (None, "y")])
    for labels in ([], [(1, 0), (2, 0)], [(1, None), (2, 7)]):
        out = toxicity.score_documents(docs, label_table(spark, labels)).collect()
        assert len(out) == 3 and {r["score"] for r in out} == {0.0} and {r["predicted"] for r in out} == {0}
    assert toxicity.score_documents(make([]), label_table(spark, [(1, 1)])).count() == 0
