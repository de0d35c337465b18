import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from motolake.llm import suffix_dedup as sd
from tests.oracle import same


def plain(rows, length):
    """Removed bytes of each row, rows in order of id and text."""
    seen, out = set(), []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            window = raw[p : p + length]
            if window in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        out.append((doc, raw, gone))
    return out


def expected(rows, length=100):
    out = []
    for doc, raw, gone in plain(sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or "")), length):
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest(), left))
    return sorted(out)


def got(df):
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in df.collect())


def texts(seed, n=60):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(300)]
    passages = [" ".join(rng.choice(words, 40)) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [" ".join(rng.choice(words, rng.integers(1, 60)))]
        for _ in range(rng.integers(0, 3)):
            p = passages[rng.integers(len(passages))]
            cut = rng.integers(0, 60)
            parts += [p[cut : cut + rng.integers(90, 260)], " ".join(rng.choice(words, rng.integers(0, 30)))]
        out.append((int(rng.integers(0, 10**6)) * 7 + i, " ".join(parts)))
    return out + [(out[k][0] + 10**8, out[k][1]) for k in range(0, n, 5)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_look_at_every_window(make, seed, monkeypatch):
    monkeypatch.setattr(sd, "BATCH", 3000)
    monkeypatch.setattr(sd, "CHUNK", 700)
    rows = texts(seed)
    assert got(sd.remove_repeats(make(rows), block_bytes=2000)) == expected(rows)


def test_periodic_and_very_long_texts(make):
    rows = [(1, "a" * 5000), (2, "ab" * 400), (3, "a" * 99), (4, "x" + "ab" * 60), (5, "é" * 300), (6, "z" * 40 + "é" * 60 + "y" * 40), (7, "hello " * 40_000)]
    assert got(sd.remove_repeats(make(rows))) == expected(rows)


def test_nulls_repeated_ids_and_empty(make):
    text = "the quick brown fox jumps over the lazy dog and runs away " * 3
    rows = [(1, None), (2, ""), (3, text), (3, text), (3, "another " + text), (4, "short")]
    out = sd.remove_repeats(make([*rows, (None, text), (None, "short")])).collect()
    # rows without an id are documents too, after all others
    assert sorted((r["n_bytes"], r["n_removed"]) for r in out if r["doc_id"] is None) == [(5, 0), (len(text), len(text))]
    assert sorted(tuple(r) for r in [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in out if r["doc_id"] is not None]) == expected(rows)
    assert sd.remove_repeats(make([])).count() == 0


def test_other_lengths(make):
    rows = texts(9, 25)
    assert got(sd.remove_repeats(make(rows), length=300, gram=20)) == expected(rows, 300)


def test_text_without_broken_characters(make):
    rows = [(1, "é" * 100), (2, "a" + "é" * 100 + "b")]
    out = {r["doc_id"]: r for r in sd.remove_repeats(make(rows), kept="text", keep=("lang", "source")).collect()}
    assert out[2]["kept_text"] == "ab" and out[1]["kept_text"].strip("é") == "" and out[1]["lang"] is None


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 40), st.integers(-5, 5), st.integers(0, 9)), max_size=25), max_size=12))
def test_family_keeps_the_earliest(batches):
    family, later, everything = sd.IndexFamily(), [], []
    for b in batches:
        records = np.array([(k, d, a) for k, d, a in b], sd.WINDOW)
        everything += [tuple(r) for r in records.tolist()]
        later.append(family.add(records))
    kept = sorted(map(tuple, family.all(sd.WINDOW).tolist()))
    best: dict = {}
    for k, d, a in everything:
        best[k] = min(best.get(k, (d, a)), (d, a))
    assert kept == sorted((k, *p) for k, p in best.items())
    rest = list(everything)
    for r in kept:
        rest.remove(r)
    assert sorted(map(tuple, np.concatenate([*later, np.zeros(0, sd.WINDOW)]).tolist())) == sorted(rest)
    sizes = [len(x) for x in family.levels]
    assert all(a > 2 * b for a, b in zip(sizes, sizes[1:], strict=False))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(-(1 << 63), (1 << 63) - 1), st.integers(0, 1 << 30)), max_size=30))
def test_records_round_trip(rows):
    records = np.array([(i, d, a) for i, (d, a) in enumerate(rows)], sd.WINDOW)
    back = sd.decode(sd.encode(records), sd.WINDOW)
    assert sorted(map(tuple, back.tolist())) == sorted(map(tuple, records.tolist()))


def test_query_gives_what_sql_gives(spark, sf_dir):
    same(sd.op8_suffix_dedup(spark, sf_dir), sd.ORACLE_SQL, sf_dir)
