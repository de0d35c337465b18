import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from motolake.llm import packing

P = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def plain(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P).encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, capacity):
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_pieces_hold_all_tokens_in_order(make):
    texts = {1: "Hello, world. " * 40, 2: None, 3: "", 4: "ÇA 한국 don't rock'n'roll's <|endoftext|> x\x1cy a b", 5: "word " * 500, 6: "  "}
    out = packing.pack_documents(make(list(texts.items())), P, capacity=64, with_ids=True).collect()
    assert check(out, 64) >= 1
    for doc, text in texts.items():
        mine = sorted((r for r in out if r["doc_id"] == doc), key=lambda r: r["piece"])
        ids = np.concatenate([np.frombuffer(r["token_ids"], "<u4") for r in mine])
        assert ids.tolist() == plain(text)
        assert [r["start"] for r in mine] == [64 * k for k in range(len(mine))]
        assert all(r["ids_crc32"] == zlib.crc32(bytes(r["token_ids"])) for r in mine)
        assert all(r["length"] == 64 for r in mine[:-1])


def test_empty_table_repeated_rows_and_shards(make):
    assert packing.pack_documents(make([]), P).count() == 0
    rows = [(1, "a b c")] * 3 + [(i, "x " * (i % 50)) for i in range(300)] + [(None, "null id")]
    out = packing.pack_documents(make(rows), P, capacity=64, shard_docs=50).collect()
    assert len(out) >= 304
    used = check(out, 64)
    assert used <= sum(r["length"] for r in out) / 64 * 1.15 + 10


def test_word_cache_is_exact():
    tokenizer = packing.WordTokenizer(P, keep=5)
    texts = ["the cat, the (dog). it's a_b x2 $5,000.50 'quoted' end.'", "Ünïcode straße ﬁ é́ 日本 text", "ΟΔΟΣ İstanbul", "a b c", "", "the the the " * 30]
    assert [np.frombuffer(x, "<u4").tolist() + [1] for x in tokenizer.encode_batch(texts)] == [plain(t) for t in texts]


def test_word_cache_is_exact_for_all_letters_and_marks():
    tokenizer = packing.WordTokenizer(P)
    letters = [chr(c) for c in range(0x80, 0x20000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    marks = [chr(c) for c in (*range(0x300, 0x345), 0x5BC, 0x93C, 0x9BC, 0x9BE, 0x9FE, 0xA3C, 0x3099)]
    rng = random.Random(3)
    texts = [f"a{c}, {c}. {c}{rng.choice(marks)}{rng.choice(marks)}!" for c in letters] + ["J\u030c, \u092c\u095d, \u0b21\u0b3c."]
    assert tokenizer.encode_batch(texts) == [tokenizer.whole(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_rule_is_sum_of_squares(lengths):
    """Each bin is the one that a look at all bins would choose."""
    capacity = 32
    bins, offsets = packing.sum_of_squares(np.array(lengths, int), capacity)
    gaps: list[int] = []
    for s, at, offset in zip(lengths, bins.tolist(), offsets.tolist(), strict=True):
        def cost(move):
            counts: dict[int, int] = {}
            for b, g in enumerate(gaps):
                g = g - s if b == move else g
                if g:
                    counts[g] = counts.get(g, 0) + 1
            return sum(n * n for n in counts.values())

        fits = [b for b, g in enumerate(gaps) if g >= s]
        if fits:
            assert at in fits and cost(at) == min(cost(b) for b in fits)
        else:
            assert at == len(gaps)
            gaps.append(capacity)
        assert offset == capacity - gaps[at]
        gaps[at] -= s


def test_lengths_out_of_range():
    with pytest.raises(ValueError):
        packing.sum_of_squares(np.array([33]), 32)
