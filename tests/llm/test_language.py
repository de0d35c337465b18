import numpy as np

from motolake.llm import language

WORDS = {"en": "the of and with that for this not have from they will would there their what".split(), "de": "der die und nicht ein ich mit sich auch auf für werden über können müssen straße".split(), "el": "και το να του της με που για δεν από είναι στο θα μου σας".split()}


def sentences(seed, n):
    rng = np.random.default_rng(seed)
    return [(" ".join(rng.choice(WORDS[lang], rng.integers(5, 40))), lang) for lang in rng.choice(list(WORDS), n)]


def test_held_out_accuracy(make):
    train = make([(i, t, lang) for i, (t, lang) in enumerate(sentences(0, 300))])
    names, prototypes = language.learn_prototypes(train.select("text", "lang"))
    assert names == ["de", "el", "en"] and prototypes.shape == (3, language.DIMENSIONS)
    test = sentences(1, 200)
    out = {r["doc_id"]: r for r in language.identify(make([(i, t) for i, (t, _) in enumerate(test)]), names, prototypes).collect()}
    assert np.mean([out[i]["lang_pred"] == lang for i, (_, lang) in enumerate(test)]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_counts_are_those_of_a_loop():
    texts = ["Ab cd!", "", "123 --", "x", "Straße straße", "a\nb" * 3, "日本語"]
    codes, counts = language.trigram_counts(texts)
    for t, row in zip(texts, counts, strict=True):
        want: dict = {}
        clean = "".join(c if c.isalpha() else " " for c in f" {t.lower()} ")
        clean = " " + " ".join(clean.split()) + " "
        for i in range(1, len(clean) - 1):
            if clean[i] != " ":
                key = tuple(0 if c == " " else ord(c) for c in clean[i - 1 : i + 2])
                want[key] = want.get(key, 0) + 1
        assert {tuple(int(x) for x in codes[j]): int(n) for j, n in enumerate(row) if n} == want


def test_bundles_are_sums_of_bound_vectors():
    codes, counts = language.trigram_counts(["abc abd"])
    vectors = language.bind(codes, 64)
    a, b, c = (language.letter_vector(ord(x), 64) for x in "abc")
    j = next(i for i, k in enumerate(codes.tolist()) if k == [97, 98, 99])
    assert (vectors[j] == np.roll(a, 2) * np.roll(b, 1) * c).all()
    prototypes = np.tile((counts @ language.bind(codes, 64)).astype(float), (1, 1))
    near, known = language.cosines(["abc abd", "1"], prototypes)
    assert abs(near[0, 0] - 1) < 1e-6 and known.tolist() == [True, False]


def test_undetermined_and_empty(make, spark):
    rows = make([(1, None), (2, ""), (3, "12 %"), (4, "the"), (4, "the"), (None, "und")])
    names, prototypes = language.learn_prototypes(make([(1, "the and", "en"), (2, "und der", "de"), (3, "x", None), (4, None, "fr")]).select("text", "lang"))
    out = language.identify(rows, names, prototypes).collect()
    assert len(out) == 6 and [r["lang_pred"] for r in out if r["doc_id"] in (1, 2, 3)] == ["und"] * 3
    none, empty = language.learn_prototypes(make([]).select("text", "lang"))
    assert none == [] and {r["lang_pred"] for r in language.identify(rows, none, empty).collect()} == {"und"}
