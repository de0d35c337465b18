import numpy as np
import pytest

import corpus_pipeline as cp
from motolake.llm import toxicity
from tests.llm.test_jaccard import expected as groups_of
from tests.llm.test_packing import check
from tests.llm.test_suffix_dedup import plain
from tests.llm.test_toxicity import corpus

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture
def folder(spark, make, tmp_path):
    docs, labels = corpus(0, 400)
    rng = np.random.default_rng(1)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(i, t if k % 3 else t + " " + passage) for k, (i, t) in enumerate(docs)]
    docs += [(1000 + i, docs[i][1]) for i in range(0, 60, 3)]
    docs += [(2000 + i, " ".join([*docs[i][1].split(), "end"])) for i in range(0, 60, 3)]
    docs += [(3000, None), (3001, ""), (3002, docs[1][1]), (3002, docs[1][1]), (None, "no id here but words enough")]
    rows = [(i, t, "en", f"s{rng.integers(4)}") for i, t in docs]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def read(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def through(spark, folder, df, name):
    df.write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")


def test_stages_one_after_another(spark, folder):
    docs = read(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rejected = {r["doc_id"] for r in toxicity.score_documents(docs, labels).filter("predicted = 1").collect()}
    assert rejected
    one = through(spark, folder, cp.drop_toxic(spark, docs, folder), "one")
    assert one.columns == COLUMNS
    before = rows_of(docs)
    assert sorted(rows_of(one), key=str) == sorted(((i, t) for i, t in before if i not in rejected), key=str)

    two = through(spark, folder, cp.one_of_each_group(spark, one, folder), "two")
    assert two.columns == COLUMNS
    ranked = sorted(rows_of(one), key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    keep = {i for i, _, c in groups_of(list(enumerate(t for _, t in ranked))) if i == c}
    assert sorted(rows_of(two), key=str) == sorted((ranked[i] for i in keep), key=str)

    three = through(spark, folder, cp.cut_repeats(spark, two, folder), "three")
    assert three.columns == COLUMNS
    ranked = sorted(rows_of(two), key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    want = []
    for (i, t), (_, raw, gone) in zip(ranked, plain(ranked, 100), strict=True):
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g).decode()
        if not raw or left:
            want.append((i, left if any(gone) else t))
    assert sorted(rows_of(three), key=str) == sorted(want, key=str)

    four = through(spark, folder, cp.mix_sources(spark, three, folder), "four")
    assert four.columns == COLUMNS
    source = {(i, t): s for i, t, s in ((r["doc_id"], r["text"], r["source"]) for r in three.collect())}
    words = sum(len((t or "").split()) for _, t in rows_of(three))
    mixed = four.collect()
    assert abs(sum(len(r["text"].split()) for r in mixed) - words) <= len({s for s in source.values()})
    assert all(r["n_chars"] == len(r["text"]) for r in mixed)
    texts = {}
    for i, t in rows_of(three):
        texts.setdefault(i, []).append(t or "")
    assert all(any(t == r["text"] or " ".join(t.split()).startswith(r["text"]) for t in texts[r["doc_id"]]) for r in mixed)

    five = cp.pack(spark, four, folder).collect()
    check(five, 4096)
    assert len(five) >= len(mixed)


def test_run_is_its_stages(spark, folder):
    out = cp.run(spark, folder).collect()
    assert out and check(out, 4096) >= 1 and [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "suffix_dedup", "mixing", "packing"]


def test_empty_documents(spark, make, tmp_path):
    make([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_near_duplicates_leave_no_large_table_behind(spark, make):
    import os

    from motolake.llm.common import scratch_dir

    folder = f"{scratch_dir(spark)}/motolake".removeprefix("file://")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    text = [f"w{j}" for j in range(60)]
    docs = make([(1, " ".join(text)), (2, " ".join([*text[:-1], "end"])), (3, "a b c d e f g")], clashes=False)
    out = cp.one_of_each_group(spark, docs, "")
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3]
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before}
    assert left <= {"jaccard-sizes", "jaccard-classes", "links"}
