"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, a function of its code point alone. A letter trigram binds
the vectors of its letters, permuted by two places, one place and none, by multiplication; a text bundles
(sums) the vectors of its trigrams; a language's prototype bundles its texts, each scaled to unit length
of its trigram counts. A document gets the language whose prototype has the largest cosine with it.
Whatever isn't a letter separates words and takes part as one boundary symbol.

Learning reads all labelled rows of the learning folds once and keeps one vector per language and task.
Prototypes (languages x ``dimensions`` doubles, ``max_languages`` checked) are all that is sent around.

Null texts, texts without a letter, and all texts if nothing could be learned are ``und`` with score 0.
Ties go to the language that sorts first. Repeated rows count as often as they occur in learning and are
repeated in the result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motolake.llm.common import begin, cache, held_out, small_batches

DIMENSIONS = 1024
SEED = 4
_letters: np.ndarray | None = None
_vectors: dict[tuple[int, int], np.ndarray] = {}


cache(__name__, _vectors.clear)


def letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _letters


def letter_vector(code: int, dimensions: int) -> np.ndarray:
    key = (code, dimensions)
    if key not in _vectors:
        if len(_vectors) > 20_000:
            _vectors.clear()
        _vectors[key] = (np.random.default_rng([SEED, code]).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1).astype(np.int8)
    return _vectors[key]


def bind(codes: np.ndarray, dimensions: int) -> np.ndarray:
    """Vectors of trigrams (rows of three code points)."""
    seen, place = np.unique(codes, return_inverse=True)
    table = np.stack([letter_vector(int(c), dimensions) for c in seen])
    place = place.reshape(codes.shape)
    return np.roll(table, 2, axis=1)[place[:, 0]] * np.roll(table, 1, axis=1)[place[:, 1]] * table[place[:, 2]]


def bundle(counts: np.ndarray, codes: np.ndarray, dimensions: int, step: int = 8192) -> np.ndarray:
    """Sums of trigrams' vectors by counts (rows x trigrams), some trigrams at a time."""
    out = np.zeros((len(counts), dimensions), np.float32)
    for a in range(0, len(codes), step):
        out += counts[:, a : a + step] @ bind(codes[a : a + step], dimensions).astype(np.float32)
    return out


def trigram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts): the trigrams that occur, and how often in each text (texts x trigrams, float32)."""
    none = np.zeros((0, 3), np.int64), np.zeros((len(texts), 0), np.float32)
    lowered = [t.lower() for t in texts]
    raw = np.frombuffer(("\n".join(["", *lowered, ""])).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts) + 1), [1, *(len(t) + 1 for t in lowered)]) if texts else np.zeros(0, np.int64)
    row = row[: len(raw)]
    raw = np.where(letters()[np.minimum(raw, 0x10FFFF)], raw, 0)
    kept = np.flatnonzero((raw != 0) | np.concatenate(([True], raw[:-1] != 0)))
    codes, row = raw[kept], row[kept]
    middle = np.flatnonzero(codes[1:-1] != 0) + 1
    if not len(middle):
        return none
    symbols, place = np.unique(codes, return_inverse=True)
    size = len(symbols)
    triple = (place[middle - 1] * size + place[middle]) * size + place[middle + 1]
    if size**3 <= 1 << 22:
        present = np.flatnonzero(np.bincount(triple, minlength=size**3))
        index = np.zeros(size**3, np.int64)
        index[present] = np.arange(len(present))
        column = index[triple]
    else:
        present, column = np.unique(triple, return_inverse=True)
    text = row[middle] - 1
    counts = np.bincount(text * len(present) + column, minlength=len(texts) * len(present)).reshape(len(texts), len(present)).astype(np.float32)
    return np.stack([symbols[present // size // size], symbols[present // size % size], symbols[present % size]], axis=1), counts


def parts(texts: list[str], rows: int = 256, cells: int = 1 << 24) -> Iterator[tuple[int, int]]:
    """Runs of texts whose number times their characters, which bounds the cells of their table of trigrams, stays below cells; a text of more is a run."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if i > start and (i - start >= rows or (i + 1 - start) * (held + len(t)) > cells):
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def learn_prototypes(rows: DataFrame, *, dimensions: int = DIMENSIONS, max_languages: int = 10_000) -> tuple[list[str], np.ndarray]:
    """(languages, prototypes) from rows of (text, lang); null languages and texts are left out."""
    small_batches(rows.sparkSession)

    def gather(batches):
        import pyarrow as pa

        begin(__name__)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in parts(texts):
                codes, counts = trigram_counts(texts[a:b])
                if not len(codes):
                    continue
                counts /= np.maximum(np.sqrt((counts**2).sum(1, keepdims=True)), 1e-9)
                names, place = np.unique(np.array(langs[a:b], object).astype(str), return_inverse=True)
                own = np.zeros((len(names), counts.shape[1]), np.float32)
                np.add.at(own, place, counts)
                made = bundle(own, codes, dimensions)
                for name, vector in zip(names.tolist(), made, strict=True):
                    if name in sums:
                        sums[name] += vector
                    else:
                        sums[name] = vector.astype(np.float64)
            if len(sums) > 256:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()])], ["lang", "vector"])
                sums = {}
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()])], ["lang", "vector"])

    def add(table):
        import pyarrow as pa

        begin(__name__)
        total = np.sum(np.stack(table.column("vector").to_pylist()), axis=0)
        return pa.table({"lang": table.column("lang")[:1], "salt": table.column("salt")[:1], "vector": pa.array([total.tolist()])})

    schema = "lang string, salt int, vector array<double>"
    partial = rows.filter("text is not null and lang is not null").select("text", "lang").mapInArrow(gather, "lang string, vector array<double>")
    for salts in (64, 1):  # a language that holds most rows is added up in two rounds
        partial = partial.withColumn("salt", (F.spark_partition_id() % salts).cast("int")).select("lang", "salt", "vector").groupBy("lang", "salt").applyInArrow(add, schema)
    found = partial.select("lang", "vector").limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    found = sorted((r["lang"], r["vector"]) for r in found)
    return [f[0] for f in found], np.array([f[1] for f in found], np.float64).reshape(len(found), dimensions)


def cosines(texts: list[str], prototypes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosine of each text with each prototype, and whether the text has a letter."""
    codes, counts = trigram_counts(texts)
    if not len(codes):
        return np.zeros((len(texts), len(prototypes))), np.zeros(len(texts), bool)
    bundles = bundle(counts, codes, prototypes.shape[1])
    length = np.sqrt((bundles.astype(np.float64) ** 2).sum(1))
    unit = prototypes / np.maximum(np.sqrt((prototypes**2).sum(1, keepdims=True)), 1e-12)
    return bundles @ unit.T / np.maximum(length, 1e-12)[:, None], counts.any(1)


def identify(docs: DataFrame, languages: list[str], prototypes: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (the cosine, at least 0)."""

    def run(batches):
        import pyarrow as pa

        begin(__name__)
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in parts(texts):
                if languages:
                    near, known = cosines(texts[a:b], prototypes)
                    best = near.argmax(1)
                    names = [languages[i] if k else "und" for i, k in zip(best, known, strict=True)]
                    score = np.where(known, np.clip(near[np.arange(b - a), best], 0, 1), 0.0)
                else:
                    names, score = ["und"] * (b - a), np.zeros(b - a)
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(names), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op4_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    languages, prototypes = learn_prototypes(docs.filter(~held_out("doc_id")).select("text", "lang"))
    return identify(docs, languages, prototypes).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
