"""Corpus pipeline: stages over documents, each of which applies a training-data operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next
one's docs. All but the last return the columns of documents: doc_id, text, lang, source, n_chars. Other
columns of the input are dropped by the first stage.

Rows whose id is null or stands in several rows are documents of their own in every stage. Null and empty
texts aren't toxic, have no near duplicates and no passages; mixing, which draws words, draws none of
theirs. Mixing repeats and cuts documents, so ids repeat from there on. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motolake.llm import jaccard, mixing, packing, suffix_dedup, toxicity
from motolake.llm.common import materialize, with_row_ids

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below one half; null texts have nothing toxic and stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model, curve = toxicity.fit(docs, labels)
    values = toxicity.differences(docs, model, keep=COLUMNS[1:])
    return values.filter(toxicity.score_of(curve) < 0.5).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    docs, own = with_row_ids(docs.select(*COLUMNS))
    groups = jaccard.near_duplicates(docs, id_col=own)
    others = groups.filter("component_id <> doc_id").select(F.col("doc_id").alias("other"))
    return docs.join(others, docs[own] == F.col("other"), "left_anti").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand earlier already; a document of which nothing is left goes.

    Characters of which only some bytes repeat go whole. Documents without a repeat come back as they were, null and empty ones too.
    """
    docs, own = with_row_ids(docs.select(*COLUMNS))
    docs = docs.select(F.col(own).alias("own_id"), F.col("doc_id").alias("old_id"), "text", "lang", "source")
    found = suffix_dedup.remove_repeats(docs, id_col="own_id", kept="text", keep=("old_id", "lang", "source")).filter("n_removed = 0 or n_removed < n_bytes")
    return found.select(F.col("old_id").alias("doc_id"), F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's documents, written by shard and shuffled inside it: a document as often as the mixture takes it, the last of a target cut to the words taken."""
    out = mixing.mixture(docs, keep=("lang", "source"))
    return out.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens: a row per piece of a document with its place."""
    import public_tokenizers

    packed = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", one_of_each_group), ("suffix_dedup", cut_repeats), ("mixing", mix_sources), ("packing", pack)]

#: Tokens and language models are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
