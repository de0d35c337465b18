"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is a stream of words: its documents in the order of a hash, one after another, over and
over. A source's target is a number of words of that stream, cut into blocks of ``block_words``; the
numbers of blocks are its exact quota. A binary tree splits the vector of quotas among output shards:
a node that has n block slots for its left half draws the left half's vector from the multivariate
hypergeometric distribution, from a generator seeded by the node, so any task can walk to a shard
without the rest of the tree. Inside a source the blocks are permuted by a seeded bijection; the place
of a block in the permutation decides by which child it goes down at each node. Shards are thus
disjoint, use every block once and keep the mixture in proportion. Inside a shard blocks are shuffled
by a hash. ``mixture`` writes a document's turn to the shard of the block it begins in, in the order of
that shard's blocks. Numbers of blocks stay below 2^28, where numpy's hypergeometric draws are exact: larger mixtures have
blocks of twice as many words, or four times and so on.

Positions in a stream come from two-level prefix sums: over buckets of a source's documents, then inside
each bucket, so that a source that holds most rows is spread over many tasks. Only a vector with an entry
per source is sent to the executors; ``max_sources`` is its checked bound.

Null texts and texts without words have size 0 and are taken 0 times. Null is a source of its own, the
last. Rows whose id is null or stands in several rows each have a place of their own, by a number in the order of id and text.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motolake.llm.common import begin, dealt, materialize, wanted_parts, with_row_ids

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, key (a unique id), source, size in words."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(source_col).cast("string").alias("source"))
    docs, key = with_row_ids(docs)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", F.col(key).alias("key"), "source", size.alias("size"))


def water_fill(totals: list[int], weights: list[int], repeats: int) -> list[tuple[int, int]]:
    """Targets as fractions: each the weight's share of all words, at most repeats times its total, the excess shared again by weight."""
    target: list[tuple[int, int] | None] = [None] * len(totals)
    left, share = sum(totals), sum(weights)
    open_ = [i for i in range(len(totals))]
    while open_:
        over = [i for i in open_ if weights[i] * left > repeats * totals[i] * share]
        if not over:
            for i in open_:
                target[i] = (weights[i] * left, share)
            break
        for i in over:
            target[i] = (repeats * totals[i], 1)
        left -= sum(repeats * totals[i] for i in over)
        share -= sum(weights[i] for i in over)
        open_ = [i for i in open_ if target[i] is None]
    return target  # type: ignore[return-value]


def targets(sized: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, repeats: int = 3, max_sources: int = 100_000) -> list[dict]:
    """Per source, by code point with null last: source, total, target (double) and words (target rounded)."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("total")).limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    totals = [int(r["total"]) for r in rows]
    filled = water_fill(totals, [weights[i % len(weights)] for i in range(len(rows))], repeats)
    return [{"source": r["source"], "total": t, "target": a / b, "words": min((2 * a + b) // (2 * b), repeats * t)} for r, t, (a, b) in zip(rows, totals, filled, strict=True)]


class SplittingTree:
    """Quotas of blocks per source, split among shards of equal numbers of slots (the first ones get one more)."""

    def __init__(self, quotas: list[int], shards: int, seed: int = 0):
        self.root = tuple(int(q) for q in quotas)
        self.shards, self.seed = shards, seed
        self.slots = sum(self.root)
        self.drawn: dict[tuple[int, int], tuple[tuple[int, ...], tuple[int, ...]]] = {}

    def before(self, shard: int) -> int:
        """Slots of all shards before this one."""
        return shard * (self.slots // self.shards) + min(shard, self.slots % self.shards)

    def split(self, low: int, high: int, counts: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """What the left and the right half of shards low..high get of counts."""
        key = (low, high)
        if key not in self.drawn:
            if len(self.drawn) > max(64, (1 << 22) // (len(counts) + 1)):
                self.drawn.clear()
            middle = (low + high) // 2
            take, rest = self.before(middle) - self.before(low), sum(counts)
            rng = np.random.default_rng([self.seed, low, high])
            out = []
            for c in counts:  # one hypergeometric draw after another gives the multivariate one
                x = int(rng.hypergeometric(c, rest - c, take)) if c and take else 0
                out.append(x)
                take, rest = take - x, rest - c
            self.drawn[key] = tuple(out), tuple(c - x for c, x in zip(counts, out, strict=True))
        return self.drawn[key]

    def walk(self, source: int, rank: int) -> int:
        """Shard of the block that stands at rank in its source's permutation."""
        low, high, counts = 0, self.shards, self.root
        while high - low > 1:
            left, right = self.split(low, high, counts)
            middle = (low + high) // 2
            if rank < left[source]:
                high, counts = middle, left
            else:
                rank -= left[source]
                low, counts = middle, right
        return low

    def quota(self, shard: int) -> tuple[int, ...]:
        """Blocks of each source in a shard."""
        low, high, counts = 0, self.shards, self.root
        while high - low > 1:
            middle = (low + high) // 2
            left, right = self.split(low, high, counts)
            low, high, counts = (low, middle, left) if shard < middle else (middle, high, right)
        return counts


def permuted(index: int, size: int, seed: str) -> int:
    """A bijection of range(size): a four-round Feistel network that walks its cycle until it is back in range."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        a, b = index >> half, index & mask
        for r in range(4):
            a, b = b, a ^ (int.from_bytes(hashlib.blake2b(f"{seed}/{r}/{b}".encode(), digest_size=8).digest(), "little") & mask)
        index = a << half | b
        if index < size:
            return index


def stream_places(sized: DataFrame, bucket_docs: int = 4096) -> DataFrame:
    """doc_id, key, source, size and place: the words of the source's documents before this one in the order of md5(key)."""
    digest = F.md5(F.col("key").cast("string").cast("binary"))
    bits = max(0, (wanted_parts(sized.count(), bucket_docs) - 1).bit_length())
    hexes = -(-bits // 4)
    docs = sized.withColumn("digest", digest).withColumn("bucket", F.substring("digest", 1, hexes) if hexes else F.lit(""))
    heads = docs.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    heads = heads.select("source", "bucket", (F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket")) - F.col("bucket_size")).alias("base"))
    inner = Window.partitionBy("source", "bucket").orderBy("digest", "key").rowsBetween(Window.unboundedPreceding, 0)
    placed = docs.withColumn("upto", F.sum("size").over(inner))
    same = placed["source"].eqNullSafe(heads["source"]) & (placed["bucket"] == heads["bucket"])
    return placed.join(heads, same).select("doc_id", "key", placed["source"], "size", (F.col("base") + F.col("upto") - F.col("size")).alias("place"))


def block_plan(plan: list[dict], block_words: int, shard_blocks: int, max_blocks: int = 1 << 28) -> tuple[int, list[int], int]:
    """(words of a block, blocks of each source, shards)."""
    while sum(-(-p["words"] // block_words) for p in plan) > max_blocks:
        block_words *= 2
    quotas = [-(-p["words"] // block_words) for p in plan]
    return block_words, quotas, wanted_parts(sum(quotas), shard_blocks)


def draw_blocks(spark, plan: list[dict], *, block_words: int = 4096, shard_blocks: int = 256, seed: int = 0) -> DataFrame:
    """The mixture: source_index, block, first_word and words in the source's stream, shard, and order inside the shard."""
    block_words, quotas, shards = block_plan(plan, block_words, shard_blocks)
    words = [p["words"] for p in plan]

    def run(batches):
        import pyarrow as pa

        begin(__name__)
        tree = SplittingTree(quotas, shards, seed)
        ends = np.cumsum(quotas)
        for batch in batches:
            at = batch.column(0).to_numpy()
            source = np.searchsorted(ends, at, side="right")
            block = at - (ends[source] - np.array(quotas)[source])
            rank = [permuted(b, quotas[s], f"{seed}/{s}") for s, b in zip(source.tolist(), block.tolist(), strict=True)]
            shard = [tree.walk(s, r) for s, r in zip(source.tolist(), rank, strict=True)]
            order = [int.from_bytes(hashlib.blake2b(f"{seed}/{s}/{b}".encode(), digest_size=7).digest(), "little") for s, b in zip(source.tolist(), block.tolist(), strict=True)]
            first = block * block_words
            last = np.minimum(first + block_words, np.array(words, np.int64)[source])
            yield pa.RecordBatch.from_arrays([pa.array(source, pa.int32()), pa.array(block, pa.int64()), pa.array(first, pa.int64()), pa.array(last - first, pa.int64()), pa.array(shard, pa.int64()), pa.array(order, pa.int64())], ["source_index", "block", "first_word", "words", "shard", "shard_order"])

    total = sum(quotas)
    slots = spark.range(0, total, 1, wanted_parts(total, 65_536)) if total else spark.range(0)
    return slots.mapInArrow(run, "source_index int, block long, first_word long, words long, shard long, shard_order long")


def draw(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, repeats: int = 3, block_words: int = 4096, shard_blocks: int = 256, seed: int = 0) -> tuple[DataFrame, DataFrame, int]:
    """What mix returns, and the number of shards."""
    spark = docs.sparkSession
    sized = materialize(sizes(docs, id_col, text_col, source_col), "mix-sizes")
    plan = targets(sized, weights=weights, repeats=repeats)
    table = spark.createDataFrame([(i, p["source"], p["total"], p["target"], p["words"]) for i, p in enumerate(plan)], "source_index int, source string, source_size long, target double, quota long")
    placed = stream_places(sized)
    placed = placed.join(F.broadcast(table), placed["source"].eqNullSafe(table["source"])).select("doc_id", "key", placed["source"], "size", "source_size", "target", "place", "source_index", "quota")
    placed = materialize(placed, "mix-places")
    block_words, _, shards = block_plan(plan, block_words, shard_blocks)
    blocks = draw_blocks(spark, plan, block_words=block_words, shard_blocks=shard_blocks, seed=seed)
    start = F.col("epoch") * F.col("source_size") + F.col("place")
    stop = F.least(start + F.col("size"), F.col("quota"))
    turns = placed.filter("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn("start", start).withColumn("stop", stop).filter("start < stop")
    width = F.lit(block_words)
    turns = turns.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("stop") - 1) / width))))
    parts = turns.select("doc_id", "key", "source_index", "place", "epoch", "block", "start", "stop").join(blocks.hint("merge"), ["source_index", "block"])
    low, high = F.greatest("start", "first_word"), F.least(F.col("stop"), F.col("first_word") + F.col("words"))
    draws = parts.select("doc_id", "key", "source_index", "place", "epoch", (low - F.col("start")).alias("from_word"), (high - low).alias("n_words"), "block", "shard", "shard_order")
    return placed, draws, shards


def mix(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(documents, draws); options are those of draw.

    documents: doc_id, key, source, size, source_size, target, place in the source's stream.
    draws: a row for each part of a document that a block takes: doc_id, key, source_index, place, epoch, from_word, n_words, block, shard, shard_order.
    """
    return draw(docs, **options)[:2]


def mixture(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), partition_shards: int = 2, **options) -> DataFrame:
    """The mixed documents: id, text, columns to keep, shard, epoch; rows stand by shard, inside it in the order of its blocks.

    A document stands as often as the mixture takes it, whole, in the shard of the block it begins in; the
    one at a target's end is cut to the words taken, parted by single spaces.
    """
    docs, own = with_row_ids(docs.select(id_col, text_col, *keep), id_col, text_col)
    documents, draws, shards = draw(docs, id_col=own, text_col=text_col, **options)
    turns = draws.groupBy("key", "epoch").agg(F.sum("n_words").alias("n_words"), F.min_by(F.struct("shard", "shard_order"), "block").alias("at"))
    turns = turns.join(documents.filter("size > 0").select("key", "size", "place"), "key")
    words = F.filter(F.split(text_col, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.when(F.col("n_words") < F.col("size"), F.array_join(F.slice(words, 1, F.col("n_words").cast("int")), " ")).otherwise(F.col(text_col))
    rows = docs.join(turns, docs[own] == turns["key"]).select(id_col, text.alias(text_col), *keep, "epoch", "place", F.col("at.shard").alias("shard"), F.col("at.shard_order").alias("shard_order"))
    rows = dealt(rows.withColumn("part", F.floor(F.col("shard") / partition_shards).cast("int")), wanted_parts(shards, partition_shards))
    return rows.sortWithinPartitions("shard", "shard_order", "epoch", "place").select(id_col, text_col, *keep, "shard", "epoch")


def taken(documents: DataFrame, draws: DataFrame) -> DataFrame:
    """documents with taken: the words that the mixture takes of each, repeats counted."""
    per_doc = draws.groupBy("key").agg(F.sum("n_words").alias("n_taken"))
    full, empty = documents.filter("size > 0"), documents.filter("size = 0")
    full = full.join(per_doc, "key", "left").withColumn("taken", F.coalesce("n_taken", F.lit(0)).cast("long"))
    return full.drop("n_taken").unionByName(empty.withColumn("taken", F.lit(0).cast("long")))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    documents, draws = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return taken(documents, draws).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS total, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM sized GROUP BY source),
w AS (SELECT source, total, i, CASE CAST(i % 3 AS INT) WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM src),
r AS (
  SELECT *, 3 * total / weight AS ratio,
    coalesce(sum(3 * total) OVER o, 0) AS capped, coalesce(sum(weight) OVER o, 0) AS gone, sum(total) OVER () AS everything, sum(weight) OVER () AS all_weight
  FROM w WINDOW o AS (ORDER BY 3 * total / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first_open AS (
  SELECT CAST(everything - capped AS DOUBLE) AS left_words, CAST(all_weight - gone AS DOUBLE) AS left_weight FROM r
  WHERE (everything - capped) * weight <= 3 * total * (all_weight - gone) ORDER BY ratio, i LIMIT 1),
t AS (
  SELECT source, total, CASE WHEN left_words IS NULL OR weight * left_words > 3.0 * total * left_weight THEN CAST(3 * total AS DOUBLE) ELSE weight * left_words / left_weight END AS target
  FROM w LEFT JOIN first_open ON true),
placed AS (
  SELECT s.doc_id, s.size, t.total, t.target, least(CAST(floor(t.target + 0.5) AS BIGINT), 3 * t.total) AS quota,
    CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(CAST(s.doc_id AS VARCHAR)), s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - s.size AS place
  FROM sized s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, total AS source_size, target,
  CAST((CASE WHEN total = 0 THEN 0 ELSE (quota // total) * size + greatest(0, least(size, quota % total - place)) END) AS BIGINT) AS taken
FROM placed
"""
