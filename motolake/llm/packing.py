"""Best-fit packing of token sequences by the sum-of-squares rule.

Every document is tokenised whole, ends with ``end_id`` and is cut only where it is longer than
``capacity``. Pieces go to packing shards by a hash of their row's number; a shard places its pieces
from the longest to the shortest, each into that open bin for which the sum over gaps g of
(open bins with gap g) ** 2 becomes smallest, and opens a bin only if the piece fits in none. Shards
hold ``shard_docs`` documents on average, so a task's memory does not grow with the input, and each
shard wastes at most its last few bins.

Nulls and empty texts are documents of the single token ``end_id``. Repeated rows are packed as often
as they occur. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
import string
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motolake.llm.common import begin, cache, small_batches, wanted_parts

#: White space and capitals that the tokenizer and Python treat differently, and the marks of special tokens.
ODD = re.compile(r"[\x1c-\x1f\x85\xa0\u0130\u03a3\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]|<\|")

#: Those of them that are ASCII.
ODD_ASCII = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")
PUNCTUATION = string.punctuation


def odd(text: str) -> bool:
    """Whether a text holds any of them; a look for single strings is quicker where it will do."""
    return any(x in text for x in ODD_ASCII) if text.isascii() else ODD.search(text) is not None


def latin(text: str) -> bool:
    """Whether all characters lie below U+0100, where nothing composes; quicker than a look at their composition."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordTokenizer:
    """Token ids of texts by way of their words, for a tokenizer that lowers case and never joins text across white space.

    Words are remembered, in two generations of at most ``keep`` each. New words of letters are tokenised
    many at a time: a word's ids end with the one id that carries the end-of-word mark. A word with
    punctuation behind its letters is its letters and the punctuation. The tokenizer composes letters (NFC)
    before anything else, so texts are composed before they are parted into words; a text whose lower case
    would compose further, or in which lower case or white space could mean something else to the
    tokenizer, is tokenised whole.
    """

    _own: dict[str, WordTokenizer] = {}

    def __init__(self, path: str, keep: int = 450_000):
        from tokenizers import Tokenizer, normalizers

        self.tokenizer = Tokenizer.from_file(path)
        self.compose = normalizers.NFC()
        self.keep = keep
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        """The process's own, which outlives a task."""
        if path not in cls._own:
            cls._own[path] = cls(path)
        return cls._own[path]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Remember these words."""
        if len(self.young) > self.keep:
            self.old, self.young = self.young, {}
        known, old = self.young, self.old
        new = words.difference(known)
        for word in old.keys() & new:
            known[word] = old[word]
        fresh, tailed, rest = [], [], []
        for word in new.difference(old):
            if word.isalpha():
                fresh.append(word)
            elif (stem := word.rstrip(PUNCTUATION)).isalpha():
                tailed.append((word, stem, word[len(stem) :]))
            else:
                rest.append(word)
        stems, tails = {t[1] for t in tailed}, {t[2] for t in tailed}
        for part in (stems, tails):
            for word in old.keys() & part.difference(known):
                known[word] = old[word]
        fresh += stems.difference(known, fresh)
        rest += tails.difference(known, rest)
        for a in range(0, len(fresh), 1000):
            some = fresh[a : a + 1000]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            stops = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(stops) == len(some):
                raw, at = ids.tobytes(), 0
                for word, stop in zip(some, stops, strict=True):
                    known[word] = raw[at:stop]
                    at = stop
            else:
                rest += some
        for word in rest:
            known[word] = self.whole(word)
        for word, stem, tail in tailed:
            known[word] = known[stem] + known[tail]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for a in range(0, len(texts), 512):
            found: list[list[bytes | None] | bytes] = []
            gaps: list[tuple[int, list[str], list[int]]] = []
            find = self.young.get
            for i, text in enumerate(texts[a : a + 512]):
                if odd(text):
                    found.append(self.whole(text))
                    continue
                if latin(text):
                    words = text.lower().split()
                else:
                    if not unicodedata.is_normalized("NFC", text):
                        text = self.compose.normalize_str(text)  # its tables may be of another version than Python's
                    lower = text.lower()
                    if not unicodedata.is_normalized("NFC", lower):
                        found.append(self.whole(text))
                        continue
                    words = lower.split()
                ids = list(map(find, words))
                found.append(ids)
                if None in ids:
                    places = [k for k, x in enumerate(ids) if x is None]
                    gaps.append((i, [words[k] for k in places], places))
            self.learn(set().union(*(g[1] for g in gaps)))
            for i, words, places in gaps:
                for k, word in zip(places, words, strict=True):
                    found[i][k] = self.young[word]  # type: ignore[index]
            out += [x if isinstance(x, bytes) else b"".join(x) for x in found]  # type: ignore[arg-type]
        return out


cache(__name__, WordTokenizer._own.clear)


def cut(ids: bytes, end_id: int, capacity: int) -> Iterator[tuple[int, int, bytes]]:
    """(start, length, ids) of the pieces of one document."""
    ids += int(end_id).to_bytes(4, "little")
    n = len(ids) // 4
    for start in range(0, n, capacity):
        part = ids[4 * start : 4 * (start + capacity)]
        yield start, len(part) // 4, part


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, *, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, with keep_ids, token_ids (binary, little-endian u32)."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", token_ids binary" if keep_ids else "")

    def run(batches):
        import pyarrow as pa

        begin(__name__)
        tokenizer = WordTokenizer.of(tokenizer_path)
        for batch in batches:
            rows: list[tuple] = []
            encoded = tokenizer.encode_batch([t or "" for t in batch.column(1).to_pylist()])
            for doc, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                for k, (start, length, part) in enumerate(cut(ids, end_id, capacity)):
                    rows.append((doc, k, start, length, zlib.crc32(part), part))
            if rows:
                cols = list(zip(*rows, strict=True))
                arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:5])]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    arrays.append(pa.array(cols[5], pa.binary()))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return source.mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, in the given order.

    Moving a bin from gap g to g - s changes the sum of squares by 2 (N[g - s] - N[g]) + 2, or by
    1 - 2 N[g] if it becomes full, so the best gap is one look over the counts. Ties go to the
    smallest gap; of the bins of a gap the one opened last is filled first.
    """
    lengths = np.asarray(lengths, np.int64)
    if len(lengths) and (lengths.min() < 1 or lengths.max() > capacity):
        raise ValueError(f"a length is not between 1 and {capacity}")
    open_bins = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    never = np.int64(1) << 40
    made = 0
    for i, s in enumerate(lengths.tolist()):
        change = open_bins[: capacity - s].copy()
        best = -1
        if len(change):
            change[0] = 0
            held = open_bins[s:capacity]
            change -= held
            change[held == 0] = never
            best = int(change.argmin())
            if change[best] >= never:
                best = -1
        if best >= 0:
            gap = best + s
            at = stacks[gap].pop()
            open_bins[gap] -= 1
        else:
            gap, at = capacity, made
            made += 1
        bins[i], offsets[i] = at, capacity - gap
        if gap > s:
            stacks[gap - s].append(at)
            open_bins[gap - s] += 1
    return bins, offsets


def place(pieces: DataFrame, *, capacity: int = 4096, shards: int = 1, keep: tuple[str, ...] = ()) -> DataFrame:
    """Add sequence_id and offset to rows of (doc_id, piece, length); keep names further columns of pieces to carry.

    Sequence ids are unique over shards and leave numbers out between them.
    """
    cols = ["doc_id", "piece", "length", *keep]
    types = {f.name: f.dataType.simpleString() for f in pieces.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in cols) + ", sequence_id long, offset long"

    def run(table):
        import pyarrow as pa

        begin(__name__)
        shard = table.column("shard")[0].as_py()
        length = table.column("length").to_numpy()
        null = -(1 << 63)
        doc = table.column("doc_id").fill_null(null).to_numpy()
        order = np.lexsort((table.column("piece").to_numpy(), doc, -length))
        table = table.take(pa.array(order))
        bins, offsets = sum_of_squares(length[order], capacity)
        out = [table.column(c) for c in cols]
        return pa.Table.from_arrays([*out, pa.array(bins + (shard << 32)), pa.array(offsets)], [*cols, "sequence_id", "offset"])

    # by row, not by id: ids may be null or repeat
    shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard")
    return pieces.select(shard, *cols).groupBy("shard").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, *, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = 32_768, with_ids: bool = False) -> DataFrame:
    """One row per piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and token_ids)."""
    pieces = tokenize_pieces(docs, tokenizer_path, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col, keep_ids=with_ids)
    keep = ("start", "ids_crc32", *(("token_ids",) if with_ids else ()))
    return place(pieces, capacity=capacity, shards=wanted_parts(docs.select(id_col).count(), shard_docs), keep=keep)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
