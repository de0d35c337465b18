"""N-gram Jaccard join: exact links by a blocked sparse product of the document by n-gram incidence.

A document's set is its distinct shingles of five words (fewer words: all of them as one), as 64-bit
hashes. Two documents link when their Jaccard similarity is at least ``percent`` %.

1. Columns that only one document has can't add to an overlap. Documents come in batches; a column that
   several documents of a batch have is shared, and announced once; of the others each block of columns,
   chosen by hash, counts the documents, and replies to the batches. A document of n shingles of which fewer than percent % of n are
   shared has no link and is discarded. Equal sets are found by fingerprint here and go on as one.
2. The same again between the different sets that are left; each batch is told how many of them hold
   each of its columns.
3. A set's prefix is its n - ceil(percent n / 100) + 1 rarest shingles, by these counts; two sets
   that link share one of their prefixes, and the sizes of two sets that link differ by percent at most. Runs of
   sets with compatible sizes in a prefix column join into clusters; sets in different clusters don't
   link.
4. In a cluster the product is taken row by row, adding up overlaps over the columns of a row with the rows
   whose size can link, until all rows not yet taken are in one component: links inside a component need
   no look. Pairs below the overlap that their sizes ask for are discarded. Clusters of more
   shingles than ``cluster_shingles`` are cut into blocks of rows, and each pair of blocks is a task; a
   wave of tasks copies each row ``copies`` times at most, fewer if that is more text than all documents
   have (but 2), and is over before the next one starts.
5. Components of the links found are those of all links.

Every step's tasks have bounded numbers of shingles, and nothing that grows is sent to all tasks. Stored are
texts, of which tasks make the sets again: their hashes would take twice the disk of the compressed texts.

Null texts and texts without words have an empty set and link with nothing. Rows whose id is null or
stands in several rows are documents of their own, with their own set and links; a component's id is the
smallest id of its rows, null if all are null. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motolake.llm.common import ODD, PrefixHash, begin, dealt, joined, materialize, mix64, release, segmented_arange, small_batches, wanted_parts, with_row_ids
from motolake.llm.components import connected_components

SHINGLE = 5
BLOCK_BYTES = 24 << 20


# ---------------------------------------------------------------- sets
def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts joined at offsets, and each text's number of words; A-Z count as a-z."""
    upper = (data >= 65) & (data <= 90)
    data = data + upper.astype(np.uint8) * np.uint8(32)
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    end = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    counts = np.diff(np.searchsorted(start, offsets))
    if not len(start):
        return np.zeros(0, np.uint64), counts
    return PrefixHash(data).of(start, end), counts


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, counts = word_hashes(data, offsets)
    factors = mix64(np.arange(1, size + 1, dtype=np.uint64) * ODD) | np.uint64(1)
    n = len(words)
    rolled = np.zeros(max(n - size + 1, 0), np.uint64)
    for k in range(size):
        rolled += words[k : n - size + 1 + k] * factors[k] if len(rolled) else rolled
    rolled = mix64(rolled)
    out, at = [], 0
    for c in counts.tolist():
        if c >= size:
            out.append(np.unique(rolled[at : at + c - size + 1]))
        elif c:
            own = words[at : at + c] * factors[:c]
            out.append(mix64(own.sum(keepdims=True, dtype=np.uint64) + np.uint64(c)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def batches_of(column, ids, most: int = 1 << 20):
    """(ids, sets) of runs of rows with a bounded number of bytes."""
    data, offsets = joined(column)
    a = 0
    while a < len(ids):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield ids[a:b], shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        a = b


#: What a batch says of each of its documents: fingerprint and size of its set, and how many of its columns other documents of the batch have too.
DOCUMENT = np.dtype([("id", "<i8"), ("hi", "<i8"), ("lo", "<i8"), ("n", "<i4"), ("local", "<i4")])
SEVERAL = np.dtype([("key", "<u4"), ("n", "<u4")])


class Announced:
    """Columns that a task has announced as held by several documents; a bounded number is remembered."""

    def __init__(self, keep: int = 1 << 19):
        self.keep, self.known = keep, np.zeros(0, np.uint64)

    def new(self, tokens: np.ndarray) -> np.ndarray:
        """Which of these are not remembered; they are from now on."""
        fresh = ~np.isin(tokens, self.known)
        self.known = np.union1d(self.known, tokens) if len(self.known) + len(tokens) <= self.keep else tokens
        return fresh


def narrow(values: np.ndarray) -> bytes:
    """Numbers from 0 in as few bytes each as the largest needs, which the first byte tells."""
    most = int(values.max()) if len(values) else 0
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def wide(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int64)


def gaps(rows: np.ndarray) -> bytes:
    """Ascending row numbers: a byte each, however many blocks a document's columns are dealt to."""
    return narrow(np.diff(rows, prepend=0))


def from_gaps(blob: bytes) -> np.ndarray:
    return np.cumsum(wide(blob))


def pieces(values: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
    """values cut into runs of these lengths."""
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    return [values[e - n : e] for e, n in zip(ends, lengths, strict=True)]


def split_columns(ids: np.ndarray, sets: list[np.ndarray], parts: int, batch: int, prints: list[bytes] | None = None, announced: Announced | None = None) -> list[tuple[int, bytes, bytes, bytes, bytes, bytes, int]]:
    """(part, ids, counts, keys, several, documents, batch) of each block of columns, as split_rows gives them."""
    out = []
    for p, rows, keys, several, documents, number in split_rows(ids, sets, parts, batch, prints, announced):
        here, counts = np.unique(from_gaps(rows), return_counts=True)
        out.append((p, ids[here].astype("<i8").tobytes(), counts.astype("<i4").tobytes(), keys, several, documents, number))
    return out


def split_rows(ids: np.ndarray, sets: list[np.ndarray], parts: int, batch: int, prints: list[bytes] | None = None, announced: Announced | None = None) -> list[tuple[int, bytes, bytes, bytes, bytes, int]]:
    """(part, rows, keys, several, documents, batch) of each block of columns; rows are places in the batch, one for each key.

    A column that several documents of the batch have is shared whatever other batches hold, so it is not
    sent a document: it goes once, with their number, and with ``announced`` only once a task. What the
    batch says of its documents goes to one block, another for each batch.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), sizes)
    distinct, place, height = np.unique(tokens, return_inverse=True, return_counts=True)
    alone = height[place] == 1
    about = np.zeros(len(sets), DOCUMENT)
    about["id"], about["n"] = ids, sizes
    about["local"] = np.bincount(row[~alone], minlength=len(sets))
    if prints:
        about["hi"], about["lo"] = np.frombuffer(b"".join(prints), "<i8").reshape(-1, 2).T
    several, many = distinct[height > 1], height[height > 1]
    if announced is not None:
        fresh = announced.new(several)
        several, many = several[fresh], many[fresh]
    tokens, row = tokens[alone], row[alone]

    def by_part(values, *others):
        part = (values % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        return np.searchsorted(part[order], np.arange(parts + 1)), values[order], *(o[order] for o in others)

    bounds, tokens, row = by_part(tokens, row)
    ends, several, many = by_part(several, many)
    home = int(mix64(np.array([batch], np.uint64))[0] % np.uint64(parts))
    out = []
    for p in range(parts):
        a, b = bounds[p], bounds[p + 1]
        c, d = ends[p], ends[p + 1]
        if a == b and c == d and p != home:
            continue
        both = np.zeros(d - c, SEVERAL)
        both["key"], both["n"] = several[c:d] >> np.uint64(32), many[c:d]
        out.append((p, gaps(row[a:b]), (tokens[a:b] >> np.uint64(32)).astype("<u4").tobytes(), both.tobytes(), about.tobytes() if p == home else b"", batch))
    return out


COLUMNS = "part int, ids binary, counts binary, keys binary, several binary, documents binary, batch long"


ROWS = "part int, rows binary, keys binary, several binary, documents binary, batch long"


def arrow_rows(rows: list[tuple], schema: str):
    """Tuples as an Arrow batch of a schema of numbers and bytes."""
    import pyarrow as pa

    names = [x.split() for x in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(names)], [n for n, _ in names])


def record(rows: list[tuple]):
    import pyarrow as pa

    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["part", "ids", "counts", "keys", "several", "documents", "batch"])


def batch_numbers():
    """Numbers that no other task of the stage gives, the same when the task runs again."""
    from pyspark import TaskContext

    task = TaskContext.get()
    return itertools.count((task.partitionId() if task else 0) << 32)


def from_buffers(column, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def column_heights(keys: np.ndarray, number: np.ndarray) -> np.ndarray:
    """For each place the sum of the numbers at all places of its key."""
    order = np.argsort(keys, kind="stable")
    in_order = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = in_order[1:] != in_order[:-1]
    first = np.flatnonzero(new)
    height = np.add.reduceat(number[order], first) if len(first) else np.zeros(0, np.int64)
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(height, np.diff(np.append(first, len(keys))))
    return out


def count_shared(columns: DataFrame, parts: int) -> DataFrame:
    """Replies of blocks of columns to batches: batch, rows (the documents of columns that their batch holds once and other batches hold too), documents."""

    def run(table):
        import pyarrow as pa

        begin(__name__)
        row_blobs, key_blobs = table.column("rows").to_pylist(), table.column("keys").to_pylist()
        keys, several = np.frombuffer(b"".join(key_blobs), "<u4"), from_buffers(table.column("several"), SEVERAL)
        every = np.concatenate([keys, several["key"]])
        number = np.concatenate([np.ones(len(keys), np.int64), several["n"].astype(np.int64)])
        shared = pieces(column_heights(every, number)[: len(keys)] > 1, [len(x) // 4 for x in key_blobs])
        out = [gaps(from_gaps(x)[on]) for x, on in zip(row_blobs, shared, strict=True)]
        return pa.table({"batch": table.column("batch"), "rows": pa.array(out, pa.binary()), "documents": table.column("documents")})

    return dealt(columns, parts).groupBy("part").applyInArrow(run, "batch long, rows binary, documents binary")


def add_shared(replies: DataFrame, parts: int) -> DataFrame:
    """doc_id, shared, size, hi, lo of every document of the batches."""

    def run(table):
        import pyarrow as pa

        begin(__name__)
        rows = np.concatenate([from_gaps(x) for x in table.column("rows").to_pylist()])
        about = from_buffers(table.column("documents"), DOCUMENT)
        total = about["local"] + np.bincount(rows, minlength=len(about))
        return pa.table({"doc_id": pa.array(about["id"]), "shared": pa.array(total), "size": pa.array(about["n"].astype(np.int64)), "hi": pa.array(about["hi"]), "lo": pa.array(about["lo"])})

    return replies.repartition(parts, "batch").groupBy("batch").applyInArrow(run, "doc_id long, shared long, size long, hi long, lo long")


# ---------------------------------------------------------------- prefixes
COUNTS = "part int, batch long, piece long, keys binary, counts binary, ids binary"
LEVELS = "part int, batch long, piece long, levels binary, ids binary"
KEPT = "doc_id long, size long, prefix binary"


def levels_of(height: np.ndarray) -> np.ndarray:
    """How frequent a column is, as a byte: exact up to 128, eighths of a power of two beyond."""
    return np.minimum(np.where(height <= 128, height, 128 + 8 * np.log2(np.maximum(height, 128) / 128)), 255).astype(np.uint8)


def columns_in_order(sets: list[np.ndarray], parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Distinct columns of sets, in how many of them each is, their order by block, and the bounds of the blocks in that order."""
    distinct, counts = np.unique(np.concatenate(sets), return_counts=True)
    part = (distinct % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return distinct, counts, order, np.searchsorted(part[order], np.arange(parts + 1)).tolist()


def count_columns(ids: np.ndarray, sets: list[np.ndarray], parts: int, batch: int) -> list[tuple[int, int, int, bytes, bytes, bytes]]:
    """(part, batch, piece, keys, counts, ids) of each block of columns that these sets, a piece of a batch named by its first id, have. The first block gets the ids, whose order the levels of the reply follow."""
    distinct, counts, order, ends = columns_in_order(sets, parts)
    keys, counts = (distinct[order] >> np.uint64(32)).astype("<u4"), counts[order]
    out = [(p, batch, int(ids[0]), keys[a:b].tobytes(), narrow(counts[a:b]), b"") for p, (a, b) in enumerate(itertools.pairwise(ends)) if a < b]
    return [(*out[0][:-1], ids.astype("<i8").tobytes()), *out[1:]]


def column_levels(columns: DataFrame, parts: int) -> DataFrame:
    """Replies of blocks of columns to batches: the level of each key that a piece has sent, in its order."""

    def run(table):
        import pyarrow as pa

        begin(__name__)
        blobs = table.column("keys").to_pylist()
        number = np.concatenate([wide(x) for x in table.column("counts").to_pylist()])
        level = levels_of(column_heights(np.frombuffer(b"".join(blobs), "<u4"), number))
        replies = [x.tobytes() for x in pieces(level, [len(x) // 4 for x in blobs])]
        return pa.table({"part": table.column("part"), "batch": table.column("batch"), "piece": table.column("piece"), "levels": pa.array(replies, pa.binary()), "ids": table.column("ids")})

    return dealt(columns, parts).groupBy("part").applyInArrow(run, LEVELS)


def prefix_of(tokens: np.ndarray, level: np.ndarray, percent: int) -> np.ndarray | None:
    """The rarest tokens of a set, one of which every set that links with it has among its own rarest; tokens of no other set are left out. None if too few are shared for a link."""
    n = len(tokens)
    if 100 * int((level > 1).sum()) < percent * n:
        return None
    order = np.lexsort((tokens, level))[: n - -(-percent * n // 100) + 1]
    return tokens[order[level[order] > 1]]


def sets_of(texts) -> list[np.ndarray]:
    """Sets of a column of texts."""
    ids = np.arange(len(texts))
    return [s for _, sets in batches_of(texts, ids) for s in sets]


def kept_sets(texts: DataFrame, levels: DataFrame, parts: int, percent: int) -> DataFrame:
    """doc_id, size, prefix of the documents (doc_id, batch, text) whose sets can link."""

    def run(left, right):
        import pyarrow as pa

        begin(__name__)
        sets = dict(zip(left.column("doc_id").to_pylist(), sets_of(left.column("text")), strict=True))
        replies: dict[int, list[tuple[int, bytes]]] = {}
        ids: dict[int, list[int]] = {}
        for part, piece, level, blob in zip(*(right.column(x).to_pylist() for x in ("part", "piece", "levels", "ids")), strict=True):
            replies.setdefault(piece, []).append((part, level))
            if blob:
                ids[piece] = np.frombuffer(blob, "<i8").tolist()
        out = []
        for piece, got in replies.items():
            distinct, _, order, _ = columns_in_order([sets[i] for i in ids[piece]], parts)
            level = np.empty(len(distinct), np.uint8)
            level[order] = np.frombuffer(b"".join(x for _, x in sorted(got)), np.uint8)
            for i in ids[piece]:
                prefix = prefix_of(sets[i], level[np.searchsorted(distinct, sets[i])], percent)
                if prefix is not None:
                    out.append((i, len(sets[i]), prefix.astype("<u8").tobytes()))
        return pa.Table.from_batches([arrow_rows(out, KEPT)])

    both = (x.repartition(parts, "batch").groupBy("batch") for x in (texts, levels))
    return next(both).cogroup(next(both)).applyInArrow(run, KEPT)


# ---------------------------------------------------------------- product
def linked(a: int, b: int, overlap, percent: int):
    return 100 * overlap >= percent * (a + b - overlap)


def product_components(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the index of the first set of its component.

    Rows are in the order of size, so the rows that a size can link with are a run of each column; overlaps
    are added up inside these runs only, and pairs below the overlap that both sizes ask for are discarded.
    """
    k = len(sets)
    label = np.arange(k)
    if k < 2:
        return label
    by_size = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in by_size], np.int64)
    tokens = np.concatenate([sets[i] for i in by_size])
    row = np.repeat(np.arange(k), sizes)
    _, column, height = np.unique(tokens, return_inverse=True, return_counts=True)
    on = height[column] > 1
    row, column = row[on], column[on]
    cells = np.sort(column * k + row)  # the product's other side: rows of each column
    holders = cells % k
    mine = np.searchsorted(row, np.arange(k + 1))
    low = np.searchsorted(sizes, -(-percent * sizes // 100))
    high = np.searchsorted(sizes, 100 * sizes // percent, side="right")
    todo = np.ones(k, bool)
    while True:
        left = np.flatnonzero(todo)
        labels, numbers = np.unique(label[left], return_counts=True)
        if len(labels) < 2:
            break
        # a row outside the largest component that is left
        i = int(left[label[left] != labels[numbers.argmax()]][0])
        todo[i] = False
        columns = column[mine[i] : mine[i + 1]] * k
        first = np.searchsorted(cells, columns + low[i])
        counts = np.searchsorted(cells, columns + high[i]) - first
        overlap = np.bincount(holders[np.repeat(first, counts) + segmented_arange(counts)] - low[i], minlength=high[i] - low[i])
        hit = np.flatnonzero(linked(int(sizes[i]), sizes[low[i] : high[i]], overlap, percent) & (overlap > 0)) + low[i]
        hit = hit[hit != i]
        if len(hit):
            groups = np.unique(np.append(label[hit], label[i]))
            label[np.isin(label, groups)] = groups[0]
    # from places in the order of size to places in the given order
    least = np.full(k, k)
    np.minimum.at(least, label, by_size)
    out = np.empty(k, np.int64)
    out[by_size] = least[label]
    return out


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, cluster_shingles: int = 2 << 20, frequent: int = 400_000, block_bytes: int = BLOCK_BYTES, copies: int = 8) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs. frequent has no effect any more: batches get the counts of all their columns."""
    small_batches(docs.sparkSession)
    docs, own = with_row_ids(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    names = None
    if own != "doc_id":
        names = docs.select(own, "doc_id")
        docs = docs.select(F.col(own).alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, wanted_parts(size, block_bytes))

    def columns_of_texts(batches):
        begin(__name__)
        held: list[tuple[np.ndarray, np.ndarray, bytes]] = []
        weight, numbers, announced = 0, batch_numbers(), Announced()

        def out():
            return arrow_rows(split_rows(np.array([h[0] for h in held], np.int64), [h[1] for h in held], parts, next(numbers), [h[2] for h in held], announced), ROWS)

        for batch in batches:
            for ids, sets in batches_of(batch.column(1), batch.column(0).to_numpy(zero_copy_only=False)):
                for i, s in zip(ids, sets, strict=True):
                    held.append((i, s, hashlib.blake2b(s.tobytes(), digest_size=16).digest()))
                    weight += len(s) + 8
                if weight > 1 << 19:
                    yield out()
                    held, weight = [], 0
        if held:
            yield out()

    sums = materialize(add_shared(count_shared(docs.mapInArrow(columns_of_texts, ROWS), parts), parts), "jaccard-sizes")
    enough = (F.col("shared") * 100 >= F.col("size") * percent) & (F.col("size") > 0)
    words = sums.agg(F.sum("size")).first()[0] or 0
    classes = sums.filter(enough).groupBy("size", "hi", "lo").agg(F.min("doc_id").alias("rep"))
    classes = materialize(classes, "jaccard-classes")

    def numbered(batches):
        import pyarrow as pa

        numbers = batch_numbers()
        number, weight = next(numbers), 0
        for batch in batches:
            mine = []
            for n in batch.column("size").to_pylist():
                if weight > 1 << 19:
                    number, weight = next(numbers), 0
                mine.append(number)
                weight += n + 8
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(mine, pa.int64()), batch.column("size"), batch.column("text")], ["doc_id", "batch", "size", "text"])

    # texts are stored and their sets made again where they are used: hashes take twice the disk of the compressed text
    reps = docs.repartition(parts, "doc_id").join(classes.select(F.col("rep").alias("doc_id"), "size").repartition(parts, "doc_id").hint("shuffle_hash"), "doc_id")
    texts = materialize(reps.select("doc_id", "size", "text").mapInArrow(numbered, "doc_id long, batch long, size long, text string"), "jaccard-texts")
    total = texts.agg(F.sum("size")).first()[0] or 0
    parts = max(8, wanted_parts(8 * total, block_bytes))

    def columns_of_sets(batches):
        begin(__name__)
        for batch in batches:
            ids, numbers, sets = batch.column(0).to_numpy(), batch.column(1).to_numpy(), sets_of(batch.column(2))
            for number in np.unique(numbers).tolist():
                on = np.flatnonzero(numbers == number)
                yield arrow_rows(count_columns(ids[on], [sets[i] for i in on], parts, number), COUNTS)

    levels = materialize(column_levels(texts.select("doc_id", "batch", "text").mapInArrow(columns_of_sets, COUNTS), parts), "jaccard-levels")
    kept = materialize(kept_sets(texts.select("doc_id", "batch", "text"), levels, parts, percent), "jaccard-kept")
    release(levels)

    def prefixes(batches):
        begin(__name__)
        for batch in batches:
            rows: list[list[tuple]] = [[] for _ in range(parts)]
            for doc, n, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine = np.frombuffer(blob, "<u8")
                part = (mine % np.uint64(parts)).astype(np.int64)
                for p in np.unique(part).tolist():
                    rows[p].append((doc, n, mine[part == p]))
            out = [(p, np.array([r[0] for r in x], "<i8").tobytes(), np.array([(len(r[2]), r[1]) for r in x], "<i4").tobytes(), np.concatenate([r[2] for r in x]).astype("<u8").tobytes(), b"", b"", 0) for p, x in enumerate(rows) if x]
            if out:
                yield record(out)

    def star(table):
        import pyarrow as pa

        begin(__name__)
        ids, both = from_buffers(table.column("ids"), "<i8"), from_buffers(table.column("counts"), "<i4").reshape(-1, 2)
        token = from_buffers(table.column("keys"), "<u8")
        doc, n = np.repeat(ids, both[:, 0]), np.repeat(both[:, 1].astype(np.int64), both[:, 0])
        order = np.lexsort((doc, n, token))
        token, doc, n = token[order], doc[order], n[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (100 * n[:-1] < percent * n[1:])
        first = np.flatnonzero(new)
        if not len(first):
            pairs = np.zeros((0, 2), np.int64)
        else:
            low = np.repeat(np.minimum.reduceat(doc, first), np.diff(np.append(first, len(doc))))
            pairs = np.unique(np.stack([doc, low], 1)[doc != low], axis=0)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    stars = dealt(kept.select("doc_id", "size", "prefix").mapInArrow(prefixes, COLUMNS), parts).groupBy("part").applyInArrow(star, "a long, b long")
    clusters = connected_components(stars)
    placed = materialize(kept.drop("prefix").join(clusters.withColumnRenamed("node", "doc_id").withColumnRenamed("component", "cluster"), "doc_id"), "jaccard-placed")
    release(kept)
    inside = clustered = materialize(placed.join(texts.select("doc_id", "text"), "doc_id"), "jaccard-clusters")
    for done in (placed, texts):
        release(done)
    weights = inside.groupBy("cluster").agg(F.sum("size").alias("weight"))
    bins = wanted_parts(inside.agg(F.sum("size")).first()[0] or 0, max(1, cluster_shingles // 8))
    heavy = materialize(weights.filter(F.col("weight") > cluster_shingles).select("cluster", F.ceil(F.col("weight") * 2 / cluster_shingles).cast("int").alias("blocks")), "jaccard-heavy")
    # a heavy cluster is a hot key of this join; each holds over cluster_shingles of all shingles, so they are few, and beyond that Spark splits the key
    inside = inside.join(F.broadcast(heavy) if heavy.count() <= 100_000 else heavy, "cluster", "left")
    light = inside.filter("blocks is null").withColumn("task", F.concat(F.lit("b"), F.pmod(F.xxhash64("cluster"), F.lit(bins))))
    most, cut_shingles = heavy.join(weights, "cluster").agg(F.max("blocks"), F.sum("weight")).first()
    # a shingle stands for a word; the copies of a wave hold no more text than the documents do, or two copies if all are in large clusters
    most, step = most or 0, max(1, min(copies, words // max(1, cut_shingles or 0)) // 2)

    def wave(k: int) -> DataFrame:
        """Tasks of the pairs of blocks that lie k * step to (k + 1) * step - 1 apart on the ring of a cluster's blocks."""
        blocks = F.col("blocks").cast("long")
        far = F.sequence(F.lit(k * step).cast("long"), F.least(F.lit((k + 1) * step - 1), F.floor(blocks / 2)))
        both = F.array_distinct(F.flatten(F.transform(far, lambda r: F.array(F.pmod(F.col("mine") + r, blocks), F.pmod(F.col("mine") - r, blocks)))))
        cut = inside.filter(F.floor(blocks / 2) >= k * step).withColumn("mine", F.pmod(F.xxhash64("doc_id"), blocks)).withColumn("other", F.explode(both))
        return cut.withColumn("task", F.concat_ws(":", "cluster", F.least("mine", "other"), F.greatest("mine", "other"))).drop("mine", "other")

    def multiply(table):
        import pyarrow as pa

        begin(__name__)
        cluster, doc = table.column("cluster").to_numpy(), table.column("doc_id").to_numpy()
        sets = sets_of(table.column("text"))
        order = np.lexsort((doc, cluster))
        bounds = np.flatnonzero(np.diff(cluster[order], prepend=cluster[order[:1]] - 1))
        a, b = [], []
        for x, y in zip(bounds, [*bounds[1:], len(order)], strict=True):
            own = order[x:y]
            label = product_components([sets[i] for i in own], percent)
            joined_to = own[label]
            on = joined_to != own
            a.append(doc[own[on]])
            b.append(doc[joined_to[on]])
        return pa.table({"a": pa.array(np.concatenate(a), pa.int64()), "b": pa.array(np.concatenate(b), pa.int64())})

    def links_of(tasks: DataFrame) -> DataFrame:
        return tasks.select("task", "cluster", "doc_id", "text").groupBy("task").applyInArrow(multiply, "a long, b long")

    found = [materialize(links_of(light.unionByName(wave(0)) if k == 0 else wave(k)), "jaccard-links") for k in range(most // 2 // step + 1)]
    components = connected_components(functools.reduce(DataFrame.unionByName, found))
    for done in (clustered, heavy, *found):
        release(done)
    reps = classes.join(components.withColumnRenamed("node", "rep"), "rep", "left").select("size", "hi", "lo", F.coalesce("component", "rep").alias("component"))
    out = sums.join(reps, ["size", "hi", "lo"], "left").select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    if names is None:
        return out
    # row numbers are in the order of ids, so a component's smallest row has its smallest id
    heads = names.select(F.col(own).alias("component_id"), F.col("doc_id").alias("head"))
    out = out.withColumnRenamed("doc_id", own).join(names, own).join(heads, "component_id")
    return out.select("doc_id", "n_shingles", F.col("head").alias("component_id"))


def op9_jaccard(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
links AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id
"""
