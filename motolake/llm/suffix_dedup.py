"""Exact removal of repeated passages with a logarithmic family of sparse suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (in a document with a
smaller id, or earlier in the same one), judged on the input.

The suffixes indexed are those at content-defined places: of the ``gram``-byte strings inside a window of
``length`` bytes the one with the smallest hash, leftmost, is the window's anchor, so equal windows have
equal anchors at equal places, and the windows of an anchor are neighbours; together they are a segment. A suffix array
here is a sorted array of suffixes by the fingerprints of their segments (long matches only need
equality, not the order of letters). Arrays are dealt to tasks by the gram's hash. There each
batch's array is merge-scanned against the levels of an ``IndexFamily``; a match leaves the earlier suffix
in the index and marks the later one's windows as repeated. Levels of equal size merge, so there are
logarithmically many and an entry moves as often.

Segments with equal grams that differ as a whole may still share windows: their windows alone are
fingerprinted one by one and go through a second family. Before each shuffle a task keeps one suffix of
those that are equal, or have equal grams, so a passage that most documents hold reaches a task at most
once per batch. A task holds ``block_bytes`` of text at most, or one document. Texts are read as UTF-8 bytes,
whole, whatever their length.

Matches are not confirmed on bytes. Two segments match if 64 bits of fingerprint and 32 of their gram are
equal, two windows if 64 bits are, and only those that were dealt to one task by the same hash are ever
compared: with n entries a task and p tasks p n^2 / 2^65 false matches of windows are to be expected,
some tenths of one on 100 TB (n 10^6, p 6 * 10^6), and less of segments.

Null texts are empty documents, and come back without spans. Rows whose id is null or stands in several
rows are documents of their own, earlier ones those with the smaller id (null last), then those whose text
sorts first. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motolake.llm.common import PrefixHash, begin, dealt, joined, segmented_arange, small_batches, wanted_parts, with_row_ids

LENGTH = 100
GRAM = 24
BLOCK_BYTES = 16 << 20
CHUNK = 1 << 20
BATCH = 8 << 20

#: Suffixes as a task holds them: fingerprint of the segment (or window), place, and for segments the gram, the number of windows and whether other segments are known to share the gram.
SUFFIX = np.dtype([("key", "<u8"), ("doc", "<i8"), ("at", "<i4"), ("gram", "<u4"), ("windows", "<u2"), ("many", "u1")])
WINDOW = np.dtype([("key", "<u8"), ("doc", "<i8"), ("at", "<i4")])
SPAN = np.dtype([("doc", "<i8"), ("at", "<i4"), ("windows", "<i4"), ("sure", "u1")])
FAMILY_BATCH = 1 << 18


# ---------------------------------------------------------------- suffixes of texts
def anchored(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, at, windows, gram hash, segment hash) of the segments of texts joined at offsets."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    sizes = np.diff(offsets)
    windows = np.maximum(sizes - length + 1, 0)
    if not windows.any():
        return none
    hashes = PrefixHash(data)
    place = np.arange(len(data) - gram + 1)
    grams = hashes.of(place, place + gram)
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | place.astype(np.uint64)
    span, have = length - gram + 1, 1
    low = key
    while 2 * have <= span:  # minima of 1, 2, 4, ... grams
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < span:
        low = np.minimum(low[: len(low) - (span - have)], low[span - have :])
    text = np.repeat(np.arange(len(sizes)), windows)
    start = np.repeat(offsets[:-1], windows) + segmented_arange(windows)
    anchor = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    begin = start[first]
    return text[first], begin - offsets[text[first]], count, grams[anchor[first]], hashes.of(begin, begin + count + length - 1)


def chunks(offsets: np.ndarray, most: int = CHUNK):
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, b
        a = b


def part_of(docs, parts: int):
    """The part of ids, the same in numpy and in part_column."""
    return (docs ^ (docs >> 7) ^ (docs >> 19)) % parts


def part_column(col, parts: int):
    return F.pmod(col.bitwiseXOR(F.shiftright(col, 7)).bitwiseXOR(F.shiftright(col, 19)), F.lit(parts)).cast("int")


# ---------------------------------------------------------------- index family
def same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which suffixes are equal: by fingerprint and, if they have one, gram."""
    equal = a["key"] == b["key"]
    return equal & (a["gram"] == b["gram"]) if "gram" in a.dtype.names else equal


class IndexFamily:
    """Sorted arrays of suffixes with different keys, in levels of geometrically growing sizes."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    @staticmethod
    def sort(entries: np.ndarray) -> np.ndarray:
        """By key, then place."""
        entries = entries[np.lexsort((entries["at"], entries["doc"]))]
        return entries[np.argsort(entries["key"], kind="stable")]

    def add(self, batch: np.ndarray) -> np.ndarray:
        """Index a batch; returns suffixes, of it or indexed before, to which an equal and earlier one is known."""
        if not len(batch):
            return batch
        batch = self.sort(batch)
        repeat = np.zeros(len(batch), bool)
        repeat[1:] = same(batch[1:], batch[:-1])
        later = [batch[repeat]]
        if "many" in batch.dtype.names and repeat.any():
            first = np.flatnonzero(~repeat)
            batch["many"][first] = np.maximum.reduceat(batch["many"], first)
        batch = batch[~repeat]
        for level in self.levels:
            at = np.searchsorted(level["key"], batch["key"])
            at[at == len(level)] = 0
            mine = np.flatnonzero(same(level[at], batch))
            if not len(mine):
                continue
            held = at[mine]
            new, old = batch[mine], level[held]
            earlier = (new["doc"] < old["doc"]) | ((new["doc"] == old["doc"]) & (new["at"] < old["at"]))
            later += [old[earlier], new[~earlier]]
            if "many" in batch.dtype.names:
                new["many"] |= old["many"]
                level["many"][held] = new["many"]
            level[held[earlier]] = new[earlier]
            keep = np.ones(len(batch), bool)
            keep[mine] = False
            batch = batch[keep]
        if len(batch):
            while self.levels and len(self.levels[-1]) <= 2 * len(batch):
                both = np.concatenate([self.levels.pop(), batch])
                batch = both[np.argsort(both["key"], kind="stable")]
            self.levels.append(batch)
        return np.concatenate(later)

    def add_all(self, batches) -> list[np.ndarray]:
        """Index many small batches, some at a time."""
        later, held, size = [], [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= FAMILY_BATCH:
                later.append(self.add(np.concatenate(held)))
                held, size = [], 0
        if held:
            later.append(self.add(np.concatenate(held)))
        return later

    def all(self, kind: np.dtype) -> np.ndarray:
        """Every suffix in the index."""
        return np.concatenate(self.levels) if self.levels else np.zeros(0, kind)


def shared_grams(entries: np.ndarray) -> np.ndarray:
    """Whether another entry has the same gram."""
    order = np.argsort(entries["gram"], kind="stable")
    gram = entries["gram"][order]
    same = np.zeros(len(gram) + 1, bool)
    same[1:-1] = gram[1:] == gram[:-1]
    out = np.zeros(len(gram), bool)
    out[order] = same[1:] | same[:-1]
    return out


# ---------------------------------------------------------------- compact records
def shrink(values: np.ndarray) -> bytes:
    """Integers of at least 0, most of them small: two bytes each, those of 65535 and more listed besides."""
    far = np.flatnonzero(values >= 65535)
    return np.uint32(len(far)).tobytes() + far.astype("<u4").tobytes() + values[far].astype("<i8").tobytes() + np.minimum(values, 65535).astype("<u2").tobytes()


class Reader:
    def __init__(self, body: bytes):
        self.body, self.at = body, 0

    def take(self, kind: str, count: int) -> np.ndarray:
        out = np.frombuffer(self.body, kind, count, self.at)
        self.at += out.nbytes
        return out

    def grow(self, count: int) -> np.ndarray:
        """What shrink made."""
        n = int(self.take("<u4", 1)[0])
        far, values = self.take("<u4", n), self.take("<i8", n)
        out = self.take("<u2", count).astype(np.int64)
        out[far] = values
        return out


def encode(records: np.ndarray) -> bytes:
    """Records without what follows from their order: documents and places as differences."""
    records = records[np.lexsort((records["at"], records["doc"]))]
    docs, first, counts = np.unique(records["doc"], return_index=True, return_counts=True)
    step = np.diff(records["at"].astype(np.int64), prepend=0)
    step[first] = records["at"][first]
    base = docs[:1] if len(docs) else np.zeros(1, np.int64)
    # differences of ids may pass 63 bits: as unsigned numbers they don't
    gaps = np.diff(docs.astype(np.uint64), prepend=base.astype(np.uint64))
    wide = bool((gaps >= np.uint64(1 << 62)).any())
    parts = [np.array([len(records), len(docs), wide], "<u4").tobytes(), base.tobytes(), gaps.tobytes() if wide else shrink(gaps.astype(np.int64)), shrink(counts), shrink(step), records["key"].tobytes()]
    if "gram" in records.dtype.names:
        parts += [records["gram"].tobytes(), records["windows"].tobytes(), records["many"].tobytes()]
    return b"".join(parts)


def decode(body: bytes, kind: np.dtype) -> np.ndarray:
    read = Reader(body)
    n, m, wide = read.take("<u4", 3).tolist()
    base = read.take("<i8", 1)
    gaps = read.take("<u8", m) if wide else read.grow(m).astype(np.uint64)
    docs = (np.cumsum(gaps, dtype=np.uint64) + base.astype(np.uint64)).astype(np.int64)
    counts, step = read.grow(m), read.grow(n)
    out = np.zeros(n, kind)
    out["key"] = read.take("<u8", n)
    if "gram" in out.dtype.names:
        out["gram"], out["windows"], out["many"] = read.take("<u4", n), read.take("<u2", n), read.take("u1", n)
    out["doc"] = np.repeat(docs, counts)
    total = np.cumsum(step)
    begin = np.cumsum(counts) - counts
    out["at"] = total - np.repeat(total[begin] - step[begin], counts) if n else total
    return out


def spans(records: np.ndarray, sure: int) -> np.ndarray:
    out = np.zeros(len(records), SPAN)
    out["doc"], out["at"], out["sure"] = records["doc"], records["at"], sure
    out["windows"] = records["windows"] if "windows" in records.dtype.names else 1
    return out


def runs(found: np.ndarray) -> np.ndarray:
    """Spans of single windows joined where they follow each other."""
    found = found[np.lexsort((found["at"], found["doc"]))]
    if not len(found):
        return found
    new = np.ones(len(found), bool)
    new[1:] = (found["doc"][1:] != found["doc"][:-1]) | (found["at"][1:] > found["at"][:-1] + found["windows"][:-1])
    first = np.flatnonzero(new)
    out = found[first].copy()
    out["windows"] = np.maximum.reduceat(found["at"] + found["windows"], first) - out["at"]
    return out


# ---------------------------------------------------------------- shuffled blocks
BLOCKS = "part int, kind int, target int, body binary"


def blocks(records: np.ndarray, part: np.ndarray, kind: int) -> list[tuple[int, int, int, bytes]]:
    """A row for each part: suffixes (kind 0), or spans for the documents of a part (kind 1), which go there by way of it."""
    if not len(records):
        return []
    order = np.argsort(part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.diff(part, prepend=-1))
    pack = encode if kind == 0 else np.ndarray.tobytes
    return [(int(part[a]), kind, int(part[a]) if kind else -1, pack(records[order[a:b]])) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(part)], strict=True)]


def batch_of(rows: list[tuple[int, int, int, bytes]]):
    import pyarrow as pa

    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["part", "kind", "target", "body"])


def table_of(rows: list[tuple[int, int, int, bytes]]):
    import pyarrow as pa

    return pa.Table.from_batches([batch_of(rows)])


def find_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame, int]:
    """(texts with their part, blocks of spans of repeated windows by part, number of parts)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, wanted_parts(size, block_bytes))

    def to_parts(found: np.ndarray) -> list[tuple[int, int, int, bytes]]:
        return blocks(found, part_of(found["doc"], parts), 1)

    def index_texts(batches):
        begin(__name__)
        held: list[np.ndarray] = []
        weight = 0

        def out():
            family = IndexFamily()
            later = family.add(np.concatenate(held))
            one = family.all(SUFFIX)
            # segments that share a gram but differ: all need a look at their windows; one tells the others
            several = shared_grams(one)
            tells = one[several]
            _, first = np.unique(tells["gram"], return_index=True)
            tells = tells[first]
            tells["many"] = 1
            sent = np.concatenate([one[~several], tells])
            local = np.concatenate([spans(later, 1), spans(one[several], 0)])
            return batch_of(blocks(sent, (sent["gram"] % np.uint32(parts)).astype(np.int64), 0) + to_parts(local))

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = joined(batch.column(1))
            for a, b in chunks(offsets):
                text, at, count, grams, whole = anchored(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], length, gram)
                records = np.zeros(len(text), SUFFIX)
                records["gram"], records["key"], records["doc"], records["at"], records["windows"] = grams & np.uint64(0xFFFFFFFF), whole, ids[a:b][text], at, count  # anchors are small in their upper bits
                held.append(records)
                weight += int(offsets[b] - offsets[a])
                if weight > BATCH:
                    yield out()
                    held, weight = [], 0
        if held and any(len(h) for h in held):
            yield out()

    def scan_suffixes(table):
        begin(__name__)
        kind, body = table.column("kind").to_pylist(), table.column("body").to_pylist()
        rows = [(t, 1, t, b) for t, k, b in zip(table.column("target").to_pylist(), kind, body, strict=True) if k == 1]
        family = IndexFamily()
        later = family.add_all(decode(b, SUFFIX) for k, b in zip(kind, body, strict=True) if k == 0)
        index = family.all(SUFFIX)
        told = np.unique(index["gram"][index["many"] == 1])
        look = index[shared_grams(index) | np.isin(index["gram"], told)]
        return table_of(rows + to_parts(np.concatenate([np.zeros(0, SPAN), *(spans(x, 1) for x in later), spans(look, 0)])))

    texts = dealt(docs.withColumn("part", part_column(F.col("doc_id"), parts)), parts)
    sent = docs.select("doc_id", "text").mapInArrow(index_texts, BLOCKS)
    first = dealt(sent, parts).groupBy("part").applyInArrow(scan_suffixes, BLOCKS)

    def look_closer(texts_of, marks):
        begin(__name__)
        body = [np.frombuffer(b, SPAN) for b in marks.column("body").to_pylist()]
        if not body:
            return table_of([])
        marks = np.concatenate(body)
        known = runs(marks[marks["sure"] == 1])
        open_ = marks[marks["sure"] == 0]
        rows = to_parts(known)
        ids = texts_of.column("doc_id").to_numpy()
        data, offsets = joined(texts_of.column("text"))
        order = np.argsort(ids, kind="stable")
        open_ = open_[np.lexsort((open_["at"], open_["doc"]))]
        twice = np.zeros(len(open_), bool)  # found both in its batch and by the family
        twice[1:] = (open_["doc"][1:] == open_["doc"][:-1]) & (open_["at"][1:] == open_["at"][:-1])
        open_ = open_[~twice]
        row = order[np.searchsorted(ids[order], open_["doc"])] if len(open_) else np.zeros(0, np.int64)
        by_row = np.argsort(row, kind="stable")
        open_, row = open_[by_row], row[by_row]
        held, sizes = [], 0

        def send():
            family = IndexFamily()
            later = family.add(np.concatenate(held))
            one = family.all(WINDOW)
            return blocks(one, (one["key"] % np.uint64(parts)).astype(np.int64), 0) + to_parts(runs(spans(later, 1)))

        for a, b in chunks(offsets):
            x, y = np.searchsorted(row, [a, b])
            if x == y:
                continue
            hashes = PrefixHash(data[offsets[a] : offsets[b]])
            counts = open_["windows"][x:y].astype(np.int64)
            at = np.repeat(open_["at"][x:y].astype(np.int64), counts) + segmented_arange(counts)
            start = np.repeat(offsets[row[x:y]] - offsets[a], counts) + at
            records = np.zeros(len(at), WINDOW)
            records["key"], records["doc"], records["at"] = hashes.of(start, start + length), np.repeat(open_["doc"][x:y], counts), at
            held.append(records)
            sizes += len(records)
            if sizes > 1 << 20:
                rows += send()
                held, sizes = [], 0
        if held:
            rows += send()
        return table_of(rows)

    closer = texts.groupBy("part").cogroup(dealt(first, parts).groupBy("part")).applyInArrow(look_closer, BLOCKS)

    def scan_windows(table):
        begin(__name__)
        kind, body = table.column("kind").to_pylist(), table.column("body").to_pylist()
        rows = [(t, 1, t, b) for t, k, b in zip(table.column("target").to_pylist(), kind, body, strict=True) if k == 1]
        later = IndexFamily().add_all(decode(b, WINDOW) for k, b in zip(kind, body, strict=True) if k == 0)
        if later:
            rows += to_parts(runs(spans(np.concatenate(later), 1)))
        return table_of(rows)

    second = dealt(closer, parts).groupBy("part").applyInArrow(scan_windows, BLOCKS)
    return texts, dealt(second, parts), parts


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, block_bytes: int = BLOCK_BYTES, kept: str | None = "bytes", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (starts and ends of removed runs), what is left and columns to keep.

    kept says what is left: as "bytes" (kept), as "text" (kept_text, without characters of which a byte
    went; null where the text was), or None for neither. keep names further columns of docs, other than
    these.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *keep)
    own, name = with_row_ids(docs)
    if name != "doc_id":
        found = remove_repeats(own.drop("doc_id"), id_col=name, length=length, gram=gram, block_bytes=block_bytes, kept=kept, keep=keep)
        return found.withColumnRenamed("doc_id", name).join(own.select(name, "doc_id"), name).select(*found.columns)
    texts, marks, _ = find_repeats(docs, length=length, gram=gram, block_bytes=block_bytes)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends"] + {"bytes": ["kept"], "text": ["kept_text"], None: []}[kept]
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, ends array<long>" + {"bytes": ", kept binary", "text": ", kept_text string", None: ""}[kept] + "".join(f", {c} {types[c]}" for c in keep)

    def cut(texts_of, marks_of):
        import pyarrow as pa

        begin(__name__)
        body = [np.frombuffer(b, SPAN) for b in marks_of.column("body").to_pylist()]
        found = runs(np.concatenate(body)) if body else np.zeros(0, SPAN)
        ids = texts_of.column("doc_id").to_numpy()
        first, last = np.searchsorted(found["doc"], ids), np.searchsorted(found["doc"], ids, side="right")
        out: list[list] = [[] for _ in names]
        for i, text, x, y in zip(ids.tolist(), texts_of.column("text").to_pylist(), first.tolist(), last.tolist(), strict=True):
            raw = (text or "").encode("utf-8")
            starts, ends = [], []
            for s, n in zip(found["at"][x:y].tolist(), found["windows"][x:y].tolist(), strict=True):
                e = s + n + length - 1
                if ends and s <= ends[-1]:
                    ends[-1] = max(ends[-1], e)
                else:
                    starts.append(s)
                    ends.append(e)
            pieces, at = [], 0
            for s, e in zip(starts, ends, strict=True):
                pieces.append(raw[at:s])
                at = e
            pieces.append(raw[at:])
            left = b"".join(pieces)
            row = [i, len(raw), len(raw) - len(left), len(starts), hashlib.sha256(left).hexdigest(), starts, ends]
            if kept == "bytes":
                row.append(left)
            elif kept == "text":
                row.append(text if not starts else "".join(p.decode("utf-8", "ignore") for p in pieces))
            for column, value in zip(out, row, strict=True):
                column.append(value)
        kinds = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int64())] * 2 + {"bytes": [pa.binary()], "text": [pa.string()], None: []}[kept]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, out, kinds, strict=True)} | {c: texts_of.column(c) for c in keep})

    return texts.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(cut, schema)


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), kept=None).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


ORACLE_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
g AS (SELECT doc_id, b, n, unnest(range(n - 99)) AS p FROM d WHERE n >= 100),
w AS (SELECT doc_id, p, row_number() OVER (PARTITION BY b[p + 1:p + 100] ORDER BY doc_id, p) AS k FROM g),
r AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER v + 100 THEN 1 ELSE 0 END AS new FROM w WHERE k > 1 WINDOW v AS (PARTITION BY doc_id ORDER BY p)),
i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM r),
spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 100 AS z FROM i GROUP BY doc_id, run),
edges AS (SELECT doc_id, z AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS z FROM spans UNION ALL SELECT doc_id, 0, min(a) FROM spans GROUP BY doc_id),
kept AS (SELECT e.doc_id, string_agg(hex(d.b[e.a + 1:coalesce(e.z, d.n)]), '' ORDER BY e.a) AS h FROM edges e JOIN d USING (doc_id) GROUP BY e.doc_id),
c AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(c.removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(c.spans, 0) AS BIGINT) AS n_spans, sha256(CASE WHEN c.doc_id IS NULL THEN d.b ELSE unhex(kept.h) END) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
