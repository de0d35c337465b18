"""Media columns: lossless payloads in baseline JPEG, decoded to DC-only luminance thumbnails.

``encode_images`` stores bytes as 8-bit grey images, one 8 x 8 block per byte: the block is flat, its
quantised DC coefficient (quantiser 8) is the byte less 128, all its AC coefficients are 0. A row of
``WIDTH`` blocks is a restart interval. A payload that needs more than ``MAX_ROWS`` rows continues in
a further image in the same column. ``thumbnails`` is a general baseline decoder that reconstructs the
luminance DC plane: it parses markers, tables and restart intervals of any baseline file (several
components and subsampling too), then Huffman-decodes all restart intervals of a batch of files side
by side in numpy, a symbol of each at a time. Files that it cannot decode get an error text and no
planes; they don't stop the others.

Null texts are empty payloads. Texts of any length are stored whole. Equal payloads give equal media.
Other columns of the input are ignored; repeated rows are repeated in the result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motolake.llm.common import begin, segmented_arange, small_batches

WIDTH = 192
MAX_ROWS = 8191

#: Code lengths of DC categories 0 to 8, the only symbols used, and of the single AC symbol, end of block.
DC_LENGTHS = {0: 4, 1: 5, 2: 4, 3: 3, 4: 2, 5: 3, 6: 3, 7: 3, 8: 6}
AC_LENGTHS = {0: 1}


# ---------------------------------------------------------------- tables
def canonical(lengths: dict[int, int]) -> list[tuple[int, int, int]]:
    """(symbol, code, length) of a canonical Huffman code, as JPEG numbers them."""
    code, before, out = 0, 0, []
    for symbol, length in sorted(lengths.items(), key=lambda x: (x[1], x[0])):
        code <<= length - before if before else 0
        if not before:
            code = 0
        out.append((symbol, code, length))
        code, before = code + 1, length
    return out


def dht(kind: int, lengths: dict[int, int]) -> bytes:
    table = canonical(lengths)
    counts = bytes(sum(1 for t in table if t[2] == n) for n in range(1, 17))
    body = bytes([kind]) + counts + bytes(t[0] for t in table)
    return b"\xff\xc4" + (len(body) + 2).to_bytes(2, "big") + body


def lookup(counts: bytes, symbols: bytes) -> np.ndarray:
    """For every 16 bits that may come next: length of the code << 8 | symbol; 0 where no code fits."""
    table = np.zeros(1 << 16, np.int32)
    code, k = 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            table[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | symbols[k]
            code, k = code + 1, k + 1
        code <<= 1
    return table


# ---------------------------------------------------------------- encoder
_DC = {s: (code, n) for s, code, n in canonical(DC_LENGTHS)}


def _symbols() -> tuple[np.ndarray, np.ndarray]:
    """Bits and their number for each difference -255..255: category, its extra bits, end of block."""
    bits, size = np.zeros(511, np.uint64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        category = abs(d).bit_length()
        code, n = _DC[category]
        extra = d if d >= 0 else d + (1 << category) - 1
        bits[d + 255] = ((code << category | extra) << 1) | 0
        size[d + 255] = n + category + 1
    return bits, size


BITS, SIZES = _symbols()


def header(rows: int) -> bytes:
    quant = b"\xff\xdb\x00\x43\x00" + b"\x08" + b"\x01" * 63
    frame = b"\xff\xc0\x00\x0b\x08" + (8 * rows).to_bytes(2, "big") + (8 * WIDTH).to_bytes(2, "big") + b"\x01\x01\x11\x00"
    restart = b"\xff\xdd\x00\x04" + WIDTH.to_bytes(2, "big")
    scan = b"\xff\xda\x00\x08\x01\x01\x00\x00\x3f\x00"
    return b"\xff\xd8" + quant + frame + dht(0x00, DC_LENGTHS) + dht(0x10, AC_LENGTHS) + restart + scan


def entropy_rows(samples: np.ndarray) -> list[bytes]:
    """Entropy-coded, stuffed bytes of each row of samples (rows x WIDTH)."""
    rows = len(samples)
    value = samples.astype(np.int16) - 128
    diff = np.diff(value, axis=1, prepend=np.int16(0)) + 255
    size = SIZES[diff]
    ends = np.cumsum(size, axis=1)
    length = (ends[:, -1] + 7) >> 3
    first = np.cumsum(length) - length
    at = (ends - size) + (first * 8)[:, None]
    spare = 32 - size - (at & 7)
    word = (BITS[diff] << spare.astype(np.uint64)).astype(np.uint32).ravel()
    place = (at >> 3).ravel()
    total = int(length.sum())
    out = np.zeros(total + 4, np.int64)
    for k in range(4):
        out += np.bincount(place + k, (word >> np.uint32(24 - 8 * k)) & np.uint32(255), total + 4).astype(np.int64)
    raw = out[:total].astype(np.uint8)
    pad = (length * 8 - ends[:, -1]).astype(np.int64)
    raw[first + length - 1] |= ((1 << pad) - 1).astype(np.uint8)
    full = np.flatnonzero(raw == 255)
    stuffed = np.insert(raw, full + 1, 0).tobytes() if len(full) else raw.tobytes()
    cuts = first + np.searchsorted(full, first)
    cuts = [*cuts.tolist(), len(stuffed)]
    return [stuffed[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)] if rows else []


def encode_batch(payloads: list[bytes]) -> list[bytes]:
    """Baseline JPEG media of payloads whose lengths are positive multiples of WIDTH."""
    samples = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, WIDTH)
    coded = entropy_rows(samples)
    out, k = [], 0
    for payload in payloads:
        left, media = len(payload) // WIDTH, []
        while left:
            rows = min(left, MAX_ROWS)
            media.append(header(rows))
            for r in range(rows):
                media.append(coded[k + r])
                media.append(bytes([0xFF, 0xD0 + r % 8]) if r + 1 < rows else b"\xff\xd9")
            k, left = k + rows, left - rows
        out.append(b"".join(media))
    return out


# ---------------------------------------------------------------- decoder
class Image:
    """Markers of one baseline image and where its entropy-coded data lie."""

    __slots__ = ("components", "end", "height", "restart", "scan", "start", "tables", "width")


def parse(data: bytes, at: int) -> Image:
    """The image that starts at a byte; ValueError if it isn't a baseline one with one interleaved scan."""
    if data[at : at + 2] != b"\xff\xd8":
        raise ValueError("no start of image")
    image = Image()
    image.restart, image.tables, quant, frame = 0, {}, {}, None
    at += 2
    while True:
        if at + 4 > len(data) or data[at] != 0xFF:
            raise ValueError("a marker is missing")
        kind = data[at + 1]
        if kind == 0xFF:
            at += 1
            continue
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        if len(body) != size - 2:
            raise ValueError("a segment is cut short")
        if kind == 0xDB:
            k = 0
            while k < len(body):
                wide = body[k] >> 4
                step = 2 if wide else 1
                quant[body[k] & 15] = int.from_bytes(body[k + 1 : k + 1 + step], "big")
                k += 1 + 64 * step
        elif kind == 0xC4:
            k = 0
            while k < len(body):
                counts = body[k + 1 : k + 17]
                n = sum(counts)
                image.tables[body[k]] = body[k + 1 : k + 17 + n]
                k += 17 + n
        elif kind == 0xDD:
            image.restart = int.from_bytes(body[:2], "big")
        elif kind == 0xC0:
            if body[0] != 8:
                raise ValueError("samples are not of 8 bits")
            image.height, image.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            frame = {body[6 + 3 * i]: (body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(body[5])}
        elif 0xC1 <= kind <= 0xCF and kind != 0xC8 and kind != 0xCC:
            raise ValueError("not baseline")
        elif kind == 0xDA:
            if frame is None or body[0] != len(frame):
                raise ValueError("not one interleaved scan")
            if not image.height or not image.width:
                raise ValueError("no size")
            image.components = []
            for i in range(body[0]):
                h, v, q = frame[body[1 + 2 * i]]
                tables = body[2 + 2 * i]
                image.components.append((h, v, quant[q], tables >> 4, 16 + (tables & 15)))
            if len(image.components) == 1:  # not interleaved: a block is an MCU
                image.components = [(1, 1, *image.components[0][2:])]
            image.start = at + 2 + size
            return image
        elif kind == 0xD9:
            raise ValueError("no scan")
        at += 2 + size


def segments(data: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Starts and ends of the restart intervals from start, and the place of the marker that ends the scan."""
    part = data[start:]
    marks = np.flatnonzero(part[:-1] == 255)
    after = part[marks + 1]
    marks, after = marks[after != 0], after[after != 0]
    stop = np.flatnonzero((after < 0xD0) | (after > 0xD7))
    if not len(stop):
        raise ValueError("no end of scan")
    marks = marks[: stop[0] + 1] + start
    return np.concatenate(([start], marks[:-1] + 2)), marks, int(marks[-1])


def thumbnails(files: list[bytes]) -> list[tuple[list[np.ndarray], list[tuple[int, int]], str | None]]:
    """For each file: luminance DC planes of its images (one sample per 8 x 8 block), their (width, height), an error or None."""
    found: list[list[Image]] = []
    errors: list[str | None] = []
    lanes: list[tuple[Image, int, int, int]] = []  # image, first MCU, start and end in the joined data
    joined, base = [], 0
    for data in files:
        images, spots, error = [], [], None
        try:
            at, array = 0, np.frombuffer(data, np.uint8)
            while True:
                image = parse(data, at)
                starts, ends, image.end = segments(array, image.start)
                step = image.restart or 1 << 62
                spots += [(image, i * step if image.restart else 0, base + a, base + b) for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True))]
                images.append(image)
                if data[image.end : image.end + 2] != b"\xff\xd9":
                    raise ValueError("more than one scan")
                at = image.end + 2
                if at >= len(data):
                    break
        except (ValueError, IndexError, KeyError) as e:
            images, spots, error = [], [], str(e) or type(e).__name__
        found.append(images)
        errors.append(error)
        lanes += spots
        joined.append(data)
        base += len(data)
    planes = decode_lanes(np.frombuffer(b"".join(joined), np.uint8), lanes)
    out = []
    for images, error in zip(found, errors, strict=True):
        got = [planes[id(i)] for i in images]
        bad = next((g for g in got if isinstance(g, str)), None)
        if error or bad:
            out.append(([], [], error or bad))
        else:
            out.append((got, [(i.width, i.height) for i in images], None))
    return out


def decode_lanes(data: np.ndarray, lanes: list[tuple[Image, int, int, int]]) -> dict[int, np.ndarray | str]:
    """Luminance DC planes by id of image, from restart intervals decoded side by side."""
    if not lanes:
        return {}
    images: dict[int, Image] = {id(x[0]): x[0] for x in lanes}
    starts, ends = np.array([x[2] for x in lanes]), np.array([x[3] for x in lanes])
    # without the stuffed bytes, a gap of 8 zero bytes after each interval
    kept = ends - starts
    source = np.repeat(starts, kept) + segmented_arange(kept)
    raw = data[source]
    stuffed = np.zeros(len(raw), bool)
    stuffed[1:] = (raw[1:] == 0) & (raw[:-1] == 255)
    heads = np.cumsum(kept) - kept
    stuffed[heads[kept > 0]] = False
    lane_of = np.repeat(np.arange(len(lanes)), kept)
    plain = raw[~stuffed]
    sizes = np.bincount(lane_of[~stuffed], minlength=len(lanes))
    first = np.cumsum(sizes + 8) - (sizes + 8)
    buffer = np.zeros(int((sizes + 8).sum()) + 8, np.uint32)
    buffer[np.repeat(first, sizes) + segmented_arange(sizes)] = plain
    window = np.zeros(len(buffer), np.uint64)
    for k in range(5):
        window[: len(buffer) - 4] |= buffer[k : len(buffer) - 4 + k].astype(np.uint64) << np.uint64(32 - 8 * k)

    tables: dict[bytes, int] = {}
    stack: list[np.ndarray] = []

    def table(image: Image, key: int) -> int:
        spec = image.tables[key]
        if spec not in tables:
            tables[spec] = len(stack)
            stack.append(lookup(spec[:16], spec[16:]))
        return tables[spec]

    shapes: dict[int, tuple] = {}
    broken: dict[int, str] = {}
    for key, image in images.items():
        hmax, vmax = max(c[0] for c in image.components), max(c[1] for c in image.components)
        across = -(-image.width // (8 * hmax))
        down = -(-image.height // (8 * vmax))
        units = [(ci, x, y) for ci, c in enumerate(image.components) for y in range(c[1]) for x in range(c[0])]
        try:
            dc = [table(image, image.components[u[0]][3]) for u in units]
            ac = [table(image, image.components[u[0]][4]) for u in units]
        except KeyError:
            broken[key] = "a Huffman table is missing"
            dc = ac = [0] * len(units)
        shapes[key] = (across, down, units, dc, ac)
    if not stack:
        return {k: "a Huffman table is missing" for k in images}
    codes = np.concatenate(stack)

    most = max(len(s[2]) for s in shapes.values())
    keys = list(images)
    index = {k: i for i, k in enumerate(keys)}
    n_units = np.array([len(shapes[k][2]) for k in keys])
    dc_of, ac_of, comp_of = (np.zeros((len(keys), most), np.int64) for _ in range(3))
    for i, k in enumerate(keys):
        _, _, units, dc, ac = shapes[k]
        dc_of[i, : len(units)], ac_of[i, : len(units)], comp_of[i, : len(units)] = dc, ac, [u[0] for u in units]
    image_of = np.array([index[id(x[0])] for x in lanes])
    mcus = np.array([shapes[k][0] * shapes[k][1] for k in keys])
    first_mcu = np.array([min(x[1], 1 << 40) for x in lanes])
    step = np.array([images[k].restart or 1 << 40 for k in keys])
    todo = np.minimum(step[image_of], mcus[image_of] - first_mcu) * n_units[image_of]
    planes = [np.zeros((shapes[k][1] * images[k].components[0][1], shapes[k][0] * images[k].components[0][0]), np.int32) for k in keys]
    covered = np.bincount(image_of, np.maximum(todo, 0), len(keys))
    for i, k in enumerate(keys):
        if covered[i] != mcus[i] * n_units[i]:
            broken[k] = "restart intervals don't cover the image"

    # DC coefficients of component 0 as decoded, lane by lane, put into planes at the end
    components = max(len(images[k].components) for k in keys)
    bit = first * 8
    limit = (first + sizes) * 8
    predicted = np.zeros((len(lanes), components), np.int64)
    live = np.flatnonzero((todo > 0) & np.array([k not in broken for k in (keys[i] for i in image_of)]))
    done = np.zeros(len(lanes), np.int64)
    wrong = np.zeros(len(lanes), bool)
    got_lane, got_unit, got_value = [], [], []
    thirty_two, sixteen = np.uint64(40), np.uint64(24)
    while len(live):
        im = image_of[live]
        unit = done[live] % n_units[im]
        position = bit[live]
        w = (window[position >> 3] << (position & 7).astype(np.uint64)) & np.uint64((1 << 40) - 1)
        entry = codes[(dc_of[im, unit] << 16) + (w >> sixteen).astype(np.int64)]
        length, category = entry >> 8, entry & 255
        extra = ((w << length.astype(np.uint64)) & np.uint64((1 << 40) - 1)) >> (thirty_two - category.astype(np.uint64))
        extra = extra.astype(np.int64)
        high = (np.int64(1) << np.maximum(category - 1, 0)) * (category > 0)
        value = np.where(extra < high, extra - (np.int64(1) << category) + 1, extra)
        value[category == 0] = 0
        component = comp_of[im, unit]
        predicted[live, component] += value
        bad = (length == 0) | (category > 11)
        bit[live] = position + length + category
        k = np.ones(len(live), np.int64)
        ac = ac_of[im, unit] << 16
        on = np.arange(len(live))
        while len(on):
            position = bit[live[on]]
            w = (window[position >> 3] << (position & 7).astype(np.uint64)) & np.uint64((1 << 40) - 1)
            entry = codes[ac[on] + (w >> sixteen).astype(np.int64)]
            symbol = entry & 255
            bit[live[on]] = position + (entry >> 8) + (symbol & 15)
            bad[on[entry == 0]] = True
            k[on] += np.where(symbol == 0, 64, np.where(symbol == 0xF0, 16, (symbol >> 4) + 1))
            bad[on] |= bit[live[on]] > limit[live[on]]
            on = on[(k[on] < 64) & ~bad[on]]
        luma = component == 0
        got_lane.append(live[luma])
        got_unit.append(done[live[luma]])
        got_value.append(predicted[live[luma], 0])
        done[live] += 1
        wrong[live[bad]] = True
        live = live[(done[live] < todo[live]) & ~bad]
    for i in set(image_of[wrong].tolist()):
        broken[keys[i]] = "damaged entropy-coded data"
    if got_lane:
        lane, unit, value = np.concatenate(got_lane), np.concatenate(got_unit), np.concatenate(got_value)
        im = image_of[lane]
        order = np.argsort(im, kind="stable")
        lane, unit, value, im = lane[order], unit[order], value[order], im[order]
        bounds = np.searchsorted(im, np.arange(len(keys) + 1))
        for i, k in enumerate(keys):
            a, b = bounds[i], bounds[i + 1]
            across, _, units, _, _ = shapes[k]
            h, v, quant = images[k].components[0][:3]
            mcu = first_mcu[lane[a:b]] + unit[a:b] // len(units)
            inside = unit[a:b] % len(units)
            y = (mcu // across) * v + inside // h
            x = (mcu % across) * h + inside % h
            planes[i][y, x] = np.clip((value[a:b] * quant + 4) // 8 + 128, 0, 255)
    return {k: broken.get(k, planes[i].astype(np.uint8)) for i, k in enumerate(keys)}


# ---------------------------------------------------------------- features
def shrink(plane: np.ndarray, rows: int, cols: int) -> np.ndarray:
    """Means over a grid of nearly equal cells; a short side repeats its samples."""
    height, width = plane.shape
    y = np.minimum(np.arange(rows + 1) * height // rows, height)
    x = np.minimum(np.arange(cols + 1) * width // cols, width)
    top, left = np.minimum(y[:-1], height - 1), np.minimum(x[:-1], width - 1)
    bottom, right = np.maximum(y[1:], top + 1), np.maximum(x[1:], left + 1)
    sums = np.zeros((height + 1, width + 1), np.int64)
    sums[1:, 1:] = plane.astype(np.int64).cumsum(0).cumsum(1)
    area = (bottom - top)[:, None] * (right - left)[None, :]
    total = sums[bottom][:, right] - sums[top][:, right] - sums[bottom][:, left] + sums[top][:, left]
    return total // area


def hexbits(bits: np.ndarray) -> str:
    return np.packbits(bits.ravel()).tobytes().hex()


def feature(planes: list[np.ndarray], dims: list[tuple[int, int]]) -> str:
    """Number of images, width and height of the first, average hash and difference hash of the planes on top of each other."""
    whole = planes[0] if len(planes) == 1 or len({p.shape[1] for p in planes}) > 1 else np.concatenate(planes)
    small = shrink(whole, 8, 8)
    wide = shrink(whole, 8, 9)
    height = sum(h for _, h in dims)
    return f"{len(dims)}:{dims[0][0]}x{height}:a{hexbits(small * 64 > small.sum())}:d{hexbits(wide[:, 1:] > wide[:, :-1])}"


# ---------------------------------------------------------------- operators
def pad(data: bytes) -> bytes:
    return data + b" " * (-len(data) % WIDTH if data else WIDTH)


def chunks(items: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of items with at most so many bytes, or one item."""
    start, held = 0, 0
    for i, item in enumerate(items):
        if i > start and held + len(item) > most:
            yield start, i
            start, held = i, 0
        held += len(item)
    if start < len(items):
        yield start, len(items)


def encode_images(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: each text's UTF-8 bytes, padded with spaces, as baseline JPEG."""
    small_batches(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        begin(__name__)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [x.encode("utf-8", "surrogatepass") if x else b"" for x in batch.column(1).to_pylist()]
            for a, b in chunks(texts, 1 << 20):
                media = encode_batch([pad(t) for t in texts[a:b]])
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b], pa.int64()), pa.array([len(t) for t in texts[a:b]], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def decode_images(media: DataFrame, *, media_col: str = "media", keep: tuple[str, ...] = ("doc_id",), with_plane: bool = True) -> DataFrame:
    """keep, width, height, images, feature, error and, with_plane, plane (samples of the luminance DC plane, row by row), media_bytes, media_sha256, and of the plane plane_bytes, plane_sha256, plane_tail_crc32.

    A null or damaged file gives nulls and its error.
    """
    types = {f.name: f.dataType.simpleString() for f in media.schema.fields}
    made = "width int, height int, images int, feature string, error string, media_bytes long, media_sha256 string, plane_bytes long, plane_sha256 string, plane_tail_crc32 long" + (", plane binary" if with_plane else "")
    schema = ", ".join(f"{c} {types[c]}" for c in keep) + ", " + made

    def run(batches):
        import pyarrow as pa

        begin(__name__)
        for batch in batches:
            files = [x or b"" for x in batch.column(len(keep)).to_pylist()]
            for a, b in chunks(files, 1 << 20):
                rows = []
                for data, (planes, dims, error) in zip(files[a:b], thumbnails(files[a:b]), strict=True):
                    if error:
                        rows.append((None, None, None, None, error, len(data), hashlib.sha256(data).hexdigest(), None, None, None, None))
                    else:
                        payload = b"".join(p.tobytes() for p in planes)
                        rows.append((dims[0][0], sum(h for _, h in dims), len(dims), feature(planes, dims), None, len(data), hashlib.sha256(data).hexdigest(), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), payload))
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int32()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()] + ([pa.binary()] if with_plane else [])
                arrays = [batch.column(i).slice(a, b - a) for i in range(len(keep))] + [pa.array(c, k) for c, k in zip(cols, kinds, strict=False)]
                names = [*keep, "width", "height", "images", "feature", "error", "media_bytes", "media_sha256", "plane_bytes", "plane_sha256", "plane_tail_crc32"] + (["plane"] if with_plane else [])
                yield pa.RecordBatch.from_arrays(arrays, names)

    return media.select(*keep, media_col).mapInArrow(run, schema)


def op3_media(spark, sf_dir: str) -> DataFrame:
    media = encode_images(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    read = decode_images(media, keep=("doc_id", "n_bytes"), with_plane=False)
    return read.select("doc_id", "n_bytes", F.col("plane_bytes").alias("payload_bytes"), F.col("plane_sha256").alias("payload_sha256"), F.col("plane_tail_crc32").alias("tail_crc32"), "media_bytes", "media_sha256", "feature")
