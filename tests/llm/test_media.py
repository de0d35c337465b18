import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from motolake.llm import media


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=900), min_size=1, max_size=5))
def test_round_trip(payloads):
    padded = [media.pad(p) for p in payloads]
    for p, (planes, dims, error) in zip(padded, media.thumbnails(media.encode_batch(padded)), strict=True):
        assert error is None and b"".join(x.tobytes() for x in planes) == p
        assert dims[0][0] == 8 * media.WIDTH


def test_long_payloads_take_several_images():
    payload = media.pad(np.random.default_rng(0).integers(0, 256, media.WIDTH * (media.MAX_ROWS + 2), dtype=np.uint8).tobytes())
    ((planes, dims, error),) = media.thumbnails(media.encode_batch([payload]))
    assert error is None and len(dims) == 2 and b"".join(x.tobytes() for x in planes) == payload


def build(components, tables, scan, restart=0, size=(16, 16)):
    """A baseline file from parts, for images of another make than encode_batch's."""
    quant = b"\xff\xdb\x00\x43\x00" + b"\x10" + b"\x01" * 63
    frame = b"\xff\xc0" + (8 + 3 * len(components)).to_bytes(2, "big") + b"\x08" + size[1].to_bytes(2, "big") + size[0].to_bytes(2, "big") + bytes([len(components)]) + b"".join(bytes([i + 1, h << 4 | v, 0]) for i, (h, v) in enumerate(components))
    rest = (b"\xff\xdd\x00\x04" + restart.to_bytes(2, "big")) if restart else b""
    sos = b"\xff\xda" + (6 + 2 * len(components)).to_bytes(2, "big") + bytes([len(components)]) + b"".join(bytes([i + 1, 0]) for i in range(len(components))) + b"\x00\x3f\x00"
    return b"\xff\xd8" + b"\xff\xfe\x00\x04hi" + quant + frame + b"".join(media.dht(k, t) for k, t in tables) + rest + sos + scan + b"\xff\xd9"


def bits(*parts):
    text = "".join(parts)
    text += "1" * (-len(text) % 8)
    return int(text, 2).to_bytes(len(text) // 8, "big").replace(b"\xff", b"\xff\x00")


def test_subsampled_colour_with_ac_coefficients():
    # one MCU of four luminance blocks and two of colour; DC categories 0 and 2, AC end of block and a run of 3 zeros with a value of 1 bit
    dc, ac = {0: 1, 2: 2}, {0x00: 1, 0x31: 2}
    code = {s: format(c, f"0{n}b") for s, c, n in media.canonical(dc)}
    a = {s: format(c, f"0{n}b") for s, c, n in media.canonical(ac)}
    blocks = [code[2] + "11" + a[0x31] + "1" + a[0], code[0] + a[0], code[2] + "00" + a[0], code[0] + a[0x31] + "0" + a[0], code[0] + a[0], code[2] + "10" + a[0]]
    data = build([(2, 2), (1, 1), (1, 1)], [(0x00, dc), (0x10, ac)], bits(*blocks))
    ((planes, dims, error),) = media.thumbnails([data])
    assert error is None and dims == [(16, 16)]
    # DC 3, 3, 0, 0 times the quantiser 16, an eighth of it above 128
    assert planes[0].tolist() == [[134, 134], [128, 128]]


def test_damaged_files_have_errors_and_spare_others():
    good = media.encode_batch([media.pad(b"hello" * 100)])[0]
    bad = [b"", b"abc", good[:200], good[:-2], good.replace(b"\xff\xc0", b"\xff\xc2"), good[:420] + b"\xff\x00" * 8 + good[436:]]
    out = media.thumbnails([*bad, good])
    assert all(e is not None for _, _, e in out[:-1]) and out[-1][2] is None


def test_tables(make):
    rows = [(1, "a"), (2, None), (3, ""), (4, "é" * 5000), (5, "a"), (5, "a"), (None, "x")]
    coded = media.encode_images(make(rows))
    out = media.decode_images(coded, keep=("doc_id", "n_bytes")).collect()
    assert len(out) == len(rows) and all(r["error"] is None for r in out)
    for doc, text in rows:
        raw = (text or "").encode()
        want = raw + b" " * (-len(raw) % 192 if raw else 192)
        r = next(x for x in out if x["doc_id"] == doc)
        assert bytes(r["plane"]) == want and r["n_bytes"] == len(raw) and r["plane_sha256"] == hashlib.sha256(want).hexdigest()
        assert r["plane_tail_crc32"] == zlib.crc32(want[-16:]) and (r["width"], r["height"]) == (1536, 8 * len(want) // 192)
    assert len({(r["media_sha256"], r["feature"]) for r in out if r["doc_id"] in (1, 5)}) == 1
    assert media.encode_images(make([])).count() == 0
    nulls = make([(1, None)]).sparkSession.createDataFrame([(1, None)], "doc_id long, media binary")
    assert media.decode_images(nulls).first()["error"]


def test_hashes_see_the_picture():
    rng = np.random.default_rng(1)
    plane = rng.integers(0, 256, (40, 192), dtype=np.uint8)
    assert media.feature([plane], [(1536, 320)]) != media.feature([plane[::-1].copy()], [(1536, 320)])
    grid = media.shrink(plane, 8, 8)
    assert grid.shape == (8, 8) and grid[0, 0] == plane[:5, :24].astype(int).sum() // 120
