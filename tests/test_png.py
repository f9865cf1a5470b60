"""PNG files: every colour type, depth, filter and interlacing against plain samples; broken files are rows with an error."""

import zlib

import numpy as np
import pytest

from sheetgraph.sources import images as im
from sheetgraph.sources import png

CASES = [(c, d) for c in png.SAMPLES for d in png.DEPTHS[c]]


def drawn(height, width, colour, depth, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 1 << depth, (height, width, png.SAMPLES[colour]))
    x[height // 3 :] = x[height // 3]  # equal rows, and smooth ones
    x[:, width // 2 :] = (np.arange(width - width // 2) % (1 << depth))[None, :, None]
    return x


def shown(x, colour, depth, palette=None, clear=None):
    """What a reader shows of samples, pixel by pixel."""
    out = np.zeros((*x.shape[:2], 3), np.uint8)
    most = (1 << depth) - 1
    for at in np.ndindex(x.shape[:2]):
        s = [int(v) for v in x[at]]
        byte = [v >> 8 if depth == 16 else v if depth == 8 else v * 255 // most for v in s]
        alpha = 255
        if colour == png.PALETTE:
            byte = [int(v) for v in palette[s[0]]]
            alpha = clear[s[0]] if clear is not None and s[0] < len(clear) else 255
        elif colour in (png.GRAY_ALPHA, png.RGBA):
            alpha, byte = byte[-1], byte[:-1]
        elif clear is not None and s == [int(v) for v in np.frombuffer(clear, ">u2")]:
            alpha = 0
        rgb = byte * 3 if len(byte) == 1 else byte
        out[at] = [(v * alpha + 255 * (255 - alpha) + 127) // 255 for v in rgb]
    return out


def as_rgb(p):
    return np.repeat(p[..., None], 3, axis=2) if p.ndim == 2 else p


@pytest.mark.parametrize("laced", [False, True])
@pytest.mark.parametrize(("colour", "depth"), CASES)
def test_every_kind(colour, depth, laced):
    palette = np.random.default_rng(1).integers(0, 256, (1 << min(depth, 8), 3)) if colour == png.PALETTE else None
    for height, width in ((1, 1), (5, 3), (9, 17), (23, 12)):
        x = drawn(height, width, colour, depth)
        clears = [None]
        if colour == png.PALETTE:
            clears.append(bytes([0, 100, 255][: 1 << depth]))
        elif colour in (png.GRAY, png.RGB):
            clears.append(np.array([x[0, 0, k] for k in range(x.shape[2])], ">u2").tobytes())
        for clear in clears:
            want = shown(x, colour, depth, palette, clear)
            for filters in (0, 1, 2, 3, 4, None, np.array([4, 3, 2, 1, 0, 3, 3, 4, 4])):
                assert (as_rgb(png.decode(png.encode(x, colour, depth, filters, palette, clear, laced))) == want).all()


def test_strips_and_gray():
    """More rows than a strip of diagonals, in every filter; gray files stay gray."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 256, (2 * png._STRIP + 7, 31, 1))
    for filters in (3, 4, rng.integers(0, 5, len(x))):
        got = png.decode(png.encode(x, png.GRAY, 8, filters))
        assert got.ndim == 2 and (got == x[..., 0]).all()
    rgb = im.png(rng.integers(0, 256, (8, 9, 3)).astype(np.uint8))
    assert png.decode(rgb).shape == (8, 9, 3)


def broken():
    good = png.encode(np.arange(48).reshape(4, 4, 3), png.RGB)
    wrong_sum = bytearray(good)
    wrong_sum[-20] ^= 1
    head, rest = good[:16], good[16:]
    header = lambda *v: png.encode(np.zeros((2, 2, 1), int), png.GRAY)[:8] + png_chunk(b"IHDR", *v)
    return {
        "empty": b"",
        "text": b"hello, this is no image at all",
        "cut": good[:40],
        "no end": good[:-12],
        "sum": bytes(wrong_sum),
        "huge": header(1 << 30, 1 << 30, 8, 2, 0, 0, 0) + png_raw(b"IDAT", zlib.compress(b"")) + png_raw(b"IEND", b""),
        "depth": header(2, 2, 3, 2, 0, 0, 0) + png_raw(b"IDAT", zlib.compress(b"x")) + png_raw(b"IEND", b""),
        "few": header(2, 2, 8, 2, 0, 0, 0) + png_raw(b"IDAT", zlib.compress(b"123")) + png_raw(b"IEND", b""),
        "filter": header(1, 1, 8, 0, 0, 0, 0) + png_raw(b"IDAT", zlib.compress(b"\x09\x00")) + png_raw(b"IEND", b""),
        "palette": header(1, 1, 8, 3, 0, 0, 0) + png_raw(b"PLTE", bytes(3)) + png_raw(b"IDAT", zlib.compress(b"\x00\x07")) + png_raw(b"IEND", b""),
        "stream": header(1, 1, 8, 0, 0, 0, 0) + png_raw(b"IDAT", b"not squeezed") + png_raw(b"IEND", b""),
        "joined": head + rest[:3],
    }


def png_raw(kind, data):
    import struct

    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def png_chunk(kind, *values):
    import struct

    return png_raw(kind, struct.pack(">IIBBBBB", *values))


def test_files_of_all_kinds(spark, tmp_path):
    """Gray, palette and alpha files are read; each broken file is one row with an error and no pixels."""
    for k, (colour, depth) in enumerate(CASES):
        palette = np.arange(3 << depth).reshape(-1, 3) % 256 if colour == png.PALETTE else None
        (tmp_path / f"good{k}.png").write_bytes(png.encode(drawn(11, 7, colour, depth), colour, depth, palette=palette))
    for name, data in broken().items():
        (tmp_path / f"bad {name}.png").write_bytes(data or b" ")  # Spark lists no files without a byte
    got = {r.path.rsplit("/", 1)[1].replace("%20", " "): r for r in im.read_images(spark, str(tmp_path)).collect()}
    assert len(got) == len(CASES) + len(broken())
    for k, (colour, depth) in enumerate(CASES):
        r = got[f"good{k}.png"]
        palette = np.arange(3 << depth).reshape(-1, 3) % 256 if colour == png.PALETTE else None
        want = shown(drawn(11, 7, colour, depth), colour, depth, palette)
        assert r.error is None and (r.height, r.width) == (11, 7) and (np.frombuffer(r.pixels, np.uint8).reshape(11, 7, 3) == want).all()
    for name in broken():
        r = got[f"bad {name}.png"]
        assert r.error and r.pixels is None, name


def test_rows_without_content(spark):
    df = spark.createDataFrame([("a", None), ("b", b"")], "path string, content binary")
    assert sorted((r.path, r.pixels, bool(r.error)) for r in im.decoded(df).collect()) == [("a", None, True), ("b", None, True)]
    assert im.decoded(df.limit(0)).count() == 0


def test_other_formats(spark, tmp_path):
    """A gray and a colour bitmap through Spark's image source; what it can't read is a row with an error."""
    import struct

    def bmp(rgb):
        rows = b"".join(r[:, ::-1].tobytes() + bytes(-3 * rgb.shape[1] % 4) for r in rgb[::-1])
        return b"BM" + struct.pack("<IHHI", 54 + len(rows), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, rgb.shape[1], rgb.shape[0], 1, 24, 0, len(rows), 0, 0, 0, 0) + rows

    rgb = np.random.default_rng(2).integers(0, 256, (5, 6, 3)).astype(np.uint8)
    (tmp_path / "a.bmp").write_bytes(bmp(rgb))
    (tmp_path / "g.png").write_bytes(png.encode(rgb[..., :1], png.GRAY, 8))
    (tmp_path / "bad.jpg").write_bytes(b"not an image")
    got = {r.path.rsplit("/", 1)[1]: r for r in im.other_images(spark, str(tmp_path)).collect()}
    assert (np.frombuffer(got["a.bmp"].pixels, np.uint8).reshape(5, 6, 3) == rgb).all() and not got["a.bmp"].gray
    assert got["g.png"].gray and (np.frombuffer(got["g.png"].pixels, np.uint8).reshape(5, 6, 3) == rgb[..., :1]).all()
    assert got["bad.jpg"].error and got["bad.jpg"].pixels is None
