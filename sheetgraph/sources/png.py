"""PNG files in numpy: all colour types, bit depths, row filters and interlacing, to gray or RGB pixels.

Row filters are undone many pixels at a time. Runs of rows of one simple filter are copies or running sums along
the rows or columns. Rows whose pixels lean on their left neighbour and on the row above (mean and Paeth) are
worked off along diagonals: the pixels of one diagonal of a strip depend on earlier diagonals only.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Samples a pixel has in each colour type, and the depths that it may have.
GRAY, RGB, PALETTE, GRAY_ALPHA, RGBA = 0, 2, 3, 4, 6
SAMPLES = {GRAY: 1, RGB: 3, PALETTE: 1, GRAY_ALPHA: 2, RGBA: 4}
DEPTHS = {GRAY: (1, 2, 4, 8, 16), RGB: (8, 16), PALETTE: (1, 2, 4, 8), GRAY_ALPHA: (8, 16), RGBA: (8, 16)}
#: First column and row, and steps between columns and rows, of the seven interlaced passes.
PASSES = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))
#: Pixels that a file may claim to hold; more are refused before any memory is taken.
MOST_PIXELS = 1 << 30
_STRIP = 512


def chunks(data: bytes):
    """(kind, content) of each chunk, sums checked."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG file")
    at = 8
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError("the file ends within a chunk")
        size, kind = struct.unpack_from(">I4s", data, at)
        if at + 12 + size > len(data):
            raise ValueError("the file ends within a chunk")
        content = data[at + 8 : at + 8 + size]
        if zlib.crc32(kind + content) != struct.unpack_from(">I", data, at + 8 + size)[0]:
            raise ValueError(f"the sum of a chunk is wrong: {kind!r}")
        yield kind, content
        if kind == b"IEND":
            return
        at += 12 + size
    raise ValueError("the file has no end")


def _nearest(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whichever of left, above and above-left is nearest to left + above - above-left; ties in that order."""
    to_a, to_b, to_c = np.abs(b - c), np.abs(a - c), np.abs(a + b - 2 * c)
    return np.where((to_a <= to_b) & (to_a <= to_c), a, np.where(to_b <= to_c, b, c))


def _diagonals(rows: np.ndarray, kinds: np.ndarray, above: np.ndarray, step: int) -> None:
    """Undo any filters of a strip (n x bytes) in place, given the row above it."""
    n, width = rows.shape
    cells = width // step
    body = rows.reshape(n, cells, step).astype(np.int16)
    done = np.zeros((n + 1, cells + 1, step), np.int16)  # a row above and a pixel before each row
    done[0, 1:] = above.reshape(cells, step)
    kind = kinds[:, None]
    for t in range(n + cells - 1):
        y = np.arange(max(0, t - cells + 1), min(n, t + 1))
        x = t - y
        a, b, c = done[y + 1, x], done[y, x + 1], done[y, x]
        k = kind[y]
        guess = np.where(k == 1, a, np.where(k == 2, b, np.where(k == 3, (a + b) >> 1, np.where(k == 4, _nearest(a, b, c), 0))))
        done[y + 1, x + 1] = (body[y, x] + guess) & 255
    rows[:] = done[1:, 1:].reshape(n, width).astype(np.uint8)


#: Rows that one after another take less time than along their diagonals.
_FEW = 12


def _one_by_one(rows: np.ndarray, kinds: np.ndarray, above: np.ndarray, step: int) -> None:
    """The same of few rows, byte by byte."""
    up = [0] * step + above.tolist()
    for k, kind in enumerate(kinds.tolist()):
        now, at = [0] * step, 0
        for v, b in zip(rows[k].tolist(), up[step:], strict=True):
            a = now[at]
            if kind == 3:
                guess = (a + b) >> 1
            else:
                c = up[at]
                pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - c - c)
                guess = a if pa <= pb and pa <= pc else b if pb <= pc else c
            now.append((v + guess) & 255)
            at += 1
        rows[k] = now[step:]
        up = now


def unfiltered(raw: np.ndarray, step: int) -> np.ndarray:
    """Rows (height x 1 + bytes, the filter's number first) as bytes of samples; step is the bytes of a pixel, 1 at least."""
    kinds, rows = raw[:, 0].copy(), raw[:, 1:].copy()
    if (kinds > 4).any():
        raise ValueError("a row has an unknown filter")
    above = np.zeros(rows.shape[1], np.uint8)
    simple = np.where(kinds <= 2, kinds, 3)
    edge = np.concatenate([[0], np.flatnonzero(np.diff(simple)) + 1, [len(rows)]])
    for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if hi == lo:
            continue
        kind, part = simple[lo], rows[lo:hi]
        if kind == 1:
            cells = part.reshape(hi - lo, -1, step)
            np.cumsum(cells, axis=1, dtype=np.uint8, out=cells)
        elif kind == 2:
            part[0] += above
            np.cumsum(part, axis=0, dtype=np.uint8, out=part)
        elif kind == 3:
            for at in range(lo, hi, _STRIP):
                end = min(hi, at + _STRIP)
                (_one_by_one if end - at <= _FEW else _diagonals)(rows[at:end], kinds[at:end], rows[at - 1] if at else above, step)
        above = rows[hi - 1]
    return rows


def _samples(rows: np.ndarray, width: int, samples: int, depth: int) -> np.ndarray:
    """Unpacked samples (height x width x samples), as stored; the high byte of those of 16 bits."""
    if depth == 16:
        return rows[:, ::2].reshape(len(rows), width, samples)
    if depth == 8:
        return rows.reshape(len(rows), width, samples)
    bits = np.unpackbits(rows, axis=1).reshape(len(rows), -1, depth)
    return (bits @ (1 << np.arange(depth - 1, -1, -1))).astype(np.uint8)[:, :width, None]


def decode(data: bytes) -> np.ndarray:
    """Pixels, height x width (gray) or height x width x 3 (RGB), 8 bits a sample; what is transparent is laid on white."""
    header, palette, clear, parts = None, None, None, []
    for kind, content in chunks(data):
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", content)
        elif kind == b"PLTE":
            palette = np.frombuffer(content, np.uint8).reshape(-1, 3)
        elif kind == b"tRNS":
            clear = content
        elif kind == b"IDAT":
            parts.append(content)
        elif kind[:1].isupper() and kind != b"IEND":
            raise ValueError(f"a chunk that must be known isn't: {kind!r}")
    if header is None or not parts:
        raise ValueError("the file has no header or no pixels")
    width, height, depth, colour, squeezed, filtering, laced = header
    if colour not in SAMPLES or depth not in DEPTHS[colour] or squeezed or filtering or laced > 1 or not width or not height:
        raise ValueError("the header holds values that the format lacks")
    if width * height > MOST_PIXELS:
        raise ValueError("the header claims too many pixels")
    if colour == PALETTE and palette is None:
        raise ValueError("the palette is missing")
    n = SAMPLES[colour]
    step = max(1, n * depth // 8)
    passes = [p for p in (PASSES if laced else ((0, 0, 1, 1),)) if p[0] < width and p[1] < height]
    sizes = [(-(-(width - x) // dx), -(-(height - y) // dy)) for x, y, dx, dy in passes]
    total = sum(h * (1 + -(-w * n * depth // 8)) for w, h in sizes)
    pour = zlib.decompressobj()
    raw = pour.decompress(b"".join(parts), total + 1)
    if len(raw) != total:
        raise ValueError("the pixels are too few or too many")
    flat = np.frombuffer(raw, np.uint8)
    out = np.zeros((height, width, n), np.uint8)
    at = 0
    wide = np.zeros((height, width, n), np.uint16) if clear is not None and depth == 16 and colour in (GRAY, RGB) else None
    for (x, y, dx, dy), (w, h) in zip(passes, sizes, strict=True):
        row = 1 + -(-w * n * depth // 8)
        rows = unfiltered(flat[at : at + h * row].reshape(h, row), step)
        out[y::dy, x::dx] = _samples(rows, w, n, depth)
        if wide is not None:
            wide[y::dy, x::dx] = rows.reshape(-1).view(">u2").reshape(h, w, n)
        at += h * row
    return _shown(out, wide, colour, depth, palette, clear)


def _shown(out: np.ndarray, wide: np.ndarray | None, colour: int, depth: int, palette: np.ndarray | None, clear: bytes | None) -> np.ndarray:
    """Samples as gray or RGB of 8 bits, transparent ones over white."""
    if colour == PALETTE:
        if out.size and int(out.max()) >= len(palette):
            raise ValueError("a pixel is beyond the palette")
        shown = palette[out[..., 0]]
        alpha = None
        if clear is not None:
            table = np.full(256, 255, np.uint8)
            table[: len(clear)] = np.frombuffer(clear, np.uint8)
            alpha = table[out[..., 0]]
    else:
        stored = out
        scaled = out if depth >= 8 else (out.astype(np.uint16) * 255 // ((1 << depth) - 1)).astype(np.uint8)
        has_alpha = colour in (GRAY_ALPHA, RGBA)
        shown, alpha = (scaled[..., :-1], scaled[..., -1]) if has_alpha else (scaled, None)
        if clear is not None and not has_alpha:
            key = np.frombuffer(clear, ">u2")[: shown.shape[-1]]
            same = wide if wide is not None else stored
            alpha = np.where((same == key).all(axis=-1), 0, 255).astype(np.uint8)
        shown = shown[..., 0] if shown.shape[-1] == 1 else shown
    if alpha is not None and (alpha < 255).any():
        a = alpha.astype(np.uint32) if shown.ndim == 2 else alpha.astype(np.uint32)[..., None]
        shown = ((shown * a + 255 * (255 - a) + 127) // 255).astype(np.uint8)
    if colour == PALETTE and (shown[..., 0] == shown[..., 1]).all() and (shown[..., 0] == shown[..., 2]).all():
        shown = shown[..., 0]
    return np.ascontiguousarray(shown)


def _guesses(rows: np.ndarray, step: int) -> list[np.ndarray]:
    """Rows (height x bytes) under each of the five filters."""
    body = rows.astype(np.int16)
    left = np.pad(body, ((0, 0), (step, 0)))[:, : body.shape[1]]
    up = np.pad(body, ((1, 0), (0, 0)))[:-1]
    corner = np.pad(body, ((1, 0), (step, 0)))[:-1, : body.shape[1]]
    return [(body - guess).astype(np.uint8) for guess in (0, left, up, (left + up) >> 1, _nearest(left, up, corner))]


def encode(samples: np.ndarray, colour: int = RGB, depth: int = 8, filters: int | np.ndarray | None = None, palette: np.ndarray | None = None, clear: bytes | None = None, laced: bool = False, level: int = 6) -> bytes:
    """A PNG file of samples (height x width x samples of the colour type, of `depth` bits each).

    filters: one for all rows, one a row, or None for the one of least sum of differences in each row.
    """
    samples = samples[..., None] if samples.ndim == 2 else samples
    height, width, n = samples.shape
    if n != SAMPLES[colour] or depth not in DEPTHS[colour]:
        raise ValueError("the samples don't fit the colour type")
    step, body = max(1, n * depth // 8), []
    for x, y, dx, dy in PASSES if laced else ((0, 0, 1, 1),):
        part = samples[y::dy, x::dx]
        if not part.size:
            continue
        if depth == 16:
            rows = np.ascontiguousarray(part.astype(">u2")).view(np.uint8).reshape(len(part), -1)
        elif depth == 8:
            rows = np.ascontiguousarray(part.astype(np.uint8)).reshape(len(part), -1)
        else:
            bits = (part[..., 0, None] >> np.arange(depth - 1, -1, -1)) & 1
            rows = np.packbits(bits.reshape(len(part), -1).astype(np.uint8), axis=1)
        guesses = np.stack(_guesses(rows, step))
        if filters is None:
            chosen = np.abs(guesses.view(np.int8).astype(np.int32)).sum(axis=2).argmin(axis=0)
        else:
            chosen = np.resize(np.asarray(filters, np.int64), len(rows))
        body.append(np.concatenate([chosen[:, None].astype(np.uint8), guesses[chosen, np.arange(len(rows))]], axis=1).tobytes())
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    out = SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, int(laced)))
    if palette is not None:
        out += chunk(b"PLTE", np.asarray(palette, np.uint8).tobytes())
    if clear is not None:
        out += chunk(b"tRNS", clear)
    return out + chunk(b"IDAT", zlib.compress(b"".join(body), level)) + chunk(b"IEND", b"")
