"""Raster stages in numpy, run over images in Arrow batches. Detectors and OCR engines plug in the same way."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


class Stage(Protocol):
    """What plugs in between tables: a detector, an OCR engine, or one of the functions below."""

    def __call__(self, df: DataFrame) -> DataFrame: ...


def image_stage(each: Callable[[pd.Series], list[dict]], schema: str) -> Stage:
    """A stage that gives the rows each(image row) returns. Images are read one batch at a time, or drawn one at a time (tiles.Drawn)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.strip().split()[0] for c in schema.split(",")]
        for pdf in batches:
            rows = [r for _, image in pdf.iterrows() for r in each(image)]
            yield pd.DataFrame(rows, columns=names)

    return lambda df: df.mapInPandas(run, schema) if isinstance(df, DataFrame) else df.over(each, schema)


class Indexed:
    """An image of few colours: a plane of their numbers, one byte a pixel. What only a pixel's colour tells is told once for each colour."""

    def __init__(self, numbers: np.ndarray, colours: np.ndarray):
        self.numbers, self.colours = numbers, colours
        self.shape = (*numbers.shape, colours.shape[1])

    def __getitem__(self, at) -> Indexed:
        return Indexed(self.numbers[at], self.colours)

    def __array__(self, dtype=None, copy=None) -> np.ndarray:
        return self.colours[self.numbers].astype(dtype or np.uint8, copy=False)

    def told(self, each: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """each(colours), of one byte each, for every pixel."""
        values = each(self.colours[None])[0]
        first, *rest = values.view(np.uint8).tolist()
        out = np.full(self.numbers.shape, first, np.uint8)
        for k, v in enumerate(rest, 1):
            if v != first:
                out += (self.numbers == k).view(np.uint8) * np.uint8((v - first) % 256)  # bytes, which go round
        return out.view(values.dtype)


def coloured(rgb: np.ndarray) -> np.ndarray:
    """True where a pixel is not white. Most of a sheet is, and needs no arithmetic."""
    return (rgb[..., 0] & rgb[..., 1] & rgb[..., 2]) != 255


def gray(rgb: np.ndarray | Indexed) -> np.ndarray:
    if isinstance(rgb, Indexed):
        return rgb.told(gray)
    out, some = np.full(rgb.shape[:-1], 255, np.uint8), np.flatnonzero(coloured(rgb))
    out.reshape(-1)[some] = np.rint(rgb.reshape(-1, rgb.shape[-1])[some, :3] @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)
    return out


def otsu(values: np.ndarray) -> int:
    """The threshold of the largest variance between its two sides."""
    n = np.bincount(values.ravel(), minlength=256).astype(float)
    w = np.cumsum(n)
    m = np.cumsum(n * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (m[-1] * w / w[-1] - m) ** 2 / (w * (w[-1] - w))
    return int(np.nanargmax(between)) if np.isfinite(between).any() else 0


def ink(values: np.ndarray, threshold: int = 240) -> np.ndarray:
    """True where an image is darker than the threshold (Otsu's if it is not positive)."""
    return values <= (threshold if threshold > 0 else otsu(values))


def background(values: np.ndarray) -> int:
    """The commonest value."""
    return int(np.argmax(np.bincount(values.ravel(), minlength=256)))


def masked(values: np.ndarray, boxes: np.ndarray, inset: int = 0) -> np.ndarray:
    """values with the insides of boxes (rows x1, y1, x2, y2) painted as background; an axis of up to 2 insets is not inset."""
    out, paper = values.copy(), background(values)
    for box in np.asarray(boxes, int).reshape(-1, 4):
        x1, x2 = sorted((box[0], box[2]))
        y1, y2 = sorted((box[1], box[3]))
        dx, dy = (inset if b - a > 2 * inset else 0 for a, b in ((x1, x2), (y1, y2)))
        out[max(0, y1 + dy) : max(0, y2 - dy), max(0, x1 + dx) : max(0, x2 - dx)] = paper
    return out


def _peeled(a: np.ndarray, even: bool) -> np.ndarray:
    """One half step of the thinning of a padded mask (Zhang and Suen, 1984)."""
    p = [a[:-2, 1:-1], a[:-2, 2:], a[1:-1, 2:], a[2:, 2:], a[2:, 1:-1], a[2:, :-2], a[1:-1, :-2], a[:-2, :-2]]
    n = sum(x.astype(np.int8) for x in p)
    turns = sum((~x & y).astype(np.int8) for x, y in zip(p, [*p[1:], p[0]], strict=True))
    top, right, bottom, left = p[0], p[2], p[4], p[6]
    open_ = ~(top & right & bottom) & ~(right & bottom & left) if even else ~(top & right & left) & ~(top & bottom & left)
    out = a.copy()
    out[1:-1, 1:-1] &= ~((n >= 2) & (n <= 6) & (turns == 1) & open_)
    return out


def thinned(mask: np.ndarray, rounds: float = 0, thick: float = 0) -> np.ndarray:
    """A mask of strokes one pixel wide. Rounds (whole or half) stop earlier, 0 goes on until nothing changes.

    With `thick`, only what lies around strokes at least that wide is thinned.
    """
    if thick > 0:
        wide = depth(mask) >= thick / 2
        if not wide.any():
            return mask.astype(bool)
        radius = max(1, int(np.ceil(thick)))
        around = depth(~wide) <= radius
        return np.where(around, thinned(mask), mask.astype(bool))
    a, steps = np.pad(mask.astype(bool), 1), 0
    while True:
        before = a
        for even in (True, False):
            a = _peeled(a, even)
            steps += 1
            if steps == round(2 * rounds):
                return a[1:-1, 1:-1]
        if (a == before).all():
            return a[1:-1, 1:-1]


def depth(mask: np.ndarray) -> np.ndarray:
    """The distance of each pixel of the mask to the nearest outside it: exact along rows, then the least over columns."""
    h, w = mask.shape
    far = float(h + w)
    out = np.where(mask, far, 0.0)
    for k in range(1, w):  # distance within the row, from both sides
        out[:, k] = np.minimum(out[:, k], out[:, k - 1] + 1)
    for k in range(w - 2, -1, -1):
        out[:, k] = np.minimum(out[:, k], out[:, k + 1] + 1)
    square, best = out**2, out**2
    for step in range(1, h):  # then over rows, nearest first, until no row can be nearer
        if step * step >= best.max():
            break
        shifted = np.full_like(square, far * far)
        shifted[step:] = square[:-step]
        shifted[:-step] = np.minimum(shifted[:-step], square[step:])
        best = np.minimum(best, shifted + step * step)
    return np.sqrt(best)


def stroke_width(mask: np.ndarray) -> float:
    """The mean width of the strokes: ink over the length of their middle lines."""
    bones = int(thinned(mask).sum())
    return float(mask.sum()) / bones if bones else 1.0


#: Fixed values of the colour test, hue in 0..179.
HUE_LOW_MAX, HUE_HIGH_MIN, MIN_SATURATION, MIN_VALUE, MIN_DOMINANCE = 25, 150, 55, 40, 32


def red(rgb: np.ndarray | Indexed) -> np.ndarray:
    """True where the hue is red and strong enough to tell, or red leads green and blue."""
    if isinstance(rgb, Indexed):
        return rgb.told(red)
    out, some = np.zeros(rgb.shape[:-1], bool), np.flatnonzero((rgb[..., 0] != rgb[..., 1]) | (rgb[..., 0] != rgb[..., 2]))  # gray has no hue
    r, g, b = rgb.reshape(-1, rgb.shape[-1])[some, :3].T.astype(float)
    top, low = np.maximum(np.maximum(r, g), b), np.minimum(np.minimum(r, g), b)
    span = np.where(top > low, top - low, 1)
    hue = np.select([top == low, top == r, top == g], [0 * r, (g - b) / span, 2 + (b - r) / span], 4 + (r - g) / span)
    hue = np.rint(30 * hue) % 180
    saturation = np.rint(255 * (top - low) / np.maximum(top, 1))
    strong = (saturation >= MIN_SATURATION) & (top >= MIN_VALUE)
    out.reshape(-1)[some] = (strong & ((hue <= HUE_LOW_MAX) | (hue >= HUE_HIGH_MIN))) | (r - np.maximum(g, b) >= MIN_DOMINANCE)
    return out


def grown(mask: np.ndarray, by: int) -> np.ndarray:
    """A mask with all pixels at most `by` rows and columns away."""
    out = mask.astype(bool)
    for axis in (0, 1):  # a square grows along one axis after the other
        wide, n = out, out.shape[axis]
        for step in range(1, min(by, n - 1) + 1):
            ahead, back = [slice(None)] * 2, [slice(None)] * 2
            ahead[axis], back[axis] = slice(step, None), slice(None, -step)
            wide = wide.copy()
            wide[tuple(ahead)] |= out[tuple(back)]
            wide[tuple(back)] |= out[tuple(ahead)]
        out = wide
    return out


def split(rgb: np.ndarray, dilate: int = 1, threshold: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The black layer (what is darker than the threshold where no red is near, in black) and the red layer, both on white.

    Red is grown before it is erased: the blurred edge of a red stroke is too pale to be told as red.
    """
    is_red = red(rgb)
    black = np.where((gray(rgb) < threshold) & ~grown(is_red, dilate), 0, 255).astype(np.uint8)
    return np.repeat(black[..., None], 3, axis=2), np.where(is_red[..., None], rgb, 255).astype(np.uint8)


def blobs(mask: np.ndarray, least: int = 12) -> list[dict]:
    """The 8-connected parts of at least that many pixels, largest first: area, box and centroid. Joined by runs of pixels."""
    from sheetgraph.operators.tiles import run_components, runs_of_mask

    row, first, end = runs_of_mask(mask)
    if not len(row):
        return []
    kind, place = np.unique(run_components(row, first, end), return_inverse=True)
    n = end - first
    area, sx, sy = (np.bincount(place, w) for w in (n, (first + end - 1) * n / 2, row * n))
    box = np.stack([np.full(len(kind), v) for v in (mask.shape[1], mask.shape[0], 0, 0)])
    for line, values, pick in zip(box, (first, row, end, row + 1), (np.minimum, np.minimum, np.maximum, np.maximum), strict=True):
        pick.at(line, place, values)
    out = [{"area": int(area[k]), **{c: int(v) for c, v in zip(("x1", "y1", "x2", "y2"), box[:, k], strict=True)}, "cx": float(sx[k] / area[k]), "cy": float(sy[k] / area[k])} for k in range(len(kind)) if area[k] >= least]
    return sorted(out, key=lambda b: (-b["area"], b["y1"], b["x1"]))


def supported(mask: np.ndarray, axis: str, level: int, start: int, end: int, band: int = 11, share: float = 0.004) -> bool:
    """One row (or column) of the band around a span holds ink over at least that share of it."""
    if end <= start:
        return True
    m = mask if axis == "h" else mask.T
    half = band // 2
    part = m[max(0, level - half) : max(0, level + half + 1), max(0, start) : max(0, end)]
    return bool(part.size) and float(part.mean(axis=1).max()) >= share


def stroke_profile(mask: np.ndarray, axis: str, level: int, start: int, end: int, band: int = 3) -> np.ndarray:
    """The inkiest row (or column) within `band` of a level, over a span."""
    m = mask if axis == "h" else mask.T
    part = m[max(0, level - band) : level + band + 1, start:end]
    return part[int(part.sum(axis=1).argmax())] if part.size else np.zeros(0, bool)


#: Lines that are looked at together before they are taken one by one.
_LINES = 512


def segments(mask: np.ndarray, votes: int = 14, least: int = 12, gap: int = 4, angles: int = 180) -> list[tuple[float, float, float, float]]:
    """Straight strokes (x1, y1, x2, y2) of a mask, by a Hough transform.

    Every ink pixel votes once for the lines through it. Lines are taken by votes; the pixels
    within one pixel of a line that no earlier one used are cut where over `gap` is blank, and
    parts of `least` pixels or more are segments, whose pixels are used up.
    """
    y, x = np.nonzero(mask)
    if not len(x):
        return []
    theta = np.arange(angles) * np.pi / angles
    cos, sin, reach = np.cos(theta), np.sin(theta), int(np.ceil(np.hypot(*mask.shape)))
    fx, fy, free, out = x.astype(float), y.astype(float), np.ones(len(x), bool), []

    def binned() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The free pixels' count in each bin, and for each angle the pixels in order of their bin, with its first place."""
        left = np.flatnonzero(free)
        count, by_bin = np.zeros((angles, 2 * reach + 3), np.int32), np.zeros((angles, len(left)), np.int32)
        for k in range(angles):
            place = np.rint(x[left] * cos[k] + y[left] * sin[k]).astype(np.int32) + reach + 1
            count[k] = np.bincount(place, minlength=2 * reach + 3)
            by_bin[k] = left[np.argsort(place.astype(np.uint16), kind="stable")]
        return count, by_bin, np.cumsum(count, axis=1) - count

    def hopeful(k: np.ndarray, rho: np.ndarray) -> np.ndarray:
        """True for lines that have a part of `least` pixels now. A line without one never gets one: pixels are only used up."""
        lo, n = first[k, rho - 1], count[k, rho - 1] + count[k, rho] + count[k, rho + 1]
        of = np.repeat(np.arange(len(k)), n)
        own = by_bin.reshape(-1)[np.arange(len(of)) + np.repeat(k * by_bin.shape[1] + lo - (np.cumsum(n) - n), n)]
        some = free[own]
        of, own = of[some], own[some]
        px, py, c, s = fx[own], fy[own], cos[k][of], sin[k][of]
        beside = np.abs(px * c + py * s - (rho - reach - 1)[of]) <= 1
        of, along = of[beside], (py * c - px * s)[beside]
        by = np.lexsort((along, of))
        of, along = of[by], along[by]
        edge = np.flatnonzero((of[1:] != of[:-1]) | (along[1:] - along[:-1] > gap + 1)) + 1
        starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(of)]])
        out = np.zeros(len(k), bool)
        if len(of):
            many = np.bincount(of, minlength=len(k)) >= least
            long = along[ends - 1] - along[starts] + 1 >= least
            out[of[starts[long]]] = True
            out &= many
        return out

    count, by_bin, first = binned()
    k, rho = np.nonzero(count >= votes)
    order = np.argsort(-count[k, rho], kind="stable")
    k, rho, n_free, n_binned = k[order], rho[order], len(x), len(x)
    todo: list[tuple[int, int]] = []
    while todo or len(k):
        if not todo:
            if n_free < 0.7 * n_binned:
                count, by_bin, first = binned()
                n_binned = n_free
                enough = count[k, rho - 1] + count[k, rho] + count[k, rho + 1] >= least
                k, rho = k[enough], rho[enough]
            may = hopeful(k[:_LINES], rho[:_LINES])
            todo = list(zip(k[:_LINES][may].tolist(), rho[:_LINES][may].tolist(), strict=True))[::-1]
            k, rho = k[_LINES:], rho[_LINES:]
            continue
        a, r = todo.pop()
        own = by_bin[a, first[a, r - 1] : first[a, r + 1] + count[a, r + 1]]
        own = own[free[own]]
        if len(own) < least:
            continue
        px, py = fx[own], fy[own]
        beside = np.abs(px * cos[a] + py * sin[a] - (r - reach - 1)) <= 1
        along = (py * cos[a] - px * sin[a])[beside]
        if len(along) < least:
            continue
        by = np.argsort(along, kind="stable")
        along = along[by]
        edge = np.flatnonzero(along[1:] - along[:-1] > gap + 1) + 1
        starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(along)]])
        long = along[ends - 1] - along[starts] + 1 >= least
        if not long.any():
            continue
        own = own[beside][by]
        for lo, hi in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            p, q = own[lo], own[hi - 1]
            out.append((float(x[p]), float(y[p]), float(x[q]), float(y[q])))
            free[own[lo:hi]] = False
            n_free -= hi - lo
    return out


def pixels(row: dict) -> np.ndarray | Indexed:
    """The RGB pixels of an image row (height, width, pixels), or of one drawn where it is read, whose pixels are an array."""
    if isinstance(row["pixels"], np.ndarray | Indexed):
        return row["pixels"]
    return np.frombuffer(bytes(row["pixels"]), np.uint8).reshape(row["height"], row["width"], 3)


def detect_lines(boxes: bool = True, threshold: int = 240, inset: int = 0, thin: float | None = 0, detector: str = "hough", inside: tuple[float, float, float, float] | None = None, axis_degrees: float | None = None, **how) -> Stage:
    """A stage from images (sheet_id, height, width, pixels and, with boxes, boxes: array of x1, y1, x2, y2) to segments.

    Gray, and boxes masked. `hough` then binarizes, thins (None: not) and searches the mask; `level_lines` searches the gray
    image. Segments are cut to the box `inside` and, with axis_degrees, only those as near to an axis stay. Rows are
    (sheet_id, line_ix, x1, y1, x2, y2) in pixels. how goes to the detector; without `least` it
    follows from the strokes' width.
    """
    if detector not in ("hough", "level_lines"):
        raise ValueError(f"no such detector: {detector}")

    def each(row: pd.Series) -> list[dict]:
        from sheetgraph.operators import level_lines

        values = gray(pixels(row))
        if boxes and row["boxes"] is not None and len(row["boxes"]):
            values = masked(values, np.array([list(b) for b in row["boxes"]]), inset)
        if inside is not None:
            x1, y1, x2, y2 = (int(v) for v in inside)
            out = np.full_like(values, background(values))
            out[y1:y2, x1:x2] = values[y1:y2, x1:x2]
            values = out
        drawn = ink(values, threshold)
        least = how.get("least") or max(2, round(1.7 * stroke_width(drawn)))
        if detector == "hough":
            found = segments(drawn if thin is None else thinned(drawn, thin), **{**how, "least": least})
        else:
            found = level_lines.strokes(values, least)
        if inside is not None:
            edge = lambda v, lo, hi: min(max(v, lo), hi)
            found = [(edge(a, x1, x2), edge(b, y1, y2), edge(c, x1, x2), edge(d, y1, y2)) for a, b, c, d in found]
        if axis_degrees is not None:
            slack = np.tan(np.radians(axis_degrees))
            found = [s for s in found if min(abs(s[2] - s[0]), abs(s[3] - s[1])) <= slack * max(abs(s[2] - s[0]), abs(s[3] - s[1]))]
        return [{"sheet_id": row["sheet_id"], "line_ix": k, "x1": a, "y1": b, "x2": c, "y2": d} for k, (a, b, c, d) in enumerate(found)]

    return image_stage(each, "sheet_id long, line_ix long, x1 double, y1 double, x2 double, y2 double")


def _per_image(images: DataFrame, rows: DataFrame, each: Callable[[np.ndarray, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """each(ink mask, the rows of a sheet), sheet by sheet; rows of sheets without an image are left out."""

    def run(key: tuple, image: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(image) or not len(own):
            return pd.DataFrame(columns=[c.strip().split()[0] for c in schema.split(",")])
        out = each(ink(gray(pixels(image.iloc[0]))), own)
        out.insert(0, "sheet_id", key[0])
        return out

    return images.groupBy("sheet_id").cogroup(rows.groupBy("sheet_id")).applyInPandas(run, schema)


def evidence(images: DataFrame, spans: DataFrame, scale: float = 1.0, band: int = 11, share: float = 0.004) -> DataFrame:
    """(sheet_id, span_id, evidence) of spans (span_id, axis, level, lo, hi), whose coordinates are `scale` times the image's."""

    def each(mask: np.ndarray, own: pd.DataFrame) -> pd.DataFrame:
        wide = np.pad(mask, 1)  # strokes are taken one pixel wider on all sides
        wide = np.max([wide[1 + i : 1 + i + mask.shape[0], 1 + j : 1 + j + mask.shape[1]] for i in (-1, 0, 1) for j in (-1, 0, 1)], axis=0)
        at = lambda c: np.floor(own[c].to_numpy(float) / scale).astype(int)
        seen = [supported(wide, *x, band=band, share=share) for x in zip(own["axis"], at("level"), at("lo"), at("hi"), strict=True)]
        return pd.DataFrame({"span_id": own["span_id"].to_numpy(), "evidence": seen})

    return _per_image(images, spans, each, f"sheet_id long, span_id {spans.schema['span_id'].dataType.simpleString()}, evidence boolean")


def profiles(images: DataFrame, spans: DataFrame, band: int = 3) -> DataFrame:
    """(sheet_id, span_id, first, length, ink): the stroke runs of the inkiest row or column within `band` of each span."""

    def each(mask: np.ndarray, own: pd.DataFrame) -> pd.DataFrame:
        out = []
        for span, axis, level, lo, hi in zip(own["span_id"], own["axis"], own["level"], own["lo"], own["hi"], strict=True):
            row = stroke_profile(mask, axis, int(level), max(0, int(lo)), int(hi), band)
            if len(row):
                edge = np.concatenate([[0], np.flatnonzero(row[1:] != row[:-1]) + 1, [len(row)]])
                out += [(span, max(0, int(lo)) + int(a), int(b - a), bool(row[a])) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        return pd.DataFrame(out, columns=["span_id", "first", "length", "ink"])

    return _per_image(images, spans, each, "sheet_id long, span_id long, first long, length long, ink boolean")
