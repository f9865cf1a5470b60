"""Images of sheets: Spark's image source, and sheets drawn from the derived segments."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheetgraph.operators import raster as r
from sheetgraph.operators import tiles
from sheetgraph.sources import derived as d
from sheetgraph.sources import png as codec

#: Pixels of a drawn sheet to one of its own.
SCALE = 10
IMAGE = "sheet_id long, height int, width int, pixels binary"


FILE = "path string, height int, width int, gray boolean, pixels binary, error string"


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """path, height, width, gray, RGB pixels and error of PNG files of any kind.

    A file that can't be read is a row with an error and no pixels. Formats of other libraries come through
    other_images().
    """
    return decoded(spark.read.format("binaryFile").load(path))


def decoded(files: DataFrame) -> DataFrame:
    """The same of rows (path, content); one image at a time is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                try:
                    p, error = codec.decode(b.column("content")[k].as_py() or b""), None
                except (ValueError, zlib.error, struct.error) as e:
                    p, error = None, str(e)
                own = {"path": b.column("path").slice(k, 1), "height": None if p is None else p.shape[0], "width": None if p is None else p.shape[1], "gray": None if p is None else p.ndim == 2}
                own["pixels"] = None if p is None else (np.repeat(p[..., None], 3, axis=2) if p.ndim == 2 else p).tobytes()
                kinds = {"height": pa.int32(), "width": pa.int32(), "gray": pa.bool_(), "pixels": pa.binary()}
                yield pa.RecordBatch.from_pydict({c: v if c == "path" else pa.array([v], kinds[c]) for c, v in own.items()} | {"error": pa.array([error], pa.string())})

    return files.select("path", "content").mapInArrow(run, FILE)


def other_images(spark: SparkSession, path: str) -> DataFrame:
    """The same columns of files that Spark's image source reads (JPEG, BMP, GIF), of one, three or four channels."""
    i = spark.read.format("image").load(path).select("image.*")

    def turned(data: bytes, channels: int) -> bytes | None:
        if channels not in (1, 3, 4):
            return None
        p = np.frombuffer(bytes(data), np.uint8).reshape(-1, channels)
        if channels == 4:  # blue, green, red, alpha
            a = p[:, 3:].astype(np.uint32)
            p = ((p[:, :3] * a + 255 * (255 - a) + 127) // 255).astype(np.uint8)
        return (np.repeat(p, 3, axis=1) if channels == 1 else p[:, 2::-1]).tobytes()

    turn = F.udf(turned, "binary", useArrow=True)
    good = F.col("nChannels") > 0
    return i.select(F.col("origin").alias("path"), *[F.when(good, F.col(c)).alias(c) for c in ("height", "width")], F.when(good, F.col("nChannels") == 1).alias("gray"), F.when(good, turn("data", "nChannels")).alias("pixels"), F.when(~good, F.lit("not an image that Spark reads")).alias("error"))


def png(rgb: np.ndarray) -> bytes:
    """An image as a PNG file."""
    return codec.encode(rgb, filters=0, level=1)


def _sheet(own: pd.DataFrame) -> np.ndarray:
    """A sheet's segments at a tenth of their size, red ones last."""
    rgb = np.full((d.HEIGHT // SCALE, d.WIDTH // SCALE, 3), 255, np.uint8)
    whole = {c: own[c].astype(np.int64) for c in ("line_ix", "pos", "lo", "hi")}
    for colour, third in (((0, 0, 0), False), ((220, 30, 30), True)):
        some = (whole["line_ix"] % 3 == 0) == third
        for axis, pos, lo, hi, kind in zip(own["axis"][some], *[whole[c][some] // SCALE for c in ("pos", "lo", "hi")], own["line_type"][some], strict=True):
            at = np.arange(lo, hi)
            at = at[at % 10 < 6] if kind == "dashed" else at
            x, y = (at, np.full_like(at, pos)) if axis == "h" else (np.full_like(at, pos), at)
            on = (x >= 0) & (y >= 0) & (x < rgb.shape[1]) & (y < rgb.shape[0])
            rgb[y[on], x[on]] = colour
    return rgb


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.segments(spark, sf_dir).select("sheet_id", "line_ix", "axis", "pos", "lo", "hi", "line_type")


def drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each derived sheet at a tenth of its size: strokes one pixel wide, every third red; dashed ones have 6 of 10 pixels."""

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        rgb = _sheet(pdf)
        return pd.DataFrame({"sheet_id": [pdf["sheet_id"].iloc[0]], "height": [rgb.shape[0]], "width": [rgb.shape[1]], "pixels": [rgb.tobytes()]})

    return _spread(_segments(spark, sf_dir), "sheet_id").groupBy("sheet_id").applyInPandas(draw, IMAGE)


def sheets_on_reading(spark: SparkSession, sf_dir: str, boxes: DataFrame | None = None) -> tiles.Drawn:
    """The same sheets, drawn where they are read, with `boxes` (sheet_id, bx1, by1, bx2, by2) as rows of an array."""
    rows, boxed = _segments(spark, sf_dir), boxes is not None
    rows = rows if not boxed else rows.unionByName(boxes, allowMissingColumns=True)

    def draw(own: pd.DataFrame, wanted: set | None = None) -> Iterator[dict]:
        strokes_ = own[own["axis"].notna()]
        if len(strokes_):  # a sheet without a segment has no image
            rgb = _sheet(strokes_)
            own_boxes = [] if not boxed else own.loc[own["axis"].isna(), ["bx1", "by1", "bx2", "by2"]].to_numpy(np.int64)
            yield {"sheet_id": own["sheet_id"].iloc[0], "height": rgb.shape[0], "width": rgb.shape[1], "pixels": rgb, "boxes": own_boxes}

    return tiles.Drawn(rows, draw)


def _spread(df: DataFrame, *key: str) -> DataFrame:
    """df by key, in as many partitions as shuffles have: its rows are few bytes but much work, so partitions are not to be merged by size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)


#: Dashed strokes of a full-size sheet: pixels on and off.
DASH, GAP = 40, 16


def strokes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived segments as strokes one pixel wide (sheet_id, axis, pos, lo, hi, red, dash, gap, base); dashes are counted from base."""
    dashed = F.col("line_type") == "dashed"
    return d.segments(spark, sf_dir).select("sheet_id", "axis", "pos", "lo", "hi", (F.col("line_ix") % 3 == 0).alias("red"), F.when(dashed, DASH).alias("dash"), F.when(dashed, GAP).alias("gap"), F.lit(0).cast("long").alias("base"))


def _by_tile(strokes: DataFrame, grid: tiles.Grid) -> DataFrame:
    """Strokes, once for each tile that may show some of them."""
    h = F.col("axis") == "h"
    x = grid.seers(F.when(h, F.col("lo")).otherwise(F.col("pos")), F.when(h, F.col("hi") - 1).otherwise(F.col("pos")), grid.width)
    y = grid.seers(F.when(h, F.col("pos")).otherwise(F.col("lo")), F.when(h, F.col("pos")).otherwise(F.col("hi") - 1), grid.height)
    within = F.when(h, (F.col("pos") >= 0) & (F.col("pos") < grid.height) & (F.col("lo") < grid.width)).otherwise((F.col("pos") >= 0) & (F.col("pos") < grid.width) & (F.col("lo") < grid.height)) & (F.col("hi") > F.greatest("lo", F.lit(0)))
    return strokes.where(within).withColumn("tx", F.explode(x)).withColumn("ty", F.explode(y))


_STROKE = ["axis", "pos", "lo", "hi", "red", "dash", "gap", "base"]
#: Colours of drawn tiles: paper, black and red, which lies over black.
COLOURS = np.array([[255, 255, 255], [0, 0, 0], [220, 30, 30]], np.uint8)


class _Strokes:
    """A sheet's strokes, from which tiles are drawn one after another."""

    def __init__(self, own: pd.DataFrame):
        own = own.sort_values("red", kind="stable")  # red ones last
        whole = {c: own[c].to_numpy(np.int64) for c in ("pos", "lo", "hi", "base")}  # floats where rows of other kinds lack them
        self.flat, self.colour = own["axis"].to_numpy() == "h", np.where(own["red"].to_numpy(bool), 2, 1)
        self.pos, self.lo, self.hi, self.base = whole["pos"], whole["lo"], np.where(whole["hi"] > np.maximum(whole["lo"], 0), whole["hi"], -1), whole["base"]
        self.dash, self.gap = (own[c].fillna(0).to_numpy(np.int64) for c in ("dash", "gap"))
        self.rhythm: dict[tuple[int, int, int], np.ndarray] = {}  # dashes of a colour, some of which a stroke shows

    def over(self, left: int, top: int, width: int, height: int) -> np.ndarray:
        """The numbers of the strokes that may show in a tile, in their order."""
        across = np.where(self.flat, self.pos - top, self.pos - left)
        along = np.where(self.flat, left, top)
        long, wide = np.where(self.flat, width, height), np.where(self.flat, height, width)
        return np.flatnonzero((across >= 0) & (across < wide) & (self.lo < along + long) & (self.hi > along))

    def drawn(self, some: np.ndarray, left: int, top: int, width: int, height: int) -> np.ndarray:
        """The numbers of colours of a tile's pixels."""
        image = np.zeros((height, width), np.uint8)
        flat = self.flat[some]
        along = np.where(flat, left, top)
        first, end = np.maximum(self.lo[some] - along, 0), np.minimum(self.hi[some] - along, np.where(flat, width, height))
        columns = (flat, self.pos[some] - np.where(flat, top, left), first, end, self.colour[some], self.dash[some], self.gap[some], first + along - self.base[some])
        for h, at, a, b, colour, dash, gap, since in zip(*[c.tolist() for c in columns], strict=True):
            line = image[at, a:b] if h else image[a:b, at]
            if not dash:
                line[:] = colour
                continue
            period = dash + gap
            if (dash, gap, colour) not in self.rhythm:
                self.rhythm[dash, gap, colour] = np.where(np.arange(max(width, height) + period) % period < dash, colour, 0).astype(np.uint8)
            since %= period
            np.maximum(line, self.rhythm[dash, gap, colour][since : since + b - a], out=line)
        return image


def _stroked(grid: tiles.Grid, key: tuple, own: pd.DataFrame) -> r.Indexed:
    """A tile's strokes on white."""
    at = (grid.start(key[1], grid.width), grid.start(key[2], grid.height), min(grid.size, grid.width), min(grid.size, grid.height))
    strokes_ = _Strokes(own)
    return r.Indexed(strokes_.drawn(strokes_.over(*at), *at), COLOURS)


def _tile(grid: tiles.Grid, key: tuple, image: r.Indexed) -> dict:
    sheet, tx, ty = key
    return {"sheet_id": sheet, "tx": tx, "ty": ty, "x": grid.start(tx, grid.width), "y": grid.start(ty, grid.height), "height": image.shape[0], "width": image.shape[1], "pixels": image}


def _as_tile(grid: tiles.Grid, key: tuple, image: r.Indexed) -> pd.DataFrame:
    return pd.DataFrame([_tile(grid, key, image) | {"pixels": np.asarray(image).tobytes()}])


def drawn_tiles(strokes: DataFrame, grid: tiles.Grid) -> DataFrame:
    """Strokes drawn at full size, tile by tile: no task holds a sheet. Red lies over black; tiles without a stroke have no row."""

    def draw(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        return _as_tile(grid, key, _stroked(grid, key, own))

    return _spread(_by_tile(strokes, grid), *tiles.KEY).groupBy(*tiles.KEY).applyInPandas(draw, tiles.TILE)


def _tilewise(grid: tiles.Grid, own: pd.DataFrame, wanted: set | None, symbols: bool = False) -> Iterator[dict]:
    """The tiles of a sheet's strokes (and symbols) that show any, row by row."""
    if not len(own):
        return
    sheet, lines = own["sheet_id"].iloc[0], _Strokes(own[own["axis"].notna()])
    placed = _Placed(own[own["class"].notna()]) if symbols else None
    for tx, ty, left, top in grid.tiles():
        if wanted is None or (tx, ty) in wanted:
            at = (left, top, min(grid.size, grid.width), min(grid.size, grid.height))
            some, above = lines.over(*at), [] if placed is None else placed.over(*at)
            if len(some) or len(above):
                image = lines.drawn(some, *at)
                if len(above):
                    placed.lay(image, above, left, top)
                yield _tile(grid, (sheet, tx, ty), r.Indexed(image, COLOURS))


def drawn_on_reading(strokes: DataFrame, grid: tiles.Grid) -> tiles.Drawn:
    """The same tiles, drawn where they are read: strokes move once, pixels don't."""
    return tiles.Drawn(strokes.select("sheet_id", *_STROKE), lambda own, wanted=None: _tilewise(grid, own, wanted))


#: Widths of drawn symbols; a sheet has one of the last three, and every fifth of its symbols the width before.
WIDTHS = [10, 14, 20, 28]
CLASSES = ["gate valve", "reducer", "bubble"]


@lru_cache(maxsize=64)
def glyph(name: str, width: int) -> np.ndarray:
    """A symbol's ink in a square of that width: a bow tie between two bars, a wedge or a ring. Drawn once, so not to be written to."""
    mask = _drawn_glyph(name, width)
    mask.flags.writeable = False
    return mask


def _drawn_glyph(name: str, width: int) -> np.ndarray:
    at = (2 * np.arange(width) + 1) / width - 1
    u, v = at[None, :], at[:, None]
    pen = max(0.16, 2 / width)
    if name == "gate valve":
        return (np.abs(u) <= 0.9) & (np.abs(v) <= 0.9) & ((np.abs(np.abs(v) - np.abs(u)) < pen) | (np.abs(u) > 0.9 - pen))
    if name == "reducer":
        return (np.abs(u) <= 0.9) & (np.abs(v) <= 0.6 - 0.3 * u)
    far = np.hypot(u, v)
    return (far <= 0.95) & (far > 0.95 - 1.3 * pen)


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived symbols as drawn on sheets of half the size (sheet_id, symbol_id, class, width, x1, y1): two of four are valves."""
    s = d.symbols(spark, sf_dir)
    n = F.expr("symbol_id div 3")
    size = F.lit(1) + F.col("sheet_id") % 3 - F.when(n % 5 == 0, 1).otherwise(0)
    width = F.element_at(F.array(*map(F.lit, WIDTHS)), (size + 1).cast("int"))
    name = F.when(n % 4 < 2, CLASSES[0]).when(n % 4 == 2, CLASSES[1]).otherwise(CLASSES[2])
    corner = lambda c: (F.expr(f"({c} + 20) div 2") - F.expr("width div 2")).cast("long").alias(c)
    return s.withColumns({"width": width, "class": name}).select("sheet_id", "symbol_id", "class", "width", corner("x1"), corner("y1"))


def _plate_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The strokes and symbols of sheets of half the size."""
    half = lambda c: F.expr(f"{c} div 2").alias(c)
    return strokes(spark, sf_dir).select("sheet_id", "axis", half("pos"), half("lo"), half("hi"), "red", "dash", "gap", "base"), planted(spark, sf_dir)


class _Placed:
    """A sheet's symbols: white squares with a symbol's ink each, a later one over an earlier one."""

    def __init__(self, symbols: pd.DataFrame):
        symbols = symbols.sort_values("symbol_id", kind="stable")
        self.name = symbols["class"].tolist()
        self.width, self.x1, self.y1 = (symbols[c].to_numpy(np.int64) for c in ("width", "x1", "y1"))

    def over(self, left: int, top: int, width: int, height: int) -> np.ndarray:
        within = lambda at, start, long: (at < start + long) & (at + self.width > start)
        return np.flatnonzero(within(self.x1, left, width) & within(self.y1, top, height))

    def lay(self, image: np.ndarray, some: np.ndarray, left: int, top: int) -> None:
        for k, w, x, y in zip(some.tolist(), self.width[some].tolist(), (self.x1[some] - left).tolist(), (self.y1[some] - top).tolist(), strict=True):
            a, b, c, e = max(x, 0), min(x + w, image.shape[1]), max(y, 0), min(y + w, image.shape[0])
            image[c:e, a:b] = glyph(self.name[k], w)[c - y : e - y, a - x : b - x]


def plates(spark: SparkSession, sf_dir: str, grid: tiles.Grid) -> DataFrame:
    """Tiles of sheets of half the size: strokes, with symbols in white squares over them (a later one over an earlier one)."""
    lines, placed = _plate_parts(spark, sf_dir)
    x, y = (grid.seers(F.col(c), F.col(c) + F.col("width") - 1, along) for c, along in (("x1", grid.width), ("y1", grid.height)))

    def draw(key: tuple, own: pd.DataFrame, symbols: pd.DataFrame) -> pd.DataFrame:
        image, above = _stroked(grid, key, own), _Placed(symbols)
        above.lay(image.numbers, np.arange(len(symbols)), grid.start(key[1], grid.width), grid.start(key[2], grid.height))
        return _as_tile(grid, key, image)

    return _spread(_by_tile(lines, grid), *tiles.KEY).groupBy(*tiles.KEY).cogroup(placed.withColumn("tx", F.explode(x)).withColumn("ty", F.explode(y)).groupBy(*tiles.KEY)).applyInPandas(draw, tiles.TILE)


def plates_on_reading(spark: SparkSession, sf_dir: str, grid: tiles.Grid) -> tiles.Drawn:
    """The same tiles, drawn where they are read."""
    lines, placed = _plate_parts(spark, sf_dir)
    return tiles.Drawn(lines.unionByName(placed, allowMissingColumns=True), lambda own, wanted=None: _tilewise(grid, own, wanted, symbols=True))


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived segments, each in a lane of its own (ten pixels from the next, cut to 440): what crosses or covers nothing else can be told by its rhythm alone.

    Horizontal ones fill the left half of a sheet, vertical ones the right; dashes are 8 on and 5 off, from the segment's start.
    """
    s = d.segments(spark, sf_dir)
    n = F.row_number().over(Window.partitionBy("sheet_id", "axis").orderBy("line_ix")) - 1
    lanes = F.when(F.col("axis") == "h", 299).otherwise(199)
    placed = s.withColumn("_n", n).withColumns({"_l": F.col("_n") % lanes, "_c": F.floor(F.col("_n") / lanes)})
    start = (F.col("_c") * 500 + 4).cast("long")
    length = F.least(F.col("hi") - F.col("lo"), F.lit(440))
    pos = (10 * F.col("_l") + F.when(F.col("axis") == "h", 5).otherwise(2005)).cast("long")
    dashed = F.col("line_type") == "dashed"
    return placed.select("sheet_id", "line_ix", "axis", pos.alias("pos"), start.alias("lo"), (start + length).alias("hi"), "line_type", F.lit(False).alias("red"), F.when(dashed, 8).alias("dash"), F.when(dashed, 5).alias("gap"), start.alias("base"))


#: The pixels of full-size sheets in SQL: fx(sheet_id, x, y, red).
FULL = f"""fx as (select sheet_id, x, y, bool_or(red) as red from (select sheet_id, line_ix % 3 = 0 as red, case when axis='h' then k else pos end as x, case when axis='h' then pos else k end as y, line_type, k from (select *, unnest(range(lo, hi)) as k from segments))
 where (line_type <> 'dashed' or k % {DASH + GAP} < {DASH}) and x between 0 and {d.WIDTH - 1} and y between 0 and {d.HEIGHT - 1} group by sheet_id, x, y)"""


#: The pixels of drawn() in SQL: px(sheet_id, x, y, red).
PIXELS = """px as (select sheet_id, x, y, bool_or(red) as red from (select sheet_id, line_ix % 3 = 0 as red, case when axis='h' then k else cast(floor(pos/10.0) as bigint) end as x, case when axis='h' then cast(floor(pos/10.0) as bigint) else k end as y, line_type, k from (select *, unnest(range(lo // 10, hi // 10)) as k from segments))
 where (line_type <> 'dashed' or k % 10 < 6) and x between 0 and 399 and y between 0 and 299 group by sheet_id, x, y)"""
