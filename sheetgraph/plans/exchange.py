"""Queries of readers and writers: tables go out as nested payloads and come back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheetgraph.operators import lines as ln
from sheetgraph.plans import stages
from sheetgraph.plans.registry import query
from sheetgraph.sources import derived as d
from sheetgraph.sources import payload as p

C4 = ("topX", "topY", "bottomX", "bottomY")


def _boxes(df):
    return [F.col(a).cast("double").alias(b) for a, b in zip(("x1", "y1", "x2", "y2"), C4, strict=True)]


def payloads(spark, sf):
    """Derived sheets as detection payloads (JSON text)."""
    s = d.symbols(spark, sf).groupBy("sheet_id").agg(F.array_sort(F.collect_list(F.struct("symbol_id", F.struct(*_boxes(None), F.col("symbol_id").alias("id"), "label", F.lit(None).cast("double").alias("score"), "text_associated").alias("v")))).alias("s"))
    x = d.texts(spark, sf).groupBy("sheet_id").agg(F.array_sort(F.collect_list(F.struct("text_ix", F.struct(*_boxes(None), "text").alias("v")))).alias("t"))
    sheet = s.join(x, "sheet_id").select("sheet_id", F.struct(F.lit("png").alias("format"), F.lit(d.WIDTH).alias("width"), F.lit(d.HEIGHT).alias("height")).alias("image_details"), F.transform("t", lambda v: v["v"]).alias("all_text_list"), F.transform("s", lambda v: v["v"]).alias("text_and_symbols_associated_list"))
    return sheet.select("sheet_id", F.to_json(F.struct("image_details", "all_text_list", "text_and_symbols_associated_list")).alias("json"))


def parsed(spark, sf):
    return payloads(spark, sf).select("sheet_id", F.from_json("json", p.DETECTIONS).alias("j")).select("sheet_id", "j.*")


@query("s01_symbols_of_payload", "select sheet_id, symbol_id, row_number() over (partition by sheet_id order by symbol_id) - 1 as ord, label, cast(x1 as double) as x1, cast(y2 as double) as y2, text_associated from symbols")
def s01(spark, sf):
    return p.symbols_of(parsed(spark, sf)).select("sheet_id", "symbol_id", "ord", "label", "x1", "y2", "text_associated")


@query("s01_texts_of_payload", "select sheet_id, row_number() over (partition by sheet_id order by text_ix) - 1 as text_ix, text, cast(x1 as double) as x1 from texts")
def s01_texts(spark, sf):
    return p.texts_of(parsed(spark, sf)).select("sheet_id", "text_ix", "text", "x1")


@query("s02_lines_of_payload", "select sheet_id, line_ix, round(x1,6) as x1, round(y2,6) as y2, line_type from lines")
def s02(spark, sf):
    l = d.lines(spark, sf)
    item = F.struct(F.col("x1").alias("startX"), F.col("y1").alias("startY"), F.col("x2").alias("endX"), F.col("y2").alias("endY"), "line_type")
    sheet = l.groupBy("sheet_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_ix", item.alias("v")))), lambda v: v["v"]).alias("line_segments"))
    j = sheet.select("sheet_id", F.from_json(F.to_json(F.struct("line_segments")), p.LINES).alias("j")).select("sheet_id", "j.*")
    return p.lines_of(j).select("sheet_id", "line_ix", F.round("x1", 6).alias("x1"), F.round("y2", 6).alias("y2"), "line_type")


@query("s03_adapted_export", "select sheet_id, row_number() over (partition by sheet_id order by symbol_id) - 1 as symbol_id, case symbol_id % 4 when 0 then 'Instrument/Valve/Ball valve NO' when 1 then 'Piping/Fittings/Reducer' when 2 then 'Instrument/Indicator/Panel box' end as label, round(greatest(0,least(1,(x1-300)/4000.0)),6) as x1 from symbols where symbol_id % 4 <> 3")
def s03(spark, sf):
    cls = F.element_at(F.array(F.lit("Ball_Valve"), F.lit("Reducer"), F.lit("box"), F.lit("Not_used")), (F.col("symbol_id") % 4 + 1).cast("int"))
    item = F.struct(F.col("symbol_id").alias("id"), cls.alias("class"), F.lit(0.5).alias("score"), F.array(*[(F.col(c) - 300).cast("double") for c in ("x1", "y1", "x2", "y2")]).alias("bbox"), F.lit(None).cast("string").alias("tag"))
    e = d.symbols(spark, sf).groupBy("sheet_id").agg(F.array_sort(F.collect_list(item)).alias("symbols")).select("sheet_id", F.lit("").alias("image"), F.lit(d.WIDTH).alias("image_width"), F.lit(d.HEIGHT).alias("image_height"), "symbols", F.array().cast("array<struct<text:string,score:double,bbox:array<double>>>").alias("texts"))
    return p.symbols_of(p.adapt_export(e)).select("sheet_id", "symbol_id", "label", F.round("x1", 6).alias("x1"))


@query("s04_stored_results", "select sheet_id, text, cast(x1 as double) as x1 from texts where sheet_id % 2 = 0 union all select sheet_id, text_associated, cast(x1 as double) from symbols where sheet_id % 2 = 1 and text_associated is not null")
def s04(spark, sf):
    dbl = [F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]
    ocr = d.texts(spark, sf).where("sheet_id % 2 = 0").select("sheet_id", "text", F.lit(1.0).alias("score"), *dbl)
    a = d.symbols(spark, sf).where("text_associated is not null").select("sheet_id", F.col("text_associated").alias("tag"), F.lit(1.0).alias("confidence"), *dbl)
    sizes = d.symbols(spark, sf).select("sheet_id").distinct().select("sheet_id", F.lit(d.WIDTH).alias("width"), F.lit(d.HEIGHT).alias("height"))
    return p.stored_results(a, ocr, sizes).select("sheet_id", "text", "x1")


@query("s08_answered_tiles", "select sheet_id, tile, sheet_id % 3 <> 0 as answered, case when sheet_id % 3 <> 0 then 10 + 640.0*tile end as x1 from (select distinct sheet_id from symbols), (select unnest([0,1]) as tile)")
def s08(spark, sf):
    s = d.symbols(spark, sf).select("sheet_id").distinct()
    tiles = s.select("sheet_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("tile")).select("*", F.concat_ws("_", "sheet_id", "tile").alias("k")).select("sheet_id", "tile", F.concat("k", F.lit(".png")).alias("file"), (640 * F.col("tile")).alias("x"), F.lit(0).alias("y"))
    answers = tiles.where("sheet_id % 3 <> 0").select(F.regexp_replace("file", ".png", "").alias("stem"), F.array(F.struct(F.lit("a").alias("label"), F.array(*[F.lit(float(v)) for v in (10, 20, 30, 40)]).alias("bbox"))).alias("symbols"))
    return p.answered_tiles(tiles, answers).select("sheet_id", "tile", "answered", F.try_element_at("symbols", F.lit(1))["bbox"][0].alias("x1"))


@query("s09_read_through", "select sheet_id, count(*) as n from texts group by sheet_id")
def s09(spark, sf):
    import uuid

    path = f"{stages.shared_dir(spark)}/cache-{uuid.uuid4().hex}"
    make = lambda: d.texts(spark, sf).groupBy("sheet_id").agg(F.count("*").alias("n"))
    stages._LIVE[path] = spark  # removed when the driver ends
    stages.read_through(spark, path, make)
    return stages.read_through(spark, path, lambda: make().limit(0))


@query("s12_rounded_sink", "select sheet_id, line_ix, round_even(x1/7.0,1) as x1 from lines")
def s12(spark, sf):
    from sheetgraph.plans.job import _folder

    path = _folder(spark, "rounded")
    p.write_json(p.rounded(d.lines(spark, sf).select("sheet_id", "line_ix", (F.col("x1") / 7).alias("x1")), ["x1"]), path)
    return spark.read.schema("sheet_id bigint, line_ix bigint, x1 double").json(path)


@query("s15_viewer_json", "select sheet_id, symbol_id, label, x1, y1 from symbols")
def s15(spark, sf):
    """What a viewer is handed: one JSON text per sheet, taken apart again."""
    one = d.symbols(spark, sf).groupBy("sheet_id").agg(F.to_json(F.collect_list(F.struct("symbol_id", "label", "x1", "y1"))).alias("json"))
    return one.select("sheet_id", F.inline(F.from_json("json", "array<struct<symbol_id:bigint,label:string,x1:bigint,y1:bigint>>")))
