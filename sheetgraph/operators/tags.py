"""What a sheet's own tags say about its numbering, and repairs by it."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetgraph.functions import text as t

# Class names of the detector and the labels they stand for; None drops the detection.
CLASS_LABELS = {
    "Not_used": None,
    "Gate_Valve": "Instrument/Valve/Gate valve NO",
    "Gate_valve_NO": "Instrument/Valve/Gate valve NO",
    "Gate_Valve_NC": "Instrument/Valve/Gate valve NC",
    "Half_Filled_Gate_Valve": "Instrument/Valve/Gate valve NO",
    "Ball_Valve": "Instrument/Valve/Ball valve NO",
    "Ball_valve_NC": "Instrument/Valve/Ball valve NC",
    "Globe_valve_NO": "Instrument/Valve/Globe valve NO",
    "Globle_valve_NC": "Instrument/Valve/Globe valve NC",
    "Butterfly_valve": "Instrument/Valve/Butterfly Valve",
    "Plug valve": "Instrument/Valve/Plug valve",
    "Check_valve": "Instrument/Valve/Check valve",
    "Diaphragm_valve": "Instrument/Valve/Diaphragm valve",
    "Needle_valve": "Instrument/Valve/Needle Valve",
    "Control_Valve": "Instrument/Valve/Control Valve",
    "Rotary_Valve": "Instrument/Valve/Rotary valve NO",
    "Rupture_disk": "Instrument/Valve/Relief valve",
    "Flow_Arrow": "Piping/Fittings/Mid arrow flow direction",
    "Other": None,
    "Flange_or_Nozzle": "Piping/Fittings/Flanged connection",
    "Reducer": "Piping/Fittings/Reducer",
    "Paddle_blind": "Piping/Fittings/Paddle blind",
    "Spectacle_blind_Open": "Piping/Fittings/Spectacle blind open",
    "Spectacle_blind_Closed": "Piping/Fittings/Spectacle blind closed",
    "Instrument_Field": "Instrument/Indicator/Field mounted discrete indicator",
    "Instrument_Panel": "Instrument/Indicator/discrete with Pri",
    "Instrument_Aux_Panel": "Instrument/Indicator/discrete with Aux Loc access",
    "sight_glass": "Instrument/Indicator/Sight glass",
    "box": "Instrument/Indicator/Panel box",
    "Pipe_Insulation_or_Tracing": "Piping/Fittings/Insulation or tracing",
}


def with_label(df: DataFrame, class_col: str, labels: dict[str, str | None] = CLASS_LABELS) -> DataFrame:
    """df with `label`: null for a class that stands for nothing, an error for an unknown one."""
    known = F.array(*[F.lit(k) for k in labels])
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    c = F.col(class_col)
    return df.withColumn("label", F.when(F.array_contains(known, c), F.try_element_at(mapping, c)).otherwise(F.raise_error(F.concat(F.lit("unknown class "), c))))


def grammar(df: DataFrame, key: list[str], text: str, order: str) -> DataFrame:
    """key, width, mapping: the commonest number of digits among a sheet's suffixed tags, and digit -> suffix letter.

    A tie goes to the width seen first. A digit is mapped where exactly one of its
    lookalikes is a suffix on the sheet. Sheets without suffixed tags have no row.
    """
    parts = df.select(*key, F.col(order).alias("_o"), t.tag_parts(F.col(text)).alias("p")).where("p is not null and p.suffix <> ''")
    widths = parts.groupBy(*key, F.length("p.digits").alias("width")).agg(F.count("*").alias("_n"), F.min("_o").alias("_first"))
    best = widths.groupBy(*key).agg(F.max_by("width", F.struct("_n", -F.col("_first"))).alias("width"))
    letters = parts.groupBy(*key).agg(F.collect_set("p.suffix").alias("_letters"))  # at most 26
    found = [(d, F.array_intersect("_letters", F.array(*[F.lit(c) for c in s]))) for d, s in t.LOOKALIKES.items()]
    entries = F.array_compact(F.array(*[F.when(F.size(a) == 1, F.struct(F.lit(d).alias("key"), a[0].alias("value"))) for d, a in found]))
    return best.join(letters, key).select(*key, "width", F.map_from_entries(entries).alias("mapping"))


def repair(df: DataFrame, key: list[str], text: str, order: str) -> DataFrame:
    """df with `text` repaired by its sheet's grammar and `text_raw` as it was."""
    g = grammar(df, key, text, order)
    fixed = t.repaired_tag(F.col("text_raw"), F.coalesce("width", F.lit(0)), F.coalesce("mapping", F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))))
    return df.withColumnRenamed(text, "text_raw").join(g, key, "left").withColumn("text", fixed).drop("width", "mapping")
