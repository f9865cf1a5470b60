"""Queries of the string functions and of what is learned from a sheet's strings."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheetgraph.functions import text as t
from sheetgraph.operators import tags as tg
from sheetgraph.plans.registry import query
from sheetgraph.sources import derived as d



def _flag(name: str, sql: str, column):
    @query(name, f"select sheet_id, ix, {sql} as hit from tags")
    def run(spark, sf):
        return d.tags(spark, sf).select("sheet_id", "ix", column(F.col("text")).alias("hit"))

    return run


_Q = lambda p: p.replace("'", "''")
_SQ = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"
_flag("t01_one_number", f"regexp_matches(text, '{_Q(t.ONE_NUMBER)}')", t.is_one_number)
_flag("t02_letter_and_digit", "regexp_matches(text, '[a-zA-Z]') and regexp_matches(text, '[0-9]')", t.has_letter_and_digit)
_flag("t03_size", f"regexp_matches(text, '{_Q(t.SIZE_TIMES_SIZE)}') or regexp_matches(text, '{_Q(t.ONE_SIZE)}')", t.is_size)
_flag("t04_equipment_tag", f"regexp_matches({_SQ}, '{_Q(t.EQUIPMENT_TAG)}')", t.is_equipment_tag)


@query("t05_tag_parts", f"select sheet_id, ix, regexp_extract({_SQ}, '{t.TAG_PARTS}', 1) as head, regexp_extract({_SQ}, '{t.TAG_PARTS}', 2) as sep, regexp_extract({_SQ}, '{t.TAG_PARTS}', 3) as digits, regexp_extract({_SQ}, '{t.TAG_PARTS}', 4) as suffix from tags where regexp_matches({_SQ}, '{t.TAG_PARTS}')")
def t05(spark, sf):
    return d.tags(spark, sf).withColumn("p", t.tag_parts(F.col("text"))).where("p is not null").select("sheet_id", "ix", "p.*")


_GRAMMAR = f"""parts as (select sheet_id, ix, {_SQ} as clean, regexp_extract({_SQ}, '{t.TAG_PARTS}', 1) as head, regexp_extract({_SQ}, '{t.TAG_PARTS}', 2) as sep, regexp_extract({_SQ}, '{t.TAG_PARTS}', 3) as digits, regexp_extract({_SQ}, '{t.TAG_PARTS}', 4) as suffix, regexp_matches({_SQ}, '{t.TAG_PARTS}') as ok from tags),
widths as (select sheet_id, length(digits) as width, count(*) as n, min(ix) as first_ix from parts where ok and suffix <> '' group by all),
width as (select sheet_id, width from widths qualify row_number() over (partition by sheet_id order by n desc, first_ix) = 1),
looks as (select * from (values ('0','D'),('0','O'),('0','Q'),('1','I'),('1','L'),('1','T'),('2','Z'),('5','S'),('6','G'),('8','B')) v(digit, letter)),
mapped as (select sheet_id, digit, min(suffix) as letter from (select distinct sheet_id, suffix from parts where ok and suffix <> '') s join looks on suffix = letter group by sheet_id, digit having count(*) = 1)"""


@query("ag08_tag_grammar", f", {_GRAMMAR} select w.sheet_id, cast(w.width as int) as width, cast(count(m.digit) as bigint) as n_repairs, string_agg(m.digit || m.letter, ',' order by m.digit) as repairs from width w left join mapped m using (sheet_id) group by w.sheet_id, w.width")
def ag08(spark, sf):
    g = tg.grammar(d.tags(spark, sf), ["sheet_id"], "text", "ix")
    pairs = F.sort_array(F.transform(F.map_entries("mapping"), lambda e: F.concat(e["key"], e["value"])))
    return g.select("sheet_id", "width", F.size("mapping").cast("long").alias("n_repairs"), F.nullif(F.array_join(pairs, ","), F.lit("")).alias("repairs"))


@query("t06_repaired_tag", f", {_GRAMMAR} select p.sheet_id, p.ix, case when ok and suffix='' and length(digits)=w.width+1 and m.letter is not null then head||sep||left(digits,length(digits)-1)||m.letter else clean end as text, t.text as text_raw from parts p join tags t using (sheet_id, ix) left join width w on p.sheet_id=w.sheet_id left join mapped m on p.sheet_id=m.sheet_id and m.digit=right(digits,1)")
def t06(spark, sf):
    return tg.repair(d.tags(spark, sf), ["sheet_id"], "text", "ix").select("sheet_id", "ix", "text", "text_raw")


@query("t07_promoted_label", f"select sheet_id, symbol_id, case when label='{t.ARROW}' and (coalesce(regexp_matches(upper(trim(text_associated)), '{t.VALVE_TAG}'), false) or 0.5*(x2-x1)>=18) and symbol_id%5<>0 then '{t.PROMOTED}' when label='{t.ARROW}' and coalesce(regexp_matches(upper(trim(text_associated)), '{t.VALVE_TAG}'), false) and symbol_id%5=0 then '{t.PROMOTED}' else label end as label from symbols")
def t07(spark, sf):
    s = d.symbols(spark, sf)
    either = t.promoted_label(F.col("label"), F.col("text_associated"), 0.5 * (F.col("x2") - F.col("x1")))
    tag = t.promoted_label(F.col("label"), F.col("text_associated"), F.lit(0.0), rule="tag")
    return s.select("sheet_id", "symbol_id", F.when(F.col("symbol_id") % 5 != 0, either).otherwise(tag).alias("label"))


@query("t08_prose", "select sheet_id, ix, (len(list_filter(string_split_regex(trim(text), '\\s+'), lambda x: x <> '')) >= 4 or (regexp_matches(regexp_replace(trim(substr(trim(text),1,3)), '\\.+$', ''), '^[0-9]+$') and contains(substr(trim(text),1,4), '.'))) and (ix % 100) > 40 as prose from tags")
def t08(spark, sf):
    return d.tags(spark, sf).select("sheet_id", "ix", t.is_prose(F.col("text"), F.col("ix") % 100).alias("prose"))


@query("t09_normalized", f"select sheet_id, ix, nullif(regexp_replace(upper(text), '[^A-Z0-9]', '', 'g'), '') as tag, upper({_SQ}) as text from tags")
def t09(spark, sf):
    return d.tags(spark, sf).select("sheet_id", "ix", t.compared_tag(F.col("text")).alias("tag"), F.upper(t.squeezed(F.col("text"))).alias("text"))


@query("t10_class_label", "select p_partkey, case split_part(p_name,' ',1) when 'x' then null else case p_size % 4 when 0 then 'Instrument/Valve/Ball valve NO' when 1 then 'Piping/Fittings/Reducer' when 2 then 'Instrument/Indicator/Panel box' end end as label from part", views=False)
def t10(spark, sf):
    p = d.base(spark, sf, "part")
    names = F.element_at(F.array(F.lit("Ball_Valve"), F.lit("Reducer"), F.lit("box"), F.lit("Not_used")), F.col("p_size") % 4 + 1)
    return tg.with_label(p.select("p_partkey", names.alias("class")), "class").select("p_partkey", "label")


@query("t11_category", "select sheet_id, symbol_id, case when starts_with(label,'Equipment/') then 'equipment' when starts_with(label,'Instrument/Valve/') then 'valve' when starts_with(label,'Piping/Endpoint/Pagination') then 'pagination' when starts_with(label,'Piping/') then 'fitting' when starts_with(label,'Instrument/') then 'instrument' else 'other' end as category from symbols")
def t11(spark, sf):
    return d.symbols(spark, sf).select("sheet_id", "symbol_id", t.category(F.col("label")).alias("category"))


@query("t12_prefix_sets", "select sheet_id, symbol_id, starts_with(lower(label),'equipment/') or starts_with(lower(label),'instrument/valve/') as folded, starts_with(label,'EQUIPMENT/') as exact from symbols")
def t12(spark, sf):
    return d.symbols(spark, sf).select("sheet_id", "symbol_id", t.starts_with_any(F.col("label"), ("EQUIPMENT/", "Instrument/VALVE/"), True).alias("folded"), t.starts_with_any(F.col("label"), ("EQUIPMENT/",)).alias("exact"))


@query("t13_node_ids", "select sheet_id, line_ix, 'l-' || line_ix as node, 'line' as kind, line_ix as key from segments")
def t13(spark, sf):
    n = d.segments(spark, sf).select("sheet_id", "line_ix", t.node_id("l", F.col("line_ix")).alias("node"))
    return n.select("sheet_id", "line_ix", "node", t.node_kind(F.col("node")).alias("kind"), t.node_key(F.col("node")).alias("key"))


@query("t14_comma_list", "select p_partkey, unnest(list_distinct(list_filter(list_transform(string_split(replace(p_name,' ',' , '), ','), lambda x: trim(x)), lambda x: x<>''))) as item from part", views=False)
def t14(spark, sf):
    return d.base(spark, sf, "part").select("p_partkey", F.explode(t.listed(F.replace("p_name", F.lit(" "), F.lit(" , ")))).alias("item"))


@query("t15_appended", "select sheet_id, symbol_id, case when text_associated is null then label else text_associated || ' ' || label end as text from symbols")
def t15(spark, sf):
    return d.symbols(spark, sf).select("sheet_id", "symbol_id", t.appended(F.col("text_associated"), F.col("label")).alias("text"))


@query("t16_display_name", "select sheet_id, symbol_id, coalesce(nullif(text_associated,''), split_part(label,'/',-1) || ' #' || symbol_id) as name from symbols")
def t16(spark, sf):
    return d.symbols(spark, sf).select("sheet_id", "symbol_id", t.display_name(F.col("text_associated"), F.col("label"), F.col("symbol_id")).alias("name"))


@query("t17_json", "select event_id, json_extract_string(props, '$.' || json_keys(props)[1]) as first_value from events where len(json_keys(props)) > 0", views=False)
def t17(spark, sf):
    e = d.base(spark, sf, "events").withColumn("m", F.from_json("props", "map<string,string>"))
    return e.where(F.size("m") > 0).select("event_id", F.element_at("m", F.json_object_keys("props")[0]).alias("first_value"))


@query("t18_math", "select sheet_id, line_ix, round(sqrt(x2*x2+y2*y2),6) as hypot, round(degrees(atan2(y2,x2)),6) as angle, cast(floor(x2/7) as bigint) as lower_, cast(ceil(x2/7) as bigint) as upper_, round_even(x2/7.0,5) as even from lines")
def t18(spark, sf):
    x, y = F.col("x2"), F.col("y2")
    return d.lines(spark, sf).select("sheet_id", "line_ix", F.round(F.hypot(x, y), 6).alias("hypot"), F.round(F.degrees(F.atan2(y, x)), 6).alias("angle"), F.floor(x / 7).alias("lower_"), F.ceil(x / 7).alias("upper_"), F.bround(x / 7, 5).alias("even"))


@query("t19_restricted", "select sheet_id, ix, regexp_replace(text, '[^A-Z0-9 .,:;_/()%+*=<>#&@''\"-]', '', 'g') as text from tags")
def t19(spark, sf):
    return d.tags(spark, sf).select("sheet_id", "ix", t.restricted(F.col("text")).alias("text"))
