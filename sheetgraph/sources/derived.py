"""Sheets derived from the driver's tables: 500 order keys make a sheet of 4000 x 3000 pixels.

The same expressions run in Spark and DuckDB; only integer division differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH, HEIGHT = 4000, 3000

SEGMENTS = """
select l_orderkey {div} 500 as sheet_id,
  row_number() over (partition by l_orderkey {div} 500 order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 as line_ix,
  case when l_linenumber % 2 = 1 then 'h' else 'v' end as axis,
  cast(20*((l_partkey + 3*l_suppkey) % 150) + (l_suppkey % 3) - 1 as bigint) as pos,
  cast(20*(l_partkey % 120) as bigint) as lo,
  cast(20*(l_partkey % 120) + 10*cast(l_quantity as bigint) as bigint) as hi,
  case when l_returnflag = 'R' then 'dashed' else 'solid' end as line_type
from lineitem"""

SYMBOLS = """
select o_orderkey {div} 500 as sheet_id, o_orderkey as symbol_id,
  cast(20*(o_custkey % 140) as bigint) as x1, cast(20*((o_custkey {div} 7) % 140) as bigint) as y1,
  cast(20*(o_custkey % 140) + 40 as bigint) as x2, cast(20*((o_custkey {div} 7) % 140) + 40 as bigint) as y2,
  case o_orderpriority when '1-URGENT' then 'Equipment/Vessel' when '2-HIGH' then 'Instrument/Valve/Gate valve NO'
    when '3-MEDIUM' then 'Piping/Fittings/Mid arrow flow direction' when '4-NOT SPECIFIED' then 'Instrument/Indicator/Panel box'
    else 'Piping/Fittings/Flanged connection' end as label,
  case when o_orderkey % 2 = 0 then concat('V', cast(o_custkey as varchar(20))) end as text_associated
from orders where o_orderkey % 3 = 0"""

TEXTS = """
select o_orderkey {div} 500 as sheet_id, o_orderkey as text_ix,
  case when o_orderkey % 5 = 0 then concat('NOTE ', cast(o_orderkey as varchar(20)), ' SEE SHEET TWO') when o_orderkey % 5 = 1 then '3/4"x1/2"' else concat('V', cast(o_custkey as varchar(20))) end as text,
  cast(20*(o_custkey % 140) + 45 as bigint) as x1, cast(20*((o_custkey {div} 7) % 140) + 5 as bigint) as y1,
  cast(20*(o_custkey % 140) + 95 as bigint) as x2, cast(20*((o_custkey {div} 7) % 140) + 25 as bigint) as y2
from orders where o_orderkey % 3 <> 2"""

#: Two enlarged symbol boxes of a sheet that follow each other: a (by 300) and b (by 200).
PAIRS = """
select a.sheet_id, a.symbol_id as a_id, b.symbol_id as b_id,
  cast(a.x1 - 300 as double) as ax1, cast(a.y1 - 300 as double) as ay1, cast(a.x2 + 300 as double) as ax2, cast(a.y2 + 300 as double) as ay2,
  cast(b.x1 - 200 as double) as bx1, cast(b.y1 - 200 as double) as by1, cast(b.x2 + 200 as double) as bx2, cast(b.y2 + 200 as double) as by2
from symbols a join symbols b on a.sheet_id = b.sheet_id and b.symbol_id = a.symbol_id + 3"""

#: Segments as lines in pixels; every seventh is tilted by a third of its length.
LINES = """
select sheet_id, line_ix, line_type,
  cast(case when axis = 'h' then lo else pos end as double) as x1, cast(case when axis = 'h' then pos else lo end as double) as y1,
  cast(case when axis = 'h' then hi else pos + case when line_ix % 7 = 0 then (hi - lo) / 4.0 else 0 end end as double) as x2,
  cast(case when axis = 'h' then pos + case when line_ix % 7 = 0 then (hi - lo) / 4.0 else 0 end else hi end as double) as y2
from segments"""


#: Strings shaped like tags, sizes, numbers and notes.
TAGS = """
select o_orderkey {div} 500 as sheet_id, o_orderkey as ix,
  case o_orderkey % 8
    when 0 then concat('PIC-', cast(100 + o_custkey % 900 as varchar(20)), substr('ABCD', cast(1 + o_custkey % 4 as int), 1))
    when 1 then concat(' TE   ', cast(1000 + o_custkey % 9000 as varchar(20)))
    when 2 then '3/4"x1/2"' when 3 then cast(o_custkey as varchar(20)) when 4 then '1/2' when 5 then '4"'
    when 6 then concat('FV', cast(10 + o_custkey % 90 as varchar(20)), substr('AB', cast(1 + o_custkey % 2 as int), 1))
    else concat('12. Note ', cast(o_orderkey as varchar(20)), ' see sheet') end as text
from orders"""


def cte(sql: str) -> str:
    """DuckDB SQL with the derived tables in front."""
    fill = lambda s: s.replace("{div}", "//")
    return f"with recursive segments as ({fill(SEGMENTS)}), symbols as ({fill(SYMBOLS)}), texts as ({fill(TEXTS)}), pairs as ({PAIRS}), lines as ({LINES}), tags as ({fill(TAGS)})\n" + (sql.lstrip() if sql.lstrip().startswith(",") else sql)


def _view(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    return spark.sql(_named(sql, tables), **tables)


def _named(sql: str, tables: dict[str, DataFrame]) -> str:
    import re

    sql = sql.replace("{div}", "div")
    for name in tables:
        sql = re.sub(rf"\b(from|join) {name}\b", rf"\1 {{{name}}}", sql)
    return sql


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the sheet is a column before lines are numbered by it, so Spark knows that a sheet's lines lie together from then on
    sheet = "l_orderkey {div} 500"
    numbered = SEGMENTS.replace(f"{sheet} as sheet_id", "sheet_id").replace(sheet, "sheet_id")
    lineitem = base(spark, sf_dir, "lineitem")
    return _view(spark, numbered, lineitem=lineitem.withColumn("sheet_id", F.expr(sheet.replace("{div}", "div"))))


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, SYMBOLS, orders=base(spark, sf_dir, "orders"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, TEXTS, orders=base(spark, sf_dir, "orders"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, PAIRS, symbols=symbols(spark, sf_dir))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, LINES, segments=segments(spark, sf_dir))


def normalized(df: DataFrame) -> DataFrame:
    """x1, y1, x2, y2 in pixels as fractions of the sheet."""
    return df.withColumns({c: F.col(c) / F.lit(float(WIDTH if c[0] == "x" else HEIGHT)) for c in ("x1", "y1", "x2", "y2")})


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, TAGS, orders=base(spark, sf_dir, "orders"))
