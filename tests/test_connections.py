"""What walks are told of: their steps, and connections nested by asset."""

from pyspark.sql import functions as F

from sheetgraph.operators import graph as gr

#: s-1 - l-1 - l-2 - s-2, and a text's line from l-1 to s-3, which only l-3 reaches otherwise.
EDGES = [(1, "l-1", "s-1", 0), (1, "l-1", "l-2", 1), (1, "l-2", "s-2", 2), (1, "l-1", "l-t-7", 3), (1, "l-3", "l-t-7", 4), (1, "l-3", "s-3", 5), (2, "l-1", "s-9", 0)]


def _tables(spark):
    edges = spark.createDataFrame(EDGES, "sheet_id long, a string, b string, ord long")
    nodes = spark.createDataFrame([(1, "s-1"), (1, "s-2"), (1, "s-3"), (2, "s-9")], "sheet_id long, node string")
    sources = spark.createDataFrame([(1, "s-2", "l-2")], "sheet_id long, node string, source string")
    return edges, nodes, sources


def test_steps_are_the_paths_sizes(spark):
    edges, nodes, sources = _tables(spark)
    whole = gr.traverse(edges, nodes, nodes, sources).select("sheet_id", "start", "node", "flow", F.size("path").alias("steps"))
    short = gr.traverse(edges, nodes, nodes, sources, paths=False)
    assert short.columns == whole.columns and sorted(short.collect()) == sorted(whole.collect())
    assert {(r.start, r.node): r.steps for r in short.collect()}[("s-1", "s-3")] == 3


def test_connections_are_nested_without_moving_paths(spark):
    edges, nodes, sources = _tables(spark)
    symbols = spark.createDataFrame([(1, 1, "Equipment/Vessel", "V1", True, False), (1, 2, "Instrument/Valve/Gate", "V2", False, True), (1, 3, "Piping/Other", None, False, False), (2, 9, "Equipment/Vessel", "V9", True, False)], "sheet_id long, symbol_id long, label string, text_associated string, is_flow boolean, is_valve boolean")
    boxes = spark.createDataFrame([(1, "l-1", 0.1, 0.1, 0.2, 0.1), (1, "l-2", 0.2, 0.1, 0.3, 0.1), (1, "l-t-7", 0.2, 0.2, 0.3, 0.3)], "sheet_id long, node string, x1 double, y1 double, x2 double, y2 double")  # l-3 has no place
    out = gr.connections(edges, nodes, nodes, sources, symbols, boxes)
    assert out.columns == ["sheet_id", "node", "connections", "symbol_id", "label", "text"]
    assert "explode" not in out._jdf.queryExecution().executedPlan().toString()
    rows = {r.node: r for r in out.collect()}
    assert set(rows) == {"s-1", "s-3"}  # s-9 reaches nothing, and from s-2 the only step goes up
    told = [(c.walk, c.id, c.label, c.flow, [tuple(s) for s in c.segments]) for c in rows["s-1"].connections]
    first, second, text = (0.1, 0.1, 0.2, 0.1), (0.2, 0.1, 0.3, 0.1), (0.2, 0.2, 0.3, 0.3)
    assert told == [(1, 2, "Instrument/Valve/Gate", "downstream", [first, second]), (2, 3, "Piping/Other", "unknown", [first, text])]
    assert [c.flow for c in rows["s-3"].connections] == ["unknown", "unknown"]
    assert [[tuple(s) for s in c.segments] for c in rows["s-3"].connections] == [[text, first], [text, first, second]]
    assert rows["s-1"].symbol_id == 1 and rows["s-1"].label == "Equipment/Vessel"
