"""The nearest symbols are found without a table that the driver holds whole."""

from sheetgraph.operators import crops as cr


def test_nearest_symbols_are_not_broadcast(spark, monkeypatch):
    plans, real = [], cr.stash
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(cr, "stash", lambda df, name="stage": plans.append(text(df)) or real(df, name))
    box = "x1 long, y1 long, x2 long, y2 long"
    texts = spark.createDataFrame([(1, 1, 0, 0, 10, 10), (1, 2, 900, 900, 910, 910), (2, 3, 0, 0, 10, 10)], f"sheet_id long, text_ix long, {box}")
    symbols = spark.createDataFrame([(1, 1, 13, 14, 20, 20)], f"sheet_id long, symbol_id long, {box}")
    got = cr.nearest_symbol(texts, symbols, ["sheet_id"])
    assert {r.text_ix: round(r.symbol_distance, 3) for r in got.collect()} == {1: 5.0, 2: 1244.508, 3: 1e9}
    assert len(plans) > 3 and not any("BroadcastExchange" in p for p in [*plans, text(got)])
