"""Queries that cover every row they are about."""

from fundloom.operators import retrieval
from fundloom.plans import registry
from fundloom.sources.tables import table
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.001"


def test_every_line_is_scaled(spark):
    lines = table(spark, DIR, "lineitem")
    got = registry.queries()["scaled_lines"](spark, DIR)
    assert got.count() == lines.count() > lines.filter("l_shipdate <= timestamp '1996-06-30'").count()


def test_every_hundredth_row_is_searched(spark):
    for name, of, key, n in (("vector_top_each", "embeddings", "vec_id", 20), ("bm25_top_each", "documents", "doc_id", 20)):
        asked = {r[0] for r in table(spark, DIR, of).filter(f"{key} % 100 = 0").select(key).collect()}
        found = [(r["query_id"], r[key]) for r in registry.queries()[name](spark, DIR).collect()]
        assert {q for q, _ in found} == asked and {(q, q) for q in asked} <= set(found)
        assert all(len([1 for q, _ in found if q == a]) <= n for a in asked)


def test_blocks_do_not_change_what_is_found(spark, monkeypatch):
    run = lambda: {name: sorted(map(tuple, registry.queries()[name](spark, DIR).collect())) for name in ("vector_top_each", "bm25_top_each")}
    whole = run()
    monkeypatch.setattr(retrieval, "ROW_BLOCK", 37)
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 2)
    assert run() == whole


def test_quantities_without_a_unit_are_decoded(spark, tmp_path):
    for name in ("unit_reference", "currency_reference", "investment_instrument", "quality_source_exceptions"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{DIR}/{name}.parquet")
    some = table(spark, DIR, "fund_position").limit(1)
    columns = {"owner_id": F.lit("o"), "instrument_id": F.lit("i"), "fair_value": F.lit(None).cast(some.schema["fair_value"].dataType)}
    made = None
    for i, (amount, unit) in enumerate([("1000", "shares"), ("1010", None), ("1020", "shares"), ("990", "shares")]):
        row = some.withColumns(columns | {"position_id": F.lit(f"p{i}"), "quantity_raw": F.lit(amount), "quantity_unit": F.lit(unit).cast("string"), "report_date": F.lit(f"2020-0{i + 1}-01").cast(some.schema["report_date"].dataType)})
        made = row if made is None else made.unionByName(row)
    made.write.parquet(str(tmp_path / "fund_position.parquet"))
    rows = registry.queries()["p4_units"](spark, str(tmp_path)).filter("field_name = 'quantity'").collect()
    assert {r["record_id"]: (r["unit"], r["base_value"]) for r in rows}["p1"] == ("share", 1010)
