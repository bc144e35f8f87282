"""Queries of the general data problems over the tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundloom.functions.numbers import plain_text, printed_number
from fundloom.functions.printed_dates import day_date
from fundloom.functions.text import match_key, squeeze, without_blanks
from fundloom.functions.units import currency_code, scale_of, unit_code, unit_words
from fundloom.operators import copies, eav, hierarchy, timestamps, zones
from fundloom.operators import units as units_op
from fundloom.operators.skew import hot_keys, join_unique
from fundloom.sources.tables import table

# ---------------------------------------------------------------- 1 hierarchies

HIERARCHIES = [
    ("investment_owner", "owner_id", "parent_owner_id", False),
    ("investment_target", "target_id", "parent_target_id", False),
    ("blocks", "block_id", "parent_id", False),
    ("lookthrough_edge", "child_position_id", "parent_position_id", True),
]


def all_links(spark: SparkSession, d: str) -> DataFrame:
    parts = [hierarchy.links(table(spark, d, h), h, node, parent, both) for h, node, parent, both in HIERARCHIES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    edges = all_links(spark, d)
    stated = edges.filter("parent is not null").select("hierarchy", "node")
    return hierarchy.resolve(edges, with_path=False).join(stated, ["hierarchy", "node"]).select(
        "hierarchy", F.col("node").alias("node_id"), F.col("root").alias("root_id"), "depth"
    )


def p1_hierarchies(spark: SparkSession, d: str) -> DataFrame:
    """Every node with its path, depth, root and number of descendants along paths: 0 on and below cycles, as its SQL twin has it.

    p1_hierarchies_whole counts those too.
    """
    whole = hierarchy.resolve(all_links(spark, d))
    below = hierarchy.descendants(whole).groupBy("hierarchy", F.col("ancestor").alias("node")).agg(F.count(F.lit(1)).alias("descendants"))
    return whole.join(below, ["hierarchy", "node"], "left").select(
        "hierarchy", F.col("node").alias("node_id"), F.col("root").alias("root_id"), "depth",
        F.concat_ws("/", "path").alias("path"), F.coalesce("descendants", F.lit(0)).alias("descendants"),
    )


def p1_descendants(spark: SparkSession, d: str) -> DataFrame:
    """Every (ancestor, descendant) with its distance, on and below cycles too."""
    return hierarchy.lineage(hierarchy.resolve(all_links(spark, d), with_walk=True))


def p1_other_parents(spark: SparkSession, d: str) -> DataFrame:
    """The links of nodes with several parents that the hierarchies leave out."""
    parts = [hierarchy.other_parents(table(spark, d, h), h, node, parent) for h, node, parent, _ in HIERARCHIES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("hierarchy", F.col("node").alias("node_id"), F.col("parent").alias("parent_id"), F.col("other").alias("other_parent_id"))


def p1_hierarchies_whole(spark: SparkSession, d: str) -> DataFrame:
    """p1_hierarchies with the descendants of every node, on and below cycles too."""
    whole = hierarchy.resolve(all_links(spark, d), with_walk=True)
    below = hierarchy.lineage(whole).groupBy("hierarchy", F.col("ancestor").alias("node")).agg(F.count(F.lit(1)).alias("descendants"))
    return whole.join(below, ["hierarchy", "node"], "left").select(
        "hierarchy", F.col("node").alias("node_id"), F.col("root").alias("root_id"), "depth",
        F.concat_ws("/", "path").alias("path"), F.coalesce("descendants", F.lit(0)).alias("descendants"),
    )


# ------------------------------------------------------- 6 differences of copies

RECORD_KEYS = ["document_id", "source_page", "source_table", "source_row_label", "source_column_label", "source_occurrence"]
RECORD_FIELDS = ["metric_category", "value_raw", "currency", "unit_scale", "as_of_date_raw", "subject_name"]
COVERAGE_FIELDS = ["page_status", "layout_checked", "expected_observation_count", "source_structures", "relevant_record_families"]
COVERAGE_LISTS = {"source_structures", "relevant_record_families"}


def _record_key(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit("")) if c in ("document_id", "source_occurrence") else match_key(F.col(c))


def _reading(df: DataFrame) -> DataFrame:
    number = printed_number(F.col("value_raw"))
    value = F.coalesce(F.concat(F.lit("#"), plain_text(number)), without_blanks(F.col("value_raw")))
    return df.select(
        *[_record_key(k).alias(k) for k in RECORD_KEYS],
        *[(value if f == "value_raw" else without_blanks(F.col(f))).alias(f) for f in RECORD_FIELDS],
    )


def _coverage_side(df: DataFrame, side: str) -> DataFrame:
    def prepared(f: str):
        c = F.col(f"{side}_{f}").cast("string")
        if f in COVERAGE_LISTS:
            items = F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), without_blanks)
            c = F.array_join(F.array_sort(F.array_distinct(F.filter(items, lambda x: x != ""))), "|")
        return without_blanks(c)

    there = F.coalesce(*[F.col(f"{side}_{f}").cast("string") for f in COVERAGE_FIELDS]).isNotNull()
    return df.filter(there).select(
        F.concat_ws("/", "document_id", "source_page").alias("case_key"), *[prepared(f).alias(f) for f in COVERAGE_FIELDS]
    )


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    found = copies.differences(_reading(table(spark, d, "records_a")), _reading(table(spark, d, "records_b")), RECORD_KEYS, RECORD_FIELDS)
    pairs = table(spark, d, "pair_index").select(*[_record_key(k).alias(k) for k in RECORD_KEYS], F.col("pair_id").alias("case_key"))
    records = pairs.join(found, RECORD_KEYS).select(F.lit("records").alias("copy_name"), "case_key", "diff_kind", "field_name")
    pages = table(spark, d, "coverage_diff")
    coverage = copies.differences(_coverage_side(pages, "a"), _coverage_side(pages, "b"), ["case_key"], COVERAGE_FIELDS)
    return records.unionByName(coverage.select(F.lit("coverage").alias("copy_name"), "case_key", "diff_kind", "field_name")).distinct()


# ------------------------------------------------ 7 attribute-value rows to wide

TABLE_ROW = ["document_id", "source_table", "source_row_label"]
#: Prints that state no value.
UNREADABLE = r"(?i)^(|-+|[—–−]+|n/?\.?a\.?|n\.?/?m\.?|not available|not meaningful|not applicable|nil|none)$"


def _readable(v):
    t = squeeze(v)
    return F.when(~t.rlike(UNREADABLE), t)


CELL_READERS = {
    "money": lambda v: printed_number(v), "percent": lambda v: printed_number(v), "multiple": lambda v: printed_number(v),
    "count": lambda v: printed_number(v), "date": day_date, "text": _readable,
}


def metric_kinds(spark: SparkSession, d: str) -> list[tuple[str, str]]:
    """(metric, kind) of the fixed table metric_reference: the columns of the wide table."""
    return [tuple(r) for r in table(spark, d, "metric_reference").select("metric_category", "value_kind").orderBy("metric_category").collect()]


def printed_cells(spark: SparkSession, d: str, kinds: list[tuple[str, str]]) -> DataFrame:
    """(document_id, source_table, source_row_label, attribute, value, priority) of every printed cell with a readable value."""
    index = table(spark, d, "pair_index").select(
        "document_id", "source_table", squeeze(F.col("source_row_label")).alias("source_row_label"),
        squeeze(F.col("source_column_label")).alias("column_label"), "metric_category", "source_occurrence", "a_row_number", "b_row_number",
    )
    columns = ["document_id", "source_table", "column_label"]
    stated = index.filter("metric_category is not null").groupBy(*columns).agg(F.min("metric_category").alias("metric"))
    labelled = index.filter("metric_category is not null").withColumnRenamed("metric_category", "metric").unionByName(
        index.filter("metric_category is null").drop("metric_category").join(stated, columns)
    )
    reading = lambda t: table(spark, d, t).select("document_id", F.col("row_no").alias("row"), F.col("value_raw").alias("value"))
    cell = lambda row: labelled.filter(row.isNotNull()).withColumn("row", row)
    a, b = F.col("a_row_number"), F.col("b_row_number")
    pointed = cell(a).join(reading("records_a"), ["document_id", "row"]).unionByName(
        cell(F.when(a.isNull(), b)).join(reading("records_b"), ["document_id", "row"])
    )
    v, of = F.col("value"), lambda *wanted: F.col("metric").isin([m for m, k in kinds if k in wanted])
    by_kind = (
        F.when(of("money", "percent", "multiple", "count"), printed_number(v).isNotNull())
        .when(of("date"), day_date(v).isNotNull()).when(of("text"), _readable(v).isNotNull())
    )
    return pointed.select(*TABLE_ROW, F.col("metric").alias("attribute"), F.when(by_kind, F.col("value")).alias("value"), F.col("source_occurrence").alias("priority"))


def p7_wide(spark: SparkSession, d: str) -> DataFrame:
    """One row per row of a printed table, one typed column per metric."""
    kinds = metric_kinds(spark, d)
    return eav.widen(printed_cells(spark, d, kinds), TABLE_ROW, kinds, CELL_READERS)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    kinds = metric_kinds(spark, d)
    wide = eav.widen(printed_cells(spark, d, kinds), TABLE_ROW, kinds, CELL_READERS)
    texts = {m: F.col(m) if k == "text" else F.col(m).cast("string") if k == "date" else plain_text(F.col(m)) for m, k in kinds}
    return eav.cells_of(wide, TABLE_ROW, texts).select(*TABLE_ROW, F.col("attribute").alias("metric_category"), "cell_text")


# ------------------------------------------------------- 5 printed dates and times


def p5_forms(spark: SparkSession, d: str) -> DataFrame:
    """(record_table, record_id, field_name, raw, normal_form, status) of every printed date and time, read or not."""
    calendar = table(spark, d, "source_calendar")  # a fixed table
    positions = table(spark, d, "fund_position").select("position_id", "date_raw", "source_document_id").filter("date_raw is not null")
    loans = table(spark, d, "investment_instrument").select("instrument_id", "maturity_date_raw").filter("maturity_date_raw is not null")
    named = zones.named_zones(positions.select(F.col("date_raw").alias("t")).unionByName(loans.select(F.col("maturity_date_raw").alias("t"))), "t")
    local = [r[0] for r in calendar.select("local_zone").distinct().collect()]
    offsets = zones.offset_table(spark, ["UTC", *local, *named])
    dated = timestamps.normalise(positions.join(F.broadcast(calendar), "source_document_id", "left"), "date_raw", offsets, F.col("date_order"), F.col("local_zone"))
    matured = timestamps.normalise(loans, "maturity_date_raw", offsets)
    row = lambda df, t, key, c: df.select(F.lit(t).alias("record_table"), F.col(key).alias("record_id"), F.lit(c).alias("field_name"), F.col(c).alias("raw"), "normal_form", F.col("normal_form_status").alias("status"))
    return row(dated, "fund_position", "position_id", "date_raw").unionByName(row(matured, "investment_instrument", "instrument_id", "maturity_date_raw"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_forms(spark, d).filter("normal_form != raw").select("record_table", "record_id", "field_name", "normal_form").distinct()


# -------------------------------------------------- 4 quantities in common units


def unit_families(spark: SparkSession, d: str) -> dict[str, list[tuple[str, float]]]:
    """Candidate units by dimension, base unit first, from the fixed tables; money is scaled currencies."""
    units: dict[str, list[tuple[str, float]]] = {}
    rows = table(spark, d, "unit_reference").select("dimension", "unit_code", "base_unit", F.col("to_base").cast("double").alias("size")).collect()
    for r in sorted(rows, key=lambda r: (r["dimension"], r["unit_code"] != r["base_unit"], r["unit_code"])):
        units.setdefault(r["dimension"], []).append((r["unit_code"], r["size"]))
    rates = table(spark, d, "currency_reference").select("currency_code", F.col("usd_per_unit").cast("double").alias("size")).collect()
    units["money"] = [
        (f"{r['currency_code']}*{scale}", r["size"] * scale)
        for scale in (1, 1_000, 1_000_000) for r in sorted(rates, key=lambda r: (r["currency_code"] != "USD", r["currency_code"]))
    ]
    units["rate"] = [("bps", 1.0), ("percent", 100.0), ("fraction", 10_000.0)]
    return units


def _sizes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(unit, dimension, base_unit, size) and (currency, rate) of the fixed reference tables."""
    return (
        table(spark, d, "unit_reference").select("unit_code", "dimension", "base_unit", F.col("to_base").cast("decimal(19,12)").alias("size")),
        table(spark, d, "currency_reference").select("currency_code", F.col("usd_per_unit").cast("decimal(16,8)").alias("rate")),
    )


def measured(spark: SparkSession, d: str) -> DataFrame:
    """Every recorded quantity as one row: (record_table, record_id, field_name, device, at, amount, stated, family, unit_text, given).

    ``stated`` is the unit that the record or its text prints, ``family`` its
    dimension, or that of the device's other quantities, ``amount`` the printed number.
    """
    units, _ = _sizes(spark, d)
    exact = "decimal(30,10)"
    position = table(spark, d, "fund_position")
    raw = squeeze(F.col("quantity_raw"))
    number = r"^([(\-−–]?[\d,]*\.?\d+\)?) ?(.*)$"
    words = F.regexp_extract(raw, number, 2)
    quantities = position.filter("quantity_raw is not null").select(
        "position_id", "owner_id", "instrument_id", "report_date",
        printed_number(F.regexp_extract(raw, number, 1), exact).alias("amount"),
        unit_words(F.when(words != "", words).otherwise(F.col("quantity_unit"))).alias("words"),
    ).withColumn("stated", unit_code(F.col("words")))
    quantities = quantities.join(F.broadcast(units.select(F.col("unit_code").alias("stated"), F.col("dimension").alias("family"))), "stated", "left").select(
        F.lit("fund_position").alias("record_table"), F.col("position_id").alias("record_id"), F.lit("quantity").alias("field_name"),
        F.concat_ws("/", "owner_id", "instrument_id").alias("device"), F.col("report_date").alias("at"), "amount", "stated", "family",
        F.col("stated").isNotNull().alias("counts"),
    )
    # an unstated quantity has the dimension that most stated ones of its device have, ties by name
    usual = quantities.filter("family is not null").groupBy("device", "family").agg(F.count(F.lit(1)).alias("n")).groupBy("device").agg(
        F.min(F.struct(-F.col("n"), "family"))["family"].alias("family")
    )
    bare = quantities.filter("family is null").drop("family")
    quantities = quantities.filter("family is not null").unionByName(join_unique(bare, usual, ["device"], "left", hot_keys(bare, ["device"])))
    money = lambda code, scale: F.when(code.isNotNull(), F.concat_ws("*", code, scale.cast("string")))
    values = position.filter("fair_value is not null").select(
        F.lit("fund_position").alias("record_table"), F.col("position_id").alias("record_id"), F.lit("fair_value").alias("field_name"),
        F.concat_ws("/", "owner_id", "instrument_id").alias("device"), F.col("report_date").alias("at"), F.col("fair_value").try_cast(exact).alias("amount"),
        money(currency_code(F.col("currency")), scale_of(F.lower("currency"))).alias("stated"), F.lit("money").alias("family"),
        F.col("currency").isNotNull().alias("counts"),
    )
    basis = F.lower(squeeze(F.col("rate_basis_raw")))
    figure, mark = r"(\d+(?:\.\d+)?)(?: ?(\d+)/(\d+))?", r"(%|per ?cent|percent|bps?|basis points)"
    after = rf"(?:\+|plus) ?{figure} ?{mark}?"
    before = rf"^{figure} ?{mark} (?:margin )?(?:over|above)"
    spread = lambda i: F.coalesce(F.nullif(F.regexp_extract(basis, after, i), F.lit("")), F.nullif(F.regexp_extract(basis, before, i), F.lit("")))
    part = F.coalesce(F.col("over").try_cast("decimal(9,0)") / F.nullif(F.col("under").try_cast("decimal(9,0)"), F.lit(0).cast("decimal(9,0)")), F.lit(0)).cast("decimal(18,6)")
    bps = F.when(F.col("stated") == "percent", F.col("amount") * 100).otherwise(F.col("amount"))
    spreads = table(spark, d, "investment_instrument").filter("rate_basis_raw is not null").select(
        "instrument_id", "spread_bps", spread(1).alias("whole"), spread(2).alias("over"), spread(3).alias("under"), spread(4).alias("u"),
    ).filter("whole is not null").select(
        F.lit("investment_instrument").alias("record_table"), F.col("instrument_id").alias("record_id"), F.lit("spread_bps").alias("field_name"),
        F.col("instrument_id").alias("device"), F.lit(None).cast("date").alias("at"), (F.col("whole").try_cast("decimal(18,6)") + part).cast(exact).alias("amount"),
        # a figure without a mark is left to the model
        F.when(F.col("u").rlike("^(%|per)"), "percent").when(F.col("u").isNotNull(), "bps").alias("stated"), F.lit("rate").alias("family"), "spread_bps",
    ).select(
        "record_table", "record_id", "field_name", "device", "at", "amount", "stated", "family", F.lit(True).alias("counts"), F.col("spread_bps").cast("decimal(20,6)").alias("recorded"),
    )
    printed = squeeze(F.col("printed_value"))
    shape = r"^(-?[(]?-?)\s*([^\d(),.\-]*)\s*(\(?)\s*([\d,]*\.?\d+)(\)?)\s*(.*)$"
    heading = F.regexp_extract("note", r"\((\S+) in (\w+)\)", 1)
    told = F.regexp_extract("note", r"prints (?:negative )?\w+ in ([A-Z]{3})\b", 1)
    note_scale = F.concat_ws(" ", F.regexp_extract("note", r"\(\S+ in (\w+)\)", 1), F.regexp_extract("note", r"prints (?:negative )?\w+ in [A-Z]{3} (\w+)", 1))
    exceptions = table(spark, d, "quality_source_exceptions").select(
        "observation_id", "field", F.coalesce("note", F.lit("")).alias("note"), printed.alias("p"),
    ).filter(F.col("p").rlike(r"\d")).select(
        "observation_id", "field", "note", "p",
        F.regexp_extract("p", shape, 2).alias("mark"), F.regexp_extract("p", shape, 4).alias("digits"), F.lower(F.regexp_extract("p", shape, 6)).alias("tail"),
        (F.translate("p", "−–", "--").startswith("-") | F.col("p").contains("(")).alias("negative"), heading.alias("heading"), told.alias("told"), note_scale.alias("note_scale"),
    )
    sign = F.when(F.col("negative"), F.lit(-1)).otherwise(F.lit(1))
    amount = (printed_number(F.col("digits"), exact) * sign).cast(exact)
    rate_unit = (
        F.when(F.col("tail").rlike(r"bps?|basis"), "bps").when(F.col("tail").rlike("%|per ?cent"), "percent")
        .when(F.col("note").rlike("(?i)decimal fraction"), "fraction").when(F.col("note").rlike("(?i)percent"), "percent")
    )
    code = F.coalesce(
        currency_code(F.nullif(F.trim("mark"), F.lit(""))), currency_code(F.nullif(F.col("heading"), F.lit(""))),
        currency_code(F.nullif(F.col("told"), F.lit(""))), F.lit("USD"),
    )
    scale = F.greatest(scale_of(F.col("tail")), scale_of(F.lower("note_scale")))
    is_rate = F.col("field") == "reported_irr"
    exceptions = exceptions.select(
        F.lit("quality_source_exceptions").alias("record_table"), F.col("observation_id").alias("record_id"), F.lit("printed_value").alias("field_name"),
        F.col("observation_id").alias("device"), F.lit(None).cast("date").alias("at"), amount.alias("amount"),
        F.when(is_rate, rate_unit).otherwise(money(code, scale)).alias("stated"), F.when(is_rate, "rate").otherwise("money").alias("family"),
        F.lit(True).alias("counts"),
    )
    return quantities.unionByName(values).unionByName(exceptions).unionByName(spreads, allowMissingColumns=True)


def p4_units(spark: SparkSession, d: str) -> DataFrame:
    """Every quantity in base units, with the unit it was recorded in, as decoded from its text and its level.

    ``unit_stated`` tells whether the text names a unit; a base value beyond a bigint is null.
    """
    return _in_base_units(spark, d, measured(spark, d))


def _in_base_units(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    rows = units_op.decode(rows, ["record_table", "field_name", "device"], ["at"], "amount", "stated", unit_families(spark, d), "family", series=("record_table", "field_name")).filter("amount is not null")
    units, rates = _sizes(spark, d)
    wide = rows.join(F.broadcast(units.withColumnRenamed("unit_code", "unit").drop("dimension")), "unit", "left").withColumns({
        "currency_code": F.when(F.col("family") == "money", F.substring_index("unit", "*", 1)),
        "scale": F.when(F.col("family") == "money", F.substring_index("unit", "*", -1).try_cast("decimal(7,0)")),
    }).join(F.broadcast(rates), "currency_code", "left")
    rate_size = F.when(F.col("unit") == "bps", 1).when(F.col("unit") == "percent", 100).when(F.col("unit") == "fraction", 10_000)
    size = (
        F.when(F.col("family") == "money", (F.col("rate") * F.col("scale")).cast("decimal(20,8)").cast("decimal(26,12)"))
        .when(F.col("family") == "rate", rate_size.cast("decimal(26,12)")).otherwise(F.col("size").cast("decimal(26,12)"))
    )
    # exact where the amount fits 18 digits, else as exact as 38 digits allow
    narrow = F.col("amount").try_cast("decimal(18,6)")
    product = F.coalesce(
        F.when(narrow == F.col("amount"), F.try_multiply(narrow, F.when(size < 10_000_000, size).cast("decimal(19,12)"))).cast("decimal(38,8)"),
        F.try_multiply(F.col("amount"), size).try_cast("decimal(38,8)"),
    )
    base = F.when(F.col("family") == "money", "USD").when(F.col("family") == "rate", "bps").otherwise(F.col("base_unit"))
    return wide.select(
        "record_table", "record_id", "field_name", base.alias("base_unit"), F.round(product, 0).try_cast("bigint").alias("base_value"),
        "unit", F.col("stated").isNotNull().alias("unit_stated"),
        (F.col("counts") & ~F.coalesce((F.col("field_name") == "spread_bps") & (product == F.col("recorded")), F.lit(False))).alias("counts"),
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    plain = F.col("unit") == F.when(F.col("field_name") == "quantity", F.col("base_unit")).when(F.col("field_name") == "fair_value", "USD*1").otherwise("")
    return p4_units(spark, d).filter(F.col("counts") & ~plain & F.col("base_value").isNotNull()).select(
        "record_table", "record_id", "field_name", "base_unit", "base_value"
    ).distinct()


def p4_unit_holdout(spark: SparkSession, d: str) -> DataFrame:
    """(record_table, field_name, family, hidden, right): stated units hidden from the model in every fifth record, and how many come out as stated."""
    rows = measured(spark, d).withColumn("true_unit", F.col("stated"))
    hidden = F.pmod(F.xxhash64(F.lit("holdout"), "record_id"), F.lit(5)) == 0
    rows = rows.withColumn("stated", F.when(~hidden, F.col("stated")))
    decoded = units_op.decode(rows, ["record_table", "field_name", "device"], ["at"], "amount", "stated", unit_families(spark, d), "family", series=("record_table", "field_name"))
    return decoded.filter(F.col("stated").isNull() & F.col("true_unit").isNotNull()).groupBy("record_table", "field_name", "family").agg(
        F.count(F.lit(1)).alias("hidden"), F.count_if(F.col("unit") == F.col("true_unit")).alias("right")
    )
