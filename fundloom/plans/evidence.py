"""Queries of records, texts as evidence, wide tables and harvested names, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundloom.functions import labels, records
from fundloom.functions.numbers import printed_number
from fundloom.operators import evidence, harvest, pivot, relational
from fundloom.plans.general_sql import number_sql
from fundloom.plans.reference import big, query, r4
from fundloom.sources.tables import table

# ------------------------------------------------------------------- predicates


@query("""SELECT record_status, COUNT(*) AS rows_all, COUNT(*) FILTER (upper(trim(COALESCE(record_status,'')))='ACTIVE') AS active, COUNT(*) FILTER (period_start_date<=DATE '2020-06-30' AND COALESCE(period_end_date, DATE '9999-12-31')>=DATE '2020-06-30') AS applying,
 COUNT(*) FILTER (COALESCE(trim(owner_fund_id),'')='' AND COALESCE(trim(instrument_id),'')='') AS whole FROM fund_position GROUP BY 1""")
def active_terms(spark, d):
    """Active rows, terms that cover a day, and rows that name no part of a fund."""
    day = F.lit("2020-06-30").cast("date")
    return table(spark, d, "fund_position").groupBy("record_status").agg(
        F.count(F.lit(1)).alias("rows_all"), F.count_if(records.active(F.col("record_status"))).alias("active"),
        F.count_if(records.term_applies(day, F.col("period_start_date"), F.col("period_end_date"))).alias("applying"),
        F.count_if(records.whole_fund(F.col("owner_fund_id"), F.col("instrument_id"))).alias("whole"))


@query(f"""WITH x AS (SELECT r.*, value_kind, {number_sql('value_raw')} AS n FROM (SELECT DISTINCT * FROM records_a) r JOIN metric_reference USING (metric_category))
 SELECT document_id, row_no, value_kind, ROUND(CAST(CASE value_kind WHEN 'money' THEN n*CASE WHEN regexp_matches(lower(COALESCE(unit_scale,'')),'million|^mm?$|^mn$') THEN 1000000 WHEN regexp_matches(lower(COALESCE(unit_scale,'')),'thousand|^k$|000') THEN 1000 ELSE 1 END WHEN 'percent' THEN n/100 ELSE n END AS DOUBLE),4) AS stored,
 COALESCE(n>0,false) AS measurable FROM x WHERE value_kind IN ('money','percent','multiple','count')""")
def period_cells(spark, d):
    """Printed numbers as they are stored: money in single units, percents as fractions."""
    kinds = F.broadcast(table(spark, d, "metric_reference"))  # a fixed table
    x = table(spark, d, "records_a").distinct().join(kinds, "metric_category").filter("value_kind in ('money', 'percent', 'multiple', 'count')")
    n = printed_number(F.col("value_raw"))
    cell = records.period_cell(F.col("value_kind"), n.cast("double"), records.scale_multiplier(F.col("unit_scale")))
    return x.select("document_id", "row_no", "value_kind", r4(cell).alias("stored"), F.coalesce(n > 0, F.lit(False)).alias("measurable"))


@query("""SELECT doc_id, regexp_matches(lower(text), '(ignore (previous|all) instructions|system:|you are now|/etc/passwd|drop table)') AS instruction, contains(lower(text),'round') AND NOT regexp_matches(lower(text),'fee|gross|net of|dietz') AS rounding FROM documents WHERE text IS NOT NULL""")
def passage_flags(spark, d):
    return table(spark, d, "documents").filter("text is not null").select("doc_id", records.is_instruction(F.col("text")).alias("instruction"), records.rounding_note(F.col("text")).alias("rounding"))


@query("""SELECT file_id, COUNT(*) AS blocks FROM blocks WHERE file_id IN (SELECT DISTINCT document_id FROM coverage_diff WHERE a_page_status IS NOT NULL) GROUP BY 1""")
def permitted_blocks(spark, d):
    """Blocks of the documents a reader may see."""
    scope = table(spark, d, "coverage_diff").filter("a_page_status is not null").select("document_id")
    return evidence.permitted(table(spark, d, "blocks"), "file_id", scope).groupBy("file_id").agg(F.count(F.lit(1)).alias("blocks"))


# --------------------------------------------------------------- views by name


@query("""SELECT wide_row_id, market_value*unit_scale_multiplier AS value_scaled FROM (SELECT DISTINCT wide_row_id, market_value, unit_scale_multiplier FROM wide_allocation_observation)""")
def vw_observation_scaled(spark, d):
    w = table(spark, d, "wide_allocation_observation").select("wide_row_id", "market_value", "unit_scale_multiplier").distinct()
    return w.select("wide_row_id", (F.col("market_value") * F.col("unit_scale_multiplier")).alias("value_scaled"))


@query("""WITH t AS (SELECT printed_name_primary AS subject_name, MIN(target_id) AS entity_id, MIN(target_kind) AS entity_kind FROM investment_target WHERE printed_name_primary IS NOT NULL GROUP BY 1) SELECT wide_row_id, entity_id, entity_kind FROM (SELECT DISTINCT wide_row_id, subject_name FROM wide_allocation_observation) JOIN t USING (subject_name)""")
def vw_observation_resolved(spark, d):
    """Observations whose subject is a known target, by its printed name."""
    t = table(spark, d, "investment_target").filter("printed_name_primary is not null").groupBy(F.col("printed_name_primary").alias("subject_name")).agg(F.min("target_id").alias("entity_id"), F.min("target_kind").alias("entity_kind"))
    return table(spark, d, "wide_allocation_observation").select("wide_row_id", "subject_name").distinct().join(t, "subject_name").select("wide_row_id", "entity_id", "entity_kind")


@query("""SELECT COALESCE(NULLIF(strategy,''),'(no family)') AS fund_family, COUNT(*) AS funds, COUNT(*) FILTER (COALESCE(subject_manager_name,'')<>'') AS with_manager, SUM(observation_count) AS observations FROM wide_allocation_observation WHERE subject_type='fund' GROUP BY ALL""")
def vw_manager_coverage(spark, d):
    return table(spark, d, "wide_allocation_observation").filter("subject_type = 'fund'").groupBy(F.coalesce(F.nullif("strategy", F.lit("")), F.lit("(no family)")).alias("fund_family")).agg(
        F.count(F.lit(1)).alias("funds"), F.count_if(F.coalesce("subject_manager_name", F.lit("")) != "").alias("with_manager"), F.sum("observation_count").alias("observations"))


@query("""WITH o AS (SELECT document_id, COUNT(*) AS written FROM records_a GROUP BY 1) SELECT c.document_id, COUNT(*) AS pages_covered, COUNT(*) FILTER (a_page_status='NO_ELIGIBLE_DATA') AS pages_no_eligible_data, SUM(a_expected_observation_count) AS expected_observations, ANY_VALUE(written) AS written_observations
 FROM coverage_diff c LEFT JOIN o USING (document_id) GROUP BY 1""")
def vw_document_coverage(spark, d):
    written = table(spark, d, "records_a").groupBy("document_id").agg(F.count(F.lit(1)).alias("written_observations"))
    pages = table(spark, d, "coverage_diff").groupBy("document_id").agg(
        F.count(F.lit(1)).alias("pages_covered"), F.count_if(F.col("a_page_status") == "NO_ELIGIBLE_DATA").alias("pages_no_eligible_data"), F.sum("a_expected_observation_count").alias("expected_observations"))
    return pages.join(written, "document_id", "left").select("document_id", "pages_covered", "pages_no_eligible_data", "expected_observations", "written_observations")


_PERIODS = """fp AS (SELECT c_custkey AS fund_period_id, c_mktsegment, SUM(CASE WHEN o_orderstatus='F' THEN o_totalprice ELSE 0 END) AS paid, SUM(CASE WHEN o_orderstatus='O' THEN o_totalprice ELSE 0 END) AS dist, MAX(c_acctbal) AS nav FROM customer JOIN orders ON o_custkey=c_custkey GROUP BY 1,2)"""


def _fund_periods(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("fund_period_id")).agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0)).alias("paid"), F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).otherwise(0.0)).alias("dist"))
    return o.join(table(spark, d, "customer").select(F.col("c_custkey").alias("fund_period_id"), "c_mktsegment", F.col("c_acctbal").alias("nav")), "fund_period_id")


@query(f"""WITH {_PERIODS} SELECT fund_period_id, ROUND(CASE WHEN paid>0 THEN dist/paid END,6) AS recomputed_dpi, ROUND(CASE WHEN paid>0 THEN nav/paid END,6) AS recomputed_rvpi, ROUND(CASE WHEN paid>0 THEN (dist+nav)/paid END,6) AS recomputed_tvpi, ROUND(nav+paid-dist,2) AS recomputed_ending_nav FROM fp""")
def vw_fund_period_math(spark, d):
    from fundloom.operators.performance import multiples

    m = multiples(F.col("paid"), F.col("dist"), F.col("nav"))
    return _fund_periods(spark, d).select("fund_period_id", *[F.round(m[k], 6).alias(f"recomputed_{k}") for k in m], F.round(F.col("nav") + F.col("paid") - F.col("dist"), 2).alias("recomputed_ending_nav"))


@query(f"""WITH {_PERIODS}, q AS (SELECT l_orderkey, o_custkey, CASE WHEN l_discount>0.095 THEN 'FAIL' WHEN l_tax=0 THEN 'SKIP' ELSE 'PASS' END AS status FROM lineitem JOIN orders ON o_orderkey=l_orderkey)
 SELECT fund_period_id FROM fp WHERE NOT EXISTS (SELECT 1 FROM q WHERE o_custkey=fund_period_id AND status='FAIL')""")
def vw_analytics_ready_fund_periods(spark, d):
    failing = table(spark, d, "lineitem").filter("l_discount > 0.095").select(F.col("l_orderkey").alias("o_orderkey")).distinct().join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    return _fund_periods(spark, d).select("fund_period_id").join(failing.select(F.col("o_custkey").alias("fund_period_id")).distinct(), "fund_period_id", "left_anti")


@query("""WITH q AS (SELECT l_returnflag AS rule_id, CASE WHEN l_linenumber<=2 THEN 'error' ELSE 'warning' END AS severity, CASE WHEN l_discount>0.09 THEN 'FAIL' WHEN l_tax=0 THEN 'SKIP' ELSE 'PASS' END AS status FROM lineitem)
 SELECT rule_id, severity, COUNT(*) AS checks, COUNT(*) FILTER (status='PASS') AS passes, COUNT(*) FILTER (status='FAIL') AS failures, COUNT(*) FILTER (status='SKIP') AS skips, ROUND(COUNT(*) FILTER (status='PASS')::DOUBLE/NULLIF(COUNT(*) FILTER (status IN ('PASS','FAIL')),0),6) AS pass_rate_excluding_skips FROM q GROUP BY ALL""")
def vw_quality_scorecard(spark, d):
    return relational.scorecard(_results(spark, d), ["rule_id", "severity"]).withColumn("pass_rate_excluding_skips", F.round("pass_rate_excluding_skips", 6))


def _results(spark, d):
    status = F.when(F.col("l_discount") > 0.09, "FAIL").when(F.col("l_tax") == 0, "SKIP").otherwise("PASS")
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("record_id"), F.col("l_returnflag").alias("rule_id"), F.when(F.col("l_linenumber") <= 2, "error").otherwise("warning").alias("severity"), status.alias("status"))


@query("""WITH q AS (SELECT CASE WHEN l_linenumber<=2 THEN 'error' ELSE 'warning' END AS severity, l_discount>0.09 AS bad FROM lineitem), s AS (SELECT severity, COUNT(*) FILTER (bad) AS violations, COUNT(*) AS checks FROM q GROUP BY 1)
 SELECT ROW_NUMBER() OVER (ORDER BY CASE severity WHEN 'error' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END) AS place, severity, violations, checks, CASE WHEN (SELECT SUM(violations) FROM s WHERE severity='error')>0 THEN 'BLOCKED' ELSE 'OPEN' END AS gate FROM s""")
def qa_summary(spark, d):
    """Violations by severity, the worst first, and whether they block publication."""
    s = _results(spark, d).groupBy("severity").agg(F.count_if(F.col("status") == "FAIL").alias("violations"), F.count(F.lit(1)).alias("checks"))
    worst = F.when(F.col("severity") == "error", 0).when(F.col("severity") == "warning", 1).otherwise(2)
    gate = F.when(F.sum(F.when(F.col("severity") == "error", F.col("violations")).otherwise(0)).over(W.partitionBy(F.lit(1))) > 0, "BLOCKED").otherwise("OPEN")  # a row a severity
    return s.select(big(F.row_number().over(W.orderBy(worst))).alias("place"), "severity", "violations", "checks", gate.alias("gate"))


# ------------------------------------------------------------ texts as evidence


@query("""WITH t AS (SELECT p_partkey, list_filter(regexp_extract_all(replace(lower('The '||p_name||' of '||p_brand||' at 5%'),'%',' percent '),'[a-z0-9%$.]+'), lambda w: NOT list_contains(['and','or','not','near','the','a','an','of','on','for','to','in','as'], w)) AS w FROM part) SELECT p_partkey, array_to_string(w[1:24],' ') AS terms FROM t""")
def search_terms(spark, d):
    text = F.concat(F.lit("The "), "p_name", F.lit(" of "), "p_brand", F.lit(" at 5%"))
    return table(spark, d, "part").select("p_partkey", F.array_join(records.query_terms(text), " ").alias("terms"))


@query()
def text_paragraphs(spark, d):
    """Paragraphs of every document with their version; packed line by line, so without a twin: tested against the whole text."""
    return evidence.paragraphs(table(spark, d, "documents"), "doc_id", "text").select("doc_id", "at", F.length("paragraph").alias("size"), "digest")


@query("""SELECT block_id, COUNT(*) AS notes FROM (SELECT DISTINCT block_id, original_text FROM blocks WHERE regexp_matches(original_text,'(?mi)^\\s*footnotes?\\s*:?\\s*$')) b, unnest(regexp_extract_all(original_text,'(?m)^\\s*(\\d{1,2})[.)]\\s+(\\S.*)$',1)) GROUP BY 1""")
def block_footnotes(spark, d):
    notes = table(spark, d, "blocks").select("block_id", "original_text").distinct().select("block_id", F.explode(evidence.footnotes(F.col("original_text"))).alias("n"))
    return notes.groupBy("block_id").agg(F.count(F.lit(1)).alias("notes"))


@query("""SELECT o_orderkey, o_orderkey%4 IN (0,3) AS quoted FROM orders""")
def quoted_numbers(spark, d):
    """Whether a claimed amount stands in a quote as a number of its own: not inside a longer one."""
    amount, k = F.format_number("o_totalprice", 2), F.col("o_orderkey") % 4
    quote = (
        F.when(k == 0, F.concat(F.lit("It was $"), amount, F.lit(" at year end."))).when(k == 1, F.concat(F.lit("It was 9"), F.replace(amount, F.lit(","), F.lit("")), F.lit(" then.")))
        .when(k == 2, F.concat(F.lit("It was "), amount, F.lit("7 then."))).otherwise(F.concat(F.lit("between 3.0 and "), amount, F.lit(", as stated")))
    )
    return table(spark, d, "orders").select("o_orderkey", records.number_in_quote(amount, quote).alias("quoted"))


@query("""WITH r AS (SELECT user_id, event_id, CAST(50+event_id%90 AS BIGINT) AS size, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS place FROM events), u AS (SELECT *, COALESCE(SUM(size) OVER (PARTITION BY user_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS used FROM r)
 SELECT user_id, event_id, place, CAST(LEAST(size, 600-used) AS BIGINT) AS taken FROM u WHERE used<600""")
def context_budget(spark, d):
    """Passages taken by rank until a budget of characters is used up."""
    ranked = table(spark, d, "events").select("user_id", "event_id", (50 + F.col("event_id") % 90).cast("bigint").alias("size"), big(F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("value"), "event_id"))).alias("place"))
    return evidence.within_budget(ranked, "user_id", "place", "size", 600).select("user_id", "event_id", "place", big(F.col("taken")).alias("taken"))


@query("""SELECT COUNT(*) AS current_vectors, (SELECT COUNT(*) FROM (SELECT DISTINCT md5(p_name||p_size) AS h FROM part) t WHERE h NOT IN (SELECT md5(p_name||p_size) FROM part WHERE p_size<=20)) AS to_embed FROM (SELECT p_partkey FROM part WHERE p_size<=20)""")
def vector_cache(spark, d):
    """Vectors that still fit their text, and distinct texts that have none."""
    texts = table(spark, d, "part").select("p_partkey", "p_size", F.md5(F.concat("p_name", F.col("p_size").cast("string"))).alias("digest"))
    cache = texts.filter("p_size <= 20")
    kept = evidence.current(cache, texts, "p_partkey", "digest").agg(F.count(F.lit(1)).alias("current_vectors"))
    return kept.crossJoin(evidence.stale(texts, cache).agg(F.count(F.lit(1)).alias("to_embed")))


# ----------------------------------------------------------------- wide tables


_GRAIN = ["document_id", "source_page", "source_table", "source_row_label"]
_WIDE_SQL = """r AS (SELECT DISTINCT document_id, source_page, source_table, source_row_label, source_column_label, metric_category, value_raw, row_no FROM records_a WHERE metric_category IS NOT NULL),
 s AS (SELECT document_id, source_page, source_table, source_row_label, MAX(n)>1 AS split FROM (SELECT document_id, source_page, source_table, source_row_label, metric_category, COUNT(DISTINCT COALESCE(source_column_label,'')) AS n FROM r GROUP BY ALL) GROUP BY ALL),
 g AS (SELECT r.*, CASE WHEN split THEN COALESCE(source_column_label,'') END AS column_group FROM r JOIN s ON r.document_id IS NOT DISTINCT FROM s.document_id AND r.source_page IS NOT DISTINCT FROM s.source_page AND r.source_table IS NOT DISTINCT FROM s.source_table AND r.source_row_label IS NOT DISTINCT FROM s.source_row_label)"""


def _wide_records(spark, d):
    rows = table(spark, d, "records_a").filter("metric_category is not null").select(*_GRAIN, "source_column_label", "metric_category", "value_raw", "row_no").distinct()
    return pivot.grains(rows, _GRAIN, "metric_category", "source_column_label")


def _metrics(spark, d):
    return [r[0] for r in table(spark, d, "metric_reference").select("metric_category").orderBy("metric_category").collect()]  # a fixed table


@query(f"""WITH {_WIDE_SQL}, c AS (SELECT document_id, source_page, source_table, source_row_label, column_group, metric_category, arg_min(value_raw, row_no) FILTER (value_raw IS NOT NULL OR TRUE) AS v, COUNT(*) AS n FROM g GROUP BY ALL)
 SELECT document_id, source_page, source_table, source_row_label, column_group, CAST(SUM(n) AS BIGINT) AS records, CAST(SUM(CASE WHEN n>1 THEN 1 ELSE 0 END) AS BIGINT) AS collisions FROM c GROUP BY ALL""")
def wide_rows(spark, d):
    """Records pivoted to one row per printed row, split by column only where a metric repeats."""
    w = pivot.wide(_wide_records(spark, d), _GRAIN, "metric_category", "value_raw", "row_no", _metrics(spark, d))
    return w.select(*_GRAIN, "column_group", "records", "collisions")


@query(f"""WITH {_WIDE_SQL} SELECT COUNT(*) AS records, COUNT(*)::BIGINT AS in_rows, COUNT(*) AS in_bridge, TRUE AS conserved FROM g""")
def wide_conservation(spark, d):
    """Every record counts once in the wide rows and once in the bridge."""
    rows = _wide_records(spark, d)
    return pivot.conserved(rows, pivot.wide(rows, _GRAIN, "metric_category", "value_raw", "row_no", _metrics(spark, d)), pivot.bridge(rows, "row_no", "metric_category"))


@query("""WITH r AS (SELECT DISTINCT * FROM records_a) SELECT 'dim_document' AS name, COUNT(DISTINCT COALESCE(document_id,'')) AS n_rows FROM r UNION ALL SELECT 'dim_page', COUNT(*) FROM (SELECT DISTINCT document_id, source_page FROM r)
 UNION ALL SELECT 'dim_entity', COUNT(DISTINCT subject_name) FROM r UNION ALL SELECT 'fact_observation', COUNT(*) FROM r WHERE value_raw IS NOT NULL""")
def star_schema(spark, d):
    """Rows of the dimensions and facts that records flatten to."""
    from fundloom.sources.files import manifest

    return manifest(pivot.star(table(spark, d, "records_a").distinct(), "document_id", "source_page", "subject_name", "value_raw"))


# ------------------------------------------------------- names and attributes


@query("""WITH u AS (SELECT document_id, f.field, NULLIF(trim(f.value),'') AS value FROM wide_allocation_observation, LATERAL (VALUES ('strategy', strategy),('geography', geography),('sector', sector)) f(field, value)),
 c AS (SELECT document_id, field, value, COUNT(*) AS n FROM u GROUP BY ALL), m AS (SELECT document_id, field, value AS mode FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY document_id, field ORDER BY n DESC, LENGTH(value) DESC, value) AS rn FROM c WHERE value IS NOT NULL) WHERE rn=1)
 SELECT c.document_id, c.field, CAST(COALESCE(SUM(n) FILTER (value IS NOT NULL),0) AS BIGINT) AS filled, CAST(COALESCE(SUM(n) FILTER (value IS NULL),0) AS BIGINT) AS blank, COUNT(value) AS "values", COUNT(value)-COUNT(DISTINCT lower(value)) AS variants, ANY_VALUE(mode) AS mode FROM c LEFT JOIN m ON m.document_id=c.document_id AND m.field=c.field GROUP BY 1,2""")
def attribute_harvest(spark, d):
    return harvest.attributes(table(spark, d, "wide_allocation_observation"), "document_id", ["strategy", "geography", "sector"], F.lower)


@query("""WITH w AS (SELECT DISTINCT subject_type, subject_name FROM wide_allocation_observation WHERE subject_name IS NOT NULL), k AS (SELECT CASE target_kind WHEN 'fund' THEN 'fund' ELSE 'company' END AS subject_type, trim(regexp_replace(lower(printed_name_primary),'\\s+',' ','g')) AS k, target_id FROM investment_target WHERE printed_name_primary IS NOT NULL),
 i AS (SELECT subject_type, k, MIN(target_id) AS target_id FROM (SELECT DISTINCT * FROM k) GROUP BY 1,2 HAVING COUNT(*)=1) SELECT w.subject_type, subject_name, target_id FROM w LEFT JOIN i ON i.subject_type=w.subject_type AND i.k=trim(regexp_replace(lower(subject_name),'\\s+',' ','g'))""")
def alias_lookup(spark, d):
    """Printed subjects looked up among targets of their kind, where only one has that key."""
    names = table(spark, d, "wide_allocation_observation").select("subject_type", "subject_name").filter("subject_name is not null").distinct()
    known = table(spark, d, "investment_target").filter("printed_name_primary is not null").select(F.when(F.col("target_kind") == "fund", "fund").otherwise("company").alias("subject_type"), "printed_name_primary", "target_id")
    return harvest.aliases(names, "subject_type", "subject_name", records.key_text(F.col("subject_name")), known, records.key_text(F.col("printed_name_primary")), "target_id").select("subject_type", "subject_name", "target_id")


@query("""WITH f AS (SELECT wide_row_id, regexp_extract(subject_name,'^(\\S+ \\S+)',1) AS family, NULLIF(trim(subject_manager_name),'') AS m FROM (SELECT DISTINCT wide_row_id, subject_name, subject_manager_name FROM wide_allocation_observation WHERE subject_name IS NOT NULL)),
 o AS (SELECT family, MIN(m) AS a FROM f WHERE m IS NOT NULL GROUP BY 1 HAVING MIN(m)=MAX(m)) SELECT wide_row_id, COALESCE(m,a) AS manager, CASE WHEN m IS NOT NULL THEN 'STATED' WHEN a IS NOT NULL THEN 'FAMILY '||family ELSE 'NONE' END AS manager_source FROM f LEFT JOIN o USING (family)""")
def manager_propagation(spark, d):
    """Managers of funds, taken from the family where the record states none."""
    f = table(spark, d, "wide_allocation_observation").filter("subject_name is not null").select("wide_row_id", "subject_name", F.col("subject_manager_name").alias("manager")).distinct()
    f = f.withColumn("family", F.regexp_extract("subject_name", r"^(\S+ \S+)", 1))
    return harvest.propagated(f, "family", "manager").select("wide_row_id", "manager", "manager_source")


@query("""WITH n AS (SELECT trim(regexp_replace(lower(subject_manager_name),'\\s+',' ','g')) AS key, subject_manager_name AS name, COUNT(*) AS n FROM wide_allocation_observation WHERE subject_manager_name IS NOT NULL GROUP BY 1,2)
 SELECT key, COUNT(*) AS spellings, arg_max(name, (n, LENGTH(name))) AS preferred FROM n GROUP BY 1 HAVING COUNT(*)>1""")
def spelling_conflicts(spark, d):
    return harvest.spelled_apart(table(spark, d, "wide_allocation_observation"), "subject_manager_name", records.key_text(F.col("subject_manager_name"))).select("key", "spellings", "preferred")


@query("""SELECT owner_id, arg_min(NULLIF(trim(currency),''), (report_date, position_id)) FILTER (NULLIF(trim(currency),'') IS NOT NULL) AS first_currency FROM fund_position GROUP BY 1""")
def first_non_blank(spark, d):
    stated = F.nullif(F.trim("currency"), F.lit(""))
    order = F.when(stated.isNotNull(), F.struct("report_date", "position_id"))
    return table(spark, d, "fund_position").groupBy("owner_id").agg(F.min_by(stated, order).alias("first_currency"))
