"""Queries of reviews: lineage, adjudication, detection, ordered folds and checks, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundloom.functions import printed_values, records
from fundloom.operators import relational, review
from fundloom.plans.reference import PAIR_SQL, big, query, r4, two_readings
from fundloom.sources.tables import table


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------------- joins


@query("""WITH p AS (SELECT o_custkey, o_orderstatus, o_orderpriority, year(o_orderdate) AS y, COUNT(*) AS periods FROM orders GROUP BY ALL), f AS (SELECT o_custkey, o_orderstatus, o_orderpriority, year(o_orderdate) AS y, list_sort(list(o_orderkey)) AS ids FROM orders WHERE o_totalprice>200000 GROUP BY ALL)
 SELECT o_custkey, o_orderstatus, o_orderpriority, CAST(y AS INT) AS y, periods, COALESCE(array_to_string(ids,';'),'') AS flow_ids FROM p LEFT JOIN f USING (o_custkey,o_orderstatus,o_orderpriority,y)""")
def position_key_flows(spark, d):
    """Periods with the flows of their four-part position key."""
    key = ["o_custkey", "o_orderstatus", "o_orderpriority", "y"]
    o = table(spark, d, "orders").withColumn("y", F.year("o_orderdate"))
    f = o.filter("o_totalprice > 200000").groupBy(*key).agg(F.array_sort(F.collect_list("o_orderkey")).alias("ids"))
    ids = F.array_join(F.transform("ids", lambda x: x.cast("string")), ";")
    return o.groupBy(*key).agg(F.count(F.lit(1)).alias("periods")).join(f, key, "left").select(*key, "periods", F.coalesce(ids, F.lit("")).alias("flow_ids"))


@query("""WITH w AS (SELECT DISTINCT wide_row_id, trim(unnest(string_split(observation_ids,';'))) AS observation_id FROM wide_allocation_observation) SELECT wide_row_id, COUNT(*) AS observations, MIN(observation_id) AS first_observation FROM w WHERE observation_id<>'' GROUP BY 1""")
def lineage_bridge(spark, d):
    """Wide rows traced to their observations."""
    ids = table(spark, d, "wide_allocation_observation").select("wide_row_id", F.explode(F.split("observation_ids", ";")).alias("o")).select("wide_row_id", F.trim("o").alias("o")).filter("o != ''").distinct()
    return ids.groupBy("wide_row_id").agg(F.count(F.lit(1)).alias("observations"), F.min("o").alias("first_observation"))


@query("""WITH defs AS (SELECT 1 AS place, document_id, source_page, source_table, MIN(metric_category) AS definition FROM records_a WHERE source_table IS NOT NULL GROUP BY ALL UNION ALL SELECT 2, document_id, source_page, NULL, MIN(metric_category) FROM records_a GROUP BY 2,3 UNION ALL SELECT 3, document_id, NULL, NULL, MIN(metric_category) FROM records_a GROUP BY 2),
 r AS (SELECT DISTINCT document_id, row_no, source_page, source_table FROM records_b) SELECT r.document_id, r.row_no, arg_min(definition, place) AS definition, MIN(place) AS place FROM r JOIN defs x ON x.document_id=r.document_id AND (x.source_page=r.source_page OR x.source_page IS NULL) AND (x.source_table=r.source_table OR x.source_table IS NULL) GROUP BY 1,2""")
def scoped_definitions(spark, d):
    """The definition that applies to a record: that of its table, else of its page, else of its document."""
    a = table(spark, d, "records_a")
    b = table(spark, d, "records_b").select("document_id", "row_no", "source_page", "source_table").distinct()
    return review.scoped(b, a, [["document_id", "source_page", "source_table"], ["document_id", "source_page"], ["document_id"]], "metric_category").select(
        "document_id", "row_no", F.col("scoped").alias("definition"), "place").filter("definition is not null").groupBy("document_id", "row_no").agg(F.min_by("definition", "place").alias("definition"), F.min("place").alias("place"))


@query("""WITH inj AS (SELECT o_orderkey FROM orders WHERE o_orderstatus='P'), fail AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_discount>0.08), k AS (SELECT o_orderpriority AS defect, COUNT(*) AS injected, COUNT(l_orderkey) AS detected FROM inj JOIN orders USING (o_orderkey) LEFT JOIN fail ON l_orderkey=o_orderkey GROUP BY 1)
 SELECT defect, injected, detected, injected-detected AS missed, ROUND(detected*1.0/injected,6) AS rate FROM k""")
def detection_scorecard(spark, d):
    injected = table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("record"), F.col("o_orderpriority").alias("defect"))
    failed = table(spark, d, "lineitem").filter("l_discount > 0.08").select(F.col("l_orderkey").alias("record"))
    return review.detection(injected, failed, "record", "defect").withColumn("rate", r6("rate"))


@query("""SELECT x.key, x.present_in FROM (SELECT observation_id AS key, 'exceptions' AS present_in FROM quality_source_exceptions WHERE source_document_id NOT IN (SELECT document_id FROM records_a) UNION ALL SELECT DISTINCT document_id, 'records' FROM records_a WHERE document_id NOT IN (SELECT source_document_id FROM quality_source_exceptions)) x""")
def unmatched_exceptions(spark, d):
    """Exceptions without records of their document, and documents without exceptions."""
    e, r = table(spark, d, "quality_source_exceptions"), table(spark, d, "records_a").select(F.col("document_id").alias("source_document_id")).distinct()
    lost = e.join(r, "source_document_id", "left_anti").select(F.col("observation_id").alias("key"), F.lit("exceptions").alias("present_in"))
    return lost.unionByName(r.join(e, "source_document_id", "left_anti").select(F.col("source_document_id").alias("key"), F.lit("records").alias("present_in")))


# --------------------------------------------------------------- adjudication


@query(f"""WITH {PAIR_SQL}, j AS (SELECT COALESCE(a.k,b.k) AS k, COALESCE(a.p,b.p) AS p, a.q AS qa, b.q AS qb FROM a FULL JOIN b ON a.k=b.k AND a.p=b.p)
 SELECT k, p, CASE WHEN qa IS NOT DISTINCT FROM qb THEN 'AGREED' WHEN qa IS NULL OR qb IS NULL THEN 'SINGLE' WHEN ABS(qa-qb)<=1 AND k%2=0 THEN 'ADJUDICATED' ELSE 'OPEN' END AS decision, CASE WHEN qa IS NOT DISTINCT FROM qb THEN qa WHEN qa IS NULL THEN qb WHEN qb IS NULL THEN qa WHEN ABS(qa-qb)<=1 AND k%2=0 THEN GREATEST(qa,qb) END AS final FROM j""")
def adjudicated_readings(spark, d):
    """Two readings made one: agreed, single, decided by an adjudicator, or open."""
    a, b = two_readings(spark, d)
    j = a.withColumnRenamed("q", "qa").join(b.withColumnRenamed("q", "qb"), ["k", "p"], "full_outer")
    rulings = j.filter((F.abs(F.col("qa") - F.col("qb")) <= 1) & (F.col("k") % 2 == 0) & (F.col("qa") != F.col("qb"))).select("k", "p", F.greatest("qa", "qb").alias("ruling"))
    return review.adjudicated(j, rulings, ["k", "p"], "qa", "qb", "ruling").select("k", "p", "decision", "final")


@query(f"""WITH {PAIR_SQL}, j AS (SELECT COALESCE(a.k,b.k) AS k, a.q AS qa, b.q AS qb FROM a FULL JOIN b ON a.k=b.k AND a.p=b.p), x AS (SELECT k, CASE WHEN qa IS NULL THEN 'missing_a' WHEN qb IS NULL THEN 'missing_b' ELSE 'differs' END AS status FROM j WHERE qa IS DISTINCT FROM qb)
 SELECT status, COUNT(*) AS cells, COUNT(DISTINCT k) AS documents FROM x GROUP BY 1""")
def disagreement_counts(spark, d):
    a, b = two_readings(spark, d)
    j = a.withColumnRenamed("q", "qa").join(b.withColumnRenamed("q", "qb"), ["k", "p"], "full_outer").filter(~F.col("qa").eqNullSafe(F.col("qb")))
    status = F.when(F.col("qa").isNull(), "missing_a").when(F.col("qb").isNull(), "missing_b").otherwise("differs")
    return j.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("cells"), F.countDistinct("k").alias("documents"))


@query(f"""WITH {PAIR_SQL}, ra AS (SELECT a.* FROM a ANTI JOIN b ON a.k=b.k AND a.p=b.p), rb AS (SELECT b.* FROM b ANTI JOIN a ON a.k=b.k AND a.p=b.p), ua AS (SELECT k, q, MIN(p) AS p FROM ra GROUP BY 1,2 HAVING COUNT(*)=1), ub AS (SELECT k, q, MIN(p) AS p FROM rb GROUP BY 1,2 HAVING COUNT(*)=1)
 SELECT k, ua.p AS a_part, ub.p AS b_part FROM ua JOIN ub USING (k, q) WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k=ua.k AND b.p%100=ua.p%100)""")
def renamed_columns(spark, d):
    """Residual rows paired by value, unless the other reading has the label too."""
    a, b = two_readings(spark, d)
    rest = lambda x, y: x.join(y, ["k", "p"], "left_anti")
    pairs = relational.unique_match(rest(a, b).withColumnRenamed("p", "a_part"), rest(b, a).withColumnRenamed("p", "b_part"), ["k", "q"], "a_part", "b_part")
    labels = b.select("k", (F.col("p") % 100).alias("label")).distinct()
    return pairs.withColumn("label", F.col("a_part") % 100).join(labels, ["k", "label"], "left_anti").select("k", "a_part", "b_part")


# --------------------------------------------------------------- aggregations


@query("""WITH g AS (SELECT p_brand, p_type, COUNT(*) AS n, quantile_cont(p_retailprice,0.5) AS med, AVG(p_retailprice) AS mean, stddev_samp(p_retailprice) AS sd FROM part GROUP BY 1,2), a AS (SELECT quantile_cont(p_retailprice,0.5) AS med FROM part)
 SELECT p_brand, p_type, n, ROUND(CASE WHEN n>=5 THEN g.med ELSE a.med END,4) AS median_used, CASE WHEN n>=5 THEN 'own' ELSE 'all' END AS origin, ROUND(mean,4) AS mean, ROUND(sd,4) AS sd FROM g, a""")
def calibration_parameters(spark, d):
    """Medians of groups with enough rows, that of all rows else, with mean and deviation."""
    from fundloom.operators.order_statistics import quantiles

    p = table(spark, d, "part").select("p_brand", "p_type", "p_retailprice")
    own = quantiles(p, ["p_brand", "p_type"], "p_retailprice", {"own": 0.5})
    every = quantiles(p.withColumn("one", F.lit(1)), ["one"], "p_retailprice", {"every": 0.5}).select("every")  # one row
    moments = p.groupBy("p_brand", "p_type").agg(F.avg("p_retailprice").alias("mean"), F.stddev_samp("p_retailprice").alias("sd"))
    x = own.join(moments, ["p_brand", "p_type"]).crossJoin(F.broadcast(every))
    enough = F.col("n") >= 5
    return x.select("p_brand", "p_type", "n", r4(F.when(enough, F.col("own")).otherwise(F.col("every"))).alias("median_used"), F.when(enough, "own").otherwise("all").alias("origin"), r4("mean").alias("mean"), r4("sd").alias("sd"))


@query("""WITH c AS (SELECT o_orderpriority AS strategy, COUNT(DISTINCT o_custkey) AS periods, COUNT(DISTINCT o_custkey) FILTER (o_orderstatus='F') AS analysed, SUM(o_totalprice*o_orderkey%7) AS weighted, COUNT(DISTINCT o_orderstatus) AS readings FROM orders GROUP BY 1)
 SELECT strategy, periods, analysed, ROUND(analysed*1.0/periods,6) AS coverage, ROUND(weighted,2) AS weighted, readings=1 AS one_reading FROM c""")
def exposure_summary(spark, d):
    """Coverage ratio, weighted sum and whether a group has one reading."""
    o = table(spark, d, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("strategy")).agg(
        F.countDistinct("o_custkey").alias("periods"), F.countDistinct(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))).alias("analysed"),
        F.round(F.sum(F.col("o_totalprice") * F.col("o_orderkey") % 7), 2).alias("weighted"), (F.countDistinct("o_orderstatus") == 1).alias("one_reading"),
    ).select("strategy", "periods", "analysed", r6(F.col("analysed") / F.col("periods")).alias("coverage"), "weighted", "one_reading")


@query("""SELECT position_id, ROUND(((CASE WHEN quantity_raw IS NOT NULL THEN 1 ELSE 0 END)+(CASE WHEN fair_value IS NOT NULL THEN 1 ELSE 0 END)+(CASE WHEN COALESCE(trim(currency),'')<>'' THEN 1 ELSE 0 END)+(CASE WHEN as_of_date IS NOT NULL THEN 1 ELSE 0 END))/4.0,4) AS readiness FROM (SELECT DISTINCT position_id, quantity_raw, fair_value, currency, as_of_date FROM fund_position)""")
def readiness_ratio(spark, d):
    """Share of the required fields that a position states."""
    p = table(spark, d, "fund_position").select("position_id", "quantity_raw", "fair_value", "currency", "as_of_date").distinct()
    return p.select("position_id", r4(review.stated_part("quantity_raw", "fair_value", "currency", "as_of_date")).alias("readiness"))


@query("""WITH x AS (SELECT l_orderkey, MAX(CASE WHEN l_discount>0.095 THEN 4 WHEN l_discount>0.02 THEN 3 WHEN l_tax>0.03 THEN 2 ELSE 1 END) AS s FROM lineitem GROUP BY 1) SELECT l_orderkey, CASE s WHEN 4 THEN 'FAIL' WHEN 3 THEN 'PASS' WHEN 2 THEN 'NOT_TESTABLE' ELSE 'NOT_CHECKED' END AS status FROM x""")
def quality_precedence(spark, d):
    status = F.when(F.col("l_discount") > 0.095, "FAIL").when(F.col("l_discount") > 0.02, "PASS").when(F.col("l_tax") > 0.03, "NOT_TESTABLE").otherwise("NOT_CHECKED")
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(review.worst_status(status, ["FAIL", "PASS", "NOT_TESTABLE", "NOT_CHECKED"]).alias("status"))


@query("""WITH x AS (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 0.5 WHEN 'O' THEN 0.05 ELSE 0.005 END*CASE WHEN o_orderkey%2=0 THEN 1000 ELSE 1 END AS h FROM orders) SELECT o_custkey, MAX(h) AS widest FROM x GROUP BY 1""")
def widest_half_unit(spark, d):
    """The coarsest printed precision behind each position."""
    v = F.when(F.col("o_orderstatus") == "F", F.format_number("o_totalprice", 0)).when(F.col("o_orderstatus") == "O", F.format_number("o_totalprice", 1)).otherwise(F.format_number("o_totalprice", 2))
    half = printed_values.half_unit(v, F.when(F.col("o_orderkey") % 2 == 0, 1000).otherwise(1))
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max(half).alias("widest"))


@query("""WITH x AS (SELECT l_suppkey, l_partkey, SUM(l_extendedprice) AS got, SUM(l_quantity*1000) AS put FROM lineitem GROUP BY 1,2), y AS (SELECT l_suppkey, SUM(got) AS g, SUM(put) AS p, arg_max(got, (got-put, l_partkey)) AS bg, arg_max(put, (got-put, l_partkey)) AS bp FROM x GROUP BY 1)
 SELECT l_suppkey, ROUND(g-p,2) AS gain, ROUND(g/p,6) AS multiple, ROUND((g-bg)/NULLIF(p-bp,0),6) AS multiple_without_best FROM y""")
def deal_analysis(spark, d):
    x = table(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_extendedprice").alias("got"), F.sum(F.col("l_quantity") * 1000).alias("put"))
    best = F.max(F.struct((F.col("got") - F.col("put")).alias("gain"), "l_partkey", "got", "put"))
    y = x.groupBy("l_suppkey").agg(F.sum("got").alias("g"), F.sum("put").alias("p"), best.alias("b"))
    return y.select("l_suppkey", F.round(F.col("g") - F.col("p"), 2).alias("gain"), r6(F.col("g") / F.col("p")).alias("multiple"), r6((F.col("g") - F.col("b.got")) / F.nullif(F.col("p") - F.col("b.put"), F.lit(0.0))).alias("multiple_without_best"))


# -------------------------------------------------------- ordered folds, ranks


@query("""SELECT o_custkey, o_orderkey, SUM(CAST(ROUND(o_totalprice,2) AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS paid_in FROM orders""")
def rounded_running(spark, d):
    """Running totals rounded at each step, in exact decimals."""
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(W.unboundedPreceding, 0)
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", F.sum(F.round("o_totalprice", 2).cast("decimal(18,2)")).over(w).cast("decimal(38,2)").alias("paid_in"))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount>0.09 AS flagged, MAX(CASE WHEN l_discount>0.09 THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey) AS any_flag, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS n FROM lineitem) SELECT l_orderkey, COUNT(*) FILTER (flagged OR (any_flag=0 AND n=1)) AS reviewed FROM x GROUP BY 1""")
def page_flags(spark, d):
    """Rows flagged for review, the first of a page where none is."""
    x = table(spark, d, "lineitem").withColumn("flagged", F.col("l_discount") > 0.09)
    return review.at_least_one(x, ["l_orderkey"], "flagged", ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], "reviewed").groupBy("l_orderkey").agg(F.count_if(F.col("reviewed")).alias("reviewed"))


@query("""WITH r AS (SELECT o_custkey, o_orderstatus, o_totalprice, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END AS rank FROM orders), m AS (SELECT o_custkey, o_orderstatus, MIN(rank) AS best FROM r GROUP BY 1,2)
 SELECT r.o_custkey, r.o_orderstatus, MIN(o_totalprice) AS value, COUNT(DISTINCT o_totalprice)>1 AS conflict FROM r JOIN m ON m.o_custkey=r.o_custkey AND m.o_orderstatus=r.o_orderstatus AND rank=best GROUP BY 1,2""")
def binding_wins(spark, d):
    """The value of the most binding document, and whether documents of that rank conflict."""
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2).otherwise(3)
    return review.binding(table(spark, d, "orders").withColumn("rank", rank), ["o_custkey", "o_orderstatus"], "rank", "o_totalprice").select("o_custkey", "o_orderstatus", "value", "conflict")


@query("""SELECT s_suppkey, RANK() OVER (PARTITION BY s_nationkey ORDER BY ROUND(s_acctbal/7,12) DESC) AS place, ROW_NUMBER() OVER (PARTITION BY s_nationkey ORDER BY ROUND(s_acctbal/7,12) DESC, s_suppkey) AS shown FROM supplier""")
def tolerant_rank(spark, d):
    """Competition ranks of scores equal to 1e-12, shown in order of id."""
    from fundloom.operators.order_statistics import numbered, ranks

    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", F.round(F.col("s_acctbal") / 7, 12).alias("score"))
    placed = ranks(s, ["s_nationkey"], "score").withColumn("least", -F.col("score"))
    return numbered(placed, ["s_nationkey"], ["least", "s_suppkey"], "shown").select("s_suppkey", F.col("competition").alias("place"), "shown")


@query("""WITH f AS (SELECT p_partkey, p_brand, p_size AS vintage, p_retailprice FROM part) SELECT p_partkey, LAG(p_partkey) OVER w AS predecessor, COUNT(*) OVER (PARTITION BY p_brand, vintage)>1 AS ambiguous, ROUND(p_retailprice/LAG(p_retailprice) OVER w,6) AS step_up FROM f WINDOW w AS (PARTITION BY p_brand ORDER BY vintage, p_partkey)""")
def fund_genealogy(spark, d):
    """Funds of a family in order of vintage and id, their predecessors, and doubtful ones: two of one vintage."""
    w = W.partitionBy("p_brand").orderBy("p_size", "p_partkey")
    return table(spark, d, "part").select("p_partkey", F.lag("p_partkey").over(w).alias("predecessor"), (F.count(F.lit(1)).over(W.partitionBy("p_brand", "p_size")) > 1).alias("ambiguous"), r6(F.col("p_retailprice") / F.lag("p_retailprice").over(w)).alias("step_up"))


@query("""SELECT event_type, event_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS n FROM events) WHERE n<=CASE WHEN event_type='error' THEN 1 ELSE 3 END""")
def brief_cards(spark, d):
    """Cards of a brief: one warning, three of each other kind; the limits are the report."""
    w = W.partitionBy("event_type").orderBy(F.desc("value"), "event_id")
    return table(spark, d, "events").withColumn("n", F.row_number().over(w)).filter(F.col("n") <= F.when(F.col("event_type") == "error", 1).otherwise(3)).select("event_type", "event_id")


# ------------------------------------------------------- lookups and functions


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority='1-URGENT' AND o_orderstatus='F' THEN 'a' WHEN o_orderpriority='1-URGENT' THEN 'b' WHEN o_orderstatus='O' THEN 'c' ELSE 'd' END AS outcome FROM orders""")
def wildcard_rules(spark, d):
    """The most specific rule that matches: exact values, patterns and wildcards by priority; equal ones that disagree are an error."""
    rules = [(1, {"o_orderpriority": "1-URGENT", "o_orderstatus": "F"}, "a"), (2, {"o_orderpriority": "/^1-/", "o_orderstatus": "*"}, "b"), (3, {"o_orderpriority": "*", "o_orderstatus": "O"}, "c"), (9, {"o_orderpriority": "*", "o_orderstatus": "*"}, "d")]
    return table(spark, d, "orders").select("o_orderkey", review.rule_outcome(rules).alias("outcome"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'partial' END AS meaning FROM orders""")
def required_lookup(spark, d):
    """A matrix that has every value; a value it lacks is an error."""
    return table(spark, d, "orders").select("o_orderkey", review.required({"F": "final", "O": "open", "P": "partial"}, F.col("o_orderstatus"), "order status").alias("meaning"))


@query("""WITH g AS (SELECT DISTINCT wide_row_id, strategy, sector FROM wide_allocation_observation), m(k, v) AS (VALUES ('buyout','Buyout'),('growth','Growth Equity'),('venture','Venture'),('technology','Technology'))
 SELECT wide_row_id, COALESCE(a.v, b.v, NULLIF(trim(strategy),''), 'Unclassified') AS reading, CASE WHEN a.v IS NOT NULL THEN 'strategy' WHEN b.v IS NOT NULL THEN 'sector' WHEN NULLIF(trim(strategy),'') IS NOT NULL THEN 'printed' ELSE 'none' END AS origin FROM g LEFT JOIN m a ON a.k=lower(trim(strategy)) LEFT JOIN m b ON b.k=lower(trim(sector))""")
def grouping_reading(spark, d):
    """Printed groupings read into a taxonomy, by strategy, then sector, else as printed."""
    taxonomy = {"buyout": "Buyout", "growth": "Growth Equity", "venture": "Venture", "technology": "Technology"}
    g = table(spark, d, "wide_allocation_observation").select("wide_row_id", "strategy", "sector").distinct()
    reading, origin = review.reading(taxonomy, ["strategy", "sector"])
    return g.select("wide_row_id", reading.alias("reading"), origin.alias("origin"))


@query("""SELECT c_custkey, LEAST(2000, GREATEST(-100, c_acctbal)) AS clamped, ROUND(GREATEST(5000-c_acctbal,0),2) AS gap, ROUND(CASE WHEN c_acctbal>0 THEN GREATEST(0, 1-GREATEST(5000-c_acctbal,0)/c_acctbal) END,6) AS haircut, ROUND(1000*0.9*(0.3-0.05)*(8-1.5),4) AS downside,
 CAST(('0x'||substr(sha256(c_name),1,8)) AS BIGINT)%5 AS bucket, ROUND(date_diff('day', DATE '2000-01-01', DATE '2000-01-01' + CAST(c_custkey%900 AS INT))/30.4375,6) AS months, DATE '2000-01-01' + CAST(round(366*0.25) AS INT) AS quarter_way FROM customer""")
def scalar_math(spark, d):
    gap, haircut = records.recovery_gap(F.lit(5000.0), F.col("c_acctbal"), F.col("c_acctbal"))
    start = F.lit("2000-01-01").cast("date")
    return table(spark, d, "customer").select(
        "c_custkey", records.clamp(F.col("c_acctbal"), -100.0, 2000.0).alias("clamped"), F.round(gap, 2).alias("gap"), r6(haircut).alias("haircut"),
        r4(records.downside(F.lit(1000.0), F.lit(0.3), F.lit(8.0), 0.1, 0.05, 1.5)).alias("downside"), records.bucket(F.col("c_name"), 5).alias("bucket"),
        r6(records.months_between_days(start, F.date_add(start, (F.col("c_custkey") % 900).cast("int")))).alias("months"), records.date_at(start, F.date_add(start, 366), F.lit(0.25)).alias("quarter_way"))


@query("""WITH x AS (SELECT user_id, list(event_type ORDER BY ts, event_id) AS l FROM events GROUP BY 1) SELECT user_id, l[1] AS first_type, len(list_distinct(l)) AS kinds, to_json(list_sort(list_distinct(l))) AS ids, list_contains(list_append(l,'end'),'end') AS ended FROM x""")
def id_arrays(spark, d):
    """Distinct ids in first order, as a sorted JSON array, and appended to."""
    x = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))).alias("a")).select("user_id", F.transform("a", lambda v: v["event_type"]).alias("l"))
    once = F.array_distinct("l")
    return x.select("user_id", once[0].alias("first_type"), big(F.size(once)).alias("kinds"), F.to_json(F.array_sort(once)).alias("ids"), F.array_contains(F.array_append("l", F.lit("end")), "end").alias("ended"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey%40 AS a, l_partkey%40 AS b FROM lineitem WHERE l_suppkey%40<l_partkey%40 UNION SELECT 41, 42 UNION SELECT 42, 43 UNION SELECT 43, 41 UNION SELECT 43, 1),
 r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a=r.b) SELECT DISTINCT CAST(a AS BIGINT) AS node FROM r WHERE a=b""")
def graph_cycles(spark, d):
    """Nodes on a cycle of a graph whose nodes may have several parents."""
    lines = table(spark, d, "lineitem").select((F.col("l_suppkey") % 40).alias("a"), (F.col("l_partkey") % 40).alias("b")).filter("a < b")
    ring = spark.createDataFrame([(41, 42), (42, 43), (43, 41), (43, 1)], "a bigint, b bigint")
    edges = lines.select(big(F.col("a")).alias("a"), big(F.col("b")).alias("b")).unionByName(ring).distinct()
    return review.on_cycles(edges).select("node")


@query("""SELECT b.block_id, COUNT(n.block_id) AS notes FROM (SELECT DISTINCT block_id, file_id, physical_page FROM blocks WHERE block_kind='paragraph') b JOIN (SELECT DISTINCT block_id, file_id, physical_page FROM blocks WHERE block_kind='footnote') n ON n.file_id=b.file_id AND n.physical_page=b.physical_page GROUP BY 1""")
def related_notes(spark, d):
    """Paragraphs with the notes of their page: one hop. Notes are counted per page first."""
    b = table(spark, d, "blocks").select("block_id", "file_id", "physical_page", "block_kind").distinct()
    notes = b.filter("block_kind = 'footnote'").groupBy("file_id", "physical_page").agg(F.count(F.lit(1)).alias("notes"))
    return b.filter("block_kind = 'paragraph'").join(notes, ["file_id", "physical_page"]).select("block_id", "notes")


@query("""SELECT COUNT(*) AS source_rows, COUNT(*) FILTER (o.o_orderkey IS NULL) AS lost, COUNT(*) FILTER (o.o_totalprice IS DISTINCT FROM s.o_totalprice AND o.o_orderkey IS NOT NULL) AS changed FROM (SELECT * FROM orders WHERE o_orderstatus='F') s LEFT JOIN (SELECT o_orderkey, CASE WHEN o_orderkey%30=0 THEN o_totalprice+1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_totalprice>5000) o USING (o_orderkey)""")
def source_preserved(spark, d):
    """Whether every source row is in the completed table with its values."""
    o = table(spark, d, "orders")
    done = o.filter("o_totalprice > 5000").select("o_orderkey", F.when(F.col("o_orderkey") % 30 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    return review.preserved(o.filter("o_orderstatus = 'F'"), done, "o_orderkey", ["o_totalprice"])
