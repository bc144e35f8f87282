"""Analytics queries over the star tables: positions, dated flows, holdings, events and texts.

A position is a customer, its dated flows are the orders (status F is a call,
O a distribution), its holdings are line items, the benchmark is the monthly
mean price of shipped lines. Each query has an SQL twin under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundloom.functions import finance, ids, labels
from fundloom.functions.numbers import printed_number
from fundloom.operators import asof, performance, relational, retrieval
from fundloom.operators.order_statistics import numbered, quantiles, ranks
from fundloom.sources import files
from fundloom.sources.tables import table
from fundloom.streaming import windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL twin."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r4(c):
    return F.round(c, 4)


def big(c):
    return c.cast("bigint")


# ---------------------------------------------------------------- flows and returns

FLOWS_SQL = """flows AS (SELECT o_custkey AS position, CAST(o_orderdate AS DATE) AS d,
 SUM(CASE WHEN o_orderstatus='F' THEN -o_totalprice ELSE o_totalprice END) AS amount
 FROM orders WHERE o_orderstatus IN ('F','O') GROUP BY 1,2)"""
BENCH_SQL = """monthly AS (SELECT last_day(CAST(l_shipdate AS DATE)) AS d, AVG(l_extendedprice) AS level FROM lineitem GROUP BY 1)"""


def flows(spark: SparkSession, d: str) -> DataFrame:
    """(position, d, amount): signed same-day sums."""
    signed = F.when(F.col("o_orderstatus") == "F", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    return table(spark, d, "orders").filter(F.col("o_orderstatus").isin("F", "O")).groupBy(
        F.col("o_custkey").alias("position"), F.col("o_orderdate").cast("date").alias("d")
    ).agg(F.sum(signed).alias("amount"))


def benchmark(spark: SparkSession, d: str) -> DataFrame:
    """(d, level): the mean price of a month, dated at its end so that nothing looks ahead."""
    return table(spark, d, "lineitem").groupBy(F.last_day(F.col("l_shipdate").cast("date")).alias("d")).agg(F.avg("l_extendedprice").alias("level"))


@query(f"WITH {FLOWS_SQL} SELECT position, d, ROUND(amount,4) AS amount FROM flows")
def same_day_flows(spark, d):
    return flows(spark, d).select("position", "d", r4("amount").alias("amount"))


@query(f"""WITH {FLOWS_SQL}, {BENCH_SQL}, v AS (SELECT f.position, f.amount, m.level FROM flows f ASOF JOIN monthly m ON f.d >= m.d),
 last AS (SELECT level AS final FROM monthly ORDER BY d DESC LIMIT 1)
 SELECT position, ROUND(SUM(CASE WHEN amount>0 THEN amount*final/level ELSE 0 END),2) AS fv_distributions,
 ROUND(SUM(CASE WHEN amount<0 THEN -amount*final/level ELSE 0 END),2) AS fv_calls,
 ROUND(SUM(CASE WHEN amount>0 THEN amount*final/level ELSE 0 END)/NULLIF(SUM(CASE WHEN amount<0 THEN -amount*final/level ELSE 0 END),0),6) AS ks_pme
 FROM v CROSS JOIN last GROUP BY position""")
def ks_pme(spark, d):
    """Public market equivalent per position: flows carried to the end at the benchmark level as of their date."""
    levels = benchmark(spark, d)
    final = levels.agg(F.max_by("level", "d").alias("final"))  # one row
    own = flows(spark, d)
    v = own.join(F.broadcast(performance.levels_as_of(own, "d", levels)), "d").crossJoin(F.broadcast(final))  # a row a calendar day at most
    grown = F.col("amount") * F.col("final") / F.col("level")
    put, got = F.sum(F.when(F.col("amount") < 0, -grown).otherwise(0.0)), F.sum(F.when(F.col("amount") > 0, grown).otherwise(0.0))
    return v.groupBy("position").agg(F.round(got, 2).alias("fv_distributions"), F.round(put, 2).alias("fv_calls"), F.round(got / F.nullif(put, F.lit(0.0)), 6).alias("ks_pme"))


@query(f"""WITH {FLOWS_SQL} SELECT position, ROUND(SUM(CASE WHEN amount<0 THEN -amount ELSE 0 END),2) AS paid_in,
 ROUND(SUM(CASE WHEN amount>0 THEN amount ELSE 0 END),2) AS distributed,
 ROUND(SUM(CASE WHEN amount>0 THEN amount ELSE 0 END)/NULLIF(SUM(CASE WHEN amount<0 THEN -amount ELSE 0 END),0),6) AS dpi,
 ROUND(GREATEST(MAX(c_acctbal),0)/NULLIF(SUM(CASE WHEN amount<0 THEN -amount ELSE 0 END),0),6) AS rvpi
 FROM flows JOIN customer ON c_custkey=position GROUP BY position""")
def fund_multiples(spark, d):
    put, got = F.sum(F.when(F.col("amount") < 0, -F.col("amount")).otherwise(0.0)), F.sum(F.when(F.col("amount") > 0, F.col("amount")).otherwise(0.0))
    held = table(spark, d, "customer").select(F.col("c_custkey").alias("position"), "c_acctbal")
    return flows(spark, d).groupBy("position").agg(put.alias("p"), got.alias("g")).join(held, "position").select(
        "position", F.round("p", 2).alias("paid_in"), F.round("g", 2).alias("distributed"), F.round(F.col("g") / F.nullif("p", F.lit(0.0)), 6).alias("dpi"),
        F.round(F.greatest("c_acctbal", F.lit(0.0)) / F.nullif("p", F.lit(0.0)), 6).alias("rvpi"),
    )


@query(f"""WITH {FLOWS_SQL}, o AS (SELECT position, MIN(d) AS d0 FROM flows GROUP BY 1)
 SELECT f.position, ROUND(SUM(amount/POW(1.08, date_diff('day', d0, d)/365.0)),2) AS npv FROM flows f JOIN o USING(position) GROUP BY 1""")
def xnpv_at_8_percent(spark, d):
    arrays = finance.dated_flows(flows(spark, d), ["position"], "d", "amount")
    return arrays.select("position", F.round(finance.xnpv(F.col("flows"), 0.08), 2).alias("npv"))


@query()
def xirr_by_position(spark, d):
    """Internal rate of return; iterative, so without an SQL twin: tests check that the value at the rate is zero."""
    arrays = finance.dated_flows(flows(spark, d), ["position"], "d", "amount")
    return finance.with_xirr(arrays, "flows").select("position", F.round("xirr", 8).alias("xirr"))


@query(f"""WITH {BENCH_SQL} SELECT d, ROUND(level/LAG(level) OVER (ORDER BY d)-1,6) AS simple_return FROM monthly""")
def simple_returns(spark, d):
    return benchmark(spark, d).select("d", F.round(F.col("level") / F.lag("level").over(W.orderBy("d")) - 1, 6).alias("simple_return"))


@query("""WITH m AS (SELECT n_regionkey AS series, last_day(CAST(o_orderdate AS DATE)) AS d, AVG(o_totalprice) AS level FROM orders JOIN customer ON c_custkey=o_custkey JOIN nation ON n_nationkey=c_nationkey GROUP BY 1,2),
 r AS (SELECT series, d, level/LAG(level) OVER (PARTITION BY series ORDER BY d)-1 AS rate FROM m)
 SELECT series, d, ROUND(EXP(SUM(LN(1+rate)) OVER (PARTITION BY series ORDER BY d)),6) AS idx FROM r WHERE rate IS NOT NULL""")
def cumulative_index(spark, d):
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("series"))
    series = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(nation), "c_nationkey")
    m = series.groupBy("series", F.last_day(F.col("o_orderdate").cast("date")).alias("d")).agg(F.avg("o_totalprice").alias("level"))
    r = m.withColumn("rate", F.col("level") / F.lag("level").over(W.partitionBy("series").orderBy("d")) - 1).filter("rate is not null")
    return relational.fold_index(r, ["series"], "d", "rate").select("series", "d", F.round("index", 6).alias("idx"))


@query("""WITH g AS (SELECT o_custkey, date_diff('day', LAG(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE)), CAST(o_orderdate AS DATE)) AS gap FROM orders),
 l AS (SELECT o_custkey, list_sort(list(gap)) AS gaps FROM g WHERE gap IS NOT NULL GROUP BY 1)
 SELECT o_custkey AS position, gaps[len(gaps)//2+1] AS median_gap FROM l""")
def median_spacing(spark, d):
    """The upper median of the days between consecutive flows."""
    day = F.col("o_orderdate").cast("date")
    gaps = table(spark, d, "orders").select("o_custkey", F.datediff(day, F.lag(day).over(W.partitionBy("o_custkey").orderBy(day))).alias("gap"))
    per = gaps.filter("gap is not null").groupBy("o_custkey").agg(F.sort_array(F.collect_list("gap")).alias("g"))
    return per.select(F.col("o_custkey").alias("position"), big(F.element_at("g", (F.size("g") / 2).cast("int") + 1)).alias("median_gap"))


@query("""WITH y AS (SELECT c_mktsegment AS s, year(o_orderdate) AS yr, AVG(o_totalprice) AS level FROM orders JOIN customer ON c_custkey=o_custkey GROUP BY 1,2),
 r AS (SELECT s, yr, level/LAG(level) OVER (PARTITION BY s ORDER BY yr)-1 AS rate FROM y)
 SELECT s AS strategy, ROUND(EXP(SUM(LN(1+rate)))-1,6) AS trailing, COUNT(*) AS years FROM r WHERE rate IS NOT NULL AND yr>=1998 GROUP BY 1""")
def trailing_compounded(spark, d):
    y = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).groupBy(
        F.col("c_mktsegment").alias("strategy"), F.year("o_orderdate").alias("yr")).agg(F.avg("o_totalprice").alias("level"))
    r = y.withColumn("rate", F.col("level") / F.lag("level").over(W.partitionBy("strategy").orderBy("yr")) - 1).filter("rate is not null and yr >= 1998")
    return r.groupBy("strategy").agg(F.round(F.product(1 + F.col("rate")) - 1, 6).alias("trailing"), F.count(F.lit(1)).alias("years"))


# ------------------------------------------------------------------ joins


@query("""SELECT c.c_custkey, COUNT(o.o_orderkey) AS flows, ROUND(COALESCE(SUM(o.o_totalprice),0),2) AS total FROM customer c LEFT JOIN orders o ON o.o_custkey=c.c_custkey GROUP BY 1""")
def periods_with_flows(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("o_orderkey").alias("n"), F.sum("o_totalprice").alias("t"))
    return table(spark, d, "customer").select("c_custkey").join(o, "c_custkey", "left").select(
        "c_custkey", F.coalesce("n", F.lit(0)).alias("flows"), F.round(F.coalesce("t", F.lit(0.0)), 2).alias("total"))


@query("""WITH c AS (SELECT event_id, user_id, ts FROM events WHERE event_type='purchase'), v AS (SELECT user_id, ts AS vts, MAX(value) AS value FROM events WHERE event_type='view' GROUP BY 1,2)
 SELECT c.event_id, v.vts AS view_ts, ROUND(v.value,4) AS view_value FROM c ASOF LEFT JOIN v ON c.user_id=v.user_id AND c.ts>=v.vts""")
def asof_latest_view(spark, d):
    e = table(spark, d, "events")
    left = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = e.filter("event_type = 'view'").select("user_id", F.col("ts").alias("view_ts"), "value")
    return asof.join_asof(left, right, ["user_id"], "ts", "view_ts", ["value"]).select("event_id", "view_ts", r4("value").alias("view_value"))


@query("""WITH l AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus='O'), r AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS rd, MAX(o_totalprice) AS nav FROM orders WHERE o_orderstatus='F' GROUP BY 1,2),
 j AS (SELECT l.o_custkey, l.d, r.rd, r.nav FROM l ASOF LEFT JOIN r ON l.o_custkey=r.o_custkey AND l.d>r.rd)
 SELECT o_custkey, d, CASE WHEN date_diff('day', rd, d)<=180 THEN rd END AS mark_date, CASE WHEN date_diff('day', rd, d)<=180 THEN ROUND(nav,2) END AS mark FROM j""")
def asof_mark_within_180_days(spark, d):
    """The latest valuation strictly before an exit, refused when older than 180 days."""
    o = table(spark, d, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("d"), "o_orderstatus", "o_totalprice")
    left = o.filter("o_orderstatus = 'O'").select("o_custkey", "d").distinct()
    right = o.filter("o_orderstatus = 'F'").select("o_custkey", F.col("d").alias("mark_date"), F.col("o_totalprice").alias("nav"))
    return asof.join_asof(left, right, ["o_custkey"], "d", "mark_date", ["nav"], strict=True, tolerance=180).select("o_custkey", "d", "mark_date", F.round("nav", 2).alias("mark"))


@query("""SELECT COUNT(*) AS orphans, COUNT(DISTINCT l_orderkey) AS keys FROM lineitem WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey=l_orderkey AND o_orderstatus<>'P')""")
def orphan_lines(spark, d):
    parents = table(spark, d, "orders").filter("o_orderstatus <> 'P'")
    return relational.missing_parents(table(spark, d, "lineitem").select("l_orderkey"), "l_orderkey", parents, "o_orderkey").agg(
        F.count(F.lit(1)).alias("orphans"), F.countDistinct("l_orderkey").alias("keys"))


@query("""SELECT r_name, p_type, COUNT(*) AS lines, ROUND(SUM(l_extendedprice*(1-l_discount)),2) AS exposure FROM lineitem JOIN supplier ON s_suppkey=l_suppkey JOIN nation ON n_nationkey=s_nationkey JOIN region ON r_regionkey=n_regionkey JOIN part ON p_partkey=l_partkey GROUP BY 1,2""")
def chained_exposure(spark, d):
    """Look through lines to parts, and to the region of the supplier, pre-aggregated before the widening joins."""
    value = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = table(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("v"))
    place = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("s_nationkey"), "r_name")
    who = table(spark, d, "supplier").join(F.broadcast(place), "s_nationkey").select(F.col("s_suppkey").alias("l_suppkey"), "r_name")
    what = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return lines.join(who, "l_suppkey").join(what, "l_partkey").groupBy("r_name", "p_type").agg(F.sum("n").alias("lines"), F.round(F.sum("v"), 2).alias("exposure"))


PAIR_SQL = """a AS (SELECT l_orderkey k, l_partkey p, MAX(l_quantity) q FROM lineitem WHERE l_linenumber<=4 GROUP BY 1,2), b AS (SELECT l_orderkey k, l_partkey p, MAX(CASE WHEN l_partkey%7=0 THEN l_quantity+1 ELSE l_quantity END) q FROM lineitem WHERE l_linenumber>=2 GROUP BY 1,2)"""


def two_readings(spark, d):
    lines = table(spark, d, "lineitem")
    moved = F.when(F.col("l_partkey") % 7 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    a = lines.filter("l_linenumber <= 4").groupBy(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("p")).agg(F.max("l_quantity").alias("q"))
    b = lines.filter("l_linenumber >= 2").groupBy(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("p")).agg(F.max(moved).alias("q"))
    return a, b


@query(f"""WITH {PAIR_SQL} SELECT CASE WHEN a.q IS NULL THEN 'B_ONLY' WHEN b.q IS NULL THEN 'A_ONLY' WHEN a.q IS DISTINCT FROM b.q THEN 'CONFLICT' ELSE 'MATCH' END AS status, COUNT(*) AS pairs FROM a FULL JOIN b ON a.k=b.k AND a.p=b.p GROUP BY 1""")
def paired_readings(spark, d):
    a, b = two_readings(spark, d)
    j = a.withColumnRenamed("q", "qa").join(b.withColumnRenamed("q", "qb"), ["k", "p"], "full_outer")
    status = F.when(F.col("qa").isNull(), "B_ONLY").when(F.col("qb").isNull(), "A_ONLY").when(~F.col("qa").eqNullSafe(F.col("qb")), "CONFLICT").otherwise("MATCH")
    return j.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("pairs"))


@query(f"""WITH {PAIR_SQL}, ra AS (SELECT a.* FROM a ANTI JOIN b ON a.k=b.k AND a.p=b.p), rb AS (SELECT b.* FROM b ANTI JOIN a ON a.k=b.k AND a.p=b.p),
 ua AS (SELECT k, MIN(p) p FROM ra GROUP BY 1 HAVING COUNT(*)=1), ub AS (SELECT k, MIN(p) p FROM rb GROUP BY 1 HAVING COUNT(*)=1) SELECT k, ua.p AS a_part, ub.p AS b_part FROM ua JOIN ub USING(k)""")
def realigned_readings(spark, d):
    """What full keys leave unpaired, paired by the coarser key where that is unique on both sides."""
    a, b = two_readings(spark, d)
    rest = lambda x, y: x.join(y, ["k", "p"], "left_anti")
    return relational.unique_match(rest(a, b).withColumnRenamed("p", "a_part"), rest(b, a).withColumnRenamed("p", "b_part"), ["k"], "a_part", "b_part")


@query(f"""WITH {PAIR_SQL} SELECT side, COUNT(*) AS n FROM ((SELECT 'a' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) UNION ALL (SELECT 'b', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))) GROUP BY 1""")
def multiset_parity(spark, d):
    return relational.parity(*two_readings(spark, d)).groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT o_custkey, last_day(CAST(o_orderdate AS DATE)) AS d, SUM(o_totalprice) AS v FROM orders GROUP BY 1,2)
 SELECT x.o_custkey, x.d, ROUND(x.v,2) AS closing, ROUND(y.v,2) AS opening FROM s x JOIN s y ON y.o_custkey=x.o_custkey AND y.d=last_day(CAST(x.d - INTERVAL 12 MONTH AS DATE))""")
def opening_snapshot_one_year_before(spark, d):
    s = table(spark, d, "orders").groupBy("o_custkey", F.last_day(F.col("o_orderdate").cast("date")).alias("d")).agg(F.sum("o_totalprice").alias("v"))
    before = s.select("o_custkey", F.last_day(F.add_months("d", 12)).alias("d"), F.round("v", 2).alias("opening"))
    return s.join(before, ["o_custkey", "d"]).select("o_custkey", "d", F.round("v", 2).alias("closing"), "opening")


@query("""WITH s AS (SELECT user_id, ts AS t0, ts + INTERVAL 6 HOUR AS t1, event_id FROM events WHERE event_type='purchase') SELECT s.event_id, COUNT(e.event_id) AS interim, ROUND(COALESCE(SUM(e.value),0),4) AS value FROM s LEFT JOIN events e ON e.user_id=s.user_id AND e.ts>s.t0 AND e.ts<=s.t1 GROUP BY 1""")
def interim_events(spark, d):
    """Events in the half-open interval (reference, closing], found by an equi-join on six-hour buckets: no range join."""
    six = 6 * 3600 * 1_000_000
    e = table(spark, d, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    s = e.filter("event_type = 'purchase'").select("event_id", "user_id", micros.alias("t0"))
    spans = s.withColumn("bucket", F.explode(F.array(F.floor(F.col("t0") / six), F.floor(F.col("t0") / six) + 1)))
    hits = e.select("user_id", micros.alias("t"), "value", F.floor(micros / six).alias("bucket"))
    found = spans.join(hits, ["user_id", "bucket"]).filter((F.col("t") > F.col("t0")) & (F.col("t") <= F.col("t0") + six)).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    return s.join(found, "event_id", "left").select("event_id", F.coalesce("n", F.lit(0)).alias("interim"), r4(F.coalesce("v", F.lit(0.0))).alias("value"))


@query("""SELECT s_suppkey, COALESCE(o.rate, 0.02) AS fee, CASE WHEN o.rate IS NULL THEN 'base' ELSE 'override' END AS origin FROM supplier LEFT JOIN (SELECT n_nationkey, 0.01 + n_nationkey/1000.0 AS rate FROM nation WHERE n_nationkey%3=0) o ON o.n_nationkey=s_nationkey""")
def scoped_override(spark, d):
    o = table(spark, d, "nation").filter("n_nationkey % 3 = 0").select(F.col("n_nationkey").alias("s_nationkey"), (F.lit(0.01) + F.col("n_nationkey") / 1000.0).alias("rate"))
    return table(spark, d, "supplier").join(F.broadcast(o), "s_nationkey", "left").select(
        "s_suppkey", F.coalesce("rate", F.lit(0.02)).alias("fee"), F.when(F.col("rate").isNull(), "base").otherwise("override").alias("origin"))


@query("""SELECT COUNT(*) AS n, SUM(CASE WHEN generated THEN 1 ELSE 0 END) AS generated FROM (SELECT o_custkey AS k, false AS generated FROM (SELECT DISTINCT o_custkey FROM orders) UNION ALL SELECT c_custkey, true FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))""")
def source_wins_over_generated(spark, d):
    source = table(spark, d, "orders").select(F.col("o_custkey").alias("k")).distinct().withColumn("generated", F.lit(False))
    made = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.lit(True).alias("generated"))
    return relational.source_wins(source, made, ["k"]).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("generated").cast("bigint")).alias("generated"))


@query("""WITH x AS (SELECT c_custkey, c_mktsegment, c_nationkey, c_acctbal FROM customer) SELECT c_custkey, (SELECT COUNT(*) FROM x y WHERE y.c_mktsegment=x.c_mktsegment AND y.c_nationkey<>x.c_nationkey) AS peers,
 ROUND(100.0*((SELECT COUNT(*) FROM x y WHERE y.c_mktsegment=x.c_mktsegment AND y.c_nationkey<>x.c_nationkey AND y.c_acctbal<x.c_acctbal)+0.5*(SELECT COUNT(*) FROM x y WHERE y.c_mktsegment=x.c_mktsegment AND y.c_nationkey<>x.c_nationkey AND y.c_acctbal=x.c_acctbal))/(SELECT COUNT(*) FROM x y WHERE y.c_mktsegment=x.c_mktsegment AND y.c_nationkey<>x.c_nationkey),4) AS percentile FROM x""")
def peer_midpoint_percentile(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    return relational.midpoint_percentile(c, ["c_mktsegment"], "c_nationkey", "c_acctbal").select("c_custkey", "peers", r4("percentile").alias("percentile"))


# ------------------------------------------------------------- aggregations


@query("""SELECT l_returnflag, l_linestatus, COUNT(*) AS total, COUNT(*) FILTER (l_discount<=0.05) AS passed, COUNT(*) FILTER (l_discount>0.05 AND l_tax>0) AS failed, ROUND(COUNT(*) FILTER (l_discount<=0.05)*1.0/NULLIF(COUNT(*) FILTER (l_discount<=0.05 OR l_tax>0),0),6) AS pass_rate FROM lineitem GROUP BY ALL""")
def scorecard(spark, d):
    ok, bad = F.col("l_discount") <= 0.05, (F.col("l_discount") > 0.05) & (F.col("l_tax") > 0)
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("passed"), F.count_if(bad).alias("failed"),
        F.round(F.count_if(ok) / F.nullif(F.count_if((F.col("l_discount") <= 0.05) | (F.col("l_tax") > 0)), F.lit(0)), 6).alias("pass_rate"))


@query("""SELECT event_type, COUNT(*) AS rows_all, COUNT(NULLIF(value,0)) AS with_value, COUNT(DISTINCT user_id) AS users FROM events GROUP BY 1""")
def resolution_coverage(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("rows_all"), F.count(F.nullif("value", F.lit(0.0))).alias("with_value"), F.countDistinct("user_id").alias("users"))


@query("""SELECT p_type, COUNT(*) AS n, MIN(p_retailprice) AS low, quantile_cont(p_retailprice,0.25) AS p25, quantile_cont(p_retailprice,0.5) AS p50, quantile_cont(p_retailprice,0.75) AS p75, MAX(p_retailprice) AS high FROM part GROUP BY 1""")
def distribution_summary(spark, d):
    q = quantiles(table(spark, d, "part").select("p_type", "p_retailprice"), ["p_type"], "p_retailprice", {"low": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "high": 1.0})
    return q.select("p_type", "n", "low", "p25", "p50", "p75", "high")


@query("""WITH h AS (SELECT l_suppkey, p_type, SUM(l_extendedprice) AS v FROM lineitem JOIN part ON p_partkey=l_partkey GROUP BY 1,2), s AS (SELECT *, v/SUM(v) OVER (PARTITION BY l_suppkey) AS w, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY v DESC, p_type) AS rn FROM h)
 SELECT l_suppkey, ROUND(SUM(w*w),6) AS hhi, ROUND(MAX(w),6) AS top1, ROUND(SUM(CASE WHEN rn<=3 THEN w ELSE 0 END),6) AS top3 FROM s GROUP BY 1""")
def concentration(spark, d):
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    h = table(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_extendedprice").alias("v")).join(parts, "l_partkey").groupBy("l_suppkey", "p_type").agg(F.sum("v").alias("v"))
    by = W.partitionBy("l_suppkey")
    s = h.withColumns({"w": F.col("v") / F.sum("v").over(by), "rn": F.row_number().over(by.orderBy(F.desc("v"), "p_type"))})
    return s.groupBy("l_suppkey").agg(F.round(F.sum(F.col("w") * F.col("w")), 6).alias("hhi"), F.round(F.max("w"), 6).alias("top1"), F.round(F.sum(F.when(F.col("rn") <= 3, F.col("w")).otherwise(0.0)), 6).alias("top3"))


@query("""WITH m AS (SELECT c_mktsegment, quantile_cont(c_acctbal,0.5) AS med FROM customer GROUP BY 1), x AS (SELECT c.c_mktsegment, med, quantile_cont(ABS(c_acctbal-med),0.5) AS mad FROM customer c JOIN m USING(c_mktsegment) GROUP BY 1,2)
 SELECT c_custkey, ROUND((c_acctbal-med)/(1.4826*mad),6) AS robust_z FROM customer JOIN x USING(c_mktsegment)""")
def robust_z(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    med = quantiles(c, ["c_mktsegment"], "c_acctbal", {"med": 0.5}).select("c_mktsegment", "med")
    dev = c.join(med, "c_mktsegment")
    mad = quantiles(dev.withColumn("away", F.abs(F.col("c_acctbal") - F.col("med"))), ["c_mktsegment"], "away", {"mad": 0.5}).select("c_mktsegment", "mad")
    return dev.join(mad, "c_mktsegment").select("c_custkey", F.round((F.col("c_acctbal") - F.col("med")) / (1.4826 * F.col("mad")), 6).alias("robust_z"))


@query("""WITH s AS (SELECT c_nationkey, c_acctbal AS y, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS x FROM customer) SELECT c_nationkey, ROUND(regr_slope(y,x),6) AS slope, ROUND(AVG(CASE WHEN y>5000 THEN 1.0 ELSE 0.0 END),6) AS above, ROUND(stddev_samp(y),4) AS sd FROM s GROUP BY 1""")
def consistency_and_slope(spark, d):
    s = numbered(table(spark, d, "customer").select("c_nationkey", "c_custkey", F.col("c_acctbal").alias("y")), ["c_nationkey"], ["c_custkey"], "x").withColumn("x", F.col("x").cast("double"))
    return s.groupBy("c_nationkey").agg(F.round(F.regr_slope("y", "x"), 6).alias("slope"), F.round(F.avg(F.when(F.col("y") > 5000, 1.0).otherwise(0.0)), 6).alias("above"), r4(F.stddev_samp("y")).alias("sd"))


@query("""WITH c AS (SELECT p_brand, p_type, COUNT(*) AS n FROM part GROUP BY 1,2), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY n DESC, LENGTH(p_type) DESC, p_type) AS rn FROM c) SELECT p_brand, p_type AS mode, n FROM r WHERE rn=1""")
def mode_with_ties(spark, d):
    c = table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    return relational.latest_per_key(c, ["p_brand"], [F.desc("n"), F.desc(F.length("p_type")), F.col("p_type")]).select("p_brand", F.col("p_type").alias("mode"), "n")


@query("""SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1,2 HAVING COUNT(*)>1""")
def duplicate_signatures(spark, d):
    return relational.repeated_keys(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("""SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ';' ORDER BY o_orderdate, o_orderkey) AS ids FROM orders GROUP BY 1""")
def ordered_id_concat(spark, d):
    g = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey"))).alias("a"))
    return g.select("o_custkey", F.array_join(F.transform("a", lambda x: x["o_orderkey"].cast("string")), ";").alias("ids"))


@query("""SELECT o_custkey, MIN(CASE WHEN o_orderpriority='1-URGENT' THEN NULL END) AS nothing, arg_min(o_totalprice, o_orderkey) FILTER (o_orderstatus='F') AS f_value, arg_min(o_totalprice, o_orderkey) FILTER (o_orderstatus='O') AS o_value, arg_min(o_totalprice, o_orderkey) FILTER (o_orderstatus='P') AS p_value,
 (CASE WHEN COUNT(*) FILTER (o_orderstatus='F')>1 THEN 1 ELSE 0 END + CASE WHEN COUNT(*) FILTER (o_orderstatus='O')>1 THEN 1 ELSE 0 END + CASE WHEN COUNT(*) FILTER (o_orderstatus='P')>1 THEN 1 ELSE 0 END)::BIGINT AS collisions FROM orders GROUP BY 1""".replace("MIN(CASE WHEN o_orderpriority='1-URGENT' THEN NULL END) AS nothing, ", ""))
def first_wins_pivot(spark, d):
    p = relational.first_wins_pivot(table(spark, d, "orders"), ["o_custkey"], "o_orderstatus", "o_totalprice", "o_orderkey", ["F", "O", "P"])
    return p.select("o_custkey", F.col("F").alias("f_value"), F.col("O").alias("o_value"), F.col("P").alias("p_value"), big(F.col("collisions")).alias("collisions"))


@query("""SELECT user_id FROM events GROUP BY 1 HAVING COUNT(DISTINCT event_type) > 4""")
def mixed_basis(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.countDistinct("event_type").alias("n")).filter("n > 4").select("user_id")


@query("""SELECT ROUND(AVG(ABS(o_totalprice-150000)),4) AS mae, ROUND(SUM(o_totalprice*ABS(o_totalprice-150000))/SUM(o_totalprice),4) AS weighted_mae, ROUND(AVG(o_totalprice-150000),4) AS bias FROM orders""")
def forecast_errors(spark, d):
    e = F.col("o_totalprice") - 150000
    return table(spark, d, "orders").agg(r4(F.avg(F.abs(e))).alias("mae"), r4(F.sum(F.col("o_totalprice") * F.abs(e)) / F.sum("o_totalprice")).alias("weighted_mae"), r4(F.avg(e)).alias("bias"))


@query("""SELECT l_orderkey, CASE WHEN MAX(CASE WHEN l_discount>0.09 THEN 1 ELSE 0 END)=1 THEN 'FAIL' WHEN MAX(CASE WHEN l_discount>0 THEN 1 ELSE 0 END)=1 THEN 'PASS' ELSE 'NOT_TESTABLE' END AS status FROM lineitem GROUP BY 1""")
def status_precedence(spark, d):
    fail, ok = F.max((F.col("l_discount") > 0.09).cast("int")), F.max((F.col("l_discount") > 0).cast("int"))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.when(fail == 1, "FAIL").when(ok == 1, "PASS").otherwise("NOT_TESTABLE").alias("status"))


@query("""SELECT p_brand, COUNT(*) AS n, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS types FROM part GROUP BY 1""")
def family_summary(spark, d):
    return table(spark, d, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("p_type")), "|").alias("types"))


@query("""SELECT n_regionkey, COALESCE(c_mktsegment,'ALL') AS segment, COUNT(*) AS n, ROUND(SUM(c_acctbal),2) AS balance FROM customer JOIN nation ON n_nationkey=c_nationkey GROUP BY GROUPING SETS ((n_regionkey, c_mktsegment),(n_regionkey))""")
def exposure_rollup(spark, d):
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    return table(spark, d, "customer").join(F.broadcast(nation), "c_nationkey").rollup("n_regionkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance")).filter("n_regionkey is not null").select(
        "n_regionkey", F.coalesce("c_mktsegment", F.lit("ALL")).alias("segment"), "n", "balance")


# --------------------------------------------------------- windows, sorts, sets


@query("""SELECT o_custkey, o_orderkey, ROUND(o_totalprice,2) AS last_value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn=1""")
def latest_row(spark, d):
    return relational.latest_per_key(table(spark, d, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", F.round("o_totalprice", 2).alias("last_value"))


@query("""SELECT s_suppkey, DENSE_RANK() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC) AS dense, RANK() OVER (PARTITION BY s_nationkey ORDER BY ROUND(s_acctbal,0) DESC) AS competition FROM supplier""")
def rank_variants(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal", F.round("s_acctbal", 0).alias("whole"))
    dense = ranks(s, ["s_nationkey"], "s_acctbal").drop("competition")
    return ranks(dense.withColumnRenamed("dense", "own"), ["s_nationkey"], "whole").select("s_suppkey", F.col("own").alias("dense"), "competition")


@query(f"""WITH {FLOWS_SQL}, b AS (SELECT position, d, SUM(amount) OVER (PARTITION BY position ORDER BY d) AS balance FROM flows) SELECT position, d, ROUND(balance,2) AS balance, balance<0 AS overdrawn FROM b""")
def running_balance(spark, d):
    b = flows(spark, d).withColumn("balance", F.sum("amount").over(W.partitionBy("position").orderBy("d")))
    return b.select("position", "d", F.round("balance", 2).alias("balance"), (F.col("balance") < 0).alias("overdrawn"))


@query("""WITH c AS (SELECT o_custkey, o_orderkey, o_orderdate, SUM(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)/SUM(o_totalprice) OVER (PARTITION BY o_custkey) AS part FROM orders) SELECT o_custkey, MIN(o_orderdate) FILTER (part>=0.5) AS half_called, MIN(o_orderdate) FILTER (part>=0.75) AS three_quarters FROM c GROUP BY 1""")
def call_milestones(spark, d):
    by = W.partitionBy("o_custkey")
    c = table(spark, d, "orders").withColumn("part", F.sum("o_totalprice").over(by.orderBy("o_orderdate", "o_orderkey")) / F.sum("o_totalprice").over(by))
    first = lambda x: F.min(F.when(F.col("part") >= x, F.col("o_orderdate")))
    return c.groupBy("o_custkey").agg(first(0.5).alias("half_called"), first(0.75).alias("three_quarters"))


@query("""SELECT s_suppkey, LAG(s_suppkey) OVER w AS predecessor, ROUND(s_acctbal/NULLIF(LAG(s_acctbal) OVER w,0),6) AS step_up, COUNT(*) OVER (PARTITION BY s_nationkey) AS family FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_suppkey)""")
def genealogy(spark, d):
    w = W.partitionBy("s_nationkey").orderBy("s_suppkey")
    return table(spark, d, "supplier").select("s_suppkey", F.lag("s_suppkey").over(w).alias("predecessor"), F.round(F.col("s_acctbal") / F.nullif(F.lag("s_acctbal").over(w), F.lit(0.0)), 6).alias("step_up"), F.count(F.lit(1)).over(W.partitionBy("s_nationkey")).alias("family"))


@query("""WITH q AS (SELECT p_type, quantile_cont(p_retailprice,0.3333) AS a, quantile_cont(p_retailprice,0.6667) AS b FROM part GROUP BY 1) SELECT p_partkey, CASE WHEN p_retailprice<=a THEN 'small' WHEN p_retailprice<=b THEN 'mid' ELSE 'large' END AS band FROM part JOIN q USING(p_type)""")
def size_bands(spark, d):
    parts = table(spark, d, "part")
    q = quantiles(parts, ["p_type"], "p_retailprice", {"a": 0.3333, "b": 0.6667})
    return parts.join(q, "p_type").select("p_partkey", F.when(F.col("p_retailprice") <= F.col("a"), "small").when(F.col("p_retailprice") <= F.col("b"), "mid").otherwise("large").alias("band"))


@query("""WITH s AS (SELECT s_nationkey, s_acctbal, COUNT(*) OVER w0 AS n, ROW_NUMBER() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS lo, ROW_NUMBER() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey DESC) AS hi FROM supplier WINDOW w0 AS (PARTITION BY s_nationkey))
 SELECT s_nationkey, ROUND(AVG(s_acctbal),4) AS all_mean, ROUND(AVG(s_acctbal) FILTER (hi>1),4) AS without_best, ROUND(AVG(s_acctbal) FILTER (lo>1),4) AS without_worst FROM s WHERE n>=2 GROUP BY 1""")
def leave_one_out(spark, d):
    """Means of each cohort, and without its best and its worst row: sums less an extreme, so no cohort is sorted."""
    n, total = F.count(F.lit(1)), F.sum("s_acctbal")
    mean = lambda less, k: r4((total - less) / (n - k))
    return table(spark, d, "supplier").groupBy("s_nationkey").agg(
        n.alias("n"), mean(F.lit(0.0), 0).alias("all_mean"), r4(F.try_divide(total - F.max("s_acctbal"), n - 1)).alias("without_best"), r4(F.try_divide(total - F.min("s_acctbal"), n - 1)).alias("without_worst")
    ).filter("n >= 2").drop("n")


@query("""SELECT event_type, user_id, event_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn<=2""")
def top_two_evidence(spark, d):
    w = W.partitionBy("event_type").orderBy(F.desc("value"), "event_id")
    return table(spark, d, "events").withColumn("rn", F.row_number().over(w)).filter("rn <= 2").select("event_type", "user_id", "event_id")


@query("""SELECT l_suppkey, arg_max(l_partkey, (l_extendedprice, l_orderkey, l_linenumber, l_partkey)) AS best_part FROM lineitem GROUP BY 1""")
def winner_take(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.max(F.struct("l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"))["l_partkey"].alias("best_part"))


@query("""SELECT (SELECT COUNT(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders)) AS both_sides, (SELECT COUNT(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)) AS missing, (SELECT COUNT(*) FROM (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer)) AS extra""")
def key_coverage(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.lit(1).alias("a")).distinct()
    b = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.lit(1).alias("b")).distinct()
    return a.join(b, "k", "full_outer").agg(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("both_sides"), F.count_if(F.col("b").isNull()).alias("missing"), F.count_if(F.col("a").isNull()).alias("extra"))


@query("""SELECT n_nationkey, s.c_mktsegment FROM nation CROSS JOIN (SELECT DISTINCT c_mktsegment FROM customer) s ANTI JOIN (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal>9000) h ON h.c_nationkey=n_nationkey AND h.c_mktsegment=s.c_mktsegment""")
def missing_from_complete_grid(spark, d):
    """Cells of the (nation, segment) grid without a large account; the grid is two tiny closed lists."""
    c = table(spark, d, "customer")
    segments = c.select("c_mktsegment").distinct().agg(F.collect_set("c_mktsegment").alias("s"))
    grid = table(spark, d, "nation").crossJoin(F.broadcast(segments)).select("n_nationkey", F.explode("s").alias("c_mktsegment"))
    have = c.filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment").distinct()
    return grid.join(have, ["n_nationkey", "c_mktsegment"], "left_anti")


# ------------------------------------------------------- lookups and functions


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'admit' WHEN '2-HIGH' THEN 'admit' WHEN '5-LOW' THEN 'refuse' ELSE 'review' END AS decision FROM orders""")
def decision_matrix(spark, d):
    matrix = {"1-URGENT": "admit", "2-HIGH": "admit", "5-LOW": "refuse", "<blank>": "refuse", "*": "review"}
    return table(spark, d, "orders").select("o_orderkey", relational.lookup(matrix, F.col("o_orderpriority")).alias("decision"))


@query("""SELECT p_partkey, CASE WHEN regexp_matches(p_name,'ring') THEN 'metal' WHEN regexp_matches(p_name,'^small') THEN 'small' WHEN regexp_matches(p_name,'.') THEN 'other' END AS class FROM part""")
def ranked_rules(spark, d):
    rules = [(1, "ring", "metal"), (2, "^small", "small"), (9, ".", "other")]
    return table(spark, d, "part").select("p_partkey", relational.match_rules(None, rules, "p_name").alias("class"))


@query("""SELECT o_orderkey, COALESCE(NULLIF(CASE WHEN o_orderpriority='5-LOW' THEN '' ELSE o_orderpriority END,''), o_orderstatus, 'unstated') AS basis FROM orders""")
def first_stated(spark, d):
    p = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority"))
    return table(spark, d, "orders").select("o_orderkey", F.coalesce(F.nullif(F.trim(p), F.lit("")), "o_orderstatus", F.lit("unstated")).alias("basis"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN l_extendedprice*1000 WHEN 'N' THEN l_extendedprice ELSE l_extendedprice/100 END AS scaled FROM lineitem WHERE l_shipdate<=TIMESTAMP '1996-06-30'""")
def scaled_amounts(spark, d):
    """Amounts by their stated scale, of lines shipped up to mid-1996 only; scaled_lines has all lines."""
    return _scaled(table(spark, d, "lineitem").filter("l_shipdate <= timestamp '1996-06-30'"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN l_extendedprice*1000 WHEN 'N' THEN l_extendedprice ELSE l_extendedprice/100 END AS scaled FROM lineitem""")
def scaled_lines(spark, d):
    """Amounts of all lines by their stated scale."""
    return _scaled(table(spark, d, "lineitem"))


def _scaled(lines: DataFrame) -> DataFrame:
    v = F.col("l_extendedprice")
    return lines.select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "A", v * 1000).when(F.col("l_returnflag") == "N", v).otherwise(v / 100).alias("scaled"))


@query("""SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey=c_custkey AND o_totalprice<5000)""")
def analytics_ready(spark, d):
    return table(spark, d, "customer").select("c_custkey").join(table(spark, d, "orders").filter("o_totalprice < 5000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("""SELECT c_custkey, 'CUS_'||substr(sha256(c_name||chr(31)||c_mktsegment),1,16) AS id, CAST(('0x'||substr(sha256(c_name),1,8)) AS BIGINT)%10=0 AS sampled FROM customer""")
def stable_ids(spark, d):
    return table(spark, d, "customer").select("c_custkey", ids.digest_id("CUS_", F.col("c_name"), F.col("c_mktsegment")).alias("id"), ids.one_in_ten(F.col("c_name")).alias("sampled"))


@query("""SELECT p_partkey, regexp_replace(regexp_replace(upper(p_name||' / '||p_brand),'[^A-Z0-9]+','_','g'),'^_+|_+$','','g') AS snake, trim(regexp_replace(regexp_replace(lower(p_type||'-investments'),'[-–—_]',' ','g'),'\\binvestments?\\b',' ','g')) AS label FROM part""")
def label_functions(spark, d):
    return table(spark, d, "part").select("p_partkey", ids.upper_snake(F.concat_ws(" / ", "p_name", "p_brand")).alias("snake"), labels.canonical_label(F.concat("p_type", F.lit("-investments"))).alias("label"))


@query("""SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS value FROM orders""")
def printed_number_round_trip(spark, d):
    """Amounts printed with grouping, marks and brackets read back as the same numbers."""
    p = F.format_number("o_totalprice", 2)
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("$ "), p)).when(F.col("o_orderkey") % 3 == 1, F.concat(p, F.lit(" "))).otherwise(F.concat(F.lit("USD"), p))
    return table(spark, d, "orders").select("o_orderkey", printed_number(text).cast("decimal(18,2)").alias("value"))


@query("""SELECT c_custkey, CAST(FLOOR(CAST(year(MIN(o_orderdate)) AS DOUBLE)/3)*3 AS BIGINT) AS vintage_bucket, last_day(CAST(MIN(o_orderdate) AS DATE)) AS month_end, CAST(MIN(o_orderdate) + INTERVAL 24 MONTH AS DATE) AS two_years_on FROM customer JOIN orders ON o_custkey=c_custkey GROUP BY 1""")
def date_functions(spark, d):
    first = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").cast("date").alias("f")).join(table(spark, d, "customer").select("c_custkey"), "c_custkey")
    return first.select("c_custkey", big(F.floor(F.year("f") / 3) * 3).alias("vintage_bucket"), F.last_day("f").alias("month_end"), F.add_months("f", 24).alias("two_years_on"))


@query("""SELECT DISTINCT c_mktsegment, last_day(CAST(q AS DATE)) AS quarter_end FROM customer, unnest(generate_series(DATE '2001-03-01', DATE '2002-12-31', INTERVAL 3 MONTH)) t(q)""")
def quarter_ends(spark, d):
    return table(spark, d, "customer").select("c_mktsegment").distinct().select("c_mktsegment", F.explode(F.expr("sequence(date'2001-03-01', date'2002-12-31', interval 3 months)")).alias("q")).select("c_mktsegment", F.last_day("q").alias("quarter_end"))


@query("""SELECT event_id, CAST(json_extract(props,'$.k') AS BIGINT) AS k, CAST(json_extract(props,'$.k') AS BIGINT) IN (1,2,3) AS wanted FROM events""")
def json_attributes(spark, d):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, d, "events").select("event_id", k.alias("k"), k.isin(1, 2, 3).alias("wanted"))


# ------------------------------------------------------------------ retrieval


_TERMS = ["portfolio", "leverage", "buyout"]
_BM25_SQL = """t AS (SELECT doc_id, regexp_extract_all(lower(COALESCE(text,'')), '[a-z0-9]+') AS w FROM documents),
c AS (SELECT doc_id, len(w)*1.0 AS l, """ + ", ".join(f"len(list_filter(w, lambda x: x='{t}'))*1.0 AS tf{i}" for i, t in enumerate(_TERMS)) + """ FROM t),
s AS (SELECT COUNT(*) AS n, AVG(l) AS a, """ + ", ".join(f"COUNT(*) FILTER (tf{i}>0) AS df{i}" for i in range(3)) + """ FROM c),
k AS (SELECT doc_id, """ + " + ".join(f"ln(1+(n-df{i}+0.5)/(df{i}+0.5))*tf{i}*2.2/(tf{i}+1.2*(0.25+0.75*l/a))" for i in range(3)) + """ AS score FROM c, s WHERE tf0>0 OR tf1>0 OR tf2>0)"""
_DOT = "list_sum(list_transform(list_zip({a},{b}), lambda z: CAST(z[1] AS DOUBLE)*CAST(z[2] AS DOUBLE)))"
_VECTOR_SQL = (
    "q AS (SELECT embedding AS qe FROM embeddings WHERE vec_id=7), v AS (SELECT vec_id AS doc_id, "
    + _DOT.format(a="embedding", b="qe") + "/sqrt(" + _DOT.format(a="embedding", b="embedding") + "*" + _DOT.format(a="qe", b="qe") + ") AS score FROM embeddings, q)"
)


@query(f"WITH {_BM25_SQL} SELECT doc_id, ROUND(score,6) AS score FROM k ORDER BY ROUND(k.score,9) DESC, doc_id LIMIT 20")
def bm25_top(spark, d):
    """The 20 best documents for three query words; the limit is the report. bm25_top_each has all queries."""
    scored = retrieval.bm25(table(spark, d, "documents"), "doc_id", "text", _TERMS).withColumn("s", F.round("score", 9))
    return retrieval.top(scored, "s", "doc_id", 20).select("doc_id", F.round("score", 6).alias("score"))


@query(f"WITH {_VECTOR_SQL} SELECT doc_id AS vec_id, ROUND(score,5) AS score FROM v ORDER BY ROUND(v.score,9) DESC, doc_id LIMIT 20")
def vector_top(spark, d):
    """The 20 nearest vectors to one; the limit is the report. vector_top_each has all queries."""
    return retrieval.top(_nearest(spark, d), "s", "vec_id", 20).select("vec_id", F.round("score", 5).alias("score"))


def _nearest(spark, d):
    v = table(spark, d, "embeddings")
    one = v.filter("vec_id = 7").select(F.col("embedding").alias("q"))  # the query: one row
    return v.crossJoin(F.broadcast(one)).select("vec_id", retrieval.cosine(F.col("embedding"), F.col("q")).alias("score")).withColumn("s", F.round("score", 9))


@query(f"""WITH {_BM25_SQL}, {_VECTOR_SQL}, a AS (SELECT doc_id, ROW_NUMBER() OVER (ORDER BY ROUND(score,9) DESC, doc_id) AS r FROM k), b AS (SELECT doc_id, ROW_NUMBER() OVER (ORDER BY ROUND(score,9) DESC, doc_id) AS r FROM v),
 u AS (SELECT doc_id, 1.0/(60+r) AS s FROM a WHERE r<=50 UNION ALL SELECT doc_id, 0.7/(60+r) FROM b WHERE r<=50) SELECT doc_id, ROUND(SUM(s),8) AS score FROM u GROUP BY 1""")
def hybrid_retrieval(spark, d):
    """Keyword and vector top lists of one query fused by reciprocal ranks with weights 1.0 and 0.7. hybrid_retrieval_each has all queries."""
    words = retrieval.top(retrieval.bm25(table(spark, d, "documents"), "doc_id", "text", _TERMS).withColumn("s", F.round("score", 9)), "s", "doc_id", 50)
    near = retrieval.top(_nearest(spark, d), "s", "vec_id", 50).withColumnRenamed("vec_id", "doc_id")
    return retrieval.fuse([(words, 1.0), (near, 0.7)], "doc_id").select("doc_id", F.round("score", 8).alias("score"))


#: Searches: every row whose id is divisible by 100 against all rows.
_ASKED = "{} % 100 = 0"
_BM25_EACH_SQL = """t AS (SELECT doc_id, regexp_extract_all(lower(COALESCE(text,'')), '[a-z0-9]+') AS w FROM documents),
s AS (SELECT COUNT(*) AS n, AVG(len(w)) AS a FROM t), c AS (SELECT doc_id, len(w) AS l, unnest(w) AS term FROM t),
p AS (SELECT doc_id, term, l, COUNT(*)*1.0::DOUBLE AS tf FROM c GROUP BY 1,2,3), f AS (SELECT term, COUNT(*) AS df FROM p GROUP BY 1),
k AS (SELECT q.doc_id AS query_id, p.doc_id, SUM(ln(1+(n-df+0.5)/(df+0.5))*p.tf*2.2/(p.tf+1.2*(0.25+0.75*p.l/a))) AS score FROM p q JOIN p USING (term) JOIN f USING (term), s WHERE q.doc_id%100=0 GROUP BY 1,2)"""
_VECTOR_EACH_SQL = (
    "v AS (SELECT q.vec_id AS query_id, e.vec_id AS doc_id, " + _DOT.format(a="e.embedding", b="q.embedding") + "/sqrt(" + _DOT.format(a="e.embedding", b="e.embedding") + "*"
    + _DOT.format(a="q.embedding", b="q.embedding") + ") AS score FROM embeddings q, embeddings e WHERE q.vec_id%100=0)"
)
_RANK_EACH = "ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY ROUND(score,9) DESC, doc_id) AS r"


@query(f"WITH {_BM25_EACH_SQL} SELECT query_id, doc_id, ROUND(score,6) AS score FROM (SELECT *, {_RANK_EACH} FROM k) WHERE r<=20")
def bm25_top_each(spark, d):
    """The 20 best documents for the words of every hundredth one."""
    return _words_each(spark, d, 20).select("query_id", "doc_id", F.round("score", 6).alias("score"))


@query(f"WITH {_VECTOR_EACH_SQL} SELECT query_id, doc_id AS vec_id, ROUND(score,5) AS score FROM (SELECT *, {_RANK_EACH} FROM v) WHERE r<=20")
def vector_top_each(spark, d):
    """The 20 nearest vectors to every hundredth one."""
    return _near_each(spark, d, 20).select("query_id", "vec_id", F.round("score", 5).alias("score"))


@query(f"""WITH {_BM25_EACH_SQL}, {_VECTOR_EACH_SQL}, a AS (SELECT query_id, doc_id, {_RANK_EACH} FROM k), b AS (SELECT query_id, doc_id, {_RANK_EACH} FROM v),
 u AS (SELECT query_id, doc_id, 1.0/(60+r) AS s FROM a WHERE r<=50 UNION ALL SELECT query_id, doc_id, 0.7/(60+r) FROM b WHERE r<=50) SELECT query_id, doc_id, ROUND(SUM(s),8) AS score FROM u GROUP BY 1,2""")
def hybrid_retrieval_each(spark, d):
    """Keyword and vector top lists of every hundredth id fused by reciprocal ranks with weights 1.0 and 0.7."""
    near = _near_each(spark, d, 50).withColumnRenamed("vec_id", "doc_id")
    return retrieval.fuse([(_words_each(spark, d, 50), 1.0), (near, 0.7)], "query_id", "doc_id").select("query_id", "doc_id", F.round("score", 8).alias("score"))


def _words_each(spark, d, n):
    return retrieval.bm25_each(table(spark, d, "documents"), "doc_id", "text", _ASKED.format("doc_id"), n)


def _near_each(spark, d, n):
    return retrieval.nearest_each(table(spark, d, "embeddings"), "vec_id", "embedding", _ASKED.format("vec_id"), n)


# ---------------------------------------------------- profiles, aliases, clusters


@query("""SELECT 'orders' AS name, COUNT(*) AS n_rows, 6::BIGINT AS n_columns, CAST(MIN(o_orderdate) AS DATE) AS first_date, CAST(MAX(o_orderdate) AS DATE) AS last_date FROM orders
 UNION ALL SELECT 'lineitem', COUNT(*), 11, CAST(MIN(l_shipdate) AS DATE), CAST(MAX(l_shipdate) AS DATE) FROM lineitem UNION ALL SELECT 'events', COUNT(*), 6, CAST(MIN(ts) AS DATE), CAST(MAX(ts) AS DATE) FROM events""")
def table_profiles(spark, d):
    """Rows, columns and date range of tables: column-pruned scans."""
    out = None
    for name, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")):
        p = files.profile(table(spark, d, name), c).select(F.lit(name).alias("name"), "n_rows", "n_columns", "first_date", "last_date")
        out = p if out is None else out.unionByName(p)
    return out


@query("""WITH k AS (SELECT DISTINCT trim(regexp_replace(regexp_replace(regexp_replace(lower(subject_name),'[^a-z0-9 ]',' ','g'),'\\b(the|inc|llc|lp|ltd|limited|corp|corporation|company|co|plc|gmbh|sa|bv)\\b',' ','g'),'\\s+',' ','g')) AS key, subject_name AS n FROM wide_allocation_observation WHERE subject_name IS NOT NULL)
 SELECT key, COUNT(*) AS spellings, MIN(n) AS first_spelling FROM k GROUP BY 1 HAVING COUNT(*)>1""")
def match_key_clusters(spark, d):
    """Spellings that share a key without punctuation and legal words."""
    k = table(spark, d, "wide_allocation_observation").filter("subject_name is not null").select(F.col("subject_name").alias("n")).distinct()
    return k.groupBy(labels.firm_key(F.col("n")).alias("key")).agg(F.count(F.lit(1)).alias("spellings"), F.min("n").alias("first_spelling")).filter("spellings > 1")


@query("""WITH p AS (SELECT * FROM fund_position), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY position_id ORDER BY report_date, source_document_id) AS rn FROM p) SELECT owner_id, COUNT(*) AS positions, COUNT(*) FILTER (quantity_raw IS NOT NULL) AS with_quantity, COUNT(DISTINCT instrument_id) AS instruments FROM r WHERE rn=1 GROUP BY 1""")
def deduplicated_positions(spark, d):
    p = table(spark, d, "fund_position").select("position_id", "owner_id", "instrument_id", "quantity_raw", "report_date", "source_document_id")
    one = relational.latest_per_key(p, ["position_id"], [F.col("report_date").asc_nulls_last(), F.col("source_document_id").asc_nulls_last()])
    return one.groupBy("owner_id").agg(F.count(F.lit(1)).alias("positions"), F.count("quantity_raw").alias("with_quantity"), F.countDistinct("instrument_id").alias("instruments"))


@query("""SELECT a.check_name, a.violations FROM (SELECT 'position_without_instrument' AS check_name, COUNT(*) AS violations FROM fund_position WHERE instrument_id IS NOT NULL AND instrument_id NOT IN (SELECT instrument_id FROM investment_instrument WHERE instrument_id IS NOT NULL)
 UNION ALL SELECT 'instrument_without_target', COUNT(*) FROM investment_instrument WHERE target_id IS NOT NULL AND target_id NOT IN (SELECT target_id FROM investment_target WHERE target_id IS NOT NULL)
 UNION ALL SELECT 'repeated_position', COUNT(*) FROM (SELECT position_id FROM fund_position GROUP BY 1 HAVING COUNT(*)>1)
 UNION ALL SELECT 'edge_parent_unknown', COUNT(*) FROM (SELECT DISTINCT parent_position_id FROM lookthrough_edge WHERE parent_position_id NOT IN (SELECT position_id FROM fund_position))) a""")
def integrity_violations(spark, d):
    """Violations-only checks of keys across the holdings tables."""
    pos, ins, tgt, edge = (table(spark, d, t) for t in ("fund_position", "investment_instrument", "investment_target", "lookthrough_edge"))
    checks = {
        "position_without_instrument": relational.missing_parents(pos.select("instrument_id"), "instrument_id", ins, "instrument_id"),
        "instrument_without_target": relational.missing_parents(ins.select("target_id"), "target_id", tgt, "target_id"),
        "repeated_position": relational.repeated_keys(pos.select("position_id"), ["position_id"]),
        "edge_parent_unknown": relational.missing_parents(edge.select("parent_position_id").distinct(), "parent_position_id", pos, "position_id"),
    }
    out = None
    for name, bad in checks.items():
        row = bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        out = row if out is None else out.unionByName(row)
    return out


@query("""SELECT window_start, event_type, COUNT(*) AS n, ROUND(SUM(value),4) AS total FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, value FROM events) GROUP BY 1,2""")
def hourly_events(spark, d):
    """Tumbling one-hour counts, the batch twin of the stream."""
    return windows.hourly(table(spark, d, "events")).select(F.col("window.start").alias("window_start"), "event_type", "n", r4("total").alias("total"))
