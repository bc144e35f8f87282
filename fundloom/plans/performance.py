"""Queries of performance, forecasts, weights and scores, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundloom.functions import finance, printed_values
from fundloom.operators import forecast, market, performance, relational, scoring, weights
from fundloom.operators.order_statistics import quantiles
from fundloom.plans.reference import BENCH_SQL, FLOWS_SQL, benchmark, flows, query, r4
from fundloom.sources.tables import table


def r6(c):
    return F.round(c, 6)


def _periods(spark, d):
    """(position, as_of, nav): one period per position, at its last flow."""
    held = table(spark, d, "customer").select(F.col("c_custkey").alias("position"), F.greatest("c_acctbal", F.lit(0.0)).alias("nav"))
    return flows(spark, d).groupBy("position").agg(F.max("d").alias("as_of")).join(held, "position")


@query(f"""WITH {FLOWS_SQL}, p AS (SELECT position, SUM(CASE WHEN amount<0 THEN -amount ELSE 0 END) AS put, SUM(CASE WHEN amount>0 THEN amount ELSE 0 END) AS got FROM flows GROUP BY 1),
 m AS (SELECT position, got/put AS dpi, GREATEST(c_acctbal,0)/put AS rvpi, (got+GREATEST(c_acctbal,0))/put AS tvpi FROM p JOIN customer ON c_custkey=position WHERE put>0 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey=position AND o_totalprice<2000))
 SELECT position, 'dpi' AS metric, ROUND(dpi,6) AS value FROM m UNION ALL SELECT position, 'rvpi', ROUND(rvpi,6) FROM m UNION ALL SELECT position, 'tvpi', ROUND(tvpi,6) FROM m""")
def fund_metrics(spark, d):
    """DPI, RVPI and TVPI of the positions that pass the quality gate, a row per metric."""
    put, got = F.sum(F.when(F.col("amount") < 0, -F.col("amount")).otherwise(0.0)), F.sum(F.when(F.col("amount") > 0, F.col("amount")).otherwise(0.0))
    failing = table(spark, d, "orders").filter("o_totalprice < 2000").select(F.col("o_custkey").alias("position"))
    rows = flows(spark, d).groupBy("position").agg(put.alias("put"), got.alias("got")).join(_periods(spark, d).select("position", "nav"), "position").join(failing, "position", "left_anti")
    values = performance.multiples(F.col("put"), F.col("got"), F.col("nav"))
    each = F.array(*[F.struct(F.lit(n).alias("metric"), r6(v).alias("value")) for n, v in values.items()])
    return rows.select("position", F.explode(each).alias("m")).select("position", "m.metric", "m.value").filter("value is not null")


@query(f"""WITH {FLOWS_SQL}, {BENCH_SQL}, g AS (SELECT list_sort(list(gap)) AS g FROM (SELECT date_diff('day', LAG(d) OVER (ORDER BY d), d) AS gap FROM monthly) WHERE gap IS NOT NULL), e AS (SELECT MAX(d) AS last FROM monthly),
 per AS (SELECT position, MAX(d) AS as_of FROM flows GROUP BY 1), fin AS (SELECT per.position, as_of, m.level AS final FROM per ASOF LEFT JOIN monthly m ON per.as_of>=m.d),
 lv AS (SELECT f.position, f.amount, m.level FROM flows f ASOF LEFT JOIN monthly m ON f.d>=m.d),
 s AS (SELECT position, SUM(CASE WHEN amount<0 THEN -amount/level END) AS put, SUM(CASE WHEN amount>0 THEN amount/level END) AS got, MAX(CASE WHEN level IS NULL THEN 1 ELSE 0 END) AS early FROM lv GROUP BY 1),
 o AS (SELECT position, as_of, CASE WHEN final IS NULL OR date_diff('day', last, as_of) > GREATEST(7, g[len(g)//2+1]) THEN 'series ends' WHEN early=1 THEN 'series starts late' WHEN COALESCE(put,0)<=0 THEN 'no contribution' ELSE 'ok' END AS status,
  (COALESCE(got,0)+GREATEST(c_acctbal,0)/final)/put AS pme FROM fin JOIN s USING (position) JOIN customer ON c_custkey=position, g, e)
 SELECT position, as_of, status, CASE WHEN status='ok' THEN ROUND(pme,6) END AS ks_pme FROM o""")
def pme_metrics(spark, d):
    """Public market equivalent with the NAV, refused where the benchmark does not cover the flows or the period."""
    return performance.market_equivalent(flows(spark, d), _periods(spark, d), benchmark(spark, d)).select("position", "as_of", "status", r6(F.col("ks_pme")).alias("ks_pme"))


@query()
def direct_alpha(spark, d):
    """The rate at which flows carried at the benchmark, and the NAV, are worth nothing; iterative, so without a twin."""
    carried = performance.market_equivalent(flows(spark, d), _periods(spark, d), benchmark(spark, d)).filter("status = 'ok'")
    found = finance.with_xirr(carried, "flows", "alpha")
    return found.select("position", "as_of", F.round("alpha", 8).alias("direct_alpha"), F.round(F.log1p("alpha"), 8).alias("continuous_alpha"))


_CHOICE = {"BUILDING": "BM_F", "MACHINERY": "BM_O", "AUTOMOBILE": "BM_NONE", "HOUSEHOLD": "BM_P"}


@query("""WITH f AS (SELECT c_custkey AS position, CASE WHEN c_nationkey%7=0 THEN ' ' ELSE c_mktsegment END AS strategy, MIN(CAST(o_orderdate AS DATE)) AS first_flow FROM customer JOIN orders ON o_custkey=c_custkey GROUP BY 1,2),
 s AS (SELECT 'BM_'||o_orderstatus AS benchmark, CAST(MIN(o_orderdate) AS DATE) + CASE o_orderstatus WHEN 'O' THEN 300 ELSE 0 END AS start FROM orders GROUP BY o_orderstatus),
 j AS (SELECT f.*, s.start, s.benchmark AS b FROM f LEFT JOIN s ON s.benchmark = CASE strategy WHEN 'BUILDING' THEN 'BM_F' WHEN 'MACHINERY' THEN 'BM_O' WHEN 'AUTOMOBILE' THEN 'BM_NONE' WHEN 'HOUSEHOLD' THEN 'BM_P' END),
 r AS (SELECT *, CASE WHEN trim(strategy)='' THEN 'no_strategy' WHEN start IS NULL THEN 'series_absent' WHEN start>first_flow THEN 'series_starts_after_first_flow' ELSE 'mapped' END AS reason FROM j)
 SELECT position, reason, CASE WHEN reason='mapped' THEN b ELSE 'BM_DEFAULT' END AS benchmark FROM r""")
def benchmark_choice(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("position"), F.when(F.col("c_nationkey") % 7 == 0, " ").otherwise(F.col("c_mktsegment")).alias("strategy"))
    first = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("position")).agg(F.min(F.col("o_orderdate").cast("date")).alias("first_flow"))
    starts = table(spark, d, "orders").groupBy("o_orderstatus").agg(F.min(F.col("o_orderdate").cast("date")).alias("s")).select(
        F.concat(F.lit("BM_"), "o_orderstatus").alias("benchmark"), F.when(F.col("o_orderstatus") == "O", F.date_add("s", 300)).otherwise(F.col("s")).alias("start"))
    return performance.benchmark_choice(c.join(first, "position"), starts, _CHOICE, "BM_DEFAULT").select("position", "reason", "benchmark")


# ------------------------------------------------------------------ forecasts


_SCENARIOS = [forecast.Scenario("base", 0.08), forecast.Scenario("low", -0.05, 0.85, 1, 0.7)]
_FORECAST_SQL = """sc(name,g,o,dl,dm) AS (VALUES ('base',0.08::DOUBLE,1.0::DOUBLE,0,1.0::DOUBLE),('low',-0.05,0.85,1,0.7)),
 f AS (SELECT s_suppkey, s_nationkey, name AS scenario, g, dl, dm, 0 AS quarter, DATE '2002-01-31' AS step_date, GREATEST(s_acctbal,0)*10*o AS nav, ABS(s_acctbal)/2 AS unfunded, ABS(s_acctbal)/2*0.8::DOUBLE AS draw, 0.0::DOUBLE AS call, 0.0::DOUBLE AS distribution FROM supplier, sc
 UNION ALL SELECT s_suppkey, s_nationkey, scenario, g, dl, dm, q1, nd, grown-paid, unfunded-c, draw-c, c, paid FROM (
  SELECT *, CASE WHEN q1>=2+dl AND grown>1e-12 THEN CASE WHEN q1=8 THEN grown ELSE grown*LEAST(1.0,0.15*dm) END WHEN q1=8 THEN grown ELSE 0 END AS paid FROM (
   SELECT *, nav+nav*(POW(1+g, date_diff('day', step_date, nd)/365.0)-1)+c*0.9 AS grown FROM (
    SELECT *, quarter+1 AS q1, CAST(DATE '2002-01-31' + to_months(3*(quarter+1)) AS DATE) AS nd, CASE WHEN quarter+1<=3 AND draw>1e-12 THEN draw/(3-quarter) ELSE 0 END AS c FROM f WHERE quarter<8))))"""


def _positions(spark, d):
    return table(spark, d, "supplier").select(
        "s_suppkey", "s_nationkey", F.lit("2002-01-31").cast("date").alias("closing"), (F.greatest("s_acctbal", F.lit(0.0)) * 10).alias("nav"), (F.abs("s_acctbal") / 2).alias("unfunded"),
        (F.greatest("s_acctbal", F.lit(0.0)) * 9).alias("ask"), F.lit(100.0).alias("cost"),
    )


@query(f"""WITH RECURSIVE {_FORECAST_SQL} SELECT s_suppkey, scenario, quarter, step_date, ROUND(call,4) AS call, ROUND(distribution,4) AS distribution, ROUND(nav,4) AS nav, ROUND(unfunded,4) AS unfunded FROM f WHERE quarter>0""")
def nav_forecast(spark, d):
    """Quarterly recurrence of NAV and unfunded commitment under two scenarios, folded in the JVM."""
    steps = forecast.forecast(_positions(spark, d), "s_suppkey", "closing", "nav", "unfunded", _SCENARIOS)
    return steps.select("s_suppkey", "scenario", "quarter", "step_date", r4("call").alias("call"), r4("distribution").alias("distribution"), r4("nav").alias("nav"), r4("unfunded").alias("unfunded"))


_PRICE_SQL = """p AS (SELECT s_suppkey, s_nationkey, scenario, SUM((distribution-call)/POW(1.12, date_diff('day', DATE '2002-01-31', step_date)/365.0)) AS pv, SUM(call) AS calls, SUM(distribution) AS got FROM f WHERE quarter>0 GROUP BY 1,2,3),
 z AS (SELECT p.*, GREATEST(s_acctbal,0)*10 AS n, GREATEST(s_acctbal,0)*9 AS ask, pv-100 AS ceiling FROM p JOIN supplier USING (s_suppkey))"""


@query(f"""WITH RECURSIVE {_FORECAST_SQL}, {_PRICE_SQL} SELECT s_suppkey, scenario, ROUND(pv,4) AS present_value, ROUND(ceiling,4) AS ceiling, ROUND(ceiling/NULLIF(n,0),6) AS ceiling_part, ROUND(pv-ask-100,4) AS ask_value,
 ROUND(got/(ask+100+calls),6) AS multiple, CASE WHEN ceiling<=0 THEN 'negative ceiling' WHEN ask<=ceiling THEN 'meets hurdle' ELSE 'exceeds ceiling' END AS status FROM z""")
def position_pricing(spark, d):
    """Price ceilings at a hurdle rate of 12 percent, per position and scenario."""
    p = forecast.priced(_positions(spark, d), "s_suppkey", "closing", "nav", "unfunded", "ask", _SCENARIOS, 0.12, "cost")
    return p.select("s_suppkey", "scenario", *[r4(c).alias(c) for c in ("present_value", "ceiling")], r6("ceiling_part").alias("ceiling_part"), r4("ask_value").alias("ask_value"), r6("multiple").alias("multiple"), "status")


@query(f"""WITH RECURSIVE {_FORECAST_SQL}, {_PRICE_SQL} SELECT s_nationkey, scenario, COUNT(*) AS positions, ROUND(SUM(pv),2) AS present_value, ROUND(SUM(ceiling),2) AS ceiling, COUNT(*) FILTER (ceiling>0 AND ask<=ceiling) AS pursuable FROM z GROUP BY 1,2""")
def portfolio_pricing(spark, d):
    pos = _positions(spark, d)
    p = forecast.priced(pos, "s_suppkey", "closing", "nav", "unfunded", "ask", _SCENARIOS, 0.12, "cost").join(pos.select("s_suppkey", "s_nationkey"), "s_suppkey")
    return p.groupBy("s_nationkey", "scenario").agg(F.count(F.lit(1)).alias("positions"), F.round(F.sum("present_value"), 2).alias("present_value"), F.round(F.sum("ceiling"), 2).alias("ceiling"), F.count_if(F.col("status") == "meets hurdle").alias("pursuable"))


# -------------------------------------------------------------------- weights


@query()
def portfolio_allocation(spark, d):
    """Bounded equal weights of the suppliers of each nation, bounds by their balance; tested by properties."""
    s = table(spark, d, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal")
    sizes = s.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    share = (1 / F.col("n")).cast("decimal(12,10)")
    rows = s.join(sizes, "s_nationkey").select(
        "s_nationkey", "s_suppkey", F.when(F.col("s_acctbal") > 8000, (share * 1).cast("decimal(12,10)")).otherwise(F.lit(0).cast("decimal(12,10)")).alias("low"),
        F.when(F.col("s_acctbal") < 0, (share / 2).cast("decimal(12,10)")).otherwise(F.lit(1).cast("decimal(12,10)")).alias("high"))
    rows = rows.withColumn("high", F.when(F.col("s_suppkey").isNotNull() & (F.col("high") < F.col("low")), F.col("low")).otherwise(F.col("high")))
    able = rows.groupBy("s_nationkey").agg(F.sum("low").alias("a"), F.sum("high").alias("b")).filter("a <= 1 and b >= 1").select("s_nationkey")
    return weights.allocate(rows.join(able, "s_nationkey", "left_semi"), "s_nationkey", "s_suppkey", "low", "high")


# --------------------------------------------------------------------- scores


@query("""WITH s AS (SELECT s_nationkey, CASE WHEN s_acctbal>=0 THEN s_acctbal/100 END AS score FROM supplier) SELECT s_nationkey, COUNT(*) AS funds, COUNT(score) AS scored, ROUND(COUNT(score)*1.0/COUNT(*),6) AS coverage, ROUND(AVG(score),6) AS mean, MIN(score) AS worst, MAX(score) AS best,
 COUNT(score)>=2 AND COUNT(score)*1.0/COUNT(*)>=0.75 AS eligible FROM s GROUP BY 1""")
def manager_rollup(spark, d):
    s = table(spark, d, "supplier").select("s_nationkey", F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal") / 100).alias("score"))
    return scoring.roll_up(s, "s_nationkey", "score").withColumns({"coverage": r6("coverage"), "mean": r6("mean")})


@query("""WITH s AS (SELECT c_nationkey, (c_acctbal+1000)/110 AS score FROM customer) SELECT c_nationkey, ROUND(AVG(CASE WHEN score>50 THEN 1.0 ELSE 0 END),6) AS above_50, ROUND(AVG(CASE WHEN score>=75 THEN 1.0 ELSE 0 END),6) AS top_quarter,
 ROUND(AVG(CASE WHEN score<=25 THEN 1.0 ELSE 0 END),6) AS bottom_quarter, ROUND(quantile_cont(score,0.75)-quantile_cont(score,0.25),6) AS iqr, ROUND(MIN(score),6) AS worst FROM s GROUP BY 1""")
def manager_consistency(spark, d):
    s = table(spark, d, "customer").select("c_nationkey", ((F.col("c_acctbal") + 1000) / 110).alias("score"))
    c = scoring.consistency(s, "c_nationkey", "score")
    return c.select("c_nationkey", *[r6(x).alias(x) for x in ("above_50", "top_quarter", "bottom_quarter", "iqr", "worst")])


@query("""WITH x AS (SELECT c_custkey, c_mktsegment, c_nationkey, c_acctbal, FLOOR(year(MIN(o_orderdate))/3)*3 AS vintage FROM customer JOIN orders ON o_custkey=c_custkey GROUP BY 1,2,3,4),
 y AS (SELECT x.c_custkey, COUNT(p.c_custkey) AS peers, COUNT(*) FILTER (p.c_acctbal<x.c_acctbal) AS below, COUNT(*) FILTER (p.c_acctbal=x.c_acctbal) AS equal FROM x LEFT JOIN x p ON p.c_mktsegment=x.c_mktsegment AND p.vintage=x.vintage AND p.c_nationkey<>x.c_nationkey GROUP BY 1)
 SELECT c_custkey, peers, CASE WHEN peers>0 THEN ROUND(100.0*(below+0.5*equal)/peers,4) END AS percentile FROM y""")
def age_peer_percentile(spark, d):
    """Percentile among peers of the same strategy and age bucket, own manager apart."""
    age = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg((F.floor(F.year(F.min("o_orderdate")) / 3) * 3).alias("vintage"))
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal").join(age, "c_custkey")
    return relational.midpoint_percentile(c, ["c_mktsegment", "vintage"], "c_nationkey", "c_acctbal").select("c_custkey", "peers", r4("percentile").alias("percentile"))


@query("""WITH q AS (SELECT c_mktsegment, quantile_cont(c_acctbal,1/3.0) AS a, quantile_cont(c_acctbal,2/3.0) AS b FROM customer GROUP BY 1), x AS (SELECT c_custkey, c.c_mktsegment, c_nationkey, CASE WHEN c_acctbal<=a THEN 1 WHEN c_acctbal<=b THEN 2 ELSE 3 END AS band, c_custkey%1000 AS score FROM customer c JOIN q USING (c_mktsegment)),
 y AS (SELECT x.c_custkey, x.band, COUNT(p.c_custkey) AS peers, COUNT(*) FILTER (p.score<x.score) AS below, COUNT(*) FILTER (p.score=x.score) AS equal FROM x LEFT JOIN x p ON p.c_mktsegment=x.c_mktsegment AND p.band=x.band AND p.c_nationkey<>x.c_nationkey GROUP BY 1,2)
 SELECT c_custkey, band, peers, CASE WHEN peers>0 THEN ROUND(100.0*(below+0.5*equal)/peers,4) END AS percentile FROM y""")
def size_band_percentile(spark, d):
    """Percentile among peers of the same strategy and size band, own manager apart."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal", (F.col("c_custkey") % 1000).alias("score"))
    q = quantiles(c, ["c_mktsegment"], "c_acctbal", {"a": 1 / 3.0, "b": 2 / 3.0})
    band = F.when(F.col("c_acctbal") <= F.col("a"), 1).when(F.col("c_acctbal") <= F.col("b"), 2).otherwise(3)
    x = c.join(q, "c_mktsegment").withColumn("band", band)
    return relational.midpoint_percentile(x, ["c_mktsegment", "band"], "c_nationkey", "score").select("c_custkey", "band", "peers", r4("percentile").alias("percentile"))


@query("""WITH h AS (SELECT l_suppkey, p_type, p_brand, SUM(l_extendedprice) AS v FROM lineitem JOIN part ON p_partkey=l_partkey GROUP BY 1,2,3), c AS (SELECT l_suppkey, p_brand, SUM(v) AS v FROM h GROUP BY 1,2), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY v DESC, p_brand) AS n FROM c),
 w AS (SELECT l_suppkey, SUM(v) AS value, SUM(CASE WHEN n<=3 THEN v ELSE 0 END) AS big FROM r GROUP BY 1), s AS (SELECT l_suppkey, MAX(v) AS sv FROM (SELECT l_suppkey, p_type, SUM(v) AS v FROM h GROUP BY 1,2) GROUP BY 1)
 SELECT l_suppkey, ROUND(value,2) AS value, ROUND(value-0.4*big,2) AS after_companies, ROUND(value-0.2*sv,2) AS after_sector FROM w JOIN s USING (l_suppkey)""")
def nav_shock(spark, d):
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    lines = table(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_extendedprice").alias("v")).join(parts, "l_partkey")
    s = scoring.value_shock(lines, "l_suppkey", "p_brand", "p_type", "v", company_loss=0.4, sector_loss=0.2)
    return s.select("l_suppkey", *[F.round(c, 2).alias(c) for c in ("value", "after_companies", "after_sector")])


@query()
def market_model(spark, d):
    """Ridge regression of line prices against the median of their part type, on two hold-outs; tested against numpy."""
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_size", "p_retailprice")
    rows = table(spark, d, "lineitem").join(parts, "l_partkey").withColumn("split", F.when(F.col("l_shipdate") > "2000-12-31", "later").when(F.col("l_suppkey") % 5 == 0, "other_managers").otherwise("train"))
    features = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
    train = rows.filter("split = 'train'")
    scales, coefficients = market.fit(train, features, "l_extendedprice", 1.0)
    base = quantiles(train, ["p_type"], "l_extendedprice", {"baseline": 0.5}).select("p_type", "baseline")
    held = market.predicted(rows.filter("split != 'train'"), scales, coefficients, low=0.0).join(base, "p_type")
    out = market.judged(held, "split", "l_extendedprice", "prediction", "baseline", "l_quantity")
    return out.select("split", "n", *[r4(c).alias(c) for c in ("model_mae", "baseline_mae", "model_weighted_mae", "baseline_weighted_mae", "model_bias")], "model_wins")


# ------------------------------------------------------------- printed values


@query("""WITH t AS (SELECT o_orderkey, o_totalprice AS v, format('{:,.2f}', o_totalprice) AS p FROM orders) SELECT o_orderkey,
 CASE o_orderkey%6 WHEN 0 THEN 'money' WHEN 1 THEN 'number' WHEN 2 THEN 'percent' WHEN 3 THEN 'multiple' WHEN 4 THEN 'text' ELSE 'money' END AS kind,
 CASE WHEN o_orderkey%6=4 THEN NULL WHEN o_orderkey%6 IN (1,5) THEN -CAST(v AS DECIMAL(18,2)) ELSE CAST(v AS DECIMAL(18,2)) END AS number,
 CASE WHEN o_orderkey%6=4 THEN '' WHEN o_orderkey%6 IN (1,5) THEN 'negative' ELSE 'positive' END AS sign, CASE o_orderkey%6 WHEN 0 THEN 'EUR' WHEN 5 THEN 'CAD' ELSE '' END AS currency,
 CASE WHEN o_orderkey%6<>4 THEN 5.0 END AS half FROM t""")
def value_tuples(spark, d):
    """Prints read back as kind, number, sign and currency, with half of their last digit in thousands."""
    p, k = F.format_number("o_totalprice", 2), F.col("o_orderkey") % 6
    text = (
        F.when(k == 0, F.concat(F.lit("€ "), p)).when(k == 1, F.concat(F.lit("("), p, F.lit(")"))).when(k == 2, F.concat(p, F.lit("%"))).when(k == 3, F.concat(p, F.lit("x")))
        .when(k == 4, "not disclosed").otherwise(F.concat(F.lit("−C$"), p))
    )
    v = table(spark, d, "orders").select("o_orderkey", text.alias("t")).select("o_orderkey", printed_values.value_parts(F.col("t")).alias("v"), printed_values.half_unit(F.col("t"), 1000.0).alias("half"))
    return v.select("o_orderkey", "v.kind", F.col("v.number").cast("decimal(18,2)").alias("number"), "v.sign", "v.currency", "half")


@query("""SELECT o_orderkey, CASE o_orderkey%6 WHEN 3 THEN last_day(CAST(o_orderdate AS DATE)) WHEN 4 THEN make_date(year(o_orderdate),12,31) WHEN 5 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date,
 CASE o_orderkey%6 WHEN 3 THEN 'month' WHEN 4 THEN 'year' WHEN 5 THEN 'unknown' ELSE 'day' END AS precision FROM orders""")
def date_tuples(spark, d):
    """Printed dates read back with the precision that the print supports."""
    day, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 6
    text = (
        F.when(k == 0, F.date_format(day, "dd/MM/yyyy")).when(k == 1, F.date_format(day, "MMMM d, yyyy")).when(k == 2, F.date_format(day, "d MMM yyyy")).when(k == 3, F.date_format(day, "MMMM yyyy"))
        .when(k == 4, F.concat(F.lit("FY"), F.date_format(day, "yyyy"))).otherwise("at closing")
    )
    v = table(spark, d, "orders").select("o_orderkey", printed_values.dated(text, F.lit("DMY")).alias("v"))
    return v.select("o_orderkey", "v.date", "v.precision")


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS v, l_quantity AS q, ROUND(l_extendedprice/l_quantity,1) AS printed FROM lineitem)
 SELECT l_orderkey, l_linenumber, ABS(v/q-printed) <= 0.05+(0.005/q+ABS(printed)*0.05/q)+1e-9 AS within FROM x""")
def rounding_checks(spark, d):
    """Whether a recomputed quotient lies within the slack that its printed parts leave."""
    v, q = F.col("l_extendedprice"), F.col("l_quantity")
    printed = F.round(v / q, 1)
    half = lambda c, digits: printed_values.half_unit(F.format_string(f"%.{digits}f", c))
    slack = printed_values.quotient_slack(half(printed, 1), [half(v, 2)], q, half(q, 1), printed)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.abs(v / q - printed) <= slack + 1e-9).alias("within"))
