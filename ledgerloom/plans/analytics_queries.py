"""Aggregating queries over the trade tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import aggregates as A
from ledgerloom.operators import windows as WN
from ledgerloom.session import table

DEC = "decimal(18,2)"
WIDE = "decimal(38,2)"

#: The nation-years that most of these queries start from, in SQL.
NY = """ny AS (
  SELECT n_name, CAST(year(o_orderdate) AS BIGINT) AS year, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue,
         COUNT(DISTINCT o_custkey) AS customers, COUNT(*) AS orders
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""


def order_rows(spark: SparkSession, d: str) -> DataFrame:
    """orders with their nation and region keys; dimensions are read, the optimiser picks the joins."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", F.col("o_totalprice").cast(DEC).alias("price"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).withColumn("year", F.year("o_orderdate").cast("long"))


def nation_years(spark: SparkSession, d: str) -> DataFrame:
    """n_name, year, revenue, customers, orders."""
    return order_rows(spark, d).groupBy("n_name", "year").agg(F.sum("price").cast(WIDE).alias("revenue"), F.count_distinct("o_custkey").alias("customers"), F.count(F.lit(1)).alias("orders"))


def _per_customer(c="revenue"):
    return F.round(F.col(c).cast("double") / F.col("customers"), 4)


def nation_year_plan(spark, d):
    """Revenue, cohort rank and change against the previous year with enough orders, per nation-year."""
    rows = nation_years(spark, d).withColumn("per_customer", _per_customer())
    ranked = WN.rank_cohort(rows, ["year"], "per_customer", F.col("orders") >= 50)
    told = WN.previous_eligible(ranked, ["n_name"], "year", "revenue", F.col("orders") >= 50)
    change = F.round(100 * (F.col("revenue").cast("double") / F.col("previous").cast("double") - 1), 4)
    reason = F.when(F.col("orders") < 50, "few_orders")
    return told.select("n_name", "year", "revenue", "customers", "orders", "per_customer", reason.alias("reason"), "rank", "cohort", F.when(reason.isNull(), change).alias("change"))


def rank_cohort(spark, d):
    rows = nation_years(spark, d).withColumn("per_customer", _per_customer())
    return WN.rank_cohort(rows, ["year"], "per_customer", F.col("customers") >= 50).select("n_name", "year", "per_customer", "rank", "cohort")


def exclusion_reason(spark, d):
    """First rule that excludes an order from comparison; one pass of ordered rules."""
    o = order_rows(spark, d).select("o_orderkey", "o_orderstatus", "price")
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum(F.col("l_extendedprice").cast(DEC)).alias("listed"))
    j = o.join(lines, o.o_orderkey == lines.k, "left")
    reason = F.when(F.col("listed").isNull(), "no_lines").when(F.col("o_orderstatus") == "P", "partial").when(F.abs(F.col("listed") - F.col("price")) > F.col("price") * F.lit("0.05").cast("decimal(4,2)"), "unequal")
    return j.select("o_orderkey", reason.alias("reason"))


def yoy_prev_eligible(spark, d):
    """Nominal change against the previous eligible year; real change only if that is the year before."""
    rows = WN.previous_eligible(nation_years(spark, d), ["n_name"], "year", "revenue", F.col("orders") >= 50)
    deflator = spark.createDataFrame([(y, 1.0 + 0.01 * (y - 1994)) for y in range(1995, 2002)], "year long, inflation double")
    r = rows.join(F.broadcast(deflator), "year", "left")
    ok = (F.col("orders") >= 50) & (F.col("previous") != 0)
    nominal = F.col("revenue").cast("double") / F.col("previous").cast("double")
    return r.select("n_name", "year", F.col("previous_year"), F.when(ok, F.round(100 * (nominal - 1), 4)).alias("nominal"), F.when(ok & (F.col("previous_year") == F.col("year") - 1), F.round(100 * (nominal / F.col("inflation") - 1), 4)).alias("real"))


def evolution_last_nonnull(spark, d):
    rows = nation_years(spark, d).withColumn("held", F.when(F.col("orders") >= 60, F.col("revenue")))
    told = WN.carry_forward(rows, ["n_name"], ["year"], {"before": F.col("held")}, inclusive=False)
    return told.select("n_name", "year", "held", "before")


def coverage_by_year(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").cast("long").alias("year"), F.col("o_totalprice").cast(DEC).alias("price"))
    has = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")).distinct().withColumn("has", F.lit(True))
    j = o.join(has, o.o_orderkey == has.k, "left")
    return j.groupBy("year").agg(F.count(F.lit(1)).alias("orders"), F.count_if("has").alias("with_lines"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.count_if(F.col("price") > 100000).alias("large"), F.count_if(F.col("has").isNull()).alias("empty"))


def modal_period(spark, d):
    o = order_rows(spark, d).select("n_name", F.quarter("o_orderdate").cast("long").alias("quarter"), F.col("o_orderpriority").alias("priority"))
    return A.modal(o, ["n_name"], ["quarter", "priority"])


def period_filter_then_rank(spark, d):
    """Only quarters that are the most frequent of their year take part in the ranking of nations."""
    o = order_rows(spark, d).withColumn("quarter", F.quarter("o_orderdate").cast("long"))
    per = o.groupBy("year", "n_name", "quarter").agg(F.sum("price").cast(WIDE).alias("revenue"))
    common = A.modal(o, ["year"], ["quarter"]).select("year", F.col("quarter").alias("modal"))
    j = per.join(common, "year").withColumn("comparable", F.col("quarter") == F.col("modal"))
    return WN.rank_cohort(j, ["year"], "revenue", F.col("comparable")).select("year", "n_name", "quarter", "revenue", "comparable", "rank", "cohort")


def chapter_rollup(spark, d):
    """Sum of the revenue by the first digit of a brand; its name is the type of its lowest part of the round brand."""
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    lines = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_extendedprice").cast(DEC)).cast(WIDE).alias("revenue"))
    j = p.join(lines, p.p_partkey == lines.l_partkey)
    code = F.substring("p_brand", 1, 7)
    return A.rolled_up(j, [], code, "revenue", "p_type", "p_partkey", F.col("p_brand").endswith("1")).select("code", F.col("total").cast(WIDE).alias("total"), "name")


def part_revenue(spark, d):
    """n_name, brand, partkey, revenue: what customers of each nation ordered of each part."""
    o = order_rows(spark, d).select("o_orderkey", "n_name", "n_regionkey")
    l = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", F.col("l_extendedprice").cast(DEC).alias("v"))
    return l.join(o, l.l_orderkey == o.o_orderkey)


def max_per_code(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    sums = part_revenue(spark, d).groupBy("n_name", "l_partkey").agg(F.sum("v").cast(WIDE).alias("revenue"))
    j = sums.join(p, sums.l_partkey == p.p_partkey).select("n_name", F.col("p_brand").alias("brand"), "revenue", F.col("l_partkey").alias("partkey"))
    return A.best_of(j, ["n_name", "brand"], "revenue", ["partkey"]).select("n_name", "brand", F.col("revenue").cast(WIDE).alias("revenue"), "partkey")


def top10_per_group(spark, d):
    sums = part_revenue(spark, d).groupBy("n_regionkey", "l_partkey").agg(F.sum("v").cast(WIDE).alias("revenue"))
    return A.top_k(sums, ["n_regionkey"], "revenue", ["l_partkey"], 10).select("n_regionkey", F.col("l_partkey").alias("partkey"), "revenue", "place")


def top8_children(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    sums = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_extendedprice").cast(DEC)).cast(WIDE).alias("revenue")).where("revenue > 0")
    j = sums.join(p, sums.l_partkey == p.p_partkey)
    return A.top_k(j, ["p_brand"], "revenue", ["l_partkey"], 8).select(F.col("p_brand").alias("brand"), F.col("l_partkey").alias("partkey"), "revenue", "place")


def coverage_gate(spark, d):
    """Orders whose lines make up 90 to 110 percent of the order's price."""
    l = table(spark, d, "lineitem").select("l_orderkey", F.col("l_extendedprice").cast(DEC).alias("part"))
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast(DEC).alias("total"))
    return A.gated(l.join(o, l.l_orderkey == o.o_orderkey), ["o_orderkey"], "part", "total").select("o_orderkey", F.col("parts").cast(WIDE).alias("parts"), "total", F.round("share", 4).alias("share"))


def plausible_total(spark, d):
    l = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.max(F.col("l_extendedprice").cast(DEC)).alias("greatest"))
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast(DEC).alias("total"))
    j = o.join(l, o.o_orderkey == l.k, "left")
    return j.select("o_orderkey", A.plausible(F.col("total"), F.col("greatest")).alias("total"))


def unit_rescue(spark, d):
    """Every third nation's revenue is told a thousandfold; its witness, the customers' balances, tells it."""
    r = nation_years(spark, d).withColumn("told", F.when(F.length("n_name") % 3 == 0, F.col("revenue") * 1000).otherwise(F.col("revenue")).cast(WIDE))
    j = r.withColumn("witness", F.col("customers") * F.lit(100000))
    value = A.rescued(F.col("told").cast("double"), F.col("witness").cast("double"), F.col("told").cast("double"))
    return j.select("n_name", "year", F.round(value, 2).alias("value"))


def plan_share_band(spark, d):
    """Each quarter's share of the nation-year; one share outside 10 to 40 percent empties all of the group."""
    o = order_rows(spark, d).withColumn("quarter", F.quarter("o_orderdate").cast("long"))
    q = o.groupBy("n_name", "year", "quarter").agg(F.sum("price").cast(WIDE).alias("v"))
    y = nation_years(spark, d).select("n_name", "year", "revenue")
    j = q.join(y, ["n_name", "year"]).withColumn("share", F.round(100 * F.col("v").cast("double") / F.col("revenue").cast("double"), 4))
    return A.all_or_nothing(j, ["n_name", "year"], "share", 10, 40).select("n_name", "year", "quarter", "share", "incomplete")


def median_thresholds(spark, d):
    o = order_rows(spark, d)
    return o.groupBy("n_name").agg(F.round(F.median(F.col("price").cast("double")), 4).alias("median"), F.count_if(F.col("price") >= 150000).alias("high"), F.count_if(F.col("price") < 50000).alias("low"), F.count_distinct("o_custkey").alias("customers"))


def cost_rollup(spark, d):
    """Calls and cost by type and day, with day totals of each type and the grand total."""
    e = table(spark, d, "events").select(F.col("event_type").alias("kind"), F.to_date("ts").alias("day"), F.col("value").cast(DEC).alias("v"))
    r = e.rollup("kind", "day").agg(F.count(F.lit(1)).alias("calls"), F.sum("v").cast(WIDE).alias("cost"), (F.grouping("kind") * 2 + F.grouping("day")).cast("long").alias("level"))
    return r.select("kind", F.col("day").cast("string").alias("day"), "calls", "cost", "level")


def report_by_type(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("calls"), F.sum(F.col("value").cast(DEC)).cast(WIDE).alias("total"), F.count_distinct("user_id").alias("users"))


def quarter_cumulative(spark, d):
    """Value cumulated over the quarters of each year, and its step back."""
    o = order_rows(spark, d).withColumn("quarter", F.quarter("o_orderdate").cast("long"))
    q = o.groupBy("n_name", "year", "quarter").agg(F.sum("price").cast(WIDE).alias("v"))
    told = WN.running_until(q, ["n_name", "year"], ["quarter"], "v", 1e18).withColumn("running", F.col("running").cast(WIDE))
    return A.de_cumulated(told, ["n_name", "year"], "quarter", "running").select("n_name", "year", "quarter", "running", F.col("step").cast(WIDE).alias("step"))


def running_budget(spark, d):
    """Events of a user up to the first that lifts the running sum over 500."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts", F.col("value").cast(DEC).alias("v"))
    return WN.running_until(e, ["user_id"], ["ts", "event_id"], "v", 500.0).select("event_id", "user_id", F.col("running").cast(WIDE).alias("running"), "within")


def expected_quarter(spark, d):
    """Quarters due 55 days after their end, by the latest order, in which a nation has no order of a priority and status."""
    series = ["n_name", "o_orderpriority", "o_orderstatus"]
    o = order_rows(spark, d).select(*series, F.trunc("o_orderdate", "quarter").alias("q"), F.to_date("o_orderdate").alias("day"))
    span = o.agg(F.min("q").alias("lo"), F.max("day").alias("hi"))
    due = span.select(F.explode(F.sequence("lo", F.trunc("hi", "quarter"), F.expr("interval 3 months"))).alias("q"), "hi").where(F.date_add(F.add_months("q", 3), 54) <= F.col("hi")).select("q")
    listed = due.agg(F.collect_list("q").alias("qs"))  # one row per quarter of the calendar
    wanted = o.select(*series).distinct().join(F.broadcast(listed)).select(*series, F.explode("qs").alias("q"))
    return wanted.join(o.select(*series, "q").distinct(), [*series, "q"], "left_anti").select(*series, F.col("q").cast("string").alias("quarter"))


_OR = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
_P = "CAST(o_totalprice AS DECIMAL(18,2))"
_X = "CAST(l_extendedprice AS DECIMAL(18,2))"
SQL = {
    "nation_year_plan": f"""WITH {NY}, a AS (SELECT *, round(revenue::DOUBLE / customers, 4) AS per_customer, orders >= 50 AS ok FROM ny),
      r AS (SELECT n_name, year, rank() OVER (PARTITION BY year ORDER BY per_customer DESC) AS rank, count(*) OVER (PARTITION BY year) AS cohort,
                   lag(revenue) OVER (PARTITION BY n_name ORDER BY year) AS previous FROM a WHERE ok)
      SELECT a.n_name, a.year, CAST(revenue AS DECIMAL(38,2)) AS revenue, customers, orders, per_customer, CASE WHEN NOT ok THEN 'few_orders' END AS reason, r.rank, r.cohort,
             round(100 * (revenue::DOUBLE / previous::DOUBLE - 1), 4) AS change FROM a LEFT JOIN r USING (n_name, year)""",
    "rank_cohort": f"""WITH {NY}, a AS (SELECT *, round(revenue::DOUBLE / customers, 4) AS per_customer, customers >= 50 AS ok FROM ny),
      r AS (SELECT n_name, year, rank() OVER (PARTITION BY year ORDER BY per_customer DESC) AS rank, count(*) OVER (PARTITION BY year) AS cohort FROM a WHERE ok)
      SELECT a.n_name, a.year, per_customer, r.rank, r.cohort FROM a LEFT JOIN r USING (n_name, year)""",
    "exclusion_reason": f"""WITH l AS (SELECT l_orderkey, SUM({_X}) AS listed FROM lineitem GROUP BY 1)
      SELECT o_orderkey, CASE WHEN listed IS NULL THEN 'no_lines' WHEN o_orderstatus = 'P' THEN 'partial' WHEN abs(listed - {_P}) > {_P} * CAST(0.05 AS DECIMAL(4,2)) THEN 'unequal' END AS reason
      FROM {_OR} LEFT JOIN l ON l_orderkey = o_orderkey""",
    "yoy_prev_eligible": f"""WITH {NY}, e AS (SELECT n_name, year, lag(revenue) OVER w AS previous, lag(year) OVER w AS previous_year FROM ny WHERE orders >= 50 WINDOW w AS (PARTITION BY n_name ORDER BY year)),
      b AS (SELECT ny.*, (SELECT max_by(x.revenue, x.year) FROM ny x WHERE x.n_name = ny.n_name AND x.orders >= 50 AND x.year < ny.year) AS p,
                   (SELECT max(x.year) FROM ny x WHERE x.n_name = ny.n_name AND x.orders >= 50 AND x.year < ny.year) AS previous_year FROM ny)
      SELECT n_name, year, previous_year, CASE WHEN orders >= 50 AND p <> 0 THEN round(100 * (revenue::DOUBLE / p::DOUBLE - 1), 4) END AS nominal,
             CASE WHEN orders >= 50 AND p <> 0 AND previous_year = year - 1 THEN round(100 * (revenue::DOUBLE / p::DOUBLE / (1.0::DOUBLE + 0.01::DOUBLE * (year - 1994)) - 1), 4) END AS real FROM b""",
    "evolution_last_nonnull": f"""WITH {NY}, h AS (SELECT n_name, year, CASE WHEN orders >= 60 THEN CAST(revenue AS DECIMAL(38,2)) END AS held FROM ny)
      SELECT n_name, year, held, last_value(held IGNORE NULLS) OVER (PARTITION BY n_name ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM h""",
    "coverage_by_year": f"""SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS orders, count(*) FILTER (has) AS with_lines, count(*) FILTER (o_orderstatus = 'F') AS finished,
      count(*) FILTER ({_P} > 100000) AS large, count(*) FILTER (has IS NULL) AS empty FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, true AS has FROM lineitem) ON l_orderkey = o_orderkey GROUP BY 1""",
    "modal_period": f"""WITH c AS (SELECT n_name, CAST(quarter(o_orderdate) AS BIGINT) AS quarter, o_orderpriority AS priority, count(*) AS n FROM {_OR} GROUP BY 1, 2, 3)
      SELECT n_name, quarter, priority, n FROM (SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY n DESC, quarter DESC, priority DESC) AS k FROM c) WHERE k = 1""",
    "period_filter_then_rank": f"""WITH o AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS year, n_name, CAST(quarter(o_orderdate) AS BIGINT) AS quarter, {_P} AS p FROM {_OR}),
      m AS (SELECT year, quarter AS modal FROM (SELECT year, quarter, row_number() OVER (PARTITION BY year ORDER BY count(*) DESC, quarter DESC) AS k FROM o GROUP BY 1, 2) WHERE k = 1),
      g AS (SELECT year, n_name, quarter, CAST(SUM(p) AS DECIMAL(38,2)) AS revenue FROM o GROUP BY 1, 2, 3), j AS (SELECT g.*, quarter = modal AS comparable FROM g JOIN m USING (year)),
      r AS (SELECT year, n_name, quarter, rank() OVER (PARTITION BY year ORDER BY revenue DESC) AS rank, count(*) OVER (PARTITION BY year) AS cohort FROM j WHERE comparable)
      SELECT j.*, r.rank, r.cohort FROM j LEFT JOIN r USING (year, n_name, quarter)""",
    "chapter_rollup": f"""WITH l AS (SELECT l_partkey, SUM({_X}) AS revenue FROM lineitem GROUP BY 1)
      SELECT p_brand[1:7] AS code, CAST(SUM(revenue) AS DECIMAL(38,2)) AS total, min_by(p_type, p_partkey) FILTER (p_brand LIKE '%1') AS name FROM part JOIN l ON l_partkey = p_partkey GROUP BY 1""",
    "max_per_code": f"""WITH s AS (SELECT n_name, l_partkey, SUM({_X}) AS revenue FROM lineitem JOIN ({'SELECT o_orderkey, n_name FROM ' + _OR}) ON l_orderkey = o_orderkey GROUP BY 1, 2)
      SELECT n_name, brand, revenue, partkey FROM (SELECT n_name, p_brand AS brand, CAST(revenue AS DECIMAL(38,2)) AS revenue, l_partkey AS partkey,
        row_number() OVER (PARTITION BY n_name, p_brand ORDER BY revenue DESC, l_partkey) AS k FROM s JOIN part ON p_partkey = l_partkey) WHERE k = 1""",
    "top10_per_group": f"""WITH s AS (SELECT n_regionkey, l_partkey, SUM({_X}) AS revenue FROM lineitem JOIN (SELECT o_orderkey, n_regionkey FROM {_OR}) ON l_orderkey = o_orderkey GROUP BY 1, 2)
      SELECT * FROM (SELECT n_regionkey, l_partkey AS partkey, CAST(revenue AS DECIMAL(38,2)) AS revenue, row_number() OVER (PARTITION BY n_regionkey ORDER BY revenue DESC, l_partkey) AS place FROM s) WHERE place <= 10""",
    "top8_children": f"""WITH s AS (SELECT l_partkey, SUM({_X}) AS revenue FROM lineitem GROUP BY 1 HAVING SUM({_X}) > 0)
      SELECT * FROM (SELECT p_brand AS brand, l_partkey AS partkey, CAST(revenue AS DECIMAL(38,2)) AS revenue, row_number() OVER (PARTITION BY p_brand ORDER BY revenue DESC, l_partkey) AS place FROM s JOIN part ON p_partkey = l_partkey) WHERE place <= 8""",
    "coverage_gate": f"""WITH s AS (SELECT o_orderkey, CAST(SUM({_X}) AS DECIMAL(38,2)) AS parts, max({_P}) AS total FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1),
      t AS (SELECT *, CASE WHEN total <> 0 THEN 100 * parts::DOUBLE / total::DOUBLE END AS s FROM s) SELECT o_orderkey, parts, total, round(s, 4) AS share FROM t WHERE s BETWEEN 90 AND 110""",
    "plausible_total": f"""WITH l AS (SELECT l_orderkey, max({_X}) AS g FROM lineitem GROUP BY 1) SELECT o_orderkey, CASE WHEN g IS NULL OR {_P} >= g THEN {_P} END AS total FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""",
    "unit_rescue": f"""WITH {NY}, t AS (SELECT n_name, year, CASE WHEN length(n_name) % 3 = 0 THEN revenue * 1000 ELSE revenue END::DOUBLE AS told, (customers * 100000)::DOUBLE AS witness FROM ny)
      SELECT n_name, year, round(CASE WHEN witness <> 0 AND told / witness >= 100 THEN told / 1000 ELSE told END, 2) AS value FROM t""",
    "plan_share_band": f"""WITH {NY}, q AS (SELECT n_name, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(quarter(o_orderdate) AS BIGINT) AS quarter, SUM({_P}) AS v FROM {_OR} GROUP BY 1, 2, 3),
      s AS (SELECT n_name, year, quarter, round(100 * v::DOUBLE / revenue::DOUBLE, 4) AS share FROM q JOIN ny USING (n_name, year)),
      b AS (SELECT *, bool_or(share NOT BETWEEN 10 AND 40) OVER (PARTITION BY n_name, year) AS incomplete FROM s)
      SELECT n_name, year, quarter, CASE WHEN NOT incomplete THEN share END AS share, incomplete FROM b""",
    "median_thresholds": f"""SELECT n_name, round(median({_P}::DOUBLE), 4) AS median, count(*) FILTER ({_P} >= 150000) AS high, count(*) FILTER ({_P} < 50000) AS low, count(DISTINCT o_custkey) AS customers FROM {_OR} GROUP BY 1""",
    "cost_rollup": """SELECT event_type AS kind, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS calls, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS cost,
      CAST(grouping(event_type) * 2 + grouping(CAST(ts AS DATE)) AS BIGINT) AS level FROM events GROUP BY ROLLUP (event_type, CAST(ts AS DATE))""",
    "report_by_type": "SELECT event_type, count(*) AS calls, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
    "quarter_cumulative": f"""WITH q AS (SELECT n_name, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(quarter(o_orderdate) AS BIGINT) AS quarter, SUM({_P}) AS v FROM {_OR} GROUP BY 1, 2, 3)
      SELECT n_name, year, quarter, CAST(SUM(v) OVER (PARTITION BY n_name, year ORDER BY quarter) AS DECIMAL(38,2)) AS running, CAST(v AS DECIMAL(38,2)) AS step FROM q""",
    "running_budget": """WITH r AS (SELECT event_id, user_id, CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,2)) AS running FROM events)
      SELECT event_id, user_id, running, running <= 500 AS within FROM r""",
    "expected_quarter": f"""WITH o AS (SELECT n_name, o_orderpriority, o_orderstatus, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS q, CAST(o_orderdate AS DATE) AS day FROM {_OR}),
      due AS (SELECT CAST(q AS DATE) AS q FROM (SELECT unnest(generate_series(min(q)::TIMESTAMP, date_trunc('quarter', max(day)), INTERVAL 3 MONTH)) AS q, max(day) AS hi FROM o) WHERE q + INTERVAL 3 MONTH + INTERVAL 54 DAY <= hi)
      SELECT n_name, o_orderpriority, o_orderstatus, CAST(q AS VARCHAR) AS quarter FROM (SELECT * FROM (SELECT DISTINCT n_name, o_orderpriority, o_orderstatus FROM o) CROSS JOIN due EXCEPT SELECT n_name, o_orderpriority, o_orderstatus, q FROM o)""",
}
QUERIES = {f.__name__: f for f in (nation_year_plan, rank_cohort, exclusion_reason, yoy_prev_eligible, evolution_last_nonnull, coverage_by_year, modal_period, period_filter_then_rank, chapter_rollup, max_per_code, top10_per_group, top8_children, coverage_gate, plausible_total, unit_rescue, plan_share_band, median_thresholds, cost_rollup, report_by_type, quarter_cumulative, running_budget, expected_quarter)}
