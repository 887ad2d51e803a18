"""Order-dependent queries over the trade and event tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import planner
from ledgerloom.operators import windows as WN
from ledgerloom.session import table

DEC = "decimal(18,2)"


def _events(spark, d):
    return table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", F.col("value").cast(DEC).alias("v"))


def gap_islands(spark, d):
    """Runs of consecutive active days of each user."""
    days = _events(spark, d).select("user_id", F.datediff(F.col("ts"), F.lit("2024-01-01")).alias("day"))
    return WN.islands(days, ["user_id"], "day")


def compact_days(spark, d):
    """The active days of each user as a range text such as 1-3,7."""
    days = _events(spark, d).select("user_id", F.datediff(F.col("ts"), F.lit("2024-01-01")).alias("day"))
    return WN.compact_ranges(WN.islands(days, ["user_id"], "day"), ["user_id"])


def page_spec(spark, d):
    """Order lines that a page range names, the range depending on the order's priority."""
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderpriority").startswith("1"), "1-2,4").when(F.col("o_orderpriority").startswith("2"), "3-").otherwise("2, 5,9").alias("spec"))
    last = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_linenumber").alias("last"))
    j = o.join(last, o.o_orderkey == last.l_orderkey).select("o_orderkey", "spec", "last")
    return WN.page_spec(j, "spec", F.col("last")).select("o_orderkey", F.col("page").cast("long").alias("page"))


def carry_forward(spark, d):
    """Each event with the id of the user's last sign-up before or at it."""
    e = _events(spark, d)
    held = F.when(F.col("event_type") == "signup", F.col("event_id"))
    return WN.carry_forward(e, ["user_id"], ["ts", "event_id"], {"signup": held}).select("event_id", "signup")


def lookahead_nonnull(spark, d):
    """Each event with the value of the user's next purchase after it."""
    e = _events(spark, d)
    return WN.look_ahead(e, ["user_id"], ["ts", "event_id"], "next_purchase", F.when(F.col("event_type") == "purchase", F.col("v"))).select("event_id", "next_purchase")


def stratified_sample(spark, d):
    """Five evenly spaced documents of each source, by id."""
    return WN.spread_sample(table(spark, d, "documents").select("source", "doc_id"), ["source"], ["doc_id"], 5)


def band_chunks(spark, d):
    """Lines of each supplier in chunks of 32 by order and number: size and first order of each chunk."""
    l = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    return WN.chunks(l, ["l_suppkey"], order, 32).groupBy("l_suppkey", "chunk").agg(F.count(F.lit(1)).alias("rows"), F.min("l_orderkey").alias("first_order"))


def stitched_lines(spark, d):
    """Events that go on the same user's event of the minute's type right before, on consecutive days."""
    e = _events(spark, d).groupBy("user_id", F.datediff(F.col("ts"), F.lit("2024-01-01")).cast("long").alias("day")).agg(F.max_by("event_type", "ts").alias("tail"), F.min_by("event_type", "ts").alias("head"))
    return WN.stitch(e, ["user_id"], "day", F.col("tail") == "view", F.col("head") == "click").select("user_id", "day", "stitched")


def first_wins(spark, d):
    """The first line of each order and number, by all its columns."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast(DEC).alias("quantity"), F.col("l_extendedprice").cast(DEC).alias("price"))
    return WN.first_wins(l, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


def session_events(spark, d):
    """Sessions of each user, half an hour without an event apart."""
    s = WN.sessions(_events(spark, d), ["user_id"], "ts", 1800)
    return s.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("events"), F.min("ts").cast("string").alias("first"), F.sum("v").cast("decimal(38,2)").alias("total"))


def tumbling_events(spark, d):
    w = _events(spark, d).groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("v").cast("decimal(38,2)").alias("total"))
    return w.select(F.unix_timestamp("w.start").alias("start"), "event_type", "events", "total")


def sliding_events(spark, d):
    w = _events(spark, d).groupBy(F.window("ts", "2 hours", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("events"), F.sum("v").cast("decimal(38,2)").alias("total"))
    return w.select(F.unix_timestamp("w.start").alias("start"), "events", "total")


def greedy_plan(spark, d):
    """Events of each user admitted by benefit per cost while 300 in value and 20 calls allow, skipping what doesn't fit."""
    e = _events(spark, d).withColumn("cost", F.col("v").cast("double")).where("cost > 0")
    order = [(-F.length("event_type") / F.col("cost")).alias("rate"), F.col("cost").alias("by_cost"), F.col("event_id").alias("id")]
    return planner.greedy_plan(e, "user_id", order, "cost", 300.0, 20, "event_id").select("user_id", F.col("place").cast("long").alias("place"), "event_id")


def occurrence_names(spark, d):
    """Repeated names get their place; of exactly two rows of one name and value the first is the total."""
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    both = WN.W.partitionBy("p_name", "p_size")
    n = F.count(F.lit(1)).over(both)
    k = F.row_number().over(both.orderBy("p_partkey"))
    role = F.when((n == 2) & (k == 1), "TOTAL").when(n == 2, "FUNCTIONARE")
    place = F.row_number().over(WN.W.partitionBy("p_name").orderBy("p_partkey")).cast("long")
    return p.select("p_partkey", place.alias("place"), role.alias("role"))


_E = "(SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS v FROM events)"
_DAY = "datediff('day', DATE '2024-01-01', CAST(ts AS DATE))"
_RUNS = f"""d AS (SELECT DISTINCT user_id, CAST({_DAY} AS BIGINT) AS day FROM events),
  r AS (SELECT user_id, day, day - row_number() OVER (PARTITION BY user_id ORDER BY day) AS run FROM d),
  i AS (SELECT user_id, min(day) AS first, max(day) AS last, count(*) AS length FROM r GROUP BY user_id, run)"""
SQL = {
    "greedy_plan": """WITH RECURSIVE c AS (SELECT user_id, event_id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS cost, row_number() OVER (PARTITION BY user_id ORDER BY -length(event_type) / CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE), CAST(value AS DECIMAL(18,2)), event_id) AS k
        FROM events WHERE CAST(value AS DECIMAL(18,2)) > 0 AND CAST(value AS DECIMAL(18,2)) <= 300),
      g AS (SELECT user_id, k, event_id, cost AS spent, 1 AS used, true AS taken FROM c WHERE k = 1
        UNION ALL SELECT c.user_id, c.k, c.event_id, CASE WHEN g.spent + c.cost <= 300 AND g.used < 20 THEN g.spent + c.cost ELSE g.spent END, CASE WHEN g.spent + c.cost <= 300 AND g.used < 20 THEN g.used + 1 ELSE g.used END, g.spent + c.cost <= 300 AND g.used < 20 FROM g JOIN c ON c.user_id = g.user_id AND c.k = g.k + 1)
      SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY k) - 1 AS BIGINT) AS place, event_id FROM g WHERE taken""",
    "gap_islands": f"WITH {_RUNS} SELECT * FROM i",
    "compact_days": f"WITH {_RUNS} SELECT user_id, string_agg(CASE WHEN first = last THEN first::VARCHAR ELSE first || '-' || last END, ',' ORDER BY first) AS spec FROM i GROUP BY 1",
    "page_spec": """WITH m AS (SELECT l_orderkey, max(l_linenumber) AS last FROM lineitem GROUP BY 1), o AS (SELECT o_orderkey, left(o_orderpriority, 1) AS p, last FROM orders JOIN m ON l_orderkey = o_orderkey),
      n AS (SELECT o_orderkey, p, last, unnest(range(1, last + 1)) AS page FROM o)
      SELECT o_orderkey, CAST(page AS BIGINT) AS page FROM n WHERE CASE WHEN p = '1' THEN page IN (1, 2, 4) WHEN p = '2' THEN page >= 3 ELSE page IN (2, 5, 9) END""",
    "carry_forward": f"SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS signup FROM {_E}",
    "lookahead_nonnull": f"SELECT event_id, first_value(CASE WHEN event_type = 'purchase' THEN v END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_purchase FROM {_E}",
    "stratified_sample": """WITH n AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS k, count(*) OVER (PARTITION BY source) AS t FROM documents)
      SELECT source, doc_id FROM n WHERE t <= 5 OR k IN (0, floor((t - 1) / 4 + 0.5), floor(2 * (t - 1) / 4 + 0.5), floor(3 * (t - 1) / 4 + 0.5), t - 1)""",
    "band_chunks": """WITH n AS (SELECT l_suppkey, l_orderkey, (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate) - 1) // 32 AS chunk FROM lineitem)
      SELECT l_suppkey, CAST(chunk AS BIGINT) AS chunk, count(*) AS rows, min(l_orderkey) AS first_order FROM n GROUP BY 1, 2""",
    "stitched_lines": f"""WITH g AS (SELECT user_id, CAST({_DAY} AS BIGINT) AS day, max_by(event_type, ts) AS tail, min_by(event_type, ts) AS head FROM events GROUP BY 1, 2)
      SELECT user_id, day, coalesce(lag(day) OVER w = day - 1 AND lag(tail) OVER w = 'view' AND head = 'click', false) AS stitched FROM g WINDOW w AS (PARTITION BY user_id ORDER BY day)""",
    "first_wins": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, quantity, price FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, quantity, price) AS k
      FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem)) WHERE k = 1""",
    "session_events": f"""WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) > 1800000000 THEN 1 ELSE 0 END AS wide FROM {_E}),
      s AS (SELECT *, CAST(SUM(wide) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM g)
      SELECT user_id, session, count(*) AS events, CAST(min(ts) AS VARCHAR) AS first, CAST(SUM(v) AS DECIMAL(38,2)) AS total FROM s GROUP BY 1, 2""",
    "tumbling_events": f"SELECT CAST(epoch(time_bucket(INTERVAL 1 HOUR, ts)) AS BIGINT) AS start, event_type, count(*) AS events, CAST(SUM(v) AS DECIMAL(38,2)) AS total FROM {_E} GROUP BY 1, 2",
    "sliding_events": f"""WITH w AS (SELECT CAST(epoch(time_bucket(INTERVAL 1 HOUR, ts)) AS BIGINT) - 3600 * k AS start, v FROM {_E} CROSS JOIN (VALUES (0), (1)) t(k))
      SELECT start, count(*) AS events, CAST(SUM(v) AS DECIMAL(38,2)) AS total FROM w GROUP BY 1""",
    "occurrence_names": """SELECT p_partkey, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS place,
      CASE WHEN count(*) OVER (PARTITION BY p_name, p_size) = 2 THEN CASE WHEN row_number() OVER (PARTITION BY p_name, p_size ORDER BY p_partkey) = 1 THEN 'TOTAL' ELSE 'FUNCTIONARE' END END AS role FROM part""",
}
QUERIES = {f.__name__: f for f in (gap_islands, compact_days, page_spec, carry_forward, lookahead_nonnull, stratified_sample, band_chunks, stitched_lines, first_wins, session_events, tumbling_events, sliding_events, greedy_plan, occurrence_names)}
