"""Joining queries over the trade tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import crossperiod as X
from ledgerloom.operators import joins as J
from ledgerloom.plans.analytics_queries import _OR, _P, _X, NY, nation_years, order_rows
from ledgerloom.session import table

DEC = "decimal(18,2)"
WIDE = "decimal(38,2)"


def registry_fallback_join(spark, d):
    """Customers with the first entry that a registry of nations, regions and a default has for them."""
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    registry = n.where("n_nationkey % 3 = 0").select(F.concat(F.lit("n"), F.col("n_nationkey")).alias("code"), F.col("n_name").alias("label")).unionByName(r.where("r_regionkey % 2 = 0").select(F.concat(F.lit("r"), F.col("r_regionkey")).alias("code"), F.col("r_name").alias("label"))).unionByName(spark.createDataFrame([("*", "DEFAULT")], "code string, label string"))
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_nationkey", "n_regionkey")
    found = J.fallback_lookup(c, registry, "code", [F.concat(F.lit("n"), F.col("c_nationkey")), F.concat(F.lit("r"), F.col("n_regionkey")), F.lit("*")], "c_custkey")
    return found.select("c_custkey", "attempt", F.col("matched_code").alias("code"), "label")


def det_wins_merge(spark, d):
    """Revenue of parts in two years merged: the later year wins, the earlier fills gaps."""
    l = table(spark, d, "lineitem").select("l_partkey", F.year("l_shipdate").alias("y"), F.col("l_extendedprice").cast(DEC).alias("v"), F.col("l_quantity").cast(DEC).alias("q"))
    per = lambda y: l.where(F.col("y") == y).groupBy("l_partkey").agg(F.sum("v").cast(WIDE).alias("value"), F.sum("q").cast(WIDE).alias("quantity"))
    return J.merge_preferring_left(per(1999), per(1998), ["l_partkey"], ["value", "quantity"])


def three_witness(spark, d):
    """Customers per nation by three sources: the register, who ordered, and whom the orders' keys name."""
    c = table(spark, d, "customer")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    named = c.join(n, c.c_nationkey == n.n_nationkey)
    register = named.groupBy("n_name").agg(F.count(F.lit(1)).alias("v"))
    ordered = order_rows(spark, d).groupBy("n_name").agg(F.count_distinct("o_custkey").alias("v"))
    positive = named.where("c_acctbal >= 0").groupBy("n_name").agg(F.count(F.lit(1)).alias("v"))
    return J.witnesses({"register": register, "ordered": ordered, "positive": positive}, ["n_name"], "v", 5.0)


def semi_anti_missing(spark, d):
    """Orders without lines and customers without orders."""
    o = table(spark, d, "orders")
    empty = o.join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"))
    idle = table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"))
    return empty.unionByName(idle)


_BANDS = "(VALUES ('low', 900.0, 920.0), ('mid', 920.0, 955.5), ('high', 955.5, 990.0), ('all', 900.0, 2000.0)) b(band, lo, hi)"


def range_join_bands(spark, d):
    bands = spark.createDataFrame([("low", 900.0, 920.0), ("mid", 920.0, 955.5), ("high", 955.5, 990.0), ("all", 900.0, 2000.0)], "band string, lo double, hi double")
    p = table(spark, d, "part").select("p_partkey", "p_retailprice")
    return J.range_join(p, "p_retailprice", bands, "lo", "hi", 25.0).select("p_partkey", "band")


def nearest_center(spark, d):
    centers = spark.createDataFrame([("c5", 5), ("c14", 14), ("c23", 23), ("c41", 41)], "centre string, at long")
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("long").alias("p_size"))
    return J.nearest_center(p, "p_size", centers, "at", "centre", 4).select("p_partkey", "centre", "distance")


def _sides(spark, d):
    l = table(spark, d, "lineitem").select("l_partkey", F.col("l_quantity").cast("long").alias("quantity"), "l_returnflag", "l_orderkey", "l_linenumber", "l_suppkey")
    return l.where("l_returnflag = 'A'"), l.where("l_returnflag = 'R'")


def one_to_one_match(spark, d):
    """Returned and accepted lines of one part and quantity matched one to one; recall and precision per brand."""
    a, r = _sides(spark, d)
    both = J.one_to_one(a, r, ["l_partkey", "quantity"], ["l_orderkey", "l_linenumber", "l_suppkey"])
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    g = both.join(p, both.l_partkey == p.p_partkey).groupBy(F.col("p_brand").alias("brand")).agg(F.count_if("expected").alias("expected"), F.count_if("predicted").alias("predicted"), F.count_if(F.col("expected") & F.col("predicted")).alias("matched"))
    pct = lambda n: F.when(F.col(n) > 0, F.round(100 * F.col("matched") / F.col(n), 2))
    return g.select("brand", "expected", "predicted", "matched", pct("expected").alias("recall"), F.when(F.col("predicted") > 0, pct("predicted")).when(F.col("expected") > 0, 0.0).alias("precision"))


def repeat_agreement(spark, d):
    """Lines of one order and number that agree with the first of them in two columns or more."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax")
    first = l.groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1")
    j = l.join(first, ["l_orderkey", "l_linenumber"])
    equal = sum((F.when(F.col(c) == F.col(f"f.{c}"), 1).otherwise(0) for c in ("l_suppkey", "l_quantity", "l_discount", "l_tax")), F.lit(0))
    return j.withColumn("equal", equal.cast("long")).where((F.col("equal") >= 2) & (F.col("l_partkey") != F.col("f.l_partkey"))).select("l_orderkey", "l_linenumber", "l_partkey", "equal")


def repeat_agreement_pairs(spark, d):
    """All pairs of lines of one order and number, of different parts, that agree in two columns or more."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax")
    return J.agreeing_pairs(l, ["l_orderkey", "l_linenumber"], ["l_suppkey", "l_quantity", "l_discount", "l_tax"], "l_partkey").withColumnRenamed("other", "other_partkey")


def component_sum(spark, d):
    """Quantities of a part that are the sum of two other lines' quantities of the same supplier and part."""
    l = table(spark, d, "lineitem").select(F.concat_ws("/", F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string")).alias("pair"), F.col("l_quantity").cast("long").alias("q"), F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_extendedprice").cast("string")).alias("ord"))
    return J.component_sums(l, l, "pair", "q", "ord")


def _region_parts(spark, d, year):
    l = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", F.col("l_extendedprice").cast(DEC).alias("v"))
    o = order_rows(spark, d).where(F.col("year") == year).select("o_orderkey", "n_regionkey")
    return l.join(o, l.l_orderkey == o.o_orderkey).groupBy("n_regionkey", "l_partkey").agg(F.sum("v").cast(WIDE).alias("value"))


def cross_period_suspects(spark, d):
    """Revenue of a region's part in 2000 against 1999, relative to the region's median change."""
    pairs = X.matched(_region_parts(spark, d, 1999), _region_parts(spark, d, 2000), ["n_regionkey", "l_partkey"], "value")
    return X.suspects(pairs, "n_regionkey").select("n_regionkey", "l_partkey", F.round("relative", 6).alias("relative"), "signature", F.round("priority", 4).alias("priority"))


def cross_period_summary(spark, d):
    pairs = X.matched(_region_parts(spark, d, 1999), _region_parts(spark, d, 2000), ["n_regionkey", "l_partkey"], "value")
    return X.summary(pairs, "n_regionkey").select("n_regionkey", "matched", F.round("median_ratio", 6).alias("median_ratio"), "unit_shift")


def union_editions(spark, d):
    """Two years' tables of different columns as one."""
    a = nation_years(spark, d).where("year = 1996").select("n_name", "year", "revenue")
    b = nation_years(spark, d).where("year = 1997").select("n_name", "year", "customers")
    return a.unionByName(b, allowMissingColumns=True)


def set_ops(spark, d):
    """Parts sold in 1998 and 1999, only in 1998, and how often in both (as multisets)."""
    l = table(spark, d, "lineitem").select(F.col("l_partkey").alias("id"), F.year("l_shipdate").alias("y"))
    a, b = l.where("y = 1998").select("id"), l.where("y = 1999").select("id")
    tag = lambda df, t: df.select(F.lit(t).alias("op"), "id")
    multi = a.intersectAll(b).groupBy("id").count().select(F.lit("multi").alias("op"), "id", F.col("count").alias("n"))
    return tag(a.intersect(b), "both").unionByName(tag(a.subtract(b), "only")).withColumn("n", F.lit(1).cast("long")).unionByName(multi)


_RP = f"""o AS (SELECT o_orderkey, n_regionkey, year(o_orderdate) AS y FROM {_OR}), g AS (SELECT n_regionkey, l_partkey, y, SUM({_X})::DOUBLE AS v FROM lineitem JOIN o ON o_orderkey = l_orderkey WHERE y IN (1999, 2000) GROUP BY 1, 2, 3),
  p AS (SELECT a.n_regionkey, a.l_partkey, a.v AS old, b.v AS new, b.v / a.v AS ratio FROM g a JOIN g b USING (n_regionkey, l_partkey) WHERE a.y = 1999 AND b.y = 2000 AND a.v <> 0),
  m AS (SELECT n_regionkey, count(*) AS matched, median(ratio) AS med FROM p GROUP BY 1 HAVING count(*) >= 20)"""
SQL = {
    "registry_fallback_join": """SELECT c_custkey, CAST(CASE WHEN c_nationkey % 3 = 0 THEN 1 WHEN n_regionkey % 2 = 0 THEN 2 ELSE 3 END AS BIGINT) AS attempt,
      CASE WHEN c_nationkey % 3 = 0 THEN 'n' || c_nationkey WHEN n_regionkey % 2 = 0 THEN 'r' || n_regionkey ELSE '*' END AS code,
      CASE WHEN c_nationkey % 3 = 0 THEN n_name WHEN n_regionkey % 2 = 0 THEN r_name ELSE 'DEFAULT' END AS label FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "det_wins_merge": f"""WITH l AS (SELECT l_partkey, year(l_shipdate) AS y, CAST(SUM({_X}) AS DECIMAL(38,2)) AS value, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS quantity FROM lineitem GROUP BY 1, 2)
      SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey, coalesce(a.value, b.value) AS value, coalesce(a.quantity, b.quantity) AS quantity,
        CAST(CASE WHEN a.l_partkey IS NULL THEN 2 ELSE 0 END AS BIGINT) AS filled, CAST(CASE WHEN a.value <> b.value THEN 1 ELSE 0 END + CASE WHEN a.quantity <> b.quantity THEN 1 ELSE 0 END AS BIGINT) AS conflicts
      FROM (SELECT * FROM l WHERE y = 1999) a FULL JOIN (SELECT * FROM l WHERE y = 1998) b ON a.l_partkey = b.l_partkey""",
    "three_witness": f"""WITH s AS (SELECT n_name, count(*)::DOUBLE AS v, 1 AS s FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1 UNION ALL SELECT n_name, count(DISTINCT o_custkey)::DOUBLE, 2 FROM {_OR} GROUP BY 1
        UNION ALL SELECT n_name, count(*)::DOUBLE, 3 FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal >= 0 GROUP BY 1)
      SELECT n_name, count(DISTINCT s) AS sources, min(v) AS low, max(v) AS high, max(v) - min(v) <= 5 AND count(DISTINCT s) = 3 AS agree FROM s GROUP BY 1""",
    "semi_anti_missing": """SELECT 'order' AS kind, o_orderkey AS id FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
      UNION ALL SELECT 'customer', c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""",
    "range_join_bands": f"SELECT p_partkey, band FROM part JOIN {_BANDS} ON p_retailprice >= lo AND p_retailprice < hi",
    "nearest_center": """WITH c AS (SELECT * FROM (VALUES ('c5', 5), ('c14', 14), ('c23', 23), ('c41', 41)) c(centre, spot)), n AS (SELECT p_partkey, centre, abs(p_size - spot) AS far, row_number() OVER (PARTITION BY p_partkey ORDER BY abs(p_size - spot), spot) AS k FROM part CROSS JOIN c)
      SELECT p_partkey, CASE WHEN far <= 4 THEN centre END AS centre, CAST(CASE WHEN far <= 4 THEN far END AS BIGINT) AS distance FROM n WHERE k = 1""",
    "one_to_one_match": """WITH n AS (SELECT l_partkey, CAST(l_quantity AS BIGINT) AS quantity, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1, 2),
      g AS (SELECT p_brand AS brand, CAST(SUM(a) AS BIGINT) AS expected, CAST(SUM(r) AS BIGINT) AS predicted, CAST(SUM(least(a, r)) AS BIGINT) AS matched FROM n JOIN part ON p_partkey = l_partkey WHERE a + r > 0 GROUP BY 1)
      SELECT *, CASE WHEN expected > 0 THEN round(100 * matched / expected, 2) END AS recall, CASE WHEN predicted > 0 THEN round(100 * matched / predicted, 2) WHEN expected > 0 THEN 0.0 END AS precision FROM g""",
    "repeat_agreement": """WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_discount, l_tax) AS k FROM lineitem), f AS (SELECT * FROM n WHERE k = 1),
      j AS (SELECT n.l_orderkey, n.l_linenumber, n.l_partkey, f.l_partkey AS fp, CAST((n.l_suppkey = f.l_suppkey)::INT + (n.l_quantity = f.l_quantity)::INT + (n.l_discount = f.l_discount)::INT + (n.l_tax = f.l_tax)::INT AS BIGINT) AS equal FROM n JOIN f USING (l_orderkey, l_linenumber))
      SELECT l_orderkey, l_linenumber, l_partkey, equal FROM j WHERE equal >= 2 AND l_partkey <> fp""",
    "component_sum": """WITH l AS (SELECT l_suppkey || '/' || l_partkey AS pair, CAST(l_quantity AS BIGINT) AS q, row_number() OVER () AS id FROM lineitem),
      m AS (SELECT w.pair, w.q AS whole, min(x.q) AS a FROM (SELECT DISTINCT pair, q FROM l) w JOIN l x ON x.pair = w.pair JOIN l y ON y.pair = w.pair AND y.id <> x.id AND x.q <= y.q AND x.q + y.q = w.q GROUP BY 1, 2)
      SELECT pair, whole, a, whole - a AS b FROM m""",
    "cross_period_suspects": f"""WITH {_RP}, s AS (SELECT n_regionkey, l_partkey, ratio / med AS rel, greatest(abs(old), abs(new)) AS size FROM p JOIN m USING (n_regionkey) WHERE med <> 0),
      t AS (SELECT *, CASE WHEN rel > 0 THEN greatest(rel, 1 / rel) ELSE 0 END AS dev, least(abs(rel / 0.001 - 1), abs(rel / 0.01 - 1), abs(rel / 0.1 - 1), abs(rel / 10 - 1), abs(rel / 100 - 1), abs(rel / 1000 - 1)) <= 0.02 AS shift FROM s)
      SELECT n_regionkey, l_partkey, round(rel, 6) AS relative, CASE WHEN shift THEN 'decimal_shift' ELSE 'outlier' END AS signature, round(dev * CASE WHEN shift THEN 2 ELSE 1 END * (1 + pow(size, 0.25)), 4) AS priority FROM t WHERE dev >= 8""",
    "cross_period_summary": f"WITH {_RP} SELECT n_regionkey, matched, round(med, 6) AS median_ratio, CAST(CASE WHEN abs(med / 1000 - 1) <= 0.05 THEN 1000 WHEN abs(med / 0.001 - 1) <= 0.05 THEN 1 END AS BIGINT) AS unit_shift FROM m",
    "union_editions": f"WITH {NY} SELECT n_name, year, CAST(revenue AS DECIMAL(38,2)) AS revenue, CAST(NULL AS BIGINT) AS customers FROM ny WHERE year = 1996 UNION ALL SELECT n_name, year, NULL, customers FROM ny WHERE year = 1997",
    "set_ops": """WITH a AS (SELECT l_partkey AS id, count(*) AS n FROM lineitem WHERE year(l_shipdate) = 1998 GROUP BY 1), b AS (SELECT l_partkey AS id, count(*) AS n FROM lineitem WHERE year(l_shipdate) = 1999 GROUP BY 1)
      SELECT 'both' AS op, id, CAST(1 AS BIGINT) AS n FROM a JOIN b USING (id) UNION ALL SELECT 'only', id, 1 FROM a WHERE id NOT IN (SELECT id FROM b) UNION ALL SELECT 'multi', id, least(a.n, b.n) FROM a JOIN b USING (id)""",
}
QUERIES = {f.__name__: f for f in (registry_fallback_join, det_wins_merge, three_witness, semi_anti_missing, range_join_bands, nearest_center, one_to_one_match, repeat_agreement, repeat_agreement_pairs, component_sum, cross_period_suspects, cross_period_summary, union_editions, set_ops)}
