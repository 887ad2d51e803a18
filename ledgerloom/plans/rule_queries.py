"""Arithmetic checks over the trade tables and the fact rows, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import rules as R
from ledgerloom.plans.analytics_queries import _OR, _P, order_rows
from ledgerloom.session import table

DEC = "decimal(18,2)"
WIDE = "decimal(38,2)"


def hierarchy_breach(spark, d):
    """Orders whose price isn't the sum of their discounted lines."""
    part = (F.col("l_extendedprice").cast(DEC) * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast(DEC)
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), part.alias("child_value"))
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").cast(DEC).alias("parent_value"))
    return R.hierarchy(orders, lines, ["key"]).select("key", F.col("difference").cast(WIDE).alias("difference"), "terms")


def row_checksum(spark, d):
    """Nation-years whose finished revenue isn't the sum of all orders' quarters."""
    o = order_rows(spark, d).withColumn("q", F.quarter("o_orderdate"))
    wide = o.groupBy("n_name", "year").agg(F.sum(F.when(F.col("o_orderstatus") != "P", F.col("price"))).cast(WIDE).alias("total"), *[F.sum(F.when(F.col("q") == i, F.col("price"))).cast(WIDE).alias(f"q{i}") for i in (1, 2, 3, 4)])
    return R.row_checksum(wide, "total", ["q1", "q2", "q3", "q4"]).select("n_name", "year", "total", F.col("difference").cast(WIDE).alias("difference"))


TERMS = (("all_flags", "T", 1, True), ("all_flags", "A", 1, False), ("all_flags", "N", 1, False), ("all_flags", "R", 1, False), ("two_flags", "T", 1, True), ("two_flags", "A", 1, False), ("two_flags", "R", 1, False), ("open_rest", "O", 1, True), ("open_rest", "T", 1, False), ("open_rest", "F", -1, False))


def identity_breach(spark, d):
    """Signed sums over flags and states of each supplier and year, where all their terms occur."""
    l = table(spark, d, "lineitem").select("l_suppkey", F.year("l_shipdate").cast("long").alias("year"), F.col("l_extendedprice").cast(DEC).alias("v"), "l_returnflag", "l_linestatus")
    # Summed once, then the few sums of a supplier's year are listed under each of their codes.
    sums = l.groupBy("l_suppkey", "year", "l_returnflag", "l_linestatus").agg(F.sum("v").alias("v"))
    listed = sums.select("l_suppkey", "year", "v", F.explode(F.array("l_returnflag", "l_linestatus", F.lit("T"))).alias("code"))
    values = listed.groupBy("l_suppkey", "year", "code").agg(F.sum("v").cast(WIDE).alias("value"))
    terms = spark.createDataFrame(list(TERMS), "identity string, code string, coeff int, is_target boolean")
    found = R.identities(values, terms, ["l_suppkey", "year"])
    return found.select("l_suppkey", "year", "identity", F.col("difference").cast(WIDE).alias("difference"), "holds")


def cross_section(spark, d):
    """Nation-years whose total isn't the sum of finished and open orders, where all three exist."""
    o = order_rows(spark, d).select("n_name", "year", "price", F.explode(F.array(F.lit("TOTAL"), "o_orderstatus")).alias("section"))
    return R.cross_section(o, ["n_name", "year"], "section", "price", "TOTAL", ["F", "O"]).select("n_name", "year", *[F.col(c).cast(WIDE).alias(c) for c in ("whole", "parts", "difference")])


def duplicates_conflict(spark, d):
    """Repeated line numbers of an order whose lines differ from the first."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return R.conflicting_duplicates(l, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"], ["l_partkey", "l_quantity", "l_extendedprice"])


def fact_duplicates(spark, d):
    """Lines of a city's edition exported more than once with different values."""
    keys = ["siruta", "year", "context_id", "institution", "budget", "suffix", "section", "kind", "func_code", "code", "column_name"]
    f = table(spark, d, "facts").select(*keys, "fact_id", "value")
    return R.conflicting_duplicates(f, keys, ["fact_id"], ["value"])


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def missing_child_residual(spark, d):
    """Nation-months of which one market segment has no finished order: what of the month's total is left for it."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("who"), "c_mktsegment")
    o = order_rows(spark, d).join(c, F.col("o_custkey") == F.col("who")).withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    parts = o.where("o_orderstatus != 'P'").groupBy("n_name", "month", "c_mktsegment").agg(F.sum("price").cast(WIDE).alias("v"))
    wholes = o.groupBy("n_name", "month").agg(F.sum("price").cast(WIDE).alias("total"))
    return R.residual_of_missing(parts, wholes, ["n_name", "month"], "c_mktsegment", "v", "total", list(SEGMENTS)).select("n_name", "month", "missing", F.col("residual").cast(WIDE).alias("residual"))


def issue_summary(spark, d):
    """The verified and unverified facts' issues as one text per city and year, in order."""
    f = table(spark, d, "facts").where("validation_issues is not null and siruta is not null").select("siruta", F.col("year").cast("long").alias("year"), F.explode(F.split("validation_issues", ";")).alias("issue"))
    told = f.select("siruta", "year", F.trim("issue").alias("issue")).where("issue != ''").groupBy("siruta", "year", "issue").agg(F.count(F.lit(1)).alias("n"))
    return told.groupBy("siruta", "year").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("issue", "n"))), lambda x: F.concat_ws(":", x["issue"], x["n"].cast("string"))), "; ").alias("issues"), F.sum("n").alias("total"))


def long_facts(spark, d):
    """A fact per line and value column, with where it comes from and whether its line holds."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[F.col(c).cast(DEC).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")])
    long_ = l.unpivot(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "column_name", "value")
    return long_.where("value is not null and value != 0").withColumn("source", F.when(F.col("column_name") == "l_tax", "derived").otherwise("printed"))


def wide_pivot(spark, d):
    """Long facts back to one row per city, year and kind, a column per quarter."""
    f = table(spark, d, "facts").where("siruta is not null").select("siruta", F.col("year").cast("long").alias("year"), "kind", "column_name", F.col("value").cast("decimal(38,6)").alias("value"))
    p = f.groupBy("siruta", "year", "kind").pivot("column_name", ["trim1", "trim2", "trim3", "trim4"]).agg(F.sum("value").cast("decimal(38,6)"))
    return p


def classification_codes(spark, d):
    """Functional and economic place of every fact's code, and its chapter."""
    from ledgerloom.functions import codes as C

    f = table(spark, d, "facts").select("fact_id", "kind", "code", "func_code")
    return f.select("fact_id", C.classification(F.col("kind"), F.col("code"), F.col("func_code")).alias("c"), C.chapter(F.col("code")).alias("chapter"), C.parent_code(F.col("code"), F.col("kind")).alias("parent")).select("fact_id", "c.functional", "c.economic", "chapter", "parent")


def evidence_json(spark, d):
    """How many rules each fact's validation evidence says were passed, and how many findings it has."""
    f = table(spark, d, "facts").where("validation_evidence is not null").select("fact_id", F.try_parse_json("validation_evidence").alias("j"))
    size = lambda path: F.size(F.expr(f"try_variant_get(j, '$.{path}', 'array<variant>')")).cast("long")
    return f.select("fact_id", F.coalesce(F.nullif(size("passed"), F.lit(-1)), F.lit(0)).alias("passed"), F.coalesce(F.nullif(size("findings"), F.lit(-1)), F.lit(0)).alias("findings"))


def fact_coverage(spark, d):
    """Facts, verified ones, missing sections and distinct lines of each city and year."""
    f = table(spark, d, "facts").select("siruta", F.col("year").cast("long").alias("year"), "verified", "section", "code")
    return f.groupBy("siruta", "year").agg(F.count(F.lit(1)).alias("facts"), F.count_if("verified").alias("verified"), F.count_if(F.col("section").isNull()).alias("no_section"), F.count_distinct("code").alias("codes"))


_L = "CAST(l_extendedprice AS DECIMAL(18,2))"
SQL = {
    "hierarchy_breach": f"""WITH s AS (SELECT l_orderkey AS key, SUM(CAST({_L} * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2))) AS s, count(*) AS terms FROM lineitem GROUP BY 1)
      SELECT key, CAST({_P} - s AS DECIMAL(38,2)) AS difference, terms FROM s JOIN orders ON o_orderkey = key WHERE abs({_P} - s) > 0.01 * greatest(terms, 2) AND NOT (s = 0 AND {_P} <> 0)""",
    "row_checksum": f"""WITH w AS (SELECT n_name, CAST(year(o_orderdate) AS BIGINT) AS year, SUM({_P}) FILTER (o_orderstatus <> 'P') AS total, SUM({_P}) AS s, count(DISTINCT quarter(o_orderdate)) AS q FROM {_OR} GROUP BY 1, 2)
      SELECT n_name, year, CAST(total AS DECIMAL(38,2)) AS total, CAST(total - s AS DECIMAL(38,2)) AS difference FROM w WHERE q = 4 AND total IS NOT NULL AND abs(total - s) > 0.04""",
    "identity_breach": f"""WITH v AS (SELECT l_suppkey, CAST(year(l_shipdate) AS BIGINT) AS year, unnest([l_returnflag, l_linestatus, 'T']) AS code, {_L} AS v FROM lineitem), g AS (SELECT l_suppkey, year, code, SUM(v) AS v FROM v GROUP BY 1, 2, 3),
      t AS (SELECT * FROM (VALUES {', '.join(f"('{a}', '{b}', {c}, {str(e).lower()})" for a, b, c, e in TERMS)}) t(identity, code, coeff, is_target)), n AS (SELECT identity, count(*) AS n FROM t GROUP BY 1),
      j AS (SELECT l_suppkey, year, identity, count(*) AS k, SUM(CASE WHEN is_target THEN v ELSE -v * coeff END) AS d FROM g JOIN t USING (code) GROUP BY 1, 2, 3)
      SELECT l_suppkey, year, identity, CAST(d AS DECIMAL(38,2)) AS difference, abs(d) <= 0.01 * greatest(n - 1, 2) AS holds FROM j JOIN n USING (identity) WHERE k = n""",
    "cross_section": f"""WITH s AS (SELECT n_name, CAST(year(o_orderdate) AS BIGINT) AS year, SUM({_P}) AS w, SUM({_P}) FILTER (o_orderstatus = 'F') AS f, SUM({_P}) FILTER (o_orderstatus = 'O') AS o FROM {_OR} GROUP BY 1, 2)
      SELECT n_name, year, CAST(w AS DECIMAL(38,2)) AS whole, CAST(f + o AS DECIMAL(38,2)) AS parts, CAST(w - f - o AS DECIMAL(38,2)) AS difference FROM s WHERE f IS NOT NULL AND o IS NOT NULL AND abs(w - f - o) > 0.02""",
    "duplicates_conflict": """WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS k, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS rows FROM lineitem),
      f AS (SELECT * FROM n WHERE k = 1) SELECT l_orderkey, l_linenumber, rows, different FROM (SELECT l_orderkey, l_linenumber, max(n.rows) AS rows,
        CAST(SUM((n.l_partkey, n.l_quantity, n.l_extendedprice) IS DISTINCT FROM (f.l_partkey, f.l_quantity, f.l_extendedprice)) AS BIGINT) AS different FROM n JOIN f USING (l_orderkey, l_linenumber) GROUP BY 1, 2) WHERE different > 0""",
    "fact_duplicates": """WITH n AS (SELECT *, row_number() OVER w AS k, first_value(value) OVER w AS fv FROM facts WINDOW w AS (PARTITION BY siruta, year, context_id, institution, budget, suffix, section, kind, func_code, code, column_name ORDER BY fact_id))
      SELECT siruta, year, context_id, institution, budget, suffix, section, kind, func_code, code, column_name, count(*) AS rows, CAST(SUM((value IS DISTINCT FROM fv)::INT) AS BIGINT) AS different FROM n GROUP BY ALL HAVING SUM((value IS DISTINCT FROM fv)::INT) > 0""",
    "missing_child_residual": f"""WITH o AS (SELECT n_name, strftime(o_orderdate, '%Y-%m') AS month, c_mktsegment AS seg, o_orderstatus, {_P} AS p FROM {_OR}),
      s AS (SELECT n_name, month, list(DISTINCT seg) AS seen, SUM(p) AS v FROM o WHERE o_orderstatus <> 'P' GROUP BY 1, 2), w AS (SELECT n_name, month, SUM(p) AS total FROM o GROUP BY 1, 2)
      SELECT n_name, month, list_filter({list(SEGMENTS)}, lambda x: NOT list_contains(seen, x))[1] AS missing, CAST(total - v AS DECIMAL(38,2)) AS residual FROM s JOIN w USING (n_name, month) WHERE len(seen) = 4 AND abs(total - v) > 0.05""",
    "issue_summary": """WITH f AS (SELECT siruta, CAST(year AS BIGINT) AS year, trim(unnest(string_split(validation_issues, ';'))) AS issue FROM facts WHERE validation_issues IS NOT NULL AND siruta IS NOT NULL),
      c AS (SELECT siruta, year, issue, count(*) AS n FROM f WHERE issue <> '' GROUP BY 1, 2, 3) SELECT siruta, year, string_agg(issue || ':' || n, '; ' ORDER BY issue) AS issues, CAST(SUM(n) AS BIGINT) AS total FROM c GROUP BY 1, 2""",
    "long_facts": """WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, CAST(l_discount AS DECIMAL(18,2)) AS l_discount, CAST(l_tax AS DECIMAL(18,2)) AS l_tax FROM lineitem)
      SELECT *, CASE WHEN column_name = 'l_tax' THEN 'derived' ELSE 'printed' END AS source FROM (UNPIVOT l ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME column_name VALUE value) WHERE value <> 0""",
    "wide_pivot": f"""SELECT siruta, CAST(year AS BIGINT) AS year, kind, {', '.join(f"CAST(SUM(value) FILTER (column_name = 'trim{i}') AS DECIMAL(38,6)) AS trim{i}" for i in (1, 2, 3, 4))} FROM facts WHERE siruta IS NOT NULL GROUP BY 1, 2, 3""",
    "classification_codes": """SELECT fact_id, CASE WHEN kind = 'expense_economic' THEN func_code WHEN kind = 'expense_functional' THEN code END AS functional, CASE WHEN kind = 'expense_economic' THEN code END AS economic,
      array_to_string(string_split(code, '.')[1:2], '.') AS chapter, CASE WHEN len(string_split(code, '.')) > 2 OR (kind = 'expense_economic' AND len(string_split(code, '.')) = 2) THEN array_to_string(string_split(code, '.')[1:-2], '.') END AS parent FROM facts""",
    "evidence_json": """SELECT fact_id, CAST(coalesce(json_array_length(e, '$.passed'), 0) AS BIGINT) AS passed, CAST(coalesce(json_array_length(e, '$.findings'), 0) AS BIGINT) AS findings
      FROM (SELECT fact_id, TRY_CAST(validation_evidence AS JSON) AS e FROM facts WHERE validation_evidence IS NOT NULL)""",
    "fact_coverage": "SELECT siruta, CAST(year AS BIGINT) AS year, count(*) AS facts, count(*) FILTER (verified) AS verified, count(*) FILTER (section IS NULL) AS no_section, count(DISTINCT code) AS codes FROM facts GROUP BY 1, 2",
}
QUERIES = {f.__name__: f for f in (hierarchy_breach, row_checksum, identity_breach, cross_section, duplicates_conflict, fact_duplicates, missing_child_residual, issue_summary, long_facts, wide_pivot, classification_codes, evidence_json, fact_coverage)}
