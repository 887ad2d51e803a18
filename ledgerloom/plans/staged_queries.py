"""Registry, matching, report, repair, manifest, assembly and page queries, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import assembly as AS
from ledgerloom.operators import crossperiod as X
from ledgerloom.operators import execution as EX
from ledgerloom.operators import joins as J
from ledgerloom.operators import manifest as MF
from ledgerloom.operators import matching as MT
from ledgerloom.operators import pages as PG
from ledgerloom.operators import registry as RG
from ledgerloom.operators import repairs as RP
from ledgerloom.operators.diff import latest
from ledgerloom.plans.analytics_queries import _OR, _P, order_rows
from ledgerloom.session import table

DEC = "decimal(18,2)"
WIDE = "decimal(38,2)"


def _registry(spark, d):
    """The codes of verified facts of a chapter's depth, with their least name, as a register."""
    f = table(spark, d, "facts").where("verified and code is not null and kind is not null and name is not null")
    return f.where(F.size(F.split("code", r"\.")) <= 2).groupBy("kind", "code").agg(F.min("name").alias("official"))


def registry_chain(spark, d):
    """Every fact's entry in a register of verified chapters, and by which attempt it was found."""
    lines = table(spark, d, "facts").select("fact_id", "kind", "code", "name")
    return RG.matched(lines, _registry(spark, d), "fact_id").select("fact_id", "attempt", "matched_code", "official")


def unknown_codes(spark, d):
    """Facts whose code no attempt finds, counted by kind and chapter."""
    lines = table(spark, d, "facts").select("fact_id", "kind", "code", "name")
    lost = RG.unknown_codes(RG.matched(lines, _registry(spark, d), "fact_id"))
    return lost.groupBy("kind", F.substring_index("code", ".", 1).alias("chapter")).agg(F.count(F.lit(1)).alias("facts"))


def registry_stats(spark, d):
    """Entries by budget and kind of the facts' distinct codes."""
    return RG.registry_stats(table(spark, d, "facts").select("budget", "kind", "code").distinct())


def discordant_names(spark, d):
    """Facts whose name is unlike the register's for their code."""
    lines = table(spark, d, "facts").select("fact_id", "kind", "code", "name")
    return RG.discordant_names(RG.matched(lines, _registry(spark, d), "fact_id")).select("fact_id", "matched_code", "official", "score")


def control_totals(spark, d):
    """Orders whose lines' sum is off the printed total by more than a thousandth."""
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_extendedprice").cast(DEC).alias("v"))
    totals = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").cast(DEC).alias("v"))
    return EX.control_breaches(lines, totals, ["key"], "v").select("key", F.col("summed").cast(WIDE).alias("summed"), F.col("printed").cast(WIDE).alias("printed"), F.round("share", 6).alias("share"))


def period_snapshot(spark, d):
    """Each nation's latest quarter with its revenue, and how many quarters there are."""
    o = order_rows(spark, d).withColumn("period", F.concat_ws("-", F.year("o_orderdate").cast("string"), F.quarter("o_orderdate").cast("string")))
    blocks = o.groupBy("n_name", "period").agg(F.sum("price").cast(WIDE).alias("revenue"))
    return EX.snapshot(blocks, ["n_name"], "period", ["revenue"]).select("n_name", "period", "revenue", F.size("periods").cast("long").alias("periods"))


def _review_states(spark, d):
    p = table(spark, d, "page_reviews").select("review_id", "revision", F.concat_ws("|", "status", "source_unit", "number_notation", "note").alias("digest"))
    edge = lambda pick: p.groupBy("review_id").agg(pick("digest", "revision").alias("digest"))
    return edge(F.min_by), edge(F.max_by)


def ingest_changes(spark, d):
    """Reviews whose latest state isn't their first."""
    first, last = _review_states(spark, d)
    return EX.to_ingest(last, first, "review_id", "digest").select("review_id", "change")


def manifest_paths(spark, d):
    """One review revision of each document: a frozen one if there is any, else the first."""
    p = table(spark, d, "page_reviews").select("document", (F.col("review_id") * 1000 + F.col("revision")).alias("ord"), "status", "siruta")
    return MF.one_per_path(p, "document", F.col("status") == "frozen", "ord")


def manifest_upsert(spark, d):
    """The manifest's valid states with the snapshot's merged onto them."""
    keys = ["siruta", "year", "budget"]
    m, s = table(spark, d, "quality_manifest"), table(spark, d, "quality_snapshot")
    formed = lambda df, stamp: latest(df.where("siruta is not null and year is not null and budget is not null").select("siruta", F.col("year").cast("long").alias("year"), "budget", "status", "xlsx", F.col(stamp).alias("stamp")), keys, [F.col("stamp"), F.col("status"), F.col("xlsx")]).select(F.concat_ws("/", "siruta", F.col("year").cast("string"), "budget").alias("key"), "status", "xlsx")
    return MF.upserted(formed(m, "updated_at"), formed(s, "written_at"), "key", ["status", "xlsx"], error="error")


def carry_resets(spark, d):
    """Each event with the last sign-up since the user's last error, and how many errors there were."""
    e = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    return AS.with_resets(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", {"signup": F.when(F.col("event_type") == "signup", F.col("event_id"))}).select("event_id", "stretch", "signup")


def page_gaps(spark, d):
    """Reviewed pages of a document before which pages are missing."""
    p = table(spark, d, "page_reviews").where("page is not null").select("siruta", "document", "page").distinct()
    return p.withColumn("gap", AS.page_gap(["siruta", "document"], ["page"], "page")).where("gap").select("siruta", "document", F.col("page").cast("long").alias("page"))


def inferred_kinds(spark, d):
    """Every fact's kind as its code's facts suggest it."""
    f = table(spark, d, "facts").select("fact_id", "siruta", "code", "kind")
    n = f.where("code is not null and kind is not null").groupBy("code", "kind").agg(F.count(F.lit(1)).alias("n"))
    total = n.groupBy("code").agg(F.sum("n").alias("total"))
    scores = n.join(total, "code").select("code", "kind", (100.0 * F.col("n") / F.col("total")).alias("score"))
    lines = f.select("fact_id", "siruta", "code", F.lit(None).cast("string").alias("region_kind"))
    return AS.inferred_kind(lines, scores, ["siruta"], ["fact_id"], "code", "score").select("fact_id", "kind")


def accepted_readings(spark, d):
    """Orders whose lines, read anew, are all there and add up to the total."""
    l = table(spark, d, "lineitem").select("l_orderkey", F.col("l_extendedprice").cast(DEC).alias("value"), F.lit(1).alias("one"))
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast(DEC).alias("target"))
    n = l.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("expected"))
    r = l.join(n, "l_orderkey").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return RP.accepted_readings(r, ["l_orderkey"], "value", "expected", "target", "one").groupBy("reason").agg(F.count(F.lit(1)).alias("orders"), F.count_if("accepted").alias("accepted"))


def exact_sections(spark, d):
    """Nation-months whose finished and open orders add up to all orders to the last digit."""
    o = order_rows(spark, d).withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    total = o.groupBy("n_name", "month").agg(F.sum("price").cast(WIDE).alias("total"))
    parts = o.join(total, ["n_name", "month"]).select("n_name", "month", "o_orderstatus", "price", "total")
    return RP.exact_sections(parts, ["n_name", "month"], "o_orderstatus", "price", "total", ("F", "O")).select("n_name", "month", F.col("F").cast(WIDE).alias("f"), F.col("O").cast(WIDE).alias("o"))


def direct_children(spark, d):
    """Codes right below each code of a city's edition."""
    f = table(spark, d, "facts").where("siruta is not null").select("siruta", F.col("year").cast("long").alias("year"), "kind", "code")
    return RP.direct_children(f, ["siruta", "year", "kind"])


def draft_classes(spark, d):
    """Quantities of a part sold in two years, compared as two drafts."""
    l = table(spark, d, "lineitem").select("l_partkey", F.year("l_shipdate").alias("y"), F.col("l_quantity").cast("long").alias("q"))
    side = lambda y: l.where(F.col("y") == y).groupBy("l_partkey").agg(F.max("q").alias("q"))
    return MT.draft_classes(side(1998), side(1999), ["l_partkey"], "q", 1)


def match_scores(spark, d):
    """Recall and precision of accepted lines against returned ones, by brand and for all."""
    l = table(spark, d, "lineitem").select("l_partkey", F.col("l_quantity").cast("long").alias("quantity"), "l_returnflag", "l_orderkey", "l_linenumber", "l_suppkey")
    both = J.one_to_one(l.where("l_returnflag = 'A'"), l.where("l_returnflag = 'R'"), ["l_partkey", "quantity"], ["l_orderkey", "l_linenumber", "l_suppkey"])
    p = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    return MT.scored(both.join(p, both.l_partkey == p.p_partkey), ["brand"])


def by_precedence(spark, d):
    """Each part's highest price in the latest of three years that has one."""
    l = table(spark, d, "lineitem").select("l_partkey", F.year("l_shipdate").alias("y"), F.col("l_extendedprice").cast(DEC).alias("v"))
    return MT.by_precedence([(f"y{y}", l.where(F.col("y") == y).groupBy("l_partkey").agg(F.max("v").alias("v"))) for y in (2000, 1999, 1998)], ["l_partkey"], "v")


def staged_match(spark, d):
    """Suppliers with the one customer of their nation and rounded balance, else of their balance alone."""
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), F.floor("s_acctbal").cast("long").alias("balance"))
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), F.floor("c_acctbal").cast("long").alias("balance"))
    return MT.staged(s, c, "s_suppkey", "c_custkey", [(["nation", "balance"], "both"), (["balance"], "balance")])


def partition_check(spark, d):
    """Pages of a document that frozen reviews have twice or lack."""
    p = table(spark, d, "page_reviews").where("page is not null and siruta is not null and document is not null")
    valid = p.groupBy("review_id").agg(F.max(F.struct("revision", "siruta", "document", "page", "status")).alias("m")).select("m.*").where("status = 'frozen'")
    return MT.not_partitioned(p, valid, ["siruta", "document"], "page").withColumn("page", F.col("page").cast("long"))


def reviewed_ranges(spark, d):
    """Order lines with the context of the range they lie in: the priority for lines 2 to 4, nothing for urgent orders."""
    o = table(spark, d, "orders").select("o_orderkey", F.lit(2).cast("long").alias("first"), F.lit(4).cast("long").alias("last"), (F.substring("o_orderpriority", 1, 1) == "1").alias("clear"), F.col("o_orderpriority").alias("flag"))
    l = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").cast("long").alias("line"), "l_partkey", F.col("l_returnflag").alias("flag"))
    return MT.in_ranges(l, o, ["o_orderkey"], "line", ["flag"]).select("o_orderkey", "line", "l_partkey", "flag")


def page_profiles(spark, d):
    """Documents of each source with and without a text layer."""
    p = PG.page_profiles(table(spark, d, "documents"), ["source"], "doc_id", "text")
    return PG.profile_summary(p, ["source"])


def best_payload(spark, d):
    """One line of each order: of those with a quantity, the dearest, largest, lowest numbered."""
    l = table(spark, d, "lineitem").select("l_orderkey", F.col("l_extendedprice").cast(DEC).alias("score"), F.col("l_quantity").cast("long").alias("cells"), F.col("l_linenumber").cast("long").alias("place"))
    return PG.best_payload(l, ["l_orderkey"], "score", "cells", "place")


def stage_rates(spark, d):
    """Value an event of each type."""
    e = table(spark, d, "events").select("event_type", F.col("value").cast("decimal(18,2)").cast("double").alias("value"), F.lit(1).alias("one"))
    return MF.rates(e, "event_type", "value", "one").select("event_type", F.col("pages").alias("events"), F.round("rate", 4).alias("rate"))


def verified_priorities(spark, d):
    """Recorded pairs far off their city's median change, by how likely the new value is wrong."""
    m = table(spark, d, "matched_lines").where("old_value != 0")
    pairs = m.select("pair_id", "old_verified", "new_verified", F.concat_ws("/", "siruta", F.col("new_year").cast("string")).alias("edition"), F.col("old_value").cast("double").alias("old"), F.col("new_value").cast("double").alias("new")).withColumn("ratio", F.col("new") / F.col("old"))
    return X.by_verification(X.suspects(pairs, "edition"), F.col("old_verified"), F.col("new_verified")).select("pair_id", "edition", "signature", F.round(F.log10("priority"), 9).alias("priority"))


def chapter_sections(spark, d):
    """Functional chapters of each city and year with what is for running and what for building."""
    f = table(spark, d, "facts").where("kind = 'expense_functional' and column_name = 'total' and siruta is not null").select("siruta", F.col("year").cast("long").alias("year"), F.substring_index("code", ".", 2).alias("chapter"), F.upper(F.trim(F.coalesce("section", F.lit("TOTAL")))).alias("s"), F.col("value").cast("decimal(38,6)").alias("v"))
    part = lambda n: F.sum(F.when(F.col("s") == n, F.col("v"))).cast("decimal(38,6)")
    return f.groupBy("siruta", "year", "chapter").agg(part("TOTAL").alias("total"), part("FUNCTIONARE").alias("running"), part("DEZVOLTARE").alias("building"))


def review_timeline(spark, d):
    """First and last freezing of each year's pages, and how many there are."""
    p = table(spark, d, "page_reviews").where("frozen_at is not null").select("review_id", F.col("year").cast("long").alias("year"), F.to_date("frozen_at").cast("string").alias("day"))
    return p.groupBy("year").agg(F.min("day").alias("first"), F.max("day").alias("last"), F.count_distinct("review_id").alias("reviews"))


def result_stats(spark, d):
    """Facts, those without any issue, their share, and errors and warnings of each city and year."""
    f = table(spark, d, "facts").select("siruta", F.col("year").cast("long").alias("year"), F.coalesce("validation_issues", F.lit("")).alias("i"))
    has = lambda s: F.count_if(F.contains(F.col("i"), F.lit(f":{s}")))
    strict = F.count_if(F.trim("i") == "")
    return f.groupBy("siruta", "year").agg(F.count(F.lit(1)).alias("facts"), strict.alias("strict"), F.round(100.0 * strict / F.count(F.lit(1)), 1).alias("strict_share"), has("error").alias("errors"), has("warning").alias("warnings"))


def edition_deltas(spark, d):
    """What each city's lines add up to in the old and the new edition."""
    m = table(spark, d, "matched_lines").where("siruta is not null")
    g = m.groupBy("siruta", F.col("new_year").cast("long").alias("year")).agg(F.sum("old_value").cast("decimal(38,6)").alias("old"), F.sum("new_value").cast("decimal(38,6)").alias("new"))
    return g.select("siruta", "year", "old", "new", (F.col("new") - F.col("old")).cast("decimal(38,6)").alias("delta"))


def part_names_within_two(spark, d):
    """Pairs of part names at most two edits apart."""
    return J.within_edits(table(spark, d, "part"), "p_name", 2)


def labels_eval(spark, d):
    """Of each language told for documents: how well being over 400 letters long tells that a text is a report."""
    t = table(spark, d, "documents").where("text is not null").select("lang", (F.col("source") == "raport").alias("expected"), (F.length("text") > 400).alias("predicted"))
    return MT.scored(t.na.fill(False, ["expected"]).withColumn("lang", F.coalesce("lang", F.lit("none"))), ["lang"])


_REG = "r AS (SELECT kind, code, min(name) AS official FROM facts WHERE verified AND code IS NOT NULL AND kind IS NOT NULL AND name IS NOT NULL AND len(string_split(code, '.')) <= 2 GROUP BY 1, 2)"
_UP = lambda c: f"CASE WHEN len(string_split({c}, '.')) > 2 THEN array_to_string(string_split({c}, '.')[1:-2], '.') END"
_RE = "CASE WHEN len(string_split(code, '.')) >= 2 THEN array_to_string(list_concat(list_concat(string_split(code, '.')[1:1], ['02']), string_split(code, '.')[3:]), '.') END"
_CHAIN = f"""{_REG}, l AS (SELECT fact_id, kind, code, name, NOT coalesce(regexp_matches(lower(strip_accents(name)), '^\\s*(total|partea)\\b'), false) AND code IS NOT NULL AS asked, {_RE} AS re, CASE WHEN code LIKE '%.02' THEN left(code, length(code) - 3) END AS bare FROM facts),
  t AS (SELECT fact_id, kind, asked, unnest([1, 2, 3, 4, 5]) AS attempt, unnest([code, re, {_UP('code')}, {_UP('bare')}, {_UP('re')}]) AS c FROM l),
  h AS (SELECT fact_id, attempt, r.code AS matched_code, official, row_number() OVER (PARTITION BY fact_id ORDER BY attempt) AS k FROM t JOIN r ON r.code = t.c AND r.kind = t.kind WHERE asked),
  m AS (SELECT l.fact_id, l.kind, l.code, asked, attempt, matched_code, official FROM l LEFT JOIN (SELECT * FROM h WHERE k = 1) h USING (fact_id))"""
_L = "CAST(l_extendedprice AS DECIMAL(18,2))"
_PCT = "CASE WHEN expected > 0 THEN round(100 * matched / expected, 2) END AS recall, CASE WHEN predicted > 0 THEN round(100 * matched / predicted, 2) WHEN expected > 0 THEN 0.0 END AS precision"
_LAST = lambda t, stamp: f"(SELECT siruta || '/' || CAST(year AS BIGINT) || '/' || budget AS key, status, xlsx FROM (SELECT *, row_number() OVER (PARTITION BY siruta, year, budget ORDER BY {stamp} DESC NULLS LAST, status DESC NULLS LAST, xlsx DESC NULLS LAST) AS k FROM {t} WHERE siruta IS NOT NULL AND year IS NOT NULL AND budget IS NOT NULL) WHERE k = 1)"
SQL = {
    "registry_chain": f"WITH {_CHAIN} SELECT fact_id, CAST(attempt AS BIGINT) AS attempt, matched_code, official FROM m",
    "unknown_codes": f"WITH {_CHAIN} SELECT kind, string_split(code, '.')[1] AS chapter, count(*) AS facts FROM m WHERE asked AND attempt IS NULL GROUP BY 1, 2",
    "registry_stats": "SELECT budget, kind, count(*) AS entries, count(DISTINCT code) AS codes FROM (SELECT DISTINCT budget, kind, code FROM facts) GROUP BY 1, 2",
    "control_totals": f"""WITH s AS (SELECT l_orderkey AS key, SUM({_L}) AS s FROM lineitem GROUP BY 1), b AS (SELECT o_orderkey AS key, coalesce(s, 0) AS summed, {_P} AS printed FROM orders LEFT JOIN s ON key = o_orderkey WHERE {_P} <> 0)
      SELECT key, CAST(summed AS DECIMAL(38,2)) AS summed, CAST(printed AS DECIMAL(38,2)) AS printed, round(abs(summed::DOUBLE - printed::DOUBLE) / abs(printed::DOUBLE), 6) AS share FROM b WHERE abs(summed::DOUBLE - printed::DOUBLE) / abs(printed::DOUBLE) > 0.001""",
    "period_snapshot": f"""WITH b AS (SELECT n_name, year(o_orderdate) || '-' || quarter(o_orderdate) AS period, CAST(SUM({_P}) AS DECIMAL(38,2)) AS revenue FROM {_OR} GROUP BY 1, 2)
      SELECT n_name, max(period) AS period, max_by(revenue, period) AS revenue, count(*) AS periods FROM b GROUP BY 1""",
    "ingest_changes": """WITH p AS (SELECT review_id, revision, concat_ws('|', status, source_unit, number_notation, note) AS digest FROM page_reviews), s AS (SELECT review_id, min_by(digest, revision) AS a, max_by(digest, revision) AS b FROM p GROUP BY 1)
      SELECT review_id, 'changed' AS change FROM s WHERE a <> b""",
    "manifest_paths": """WITH p AS (SELECT document, review_id * 1000 + revision AS ord, status, siruta FROM page_reviews), n AS (SELECT *, min(ord) OVER (PARTITION BY document) AS place, row_number() OVER (PARTITION BY document ORDER BY (coalesce(status, '') <> 'frozen')::INT, ord) AS k FROM p WHERE document IS NOT NULL)
      SELECT document, place AS ord, status, siruta FROM n WHERE k = 1 UNION ALL SELECT document, ord, status, siruta FROM p WHERE document IS NULL""",
    "manifest_upsert": f"SELECT coalesce(m.key, s.key) AS key, coalesce(s.status, m.status) AS status, coalesce(s.xlsx, m.xlsx) AS xlsx FROM {_LAST('quality_manifest', 'updated_at')} m FULL JOIN {_LAST('quality_snapshot', 'written_at')} s ON m.key = s.key",
    "carry_resets": """WITH s AS (SELECT event_id, ts, user_id, event_type, CAST(SUM((event_type = 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stretch FROM events)
      SELECT event_id, stretch, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id, stretch ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS signup FROM s""",
    "page_gaps": """SELECT siruta, document, CAST(page AS BIGINT) AS page FROM (SELECT *, lag(page) OVER (PARTITION BY siruta, document ORDER BY page) AS b FROM (SELECT DISTINCT siruta, document, page FROM page_reviews WHERE page IS NOT NULL)) WHERE page - b > 1""",
    "inferred_kinds": """WITH n AS (SELECT code, kind, count(*) AS n FROM facts WHERE code IS NOT NULL AND kind IS NOT NULL GROUP BY 1, 2), w AS (SELECT code, kind, 100.0 * n / SUM(n) OVER (PARTITION BY code) AS score FROM n), s AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY score DESC, kind DESC) AS k, count(*) OVER (PARTITION BY code) AS kinds FROM w),
      b AS (SELECT a.code, CASE WHEN a.kinds = 1 THEN a.kind WHEN a.score >= 60 AND a.score - coalesce(c.score, 0) >= 15 THEN a.kind END AS own FROM s a LEFT JOIN s c ON c.code = a.code AND c.k = 2 WHERE a.k = 1), l AS (SELECT fact_id, siruta, own FROM facts LEFT JOIN b USING (code))
      SELECT fact_id, coalesce(own, last_value(own IGNORE NULLS) OVER (PARTITION BY siruta ORDER BY fact_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'revenue') AS kind FROM l""",
    "accepted_readings": f"""WITH s AS (SELECT l_orderkey, SUM({_L}) AS s, count(*) AS n FROM lineitem GROUP BY 1), r AS (SELECT CASE WHEN abs(s - {_P}) <= 0.01 * greatest(n, 2) THEN 'closes' ELSE 'sum' END AS reason FROM s JOIN orders ON o_orderkey = l_orderkey)
      SELECT reason, count(*) AS orders, count(*) FILTER (reason = 'closes') AS accepted FROM r GROUP BY 1""",
    "exact_sections": f"""WITH s AS (SELECT n_name, strftime(o_orderdate, '%Y-%m') AS month, SUM({_P}) FILTER (o_orderstatus = 'F') AS f, SUM({_P}) FILTER (o_orderstatus = 'O') AS o, SUM({_P}) AS t FROM {_OR} GROUP BY 1, 2)
      SELECT n_name, month, CAST(f AS DECIMAL(38,2)) AS f, CAST(o AS DECIMAL(38,2)) AS o FROM s WHERE f <> 0 AND o <> 0 AND f + o = t""",
    "direct_children": """WITH c AS (SELECT DISTINCT siruta, CAST(year AS BIGINT) AS year, kind, code FROM facts WHERE siruta IS NOT NULL AND code IS NOT NULL)
      SELECT p.siruta, p.year, p.kind, p.code, x.code AS child FROM c p JOIN c x ON x.siruta = p.siruta AND x.year = p.year AND x.kind = p.kind AND len(string_split(x.code, '.')) >= 2 AND array_to_string(string_split(x.code, '.')[1:-2], '.') = p.code""",
    "draft_classes": """WITH q AS (SELECT l_partkey, year(l_shipdate) AS y, max(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY 1, 2)
      SELECT l_partkey, a.q AS first_value, b.q AS second_value, CASE WHEN a.q IS NULL OR b.q IS NULL THEN 'single_source' WHEN abs(a.q - b.q) <= 1 THEN 'confirmed' ELSE 'conflicting' END AS class FROM (SELECT l_partkey, q FROM q WHERE y = 1998) a FULL JOIN (SELECT l_partkey, q FROM q WHERE y = 1999) b USING (l_partkey)""",
    "match_scores": f"""WITH n AS (SELECT l_partkey, CAST(l_quantity AS BIGINT) AS quantity, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1, 2),
      g AS (SELECT p_brand AS brand, CAST(grouping(p_brand) AS BIGINT) AS level, CAST(SUM(a) AS BIGINT) AS expected, CAST(SUM(r) AS BIGINT) AS predicted, CAST(SUM(least(a, r)) AS BIGINT) AS matched FROM n JOIN part ON p_partkey = l_partkey WHERE a + r > 0 GROUP BY GROUPING SETS ((p_brand), ())) SELECT *, {_PCT} FROM g""",
    "by_precedence": f"""WITH m AS (SELECT l_partkey, year(l_shipdate) AS y, max({_L}) AS v FROM lineitem WHERE year(l_shipdate) IN (1998, 1999, 2000) GROUP BY 1, 2) SELECT l_partkey, max_by(v, y) AS v, 'y' || max(y) AS method, count(*) - 1 AS also FROM m GROUP BY 1""",
    "staged_match": """WITH s AS (SELECT s_suppkey, s_nationkey AS n, CAST(floor(s_acctbal) AS BIGINT) AS b FROM supplier), c AS (SELECT c_custkey, c_nationkey AS n, CAST(floor(c_acctbal) AS BIGINT) AS b FROM customer),
      f AS (SELECT s_suppkey, c_custkey FROM (SELECT n, b, min(s_suppkey) AS s_suppkey FROM s GROUP BY 1, 2 HAVING count(*) = 1) JOIN (SELECT n, b, min(c_custkey) AS c_custkey FROM c GROUP BY 1, 2 HAVING count(*) = 1) USING (n, b)),
      s2 AS (SELECT * FROM s WHERE s_suppkey NOT IN (SELECT s_suppkey FROM f)), c2 AS (SELECT * FROM c WHERE c_custkey NOT IN (SELECT c_custkey FROM f))
      SELECT s_suppkey, c_custkey, 'both' AS stage FROM f UNION ALL SELECT s_suppkey, c_custkey, 'balance' FROM (SELECT b, min(s_suppkey) AS s_suppkey FROM s2 GROUP BY 1 HAVING count(*) = 1) JOIN (SELECT b, min(c_custkey) AS c_custkey FROM c2 GROUP BY 1 HAVING count(*) = 1) USING (b)""",
    "partition_check": """WITH p AS (SELECT * FROM page_reviews WHERE page IS NOT NULL AND siruta IS NOT NULL AND document IS NOT NULL), a AS (SELECT DISTINCT siruta, document, page FROM p), v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY revision DESC) AS k FROM p) WHERE k = 1 AND status = 'frozen'),
      c AS (SELECT siruta, document, page, count(*) AS n FROM v GROUP BY ALL) SELECT siruta, document, CAST(page AS BIGINT) AS page, CASE WHEN n IS NULL THEN 'missing' ELSE 'repeated' END AS problem FROM a LEFT JOIN c USING (siruta, document, page) WHERE n IS NULL OR n > 1""",
    "reviewed_ranges": """SELECT l_orderkey AS o_orderkey, CAST(l_linenumber AS BIGINT) AS line, l_partkey, CASE WHEN o_orderkey IS NOT NULL AND l_linenumber BETWEEN 2 AND 4 THEN CASE WHEN left(o_orderpriority, 1) = '1' THEN NULL ELSE coalesce(o_orderpriority, l_returnflag) END ELSE l_returnflag END AS flag FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""",
    "page_profiles": r"""WITH p AS (SELECT source, length(regexp_replace(coalesce(text, ''), '[ \t\n\v\f\r]+', '', 'g')) > 20 AS t FROM documents) SELECT source, count(*) AS pages, count(*) FILTER (t) AS with_text, count(*) FILTER (t) < count(*) / 2 AS mostly_scanned FROM p GROUP BY 1""",
    "best_payload": f"""SELECT l_orderkey, score, cells, place FROM (SELECT l_orderkey, {_L} AS score, CAST(l_quantity AS BIGINT) AS cells, CAST(l_linenumber AS BIGINT) AS place, row_number() OVER (PARTITION BY l_orderkey ORDER BY (l_quantity > 0)::INT DESC, {_L} DESC, CAST(l_quantity AS BIGINT) DESC, l_linenumber) AS k FROM lineitem) WHERE k = 1""",
    "stage_rates": "SELECT event_type, count(*) AS events, CASE WHEN count(*) >= 5 THEN round(SUM(CAST(value AS DECIMAL(18,2))::DOUBLE) / count(*), 4) END AS rate FROM events GROUP BY 1",
    "verified_priorities": """WITH p AS (SELECT pair_id, old_verified, new_verified, siruta || '/' || new_year AS edition, old_value::DOUBLE AS old, new_value::DOUBLE AS new, new_value::DOUBLE / old_value::DOUBLE AS ratio FROM matched_lines WHERE old_value <> 0), m AS (SELECT edition, median(ratio) AS med FROM p GROUP BY 1 HAVING count(*) >= 20),
      s AS (SELECT p.*, ratio / med AS rel FROM p JOIN m USING (edition) WHERE med <> 0), t AS (SELECT *, CASE WHEN rel > 0 THEN greatest(rel, 1 / rel) ELSE 0 END AS dev, least(abs(rel / 0.001 - 1), abs(rel / 0.01 - 1), abs(rel / 0.1 - 1), abs(rel / 10 - 1), abs(rel / 100 - 1), abs(rel / 1000 - 1)) <= 0.02 AS shift FROM s)
      SELECT pair_id, edition, CASE WHEN shift THEN 'decimal_shift' ELSE 'outlier' END AS signature, round(log10(dev * CASE WHEN shift THEN 2 ELSE 1 END * (1 + pow(greatest(abs(old), abs(new)), 0.25)) * CASE WHEN coalesce(old_verified, false) AND NOT coalesce(new_verified, false) THEN 4 WHEN coalesce(old_verified, false) THEN 0.5 ELSE 1 END), 9) AS priority FROM t WHERE dev >= 8""",
    "chapter_sections": """WITH f AS (SELECT siruta, CAST(year AS BIGINT) AS year, array_to_string(string_split(code, '.')[1:2], '.') AS chapter, upper(trim(coalesce(section, 'TOTAL'))) AS s, value AS v FROM facts WHERE kind = 'expense_functional' AND column_name = 'total' AND siruta IS NOT NULL)
      SELECT siruta, year, chapter, CAST(SUM(v) FILTER (s = 'TOTAL') AS DECIMAL(38,6)) AS total, CAST(SUM(v) FILTER (s = 'FUNCTIONARE') AS DECIMAL(38,6)) AS running, CAST(SUM(v) FILTER (s = 'DEZVOLTARE') AS DECIMAL(38,6)) AS building FROM f GROUP BY 1, 2, 3""",
    "review_timeline": "SELECT CAST(year AS BIGINT) AS year, CAST(min(frozen_at)::DATE AS VARCHAR) AS first, CAST(max(frozen_at)::DATE AS VARCHAR) AS last, count(DISTINCT review_id) AS reviews FROM page_reviews WHERE frozen_at IS NOT NULL GROUP BY 1",
    "result_stats": """WITH f AS (SELECT siruta, CAST(year AS BIGINT) AS year, coalesce(validation_issues, '') AS i FROM facts) SELECT siruta, year, count(*) AS facts, count(*) FILTER (trim(i) = '') AS strict, round(100.0 * count(*) FILTER (trim(i) = '') / count(*), 1) AS strict_share, count(*) FILTER (contains(i, ':error')) AS errors, count(*) FILTER (contains(i, ':warning')) AS warnings FROM f GROUP BY 1, 2""",
    "edition_deltas": "SELECT siruta, CAST(new_year AS BIGINT) AS year, CAST(SUM(old_value) AS DECIMAL(38,6)) AS old, CAST(SUM(new_value) AS DECIMAL(38,6)) AS new, CAST(SUM(new_value) - SUM(old_value) AS DECIMAL(38,6)) AS delta FROM matched_lines WHERE siruta IS NOT NULL GROUP BY 1, 2",
    "part_names_within_two": "WITH s AS (SELECT DISTINCT p_name AS n FROM part WHERE p_name IS NOT NULL) SELECT a.n AS a, b.n AS b FROM s a JOIN s b ON a.n < b.n AND levenshtein(a.n, b.n) <= 2",
    "labels_eval": f"""WITH t AS (SELECT coalesce(lang, 'none') AS lang, coalesce(source = 'raport', false) AS e, length(text) > 400 AS p FROM documents WHERE text IS NOT NULL),
      g AS (SELECT lang, CAST(grouping(lang) AS BIGINT) AS level, count(*) FILTER (e) AS expected, count(*) FILTER (p) AS predicted, count(*) FILTER (e AND p) AS matched FROM t GROUP BY GROUPING SETS ((lang), ())) SELECT *, {_PCT} FROM g""",
}
QUERIES = {
    f.__name__: f
    for f in (
        registry_chain, unknown_codes, registry_stats, discordant_names, control_totals, period_snapshot, ingest_changes, manifest_paths, manifest_upsert, carry_resets, page_gaps, inferred_kinds, accepted_readings, exact_sections, direct_children, draft_classes,
        match_scores, by_precedence, staged_match, partition_check, reviewed_ranges, page_profiles, best_payload, stage_rates, verified_priorities, chapter_sections, review_timeline, result_stats, edition_deltas, part_names_within_two, labels_eval,
    )
}
