"""Queries over the domain's own tables: facts, reviews, matched lines, analytics rows; with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import codes as C
from ledgerloom.functions import numbers as N
from ledgerloom.operators import aggregates as A
from ledgerloom.operators import crossperiod as X
from ledgerloom.operators import rules as R
from ledgerloom.operators import windows as WN
from ledgerloom.session import table

MONEY = "decimal(38,6)"
LINE = ["siruta", "suffix", "section", "kind", "code", "func_code", "column_name"]


def _facts(spark, d):
    """facts with the values in mii lei by their label (numbers.unit_exponent, the one unit rule); a missing or unitless label counts as mii lei, missing key parts as ''."""
    f = table(spark, d, "facts").where("siruta is not null and year is not null and value is not null")
    exponent = F.coalesce(N.unit_exponent(F.col("unit")), F.lit(0))
    return f.select("fact_id", F.col("year").cast("long").alias("year"), *[F.coalesce(c, F.lit("")).alias(c) for c in LINE], N.times_ten_to(F.col("value"), exponent).alias("value"), "verified", "source", "page")


def edition_lines(spark, d):
    """The first exported fact of each line and edition, of size 1 or more."""
    f = _facts(spark, d).where("code != '' and abs(value) >= 1").select(*LINE, "year", "fact_id", "value")
    return WN.first_wins(f, [*LINE, "year"], ["fact_id"])


def crossyear_suspects(spark, d):
    """Lines of consecutive editions whose change is far from the median change of their city."""
    e = edition_lines(spark, d)
    old = e.withColumn("year", F.col("year") + 1)
    pairs = X.matched(old, e, [*LINE, "year"], "value").withColumn("edition", F.concat_ws("/", "siruta", F.col("year").cast("string")))
    s = X.suspects(pairs, "edition")
    return s.select("edition", "code", "func_code", "column_name", "suffix", "section", "kind", F.round(F.log10("relative"), 9).alias("magnitude"), "signature", F.round(F.log10("priority"), 9).alias("priority"))


def crossyear_summary(spark, d):
    e = edition_lines(spark, d)
    pairs = X.matched(e.withColumn("year", F.col("year") + 1), e, [*LINE, "year"], "value").withColumn("edition", F.concat_ws("/", "siruta", F.col("year").cast("string")))
    return X.summary(pairs, "edition").withColumn("median_ratio", F.round("median_ratio", 6))


def matched_priorities(spark, d):
    """Recorded pairs with their ratio against the city's median, near powers of ten marked."""
    m = table(spark, d, "matched_lines").where("old_value != 0")
    pairs = m.select("pair_id", F.concat_ws("/", "siruta", F.col("new_year").cast("string")).alias("edition"), F.col("old_value").cast("double").alias("old"), F.col("new_value").cast("double").alias("new")).withColumn("ratio", F.col("new") / F.col("old"))
    return X.suspects(pairs, "edition").select("pair_id", "edition", F.round(F.log10("relative"), 9).alias("magnitude"), "signature")


def city_totals(spark, d):
    """Largest revenue total and largest expense total of each city and year, sections of the total only."""
    f = _facts(spark, d).where("column_name = 'total' and value > 0").where(~F.upper(F.trim("section")).isin("FUNCTIONARE", "DEZVOLTARE"))
    part = lambda k: F.max(F.when(F.col("kind") == k, F.col("value")))
    return f.groupBy("siruta", "year").agg(part("revenue").alias("revenue"), F.greatest(part("expense_functional"), part("expense_economic")).alias("expense"))


def top_chapters(spark, d):
    """The ten largest functional chapters of each city and year."""
    f = _facts(spark, d).where("kind = 'expense_functional' and column_name = 'total'").withColumn("chapter", C.chapter(F.col("code")))
    sums = f.groupBy("siruta", "year", "chapter").agg(F.sum("value").cast(MONEY).alias("total"))
    return A.top_k(sums, ["siruta", "year"], "total", ["chapter"], 10)


def fact_hierarchy(spark, d):
    """Facts of a code that aren't the sum of the facts of the codes right below it."""
    keys = ["siruta", "year", "suffix", "section", "kind", "column_name"]
    f = _facts(spark, d).groupBy(*keys, "code").agg(F.sum("value").cast(MONEY).alias("value"))
    children = f.withColumn("parent", C.parent_code(F.col("code"), F.col("kind"))).where("parent is not null").select(*keys, F.col("parent").alias("at"), F.col("value").alias("child_value"))
    parents = f.select(*keys, F.col("code").alias("at"), F.col("value").alias("parent_value"))
    return R.hierarchy(parents, children, [*keys, "at"]).select(*keys, F.col("at").alias("code"), F.col("difference").cast(MONEY).alias("difference"), "terms")


def per_capita_ranks(spark, d):
    """Revenue per inhabitant of each city and year, ranked among the rows that have both, with the change against the year before that has one."""
    a = table(spark, d, "analytics_rows").select("row_id", F.col("year").cast("long").alias("year"), "siruta", "county_code", F.col("population").cast("long").alias("population"), F.col("planned_revenue_mii_lei").cast("decimal(18,3)").alias("revenue"))
    value = F.when(F.col("population") > 0, F.round(F.col("revenue").cast("double") * 1000 / F.col("population"), 2))
    has = F.col("lei_per_capita").isNotNull()
    ranked = WN.rank_cohort(a.withColumn("lei_per_capita", value), ["year"], "lei_per_capita", has)
    told = WN.previous_eligible(ranked, ["siruta"], "year", "lei_per_capita", has)
    change = F.when(has & (F.col("previous") != 0), F.round((F.col("lei_per_capita") - F.col("previous")) / F.col("previous") * 100, 2))
    return told.select("row_id", "lei_per_capita", "rank", "cohort", "previous_year", change.alias("change"))


def analytics_with_regions(spark, d):
    """Analytics rows with their municipality's register entry; rows without one stay."""
    a = table(spark, d, "analytics_rows").select("row_id", "siruta", F.col("area_km2").alias("told"))
    m = table(spark, d, "municipalities").select("siruta", F.col("county").alias("register_county"), F.col("area_km2").alias("registered"), F.col("population").cast("long").alias("register_population"))
    j = a.join(m, "siruta", "left")
    density = F.when(F.col("registered") > 0, F.round(F.col("register_population") / F.col("registered"), 2))
    return j.select("row_id", "register_county", (F.abs(F.col("told") - F.col("registered")) <= 0.05).alias("same_area"), density.alias("density"))


def current_reviews(spark, d):
    """The valid revision of each page review, and how many it supersedes."""
    p = table(spark, d, "page_reviews").select("review_id", F.col("revision").cast("long").alias("revision"), "siruta", "page_kind", "status", "source_unit")
    latest = p.groupBy("review_id").agg(F.max(F.struct("revision", "siruta", "page_kind", "status", "source_unit")).alias("m"), (F.count(F.lit(1)) - 1).alias("superseded"))
    return latest.select("review_id", "m.*", "superseded")


def review_counts(spark, d):
    """Valid reviews of each page kind by status."""
    r = current_reviews(spark, d)
    names = [f"n_{s}" for s in ("frozen", "classified", "draft")]
    return r.groupBy("page_kind").agg(F.count(F.lit(1)).alias("pages"), *[F.count_if(F.col("status") == n[2:]).alias(n) for n in names])


def page_runs(spark, d):
    """Pages reviewed of each city and document as ranges."""
    p = table(spark, d, "page_reviews").where("page is not null").select("siruta", "document", "page")
    return WN.compact_ranges(WN.islands(p, ["siruta", "document"], "page"), ["siruta", "document"])


def reading_scores(spark, d):
    """Of each role: cells read, cells read as the frozen print, and the share; both numbers compared as such."""
    truth = table(spark, d, "annotation_values").where("normalized_mii_lei is not null").select("value_id", N.printed_number(N.number_part(F.col("printed"))).alias("truth")).where("truth is not null")
    read = table(spark, d, "cell_readings").where("value is not null").select("value_id", "role", N.printed_number(F.col("value")).alias("seen")).where("seen is not null")
    j = read.join(truth, "value_id")
    return j.groupBy("role").agg(F.count(F.lit(1)).alias("readings"), F.count_if(F.col("seen") == F.col("truth")).alias("equal")).withColumn("share", F.round(100 * F.col("equal") / F.col("readings"), 2))


def fact_sources(spark, d):
    """Sources of each city and year in order, and `mixed` where there are several."""
    f = table(spark, d, "facts").where("source is not null").groupBy("siruta", F.col("year").cast("long").alias("year")).agg(F.array_sort(F.collect_set("source")).alias("s"))
    return f.select("siruta", "year", F.array_join("s", ",").alias("sources"), F.when(F.size("s") > 1, "mixed").otherwise(F.get("s", F.lit(0))).alias("source"))


def manifest_status(spark, d):
    """Valid state of every artifact counted by status and year, with totals of the year and of all."""
    from ledgerloom.operators import diff

    m = diff.latest(table(spark, d, "quality_manifest").select("siruta", F.col("year").cast("long").alias("year"), "budget", "status", F.col("lines").cast("long").alias("lines"), "updated_at", "revision"), ["siruta", "year", "budget"], [F.col("updated_at"), F.col("revision")])
    r = m.rollup("year", "status").agg(F.count(F.lit(1)).alias("artifacts"), F.sum("lines").alias("lines"), (F.grouping("year") * 2 + F.grouping("status")).cast("long").alias("level"))
    return r


_F = """f AS (SELECT fact_id, CAST(year AS BIGINT) AS year, coalesce(siruta, '') AS siruta, coalesce(suffix, '') AS suffix, coalesce(section, '') AS section, coalesce(kind, '') AS kind, coalesce(code, '') AS code, coalesce(func_code, '') AS func_code, coalesce(column_name, '') AS column_name,
  CAST(value::DECIMAL(28,6) * (CASE WHEN unit IS NULL OR NOT regexp_matches(lower(unit), '(lei|leu|ron)') THEN 1 WHEN regexp_matches(lower(unit), '(^|[^a-z])(miliard|mld)') THEN 1000000 WHEN regexp_matches(lower(unit), '(^|[^a-z])(mil[.]|milio|mln|mio)') THEN 1000
    WHEN regexp_matches(lower(unit), '(^|[^a-z])(mii|mie|k |ezer|thousand)') THEN 1 ELSE 0.001 END)::DECIMAL(10,3) AS DECIMAL(38,6)) AS value FROM facts WHERE siruta IS NOT NULL AND year IS NOT NULL AND value IS NOT NULL)"""
_E = f"""{_F}, e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY siruta, suffix, section, kind, code, func_code, column_name, year ORDER BY fact_id) AS k FROM f WHERE code <> '' AND abs(value) >= 1) WHERE k = 1),
  p AS (SELECT n.*, n.siruta || '/' || n.year AS edition, o.value::DOUBLE AS old, n.value::DOUBLE AS new, n.value::DOUBLE / o.value::DOUBLE AS ratio FROM e o JOIN e n USING (siruta, suffix, section, kind, code, func_code, column_name) WHERE n.year = o.year + 1),
  m AS (SELECT edition, count(*) AS matched, median(ratio) AS med FROM p GROUP BY 1 HAVING count(*) >= 20)"""
_DEV = "CASE WHEN rel > 0 THEN greatest(rel, 1 / rel) ELSE 0 END"
_SHIFT = "least(abs(rel / 0.001 - 1), abs(rel / 0.01 - 1), abs(rel / 0.1 - 1), abs(rel / 10 - 1), abs(rel / 100 - 1), abs(rel / 1000 - 1)) <= 0.02"
_NUMBER = lambda c: f"""CASE WHEN regexp_full_match({c}, '-?[0-9]+([.][0-9]*)?|-?[.][0-9]+') THEN TRY_CAST({c} AS DECIMAL(38,6)) END"""
_READ = lambda c: f"""(SELECT CASE WHEN contains(t, ',') THEN replace(replace(t, '.', ''), ',', '.') ELSE t END FROM (SELECT CASE WHEN regexp_full_match(u, '[(].*[)]') THEN '-' || regexp_replace(u, '[()]', '', 'g') ELSE u END AS t FROM (SELECT regexp_replace(regexp_replace({c}, '[\\s\\x{{00A0}}\\x{{2000}}-\\x{{200B}}\\x{{202F}}]', '', 'g'), '[−–]', '-', 'g') AS u)))"""
SQL = {
    "reading_scores": f"""WITH a AS (SELECT value_id, {_READ("regexp_extract(printed, '[(]?[-−]?[0-9][0-9.,\\s\\x{00A0}\\x{202F}]*[0-9][)]?|[-−]?[0-9]')")} AS x FROM annotation_values WHERE normalized_mii_lei IS NOT NULL), t AS (SELECT value_id, {_NUMBER('x')} AS truth FROM a),
      r AS (SELECT value_id, role, {_READ('value')} AS x FROM cell_readings WHERE value IS NOT NULL), s AS (SELECT value_id, role, {_NUMBER('x')} AS seen FROM r)
      SELECT role, count(*) AS readings, count(*) FILTER (seen = truth) AS equal, round(100 * count(*) FILTER (seen = truth) / count(*), 2) AS share FROM s JOIN t USING (value_id) WHERE truth IS NOT NULL AND seen IS NOT NULL GROUP BY 1""",
    "edition_lines": f"WITH {_E} SELECT siruta, suffix, section, kind, code, func_code, column_name, year, fact_id, value FROM e",
    "crossyear_suspects": f"""WITH {_E}, s AS (SELECT p.*, ratio / med AS rel FROM p JOIN m USING (edition) WHERE med <> 0)
      SELECT edition, code, func_code, column_name, suffix, section, kind, round(log10(rel), 9) AS magnitude, CASE WHEN {_SHIFT} THEN 'decimal_shift' ELSE 'outlier' END AS signature,
        round(log10({_DEV} * CASE WHEN {_SHIFT} THEN 2 ELSE 1 END * (1 + pow(greatest(abs(old), abs(new)), 0.25))), 9) AS priority FROM s WHERE {_DEV} >= 8""",
    "crossyear_summary": f"WITH {_E} SELECT edition, matched, round(med, 6) AS median_ratio, CAST(CASE WHEN abs(med / 1000 - 1) <= 0.05 THEN 1000 WHEN abs(med / 0.001 - 1) <= 0.05 THEN 1 END AS BIGINT) AS unit_shift FROM m",
    "matched_priorities": f"""WITH p AS (SELECT pair_id, siruta || '/' || new_year AS edition, new_value::DOUBLE / old_value::DOUBLE AS ratio FROM matched_lines WHERE old_value <> 0), m AS (SELECT edition, median(ratio) AS med FROM p GROUP BY 1 HAVING count(*) >= 20),
      s AS (SELECT pair_id, edition, ratio / med AS rel FROM p JOIN m USING (edition) WHERE med <> 0) SELECT pair_id, edition, round(log10(rel), 9) AS magnitude, CASE WHEN {_SHIFT} THEN 'decimal_shift' ELSE 'outlier' END AS signature FROM s WHERE {_DEV} >= 8""",
    "city_totals": f"""WITH {_F} SELECT siruta, year, max(value) FILTER (kind = 'revenue') AS revenue, greatest(max(value) FILTER (kind = 'expense_functional'), max(value) FILTER (kind = 'expense_economic')) AS expense
      FROM f WHERE column_name = 'total' AND value > 0 AND upper(trim(section)) NOT IN ('FUNCTIONARE', 'DEZVOLTARE') GROUP BY 1, 2""",
    "top_chapters": f"""WITH {_F}, s AS (SELECT siruta, year, array_to_string(string_split(code, '.')[1:2], '.') AS chapter, CAST(SUM(value) AS DECIMAL(38,6)) AS total FROM f WHERE kind = 'expense_functional' AND column_name = 'total' GROUP BY 1, 2, 3)
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY siruta, year ORDER BY total DESC, chapter) AS place FROM s) WHERE place <= 10""",
    "fact_hierarchy": f"""WITH {_F}, g AS (SELECT siruta, year, suffix, section, kind, column_name, code, SUM(value) AS value, len(string_split(code, '.')) AS depth, array_to_string(string_split(code, '.')[1:-2], '.') AS up FROM f GROUP BY ALL),
      c AS (SELECT siruta, year, suffix, section, kind, column_name, up AS code, SUM(value) AS s, count(*) AS terms FROM g WHERE depth > 2 OR (kind = 'expense_economic' AND depth = 2) GROUP BY ALL)
      SELECT siruta, year, suffix, section, kind, column_name, code, CAST(value - s AS DECIMAL(38,6)) AS difference, terms FROM g JOIN c USING (siruta, year, suffix, section, kind, column_name, code) WHERE abs(value - s) > 0.01 * greatest(terms, 2) AND NOT (s = 0 AND value <> 0)""",
    "per_capita_ranks": """WITH a AS (SELECT row_id, year, siruta, CASE WHEN population > 0 THEN round(CAST(planned_revenue_mii_lei AS DECIMAL(18,3))::DOUBLE * 1000 / population, 2) END AS v FROM analytics_rows),
      r AS (SELECT row_id, rank() OVER (PARTITION BY year ORDER BY v DESC) AS rank, count(*) OVER (PARTITION BY year) AS cohort FROM a WHERE v IS NOT NULL),
      b AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN {'v': v, 'y': year} END IGNORE NULLS) OVER (PARTITION BY siruta ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM a)
      SELECT b.row_id, v AS lei_per_capita, r.rank, r.cohort, CAST(p.y AS BIGINT) AS previous_year, CASE WHEN v IS NOT NULL AND p.v <> 0 THEN round((v - p.v) / p.v * 100, 2) END AS change FROM b LEFT JOIN r USING (row_id)""",
    "analytics_with_regions": "SELECT row_id, m.county AS register_county, abs(a.area_km2 - m.area_km2) <= 0.05 AS same_area, CASE WHEN m.area_km2 > 0 THEN round(m.population / m.area_km2, 2) END AS density FROM analytics_rows a LEFT JOIN municipalities m USING (siruta)",
    "current_reviews": "SELECT review_id, CAST(revision AS BIGINT) AS revision, siruta, page_kind, status, source_unit, n - 1 AS superseded FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY revision DESC) AS k, count(*) OVER (PARTITION BY review_id) AS n FROM page_reviews) WHERE k = 1",
    "review_counts": """SELECT page_kind, count(*) AS pages, count(*) FILTER (status = 'frozen') AS n_frozen, count(*) FILTER (status = 'classified') AS n_classified, count(*) FILTER (status = 'draft') AS n_draft
      FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY revision DESC) AS k FROM page_reviews) WHERE k = 1 GROUP BY 1""",
    "page_runs": """WITH d AS (SELECT DISTINCT siruta, document, CAST(page AS BIGINT) AS page FROM page_reviews WHERE page IS NOT NULL), r AS (SELECT *, page - row_number() OVER (PARTITION BY siruta, document ORDER BY page) AS run FROM d),
      i AS (SELECT siruta, document, min(page) AS a, max(page) AS b FROM r GROUP BY siruta, document, run) SELECT siruta, document, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ',' ORDER BY a) AS spec FROM i GROUP BY 1, 2""",
    "fact_sources": "WITH s AS (SELECT siruta, CAST(year AS BIGINT) AS year, list_sort(list(DISTINCT source)) AS s FROM facts WHERE source IS NOT NULL GROUP BY 1, 2) SELECT siruta, year, array_to_string(s, ',') AS sources, CASE WHEN len(s) > 1 THEN 'mixed' ELSE s[1] END AS source FROM s",
    "manifest_status": """SELECT CAST(year AS BIGINT) AS year, status, count(*) AS artifacts, CAST(SUM(lines) AS BIGINT) AS lines, CAST(grouping(year) * 2 + grouping(status) AS BIGINT) AS level
      FROM (SELECT *, row_number() OVER (PARTITION BY siruta, year, budget ORDER BY updated_at DESC, revision DESC) AS k FROM quality_manifest) WHERE k = 1 GROUP BY ROLLUP (year, status)""",
}
QUERIES = {f.__name__: f for f in (edition_lines, crossyear_suspects, crossyear_summary, matched_priorities, city_totals, top_chapters, fact_hierarchy, per_capita_ranks, analytics_with_regions, current_reviews, review_counts, page_runs, reading_scores, fact_sources, manifest_status)}
