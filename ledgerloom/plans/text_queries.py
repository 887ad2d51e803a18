"""String, number and code queries, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import codes as C
from ledgerloom.functions import numbers as N
from ledgerloom.functions import text as T
from ledgerloom.functions import years as Y
from ledgerloom.session import table

DEC = "decimal(18,2)"


def fold_text(spark, d):
    """Length and words of every document's folded text."""
    t = table(spark, d, "documents").select("doc_id", T.fold(F.col("text")).alias("folded"))
    return t.select("doc_id", F.length("folded").cast("long").alias("chars"), F.size(F.filter(F.split(F.coalesce("folded", F.lit("")), "[^a-z]+"), lambda w: w != "")).cast("long").alias("words"))


def ro_number(spark, d):
    """Prices printed the Romanian way and read back."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast(DEC).alias("price"))
    p = o.select("o_orderkey", "price", N.romanian_text(F.col("price")).alias("printed"))
    return p.select("o_orderkey", "printed", (N.cell(F.col("printed"))["value"] == F.col("price")).alias("same"))


def printed_cells(spark, d):
    """Kind and value of every printed annotation without a unit, leniently read."""
    a = table(spark, d, "annotation_values").select("value_id", "printed")
    c = a.select("value_id", N.cell(F.col("printed")).alias("strict"), N.cell(F.col("printed"), scanned=True).alias("lenient"))
    return c.select("value_id", F.col("strict.kind").alias("strict_kind"), F.col("lenient.kind").alias("lenient_kind"), F.col("lenient.value").alias("value"))


def indicator_code(spark, d):
    """Codes made of part keys as compact digits, in dotted form, with parent and chapter."""
    p = table(spark, d, "part").select("p_partkey", F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("raw"))
    c = p.select("p_partkey", C.indicator_code(F.col("raw")).alias("code"), C.dotted_code(F.col("raw"), F.lit("revenue"), F.lit("02")).alias("dotted"))
    return c.select("p_partkey", "code", C.parent_code(F.col("code"), F.lit("revenue")).alias("parent"), "dotted")


def levenshtein_names(spark, d):
    """Pairs of different supplier names one edit apart, found by their one-letter deletions."""
    s = table(spark, d, "supplier").select(F.col("s_name").alias("name")).distinct()
    keyed = s.select("name", F.explode(T.near_keys(F.col("name"))).alias("key"))
    a, b = keyed.toDF("a", "key"), keyed.toDF("b", "key")
    return a.join(b, "key").where("a < b").select("a", "b").distinct().where(F.levenshtein("a", "b") <= 1)


def token_subset(spark, d):
    """Documents whose title's words are all in their text."""
    t = table(spark, d, "documents").where("title is not null and text is not null")
    return t.select("doc_id", T.subset_of(F.col("title"), F.col("text")).alias("inside"))


def sha_fingerprint(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.sha2(F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus", "o_orderpriority"), 256).alias("hash"))
    return o.select("o_orderkey", "hash", F.substring("hash", 1, 24).alias("bundle"))


def json_props(spark, d):
    """The property k of every event type's events."""
    e = table(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return e.groupBy("event_type").agg(F.count("k").alias("n"), F.min("k").alias("low"), F.max("k").alias("high"), F.sum("k").alias("total"))


def name_slugs(spark, d):
    """Slugs and cleaned forms of the distinct fact names."""
    n = table(spark, d, "facts").where("name is not null").select("name").distinct()
    return n.select("name", T.safe_id(F.col("name")).alias("slug"), T.cut_at(T.clean_name(F.col("name")), 20).alias("short"))


def header_years(spark, d):
    """Years of the documents' titles and texts, and the edition they suggest."""
    t = table(spark, d, "documents").select("doc_id", Y.budget_year(F.col("title")).alias("title_year"), F.size(Y.years_in(F.col("text"))).cast("long").alias("years"))
    return t


def title_scores(spark, d):
    """Fuzzy scores of each document's title against its source and type."""
    t = table(spark, d, "documents").where("title is not null").select("doc_id", T.fold(F.col("title")).alias("title"), F.regexp_replace(T.fold(F.col("source")), "_", " ").alias("source"))
    return t.select("doc_id", *[T.fuzzy(k)(F.col("title"), F.col("source")).alias(k) for k in ("indel", "token_set", "partial")])


_FOLDED = "lower(strip_accents(text))"
SQL = {
    "name_slugs": r"""WITH n AS (SELECT DISTINCT name FROM facts WHERE name IS NOT NULL), c AS (SELECT name, regexp_replace(regexp_replace(name, '^\s*(\d{1,3}[.)]|[ivxIVX]{1,5}[.)]|[-–•*])\s+', ''), '\s+', ' ', 'g') AS bare FROM n)
      SELECT name, regexp_replace(regexp_replace(lower(strip_accents(name)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug, left(trim(regexp_replace(bare, '[\s:;,.]+$', '')), 20) AS short FROM c""",
    "fold_text": f"""SELECT doc_id, CAST(length({_FOLDED}) AS BIGINT) AS chars, CAST(len(list_filter(regexp_split_to_array(coalesce({_FOLDED}, ''), '[^a-z]+'), lambda w: w <> '')) AS BIGINT) AS words FROM documents""",
    "ro_number": """SELECT o_orderkey, replace(replace(replace(format('{:,.2f}', CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE), ',', '_'), '.', ','), '_', '.') AS printed, true AS same FROM orders""",
    "indicator_code": """WITH p AS (SELECT p_partkey, CASE WHEN length(p_partkey::VARCHAR) > 6 THEN left(p_partkey::VARCHAR, 6) ELSE lpad(p_partkey::VARCHAR, 6, '0') END AS r FROM part)
      SELECT p_partkey, r[1:2] || '.' || r[3:4] || '.' || r[5:6] AS code, r[1:2] || '.' || r[3:4] AS parent,
        r[1:2] || '.02' || CASE WHEN r[3:4] <> '00' THEN '.' || r[3:4] ELSE '' END || CASE WHEN r[5:6] <> '00' THEN '.' || r[5:6] ELSE '' END AS dotted FROM p""",
    "levenshtein_names": "WITH s AS (SELECT DISTINCT s_name AS n FROM supplier) SELECT a.n AS a, b.n AS b FROM s a JOIN s b ON a.n < b.n AND levenshtein(a.n, b.n) <= 1",
    "token_subset": r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(strip_accents(title)), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS t, list_filter(regexp_split_to_array(lower(strip_accents(text)), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS h
      FROM documents WHERE title IS NOT NULL AND text IS NOT NULL) SELECT doc_id, len(t) > 0 AND list_has_all(h, t) AS inside FROM w""",
    "sha_fingerprint": "SELECT o_orderkey, sha256(o_orderkey || '|' || o_custkey || '|' || o_orderstatus || '|' || o_orderpriority) AS hash, left(sha256(o_orderkey || '|' || o_custkey || '|' || o_orderstatus || '|' || o_orderpriority), 24) AS bundle FROM orders",
    "json_props": "SELECT event_type, count(k) AS n, min(k) AS low, max(k) AS high, CAST(SUM(k) AS BIGINT) AS total FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY 1",
    "header_years": r"""SELECT doc_id, CAST(list_min(list_filter([CAST(y AS INT) FOR y IN regexp_extract_all(' ' || title || ' ', '(?:[^0-9])((?:19|20)[0-9]{2})(?:[^0-9])', 1)], lambda y: y BETWEEN 2000 AND 2100)) AS INTEGER) AS title_year,
      CAST(coalesce(len(list_distinct(regexp_extract_all(regexp_replace(regexp_replace(' ' || coalesce(text, '') || ' ', '[0-9]{5,}', '#', 'g'), '[^0-9]', '  ', 'g'), ' ((?:19|20)[0-9]{2}) ', 1))), 0) AS BIGINT) AS years FROM documents""",
}
QUERIES = {f.__name__: f for f in (fold_text, ro_number, printed_cells, indicator_code, levenshtein_names, token_subset, sha_fingerprint, json_props, name_slugs, header_years, title_scores)}
