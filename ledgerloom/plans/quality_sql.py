"""SQL twins of those quality queries that SQL can say."""

_NUM = """CASE WHEN trim({c}) = '' OR {c} IS NULL THEN NULL WHEN regexp_full_match(replace(trim({c}), ' ', ''), '[-+]?[0-9]+([.][0-9]*)?') THEN rtrim(rtrim(printf('%.6f', CAST(replace(trim({c}), ' ', '') AS DOUBLE)), '0'), '.') ELSE lower(trim({c})) END"""
_PATH = r"""nullif(regexp_replace(regexp_replace(replace(trim({c}), '\', '/'), '/+', '/', 'g'), '^(\./)+', ''), '')"""


def _side(name: str, stamp: str, revision: str) -> str:
    return f"""SELECT siruta, year, budget, lines, lines_strictly_verified, xlsx, status FROM (SELECT *, row_number() OVER (PARTITION BY siruta, year, budget ORDER BY stamp DESC, revision DESC) AS k FROM
      (SELECT trim(siruta) AS siruta, CAST(year AS INTEGER) AS year, trim(budget) AS budget, {_NUM.format(c="CAST(lines AS VARCHAR)")} AS lines, {_NUM.format(c="CAST(lines_strictly_verified AS VARCHAR)")} AS lines_strictly_verified,
       {_PATH.format(c='xlsx')} AS xlsx, nullif(lower(trim(status)), '') AS status, {stamp} AS stamp, {revision} AS revision FROM {name})) WHERE k = 1"""


_BOTH = f"""m AS ({_side('quality_manifest', 'updated_at', 'revision')}), s AS ({_side('quality_snapshot', 'written_at', '0')}),
  d AS (SELECT siruta, year, budget, 'missing_in_snapshot' AS difference, NULL AS left_value, NULL AS right_value FROM m WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.siruta = m.siruta AND s.year = m.year AND s.budget = m.budget)
    UNION ALL SELECT siruta, year, budget, 'missing_in_manifest', NULL, NULL FROM s WHERE NOT EXISTS (SELECT 1 FROM m WHERE s.siruta = m.siruta AND s.year = m.year AND s.budget = m.budget)
    {' '.join(f"UNION ALL SELECT siruta, year, budget, '{f}', m.{f}, s.{f} FROM m JOIN s USING (siruta, year, budget) WHERE m.{f} IS DISTINCT FROM s.{f}" for f in ('lines', 'lines_strictly_verified', 'xlsx', 'status'))})"""
_CUR = r"[\s_]*(de[\s_]+)?(lei|leu|ron)($|[^\p{L}])"
_EXP = lambda c: f"""CASE WHEN regexp_matches(lower({c}), '(^|[^\\p{{L}}])(miliarde?|mld[.]?){_CUR}') THEN 6 WHEN regexp_matches(lower({c}), '(^|[^\\p{{L}}])(milioane|milion|mil[.]?|mln[.]?|mio[.]?){_CUR}') THEN 3
  WHEN regexp_matches(lower({c}), '(^|[^\\p{{L}}])(mii|mie|k|ezer|thousand){_CUR}') THEN 0 WHEN regexp_matches(lower({c}), '(^|[^\\p{{L}}])(lei|leu|ron)($|[^\\p{{L}}])') THEN -3 END"""  # noqa: E731
_BARE = lambda c: f"regexp_replace(regexp_replace({c}, '[\\s\\x{{00A0}}\\x{{2000}}-\\x{{200B}}\\x{{202F}}]', '', 'g'), '[−–]', '-', 'g')"
_VALUES = f"""pg AS (SELECT review_id, arg_max_null(note, revision) AS note, arg_max_null(number_notation, revision) AS notation, arg_max_null(source_unit, revision) AS unit FROM page_reviews GROUP BY 1),
  v AS (SELECT value_id, coalesce({_EXP('printed')}, {_EXP("replace(unit, '_', ' ')")}, {_EXP('pg.note')}) AS e, notation, {_BARE("regexp_extract(printed, '[(]?[-−]?[0-9][0-9.,\\s\\x{00A0}\\x{202F}]*[0-9][)]?|[-−]?[0-9]')")} AS t, {_BARE('normalized_mii_lei')} AS n FROM annotation_values LEFT JOIN pg USING (review_id)),
  w AS (SELECT value_id, e, TRY_CAST(CASE WHEN notation = 'romanian' OR (notation IS DISTINCT FROM 'canonical' AND contains(t, ',')) THEN replace(replace(t, '.', ''), ',', '.') WHEN notation = 'canonical' THEN replace(t, ',', '') ELSE t END AS DECIMAL(38,6)) AS x, TRY_CAST(replace(n, ',', '') AS DECIMAL(38,6)) AS y FROM v)"""
_SPANS = """p AS (SELECT feed, file_name, file_kind, written_at, CAST(payload AS JSON) AS j FROM raw_payloads WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'),
  k AS (SELECT feed, file_name, file_kind, written_at, j, unnest(json_keys(j)) AS key FROM p), o AS (SELECT feed, file_name, file_kind, written_at, json_extract(j, '$.values') AS j, unnest(json_keys(j, '$.values')) AS key FROM p WHERE json_type(j, '$.values') = 'OBJECT'),
  f AS (SELECT feed, file_name, file_kind, written_at, key AS field, json_type(j, '$."' || key || '"') AS t FROM k WHERE key <> 'values' UNION ALL SELECT feed, file_name, file_kind, written_at, 'values.' || key, json_type(j, '$."' || key || '"') FROM o),
  y AS (SELECT feed, file_name, file_kind, written_at, field, CASE t WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN NULL ELSE 'number' END AS t FROM f),
  c AS (SELECT file_kind, feed, file_name, field, t, count(*) AS n, max(written_at) AS w FROM y GROUP BY ALL), g AS (SELECT file_kind, feed, file_name, field, max(w) AS w, (max({'n': n, 't': t}) FILTER (t IS NOT NULL)).t AS t FROM c GROUP BY ALL),
  r AS (SELECT feed, file_name, row_number() OVER (PARTITION BY feed ORDER BY max(w) NULLS FIRST, file_name) AS seq FROM g GROUP BY file_kind, feed, file_name),
  s AS (SELECT g.*, seq, seq - row_number() OVER (PARTITION BY g.feed, field ORDER BY seq) AS span FROM g JOIN r ON r.feed = g.feed AND r.file_name = g.file_name),
  h AS (SELECT *, last_value(t IGNORE NULLS) OVER (PARTITION BY feed, field, span ORDER BY seq ROWS UNBOUNDED PRECEDING) AS held FROM s),
  u AS (SELECT *, coalesce((held <> lag(held) OVER (PARTITION BY feed, field, span ORDER BY seq))::INT, 0) AS turn FROM h), i AS (SELECT *, SUM(turn) OVER (PARTITION BY feed, field, span ORDER BY seq ROWS UNBOUNDED PRECEDING) AS island FROM u)"""
SQL = {"p4_found": f"WITH {_BOTH} SELECT siruta, year, budget, difference FROM d", "p4_values": f"WITH {_BOTH} SELECT * FROM d",
    "p2_lifespans": f"WITH {_SPANS} SELECT file_kind, feed, field, max(held) AS type, CAST(min(seq) AS BIGINT) AS first_seq, CAST(max(seq) AS BIGINT) AS last_seq FROM i GROUP BY file_kind, feed, field, span, island",
    "p5_values": f"WITH {_VALUES} SELECT value_id FROM w WHERE e IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL AND abs(y::DOUBLE - x::DOUBLE * pow(10, e)) > 0.005 * abs(x::DOUBLE * pow(10, e))",
}
QUERIES: dict = {}
