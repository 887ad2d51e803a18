"""Grid, alignment and clustering queries over documents and trade tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import grids as G
from ledgerloom.session import cut, table


def _cells(spark, d):
    return G.cells_of_text(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


def grid_facts(spark, d):
    """Facts of the tables printed in documents."""
    cells = cut(G.trimmed(_cells(spark, d), "doc_id"))
    return G.grid_facts(cells, "doc_id").withColumn("row", F.col("row").cast("long"))


def grid_sizes(spark, d):
    """Rows, columns and filled cells of each document's grid, and of its transposition."""
    cells = G.trimmed(_cells(spark, d), "doc_id")
    size = lambda c, t: c.groupBy("doc_id").agg(F.count_distinct("row").alias("rows"), F.count_distinct("col").alias("cols"), F.count_if(F.col("cell") != "").alias("filled")).withColumn("turned", F.lit(t))
    return size(cells, False).unionByName(size(G.transposed(cells), True))


def zipped_columns(spark, d):
    """Column names of each valid page with the quarters they stand for, place by place."""
    p = table(spark, d, "page_reviews").groupBy("review_id").agg(F.max(F.struct("revision", "columns"))["columns"].alias("columns"))
    quarters = F.transform("columns", lambda c: F.when(c.startswith("trim"), F.substring(c, 5, 1)))
    return G.zipped_streams(p, ["review_id"], {"column_name": F.col("columns"), "quarter": quarters}).select("review_id", F.col("place").cast("long").alias("place"), "column_name", "quarter")


def mean_clusters(spark, d):
    """Each customer's orders clustered by price: a new cluster 50,000 beyond the running mean."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return G.mean_clusters(o, ["o_custkey"], "o_totalprice", 50000.0).select("o_custkey", "o_orderkey", "cluster")


def aligned_priorities(spark, d):
    """Longest common order of each customer's order priorities in 1998 and 1999."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("label"))
    return G.aligned(o.where("y = 1998"), o.where("y = 1999"), "o_custkey", "o_orderkey", "label")


SQL = {
    "grid_sizes": r"""WITH l AS (SELECT doc_id, unnest(string_split_regex(text, '\r\n|\r|\n')) AS line, generate_subscripts(string_split_regex(text, '\r\n|\r|\n'), 1) AS r FROM documents WHERE text IS NOT NULL),
      b AS (SELECT doc_id, r, string_split_regex(regexp_replace(trim(line), '^[|¦]\s*|\s*[|¦]$', '', 'g'), '\s*[\t|¦;]\s*|\s{3,}') AS parts FROM l), c AS (SELECT doc_id, r, generate_subscripts(parts, 1) AS k, trim(unnest(parts)) AS cell FROM b WHERE len(parts) >= 3),
      m AS (SELECT doc_id, max(r) AS last_r, max(k) AS last_k FROM c WHERE cell <> '' GROUP BY 1), s AS (SELECT doc_id, count(DISTINCT r) AS n, count(DISTINCT k) AS m, count(*) FILTER (cell <> '') AS filled FROM c JOIN m USING (doc_id) WHERE r <= last_r AND k <= last_k GROUP BY 1)
      SELECT doc_id, n AS rows, m AS cols, filled, false AS turned FROM s UNION ALL SELECT doc_id, m, n, filled, true FROM s""",
    "zipped_columns": """WITH p AS (SELECT review_id, max_by(columns, revision) AS columns FROM page_reviews GROUP BY 1), u AS (SELECT review_id, unnest(columns) AS column_name, generate_subscripts(columns, 1) - 1 AS place FROM p)
      SELECT review_id, CAST(place AS BIGINT) AS place, column_name, CASE WHEN column_name LIKE 'trim%' THEN column_name[5:5] END AS quarter FROM u""",
}
QUERIES = {f.__name__: f for f in (grid_facts, grid_sizes, zipped_columns, mean_clusters, aligned_priorities)}
