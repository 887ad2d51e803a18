"""Queries of the language-model data problems (1, 3, 7, 8 and 9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import confusables, consensus, leakage, prose, tokens
from ledgerloom.session import spread, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Cells where the page's first reviewer read another number than the consensus."""
    votes, decided, _, _ = consensus.consensus(table(spark, d, "cell_readings"))
    first = votes.where("role = 'reviewer'").select("cell", "num")
    return first.join(decided.select("cell", "consensus"), "cell").where("num != consensus").select(F.col("cell").alias("value_id")).distinct()


def p1_consensus(spark: SparkSession, d: str) -> DataFrame:
    """Consensus number and agreement of every cell."""
    decided = consensus.consensus(table(spark, d, "cell_readings"))[1]
    return decided.withColumnRenamed("cell", "value_id").withColumn("margin", F.round("margin", 6))


def p1_annotators(spark: SparkSession, d: str) -> DataFrame:
    """Reliability of every annotator, and whom they copy."""
    votes, decided, rated, links = consensus.consensus(table(spark, d, "cell_readings"))
    held = votes.join(decided.select("cell", "consensus"), "cell").groupBy("annotator").agg(F.count(F.lit(1)).alias("readings"), F.avg((F.col("num") == F.col("consensus")).cast("double")).alias("with_consensus"))
    copies = links.groupBy("child").agg(F.max_by("parent", F.struct("copied", "parent")).alias("copies_of"), F.max("copied").alias("copied"))
    return held.join(rated, "annotator", "left").join(copies, held.annotator == copies.child, "left").select(held.annotator, "readings", F.round("reliability", 6).alias("reliability"), F.round("with_consensus", 6).alias("with_consensus"), "copies_of", F.round("copied", 6).alias("copied"))


def _names(spark: SparkSession, d: str) -> DataFrame:
    sources = (("facts", "fact_id", "name"), ("annotation_values", "value_id", "name"), ("analytics_rows", "row_id", "municipality"))
    parts = [table(spark, d, t).select(F.lit(t).alias("source_table"), F.col(k).alias("row_key"), F.col(n).alias("name")) for t, k, n in sources]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose name isn't in ordinary spelling."""
    return confusables.spelled_otherwise(_names(spark, d)).select("source_table", "row_key")


def p3_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every row's name in its consistent form."""
    rows = _names(spark, d)
    return rows.join(confusables.consistent_forms(rows.select("name")), "name", "left").select("source_table", "row_key", "form")


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k."""
    return tokens.encode_documents(_documents(spark, d))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the evaluation items that leaked into them."""
    return leakage.leaks(_documents(spark, d), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p8_parts(spark: SparkSession, d: str) -> DataFrame:
    """As p8_found, with how much of the item the document has."""
    return leakage.leaks(_documents(spark, d), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that are a list, a table or junk."""
    return prose.text_statistics(_documents(spark, d)).where("text_kind != 'prose'").select("doc_id", "text_kind")


def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Text statistics of every document."""
    return prose.text_statistics(_documents(spark, d))


QUERIES = {f.__name__: f for f in (p1_found, p1_consensus, p1_annotators, p3_found, p3_forms, p7_ids, p8_found, p8_parts, p9_found, p9_statistics)}
SQL: dict[str, str] = {}
