"""Lines of pages in order: contexts that carry on until something resets them, kinds inferred, priors learned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_resets(df: DataFrame, keys: list[str], order: list[str], resets: Column, columns: dict[str, Column]) -> DataFrame:
    """Adds each column's last non-null value since the last reset (a resetting row's own value counts), and `stretch`, the resets so far."""
    by = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    marked = df.withColumn("stretch", F.sum(F.coalesce(resets, F.lit(False)).cast("long")).over(by))
    within = W.partitionBy(*keys, "stretch").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return marked.withColumns({name: F.last(c, ignorenulls=True).over(within) for name, c in columns.items()})


def page_gap(keys: list[str], order: list[str], page: str) -> Column:
    """True on the first row of a page that isn't the one before's or the next: what was carried ends here."""
    before = F.lag(page).over(W.partitionBy(*keys).orderBy(*order))
    return before.isNotNull() & ~(F.col(page) - before).isin(0, 1)


def assembled(lines: DataFrame, document: str, order: list[str], page: str, section: Column, region: Column, institution: Column, title: Column) -> DataFrame:
    """Lines with the section, region and institution they stand under.

    title and institution, where given, begin a new part: section and region
    start anew there, and on a gap in the pages; an institution carries on to
    the next title. Pure carries and resets are windows over a document.
    """
    keys = [document]
    started = with_resets(lines.withColumn("_gap", page_gap(keys, order, page)), keys, order, title.isNotNull() | F.col("_gap"), {"institution_at": institution})
    part = started.withColumnRenamed("stretch", "part")
    inner = with_resets(part, [*keys, "part"], order, institution.isNotNull(), {"section_at": section, "region_at": region})
    return inner.drop("stretch", "_gap")


def inferred_kind(lines: DataFrame, registry: DataFrame, keys: list[str], order: list[str], code: str, score: str, least: float = 60.0, margin: float = 15.0, region: str = "region_kind", first: str = "revenue") -> DataFrame:
    """Adds `kind`: that of the registry's only entry of the code; else the best name's, if it leads; else the line's before; else the region's; else `first`.

    registry(code, kind, score): the score of each entry's name for the code's
    lines. Lines keep their number.
    """
    entries = registry.groupBy(F.col("code").alias(code)).agg(F.count_distinct("kind").alias("_n"), F.min("kind").alias("_only"), F.sort_array(F.collect_set(F.struct(F.col(score).alias("score"), F.col("kind").alias("kind"))), asc=False).alias("_s"))
    second = F.coalesce(F.get("_s", F.lit(1))["score"], F.lit(0.0))
    leads = (F.get("_s", F.lit(0))["score"] >= least) & (F.get("_s", F.lit(0))["score"] - second >= margin)
    own = F.when(F.col("_n") == 1, F.col("_only")).when(leads, F.get("_s", F.lit(0))["kind"])
    told = lines.join(entries, code, "left").withColumn("_own", own)
    before = F.last("_own", ignorenulls=True).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    return told.withColumn("kind", F.coalesce("_own", before, F.col(region), F.lit(first))).drop("_n", "_only", "_s", "_own")


def learned_prior(pages: DataFrame, keys: list[str], order: str, upright: Column, score: str, streak: int = 3, every: int = 15) -> DataFrame:
    """Adds `trusted`: the page may be taken as upright without trying, by what came before it.

    So it is after `streak` upright pages in a row whose mean score is no less
    than half of all upright pages' so far, but every `every`-th page is tried.
    """
    by = W.partitionBy(*keys).orderBy(order)
    ok = F.coalesce(upright, F.lit(False))
    recent = by.rowsBetween(-streak, -1)
    all_before = by.rowsBetween(W.unboundedPreceding, -1)
    run = (F.count(F.lit(1)).over(recent) == streak) & (F.min(ok.cast("int")).over(recent) == 1)
    usual = F.avg(F.when(ok, F.col(score))).over(all_before)
    lately = F.avg(F.col(score)).over(recent)
    checked = F.row_number().over(by) % every == 0
    return pages.withColumn("trusted", F.coalesce(run & (lately >= usual / 2) & ~checked, F.lit(False)))


def orientation(words: DataFrame, keys: list[str], turn: str, text: str, confidence: str, usual: str | None = None, margin: float = 0.15) -> DataFrame:
    """keys, turn, score: the turn with the greatest sum of confidence times letters; the usual one stays unless beaten by `margin`."""
    sums = words.groupBy(*keys, turn).agg(F.sum(F.col(confidence) * F.length(text)).alias("score"))
    favour = F.when(F.col(turn) == usual, F.col("score") * (1 + margin)).otherwise(F.col("score")) if usual is not None else F.col("score")
    return sums.groupBy(*keys).agg(F.max(F.struct(favour.alias("f"), turn, "score")).alias("m")).select(*keys, f"m.{turn}", "m.score")
