"""Words of pages to grids: profiles, ruling lines, rows and columns by place, bands, page quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.grids import mean_clusters
from ledgerloom.operators.joins import nearest_center

#: Letters a page must have more of to count as having a text layer.
TEXT_LAYER = 20


def page_profiles(pages: DataFrame, keys: list[str], page: str, text: str) -> DataFrame:
    """keys, page, chars, has_text: letters of each page without blanks."""
    chars = F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\s+", ""))
    return pages.select(*keys, page, chars.cast("long").alias("chars"), (chars > TEXT_LAYER).alias("has_text"))


def profile_summary(profiles: DataFrame, keys: list[str]) -> DataFrame:
    """keys, pages, with_text, mostly_scanned: fewer than half the pages have a text layer."""
    g = profiles.groupBy(*keys).agg(F.count(F.lit(1)).alias("pages"), F.count_if("has_text").alias("with_text"))
    return g.withColumn("mostly_scanned", F.col("with_text") < F.col("pages") / 2)


def column_spans(rules: DataFrame, keys: list[str], x: str, gap: float = 4.0) -> DataFrame:
    """keys, col, low, high: columns between ruling lines; lines less than `gap` right of the last kept one are the same line.

    A page's lines are few: a fold over its sorted places.
    """
    listed = rules.where(F.col(x).isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_set(F.col(x).cast("double"))).alias("xs"))
    kept = F.aggregate("xs", F.array().cast("array<double>"), lambda acc, v: F.when((F.size(acc) == 0) | (v - F.element_at(acc, -1) >= gap), F.concat(acc, F.array(v))).otherwise(acc))
    spans = F.arrays_zip(F.slice("k", 1, F.size("k") - 1).alias("low"), F.slice("k", 2, F.size("k") - 1).alias("high"))
    return listed.withColumn("k", kept).where("size(k) > 1").select(*keys, F.posexplode(spans).alias("col", "s")).select(*keys, "col", "s.low", "s.high")


def digital_grid(words: DataFrame, rules: DataFrame, keys: list[str], apart: float = 1.6, width: float = 32.0) -> DataFrame:
    """keys, row, col, cell: words of a page put into rows by their top and into the columns between its ruling lines.

    words(keys, x0, x1, top, text), rules(keys, x). A word stands where its
    middle is; words outside all columns are left out. Columns meet words on
    buckets of `width`, an equi-join with the page.
    """
    spans = column_spans(rules, keys, "x").withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor(F.col("high") / width))))
    middle = (F.col("x0") + F.col("x1")) / 2
    rows = mean_clusters(words.select(*keys, "x0", middle.alias("_x"), F.col("top").cast("double").alias("top"), "text"), keys, "top", apart)
    placed = rows.withColumn("_bucket", F.floor(F.col("_x") / width)).join(spans, [*keys, "_bucket"]).where((F.col("_x") >= F.col("low")) & (F.col("_x") < F.col("high")))
    told = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda w: w["text"]), " ")
    return placed.groupBy(*keys, F.col("cluster").alias("row"), "col").agg(told.alias("cell"))


def coordinate_cells(tokens: DataFrame, centres: DataFrame, keys: list[str], farthest: float, apart: float) -> DataFrame:
    """keys, row, column, cell: scanned tokens put into rows by clusters of their height, and to the nearest column centre within reach.

    tokens(keys, x, y, text), centres(column, at). Tokens out of every column's
    reach are left out.
    """
    near = nearest_center(tokens, "x", centres, "at", "column", farthest).where(F.col("column").isNotNull())
    rows = mean_clusters(near.select(*keys, "x", F.col("y").cast("double").alias("y"), "text", "column"), keys, "y", apart)
    told = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x", "text"))), lambda w: w["text"]), " ")
    return rows.groupBy(*keys, F.col("cluster").alias("row"), "column").agg(told.alias("cell"))


def row_bands(words: DataFrame, keys: list[str], row: str, top: str, bottom: str, height: Column) -> DataFrame:
    """keys, row, from_share, to_share: where on its page each row lies, as shares of the height."""
    return words.groupBy(*keys, row).agg(F.round(F.min(F.col(top) / height), 6).alias("from_share"), F.round(F.max(F.col(bottom) / height), 6).alias("to_share"))


def code_band(rows: DataFrame, codes: DataFrame, keys: list[str], code: str, top: str, bottom: str) -> DataFrame:
    """keys, low, high: the band of the rows that have any of the codes asked for."""
    return rows.join(codes.select(code).distinct(), code, "left_semi").groupBy(*keys).agg(F.min(top).alias("low"), F.max(bottom).alias("high"))


def structural_score(coverage: Column, identity: Column, hygiene: Column, unknown: Column) -> Column:
    """A page mapping's score: 0.7 coverage, 0.2 identity, 0.1 hygiene, each within 0 and 1; three quarters of it for an unknown layout."""
    within = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(c, F.lit(0.0))))
    score = 0.7 * within(coverage) + 0.2 * within(identity) + 0.1 * within(hygiene)
    return F.round(F.when(unknown, score * 0.75).otherwise(score), 4)


def first_rule(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    """The name of the first rule that holds: a cascade."""
    told = reduce(lambda acc, rule: F.when(rule[1], rule[0]) if acc is None else acc.when(rule[1], rule[0]), rules, None)
    return told.otherwise(otherwise)


def best_payload(payloads: DataFrame, keys: list[str], score: str, cells: str, index: str) -> DataFrame:
    """One payload of each page: one with cells before one without, then the greatest score, most cells, lowest index."""
    rest = [c for c in payloads.columns if c not in (*keys, score, cells, index)]
    best = F.max(F.struct((F.coalesce(F.col(cells), F.lit(0)) > 0).alias("_p"), F.col(score), F.col(cells), (-F.col(index)).alias("_i"), *rest))
    return payloads.groupBy(*keys).agg(best.alias("m")).select(*keys, F.col(f"m.{score}").alias(score), F.col(f"m.{cells}").alias(cells), (-F.col("m._i")).alias(index), *[F.col(f"m.{c}").alias(c) for c in rest])


def needs_another_reading(cells: Column, unreadable: Column, score: Column, layout: Column, least: float = 0.5, unread: float = 0.2) -> Column:
    """A page whose mapping isn't to be relied on: an unknown layout, no cells, a low score, or too many unreadable cells."""
    share = unreadable / F.nullif(cells + unreadable, F.lit(0))
    return (layout == "unknown") | (F.coalesce(cells, F.lit(0)) == 0) | (F.coalesce(score, F.lit(0.0)) < least) | (F.coalesce(share, F.lit(0.0)) > unread)


def quality_label(strict: Column, problems: Column, good: float = 90.0, fair: float = 70.0) -> Column:
    """high, medium or low: by the strictly verified share in percent, never high with open problems, low without figures."""
    return F.when(strict.isNull(), "low").when((strict >= good) & (F.coalesce(problems, F.lit(0)) == 0), "high").when(strict >= fair, "medium").otherwise("low")
