"""Periodic reports: headers bound by label, control totals, snapshots, re-reading what hasn't changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import numbers as N
from ledgerloom.functions import text as T

#: Rows at the top of a sheet in which its header is looked for.
HEADER_WITHIN = 40


def report_date(c: Column) -> Column:
    """The day of a text such as `LA DATA: 30-JUN-26`; null without one."""
    day = F.initcap(F.regexp_extract(F.upper(c), r"(\d{1,2}-[A-Z]{3}-\d{2,4})", 1))
    return F.coalesce(F.try_to_timestamp(day, F.lit("d-MMM-yyyy")), F.try_to_timestamp(day, F.lit("d-MMM-yy"))).cast("date")


def bound_columns(cells: DataFrame, labels: dict[str, str], key: str) -> DataFrame:
    """(key, header, label, col): columns by their label, in the first of the top rows that has all labels.

    cells(key, row, col, cell), labels: name to a pattern of the folded cell. A
    label takes its leftmost column; sheets without such a row give nothing.
    """
    folded = T.fold(F.trim("cell"))
    label = F.coalesce(*[F.when(folded.rlike(p), F.lit(n)) for n, p in labels.items()])
    heads = cells.where(F.col("row") < HEADER_WITHIN).withColumn("label", label).where("label is not null").groupBy(key, "row", "label").agg(F.min("col").alias("col"))
    whole = heads.groupBy(key, "row").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(labels)).groupBy(key).agg(F.min("row").alias("header"))
    return heads.join(whole, key).where("row = header").select(key, "header", "label", "col")


def report_lines(cells: DataFrame, labels: dict[str, str], key: str, amounts: list[str], code: str = "code", total: str = r"^\s*total\b") -> tuple[DataFrame, DataFrame]:
    """(lines, control totals) of reports: key, row, the texts and amounts of each bound column.

    Rows under the header whose name (or first text) begins like a total are
    control totals, rows with a code are lines; others are neither. Amounts are
    read as printed numbers.
    """
    places = bound_columns(cells, labels, key)
    told = cells.join(places, [key, "col"]).where(F.col("row") > F.col("header"))
    wide = told.groupBy(key, "row").agg(*[F.max(F.when(F.col("label") == n, F.col("cell"))).alias(n) for n in labels])
    for n in amounts:
        wide = wide.withColumn(n, N.printed_number(F.col(n)))
    texts = [c for c in labels if c not in amounts]
    is_total = F.greatest(*[F.coalesce(T.fold(F.col(c)).rlike(total), F.lit(False)) for c in texts], F.lit(False))
    return wide.where(~is_total & (F.coalesce(F.trim(code), F.lit("")) != "")), wide.where(is_total)


def control_breaches(lines: DataFrame, totals: DataFrame, keys: list[str], value: str, within: float = 0.001) -> DataFrame:
    """keys, summed, printed, share: groups whose lines' sum is off the printed total by more than `within` of it.

    Lines are summed before the join; a group without a printed total, or with
    one of nil, isn't judged; a printed total without lines is off by all of it.
    """
    sums = lines.groupBy(*keys).agg(F.sum(value).alias("summed"))
    printed = totals.groupBy(*keys).agg(F.max(value).alias("printed")).where("printed is not null and printed != 0")
    both = printed.join(sums, keys, "left").withColumn("summed", F.coalesce("summed", F.lit(0)))
    share = F.abs(F.col("summed").cast("double") - F.col("printed").cast("double")) / F.abs(F.col("printed").cast("double"))
    return both.withColumn("share", share).where(F.col("share") > within).select(*keys, "summed", "printed", "share")


def snapshot(blocks: DataFrame, keys: list[str], period: str, fields: list[str]) -> DataFrame:
    """keys, the latest period's fields, and all periods as an array in order. A key's periods are few: a year's quarters."""
    row = F.struct(F.col(period), *fields)
    held = blocks.where(F.col(period).isNotNull()).groupBy(*keys).agg(F.max(row).alias("m"), F.array_sort(F.collect_set(row)).alias("periods"))
    return held.select(*keys, F.col(f"m.{period}").alias(period), *[F.col(f"m.{f}").alias(f) for f in fields], "periods")


def to_ingest(found: DataFrame, held: DataFrame, key: str, digest: str) -> DataFrame:
    """Found files that aren't held with the same hash: new ones and changed ones, with `change`."""
    old = held.groupBy(key).agg(F.max_by(digest, digest).alias("_old"))
    both = found.join(old, key, "left")
    return both.withColumn("change", F.when(F.col("_old").isNull(), "new").when(F.col("_old") != F.col(digest), "changed")).where("change is not null").drop("_old")


def merged_records(held: DataFrame, fresh: DataFrame, key: str, digest: str, fields: list[str]) -> DataFrame:
    """Records after re-reading: of a key with an unchanged hash the earlier record stays, with its verification; else the fresh one holds."""
    tag = lambda df, t: df.select(F.col(key), F.struct(digest, *fields).alias(t))
    both = tag(held, "_h").join(tag(fresh, "_f"), key, "full_outer")
    keep = F.col("_f").isNull() | F.coalesce(F.col(f"_h.{digest}") == F.col(f"_f.{digest}"), F.lit(False))
    return both.select(key, F.when(keep, F.col("_h")).otherwise(F.col("_f")).alias("m")).select(key, f"m.{digest}", *[F.col(f"m.{f}").alias(f) for f in fields])


def scaffold(previous: DataFrame, path: str, period: str, old: str, new: str) -> DataFrame:
    """The entries of a period made for the next: paths and period with `old` replaced by `new`."""
    return previous.where(F.col(period) == old).withColumn(path, F.regexp_replace(path, rf"(?<![A-Za-z0-9]){old}(?![A-Za-z0-9])", new)).withColumn(period, F.lit(new))
