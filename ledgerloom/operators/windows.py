"""Order-dependent operators as windows. Row order is always an explicit column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TOP, END = W.unboundedPreceding, W.unboundedFollowing


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key. Equal orders are told apart by all columns; null keys are one key."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.min(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def rank_cohort(df: DataFrame, cohort: list[str], value: str, eligible: Column) -> DataFrame:
    """Competition rank and cohort size among eligible rows with a value; other rows stay, with nulls.

    rank is 1 + the number of strictly greater values, so ties share a rank. One
    window over all rows: the ineligible ones sort last and don't count.
    """
    counts = eligible & F.col(value).isNotNull()
    marked = df.withColumn("_in", F.coalesce(counts, F.lit(False)))
    by_value = W.partitionBy(*cohort).orderBy(F.col("_in").desc(), F.when(F.col("_in"), F.col(value)).desc_nulls_last())
    size = F.sum(F.col("_in").cast("long")).over(W.partitionBy(*cohort))
    return marked.withColumn("rank", F.when(F.col("_in"), F.rank().over(by_value).cast("long"))).withColumn("cohort", F.when(F.col("_in"), size)).drop("_in")


def previous_eligible(df: DataFrame, keys: list[str], order: str, value: str, eligible: Column) -> DataFrame:
    """Adds previous and previous_<order>: value and place of the last eligible row before, however long ago."""
    held = F.when(eligible & F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col(order).alias("o")))
    last = F.last(held, ignorenulls=True).over(W.partitionBy(*keys).orderBy(order).rowsBetween(TOP, -1))
    return df.withColumn("_p", last).withColumn("previous", F.col("_p.v")).withColumn(f"previous_{order}", F.col("_p.o")).drop("_p")


def carry_forward(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, Column], inclusive: bool = True) -> DataFrame:
    """Adds each column's last non-null value so far (with or without the row itself)."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(TOP, 0 if inclusive else -1)
    return df.withColumns({name: F.last(c, ignorenulls=True).over(w) for name, c in columns.items()})


def look_ahead(df: DataFrame, keys: list[str], order: list[str], name: str, value: Column) -> DataFrame:
    """Adds the next non-null value after the row."""
    return df.withColumn(name, F.first(value, ignorenulls=True).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(1, END)))


def islands(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Runs of consecutive integers: keys, first, last, length. Repeats count once, nulls for nothing."""
    spots = df.where(F.col(at).isNotNull()).select(*keys, F.col(at).cast("long").alias("_at")).distinct()
    run = F.col("_at") - F.row_number().over(W.partitionBy(*keys).orderBy("_at"))
    return spots.withColumn("_run", run).groupBy(*keys, "_run").agg(F.min("_at").alias("first"), F.max("_at").alias("last"), F.count(F.lit(1)).alias("length")).drop("_run")


def compact_ranges(runs: DataFrame, keys: list[str]) -> DataFrame:
    """`1-3,7` from the runs of islands; a key has as many parts as runs."""
    part = F.when(F.col("first") == F.col("last"), F.col("first").cast("string")).otherwise(F.concat_ws("-", F.col("first").cast("string"), F.col("last").cast("string")))
    return runs.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", part.alias("part")))), lambda x: x["part"]), ",").alias("spec"))


def page_spec(df: DataFrame, spec: str, last: Column) -> DataFrame:
    """Rows (input columns, page) of the pages that `1-10`, `9,31` or `5-` name within 1..last, each once."""
    part = F.explode(F.split(F.regexp_replace(spec, r"\s", ""), ","))
    parts = df.withColumn("_last", last).withColumn("_part", part).where(F.col("_part").rlike(r"^\d+(-\d*)?$"))
    low = F.split("_part", "-")[0].cast("int")
    high = F.when(~F.contains(F.col("_part"), F.lit("-")), low).otherwise(F.coalesce(F.try_element_at(F.split("_part", "-"), F.lit(2)).try_cast("int"), F.col("_last")))
    bounds = parts.withColumn("_lo", F.greatest(low, F.lit(1))).withColumn("_hi", F.least(high, F.col("_last"))).where("_lo <= _hi")
    return bounds.select(*df.columns, F.explode(F.sequence("_lo", "_hi")).alias("page")).distinct()


def sessions(df: DataFrame, keys: list[str], at: str, gap_seconds: int) -> DataFrame:
    """Adds `session`: how many gaps longer than `gap_seconds` lie before the row."""
    by = W.partitionBy(*keys).orderBy(at)
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    wide = micros - F.lag(micros).over(by) > gap_seconds * 1_000_000
    return df.withColumn("_wide", F.coalesce(wide.cast("long"), F.lit(0))).withColumn("session", F.sum("_wide").over(by.rowsBetween(TOP, 0))).drop("_wide")


def chunks(df: DataFrame, keys: list[str], order: list[str], size: int) -> DataFrame:
    """Adds `chunk`: rows of a key in order, `size` at a time."""
    return df.withColumn("chunk", F.floor((F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1) / size).cast("long"))


def spread_sample(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """n rows of each key, evenly spaced from the first to the last (all rows if there are fewer)."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1
    total = F.count(F.lit(1)).over(W.partitionBy(*keys))
    steps = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.floor(i * (F.col("_total") - 1) / max(1, n - 1) + 0.5).cast("long"))
    placed = df.withColumn("_place", place.cast("long")).withColumn("_total", total)
    return placed.where((F.col("_total") <= n) | F.array_contains(steps, F.col("_place"))).drop("_place", "_total")


def stitch(df: DataFrame, keys: list[str], page: str, tail: Column, head: Column) -> DataFrame:
    """Adds `stitched`: the row goes on a row of the page right before, whose `tail` holds where `head` does here."""
    by = W.partitionBy(*keys).orderBy(page)
    joined = (F.lag(page).over(by) == F.col(page) - 1) & F.lag(tail).over(by) & head
    return df.withColumn("stitched", F.coalesce(joined, F.lit(False)))


def running_until(df: DataFrame, keys: list[str], order: list[str], amount: str, cap: float) -> DataFrame:
    """Adds `running`, the sum so far, and `within`, whether it is still at most `cap`."""
    total = F.sum(amount).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(TOP, 0))
    return df.withColumn("running", total).withColumn("within", F.col("running") <= F.lit(cap))
