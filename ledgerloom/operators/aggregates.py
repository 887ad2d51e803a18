"""Aggregations with the engine's rules about absent values, ties and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def best_of(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """The row of the greatest value of each key; of equal values the first in `order`. Null values never win."""
    rest = [c for c in df.columns if c not in keys and c != value and c not in order]
    # Order ascending among equals: the least of (minus value) structs.
    row = F.min(F.struct((-F.col(value)).alias("_minus"), *order, *rest))
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(row.alias("_r")).select(*keys, (-F.col("_r._minus")).alias(value), *[F.col(f"_r.{c}").alias(c) for c in (*order, *rest)])


def top_k(df: DataFrame, keys: list[str], value: str, ties: list[str], k: int) -> DataFrame:
    """The k greatest of each key with their place; equal values by `ties`."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last(), *ties))
    return df.withColumn("place", place.cast("long")).where(F.col("place") <= k)


def modal(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The most frequent combination of each key; of equal counts the greatest, nulls least."""
    counted = df.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(*keys).agg(F.max(F.struct("n", *columns)).alias("_m")).select(*keys, *[F.col(f"_m.{c}").alias(c) for c in columns], F.col("_m.n").alias("n"))


def rolled_up(df: DataFrame, keys: list[str], code: Column, value: str, name: str, order: str, own: Column) -> DataFrame:
    """Sum of `value` per group `code`; the group's name is that of its first row where `own` holds."""
    named = F.min(F.when(own, F.struct(F.col(order), F.col(name).alias("name"))))
    return df.groupBy(*keys, code.alias("code")).agg(F.sum(value).alias("total"), named["name"].alias("name"))


def plausible(total: Column, greatest_part: Column) -> Column:
    """A total that is less than its greatest part is dropped; without parts it stands."""
    return F.when(greatest_part.isNull() | (total >= greatest_part), total)


def gated(df: DataFrame, keys: list[str], part: str, total: str, low: float = 90, high: float = 110) -> DataFrame:
    """Groups whose parts make up between `low` and `high` percent of the total."""
    sums = df.groupBy(*keys).agg(F.sum(part).alias("parts"), F.max(total).alias("total"))
    return sums.withColumn("share", F.when(F.col("total") != 0, 100 * F.col("parts").cast("double") / F.col("total").cast("double"))).where(F.col("share").between(low, high))


def all_or_nothing(df: DataFrame, keys: list[str], share: str, low: float, high: float) -> DataFrame:
    """Adds `incomplete` (some share of the group is out of the band) and empties all the group's shares then."""
    out = F.coalesce(F.max(~F.col(share).between(low, high)).over(W.partitionBy(*keys)), F.lit(False))
    return df.withColumn("incomplete", out).withColumn(share, F.when(~F.col("incomplete"), F.col(share)))


def rescued(smallest: Column, witness: Column, value: Column, factor: int = 1000, least: float = 100) -> Column:
    """value / factor where even the smallest total is `least` times its witness or more."""
    return F.when((witness != 0) & (smallest / witness >= least), value / factor).otherwise(value)


def de_cumulated(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Adds `step`: what a cumulative value adds to the one before (all of it for the first)."""
    before = F.lag(value).over(W.partitionBy(*keys).orderBy(order))
    return df.withColumn("step", F.col(value) - F.coalesce(before, F.lit(0)))
