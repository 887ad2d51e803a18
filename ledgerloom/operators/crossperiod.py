"""Comparison of two periods, key by key; nothing is ever altered."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The powers of ten that a slipped decimal point or unit gives.
POWERS = (0.001, 0.01, 0.1, 10.0, 100.0, 1000.0)


def near_power_of_ten(ratio: Column, within: float = 0.02) -> Column:
    """The ratio is a power of ten, give or take `within`."""
    return F.exists(F.array(*[F.lit(p) for p in POWERS]), lambda p: F.abs(ratio / p - 1) <= within)


def matched(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, old, new, ratio of the keys present in both; null keys match null keys, nil old values don't."""
    a = old.select(*keys, F.col(value).cast("double").alias("old")).where("old is not null and old != 0")
    b = new.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(value).cast("double").alias("new")).where("new is not null")
    on = reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_{k}"]) for k in keys])
    return a.join(b, on).select(*keys, "old", "new", (F.col("new") / F.col("old")).alias("ratio"))


def summary(pairs: DataFrame, group: str, least: int = 20) -> DataFrame:
    """group, matched, median ratio and unit shift; groups of fewer than `least` pairs are left out.

    unit_shift is 1000 or 1 where the median is within 5 % of 1000 or 0.001.
    """
    told = pairs.groupBy(group).agg(F.count(F.lit(1)).alias("matched"), F.median("ratio").alias("median_ratio")).where(F.col("matched") >= least)
    shift = F.when(F.abs(F.col("median_ratio") / 1000 - 1) <= 0.05, 1000).when(F.abs(F.col("median_ratio") / 0.001 - 1) <= 0.05, 1)
    return told.withColumn("unit_shift", shift.cast("long"))


def suspects(pairs: DataFrame, group: str, least: int = 20, outlier: float = 8.0) -> DataFrame:
    """Pairs whose ratio, relative to their group's median, is `outlier` times off either way.

    Adds signature (decimal_shift near a power of ten, else outlier) and priority
    (deviation, doubled for a shift, times 1 + the greatest magnitude ** 0.25).
    Negative relative ratios are no outliers.
    """
    med = summary(pairs, group, least).select(group, "median_ratio")
    rel = pairs.join(med, group).where("median_ratio != 0").withColumn("relative", F.col("ratio") / F.col("median_ratio"))
    deviation = F.when(F.col("relative") > 0, F.greatest(F.col("relative"), 1 / F.col("relative"))).otherwise(0.0)
    marked = rel.withColumn("deviation", deviation).where(F.col("deviation") >= outlier)
    shift = near_power_of_ten(F.col("relative"))
    size = F.pow(F.greatest(F.abs("old"), F.abs("new")), 0.25)
    return marked.withColumn("signature", F.when(shift, "decimal_shift").otherwise("outlier")).withColumn("priority", F.col("deviation") * F.when(shift, 2.0).otherwise(1.0) * (1 + size))


#: How much likelier a suspect's new value is the wrong one, where the old one is verified: by whether the new one is, too.
AGAINST_UNVERIFIED, AGAINST_VERIFIED = 4.0, 0.5


def by_verification(suspects: DataFrame, old_verified: Column, new_verified: Column) -> DataFrame:
    """Suspects with their priority weighed by verification: null counts as not verified, an unverified old value changes nothing."""
    old, new = (F.coalesce(c, F.lit(False)) for c in (old_verified, new_verified))
    return suspects.withColumn("priority", F.col("priority") * F.when(old & ~new, AGAINST_UNVERIFIED).when(old & new, AGAINST_VERIFIED).otherwise(1.0))
