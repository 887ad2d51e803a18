"""Greedy choice under caps, as a fold over a bounded, pre-sorted list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def greedy_plan(candidates: DataFrame, group: str, order: list, cost: str, cap: float, calls: int, key: str, most: int = 100_000) -> DataFrame:
    """The candidates of each group admitted in order while cost and call caps allow, skipping those that don't fit.

    Order-dependent and not associative: a group is one fold, in the JVM. A
    group of more than `most` candidates raises instead of filling a task; only
    candidates of a cost within the cap can ever be admitted, so others don't
    enter the fold. Null costs are never admitted.
    """
    fitting = candidates.where(F.col(cost).isNotNull() & (F.col(cost) <= cap)).select(group, F.struct(*order, F.col(cost).cast("double").alias("_cost"), F.col(key).alias("_key")).alias("c"))
    longest = fitting.groupBy(group).count().agg(F.max("count").alias("n")).first().n or 0
    if longest > most:
        raise ValueError(f"a group has {longest} candidates, more than {most}")
    checked = fitting.groupBy(group).agg(F.array_sort(F.collect_list("c")).alias("cs"))
    start = F.struct(F.lit(0.0).alias("spent"), F.lit(0).alias("used"), F.array().cast(f"array<{dict(candidates.dtypes)[key]}>").alias("keys"))

    def step(acc, c):
        fits = (acc["spent"] + c["_cost"] <= cap) & (acc["used"] < calls)
        return F.when(fits, F.struct((acc["spent"] + c["_cost"]).alias("spent"), (acc["used"] + 1).alias("used"), F.concat(acc["keys"], F.array(c["_key"])).alias("keys"))).otherwise(acc)

    return checked.select(group, F.aggregate("cs", start, step).alias("p")).select(group, F.posexplode("p.keys").alias("place", key))
