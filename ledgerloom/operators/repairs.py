"""Repairs that arithmetic proves, their gates, and checks run again after them. Every repair is told, none is silent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes as C
from ledgerloom.operators.rules import tolerance


def one_edit(a: Column, b: Column) -> Column:
    """Two numbers whose digits are one edit apart: a scanned digit wrong, lost or doubled."""
    digits = lambda c: F.regexp_replace(c.cast("string"), r"[^0-9]", "")
    return (a != b) & (F.levenshtein(digits(a), digits(b)) <= 1)


def proven_cells(cells: DataFrame, peers: DataFrame, keys: list[str], group: list[str], value: str, total: str) -> DataFrame:
    """keys, group, old, new: cells one edit from their peer's value where the peer's value, and nothing else, makes the group's sum right.

    cells(keys, group, value, total): keys tell a cell, group the parts of one
    sum whose printed total is `total`. Groups are summed once before the join;
    a group is repaired only if it is off, exactly one of its cells has such a
    peer, and the sum then equals the total to the last digit.
    """
    sums = cells.groupBy(*group).agg(F.sum(value).alias("_sum"), F.max(total).alias("_total")).where("_sum != _total")
    told = peers.groupBy(*keys).agg(F.min(value).alias("_peer"), F.count_distinct(value).alias("_n")).where("_n = 1")
    open_ = cells.select(*keys, *group, F.col(value).alias("old")).join(sums, group).join(told, keys)
    right = open_.where(one_edit(F.col("old"), F.col("_peer")) & (F.col("_sum") - F.col("old") + F.col("_peer") == F.col("_total")))
    alone = right.groupBy(*group).agg(F.count(F.lit(1)).alias("_k")).where("_k = 1")
    return right.join(alone, group).select(*keys, *[g for g in group if g not in keys], "old", F.col("_peer").alias("new"))


def repeated_cells(rows: DataFrame, keys: list[str], page: str, columns: list[str], least: int = 2) -> DataFrame:
    """keys, page, column, new: empty cells of a row that other pages repeat, filled where all repeats that agree with it say one value.

    A repeat is a row of the same keys on another page that equals this one in
    `least` columns or more and differs in none. Rows of a key are the repeats of
    one printed summary row; they meet by the key and by page.
    """
    here = rows.select(*keys, F.col(page).alias("_p"), *[F.col(c).alias(f"a_{c}") for c in columns])
    there = rows.select(*keys, F.col(page).alias("_q"), *[F.col(c).alias(f"b_{c}") for c in columns])
    lacking = None
    for c in columns:
        lacking = F.col(f"a_{c}").isNull() if lacking is None else lacking | F.col(f"a_{c}").isNull()
    pairs = here.where(lacking).join(there, keys).where("_p != _q")
    equal = sum((F.when(F.col(f"a_{c}") == F.col(f"b_{c}"), 1).otherwise(0) for c in columns), F.lit(0))
    unlike = sum((F.when(F.col(f"a_{c}") != F.col(f"b_{c}"), 1).otherwise(0) for c in columns), F.lit(0))
    agreeing = pairs.where((equal >= least) & (unlike == 0))
    offers = F.filter(F.array(*[F.when(F.col(f"a_{c}").isNull() & F.col(f"b_{c}").isNotNull(), F.struct(F.lit(c).alias("column"), F.col(f"b_{c}").alias("new"))) for c in columns]), lambda x: x.isNotNull())
    told = agreeing.select(*keys, "_p", F.explode(offers).alias("o")).groupBy(*keys, F.col("_p").alias(page), F.col("o.column").alias("column")).agg(F.min("o.new").alias("new"), F.count_distinct("o.new").alias("_n"))
    return told.where("_n = 1").drop("_n")


def accepted_readings(readings: DataFrame, job: list[str], value: str, expected: str, target: str, coefficient: str) -> DataFrame:
    """job, accepted, reason: re-read sets that are complete and whose signed sum closes on the target.

    readings(job, value, expected, target, coefficient): expected is how many
    terms a job has. Rounding of 0.01 a term is allowed. Incomplete sets, also
    those with an unread term, are refused before their sum is looked at.
    """
    g = readings.groupBy(*job).agg(F.count(value).alias("_read"), F.max(expected).alias("_expected"), F.sum(F.col(value) * F.col(coefficient)).alias("_sum"), F.max(target).alias("_target"))
    whole = F.col("_read") == F.col("_expected")
    closes = F.abs(F.col("_sum") - F.col("_target")) <= tolerance(F.col("_expected"))
    reason = F.when(~whole, "incomplete").when(~F.coalesce(closes, F.lit(False)), "sum").otherwise("closes")
    return g.select(*job, (reason == "closes").alias("accepted"), reason.alias("reason"))


def gated_codes(candidates: DataFrame, registry: DataFrame, lines: DataFrame, keys: list[str], code: str, score: str, least: float = 85.0) -> DataFrame:
    """Code candidates that the registry has, whose name scores `least` or more, and that no line of the same keys already has."""
    known = candidates.join(registry.select(F.col("code").alias(code)).distinct(), code, "left_semi").where(F.col(score) >= least)
    return known.join(lines.select(*keys, code).distinct(), [*keys, code], "left_anti")


def economic_groups(lines: DataFrame, keys: list[str], value: str, whole: str, titles: list[str]) -> DataFrame:
    """keys, printed, summed, difference: groups whose line `whole` isn't the sum of their title lines, beyond 0.01 a title present.

    A title's absent value counts as nil; an absent row is no term; groups
    without any title row aren't judged.
    """
    head = F.col("code") == whole
    part = F.col("code").isin(*titles)
    g = lines.where(head | part).groupBy(*keys).agg(F.sum(F.when(head, F.col(value))).alias("printed"), F.sum(F.when(part, F.coalesce(F.col(value), F.lit(0)))).alias("summed"), F.count_if(part).alias("_n"))
    off = F.col("printed") - F.col("summed")
    return g.where("printed is not null and _n > 0").withColumn("difference", off).where(F.abs("difference") > tolerance(F.col("_n"))).drop("_n")


def revalidated(issues: DataFrame, fresh: DataFrame, keep: tuple[str, ...] = ("info",), provenance: str = "repair") -> DataFrame:
    """Issues after checks were run again: earlier errors and warnings go, notes and the log of repairs stay, fresh ones come."""
    stays = F.col("severity").isin(*keep) | (F.col("check") == provenance)
    return issues.where(stays).unionByName(fresh.select(*issues.columns))


def repair_log(repairs: DataFrame, keys: list[str], method: str) -> DataFrame:
    """Repairs as issues of their own: keys, check, severity, note."""
    return repairs.select(*keys, F.lit("repair").alias("check"), F.lit("info").alias("severity"), F.concat_ws(" ", F.lit(method), F.col("old").cast("string"), F.lit("->"), F.col("new").cast("string")).alias("note"))


def exact_sections(parts: DataFrame, keys: list[str], section: str, value: str, total: str, names: tuple[str, str]) -> DataFrame:
    """keys: groups whose two sections are both not nil and add up to the printed total to the last digit."""
    s = [F.sum(F.when(F.col(section) == n, F.col(value))) for n in names]
    g = parts.groupBy(*keys).agg(s[0].alias("_a"), s[1].alias("_b"), F.max(total).alias("_t"))
    return g.where("_a != 0 and _b != 0 and _a + _b = _t").select(*keys, F.col("_a").alias(names[0]), F.col("_b").alias(names[1]))


def direct_children(lines: DataFrame, keys: list[str], code: str = "code") -> DataFrame:
    """keys, code, child: codes right below each code that is there, by a join on the child's parent (no prefix comparison)."""
    distinct = lines.select(*keys, code).where(F.col(code).isNotNull()).distinct()
    up = distinct.select(*keys, F.col(code).alias("child"), C.parent_code(F.col(code), F.lit("expense_economic")).alias(code)).where(F.col(code).isNotNull())
    return distinct.join(up, [*keys, code])
