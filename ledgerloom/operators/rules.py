"""Arithmetic checks over lines: sums, identities, sections, duplicates, missing parts.

Absent isn't zero: a missing row makes a rule not apply, a missing value of a
present row counts as nil, as each rule says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import small


def tolerance(terms: Column, unit: float = 0.01, least: int = 2) -> Column:
    """Rounding slack of a sum of so many printed terms."""
    return F.greatest(terms, F.lit(least)) * F.lit(str(unit)).cast("decimal(10,4)")


def row_checksum(wide: DataFrame, total: str, parts: list[str], slack: str = "0.04") -> DataFrame:
    """Rows whose total isn't the sum of all their parts; rows with any of them absent aren't judged."""
    present = F.col(total).isNotNull()
    added = None
    for p in parts:
        present = present & F.col(p).isNotNull()
        added = F.col(p) if added is None else added + F.col(p)
    off = F.col(total) - added
    return wide.where(present).withColumn("difference", off).where(F.abs(off) > F.lit(slack).cast("decimal(10,4)"))


def hierarchy(parents: DataFrame, children: DataFrame, keys: list[str], parent: str = "parent_value", child: str = "child_value") -> DataFrame:
    """Parents that aren't the sum of their children, beyond 0.01 per term.

    A child's absent value counts as nil, a parent without children isn't
    judged, nor is one of a nil sum of children. keys identify the parent in
    both inputs. Children are summed before the join.
    """
    sums = children.groupBy(*keys).agg(F.sum(F.coalesce(child, F.lit(0))).alias("children_sum"), F.count(F.lit(1)).alias("terms"))
    joined = parents.where(F.col(parent).isNotNull()).join(sums, keys)
    off = F.col(parent) - F.col("children_sum")
    skipped = (F.col("children_sum") == 0) & (F.col(parent) != 0)
    return joined.withColumn("difference", off).where((F.abs(off) > tolerance(F.col("terms"))) & ~skipped)


def identities(values: DataFrame, terms: DataFrame, keys: list[str]) -> DataFrame:
    """Every identity of every group of which all terms are present, with its difference.

    values(keys, code, value), terms(identity, code, coeff, is_target). target
    minus the signed sum of the terms, `holds` within 0.01 per term. Codes that
    occur repeatedly in a group count as their sum.
    """
    wanted = terms.groupBy("identity").agg(F.count(F.lit(1)).alias("n_terms"))
    codes = values.groupBy(*keys, "code").agg(F.sum("value").alias("value"))
    joined = codes.join(small(terms), "code").groupBy(*keys, "identity").agg(
        F.count(F.lit(1)).alias("present"),
        F.sum(F.when(F.col("is_target"), F.col("value")).otherwise(0)).alias("target"),
        F.sum(F.when(~F.col("is_target"), F.col("value") * F.col("coeff")).otherwise(0)).alias("signed_sum"),
    )
    whole = joined.join(wanted, "identity").where("present = n_terms")
    off = F.col("target") - F.col("signed_sum")
    return whole.withColumn("difference", off).withColumn("holds", F.abs(off) <= tolerance(F.col("n_terms") - 1)).drop("present")


def cross_section(lines: DataFrame, keys: list[str], section: str, value: str, whole: str, parts: list[str], slack: str = "0.02") -> DataFrame:
    """Keys that have all sections, where the whole isn't the sum of the parts. A present row's absent value is nil."""
    names = [whole, *parts]
    aggs = [x for i, n in enumerate(names) for x in (F.sum(F.when(F.col(section) == n, F.coalesce(value, F.lit(0)))).alias(f"v{i}"), F.max(F.when(F.col(section) == n, 1)).alias(f"h{i}"))]
    wide = lines.groupBy(*keys).agg(*aggs)
    for i in range(len(names)):
        wide = wide.where(F.col(f"h{i}").isNotNull())
    added = sum((F.col(f"v{i}") for i in range(2, len(names))), F.col("v1"))
    off = F.col("v0") - added
    return wide.withColumn("whole", F.col("v0")).withColumn("parts", added).withColumn("difference", off).where(F.abs(off) > F.lit(slack).cast("decimal(10,4)")).select(*keys, "whole", "parts", "difference")


def conflicting_duplicates(lines: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Repeated keys: rows, how many differ from the key's first row in `values`. Only keys with a difference."""
    image = F.xxhash64(*[x for v in values for x in (F.col(v), F.col(v).isNull())])
    marked = lines.withColumn("_image", image)
    firsts = marked.groupBy(*keys).agg(F.min(F.struct(*order, "_image")).alias("_f"), F.count(F.lit(1)).alias("rows"))
    images = marked.groupBy(*keys, "_image").agg(F.count(F.lit(1)).alias("n"))
    same = firsts.select(*[F.col(k).alias(f"k_{k}") for k in keys], F.col("_f._image").alias("first_image"), "rows")
    on = None
    for k in keys:
        on = images[k].eqNullSafe(same[f"k_{k}"]) if on is None else on & images[k].eqNullSafe(same[f"k_{k}"])
    differing = images.join(same.where("rows > 1"), on).where("_image != first_image")
    return differing.groupBy(*keys).agg(F.max("rows").alias("rows"), F.sum("n").alias("different"))


def residual_of_missing(parts: DataFrame, wholes: DataFrame, keys: list[str], part: str, value: str, total: str, expected: list[str]) -> DataFrame:
    """Keys that lack exactly one expected part and have another: the missing part and what is left for it.

    Nothing is told if the rest is within rounding of nil. Repeated parts are added up.
    """
    names = F.array(*[F.lit(x) for x in expected])
    seen = parts.where(F.col(part).isin(*expected)).groupBy(*keys).agg(F.collect_set(part).alias("_seen"), F.sum(value).alias("_sum"))
    lacking = seen.withColumn("_missing", F.array_except(names, "_seen")).where("size(_missing) = 1 and size(_seen) >= 1")
    left = wholes.join(lacking, keys).withColumn("residual", F.col(total) - F.col("_sum"))
    return left.where(F.abs("residual") > tolerance(F.lit(len(expected)))).select(*keys, F.col("_missing")[0].alias("missing"), "residual")
