"""Truth against prediction, drafts against reviews: staged matches, consumption, change sets, scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.operators.grids import weighted_alignment


def staged(left: DataFrame, right: DataFrame, left_id: str, right_id: str, stages: list[tuple[list[str], str]]) -> DataFrame:
    """(left_id, right_id, stage): rows matched in stages, each taking only rows no stage before took.

    A stage is (columns, name): equal columns, where neither side has them
    twice among the rows left over (an ambiguous key matches nothing). Null keys
    match nothing. Both sides have the stages' columns.
    """
    out, l, r = None, left, right  # noqa: E741
    for columns, name in stages:
        once = lambda df, key: df.dropna(subset=columns).groupBy(*columns).agg(F.min(key).alias(key), F.count(F.lit(1)).alias("_n")).where("_n = 1").drop("_n")  # noqa: E731, B023
        hit = once(l, left_id).join(once(r, right_id), columns).select(left_id, right_id, F.lit(name).alias("stage"))
        out = hit if out is None else out.unionByName(hit)
        l, r = l.join(hit, left_id, "left_anti"), r.join(hit, right_id, "left_anti")  # noqa: E741
    return out


def fuzzy_unique(left: DataFrame, right: DataFrame, left_id: str, right_id: str, block: list[str], name: str, score: float = 94.0, shortest: int = 12) -> DataFrame:
    """(left_id, right_id, score): names of one block that are each other's best at `score` or more; names under `shortest` letters aren't tried.

    Names meet only where they share a block and a word of four letters or more
    (an equi-join, never all pairs of a block), once for each two different
    names; a pair stands only if neither side scores equally with another.
    """

    def keyed(df: DataFrame, key: str, tag: str) -> DataFrame:
        named = df.where(F.length(name) >= shortest).select(*block, F.col(key), T.fold(F.col(name)).alias(f"_{tag}"))
        return named.select("*", F.explode(F.array_distinct(F.filter(T.words(F.col(f"_{tag}")), lambda w: F.length(w) >= 4))).alias("_word"))

    a, b = keyed(left, left_id, "a"), keyed(right, right_id, "b")
    met = a.join(b, [*block, "_word"]).select(left_id, right_id, "_a", "_b").distinct()
    scores = met.select("_a", "_b").distinct().withColumn("score", T.fuzzy("indel")(F.col("_a"), F.col("_b"))).where(F.col("score") >= score)
    told = met.join(scores, ["_a", "_b"])
    for key in (left_id, right_id):
        best = F.max("score").over(W.partitionBy(key))
        told = told.withColumn("_best", best).where("score = _best").withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(key))).where("_n = 1").drop("_best", "_n")
    return told.select(left_id, right_id, "score")


def consumed_sums(wholes: DataFrame, parts: DataFrame, key: str, value: str, whole_id: str, part_id: str) -> DataFrame:
    """(key, whole_id, a, b): wholes confirmed by two parts of their key that no other whole uses.

    Candidates come from an equi-join on what a part lacks to the whole. Of
    candidates that want one part the first in order of (whole, a, b) has it:
    rounds of mutual firsts, told by windows, until nothing is left to take, so
    the result is that of taking them one by one.
    """
    p = parts.select(key, F.col(value).alias("_va"), F.col(part_id).alias("a"))
    q = parts.select(F.col(key).alias("_k"), F.col(value).alias("_vb"), F.col(part_id).alias("b"))
    w = wholes.select(key, F.col(value).alias("_whole"), F.col(whole_id))
    lacking = w.join(p, key).withColumn("_need", F.col("_whole") - F.col("_va"))
    cand = lacking.join(q, (lacking[key] == q._k) & (lacking._need == q._vb) & (F.col("a") < F.col("b"))).select(key, whole_id, "a", "b")
    # A key's candidates are few: the parts of one printed sum. Greedy in order, as a fold over them.
    listed = cand.select(key, F.struct(whole_id, "a", "b").alias("_o")).distinct().groupBy(key).agg(F.array_sort(F.collect_list("_o")).alias("os"))
    start = F.struct(F.array().cast(f"array<{dict(parts.dtypes)[part_id]}>").alias("parts"), F.array().cast(f"array<{dict(wholes.dtypes)[whole_id]}>").alias("wholes"), F.array().cast(listed.schema["os"].dataType).alias("taken"))

    def step(acc: Column, o: Column) -> Column:
        free = ~F.array_contains(acc["wholes"], o[whole_id]) & ~F.array_contains(acc["parts"], o["a"]) & ~F.array_contains(acc["parts"], o["b"])
        return F.when(free, F.struct(F.concat(acc["parts"], F.array(o["a"], o["b"])).alias("parts"), F.concat(acc["wholes"], F.array(o[whole_id])).alias("wholes"), F.concat(acc["taken"], F.array(o)).alias("taken"))).otherwise(acc)

    return listed.select(key, F.explode(F.aggregate("os", start, step)["taken"]).alias("o")).select(key, "o.*")


def draft_classes(primary: DataFrame, second: DataFrame, keys: list[str], value: str, tolerance: float = 0.0) -> DataFrame:
    """keys, both values and class: confirmed, conflicting, single_source (one side only) or uncovered (a row without a value on either side)."""
    a = primary.select(*keys, F.col(value).alias("first_value"), F.lit(True).alias("_a"))
    b = second.select(*keys, F.col(value).alias("second_value"), F.lit(True).alias("_b"))
    both = a.join(b, keys, "full_outer")
    x, y = F.col("first_value"), F.col("second_value")
    kind = F.when(x.isNull() & y.isNull(), "uncovered").when(x.isNull() | y.isNull(), "single_source").when(F.abs(x - y) <= tolerance, "confirmed").otherwise("conflicting")
    return both.select(*keys, "first_value", "second_value", kind.alias("class"))


def scored(matches: DataFrame, by: list[str]) -> DataFrame:
    """Expected, predicted, matched, and recall and precision in percent, by group and for all (level 1).

    matches(by, expected, predicted): booleans of `one_to_one`. Nothing expected
    has no recall; nothing predicted has precision 0 if something was expected.
    """
    told = matches.groupingSets([[F.col(c) for c in by], []], *by).agg(F.count_if("expected").alias("expected"), F.count_if("predicted").alias("predicted"), F.count_if(F.col("expected") & F.col("predicted")).alias("matched"), F.grouping(by[0]).cast("long").alias("level"))
    pct = lambda n: F.when(F.col(n) > 0, F.round(100 * F.col("matched") / F.col(n), 2))
    return told.select(*by, "level", "expected", "predicted", "matched", pct("expected").alias("recall"), F.when(F.col("predicted") > 0, pct("predicted")).when(F.col("expected") > 0, 0.0).alias("precision"))


class ConflictError(ValueError):
    """A change set that doesn't fit its rows."""


def changed(rows: DataFrame, keys: list[str], cell: str, value: str, deletions: DataFrame, overrides: DataFrame, corrections: DataFrame, additions: DataFrame) -> DataFrame:
    """keys, cell, value, method: rows after a change set; precedence is deleted row, whole-row override, per-cell correction, addition.

    rows, overrides, corrections and additions are cells (keys, cell, value),
    deletions are keys. An override replaces all cells of its row. Raises
    ConflictError if a correction's cell isn't there, an addition's cell is, or
    a correction or addition is told twice; each is one counted join.
    """
    place = [*keys, cell]
    tell = lambda df, name: df.select(*place, value, F.lit(name).alias("method"))
    kept = tell(rows.join(deletions.select(*keys).distinct(), keys, "left_anti").join(overrides.select(*keys).distinct(), keys, "left_anti"), "read").unionByName(tell(overrides.join(deletions.select(*keys).distinct(), keys, "left_anti"), "override"))
    for what, df in (("corrected", corrections), ("added", additions)):
        if not df.groupBy(*place).count().where("count > 1").isEmpty():
            raise ConflictError(f"a cell is {what} twice")
    if not corrections.join(kept, place, "left_anti").isEmpty():
        raise ConflictError("a correction has no cell")
    if not additions.join(kept, place, "left_semi").isEmpty():
        raise ConflictError("an addition's cell exists")
    right = corrections.select(*place, F.col(value).alias("_new"), F.lit(True).alias("_c"))
    merged = kept.join(right, place, "left").select(*place, F.when(F.col("_c"), F.col("_new")).otherwise(F.col(value)).alias(value), F.when(F.col("_c"), "correction").otherwise(F.col("method")).alias("method"))
    return merged.unionByName(tell(additions, "addition"))


def by_precedence(sources: list[tuple[str, DataFrame]], keys: list[str], value: str) -> DataFrame:
    """keys, value, method, also: each key's value of the first source that has it, and how many others have it."""
    stacked = reduce(DataFrame.unionByName, [df.where(F.col(value).isNotNull()).select(*keys, F.col(value), F.lit(i).alias("_rank"), F.lit(name).alias("method")) for i, (name, df) in enumerate(sources)])
    best = stacked.groupBy(*keys).agg(F.min(F.struct("_rank", value, "method")).alias("m"), F.count_distinct("method").alias("_n"))
    return best.select(*keys, F.col(f"m.{value}").alias(value), "m.method", (F.col("_n") - 1).alias("also"))


def not_partitioned(pages: DataFrame, classified: DataFrame, key: list[str], page: str) -> DataFrame:
    """keys, page, problem: pages that the classification has twice, lacks, or made up. Empty for a partition."""
    told = classified.groupBy(*key, page).agg(F.count(F.lit(1)).alias("_n"))
    all_pages = pages.select(*key, page).distinct().withColumn("_there", F.lit(True))
    both = all_pages.join(told, [*key, page], "full_outer")
    problem = F.when(F.col("_there").isNull(), "unknown").when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "repeated")
    return both.select(*key, page, problem.alias("problem")).where("problem is not null")


def in_ranges(rows: DataFrame, contexts: DataFrame, keys: list[str], at: str, fields: list[str]) -> DataFrame:
    """Rows with the context of the explicit range (first, last) they lie in; `clear` empties the fields; rows in no range keep theirs.

    contexts(keys, first, last, clear, fields). Ranges of a key are disjoint (a
    row in two raises nothing but takes the later first). An as-of look back:
    each row meets the last range that begins at or before it, by one window.
    """
    start = contexts.select(*keys, F.col("first").alias(at), F.lit(0).alias("_row"), F.struct("first", "last", "clear", *fields).alias("_range"))
    body = rows.select(*keys, F.col(at).cast(dict(start.dtypes)[at]).alias(at), F.lit(1).alias("_row"), F.lit(None).cast(start.schema["_range"].dataType).alias("_range"), F.struct(*[c for c in rows.columns if c not in (*keys, at)]).alias("_rest"))
    stacked = start.withColumn("_rest", F.lit(None).cast(body.schema["_rest"].dataType)).unionByName(body)
    held = F.last("_range", ignorenulls=True).over(W.partitionBy(*keys).orderBy(at, "_row").rowsBetween(W.unboundedPreceding, 0))
    told = stacked.withColumn("_held", held).where("_row = 1")
    inside = F.col("_held").isNotNull() & (F.col(at) <= F.col("_held.last"))
    rest = [c for c in rows.columns if c not in (*keys, at)]
    new = {f: F.when(inside & F.col("_held.clear"), None).when(inside, F.coalesce(F.col(f"_held.{f}"), F.col(f"_rest.{f}"))).otherwise(F.col(f"_rest.{f}")) for f in fields}
    return told.select(*keys, at, *[new.get(c, F.col(f"_rest.{c}")).alias(c) for c in rest])


__all__ = ["ConflictError", "by_precedence", "changed", "consumed_sums", "draft_classes", "fuzzy_unique", "in_ranges", "not_partitioned", "scored", "staged", "weighted_alignment"]
