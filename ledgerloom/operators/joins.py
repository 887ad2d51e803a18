"""Joins with fallbacks, ranges, nearest matches and consumption."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Dimension rows up to which a small side is sent to every task; counted before it is.
SMALL_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """`df` with a broadcast hint if it has at most SMALL_ROWS rows (looked at, not assumed), else as it is."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def fallback_lookup(rows: DataFrame, registry: DataFrame, key: str, candidates: list[Column], id_column: str) -> DataFrame:
    """Looks up the first of several candidate keys that the registry has.

    registry(key, ...) has unique keys. Candidates are tried in order; rows
    without any match stay with nulls. Adds the registry's columns and
    `attempt` (1 for the first candidate). Candidates are exploded and joined
    once, so the chain's length doesn't add joins; null candidates are skipped.
    """
    tried = F.filter(F.transform(F.array(*[c.cast("string") for c in candidates]), lambda c, i: F.struct((i + 1).alias("attempt"), c.alias("_key"))), lambda x: x["_key"].isNotNull())
    exploded = rows.select(id_column, F.explode(tried).alias("t")).select(id_column, "t.attempt", "t._key").distinct()
    rest = [c for c in registry.columns if c != key]
    hits = exploded.join(small(registry), exploded._key == registry[key]).groupBy(id_column).agg(F.min(F.struct("attempt", key, *rest)).alias("m"))
    return rows.join(hits, id_column, "left").select(*[rows[c] for c in rows.columns], F.col("m.attempt").cast("long").alias("attempt"), F.col(f"m.{key}").alias(f"matched_{key}"), *[F.col(f"m.{c}").alias(c) for c in rest])


def merge_preferring_left(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Full outer merge: the left value wins, the right fills gaps; counts of both per row.

    Null keys match null keys. Adds filled (right value used) and conflicts
    (both present and different). Both sides have one row per key.
    """
    a = left.select(*[F.col(c).alias(f"l_{c}") for c in (*keys, *fields)], F.lit(1).alias("in_l"))
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in (*keys, *fields)], F.lit(1).alias("in_r"))
    same = reduce(lambda x, y: x & y, [F.col(f"l_{k}").eqNullSafe(F.col(f"r_{k}")) for k in keys])
    both = a.join(b, same, "full_outer")
    filled = sum((F.when(F.col(f"l_{f}").isNull() & F.col(f"r_{f}").isNotNull(), 1).otherwise(0) for f in fields), F.lit(0))
    conflicts = sum((F.when(F.col(f"l_{f}") != F.col(f"r_{f}"), 1).otherwise(0) for f in fields), F.lit(0))
    return both.select(*[F.coalesce(f"l_{k}", f"r_{k}").alias(k) for k in keys], *[F.coalesce(f"l_{f}", f"r_{f}").alias(f) for f in fields], filled.cast("long").alias("filled"), conflicts.cast("long").alias("conflicts"))


def range_join(points: DataFrame, at: str, ranges: DataFrame, low: str, high: str, width: float) -> DataFrame:
    """Points with the ranges [low, high) they lie in, as an equi-join on buckets of `width`.

    A range is listed in every bucket it touches, so that the join is a hash or
    sort-merge join, not a nested loop, whatever the size of either side.
    """
    listed = ranges.where(F.col(low) < F.col(high)).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    placed = points.withColumn("_bucket", F.floor(F.col(at) / width))
    return placed.join(listed, "_bucket").where((F.col(at) >= F.col(low)) & (F.col(at) < F.col(high))).drop("_bucket")


def nearest_center(points: DataFrame, at: str, centers: DataFrame, center: str, name: str, farthest: float) -> DataFrame:
    """Each point with the nearest centre at most `farthest` away (the lower one of equals), else without.

    Centres lie in buckets of twice the reach and a point asks its own bucket
    and both neighbours: an equi-join of any size. Points are told apart by all
    their columns; a null place has no centre.
    """
    width = farthest * 2 or 1.0
    listed = centers.select(F.explode(F.array(F.floor(F.col(center) / width) - 1, F.floor(F.col(center) / width), F.floor(F.col(center) / width) + 1)).alias("_bucket"), F.col(center).alias("_center"), F.col(name).alias("_name"))
    spots = points.select(at).where(F.col(at).isNotNull()).distinct().withColumn("_bucket", F.floor(F.col(at) / width))
    near = spots.join(listed, "_bucket").withColumn("_far", F.abs(F.col(at) - F.col("_center"))).where(F.col("_far") <= farthest)
    best = near.groupBy(at).agg(F.min(F.struct("_far", "_center", "_name")).alias("b")).select(F.col(at).alias("_at"), F.col("b._name").alias(name), F.col("b._far").alias("distance"))
    return points.join(best, points[at] == best._at, "left").drop("_at")


def one_to_one(expected: DataFrame, predicted: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Matches equal keys one to one: the k-th row here with the k-th there; leftovers on both sides stay.

    Returns keys, nth, expected, predicted (both boolean). Exact for any predicate
    that is an equivalence; nothing is matched twice.
    """

    def numbered(df: DataFrame, side: str) -> DataFrame:
        return df.select(*keys, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long").alias("nth"), F.lit(True).alias(side))

    both = numbered(expected, "expected").join(numbered(predicted, "predicted"), [*keys, "nth"], "full_outer")
    return both.na.fill(False, ["expected", "predicted"])


def witnesses(sources: dict[str, DataFrame], keys: list[str], value: str, tolerance: float) -> DataFrame:
    """Values of one metric from several sources: count, least, greatest, whether they agree within `tolerance`."""
    stacked = reduce(DataFrame.unionByName, [df.select(*keys, F.col(value).cast("double").alias("v"), F.lit(name).alias("source")) for name, df in sources.items()])
    told = stacked.where("v is not null").groupBy(*keys).agg(F.count_distinct("source").alias("sources"), F.min("v").alias("low"), F.max("v").alias("high"))
    return told.withColumn("agree", (F.col("high") - F.col("low") <= tolerance) & (F.col("sources") == len(sources)))


def component_sums(wholes: DataFrame, parts: DataFrame, key: str, value: str, ord_: str) -> DataFrame:
    """Wholes that are the sum of two different parts of their key: key, whole, a, b.

    Not all pairs of a key: each part looks up the one value that completes the
    whole, an equi-join on (key, value). The pair of least a is told.
    """
    w = wholes.select(key, F.col(value).alias("whole")).distinct()
    p = parts.select(key, F.col(value).alias("a"), F.col(ord_).alias("oa"))
    q = parts.select(F.col(key).alias("_k"), F.col(value).alias("b"), F.col(ord_).alias("ob"))
    open_ = w.join(p, key).withColumn("_need", F.col("whole") - F.col("a")).where("a <= _need")
    hit = open_.join(q, (open_[key] == q._k) & (open_._need == q.b) & (open_.oa != q.ob))
    return hit.groupBy(key, "whole").agg(F.min(F.struct("a", "b")).alias("ab")).select(key, "whole", "ab.a", "ab.b")


def agreeing_pairs(rows: DataFrame, keys: list[str], columns: list[str], order: str, least: int = 2) -> DataFrame:
    """All pairs of rows of one key that are equal in `least` of the columns or more: keys, order, other, equal.

    A pair is told once, the row of the lower `order` first; rows of one order
    give no pair, nulls equal nothing. Rows meet by equi-join on the key and the
    values of `least` columns, so rows of a key that agree in less are never
    paired. A pair that meets in several places counts only where its first
    equal columns are, so repeated rows keep their number without a distinct.
    """
    places = [F.when(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in chosen]), F.struct(F.lit(i).alias("place"), F.array(*[F.col(c).cast("string") for c in chosen]).alias("held"))) for i, chosen in enumerate(combinations(columns, least))]
    listed = rows.select(*keys, order, *columns, F.explode(F.filter(F.array(*places), lambda x: x.isNotNull())).alias("_at")).select("*", "_at.place", "_at.held").drop("_at")
    there = listed.select(*keys, "place", "held", F.col(order).alias("other"), *[F.col(c).alias(f"_{c}") for c in columns])
    same = {c: F.coalesce(F.col(c) == F.col(f"_{c}"), F.lit(False)) for c in columns}
    met = listed.join(there, [*keys, "place", "held"]).where(F.col(order) < F.col("other"))
    first = F.slice(F.filter(F.array(*[F.when(same[c], F.lit(i)) for i, c in enumerate(columns)]), lambda x: x.isNotNull()), 1, least)
    own = F.element_at(F.array(*[F.array(*map(F.lit, chosen)) for chosen in combinations(range(len(columns)), least)]), F.col("place") + 1)
    equal = sum((F.when(same[c], 1).otherwise(0) for c in columns), F.lit(0))
    return met.where(first == own).select(*keys, order, "other", equal.cast("long").alias("equal"))


def within_edits(names: DataFrame, name: str, edits: int = 2) -> DataFrame:
    """(a, b): all pairs of different names at most `edits` edits apart, a before b.

    A name is cut into edits + 1 parts; of two names so near one part at least is
    whole in the other, at most `edits` places off. So names meet by equi-join on
    (length, part, text), never all with all, and the distance decides.
    """
    n = names.where(F.col(name).isNotNull()).select(F.col(name).alias("a")).distinct().withColumn("_l", F.length("a"))
    parts = edits + 1
    start = lambda length, i: F.floor(length * i / parts).cast("int")
    own = n.select("a", "_l", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.substring("a", start(F.col("_l"), i) + 1, start(F.col("_l"), i + 1) - start(F.col("_l"), i)).alias("t")) for i in range(parts)])).alias("k")).select("a", F.col("_l").alias("l"), "k.i", "k.t")
    lengths = n.select(F.col("a").alias("b"), F.explode(F.sequence(F.greatest(F.col("_l") - edits, F.lit(0)), F.col("_l") + edits)).alias("l"))
    asked = F.array(*[F.struct(F.lit(i).alias("i"), (start(F.col("l"), i) + off + 1).alias("at"), (start(F.col("l"), i + 1) - start(F.col("l"), i)).alias("size")) for i in range(parts) for off in range(-edits, edits + 1)])
    probes = lengths.select("b", "l", F.explode(asked).alias("q")).where("q.at >= 1 or q.size = 0").select("b", "l", "q.i", F.substring("b", F.greatest("q.at", F.lit(1)), F.col("q.size")).alias("t")).distinct()
    return own.join(probes, ["l", "i", "t"]).where("a < b").select("a", "b").distinct().where(F.levenshtein("a", "b") <= edits)
