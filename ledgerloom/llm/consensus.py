"""Consensus of several annotators by spectral reliability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import DASHES, SPACES, shortest
from ledgerloom.session import cut

#: Share of wrong readings of one cell that are the same wrong number; hard digits mislead alike.
COINCIDENCE = 0.45


def reading_number(text):
    """The number a reading states, as its shortest text; null for null, blank, a dash or what isn't a number.

    A comma is the decimal mark and dots then group digits; without a comma a
    dot is the decimal mark. Leading and trailing zeros don't matter, so equal
    numbers of any length are equal texts.
    """
    bare = F.regexp_replace(F.regexp_replace(text, SPACES, ""), "[−–—]", "-")
    plain = F.when(F.contains(bare, F.lit(",")), F.regexp_replace(F.regexp_replace(bare, r"\.", ""), ",", ".")).otherwise(bare)
    return F.when(~bare.isin(*DASHES), shortest(plain))


def votes_of(readings: DataFrame) -> DataFrame:
    """(cell, annotator, num, role): each annotator's latest reading of each cell.

    readings(reading_id, value_id, annotator, role, value, read_at). Readings of
    nothing (null, blank, dash), or without cell or annotator, don't count;
    of readings at one time the one of the highest reading_id counts, so a
    repeated row weighs once. One aggregation, whose size no repetition raises.
    """
    told = readings.where("value_id is not null and annotator is not null").select(F.col("value_id").alias("cell"), "annotator", reading_number(F.col("value")).alias("num"), "role", "read_at", "reading_id").where("num is not null")
    last = told.groupBy("cell", "annotator").agg(F.max(F.struct("read_at", "reading_id", "num", "role")).alias("v"))
    return last.select("cell", "annotator", "v.num", "v.role")


def agreement_matrix(votes: DataFrame) -> DataFrame:
    """(a, b, overlap, agree): sparse, symmetric, without diagonal.

    Cells that the same annotators read in the same division are one pattern
    (told by order-free hashes, in mergeable aggregations); the pairs arise from
    one cell of each pattern, weighted by how many cells it stands for. So the
    work grows with the number of patterns and of annotators, not with cells,
    and repeated readings of a cell add nothing.
    """
    groups = votes.groupBy("cell", "num").agg(F.bit_xor(F.xxhash64("annotator")).alias("x"), F.sum(F.shiftright(F.xxhash64("annotator", F.lit(1)), 16)).alias("s"), F.count(F.lit(1)).alias("n"))
    marks = groups.groupBy("cell").agg(F.bit_xor(F.xxhash64("x", "s", "n")).alias("p1"), F.sum(F.shiftright(F.xxhash64("s", "x"), 16)).alias("p2"), F.sum("n").alias("k")).where("k > 1")
    patterns = marks.groupBy("p1", "p2", "k").agg(F.min("cell").alias("cell"), F.count(F.lit(1)).alias("weight"))
    shown = cut(votes.join(patterns.select("cell", "weight"), "cell").select("cell", "annotator", "num", "weight"))
    left, right = shown.toDF("cell", "a", "num_a", "weight"), shown.select("cell", F.col("annotator").alias("b"), F.col("num").alias("num_b"))
    half = left.join(right, "cell").where("a < b").groupBy("a", "b").agg(F.sum("weight").alias("overlap"), F.sum(F.when(F.col("num_a") == F.col("num_b"), F.col("weight")).otherwise(0)).alias("agree"))
    return half.unionByName(half.select(F.col("b").alias("a"), F.col("a").alias("b"), "overlap", "agree"))


def chance_of(votes: DataFrame) -> DataFrame:
    """One row: the chance that two readings of different cells are the same number."""
    return votes.groupBy("num").agg(F.count(F.lit(1)).cast("double").alias("n")).agg(F.coalesce(F.sum(F.col("n") * F.col("n")) / F.pow(F.sum("n"), 2), F.lit(0.0)).alias("chance"))


def leading_vector(matrix: DataFrame, start: DataFrame | None = None, coincidence: float = COINCIDENCE, steps: int = 4, tolerance: float = 1e-4, most: int = 80) -> DataFrame:
    """(annotator, reliability, overlaps): the leading eigenvector u by power iteration.

    matrix(a, b, overlap, centred). Of the agreement of a and b the chance
    that both err alike, `coincidence` * (1 - u_a)(1 - u_b), is taken off, too.
    An annotator's agreement with itself isn't known, nor do all pairs share as
    many cells; so in the eigenvector's equation both sides are summed over the
    pairs there are, weighted by their overlap:
    u_a = sum(overlap * centred * u_b) / sum(overlap * u_b^2). With equal
    overlaps this is the eigenvector of the matrix with the diagonal u_a^2. One
    iteration is a join of the sparse matrix with the vector and an
    aggregation. A vector too large by a factor gives one too small by it, so
    the last of the `steps` between two checkpoints takes the geometric mean
    with the one before. u is the share of right readings. `start` is a vector to go on
    from (annotator, reliability), else every annotator starts alike. A vector
    that still changes by `tolerance` or more after `most` iterations raises.
    """
    degree = matrix.groupBy("a").agg(F.sum("overlap").alias("overlaps"))
    vector = degree.select(F.col("a").alias("node"), F.lit(0.9).alias("u"), "overlaps")
    if start is not None:
        vector = degree.join(start.select(F.col("annotator").alias("a"), "reliability"), "a", "left").select(F.col("a").alias("node"), F.coalesce("reliability", F.lit(0.9)).alias("u"), "overlaps")
    vector = cut(vector)
    # A diagonal of no weight hands each annotator's own value through the one join.
    own = vector.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0.0).alias("overlap"), F.lit(0.0).alias("centred"))
    matrix = cut(matrix.select("a", "b", F.col("overlap").cast("double").alias("overlap"), "centred").unionByName(own))

    def turn(v: DataFrame, last: bool) -> DataFrame:
        weight, ub = F.col("overlap"), F.col("u")
        held = F.max(F.when(F.col("a") == F.col("b"), F.struct("u", "overlaps")))
        moved = matrix.join(v.withColumnRenamed("node", "b"), "b").groupBy("a").agg(held.alias("own"), F.sum(weight * F.col("centred") * ub).alias("up"), F.sum(weight * (1 - ub) * ub).alias("alike"), F.sum(weight * ub * ub).alias("down"))
        y = F.greatest((F.col("up") - coincidence * (1 - F.col("own.u")) * F.col("alike")) / F.col("down"), F.lit(1e-3))
        u = F.least(F.sqrt(F.col("own.u") * y), F.lit(0.995)) if last else F.least(y, F.lit(1.5))
        return moved.select(F.col("a").alias("node"), u.alias("u"), F.col("own.overlaps").alias("overlaps"))

    for _ in range(0, most, steps):
        new = vector
        for step in range(1, steps + 1):
            new = turn(new, step == steps)
        new = cut(new)
        moved = new.join(vector.select("node", F.col("u").alias("before")), "node").agg(F.max(F.abs(F.col("u") - F.col("before"))).alias("d")).first().d
        vector = new
        if moved is None or moved < tolerance:
            break
    else:
        raise RuntimeError(f"reliabilities still change by {moved:.1e} after {most} steps")
    return vector.select(F.col("node").alias("annotator"), F.greatest("u", F.lit(0.02)).alias("reliability"), F.col("overlaps").cast("long").alias("overlaps"))


def dependent_pairs(matrix: DataFrame, reliability: DataFrame, copied: float, deviations: float = 4.0, coincidence: float = COINCIDENCE) -> DataFrame:
    """(a, b, copied): annotators that agree far more than two independent readers of their reliability.

    Independent readers agree in e = r_a r_b + q (1 - r_a)(1 - r_b) of the
    shared cells, a copier of a share c in c + (1 - c) e. Pairs with c of
    `copied` or more, `deviations` standard deviations beyond e, are dependent.
    """
    ra, rb = reliability.select(F.col("annotator").alias("a"), F.col("reliability").alias("ra")), reliability.select(F.col("annotator").alias("b"), F.col("reliability").alias("rb"))
    e = F.col("ra") * F.col("rb") + coincidence * (1 - F.col("ra")) * (1 - F.col("rb"))
    off = matrix.join(ra, "a").join(rb, "b").withColumn("c", (F.col("centred") - e) / (1 - e)).withColumn("z", (F.col("centred") - e) * F.sqrt(F.col("overlap") / (e * (1 - e))))
    return off.where((F.col("c") >= copied) & (F.col("z") >= deviations)).select("a", "b", F.col("c").alias("copied"))


def reliabilities(votes: DataFrame, suspect: float = 0.4, copied: float = 0.72) -> tuple[DataFrame, DataFrame]:
    """Reliability per annotator, and the dependent pairs (child, parent, copied).

    Copies vouch for their original, so the eigenvector is taken three times:
    over all pairs, without those of a copied share of `suspect` or more, and
    without those that then still have `copied` (cells of unequal difficulty
    make good readers agree somewhat more than independent ones, copiers much
    more). Of a pair the one with fewer overlaps is the child.
    """
    raw = agreement_matrix(votes).withColumn("chance", chance_of(votes).scalar())
    matrix = cut(raw.select("a", "b", "overlap", ((F.col("agree") / F.col("overlap") - F.col("chance")) / F.greatest(1 - F.col("chance"), F.lit(1e-9))).alias("centred")))

    def without(pairs: DataFrame, start: DataFrame) -> DataFrame:
        return leading_vector(matrix.join(pairs.select("a", "b"), ["a", "b"], "left_anti"), start)

    rated = leading_vector(matrix)
    pairs = cut(dependent_pairs(matrix, rated, suspect))
    if not pairs.isEmpty():
        rated = without(pairs, rated)
        pairs = cut(dependent_pairs(matrix, rated, copied))
    rated = cut(without(pairs, rated))
    size = matrix.groupBy("a").agg(F.sum("overlap").alias("size"))
    told = pairs.join(size.toDF("a", "size_a"), "a").join(size.toDF("b", "size_b"), "b")
    links = told.where("size_a < size_b or (size_a = size_b and a > b)").select(F.col("a").alias("child"), F.col("b").alias("parent"), "copied")
    return rated, cut(links)


def decide(votes: DataFrame, rated: DataFrame, links: DataFrame, coincidence: float = COINCIDENCE, unrated: float = 0.8) -> DataFrame:
    """(cell, consensus, readers, agree, agreement, margin): the number with the most weight.

    A vote weighs log(r / ((1 - r) q)), q the share of wrong readings of a cell
    that coincide. A vote that repeats that of one of its parents weighs only
    what it adds if a share of such votes is copied. Annotators who share no
    cell with anybody count with reliability `unrated`. Of equal weights the
    number with more votes wins, then the smaller one. Numbers are texts, as of reading_number. margin is the lead over
    the next number, in log odds (over nothing if there is no other).
    """
    r = F.coalesce("reliability", F.lit(unrated))
    weighed = votes.join(rated.select("annotator", "reliability"), "annotator", "left").withColumn("r", F.least(F.greatest(r, F.lit(0.05)), F.lit(0.99)))
    repeats = votes.join(links, votes.annotator == links.child).select("cell", "num", "child", "parent", "copied").join(votes.select("cell", "num", F.col("annotator").alias("parent")), ["cell", "num", "parent"]).groupBy("cell", F.col("child").alias("annotator")).agg(F.max("copied").alias("copied"))
    c = F.coalesce("copied", F.lit(0.0))
    right, wrong = c + (1 - c) * F.col("r"), c + (1 - c) * (1 - F.col("r")) * coincidence
    scored = weighed.join(repeats, ["cell", "annotator"], "left").withColumn("w", F.log(right / wrong))
    sums = scored.groupBy("cell", "num").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("votes"))
    # The best and the next by mergeable aggregates; no cell is collected.
    order = F.struct(F.round("w", 9).alias("w"), "votes", (-F.col("num").cast("double")).alias("minus"), "num")
    best = sums.groupBy("cell").agg(F.max(order).alias("best"), F.sum("votes").alias("readers"), F.count(F.lit(1)).alias("numbers"))
    second = sums.join(best.select("cell", "best"), "cell").where(F.col("num") != F.col("best.num")).groupBy("cell").agg(F.max("w").alias("second"))
    return best.join(second, "cell", "left").select("cell", F.col("best.num").alias("consensus"), "readers", F.col("best.votes").alias("agree"), (F.col("best.votes") / F.col("readers")).alias("agreement"), (F.col("best.w") - F.coalesce("second", F.lit(0.0))).alias("margin"))


def consensus(readings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(votes, consensus per cell, reliability per annotator, dependent pairs) of readings.

    See votes_of for what counts. Cells without a reading are missing from the
    result. Empty input gives empty results; other columns are ignored.
    """
    votes = cut(votes_of(readings))
    rated, links = reliabilities(votes)
    return votes, decide(votes, rated, links), rated, links
