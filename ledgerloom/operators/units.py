"""Amounts in mixed units brought to one unit, from links between sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.graph import propagate
from ledgerloom.session import cut


def pairwise_scales(links: DataFrame, min_links: int = 3, snap: tuple[float, ...] = (-9, -6, -3, 0, 3, 6, 9), snap_within: float = 0.5, offset_within: float = 0.5) -> DataFrame:
    """Robust scale and offset of each pair of sources, snapped to known conversions.

    links(a, b, x, y): x and y are what sources a and b say of one entity, and
    y = scale * x + offset is wanted. log10 of the scale is the median of
    log10 |y/x|; if a power in `snap` lies within `snap_within` of it, that is
    the conversion, else (or with fewer than `min_links` links) there is none.
    offset is the median of y - scale * x under the snapped scale; units of
    money have no offset, so a pair whose offset is more than `offset_within`
    of its median |y| isn't told apart by its unit and has no power. Returns
    (a, b, n_links, log_scale, power, offset); power is null where none is
    known, so that no pair of sources is lost. Links with a null or nil amount
    count for nothing. Mergeable sketches only, so that a pair of any size is
    spread over tasks.
    """
    usable = links.where("x != 0 and y != 0 and a is not null and b is not null")
    found = usable.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_links"), F.percentile_approx(F.log10(F.abs(F.col("y") / F.col("x"))), 0.5, 10000).alias("log_scale"))
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col("log_scale") - float(s)).alias("off"), F.lit(float(s)).alias("power")) for s in snap]))
    snapped = found.withColumn("near", nearest).withColumn("power", F.when((F.col("n_links") >= min_links) & (F.col("near.off") <= snap_within), F.col("near.power"))).drop("near")
    rest = F.col("y") - F.pow(F.lit(10.0), F.col("power")) * F.col("x")
    offsets = usable.join(snapped.where("power is not null").select("a", "b", "power"), ["a", "b"]).groupBy("a", "b").agg(F.percentile_approx(rest, 0.5, 10000).alias("offset"), F.percentile_approx(F.abs("y"), 0.5, 1000).alias("size"))
    told = snapped.join(offsets, ["a", "b"], "left")
    return told.withColumn("power", F.when(F.abs("offset") <= offset_within * F.col("size"), F.col("power"))).drop("size")


def source_scales(amounts: DataFrame, **options) -> DataFrame:
    """Power of ten by which each source's amounts are off their group's common scale.

    amounts(grp, source, rank, entity, amount): sources of one grp tell amounts
    of the same entities, in what their label says is one unit. Repeated rows of
    an (entity, source) count as their largest amount. Each entity links only
    sources that follow one another in `rank` (never all pairs), pairwise scales
    are estimated and snapped (`pairwise_scales`), and potentials are carried
    through the graph of sources. In a connected part the scale held by most
    sources is the common one; of equal counts, that whose amounts' median is
    nearest the median of all amounts. Returns (grp, source, power, reference,
    n_sources): power 0 for a source on the common scale. Sources without a
    usable link are missing from the result. Rows with a null grp, source,
    entity or amount count for nothing.
    """
    rows = amounts.where("grp is not null and source is not null and entity is not null and amount is not null and amount != 0")
    spot = rows.groupBy("grp", "entity", "source").agg(F.max("rank").alias("rank"), F.max_by("amount", F.abs(F.col("amount"))).alias("amount"))
    spot = cut(spot)
    # An entity's sources, in order, in one small array: there are as many as editions.
    chain = spot.groupBy("grp", "entity").agg(F.sort_array(F.collect_list(F.struct("rank", "source", "amount"))).alias("c")).where(F.size("c") > 1)
    steps = chain.select("grp", F.explode(F.arrays_zip(F.slice("c", 1, F.size("c") - 1).alias("p"), F.slice("c", 2, F.size("c") - 1).alias("q"))).alias("s"))
    links = steps.select(F.col("s.p.source").alias("a"), F.col("s.q.source").alias("b"), F.col("s.p.amount").cast("double").alias("x"), F.col("s.q.amount").cast("double").alias("y"))
    pairs = pairwise_scales(links, **options).where("power is not null")
    placed = propagate(pairs.select("a", "b", F.col("power").alias("shift")))
    sizes = spot.groupBy("grp", "source").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(F.log10(F.abs(F.col("amount").cast("double"))), 0.5, 1000).alias("typical"))
    known = placed.join(sizes, placed.node == sizes.source).select("grp", "source", "root", F.round("potential").cast("int").alias("potential"), "typical")
    usual = sizes.agg(F.percentile_approx("typical", 0.5, 1000).alias("usual"))
    votes = known.groupBy("root", "potential").agg(F.count(F.lit(1)).alias("n"), F.avg("typical").alias("typical")).withColumn("usual", usual.scalar())
    best = votes.groupBy("root").agg(F.max(F.struct("n", (-F.abs(F.col("typical") - F.col("usual"))).alias("nearness"), F.col("potential").alias("reference"))).alias("best"), F.sum("n").alias("n_sources"))
    return known.join(best, "root").select("grp", "source", (F.col("potential") - F.col("best.reference")).alias("power"), F.col("best.reference").alias("reference"), "n_sources")


def differs(x: Column, y: Column, share: float) -> Column:
    """x isn't within `share` of y; exact decimals, null if either is null."""
    return F.abs(x - y) > F.abs(y) * F.lit(str(share)).cast("decimal(6,4)")
