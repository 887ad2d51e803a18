"""Connected components with potentials, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut


def propagate(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Carry labels over a graph until nothing changes.

    edges(a, b, shift): the potential of b is that of a plus `shift`. Returns
    (node, root, potential, hops): root is the least node of the component,
    potential is relative to the root along a shortest known path. Rows with a
    null end are ignored, repeated and opposite edges are harmless, an empty
    graph gives an empty result. A component of diameter d takes d + 1 rounds;
    each round is one join of the edges with the labels and one aggregation, cut
    by a checkpoint. Rounds beyond `max_rounds` raise, so nothing is left half done.
    """
    both = cut(
        edges.where("a is not null and b is not null")
        .select("a", "b", F.col("shift").cast("double").alias("shift"))
        .unionByName(edges.where("a is not null and b is not null").select(F.col("b").alias("a"), F.col("a").alias("b"), (-F.col("shift")).cast("double").alias("shift")))
        .distinct()
    )
    labels = both.select(F.col("a").alias("node")).distinct().select("node", F.struct(F.col("node").alias("root"), F.lit(0).alias("hops"), F.lit(0.0).alias("potential")).alias("label"))
    for _ in range(max_rounds):
        offers = both.join(labels, both.a == labels.node).select(F.col("b").alias("node"), F.struct(F.col("label.root").alias("root"), (F.col("label.hops") + 1).alias("hops"), (F.col("label.potential") + F.col("shift")).alias("potential")).alias("label"), F.lit(False).alias("own"))
        merged = labels.withColumn("own", F.lit(True)).unionByName(offers).groupBy("node").agg(F.min("label").alias("label"), F.min(F.when(F.col("own"), F.col("label"))).alias("before"))
        merged = cut(merged)
        labels = merged.select("node", "label")
        if merged.where(~F.col("label").eqNullSafe(F.col("before"))).isEmpty():
            return labels.select("node", "label.root", "label.potential", "label.hops")
    raise RuntimeError(f"the graph did not settle in {max_rounds} rounds")
