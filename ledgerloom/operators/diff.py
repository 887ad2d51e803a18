"""Differences between two copies of a table, found by hierarchical checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that is last in `order`; one pre-aggregated pass, no window.

    Rows of equal order are told apart by all their columns, so the choice
    doesn't depend on the row order. Null keys are keys of their own.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = F.max(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.struct(*rest).alias("row")))
    return df.groupBy(*keys).agg(picked.alias("_last")).select(*keys, "_last.row.*")


def digested(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys, fields, `_spot` (the key's place in hash order) and `_row` (a hash of keys and fields), computed once."""
    spot = F.xxhash64(F.lit(7), *[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys])
    # Nulls must weigh: xxhash64 skips them, so each field goes in with its presence.
    row = F.xxhash64(*[x for c in [*keys, *fields] for x in (F.col(c).cast("string"), F.col(c).isNull())])
    return df.select(*keys, *fields, spot.alias("_spot"), row.alias("_row"))


def _range(depth: int) -> Column:
    """The range of 2**depth that a key's place in hash order lies in."""
    return F.shiftrightunsigned("_spot", 64 - depth) if depth else F.lit(0).cast("long")


def range_sums(rows: DataFrame, alive: DataFrame | None, above: int, depth: int, side: str) -> DataFrame:
    """Checksums of the 2**depth ranges, of rows in the ranges `alive` at depth `above` only.

    A checksum is the row count, the xor and a sum of the row hashes, which sums
    without order. Rows of other ranges are left before anything is shuffled.
    """
    if alive is not None:
        rows = rows.join(alive.select(F.col("range").alias("_up")), _range(above) == F.col("_up"), "left_semi")
    return rows.groupBy(_range(depth).alias("range")).agg(F.count(F.lit(1)).alias(f"{side}_n"), F.bit_xor("_row").alias(f"{side}_x"), F.sum(F.shiftright("_row", 20)).alias(f"{side}_s"))


def unequal_ranges(left: DataFrame, right: DataFrame, alive: DataFrame | None, above: int, depth: int) -> DataFrame:
    """(range, l_n, r_n): ranges at `depth`, within those `alive` at depth `above`, whose checksums differ."""
    sums = range_sums(left, alive, above, depth, "l").join(range_sums(right, alive, above, depth, "r"), "range", "full_outer")
    sums = sums.na.fill(0, ["l_n", "l_x", "l_s", "r_n", "r_x", "r_s"])
    return sums.where((F.col("l_n") != F.col("r_n")) | (F.col("l_x") != F.col("r_x")) | (F.col("l_s") != F.col("r_s"))).select("range", "l_n", "r_n")


def mismatched_ranges(left: DataFrame, right: DataFrame, rows_per_leaf: int = 16, bits: int = 8) -> tuple[DataFrame, int]:
    """(range, l_n, r_n) of the leaf ranges whose checksums differ, and the leaves' depth.

    left and right are `digested`. From one range that holds everything,
    unequal ranges are bisected `bits` times a round and summed again, so each
    round reads and shuffles only rows of the ranges that still differ. Leaves
    hold about `rows_per_leaf` rows; equal copies cost one sum of each.
    """
    alive = cut(unequal_ranges(left, right, None, 0, 0))
    top = alive.first()
    total = max(top.l_n, top.r_n) if top else 0
    leaf = max(1, min(48, (total // rows_per_leaf).bit_length()))
    above = 0
    while top and above < leaf:
        depth = min(leaf, above + bits)
        alive = cut(unequal_ranges(left, right, alive if above else None, above, depth))
        above = depth
    return alive, above


def difference(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str], names: tuple[str, str] = ("left", "right"), rows_per_leaf: int = 16, bits: int = 8) -> DataFrame:
    """Rows missing on either side and fields whose values differ.

    Both sides have one row per key (see `latest`) and values brought to one
    form; null equals null, null against a value is a difference. Returns the
    keys, difference (`missing_in_<name>` or the field) and both values as text
    (null for missing rows). Ranges of the keys' hash order are bisected on
    checksums; only rows of leaf ranges that differ are compared by field, so
    two equal copies cost one aggregation each. Rows with a null in the key are
    compared like others. Columns beside keys and fields are ignored; an empty
    side makes every row of the other missing.
    """
    left, right = cut(digested(left, keys, fields)), cut(digested(right, keys, fields))
    leaves, depth = mismatched_ranges(left, right, rows_per_leaf, bits)

    def side(df: DataFrame, tag: str) -> DataFrame:
        kept = df.join(leaves.select(F.col("range").alias("_up")), _range(depth) == F.col("_up"), "left_semi")
        return kept.select(*[F.col(k).alias(f"{tag}_{i}") for i, k in enumerate(keys)], F.struct(*fields).alias(tag))

    a, b = side(left, "l"), side(right, "r")
    same = F.lit(True)
    for i in range(len(keys)):
        same = same & F.col(f"l_{i}").eqNullSafe(F.col(f"r_{i}"))
    joined = a.join(b, same, "full_outer")
    changes = F.when(F.col("r").isNull(), F.array(F.struct(F.lit(f"missing_in_{names[1]}").alias("difference"), F.lit(None).cast("string").alias("left_value"), F.lit(None).cast("string").alias("right_value"))))
    changes = changes.when(F.col("l").isNull(), F.array(F.struct(F.lit(f"missing_in_{names[0]}").alias("difference"), F.lit(None).cast("string").alias("left_value"), F.lit(None).cast("string").alias("right_value"))))
    by_field = F.filter(
        F.array(*[F.when(~F.col(f"l.{f}").eqNullSafe(F.col(f"r.{f}")), F.struct(F.lit(f).alias("difference"), F.col(f"l.{f}").cast("string").alias("left_value"), F.col(f"r.{f}").cast("string").alias("right_value"))) for f in fields]),
        lambda x: x.isNotNull(),
    )
    return joined.select(*[F.coalesce(F.col(f"l_{i}"), F.col(f"r_{i}")).alias(k) for i, k in enumerate(keys)], F.explode(changes.otherwise(by_field)).alias("d")).select(*keys, "d.*")


def path_form(c: Column) -> Column:
    """One spelling of a path: forward slashes, no `//`, `./` or `x/../`, no outer blanks; null if blank."""
    bare = F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")
    slashed = F.regexp_replace(F.regexp_replace(bare, r"\\", "/"), r"/{2,}", "/")
    undotted = F.regexp_replace(F.regexp_replace(F.regexp_replace(slashed, r"(?<=^|/)(\./)+", ""), r"[^/]+/\.\./", ""), r"/\.$|/$", "")
    return F.when(undotted != "", undotted)
