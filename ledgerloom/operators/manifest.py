"""Manifests of sources: path duplicates, lookups, upserts; the store of stage results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_path(entries: DataFrame, path: str, preferred: Column, order: str) -> DataFrame:
    """One entry of each path: a preferred one if there is any, else the first; at the place of the path's first entry.

    Entries without a path are kept as they are.
    """
    rest = [c for c in entries.columns if c not in (path, order)]
    named = entries.where(F.col(path).isNotNull()).withColumn("_last", (~F.coalesce(preferred, F.lit(False))).cast("int"))
    best = named.groupBy(path).agg(F.min(F.struct("_last", order, *rest)).alias("m"), F.min(order).alias("_place"))
    told = best.select(path, F.col("_place").alias(order), *[F.col(f"m.{c}").alias(c) for c in rest]).select(*entries.columns)
    return told.unionByName(entries.where(F.col(path).isNull()))


def found(entries: DataFrame, asked: DataFrame, name: str, code: str, order: str) -> DataFrame:
    """asked and the first entry whose name (in any case) or code it is; questions without an answer stay, with nulls."""
    q = asked.select("question").distinct()
    keys = entries.select(*entries.columns, F.explode(F.array_distinct(F.array(F.lower(F.trim(name)), F.col(code)))).alias("_key")).where("_key is not null")
    hits = q.join(keys, F.lower(F.trim("question")) == F.col("_key")).groupBy("question").agg(F.min(F.struct(order, *[c for c in entries.columns if c != order])).alias("m"))
    return q.join(hits, "question", "left").select("question", *[F.col(f"m.{c}").alias(c) for c in entries.columns])


def upserted(held: DataFrame, fresh: DataFrame, key: str, fields: list[str], status: str = "status", error: str = "error", success: str = "converted") -> DataFrame:
    """The manifest with fresh entries merged onto it: a fresh field wins where it is given; success clears an earlier error."""
    a = held.select(key, F.struct(*fields).alias("_h"))
    b = fresh.select(key, F.struct(*fields).alias("_f"))
    both = a.join(b, key, "full_outer")
    new = {f: F.coalesce(F.col(f"_f.{f}"), F.col(f"_h.{f}")) for f in fields}
    if error in new:
        new[error] = F.when(F.col(f"_f.{status}") == success, F.col(f"_f.{error}")).otherwise(new[error])
    return both.select(key, *[c.alias(f) for f, c in new.items()])


def identity_of(files: DataFrame, manifest: DataFrame, path: str, fields: list[str]) -> DataFrame:
    """Files with their manifest entry's fields; without an entry the file's own name stands for the first field."""
    m = manifest.groupBy(path).agg(F.min(F.struct(*fields)).alias("m"))
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]+$", "")
    both = files.join(m, path, "left")
    return both.select(*files.columns, F.coalesce(F.col(f"m.{fields[0]}"), stem).alias(fields[0]), *[F.col(f"m.{f}").alias(f) for f in fields[1:]], F.col("m").isNotNull().alias("in_manifest"))


def valid_results(results: DataFrame, keys: list[str], digest: str, wanted: str, at: str) -> DataFrame:
    """The latest stage result of each key that was made with the wanted configuration."""
    rest = [c for c in results.columns if c not in keys and c != at]
    good = results.where(F.col(digest) == wanted)
    return good.groupBy(*keys).agg(F.max(F.struct(at, *rest)).alias("m")).select(*keys, *[F.col(f"m.{c}").alias(c) for c in (at, *rest)])


def open_failures(results: DataFrame, failures: DataFrame, keys: list[str], at: str) -> DataFrame:
    """The last failure of each key that no later success has cleared."""
    last = failures.groupBy(*keys).agg(F.max(F.struct(at, "message")).alias("f"))
    good = results.groupBy(*keys).agg(F.max(at).alias("_good"))
    return last.join(good, keys, "left").where(F.col("_good").isNull() | (F.col("_good") < F.col(f"f.{at}"))).select(*keys, F.col(f"f.{at}").alias(at), "f.message")


def rates(timings: DataFrame, stage: str, seconds: str, pages: str, least: int = 5) -> DataFrame:
    """Seconds a page of each stage, null under `least` pages."""
    g = timings.groupBy(stage).agg(F.sum(seconds).alias("seconds"), F.sum(pages).alias("pages"))
    return g.withColumn("rate", F.when(F.col("pages") >= least, F.round(F.col("seconds") / F.col("pages"), 6)))


def queue(units: DataFrame, scope: str, rate: str, order: list[str]) -> DataFrame:
    """Units in working order: whole scopes first, then the lowest rate (none last), then the order. A distributed sort."""
    return units.orderBy((F.col(scope) != "full").cast("int"), F.coalesce(F.col(rate), F.lit(101.0)), *order)
