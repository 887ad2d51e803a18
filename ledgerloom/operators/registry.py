"""Codes against a registry: lookup through fallbacks, validity, names, corrections, snapshots by year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes as C
from ledgerloom.functions import text as T
from ledgerloom.operators.joins import fallback_lookup, small

#: Fixed value: folded names of totals, which need no code of their own.
TOTAL_NAMES = r"^\s*(total|partea)\b"


def chain(code: Column, suffix: str = "02") -> list[Column]:
    """Codes to try, in order: as printed, with the registry's suffix, one level up, without the suffix one level up, with the registry's suffix one level up."""
    up = lambda c: F.when(F.size(F.split(c, r"\.")) > 2, F.regexp_extract(c, r"^(.+)\.[^.]+$", 1))
    bare = F.when(code.endswith(f".{suffix}"), F.substring(code, F.lit(1), F.length(code) - len(suffix) - 1))
    return [code, C.resuffixed(code, suffix), up(code), up(bare), up(C.resuffixed(code, suffix))]


def matched(lines: DataFrame, registry: DataFrame, id_column: str, suffix: str = "02") -> DataFrame:
    """Lines with what the registry has for their (kind, code), found through the chain.

    lines(id, kind, code, name), registry(kind, code, official). Adds attempt
    (1 to 5; above 2 is a roll-up; null for none), matched_code and official.
    Lines named as totals, and lines without a code, are not looked up. One
    join however long the chain; the registry is sent to all tasks only if
    counted small.
    """
    keyed = registry.groupBy(F.concat_ws("|", "kind", "code").alias("entry")).agg(F.min("official").alias("official"), F.min("code").alias("registry_code"))
    asked = ~F.coalesce(T.fold(F.col("name")).rlike(TOTAL_NAMES), F.lit(False)) & F.col("code").isNotNull()
    tries = [F.when(asked & c.isNotNull(), F.concat_ws("|", F.coalesce("kind", F.lit("")), c)) for c in chain(F.col("code"), suffix)]
    found = fallback_lookup(lines, keyed, "entry", tries, id_column)
    return found.withColumn("asked", asked).withColumnRenamed("registry_code", "matched_code").drop("matched_entry")


def unknown_codes(found: DataFrame) -> DataFrame:
    """Lines of `matched` that no step of the chain knows: errors."""
    return found.where("asked and attempt is null").drop("attempt", "matched_code", "official", "asked")


def discordant_names(found: DataFrame, least: float = 55.0) -> DataFrame:
    """Lines of `matched` whose name scores under `least` against the official one: warnings. Roll-ups aren't judged.

    A printed formula in the name doesn't count. Scores are told once for each
    two different names, however many lines have them.
    """
    plain = found.where("attempt <= 2 and name is not null and official is not null").withColumn("_a", F.trim(F.regexp_replace(T.fold(F.col("name")), r"\([^()]*\)", " "))).withColumn("_b", T.fold(F.col("official")))
    scored = plain.select("_a", "_b").distinct().withColumn("score", T.fuzzy("token_set")(F.col("_a"), F.col("_b"))).where(F.col("score") < least)
    return plain.join(small(scored), ["_a", "_b"]).drop("_a", "_b", "asked")


def corrected_codes(lines: DataFrame, registry: DataFrame, id_column: str, score: float = 94.0, margin: float = 5.0, own: float = 50.0) -> DataFrame:
    """(id, code, better, score): codes misread by one character, told by their name.

    Of registry codes of the line's kind within one edit of its code, that whose
    name scores `score` or more and leads the next by `margin`, where the line's
    own code (if known) scores under `own`. Codes meet on one-letter deletions,
    an equi-join, and only for codes whose names don't already agree.
    """
    names = lines.where("code is not null and name is not null").select(F.coalesce("kind", F.lit("")).alias("kind"), "code", T.fold(F.col("name")).alias("name")).distinct()
    official = registry.select(F.col("kind").alias("k"), F.col("code").alias("better"), T.fold(F.col("official")).alias("official")).distinct()
    mine = names.join(small(official), (F.col("kind") == F.col("k")) & (F.col("code") == F.col("better")), "left").withColumn("own", F.coalesce(T.fuzzy("token_set")(F.col("name"), F.col("official")), F.lit(0.0)))
    open_ = mine.where(F.col("own") < own).select("kind", "code", "name")
    here = open_.select("*", F.explode(T.near_keys(F.col("code"))).alias("key"))
    there = official.select("k", "better", "official", F.explode(T.near_keys(F.col("better"))).alias("key"))
    near = here.join(there, (here.key == there.key) & (F.col("kind") == F.col("k"))).where((F.col("code") != F.col("better")) & (F.levenshtein("code", "better") <= 1)).select("kind", "code", "name", "better", "official").distinct()
    scored = near.withColumn("score", T.fuzzy("token_set")(F.col("name"), F.col("official")))
    best = scored.groupBy("kind", "code", "name").agg(F.max(F.struct("score", "better")).alias("b"), F.sort_array(F.collect_set("score"), asc=False).alias("s"), F.count(F.lit(1)).alias("n"))
    lead = F.when(F.col("n") == 1, 100.0).otherwise(F.get("s", F.lit(0)) - F.coalesce(F.get("s", F.lit(1)), F.get("s", F.lit(0))))
    told = best.where((F.col("b.score") >= score) & (lead >= margin)).select("kind", "code", "name", F.col("b.better").alias("better"), F.col("b.score").alias("score"))
    keyed = lines.select(id_column, F.coalesce("kind", F.lit("")).alias("kind"), "code", T.fold(F.col("name")).alias("name"))
    return keyed.join(told, ["kind", "code", "name"]).select(id_column, "code", "better", "score")


def completed_codes(lines: DataFrame, registry: DataFrame, id_column: str) -> DataFrame:
    """(id, code, completed): the first of a damaged code's candidates (functions.codes.candidates) that the registry has."""
    entries = registry.select(F.col("code").alias("completed")).distinct()
    tried = lines.select(id_column, "code", F.posexplode(C.candidates(F.col("code"))).alias("place", "candidate"))
    hits = tried.join(small(entries), F.col("candidate") == F.col("completed")).groupBy(id_column, "code").agg(F.min(F.struct("place", "completed")).alias("m"))
    return hits.select(id_column, "code", F.col("m.completed").alias("completed"))


def snapshot_of(registry: DataFrame, wanted: DataFrame, year: str = "effective_year") -> DataFrame:
    """(wanted_year, effective_year): the registry's snapshot for each year wanted: its own, else the newest before, else the oldest there is."""
    years = registry.select(F.col(year).alias("effective")).distinct()
    held = years.agg(F.array_sort(F.collect_set("effective")).alias("all"))  # years, not rows: few by nature
    asked = wanted.select(F.col("year").alias("wanted_year")).distinct().withColumn("all", held.scalar())
    before = F.array_max(F.filter("all", lambda y: y <= F.col("wanted_year")))
    return asked.select("wanted_year", F.coalesce(before, F.array_min("all")).alias("effective_year"))


def registry_stats(registry: DataFrame) -> DataFrame:
    """Entries by budget and kind."""
    return registry.groupBy("budget", "kind").agg(F.count(F.lit(1)).alias("entries"), F.count_distinct("code").alias("codes"))


def annex_entries(cells: DataFrame, sheet: str = "sheet", header: str = r"^denumire") -> DataFrame:
    """(sheet, row, code, official): entries of a registry's annex, a row per row after the header that has exactly one code.

    cells(sheet, row, col, cell). The name is the row's longest other cell.
    Sheets without a header give nothing.
    """
    folded = T.fold(F.col("cell"))
    heads = cells.where(folded.rlike(header)).groupBy(sheet).agg(F.min("row").alias("_head"))
    body = cells.join(heads, sheet).where(F.col("row") > F.col("_head")).withColumn("_code", C.indicator_code(F.col("cell")))
    rows = body.groupBy(sheet, "row").agg(F.count("_code").alias("codes"), F.max("_code").alias("code"), F.max(F.when(F.col("_code").isNull(), F.struct(F.length("cell").alias("n"), F.col("cell"))))["cell"].alias("official"))
    return rows.where("codes = 1 and official is not null").select(sheet, "row", "code", "official")
