"""Queries of the general data-quality problems (2, 4, 5 and 6) over the staged tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import numbers as N
from ledgerloom.operators import diff, drift, spikes, units
from ledgerloom.session import cut, table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Changes of each file of a feed against the one before."""
    return drift.changes(table(spark, d, "raw_payloads")).select("feed", "file_name", "change", "old_field", "new_field")


def p2_table(spark: SparkSession, d: str) -> DataFrame:
    """All readable records under canonical names and types."""
    rows = drift.consistent(table(spark, d, "raw_payloads"))
    return rows.select("record_id", "feed", "file_name", "file_kind", F.to_json("numbers").alias("numbers"), F.to_json("flags").alias("flags"), F.to_json("texts").alias("texts"))


def p2_lifespans(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue of field lifespans."""
    return drift.lifespans(drift.catalogue(drift.fields_of(table(spark, d, "raw_payloads")))).select("file_kind", "feed", "field", "type", F.col("first_seq").cast("long").alias("first_seq"), F.col("last_seq").cast("long").alias("last_seq"))


def p2_casts(spark: SparkSession, d: str) -> DataFrame:
    """The casts generated from the alias table."""
    records = table(spark, d, "raw_payloads")
    cat = cut(drift.catalogue(drift.fields_of(records)))
    moved = cut(drift.renames(drift._events(drift.lifespans(cat)), records, cat, drift.RECORD_KEYS))
    return drift.casts(cat, drift.alias_table(moved, cat))


ARTIFACT = ["siruta", "year", "budget"]
COMPARED = ["lines", "lines_strictly_verified", "xlsx", "status"]


def artifact_copies(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Both copies' valid state per artifact, in one form."""

    def formed(df: DataFrame, stamp: str) -> DataFrame:
        keyed = df.select(
            N.blank_to_null(F.col("siruta").cast("string")).alias("siruta"), F.col("year").cast("int").alias("year"), N.blank_to_null(F.col("budget")).alias("budget"),
            N.loose_number(F.col("lines").cast("string")).alias("lines"), N.loose_number(F.col("lines_strictly_verified").cast("string")).alias("lines_strictly_verified"),
            diff.path_form(F.col("xlsx")).alias("xlsx"), F.lower(N.blank_to_null(F.col("status"))).alias("status"), F.col(stamp).alias("stamp"), F.col("revision") if "revision" in df.columns else F.lit(0).alias("revision"),
        )
        return diff.latest(keyed, ARTIFACT, [F.col("stamp"), F.col("revision")])

    return formed(table(spark, d, "quality_manifest"), "updated_at"), formed(table(spark, d, "quality_snapshot"), "written_at")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Artifacts missing on either side, and fields that differ."""
    left, right = artifact_copies(spark, d)
    return diff.difference(left, right, ARTIFACT, COMPARED, ("manifest", "snapshot")).select(*ARTIFACT, "difference")


def p4_values(spark: SparkSession, d: str) -> DataFrame:
    """As p4_found, with both values."""
    left, right = artifact_copies(spark, d)
    return diff.difference(left, right, ARTIFACT, COMPARED, ("manifest", "snapshot"))


LINE = ["context_id", "budget", "suffix", "section", "kind", "code", "func_code", "economic_code", "column_name"]


def edition_amounts(spark: SparkSession, d: str) -> DataFrame:
    """facts in the unit they are labelled with, brought to mii lei.

    A row without a unit takes the label most rows of its edition have. An
    entity is a line of a city: nulls in its key are nulls of the line.
    """
    facts = table(spark, d, "facts").where("siruta is not null and year is not null and value is not null")
    rows = facts.select("fact_id", "siruta", "year", "exported_at", "value", N.unit_exponent(F.col("unit")).alias("own"), F.xxhash64(*[x for c in LINE for x in (F.col(c), F.col(c).isNull())]).alias("line"))
    labels = rows.where("own is not null").groupBy("siruta", "year", "own").count().groupBy("siruta", "year").agg(F.max_by("own", F.struct("count", "own")).alias("label"))
    return rows.join(labels, ["siruta", "year"], "left").withColumn("exponent", F.coalesce("own", "label"))


def edition_scales(spark: SparkSession, d: str) -> DataFrame:
    """Power of ten by which each edition is off the scale of the city's other editions."""
    rows = edition_amounts(spark, d).where("exponent is not null")
    amounts = rows.select(F.col("siruta").alias("grp"), F.concat_ws("/", "siruta", F.col("year").cast("string")).alias("source"), F.col("year").alias("rank"), F.col("line").alias("entity"), (F.col("value").cast("double") * F.pow(F.lit(10.0), F.col("exponent"))).alias("amount"))
    return units.source_scales(amounts)


def printed_amounts(spark: SparkSession, d: str) -> DataFrame:
    """annotation_values with the printed number, the unit known for it, and where that is from."""
    pages = table(spark, d, "page_reviews").select("review_id", "revision", "source_unit", "number_notation", "note")
    valid = pages.groupBy("review_id").agg(F.max(F.struct("revision", "source_unit", "number_notation", "note")).alias("page"))
    valid = valid.select("review_id", N.unit_exponent(F.regexp_replace("page.source_unit", "_", " ")).alias("page_exponent"), N.unit_exponent(F.col("page.note")).alias("note_exponent"), F.col("page.number_notation").alias("notation"))
    values = table(spark, d, "annotation_values").select("value_id", "review_id", "printed", "normalized_mii_lei")
    read = values.join(valid, "review_id", "left").select(
        "value_id", "review_id", "printed", "page_exponent", "note_exponent", N.unit_exponent(F.col("printed")).alias("own"), N.printed_number(N.number_part(F.col("printed")), F.col("notation")).alias("number"), N.printed_number(F.col("normalized_mii_lei"), F.lit("canonical")).alias("normalized"),
    )
    basis = F.when(F.col("own").isNotNull(), "printed").when(F.col("page_exponent").isNotNull(), "page").when(F.col("note_exponent").isNotNull(), "note")
    return cut(read).select("value_id", "review_id", "printed", "number", "normalized", F.coalesce("own", "page_exponent", "note_exponent").alias("exponent"), basis.alias("basis"))


def _page_source() -> Column:
    """The source of a value: its page, or what its page prints in one unit of its own."""
    return F.concat_ws("/", F.col("review_id").cast("string"), F.when(F.col("basis") == "printed", F.concat(F.lit("printed "), F.col("exponent").cast("string"))).otherwise("page"))


def value_scales(rows: DataFrame) -> DataFrame:
    """(source, inferred, n_links, offset): scale of each page (and unit statement on it) against its frozen normalised values, snapped."""
    links = rows.where("number is not null and normalized is not null").select(_page_source().alias("a"), F.lit("normalised").alias("b"), F.col("number").cast("double").alias("x"), F.col("normalized").cast("double").alias("y"))
    return units.pairwise_scales(links, min_links=2).select(F.col("a").alias("source"), F.col("power").cast("int").alias("inferred"), "n_links", "offset")


def harmonised_values(spark: SparkSession, d: str) -> DataFrame:
    """Printed amounts in mii lei: by the unit stated, else by the scale inferred for the page."""
    rows = printed_amounts(spark, d).withColumn("source", _page_source())
    scaled = rows.join(value_scales(rows), "source", "left")
    used = F.coalesce("exponent", "inferred")
    return scaled.withColumn("mii_lei", N.times_ten_to(F.col("number"), used)).withColumn("basis", F.coalesce("basis", F.when(F.col("inferred").isNotNull(), "inferred"), F.lit("unknown")))


def value_cases(values: DataFrame, share: float = 0.005) -> DataFrame:
    """Values off their source's line of scale and offset, then exactly checked against the unit stated.

    A candidate is a value that its source's estimated line doesn't give within
    `share`, or any value of a source whose line isn't the stated unit's (no
    scale known, another one, or an offset that alone could hide a difference).
    A value on a line that is the stated unit's is right, so none is lost.
    """
    line = N.times_ten_to(F.col("number"), F.col("inferred")) + F.col("offset").cast(N.MONEY)
    plain = (F.col("inferred") == F.col("exponent")) & (F.abs("offset") <= share * F.abs(F.col("normalized").cast("double")) / 10)
    candidate = ~F.coalesce(plain & ~units.differs(F.col("normalized"), line, share / 2), F.lit(False))
    return values.where("exponent is not null and normalized is not null and mii_lei is not null").where(candidate).where(units.differs(F.col("normalized"), F.col("mii_lei"), share))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Values whose normalised amount isn't the printed one, and editions in another unit than their label's."""
    values = value_cases(harmonised_values(spark, d))
    editions = edition_scales(spark, d).where("power != 0")
    return values.select(F.lit("value").alias("record_kind"), F.col("value_id").cast("string").alias("record_key")).unionByName(editions.select(F.lit("edition").alias("record_kind"), F.col("source").alias("record_key")))


def p5_values(spark: SparkSession, d: str) -> DataFrame:
    """The values of p5_found."""
    return value_cases(harmonised_values(spark, d)).select("value_id")


def p5_editions(spark: SparkSession, d: str) -> DataFrame:
    """Every edition with amounts: the power of ten it is off its city's scale, or `unjudged` where too few lines link it."""
    held = edition_amounts(spark, d).groupBy("siruta", F.col("year").cast("long").alias("year")).agg(F.count(F.lit(1)).alias("amounts"))
    scales = edition_scales(spark, d).select(F.col("source").alias("edition"), "power", "n_sources")
    told = held.withColumn("edition", F.concat_ws("/", "siruta", F.col("year").cast("string"))).join(scales, "edition", "left")
    return told.select("edition", "amounts", F.coalesce("n_sources", F.lit(0)).cast("long").alias("linked"), "power", F.when(F.col("power").isNull(), "unjudged").when(F.col("power") == 0, "as labelled").otherwise("another unit").alias("state"))


def p5_amounts(spark: SparkSession, d: str) -> DataFrame:
    """Every amount in mii lei, with the unit's basis."""
    values = harmonised_values(spark, d).select(F.lit("value").alias("record_kind"), F.col("value_id").alias("record_id"), "mii_lei", "basis")
    scales = edition_scales(spark, d).select(F.col("source").alias("edition"), "power")
    facts = edition_amounts(spark, d).withColumn("edition", F.concat_ws("/", "siruta", F.col("year").cast("string"))).join(scales, "edition", "left")
    off = F.coalesce("power", F.lit(0))
    told = facts.select(
        F.lit("fact").alias("record_kind"), F.col("fact_id").alias("record_id"), N.times_ten_to(F.col("value"), (F.col("exponent") - off).cast("int")).alias("mii_lei"),
        F.when(F.col("exponent").isNull(), "unknown").when(off != 0, "corrected").when(F.col("own").isNotNull(), "label").otherwise("edition").alias("basis"),
    )
    return values.unionByName(told)


def line_changes(spark: SparkSession, d: str) -> DataFrame:
    """matched_lines as paired measurements; a source is a city's new edition."""
    rows = table(spark, d, "matched_lines")
    return rows.select(F.col("pair_id").alias("reading_id"), F.concat_ws("/", "siruta", F.col("new_year").cast("string")).alias("source"), F.col("compared_at").alias("at"), "old_value", "new_value", F.col("code").startswith("98.").alias("may_be_negative"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that are abnormal for their city."""
    return spikes.abnormal(line_changes(spark, d)).select(F.col("reading_id").alias("pair_id"))


def p6_reasons(spark: SparkSession, d: str) -> DataFrame:
    """As p6_found, with the reason and the standardised innovation."""
    return spikes.abnormal(line_changes(spark, d)).select(F.col("reading_id").alias("pair_id"), "source", "reason", F.round("innovation", 3).alias("innovation"))


QUERIES = {f.__name__: f for f in (p2_found, p2_table, p2_lifespans, p2_casts, p4_found, p4_values, p5_found, p5_values, p5_editions, p5_amounts, p6_found, p6_reasons)}
