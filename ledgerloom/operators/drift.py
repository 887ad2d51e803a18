"""Drifting schemas: a catalogue of field lifespans, their changes, one consistent table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.graph import propagate
from ledgerloom.session import cut

#: The field that tells records of a file kind apart.
RECORD_KEYS = {"inventory": "page", "lines": "row_no", "quality": "siruta"}

_EXPLODE = """
select r.record_id, r.feed, r.file_name, r.file_kind, r.written_at,
       case when i.key is null then e.key else concat(e.key, '.', i.key) end as field,
       case when i.key is null then e.value else i.value end as value
from {records} r,
lateral variant_explode(r.parsed) e,
lateral variant_explode_outer(case when e.key = '{nested}' and schema_of_variant(e.value) like 'OBJECT%' then e.value end) i
where not (e.key = '{nested}' and i.key is null)
"""


def _type(v: Column) -> Column:
    s = F.schema_of_variant(v)
    return (
        F.when(s == "STRING", "string").when(s == "BOOLEAN", "boolean").when(s.startswith("ARRAY"), "array").when(s.startswith("OBJECT"), "object").when(s != "VOID", "number")
    )


def content_form(text: Column) -> Column:
    """JSON text with numbers, wrappers and separators brought to one form, to see if content goes on."""
    words = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), '"text"\\s*:', " "), r"[^\p{L}\p{N}.\-]+", " "))
    number = F.when(words.rlike(r"^-?\d{1,15}(\.\d+)?$"), F.format_string("%.6f", words.try_cast("double")))
    return F.coalesce(number, words)


def readable(records: DataFrame) -> DataFrame:
    """Records whose payload is a JSON object, parsed once."""
    parsed = records.withColumn("parsed", F.try_parse_json("payload")).where("parsed is not null")
    return parsed.where(F.schema_of_variant("parsed").startswith("OBJECT"))


def fields_of(records: DataFrame, nested: str = "values") -> DataFrame:
    """(record_id, feed, file_name, file_kind, written_at, field, type, text), a row per field and record.

    Fields are top-level keys, and keys inside the object `nested` as
    `nested.key`. type is null for JSON null. Unreadable payloads (cut off, no
    object, null, empty) give no rows.
    """
    rows = records.sparkSession.sql(_EXPLODE.replace("{nested}", nested), records=readable(records.select("record_id", "feed", "file_name", "file_kind", "written_at", "payload")))
    return rows.select("record_id", "feed", "file_name", "file_kind", "written_at", "field", _type(F.col("value")).alias("type"), F.to_json("value").alias("text"))


def catalogue(fields: DataFrame) -> DataFrame:
    """A row per field of each file: its place `seq` in its feed, main type, counts.

    This is the files' footer metadata: it grows with files and fields, not with
    records. Files of a feed follow one another by written_at, then name.
    """
    cells = fields.groupBy("file_kind", "feed", "file_name", "field", "type").agg(F.count(F.lit(1)).alias("n"), F.max("written_at").alias("written_at"))
    per_field = cells.groupBy("file_kind", "feed", "file_name", "field").agg(F.max("written_at").alias("written_at"), F.sum("n").alias("n"), F.max(F.when(F.col("type").isNotNull(), F.struct("n", "type")))["type"].alias("type"))
    # Ranked once per file, on one row per file.
    files = per_field.groupBy("file_kind", "feed", "file_name").agg(F.max("written_at").alias("at"))
    ranked = files.withColumn("seq", F.row_number().over(W.partitionBy("feed").orderBy(F.col("at").asc_nulls_first(), "file_name"))).withColumn("files", F.count(F.lit(1)).over(W.partitionBy("feed")))
    return per_field.join(ranked.select("feed", "file_name", "seq", "files"), ["feed", "file_name"])


def lifespans(cat: DataFrame) -> DataFrame:
    """Islands of consecutive files in which a field of a feed is present with one type.

    (feed, field, type, first_seq, last_seq, files). A file where the field has
    only nulls carries the type on.
    """
    by_field = W.partitionBy("feed", "field").orderBy("seq")
    known = cat.withColumn("gap", (F.col("seq") != F.lag("seq").over(by_field) + 1).cast("int")).withColumn("span", F.sum(F.coalesce("gap", F.lit(1))).over(by_field))
    by_span = W.partitionBy("feed", "field", "span").orderBy("seq")
    typed = known.withColumn("held", F.last("type", ignorenulls=True).over(by_span))
    turned = typed.withColumn("turn", F.coalesce((F.col("held") != F.lag("held").over(by_span)).cast("int"), F.lit(0))).withColumn("island", F.sum("turn").over(by_span))
    return turned.groupBy("file_kind", "feed", "field", "span", "island").agg(F.max("held").alias("type"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.max("files").alias("files"))


def _events(spans: DataFrame) -> DataFrame:
    """Starts, endings and turns of type, each at the file (seq) that shows it."""
    last = W.partitionBy("feed", "field", "span").orderBy("island")
    told = spans.withColumn("is_first", F.row_number().over(last) == 1).withColumn("is_last", F.lead("island").over(last).isNull())
    events = F.filter(
        F.array(
            F.when(F.col("is_first") & (F.col("first_seq") > 1), F.struct(F.lit("added").alias("change"), F.col("first_seq").alias("seq"))),
            F.when(F.col("is_last") & (F.col("last_seq") < F.col("files")), F.struct(F.lit("removed").alias("change"), (F.col("last_seq") + 1).alias("seq"))),
            F.when(~F.col("is_first"), F.struct(F.lit("type_changed").alias("change"), F.col("first_seq").alias("seq"))),
        ),
        lambda e: e.isNotNull(),
    )
    return told.select("file_kind", "feed", "field", F.explode(events).alias("e")).select("file_kind", "feed", "field", "e.*")


def renames(events: DataFrame, records: DataFrame, cat: DataFrame, keys: dict[str, str], nested: str = "values", share: float = 0.8, least: int = 2) -> DataFrame:
    """Endings and starts of one file that are one field under two names.

    (feed, seq, old_field, new_field, same, compared). Records that come again
    are matched by key; a pair is a rename if at least `share` of the `least` or
    more records that have both say the same. Each name is used once, best pair
    first. Where records can't tell, an alias that content proved elsewhere in
    the same file kind (and nowhere disproved more often) decides.
    """
    ended = events.where("change = 'removed'").select("file_kind", "feed", "seq", F.col("field").alias("old_field"))
    started = events.where("change = 'added'").select("feed", "seq", F.col("field").alias("new_field"))
    open_pairs = cut(ended.join(started, ["feed", "seq"]))
    wanted_old = open_pairs.select("feed", (F.col("seq") - 1).alias("seq"), F.col("old_field").alias("field")).distinct()
    wanted_new = open_pairs.select("feed", "seq", F.col("new_field").alias("field")).distinct()
    asked = wanted_old.unionByName(wanted_new).distinct()
    files = cat.select("feed", "file_name", "seq").distinct()
    wanted = asked.join(files, ["feed", "seq"]).select("feed", "file_name", "seq", F.col("field").alias("asked"))
    # A file's fields in question are few: one array per file travels with its records.
    per_file = cut(wanted.groupBy("feed", "file_name", "seq").agg(F.collect_set("asked").alias("asked")))
    key_of = F.create_map(*[F.lit(x) for kv in keys.items() for x in kv])
    fields = fields_of(records.join(per_file.select("feed", "file_name"), ["feed", "file_name"], "left_semi"), nested)
    is_key = F.col("field") == F.element_at(key_of, F.col("file_kind"))
    some = cut(fields.where("type is not null").join(per_file, ["feed", "file_name"]).where(F.array_contains("asked", F.col("field")) | is_key).select("record_id", "feed", "seq", "field", is_key.alias("is_key"), F.array_contains("asked", F.col("field")).alias("in_question"), content_form(F.col("text")).alias("form")))
    key_rows = some.where("is_key").groupBy("record_id").agg(F.min("form").alias("key"))
    told = some.where("in_question").join(key_rows, "record_id")
    told = cut(told.groupBy("feed", "seq", "key", "field").agg(F.max_by("form", "record_id").alias("form")))
    before = told.join(wanted_old, ["feed", "seq", "field"], "left_semi").select("feed", (F.col("seq") + 1).alias("seq"), "key", F.col("field").alias("old_field"), F.col("form").alias("old_form"))
    after = told.join(wanted_new, ["feed", "seq", "field"], "left_semi").select("feed", "seq", "key", F.col("field").alias("new_field"), F.col("form").alias("new_form"))
    shared = before.join(after, ["feed", "seq", "key"]).groupBy("feed", "seq", "old_field", "new_field").agg(F.count(F.lit(1)).alias("compared"), F.sum((F.col("old_form") == F.col("new_form")).cast("long")).alias("same"), F.count_distinct("old_form").alias("forms"))
    scored = open_pairs.join(shared, ["feed", "seq", "old_field", "new_field"], "left").na.fill(0, ["compared", "same", "forms"])
    alike = F.col("same") >= share * F.col("compared")
    # Of two flags some agree by chance: where there are few contents, all must be the same.
    telling = F.when(F.col("forms") > 2, alike).otherwise(F.col("same") == F.col("compared"))
    scored = cut(scored.withColumn("enough", F.col("compared") >= least).withColumn("proved", F.col("enough") & telling).withColumn("open", alike))
    names = [F.least("old_field", "new_field").alias("n1"), F.greatest("old_field", "new_field").alias("n2")]
    aliases = scored.groupBy("file_kind", *names).agg(F.sum(F.col("proved").cast("int")).alias("pro"), F.sum((F.col("enough") & ~F.col("open")).cast("int")).alias("con"))
    judged = scored.withColumn("n1", names[0]).withColumn("n2", names[1]).join(aliases, ["file_kind", "n1", "n2"], "left")
    likely = judged.where(F.col("proved") | (F.col("open") & (F.col("pro") > F.col("con"))))
    order = [F.col("proved").desc(), (F.col("same") / F.greatest("compared", F.lit(1))).desc(), F.col("pro").desc(), F.col("same").desc(), "old_field", "new_field"]
    ranked = likely.withColumn("r_old", F.row_number().over(W.partitionBy("feed", "seq", "old_field").orderBy(*order))).withColumn("r_new", F.row_number().over(W.partitionBy("feed", "seq", "new_field").orderBy(*order)))
    return ranked.where("r_old = 1 and r_new = 1").select("file_kind", "feed", "seq", "old_field", "new_field", "same", "compared")


def changes(records: DataFrame, keys: dict[str, str] = RECORD_KEYS, nested: str = "values") -> DataFrame:
    """Every change of a file against the previous file of its feed.

    (file_kind, feed, file_name, change, old_field, new_field), change `added`
    (old_field ''), `removed` (new_field ''), `renamed` or `type_changed` (same
    name twice). Files without a readable record don't count as files; a field
    seen only as null is present without a type. A rename is told only as such.
    An empty table gives no rows; further columns are ignored.
    """
    cat = cut(catalogue(fields_of(records, nested)))
    events = cut(_events(lifespans(cat)))
    moved = cut(renames(events, records, cat, keys, nested))
    lost = moved.select("feed", "seq", F.col("old_field").alias("field"), F.lit("removed").alias("change"))
    won = moved.select("feed", "seq", F.col("new_field").alias("field"), F.lit("added").alias("change"))
    plain = events.join(lost.unionByName(won), ["feed", "seq", "field", "change"], "left_anti")
    told = plain.select("file_kind", "feed", "seq", "change", F.when(F.col("change") == "added", "").otherwise(F.col("field")).alias("old_field"), F.when(F.col("change") == "removed", "").otherwise(F.col("field")).alias("new_field"))
    told = told.unionByName(moved.select("file_kind", "feed", "seq", F.lit("renamed").alias("change"), "old_field", "new_field"))
    files = cat.select("feed", "seq", "file_name").distinct()
    return told.join(files, ["feed", "seq"]).select("file_kind", "feed", "file_name", "change", "old_field", "new_field")


def alias_table(moved: DataFrame, cat: DataFrame) -> DataFrame:
    """(file_kind, field, canonical): names that renames tie together share the one most files use."""
    edges = moved.select(F.concat_ws("\t", "file_kind", "old_field").alias("a"), F.concat_ws("\t", "file_kind", "new_field").alias("b"), F.lit(0.0).alias("shift"))
    groups = propagate(edges).select("node", "root")
    used = cat.groupBy("file_kind", "field").agg(F.count(F.lit(1)).alias("files")).withColumn("node", F.concat_ws("\t", "file_kind", "field")).join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = used.groupBy("root").agg(F.max_by("field", F.struct("files", "field")).alias("canonical"))
    return used.join(best, "root").select("file_kind", "field", "canonical", "files")


#: The casts there are, by the type a field's values are brought to. Of a field's
#: value they have `v` (the variant, unwrapped), `plain` (a scalar's own text) and `json`.
CASTS = {
    "number": "try_cast(plain as decimal(38,6))",
    "boolean": "try_cast(plain as boolean)",
    "string": "coalesce(plain, json)",
    "array": "coalesce(json, plain)",
    "object": "coalesce(json, plain)",
}


def casts(cat: DataFrame, aliases: DataFrame) -> DataFrame:
    """The cast of every (field, type) to its canonical field's main type, as the SQL expression that `consistent` runs."""
    seen = cat.where("type is not null").join(aliases.drop("files"), ["file_kind", "field"]).groupBy("file_kind", "canonical", "field", "type").agg(F.count(F.lit(1)).alias("files"))
    per_type = seen.groupBy("file_kind", "canonical", "type").agg(F.sum("files").alias("files"))
    main = per_type.groupBy("file_kind", "canonical").agg(F.max_by("type", F.struct("files", "type")).alias("to_type"))
    sql = F.element_at(F.create_map(*[F.lit(x) for kv in CASTS.items() for x in kv]), F.col("to_type"))
    return seen.join(main, ["file_kind", "canonical"]).select("file_kind", "field", "canonical", F.col("type").alias("from_type"), "to_type", "files", sql.alias("cast"))


def consistent(records: DataFrame, keys: dict[str, str] = RECORD_KEYS, nested: str = "values") -> DataFrame:
    """All readable records as one table: canonical field names, values in their main type.

    (record_id, feed, file_name, file_kind, written_at, numbers, flags, texts):
    three maps by canonical field, for fields whose main type is number, boolean
    or anything else (texts; arrays and objects as JSON). Each value goes through
    the cast generated for its field and type (`casts`); a number written as
    text becomes a number. Wrapped values ({"text": x}, and [x] where the field
    isn't an array) are unwrapped by path; arrays of more values, other objects
    and all characters of a text stay as they are; a value that can't be cast
    stays in texts. Two old names of one field in one record keep the canonical
    one's value. Maps of any number of fields, so the drift needs no change of
    the table's schema.
    """
    cat = cut(catalogue(fields_of(records, nested)))
    moved = renames(_events(lifespans(cat)), records, cat, keys, nested)
    aliases = cut(alias_table(cut(moved), cat))
    generated = cut(casts(cat, aliases)).select("file_kind", "field", "canonical", F.col("from_type").alias("type"), "to_type", "cast")
    named = fields_of(records, nested).where("type is not null").join(generated, ["file_kind", "field", "type"])
    whole = F.parse_json("text")
    only_text = (F.col("type") == "object") & (F.size(F.expr("json_object_keys(text)")) == 1) & F.expr("json_object_keys(text)[0] = 'text'")
    lone = (F.col("type") == "array") & (F.col("to_type") != "array") & (F.expr("json_array_length(text)") == 1)
    v = F.when(only_text, F.try_variant_get(whole, "$.text", "variant")).when(lone, F.try_variant_get(whole, "$[0]", "variant")).otherwise(whole)
    opened = named.withColumn("v", v).withColumn("inner_type", _type(F.col("v")))
    plain = F.when(F.col("inner_type").isin("string", "number", "boolean"), F.try_variant_get("v", "$", "string"))
    forms = opened.withColumn("plain", plain).withColumn("json", F.when(F.col("plain").isNull(), F.to_json("v")))
    one = forms.groupBy("record_id", "feed", "file_name", "file_kind", "written_at", "canonical", "cast").agg(F.max_by(F.struct("plain", "json"), F.struct((F.col("field") == F.col("canonical")).alias("own"), "field")).alias("m")).select("*", "m.*")
    # The generated casts are run: each row by the one its field and type have.
    run = lambda kind: F.when(F.col("cast") == CASTS[kind], F.expr(CASTS[kind]))
    one = one.withColumn("number", run("number")).withColumn("flag", run("boolean"))
    one = one.withColumn("kept", F.coalesce(run("array"), run("string"), F.coalesce("plain", "json")))
    pairs = lambda value, keep: F.map_from_entries(F.array_sort(F.collect_list(F.when(keep, F.struct("canonical", value)))))
    return one.groupBy("record_id", "feed", "file_name", "file_kind", "written_at").agg(
        pairs("number", F.col("number").isNotNull()).alias("numbers"), pairs("flag", F.col("flag").isNotNull()).alias("flags"), pairs("kept", F.col("number").isNull() & F.col("flag").isNull()).alias("texts")
    )
