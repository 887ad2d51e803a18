"""One consistent spelling for text that looks the same in different characters."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import small
from ledgerloom.session import cut

#: Look-alike letters, one row per script, column by column the same shape.
#: A dot stands where a script has no such letter.
SHAPES = {
    "LATIN": "A B C D E F G H I J K L M N O P Q R S T U V W X Y Z a b c d e f g h i j k l m n o p q r s t u v w x y z ă ï ë é Ï Ë ö ó ĸ ü ç".split(),
    "CYRILLIC": "А В С . Е . Ԍ Н І Ј К . М . О Р Ԛ . Ѕ Т . Ѵ Ԝ Х Ү . а . с ԁ е . . һ і ј . ӏ . . о р ԛ г ѕ . . ѵ ԝ х у . ӑ ї ё . Ї Ё ӧ . к . ҫ".split(),
    "GREEK": "Α Β . . Ε . . Η Ι . Κ . Μ Ν Ο Ρ . . . Τ . . . Χ Υ Ζ . . ϲ . . . . . . ϳ . . . . ο . . . . . . ν . . . . . ϊ . . Ϊ . . ό κ . .".split(),
    "ARMENIAN": ". . . . . . . . . . . . . . Օ . . . Տ . Ս . . . . . . . . . . . ց հ . յ . . . ո օ . զ . . . ս . . . . . . . . . . . . . . . .".split(),
}
#: Capitals A to Z of scripts that only ever stand in for Latin letters; a dot where a script has none.
STAND_INS = {
    "CHEROKEE": "Ꭺ Ᏼ Ꮯ Ꭰ Ꭼ . Ꮐ Ꮋ . Ꭻ Ꮶ Ꮮ Ꮇ . . Ꮲ . Ꭱ Ꮪ Ꭲ . Ꮩ Ꮃ . . Ꮓ".split(),
    "COPTIC": "Ⲁ Ⲃ Ⲥ . Ⲉ . . Ⲏ Ⲓ . Ⲕ . Ⲙ Ⲛ Ⲟ Ⲣ . . . Ⲧ . . . Ⲭ Ⲩ Ⲍ".split(),
    "LISU": "ꓮ ꓐ ꓚ ꓓ ꓰ ꓝ ꓖ ꓧ ꓲ ꓙ ꓗ ꓡ ꓟ ꓠ ꓳ ꓑ . ꓣ ꓢ ꓔ ꓴ ꓦ ꓪ ꓫ ꓬ ꓜ".split(),
}
#: Further pairs of one direction, which only a script's own words can decide.
EXTRA = {("CYRILLIC", "Ү"): "Y", ("CYRILLIC", "ɡ"): "g", ("GREEK", "ι"): "i", ("GREEK", "υ"): "u", ("GREEK", "σ"): "o", ("GREEK", "α"): "a", ("GREEK", "γ"): "y", ("GREEK", "ρ"): "p", ("GREEK", "τ"): "t", ("GREEK", "ύ"): "ú", ("GREEK", "ί"): "í"}
#: Latin letters that are another Latin letter's look-alike and not of any of the corpus's languages.
LATIN_DOUBLES = {"ɑ": "a", "ɡ": "g", "ⅼ": "l", "ǎ": "ă", "Ǎ": "Ă", "ʀ": "R", "ɩ": "i", "ꞌ": "'"}
#: The cedilla letters of older encodings and the Romanian letters they stand for.
CEDILLA = {"ş": "ș", "Ş": "Ș", "ţ": "ț", "Ţ": "Ț"}
#: Letters only Turkish has; beside them a cedilla s is Turkish.
TURKISH = set("ğĞıİ")
#: Hyphens that look like the ordinary one.
HYPHENS = {c: "-" for c in "‐‑﹣－˗⁃−­᠆"}
#: Invisible characters that aren't of category Cf, and blanks that aren't of category Zs.
INVISIBLE = {0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
BLANKS = {"⠀", "\t", "\n", "\r", "\v", "\f", "\x85", " ", " "}
#: Kinds of compatibility characters that look like what they decompose to.
SAME_LOOK = ("<wide>", "<narrow>", "<font>", "<noBreak>")


@lru_cache(maxsize=65536)
def script_of(c: str) -> str:
    """LATIN, CYRILLIC, GREEK ...; empty for what belongs to every script."""
    if not unicodedata.category(c).startswith("L"):
        return ""
    name = unicodedata.name(c, "")
    return name.split(" ")[0] if name else ""


def _maps() -> dict[tuple[str, str], dict[str, str]]:
    """(from script, to script): its letters with a look-alike there."""
    out: dict[tuple[str, str], dict[str, str]] = {}
    for a, row in SHAPES.items():
        for b, other in SHAPES.items():
            if a != b:
                out[a, b] = {x: y for x, y in zip(row, other, strict=True) if x != "." and y != "."}
    for (script, x), y in EXTRA.items():
        out[script, "LATIN"].setdefault(x, y)
    for script, row in STAND_INS.items():
        out[script, "LATIN"] = {x: y for x, y in zip(row, SHAPES["LATIN"], strict=False) if x != "."}
    return out


MAPS = _maps()


@lru_cache(maxsize=65536)
def resolved(c: str) -> frozenset[str]:
    """The scripts in which a letter with this look exists."""
    own = script_of(c)
    return frozenset({own} | {b for b in SHAPES if c in MAPS.get((own, b), {})}) if own else frozenset()


@lru_cache(maxsize=65536)
def _plain(c: str) -> str:
    """A character without its compatibility dress, if it looks as without."""
    d = unicodedata.decomposition(c)
    if not d or not d.startswith("<"):
        return c
    kind = d.split(" ")[0]
    if kind in SAME_LOOK:
        return unicodedata.normalize("NFKC", c)
    if kind == "<compat>" and unicodedata.category(c) in ("Ll", "Lu", "Nl"):
        letters = unicodedata.normalize("NFKC", c)
        return letters if letters.isalpha() else c
    return c


def visible(text: str) -> str:
    """Ordinary spaces and hyphens, nothing invisible, compatibility forms undressed."""
    out = []
    for c in text:
        category = unicodedata.category(c)
        if c in HYPHENS:
            if c != "­":
                out.append("-")
        elif category == "Zs" or c in BLANKS:
            out.append(" ")
        elif category in ("Cf", "Cc") or ord(c) in INVISIBLE:
            continue
        else:
            out.append(_plain(c))
    return "".join(out)


def _tokens(text: str) -> list[str]:
    """Runs of letters and marks, and what is between them, in order."""
    parts: list[str] = []
    inside: bool | None = None
    for c in text:
        is_letter = unicodedata.category(c)[0] in "LM"
        if inside is None or is_letter != inside:
            parts.append("")
            inside = is_letter
        parts[-1] += c
    return parts


def token_scripts(token: str) -> tuple[frozenset[str], set[str]]:
    """Scripts in which the whole token can be written, and those its unmistakable letters demand."""
    common: frozenset[str] | None = None
    anchors: set[str] = set()
    for c in unicodedata.normalize("NFC", token):
        scripts = resolved(c)
        if not scripts:
            base = unicodedata.normalize("NFD", c)[0]
            scripts = resolved(base) if base != c else scripts
        if not scripts:
            continue
        if len(scripts) == 1:
            anchors |= scripts
        common = scripts if common is None else common & scripts
    return common or frozenset(), anchors


def respelled(token: str, script: str) -> str:
    """The token with every letter that has a look-alike in `script` written in it."""
    out = []
    for c in unicodedata.normalize("NFC", token):
        own = script_of(c)
        there = MAPS.get((own, script))
        if there is None:
            out.append(c)
        elif c in there:
            out.append(there[c])
        else:
            parts = unicodedata.normalize("NFD", c)
            out.append(there.get(parts[0], parts[0]) + parts[1:])
    return unicodedata.normalize("NFC", "".join(out))


def _script(token: str, context: dict[str, int]) -> str | None:
    """The script a token is to be written in: where all its letters fit, else where most of its own letters are."""
    own: dict[str, int] = {}
    for c in unicodedata.normalize("NFC", token):
        s = script_of(c)
        if s:
            own[s] = own.get(s, 0) + 1
    if not own:
        return None
    common, anchors = token_scripts(token)
    if len(own) == 1 and anchors:
        return next(iter(own))
    if common:
        # Every letter fits several scripts: whole-script look-alikes follow their neighbours, else the Latin look.
        best = max(sorted(common), key=lambda s: (context.get(s, 0), s == "LATIN", own.get(s, 0)))
        return best
    # Mixed: the script of the letters that exist in no other.
    weight: dict[str, int] = {}
    for c in unicodedata.normalize("NFC", token):
        scripts = resolved(c)
        if len(scripts) == 1:
            s = next(iter(scripts))
            weight[s] = weight.get(s, 0) + 1
    return max(sorted(weight or own), key=lambda s: ((weight or own)[s], own.get(s, 0)))


def _inner_capital(token: str) -> str:
    """A capital I inside a word of small letters is a small l."""
    if "I" not in token[1:] or not any(c.islower() for c in token) or any(c.isupper() and c != "I" for c in token[1:]):
        return token
    return token[0] + token[1:].replace("I", "l")


def ordinary(text: str | None) -> str | None:
    """The consistent spelling of a text; null stays null, and what is ordinary stays as it is.

    For each token the scripts in which each of its letters exists are
    intersected. If a common script is left, the token is a whole-script
    look-alike or plain and follows the text's unmistakable words; if none is,
    it is mixed and takes the script of its unmistakable letters. Then marks are
    composed, and Romanian's cedilla letters get their commas.
    """
    if text is None or text.isascii() and "I" not in text and not any(c < " " or c == "\x7f" for c in text):
        return text
    parts = _tokens(unicodedata.normalize("NFC", visible(text)))
    context: dict[str, int] = {}
    for p in parts:
        scripts, anchors = token_scripts(p)
        for s in anchors:
            context[s] = context.get(s, 0) + 1
        if not anchors and scripts == frozenset({"LATIN"}):
            context["LATIN"] = context.get("LATIN", 0) + 1
    turkish = bool(TURKISH & set(text))
    out = []
    for p in parts:
        script = _script(p, context)
        if script in SHAPES:
            p = respelled(p, script)
        if script == "LATIN":
            p = "".join(LATIN_DOUBLES.get(c, c) for c in p)
            if not turkish:
                p = "".join(CEDILLA.get(c, c) for c in p)
            p = _inner_capital(p)
        out.append(p)
    return unicodedata.normalize("NFC", "".join(out))


def _spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"name": pdf.name_, "n": pdf.n, "form": [ordinary(t) for t in pdf.name_]})


def _initials(forms: DataFrame, dominance: int) -> DataFrame:
    """(token, better): words whose first letter is an I written l, or an l written I, by the corpus's own words."""
    words = forms.select("n", F.explode(F.split("form", r"[^\p{L}\p{M}]+")).alias("token")).where(F.length("token") > 1)
    either = words.where(F.substring("token", 1, 1).isin("I", "l")).groupBy("token").agg(F.sum("n").alias("n"))
    shape = F.concat(F.lit("l"), F.expr("substring(token, 2)"))
    best = either.groupBy(shape.alias("shape")).agg(F.max_by("token", F.struct("n", "token")).alias("better"), F.max("n").alias("most"))
    return either.join(best, shape == F.col("shape")).where((F.col("token") != F.col("better")) & (F.col("most") >= dominance * F.col("n"))).select("token", "better")


def consistent_forms(names: DataFrame, dominance: int = 3) -> DataFrame:
    """(name, form): every distinct name and its consistent spelling.

    names(name): one row per occurrence; nulls give no row. Distinct names are
    spelled once. Where only the corpus can tell l from I (the first letter of a
    word), the spelling `dominance` times as frequent wins; a name that begins
    with a small l where the capital I is as frequent takes the capital if the
    corpus's names begin with capitals.
    """
    counted = names.where("name is not null").groupBy(F.col("name").alias("name_")).agg(F.count(F.lit(1)).alias("n"))
    # As many tasks as cores: the few distinct names are costly to spell, and adaptive execution would put them into one.
    forms = cut(counted.repartition(names.sparkSession.sparkContext.defaultParallelism).mapInPandas(_spell, "name string, n long, form string"))
    swaps = _initials(forms, dominance)
    words = forms.select("name", "form", F.posexplode(F.split("form", r"(?<=[\p{L}\p{M}])(?![\p{L}\p{M}])|(?<![\p{L}\p{M}])(?=[\p{L}\p{M}])")).alias("at", "token")).where(F.substring("token", 1, 1).isin("I", "l") | F.col("form").rlike(r"(^|[^\p{L}\p{M}])[Il]"))
    fixed = words.join(swaps, "token", "left").withColumn("token", F.coalesce("better", "token")).groupBy("name").agg(F.array_sort(F.collect_list(F.struct("at", "token"))).alias("parts"))
    rejoined = fixed.select("name", F.concat_ws("", F.col("parts.token")).alias("better_form"))
    capital = forms.agg((F.sum(F.when(F.substring("form", 1, 1) == F.upper(F.substring("form", 1, 1)), F.col("n")).otherwise(0)) >= 0.99 * F.sum("n")).alias("capitals"))
    told = forms.join(rejoined, "name", "left").select("name", F.coalesce("better_form", "form").alias("form"), capital.scalar().alias("capitals"))
    known = _initials_known(forms)
    first = F.regexp_extract("form", r"^[\p{L}\p{M}]+", 0)
    joined = told.withColumn("first", first).join(known, F.col("first") == F.col("word"), "left")
    raised = F.when(F.col("capitals") & F.col("form").startswith("l") & F.col("word").isNull(), F.concat(F.lit("I"), F.expr("substring(form, 2)"))).otherwise(F.col("form"))
    return joined.select("name", raised.alias("form"))


def _initials_known(forms: DataFrame) -> DataFrame:
    """Words with a small l that are written so inside names, so that a name may well begin with them."""
    words = F.split("form", r"[^\p{L}\p{M}]+")
    inner = forms.select(F.explode(F.slice(words, F.lit(2), F.size(words))).alias("word"))
    return inner.where(F.col("word").startswith("l")).distinct()


def spelled_otherwise(rows: DataFrame) -> DataFrame:
    """(source_table, row_key, name, form) of the rows whose name isn't in its consistent spelling.

    rows(source_table, row_key, name). Names of each source are judged by all
    sources' words. Null and empty names are never told; repeated rows are each
    told; further columns are ignored.
    """
    told = rows.select("source_table", "row_key", "name")
    forms = consistent_forms(told.select("name"))
    # Hot names are no hot keys where the odd forms, which grow with distinct names only, are counted few enough to be sent.
    other = cut(forms.where(F.col("name") != F.col("form")))
    return told.join(small(other), "name").select("source_table", "row_key", "name", "form")
