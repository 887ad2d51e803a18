"""Numbers and units as they are printed: column expressions, no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,6)"

#: Every space that may group digits or surround a value.
SPACES = r"[\s  -​  　﻿]"
#: What stands for "no reading".
DASHES = ("-", "–", "—", "−")


def blank_to_null(c: Column) -> Column:
    """Null for null, empty, or space-only text; else the text without outer spaces."""
    bare = F.regexp_replace(c, f"^{SPACES}+|{SPACES}+$", "")
    return F.when(bare != "", bare)


def _signed(digits: Column) -> Column:
    """Parentheses and the typographic minus are signs."""
    plain = F.regexp_replace(digits, "[−–]", "-")
    return F.when(plain.rlike(r"^\(.*\)$"), F.concat(F.lit("-"), F.regexp_replace(plain, r"[()]", ""))).otherwise(plain)


def printed_number(c: Column, notation: Column | None = None) -> Column:
    """A printed number as decimal(38,6); null where it isn't one.

    Without `notation` a comma is the decimal mark and dots then group digits,
    and without a comma a dot is the decimal mark. `notation` `romanian` makes
    every dot a grouping mark, `canonical` every comma.
    """
    text = _signed(F.regexp_replace(blank_to_null(c), SPACES, ""))
    comma = F.regexp_replace(F.regexp_replace(text, r"\.", ""), ",", ".")
    auto = F.when(F.contains(text, F.lit(",")), comma).otherwise(text)
    if notation is not None:
        canonical = F.regexp_replace(text, ",", "")
        auto = F.when(notation == "romanian", comma).when(notation == "canonical", canonical).otherwise(auto)
    return F.when(auto.rlike(r"^-?\d+(\.\d*)?$|^-?\.\d+$"), auto.try_cast(MONEY))


def loose_number(c: Column) -> Column:
    """A loosely typed number text such as `1 245`, ` 533.0` or `8,096` in plain form.

    The result is the shortest text of the number, of any length, so equal
    numbers are equal texts. Text that isn't a number comes back trimmed and in
    lower case.
    """
    text = F.regexp_replace(blank_to_null(c), SPACES, "")
    grouped = F.when(text.rlike(r"^-?\d{1,3}(,\d{3})+(\.\d+)?$"), F.regexp_replace(text, ",", "")).otherwise(F.regexp_replace(text, ",", "."))
    return F.coalesce(shortest(grouped), F.lower(blank_to_null(c)))


def shortest(text: Column) -> Column:
    """The shortest text of a plain decimal text of any length (no outer zeros, no plus, no minus nil); null for other text."""
    # One chain of replacements, so the expression stays small where it is nested.
    bare = text
    for pattern, by in ((r"^\+", ""), (r"^(-?)\.", "$10."), (r"^(-?)0+(?=\d)", "$1"), (r"(\.\d*?)0+$", "$1"), (r"\.$", ""), (r"^-0$", "0")):
        bare = F.regexp_replace(bare, pattern, by)
    return F.when(text.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)$"), bare)


#: A unit's words and the power of ten that brings it to mii lei, greatest first.
UNITS = ((6, r"miliarde?|mld\.?"), (3, r"milioane|milion|mil\.?|mln\.?|mio\.?"), (0, r"mii|mie|k|ezer|thousand"))
#: Names of the currency.
CURRENCY = r"(?:lei|leu|ron)"


def unit_exponent(c: Column) -> Column:
    """Power of ten that brings an amount with this unit text to mii lei; null if the text states no unit.

    lei and RON are -3, mii (thousand, k) 0, milioane (mil.) 3, miliarde 6. A
    unit may be glued to a number (`18,5mil. RON`) or an underscore (`mii_lei`),
    not to other letters (`premii lei` has no thousands). Every unit needs its
    currency; of several the greatest is told.
    """
    text = F.lower(c)
    alone = r"(?<!\p{L})"
    told = None
    for power, words in UNITS:
        fits = text.rlike(rf"{alone}(?:{words})[\s_]*(?:de[\s_]+)?{CURRENCY}(?!\p{{L}})")
        told = F.when(fits, F.lit(power)) if told is None else told.when(fits, F.lit(power))
    return told.when(text.rlike(rf"{alone}{CURRENCY}(?!\p{{L}})"), F.lit(-3))


def number_part(c: Column) -> Column:
    """The number inside a text that may also carry a unit."""
    return F.regexp_extract(c, r"\(?[-−]?\d[\d.,\s  ]*\d\)?|[-−]?\d", 0)


def times_ten_to(value: Column, exponent: Column) -> Column:
    """Decimal `value` times ten to an exponent of -9..9, exact in decimal(38,6)."""
    factor = F.pow(F.lit(10.0), exponent).cast("decimal(20,9)")
    return (value.cast("decimal(26,6)") * factor).cast(MONEY)


def cell(c: Column, scanned: bool = False) -> Column:
    """struct(kind, value): kind is number, x (not applicable), empty or error; only numbers have a value.

    Dots group three digits each, the last comma is the decimal mark. Two
    amounts in one cell, wrong groups and other text are errors, never nil; a
    lone dash is empty. `scanned` also reads what scanners make of digits and
    marks: letters like digits, a dot or comma before one or two last digits as
    decimal mark, either mark between groups of three.
    """
    two = c.rlike(r"^\s*\d[\d.]*,\d{2}\s+\d[\d.]*,\d{2}\s*$")
    text = F.regexp_replace(F.coalesce(c, F.lit("")), SPACES, "")
    x = F.upper(text) == "X"
    if scanned:
        x = x | F.lower(F.regexp_replace(text, r"[^0-9a-zA-Z×]", "")).isin("x", "xx", "1x", "x1", "ix", "lx", "xi", "×")
        digits = F.translate(F.regexp_replace(text, r"(?<=\d)[:;](?=\d)", "."), "OoPpIlSsGB", "0000115568")
        tail = F.regexp_replace(F.regexp_replace(digits, r"([.,]\d?)[Cc(]$", "$10"), r"([.,])[Cc(](\d)$", "$10$2")
        text = F.when(tail.rlike(r"^[\d.,()\-−–—]+$"), tail).otherwise(text)
    empty = (text == "") | text.isin(*DASHES) | (F.lit(scanned) & (text == "?"))
    negative = text.rlike(r"^[-−–—]") | text.rlike(r"^\(.*\)$")
    body = F.regexp_replace(text, r"^[-−–—]|^\((?=.*\)$)|(?<=^\(.{1,60})\)$", "")
    strict = F.when(body.rlike(r"^\d+(,\d+)?$|^\d+(\.\d{3})+(,\d+)?$"), F.regexp_replace(F.regexp_replace(body, r"\.", ""), ",", "."))
    plain = strict
    if scanned:
        grouped = F.when(body.rlike(r"^\d{1,3}([.,]\d{3})+$"), F.regexp_replace(body, "[.,]", ""))
        decimal = F.when(body.rlike(r"^(\d+|\d{1,3}([.,]\d{3})+)[.,]\d{1,2}$"), F.concat(F.regexp_replace(F.regexp_extract(body, r"^(.*)[.,]\d{1,2}$", 1), "[.,]", ""), F.lit("."), F.regexp_extract(body, r"[.,](\d{1,2})$", 1)))
        plain = F.coalesce(grouped, decimal, strict)
    value = plain.try_cast(MONEY)
    number = F.when(negative, -value).otherwise(value)
    kind = F.when(two, "error").when(empty, "empty").when(x, "x").when(number.isNull(), "error").otherwise("number")
    return F.struct(kind.alias("kind"), F.when(kind == "number", number).alias("value"))


def romanian_text(value: Column, decimals: int = 2) -> Column:
    """A number as printed: 1.234.567,89, half to even."""
    return F.translate(F.format_number(F.bround(value, decimals), decimals), ",.", ".,")


def canonical_text(value: Column) -> Column:
    """A number's shortest text: no trailing zeros, no trailing point."""
    return F.regexp_replace(F.regexp_replace(value.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
