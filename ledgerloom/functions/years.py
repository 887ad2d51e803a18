"""Years in headers and column roles, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def years_in(c: Column) -> Column:
    """Distinct years 1900 to 2099 of a text, in their order."""
    return F.transform(F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?<!\d)((?:19|20)\d{2})(?!\d)"), 1)), lambda y: y.cast("int"))


def budget_year(c: Column, fallback: Column | None = None) -> Column:
    """The earliest year from 2000 on: annual tables print the current year before its forecasts."""
    first = F.array_min(F.filter(years_in(c), lambda y: y.between(2000, 2100)))
    return first if fallback is None else F.coalesce(first, fallback)


#: What a header cell with a year says, and the role it then has, in this order. A plan is the
#: total of its own edition's year, else a budget.
HEADER_WORDS = (("executie_", "exec"), ("plan", "bvc"), ("est", r"estim|^\s*(19|20)\d{2}\s*$"), ("buget_", "initial"), ("total_", "buget|prevederi|total"))
#: Fixed value: quarters have roles of their own.
QUARTER = "trim"


def header_role(c: Column, year: Column) -> Column:
    """Role of a header cell with a year (HEADER_WORDS), null for quarters and headers without a year."""
    text, at = F.lower(c), F.get(years_in(F.lower(c)), F.lit(0))
    kind = F.coalesce(*[F.when(text.rlike(words), F.lit(role)) for role, words in HEADER_WORDS])
    kind = F.when(kind != "plan", kind).when(F.coalesce(year, at) == at, "total_").when(kind == "plan", "buget_")
    return F.when(at.isNotNull() & ~F.contains(text, F.lit(QUARTER)), F.concat(kind, at.cast("string")))


def role_year(role: Column) -> Column:
    """The year of a total_, buget_ or est role."""
    return F.regexp_extract(role, r"^(?:total_|buget_|est)(\d{4})$", 1).try_cast("int")


#: Years a role may lie after its edition, by kind of role.
REACH = (("total_", 0, 0), ("buget_", 0, 0), ("est", 1, 3))


def shifted_role(role: Column, year: Column, edition: int) -> Column:
    """A role of one edition told for another year's; roles out of their kind's REACH, and all where no year is given, stay."""
    ahead = role_year(role) - edition
    reaches = F.coalesce(*[F.when(role.startswith(kind), ahead.between(low, high)) for kind, low, high in REACH], F.lit(False))
    return F.when(year.isNotNull() & reaches, F.concat(F.regexp_extract(role, r"^\D+", 0), (year + ahead).cast("string"))).otherwise(role)


def annual_rank(column: Column) -> Column:
    """Preference among current-budget columns: total, then total_ and buget_ by year, latest first; null for others."""
    year = role_year(column)
    return F.when(column == "total", F.lit(0)).when(column.startswith("total_"), 10000 - year).when(column.startswith("buget_"), 20000 - year)


def column_label(role: Column) -> Column:
    """What a sheet prints above a role's column; null for other roles."""
    y = F.regexp_extract(role, r"(\d{4})$", 1)
    return F.when(role.rlike(r"^total_\d{4}$"), F.concat(F.lit("TOTAL "), y)).when(role.rlike(r"^buget_\d{4}$"), F.concat(F.lit("Buget "), y)).when(role.rlike(r"^est\d{4}$"), F.concat(F.lit("Estimare "), y))
