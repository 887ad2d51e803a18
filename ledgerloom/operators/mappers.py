"""Grids of several layouts to long facts: each layout is a mapper of one interface, chosen by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import codes as C
from ledgerloom.functions import numbers as N
from ledgerloom.functions import text as T
from ledgerloom.operators import grids as G

#: (key, row, code, func_code, name, column_name, kind, value) of the cells (key, page, row, col, cell) of grids.
Mapper = Callable[[DataFrame, str], DataFrame]
#: Roles by place in tables printed without a header, by how many columns they have.
POSITIONAL = {
    3: ("name", "code", "total"),
    5: ("name", "code", "total", "trim1", "trim2"),
    7: ("name", "code", "total", "trim1", "trim2", "trim3", "trim4"),
    8: ("row_no", "name", "code", "total", "trim1", "trim2", "trim3", "trim4"),
}


def index_roles(cells: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """(key, row, col, role): columns by a printed row of indexes `1 2 3 ...`, the n-th role at index n.

    Such a row has three cells or more and numbers from 1 on without a gap.
    """
    n = F.regexp_extract(F.trim("cell"), r"^\(?(\d{1,2})\)?$", 1).try_cast("int")
    told = cells.where(F.trim("cell") != "").withColumn("_n", n)
    rows = told.groupBy(key, "row").agg(F.count(F.lit(1)).alias("_k"), F.count("_n").alias("_m"), F.count_distinct("_n").alias("_d"), F.min("_n").alias("_a"), F.max("_n").alias("_b"))
    index = rows.where("_k = _m and _m = _d and _k >= 3 and _a = 1 and _b = _k").groupBy(key).agg(F.min("row").alias("row"))
    names = F.element_at(F.array(*[F.lit(r) for r in order]), F.col("_n"))
    return told.join(index, [key, "row"]).where(F.col("_n") <= len(order)).select(key, "row", "col", names.alias("role"))


def roles_of(cells: DataFrame, key: str, page: str = "page", positional: dict[int, tuple[str, ...]] = POSITIONAL) -> DataFrame:
    """(key, page, header, col, role, basis): columns' roles of each page of a document.

    By the page's own header; else those of the page right before, if it has as
    many columns (and so on back: contexts are inherited through pages without
    a header, not over a gap); else by place, where the number of columns is one
    that has roles by place.
    """
    both = F.concat_ws("/", F.col(key).cast("string"), F.col(page).cast("string")).alias("_grid")
    grids = cells.select(key, page, both, "row", "col", "cell")
    headers = G.header_rows(grids, "_grid")
    own = G.column_roles(grids, headers, "_grid").groupBy("_grid").agg(F.map_from_entries(F.collect_list(F.struct("col", "role"))).alias("own"))
    pages = grids.groupBy(key, page, "_grid").agg((F.max("col") + 1).cast("int").alias("wide")).join(own, "_grid", "left").join(headers, "_grid", "left")
    by = W.partitionBy(key).orderBy(page)
    # A stretch of pages of one width without a gap inherits; a header of its own begins anew.
    breaks = (F.lag(page).over(by) != F.col(page) - 1) | (F.lag("wide").over(by) != F.col("wide")) | F.col("own").isNotNull()
    stretch = F.sum(F.coalesce(breaks, F.lit(True)).cast("long")).over(by)
    held = F.first("own", ignorenulls=True).over(W.partitionBy(key, "_stretch").orderBy(page).rowsBetween(W.unboundedPreceding, 0))
    told = pages.withColumn("_stretch", stretch).withColumn("_held", held)
    place = F.coalesce(*[F.when(F.col("wide") == n, F.map_from_arrays(F.array(*[F.lit(i) for i in range(n)]), F.array(*[F.lit(r) for r in roles]))) for n, roles in positional.items()])
    used = F.coalesce("own", "_held", place)
    basis = F.when(F.col("own").isNotNull(), "header").when(F.col("_held").isNotNull(), "inherited").otherwise("position")
    return told.where(used.isNotNull()).select(key, page, F.coalesce("header", F.lit(-1)).alias("header"), basis.alias("basis"), F.explode(used).alias("col", "role"))


def _facts(cells: DataFrame, roles: DataFrame, keys: list[str]) -> DataFrame:
    """Facts of cells whose columns have roles: the row's name and code with each value."""
    data = cells.join(roles, [*keys, "col"]).where(F.col("row") > F.col("header"))
    who = data.groupBy(*keys, "row").agg(F.max(F.when(F.col("role") == "name", T.clean_name(F.col("cell")))).alias("name"), F.max(F.when(F.col("role") == "code", F.col("cell"))).alias("_code"))
    coded = who.withColumn("_c", C.combined_code(F.col("_code"))).select(*keys, "row", "name", F.col("_c.code").alias("code"), F.col("_c.func_code").alias("func_code"))
    values = data.where(~F.col("role").isin("name", "code", "row_no") & (F.trim("cell") != "")).select(*keys, "row", F.col("role").alias("column_name"), N.cell(F.col("cell"), scanned=True).alias("c"))
    return values.join(coded, [*keys, "row"]).select(*keys, "row", "code", "func_code", "name", "column_name", "c.kind", "c.value")


def table(cells: DataFrame, key: str) -> DataFrame:
    """The generic table: a row per line, columns by header, inheritance or place."""
    return _facts(cells, roles_of(cells, key).drop("basis"), [key, "page"])


def transposed(cells: DataFrame, key: str) -> DataFrame:
    """Lines printed as columns: rows for columns, then the generic table."""
    return table(G.transposed(cells), key)


def matrix(cells: DataFrame, key: str) -> DataFrame:
    """Codes along both sides: every number is of its row's code, under its column's chapter.

    The first row with two codes or more names the columns; rows under it with
    one code are lines. Numbers of columns without a code belong to no chapter.
    """
    coded = cells.withColumn("_code", C.indicator_code(F.col("cell"))).withColumn("_number", N.cell(F.col("cell"), scanned=True))
    keys = [key, "page"]
    heads = coded.groupBy(*keys, "row").agg(F.count("_code").alias("_n")).where("_n >= 2").groupBy(*keys).agg(F.min("row").alias("header"))
    body = coded.join(heads, keys)
    chapters = body.where("row = header and _code is not null").select(*keys, "col", F.col("_code").alias("func_code"))
    first = F.min(F.when(F.col("_code").isNotNull(), F.struct("col", F.col("_code").alias("code"))))
    rows = body.where("row > header").groupBy(*keys, "row").agg(first.alias("_f"), F.max(F.when(F.col("_code").isNull() & (F.col("_number.kind") == "error"), T.clean_name(F.col("cell")))).alias("name")).where("_f is not null")
    values = body.where("row > header").join(rows, [*keys, "row"]).where(F.col("col") > F.col("_f.col")).join(chapters, [*keys, "col"]).where(F.trim("cell") != "")
    return values.select(*keys, "row", F.col("_f.code").alias("code"), "func_code", "name", F.lit("total").alias("column_name"), F.col("_number.kind").alias("kind"), F.col("_number.value").alias("value"))


def stacked(cells: DataFrame, key: str) -> DataFrame:
    """Rows of which a cell holds many lines' tokens: names, codes and values split and put side by side, where all count alike.

    Codes are what a cell has of code shapes, values what another has of
    numbers; a row whose counts differ gives nothing.
    """
    keys = [key, "page"]
    code_list = F.regexp_extract_all("cell", F.lit(rf"(?<![\d.,])({C.PAIRS})(?![\d.,])"), 1)
    number_list = F.regexp_extract_all("cell", F.lit(r"(-?\d{1,3}(?:\.\d{3})*,\d{1,2})"), 1)
    told = cells.withColumn("_codes", F.when(F.size(code_list) > 1, code_list)).withColumn("_numbers", F.when(F.size(number_list) > 1, number_list))
    rows = told.groupBy(*keys, "row").agg(F.max("_codes").alias("_codes"), F.max("_numbers").alias("_numbers"))
    zipped = G.zipped_streams(rows, [*keys, "row"], {"code": F.col("_codes"), "number": F.col("_numbers")})
    c = zipped.withColumn("c", N.cell(F.col("number"), scanned=True))
    return c.select(*keys, "row", "code", F.lit(None).cast("string").alias("func_code"), F.lit(None).cast("string").alias("name"), F.lit("total").alias("column_name"), "c.kind", "c.value")


def summary(cells: DataFrame, key: str) -> DataFrame:
    """A general summary: lines known by their name, each with one total, the row's last number."""
    keys = [key, "page"]
    read = cells.withColumn("c", N.cell(F.col("cell"), scanned=True))
    rows = read.groupBy(*keys, "row").agg(F.max_by(F.when(F.col("c.kind") == "number", F.col("c.value")), F.when(F.col("c.kind") == "number", F.col("col"))).alias("value"), F.min(F.when((F.col("c.kind") == "error") & C.indicator_code(F.col("cell")).isNull(), F.struct("col", T.clean_name(F.col("cell")).alias("n"))))["n"].alias("name"), F.max(C.indicator_code(F.when(F.col("c.kind") == "error", F.col("cell")))).alias("code"))
    return rows.where("name is not null and value is not null").select(*keys, "row", "code", F.lit(None).cast("string").alias("func_code"), "name", F.lit("total").alias("column_name"), F.lit("number").alias("kind"), "value")


#: Mappers by layout; a caller may add its own.
MAPPERS: dict[str, Mapper] = {"table": table, "transposed": transposed, "matrix": matrix, "collapsed": stacked, "general_summary": summary}


def mapped(cells: DataFrame, layouts: DataFrame, key: str, mappers: dict[str, Mapper] | None = None) -> DataFrame:
    """Facts of every document by the mapper of its layout; layouts(key, layout). Documents of an unknown layout give nothing."""
    out = None
    for name, mapper in (mappers or MAPPERS).items():
        own = cells.join(layouts.where(F.col("layout") == name).select(key), key, "left_semi")
        told = mapper(own, key).withColumn("layout", F.lit(name))
        out = told if out is None else out.unionByName(told)
    return out
