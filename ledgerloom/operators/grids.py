"""Grids of cells to lines: text tables, header roles, transposition, parallel streams, row clusters, alignment."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import codes as C
from ledgerloom.functions import numbers as N
from ledgerloom.functions import text as T
from ledgerloom.functions import years as Y

#: What a folded header cell holds and the role it then has; the first that fits counts.
HEADER_ROLES = (
    ("code", r"^\W*cod\b"), ("name", r"denumire|indicator"), ("code", r"\bcod\b|cod indicator"), ("row_no", r"nr\.? ?(crt|rd|rand)"),
    ("trim4", r"trim(estrul)?\.? ?(iv|4)\b"), ("trim3", r"trim(estrul)?\.? ?(iii|3)\b"), ("trim2", r"trim(estrul)?\.? ?(ii|2)\b"), ("trim1", r"trim(estrul)?\.? ?(i|1)\b"),
    ("credite_restante", r"credite|restante"), ("initial", r"initial"), ("est", r"estim"), ("total", r"total|prevederi|buget"),
)
SEPARATOR = r"\s*[\t|¦;]\s*|\s{3,}"


def cells_of_text(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, row, col, cell): lines of a text split at cell marks; lines of one cell are no rows of a grid.

    Row numbers are the lines' places in the text. Null and empty texts give nothing.
    """
    lines = rows.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("row", "line"))
    bare = F.regexp_replace(F.trim("line"), r"^[|¦]\s*|\s*[|¦]$", "")
    split = lines.select(key, "row", F.split(bare, SEPARATOR).alias("parts")).where(F.size("parts") >= 3)
    return split.select(key, "row", F.posexplode("parts").alias("col", "cell")).withColumn("cell", F.trim("cell"))


def trimmed(cells: DataFrame, key: str) -> DataFrame:
    """Without the rows after the last and the columns right of the last that hold something."""
    last = cells.where("cell is not null and cell != ''").groupBy(key).agg(F.max("row").alias("_row"), F.max("col").alias("_col"))
    return cells.join(last, key).where((F.col("row") <= F.col("_row")) & (F.col("col") <= F.col("_col"))).drop("_row", "_col")


def transposed(cells: DataFrame) -> DataFrame:
    """Rows for columns."""
    return cells.withColumns({"row": F.col("col"), "col": F.col("row")})


def header_rows(cells: DataFrame, key: str, within: int = 6) -> DataFrame:
    """(key, header): the last of the first rows that have two or more header words and no number, in the first `within` rows of a grid."""
    folded = T.fold(F.col("cell"))
    hint = folded.rlike("|".join(p for _, p in HEADER_ROLES))
    told = cells.groupBy(key, "row").agg(F.count_if(hint).alias("hints"), F.count_if(N.cell(F.col("cell"))["kind"] == "number").alias("numbers"))
    place = F.row_number().over(W.partitionBy(key).orderBy("row"))
    return told.withColumn("place", place).where((F.col("place") <= within) & (F.col("hints") >= 2) & (F.col("numbers") == 0)).groupBy(key).agg(F.max("row").alias("header"))


def column_roles(cells: DataFrame, headers: DataFrame, key: str) -> DataFrame:
    """(key, col, role) of the header's columns: per column the first pattern that fits, each role at its leftmost column."""
    head = cells.join(headers.select(key, F.col("header").alias("row")), [key, "row"]).select(key, "col", T.fold(F.col("cell")).alias("folded"))
    role = None
    for name, pattern in HEADER_ROLES:
        fits = F.col("folded").rlike(pattern)
        role = F.when(fits, name) if role is None else role.when(fits, name)
    dated = F.coalesce(Y.header_role(F.col("folded"), F.lit(None).cast("int")), role)
    return head.withColumn("role", dated).where("role is not null").groupBy(key, "role").agg(F.min("col").alias("col"))


def grid_facts(cells: DataFrame, key: str) -> DataFrame:
    """(key, row, code, name, column_name, kind, value): the generic mapping of a grid with a header to long facts.

    Values are read as scanned cells. Rows without a code are told with a null
    code; grids without a header give nothing. Joins on (key, col) only.
    """
    headers = header_rows(cells, key)
    roles = column_roles(cells, headers, key)
    data = cells.join(headers, key).where(F.col("row") > F.col("header")).join(roles, [key, "col"])
    who = data.groupBy(key, "row").agg(F.max(F.when(F.col("role") == "name", T.clean_name(F.col("cell")))).alias("name"), F.max(F.when(F.col("role") == "code", C.indicator_code(F.col("cell")))).alias("code"))
    values = data.where(~F.col("role").isin("name", "code", "row_no")).select(key, "row", F.col("role").alias("column_name"), N.cell(F.col("cell"), scanned=True).alias("c"))
    return values.join(who, [key, "row"]).select(key, "row", "code", "name", "column_name", "c.kind", "c.value")


def zipped_streams(rows: DataFrame, keep: list[str], streams: dict[str, Column]) -> DataFrame:
    """Parallel arrays as rows, only where all have the same length (else the row gives nothing)."""
    sizes = [F.size(c) for c in streams.values()]
    same = F.lit(True)
    for s in sizes[1:]:
        same = same & (s == sizes[0])
    zipped = rows.where(same).select(*keep, F.posexplode(F.arrays_zip(*[c.alias(n) for n, c in streams.items()])).alias("place", "z"))
    return zipped.select(*keep, "place", *[F.col("z")[n].alias(n) for n in streams])


def _clusters(group: list[str], at: str, limit: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(at, kind="stable").reset_index(drop=True)
        number, mean, size, out = -1, 0.0, 0, np.empty(len(pdf), dtype=np.int64)
        for i, y in enumerate(pdf[at].to_numpy(dtype=float).tolist()):
            if number < 0 or y - mean > limit:
                number, mean, size = number + 1, y, 1
            else:
                size += 1
                mean += (y - mean) / size
            out[i] = number
        return pdf.assign(cluster=out)

    return run


def mean_clusters(points: DataFrame, group: list[str], at: str, limit: float) -> DataFrame:
    """Adds `cluster`: a new one begins where a point lies more than `limit` beyond the running mean of the last.

    The mean moves with each point, so this is no gap rule a window could tell.
    A group is a page's words: small by nature. Points of a null place are left out.
    """
    schema = points.schema.simpleString()[len("struct<") : -1] + ",cluster:bigint"
    return points.where(F.col(at).isNotNull()).groupBy(*group).applyInPandas(_clusters(group, at, limit), schema)


def _align():
    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, y = a.sort_values("at", kind="stable"), b.sort_values("at_", kind="stable")
        p, q = x["label"].tolist(), y["label_"].tolist()
        best = np.zeros((len(p) + 1, len(q) + 1), dtype=np.int32)
        for i in range(len(p) - 1, -1, -1):
            for j in range(len(q) - 1, -1, -1):
                best[i, j] = best[i + 1, j + 1] + 1 if p[i] == q[j] else max(best[i + 1, j], best[i, j + 1])
        i = j = 0
        pairs = []
        while i < len(p) and j < len(q):
            if p[i] == q[j]:
                pairs.append((x["at"].iloc[i], y["at_"].iloc[j], p[i]))
                i, j = i + 1, j + 1
            elif best[i + 1, j] >= best[i, j + 1]:
                i += 1
            else:
                j += 1
        told = pd.DataFrame(pairs, columns=["left_at", "right_at", "label"])
        told.insert(0, "key", key[0])
        return told

    return run


def aligned(left: DataFrame, right: DataFrame, key: str, at: str, label: str) -> DataFrame:
    """(key, left_at, right_at, label): the longest order-keeping match of two label sequences per key.

    Of equally long ones that which skips on the left first. A key's sequences
    are the rows of a document: small by nature. Null labels match nothing.
    """
    schema = f"key {dict(left.dtypes)[key]}, left_at {dict(left.dtypes)[at]}, right_at {dict(right.dtypes)[at]}, label string"
    # Both sides get columns of their own: they may come from one table.
    a = left.where(F.col(label).isNotNull()).select(F.col(key).alias("key"), F.col(at).alias("at"), F.col(label).alias("label"))
    b = right.where(F.col(label).isNotNull()).select(F.col(key).alias("key_"), F.col(at).alias("at_"), F.col(label).alias("label_"))
    return a.groupBy("key").cogroup(b.groupBy("key_")).applyInPandas(_align(), schema)


def split_rows_stitched(cells: DataFrame, key: str) -> DataFrame:
    """(key, row, joined_to): rows that only complete the row right before: where one has a cell the other has none."""
    rows = cells.groupBy(key, "row").agg(F.array_sort(F.collect_set(F.when(F.coalesce("cell", F.lit("")) != "", F.col("col")))).alias("filled"), F.max("col").alias("wide"))
    by = W.partitionBy(key).orderBy("row")
    before, at = F.lag("filled").over(by), F.lag("row").over(by)
    joins = (at == F.col("row") - 1) & (F.size("filled") > 0) & (F.size(before) > 0) & ~F.arrays_overlap("filled", before)
    return rows.withColumn("joined_to", F.when(joins, at)).where("joined_to is not null").select(key, "row", "joined_to")


def _weighted(key_type: str):
    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, y = a.sort_values("at", kind="stable"), b.sort_values("at_", kind="stable")
        p, q = x["tokens"].map(set).tolist(), y["tokens_"].map(set).tolist()
        told = pd.DataFrame(columns=["key", "left_at", "right_at", "weight"])
        if p and q:
            weight = np.array([[len(s & t) for t in q] for s in p], dtype=np.int64)
            best = np.zeros((len(p) + 1, len(q) + 1), dtype=np.int64)
            for i in range(len(p) - 1, -1, -1):
                match = best[i + 1, 1:] + weight[i]
                row = np.maximum(best[i + 1, :-1], match)
                # The best over all later columns of a row: a running maximum from the right.
                best[i, :-1] = np.maximum.accumulate(row[::-1])[::-1]
            i = j = 0
            pairs = []
            while i < len(p) and j < len(q):
                if weight[i, j] and best[i, j] == best[i + 1, j + 1] + weight[i, j]:
                    pairs.append((key[0], x["at"].iloc[i], y["at_"].iloc[j], weight[i, j]))
                    i, j = i + 1, j + 1
                elif best[i, j] == best[i + 1, j]:
                    i += 1
                else:
                    j += 1
            told = pd.DataFrame(pairs, columns=told.columns)
        return told

    return run


def weighted_alignment(left: DataFrame, right: DataFrame, key: str, at: str, tokens: str) -> DataFrame:
    """(key, left_at, right_at, weight): the order-keeping alignment of two sequences of rows that shares the most tokens.

    tokens is an array of a row's words; a pair weighs how many it shares, pairs
    that share none aren't told. A key's rows are those of a document: small by
    nature. Null arrays are empty.
    """
    t = dict(left.dtypes)
    a = left.select(F.col(key).alias("key"), F.col(at).alias("at"), F.coalesce(F.col(tokens), F.array().cast("array<string>")).alias("tokens"))
    b = right.select(F.col(key).alias("key_"), F.col(at).alias("at_"), F.coalesce(F.col(tokens), F.array().cast("array<string>")).alias("tokens_"))
    return a.groupBy("key").cogroup(b.groupBy("key_")).applyInPandas(_weighted(t[key]), f"key {t[key]}, left_at {t[at]}, right_at {dict(right.dtypes)[at]}, weight long")


def wrapped_merged(cells: DataFrame, key: str) -> DataFrame:
    """Cells with rows that only complete the row before put into it; chains of them into the first."""
    joins = split_rows_stitched(cells, key)
    rows = cells.select(key, "row").distinct().join(joins, [key, "row"], "left")
    own = F.when(F.col("joined_to").isNull(), F.col("row"))
    first = rows.select(key, "row", F.last(own, ignorenulls=True).over(W.partitionBy(key).orderBy("row")).alias("_first"))
    moved = cells.join(first, [key, "row"]).where("cell is not null and cell != '' or row = _first").withColumnRenamed("row", "_row").withColumnRenamed("_first", "row")
    filled = F.filter(F.transform(F.array_sort(F.collect_list(F.struct("_row", "cell"))), lambda x: x["cell"]), lambda c: c != "")
    return moved.groupBy(key, "row", "col").agg(F.array_join(filled, " ").alias("cell"))
