from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import codes as C
from ledgerloom.functions import numbers as N
from ledgerloom.functions import text as T
from ledgerloom.functions import years as Y


def mapped(spark, values, column, schema="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [("1.234,50", "number", "1234.5"), ("1.234", "number", "1234"), ("1.23", "error", None), ("12,5", "number", "12.5"), ("X", "x", None), ("x", "x", None), ("", "empty", None), (None, "empty", None), ("-", "empty", None),
     ("-12", "number", "-12"), ("(1.000,00)", "number", "-1000"), ("−5", "number", "-5"), ("57.199,00 39.768,00", "error", None), ("abc", "error", None), ("1.2345", "error", None), ("12,", "error", None)],
)
def test_cell_strict(spark, text, kind, value):
    got = mapped(spark, [text], N.cell(F.col("x")))[0]
    assert got.kind == kind
    assert got.value == (Decimal(value) if value else None)


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [("48152.87", "number", "48152.87"), ("19,809.00", "number", "19809"), ("15,735,00", "number", "15735"), ("91.123.00", "number", "91123"), ("69,600.000", "number", "69600000"), ("617,OC", "number", "617"), ("l2S", "number", "125"), ("1x", "x", None), ("?", "empty", None), ("1:234,50", "number", "1234.5"), ("41.02C", "error", None)],
)
def test_cell_scanned(spark, text, kind, value):
    got = mapped(spark, [text], N.cell(F.col("x"), scanned=True))[0]
    assert (got.kind, got.value) == (kind, Decimal(value) if value else None)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.decimals(min_value=Decimal("-999999999.99"), max_value=Decimal("999999999.99"), places=2), min_size=1, max_size=60))
def test_printed_numbers_come_back(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x decimal(18,2)")
    printed = df.withColumn("p", N.romanian_text(F.col("x")))
    assert printed.where(~N.cell(F.col("p"))["value"].eqNullSafe(F.col("x"))).count() == 0


def test_loose_numbers(spark):
    got = mapped(spark, ["1 245", " 533.0", "8 096", "0012", "1,5", "x1", "", None, "-7.50"], N.loose_number(F.col("x")))
    assert got == ["1245", "533", "8096", "12", "1.5", "x1", None, None, "-7.5"]


def test_units(spark):
    texts = ["12 lei", "RON", "mii lei", "Mii RON", "3 k lei", "mil. lei 5", "0,5 milioane de lei", "9 miliarde lei", "- lei -", "mii_lei", "unknown", None, "pagină rotită", "lei (RON)", "tabel în lei, exemplar semnat", "mii de lei, pagină scanată"]
    assert mapped(spark, texts, N.unit_exponent(F.col("x"))) == [-3, -3, 0, 0, 0, 3, 3, 6, -3, 0, None, None, None, -3, -3, 0]


def test_codes(spark):
    raw = ["42.02.93.01", "65020301", "42/02/93", "51.02A", "20.02.00", "001.02", "59,40", "D", "01F", "*", None, "42 55", "66.02.06.04*"]
    assert mapped(spark, raw, C.indicator_code(F.col("x"))) == ["42.02.93.01", "65.02.03.01", "42.02.93", "51.02", "20.02", "00.01.02", "59.40", None, None, None, None, "42.55", "66.02.06.04"]
    both = mapped(spark, ["5102.200130", "7002.1001", "59.01", "65.02"], C.combined_code(F.col("x")))
    assert [tuple(b) for b in both] == [("20.01.30", "51.02"), ("10.01", "70.02"), ("59.01", None), ("65.02", None)]
    assert mapped(spark, ["65.02.04.01", "65.02", "10"], C.parent_code(F.col("x"), F.lit("revenue"))) == ["65.02.04", None, None]
    assert mapped(spark, ["10.01.01", "10.01", "10"], C.parent_code(F.col("x"), F.lit("expense_economic"))) == ["10.01", "10", None]
    assert mapped(spark, ["510103", "2001", None], C.dotted_code(F.col("x"), F.lit("revenue"), F.lit("02"))) == ["51.02.01.03", "00.02.20.01", None]
    assert mapped(spark, ["Total (cod 74.02.03+74.02.05)", "x (cod 51.02 la 53.02)", "none"], C.formula_children(F.col("x"))) == [["74.02.03", "74.02.05"], None, None]
    assert [tuple(m) for m in mapped(spark, ["66.02.06.04*", "51.0", "58 06 01"], C.marked_code(F.col("x")))] == [("66.02.06.04", "*"), ("51", ""), ("58.06.01", "")]


def test_years(spark):
    assert mapped(spark, ["2024 si 2025, 2024", "nr. 120245", None], Y.years_in(F.col("x"))) == [[2024, 2025], [], []]
    assert mapped(spark, ["2027 2025 2026", "1998", None], Y.budget_year(F.col("x"))) == [2025, None, None]
    heads = ["Executie 2024", "BVC 2025", "Estimari 2027", "2028", "Buget initial 2025", "Prevederi 2025", "Trim I 2025", "cod"]
    assert mapped(spark, heads, Y.header_role(F.col("x"), F.lit(2026))) == ["executie_2024", "buget_2025", "est2027", "est2028", "buget_2025", "total_2025", None, None]
    assert mapped(spark, ["total_2026", "est2028", "trim1"], Y.shifted_role(F.col("x"), F.lit(2024), 2026)) == ["total_2024", "est2026", "trim1"]


def test_texts(spark):
    assert mapped(spark, ["ȘTIINȚĂ și Öl", "ã́", None], T.fold(F.col("x"))) == ["stiinta si ol", "a", None]
    assert mapped(spark, ["  1. Total   venituri: "], T.clean_name(F.col("x"))) == ["Total venituri"]
    assert mapped(spark, ["Piața Mare (nr. 2)", ""], T.safe_id(F.col("x"))) == ["piata-mare-nr-2", ""]
    assert mapped(spark, ['so: {"a": 1} done', "none", '{"a": '], T.json_inside(F.col("x"))) == ['{"a":1}', None, None]


def test_fuzzy_scores():
    assert T.indel_ratio("abcd", "abcd") == 100 and T.indel_ratio("", "") == 100 and T.indel_ratio("ab", "") == 0
    assert round(T.indel_ratio("kitten", "sitting"), 4) == round(200 * 4 / 13, 4)
    assert T.token_set_ratio("total venituri", "venituri total proprii") == 100
    assert T.partial_ratio("abc", "xxabcxx") == 100


@settings(max_examples=60, deadline=None)
@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
def test_subsequence_equals_table(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert T._common_subsequence(a, b) == table[-1][-1]


def test_near_keys_meet_at_one_edit(spark):
    names = ["bolt", "bold", "bol", "bolts", "cold", "x"]
    s = spark.createDataFrame([(n,) for n in names], "name string")
    keyed = s.select("name", F.explode(T.near_keys(F.col("name"))).alias("k"))
    met = {(r.a, r.b) for r in keyed.toDF("a", "k").join(keyed.toDF("b", "k"), "k").where("a < b and levenshtein(a, b) <= 1").select("a", "b").collect()}
    assert met == {("bold", "bolt"), ("bol", "bolt"), ("bol", "bold"), ("bolt", "bolts"), ("bold", "cold")}


def test_unit_words_glued_and_spaced(spark):
    words = {6: ["miliarde", "miliard", "mld", "mld."], 3: ["milioane", "milion", "mil.", "mil", "mln"], 0: ["mii", "k", "ezer"]}
    texts, powers = [], []
    for power, names in words.items():
        for name in names:
            for currency in ("lei", "RON"):
                for form in (f"18,51944{name} {currency}", f"18,5 {name} {currency}", f"{name} {currency} 18,5", f"18,5{name} de {currency}", f"18 {name.upper()} {currency}", f"{name}_{currency}"):
                    texts.append(form)
                    powers.append(power)
    for form in ("7lei", "7 LEI", "RON 7", "lei (RON)"):
        texts.append(form)
        powers.append(-3)
    for form in ("premii lei", "7", "leit", "mii", "", None):
        texts.append(form)
        powers.append(-3 if form == "premii lei" else None)
    assert mapped(spark, texts, N.unit_exponent(F.col("x"))) == powers


def test_shortest_has_no_bound_of_digits(spark):
    long_ = "9" * 60
    got = mapped(spark, [long_, f"000{long_}.500", f"-{long_}", "-0.00", "+5", ".5", "5.", "x"], N.shortest(F.col("x")))
    assert got == [long_, f"{long_}.5", f"-{long_}", "0", "5", "0.5", "5", None]
