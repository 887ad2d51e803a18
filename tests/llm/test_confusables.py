import pytest
from hypothesis import given
from hypothesis import strategies as st

from ledgerloom.llm import confusables as C

SAME = ["Sold al fondului", "Дитячий садок", "Сільська бібліотека", "Λύκειο – schimb școlar", "Łódka de agrement", "Façade și mansarde", "Óvodai étkeztetés bővítése", "Programul „Casa Verde”", "Reparații – etapa a II-a", "Centrul «Lumina»", "m² și № 5 … ½", "Beşiktaş ğ", "", "A", "IT 2025", "Ţ̧"[:0]]


@pytest.mark.parametrize("text", SAME)
def test_ordinary_text_stays(text):
    assert C.ordinary(text) == text


@pytest.mark.parametrize(
    ("text", "form"),
    [
        ("Ｔａｘｅ pentru", "Taxe pentru"), ("prⅰⅴⅰnⅾ", "privind"), ("ﬁlarmonică", "filarmonică"), ("Sume\xa0alocate", "Sume alocate"), ("Tax​e", "Taxe"), ("so\xadld", "sold"), ("a﻿b⁠c‏d⁨e️f͏g", "abcdefg"),
        ("oraşului, pieţe", "orașului, piețe"), ("Încasări", "Încasări"), ("piețe", "piețe"), ("şi", "și"), ("Întreținere ‑ x － y", "Întreținere - x - y"),
        ("Ѕоld аl", "Sold al"), ("рrіvіnd", "privind"), ("Τaxe", "Taxe"), ("οrașului", "orașului"), ("Дитячий сaдoк", "Дитячий садок"), ("ре apă", "pe apă"), ("Λύκειo", "Λύκειο"), ("străziIe orașuIui", "străzile orașului"), ("AIocate", "Alocate"),
        ("Cӑtre", "Către"), ("cǎtre", "către"), ("fűtése és".replace("ű", "ű"), "fűtése és"),
    ],
)
def test_look_alikes_are_brought_back(text, form):
    assert C.ordinary(text) == form


@given(st.text(max_size=40))
def test_forms_are_stable(text):
    once = C.ordinary(text)
    assert C.ordinary(once) == once


def test_null_and_long():
    assert C.ordinary(None) is None
    assert C.ordinary("ааa " * 20_000) == "aaa " * 20_000


def rows(spark, names):
    return spark.createDataFrame([("t", i, n, "form", 1) for i, n in enumerate(names)], "source_table string, row_key long, name string, form string, n int")


def test_corpus_decides_first_letters(spark):
    names = ["Iernița"] * 6 + ["lernița"] + ["Taxa locală"] * 500 + ["Taxa Iocală", None, "", "locală", "lazuducea"]
    got = {(r.row_key, r.name, r["form"]) for r in C.spelled_otherwise(rows(spark, names)).collect()}
    assert {(n, f) for _, n, f in got} == {("lernița", "Iernița"), ("Taxa Iocală", "Taxa locală"), ("lazuducea", "Iazuducea")}


def test_repeats_and_empty_table(spark):
    assert C.spelled_otherwise(rows(spark, ["Ｔaxe", "Ｔaxe", "Taxe"])).count() == 2
    assert C.spelled_otherwise(rows(spark, [])).count() == 0


def test_words_behind_the_thousandth_are_known(spark):
    long = "Carne" + " si" * 1100 + " lapte"
    df = spark.createDataFrame([("Carne",)] * 200 + [(long,), ("lapte gras",)], "name string")
    assert {r.name: r.form for r in C.consistent_forms(df).collect()}["lapte gras"] == "lapte gras"


def test_delete_character_is_removed():
    assert C.ordinary("ab\x7fc") == "abc"


def test_letters_of_further_scripts_stand_in_for_latin_ones():
    assert C.ordinary("Ꮪtrada Mare") == "Strada Mare"
    assert C.ordinary("Ⲥetate") == "Cetate" and C.ordinary("ꓢALARII ꓐUNURI") == "SALARII BUNURI"
    cherokee = "ᏣᎳᎩ ᎦᏬᏂᎯᏍᏗ"
    assert C.ordinary(cherokee) == cherokee


def test_long_names_are_read_whole(spark):
    words = " ".join(f"Strada{i}" for i in range(1500))
    names = spark.createDataFrame([("Strada lunga " + words + " lac",), ("lac mare",)], "name string")
    assert {r.name[:8]: r.form[:8] for r in C.consistent_forms(names).collect()}["lac mare"] == "lac mare"
