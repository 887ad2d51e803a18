"""Operators of the staged pipeline on small planted cases: registry, matching, reports, repairs, manifests, assembly, pages, mappers."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import codes as C
from ledgerloom.functions import text as T
from ledgerloom.operators import assembly, execution, grids, joins, manifest, mappers, matching, pages, registry, repairs

D = Decimal


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


LINES = "id long, kind string, code string, name string"
REGISTRY = "kind string, code string, official string"


def test_registry_chain(spark):
    reg = spark.createDataFrame([("revenue", "42.02", "Subvenții"), ("revenue", "16.02.02", "Taxe pe mijloace de transport"), ("expense", "65", "Învățământ")], REGISTRY)
    lines = spark.createDataFrame([(1, "revenue", "42.02", "Subventii"), (2, "revenue", "16.10.02", "Taxe pe mijloace de transport"), (3, "revenue", "42.02.05", "x"), (4, "revenue", "99.99", "y"), (5, "revenue", "99.98", "TOTAL VENITURI"), (6, None, "42.02", None), (7, "revenue", None, "z")], LINES)
    found = registry.matched(lines, reg, "id")
    assert rows(found, "id", "attempt", "matched_code") == [(1, 1, "42.02"), (2, 2, "16.02.02"), (3, 3, "42.02"), (4, None, None), (5, None, None), (6, None, None), (7, None, None)]
    assert rows(registry.unknown_codes(found), "id") == [(4,), (6,)]
    odd = spark.createDataFrame([(1, "revenue", "42.02", "Amenzi si penalitati"), (2, "revenue", "42.02", "Subvenții (cod 42.02.01+42.02.02)"), (3, "revenue", "42.02.05", "cu totul altceva")], LINES)
    assert rows(registry.discordant_names(registry.matched(odd, reg, "id")), "id") == [(1,)]


def test_codes_corrected_by_name_and_completed(spark):
    reg = spark.createDataFrame([("expense", "65.02", "invatamant prescolar"), ("expense", "66.02", "sanatate publica"), ("expense", "68.02", "asistenta sociala")], REGISTRY)
    lines = spark.createDataFrame([(1, "expense", "66.02", "Învățământ preșcolar"), (2, "expense", "66.02", "Sănătate publică"), (3, "expense", "65.82", "Învățământ preșcolar"), (4, "expense", "99.02", "Învățământ preșcolar")], LINES)
    assert rows(registry.corrected_codes(lines, reg, "id"), "id", "better") == [(1, "65.02"), (3, "65.02")]
    damaged = spark.createDataFrame([(1, "expense", "65", None), (2, "expense", "66.02.00", None), (3, "expense", "70", None)], LINES)
    assert rows(registry.completed_codes(damaged, reg, "id"), "id", "completed") == [(1, "65.02"), (2, "66.02")]
    years = spark.createDataFrame([(2022,), (2024,)], "effective_year int")
    wanted = spark.createDataFrame([(2021,), (2023,), (2025,)], "year int")
    assert rows(registry.snapshot_of(years, wanted), "wanted_year", "effective_year") == [(2021, 2022), (2023, 2022), (2025, 2024)]


CELLS = "doc string, page int, row int, col int, cell string"


def grid(spark, text, doc="d", page=1):
    return [(doc, page, r, c, cell.strip()) for r, line in enumerate(text.strip().split("\n")) for c, cell in enumerate(line.split("|"))]


def test_annex_entries(spark):
    cells = spark.createDataFrame(grid(spark, "Anexa||\nDenumire|Cod|x\nImpozit pe venit|03.02|\nfără cod||\ndouă|04.02|05.02"), CELLS)
    assert rows(registry.annex_entries(cells, "doc"), "code", "official") == [("03.02", "Impozit pe venit")]


def test_code_helpers(spark):
    one = spark.createDataFrame([("65.02/20.01", "6S.O2", ["65", "65.02.03", "65.02"]), ("65.02.20.01", "x", []), (None, None, None)], "s string, o string, m array<string>")
    got = one.select(C.slash_codes(F.col("s"), ("20",)).alias("s"), C.ocr_code(F.col("o")).alias("o"), C.most_specific(F.col("m")).alias("m"), C.resuffixed(F.col("s"), "10").alias("r")).collect()
    assert [(r.s.functional, r.s.economic, r.o, r.m) for r in got[:2]] == [("65.02", "20.01", "65.02", "65.02.03"), ("65.02", "20.01", None, None)]
    assert got[1].r == "65.10.20.01" and got[2].o is None


def test_text_scores_and_meanings(spark):
    assert T.weighted_ratio("buget local", "buget local") == 100 and T.weighted_ratio("", "a") == 0
    assert T.weighted_ratio("buget", "proiect de buget local al orasului pentru anul viitor") >= 54 and T.sequence_ratio("abcd", "bcde") == 75.0
    df = spark.createDataFrame([("S.C. Apa Canal", "SC Apă-Canal SA"), ("Primăria Zăvgoveni", "Orașul Zăvgoveni"), ("", "x"), ("a b", "c d")], "a string, b string")
    got = [r[0] for r in df.select(T.means_the_same(F.col("a"), F.col("b"), {"primaria": "orasul"}, ("sa", "de"))).collect()]
    assert got[:3] == [True, True, False] and got[3] is False


def test_staged_and_fuzzy_matches(spark):
    a = spark.createDataFrame([(1, "x", "n1"), (2, "x", "n2"), (3, "y", "n3"), (4, None, "n4")], "l long, code string, name string")
    b = spark.createDataFrame([(11, "y", "zz"), (12, "x", "n2"), (13, None, "n4"), (14, None, "n4")], "r long, code string, name string")
    assert rows(matching.staged(a, b, "l", "r", [(["code"], "code"), (["name"], "name")]), "l", "r", "stage") == [(2, 12, "name"), (3, 11, "code")]
    left = spark.createDataFrame([(1, "p", "Reabilitare străzi centrale"), (2, "p", "Modernizare iluminat public"), (3, "q", "Modernizare iluminat public")], "l long, block string, name string")
    right = spark.createDataFrame([(7, "p", "Reabilitare strazi centrale"), (8, "p", "Modernizare iluminat publlc"), (9, "p", "Modernizare iluminat publlc")], "r long, block string, name string")
    assert rows(matching.fuzzy_unique(left, right, "l", "r", ["block"], "name"), "l", "r") == [(1, 7)]


def test_sums_are_consumed(spark):
    wholes = spark.createDataFrame([("k", 10, 1), ("k", 10, 2), ("k", 99, 3)], "k string, v long, w long")
    parts = spark.createDataFrame([("k", 4, 1), ("k", 6, 2), ("k", 7, 3), ("z", 6, 4)], "k string, v long, p long")
    assert rows(matching.consumed_sums(wholes, parts, "k", "v", "w", "p"), "w", "a", "b") == [(1, 1, 2)]


def test_change_sets(spark):
    cell = "r long, c string, v long"
    df = lambda *x: spark.createDataFrame(list(x), cell)
    base = df((1, "a", 1), (1, "b", 2), (2, "a", 3), (3, "a", 4))
    none = df().limit(0)
    got = matching.changed(base, ["r"], "c", "v", spark.createDataFrame([(3,)], "r long"), df((2, "x", 9)), df((1, "b", None)), df((1, "c", 5)))
    assert rows(got, "r", "c", "v", "method") == [(1, "a", 1, "read"), (1, "b", None, "correction"), (1, "c", 5, "addition"), (2, "x", 9, "override")]
    for corrections, additions in ((df((9, "a", 1)), none), (none, df((1, "a", 1))), (df((1, "a", 1), (1, "a", 2)), none)):
        with pytest.raises(matching.ConflictError):
            matching.changed(base, ["r"], "c", "v", spark.createDataFrame([], "r long"), none, corrections, additions)


def test_weighted_alignment_keeps_order(spark):
    row = "k string, at int, t array<string>"
    a = spark.createDataFrame([("d", 0, ["x", "y"]), ("d", 1, ["p", "q", "r"]), ("d", 2, ["z"]), ("d", 3, None)], row)
    b = spark.createDataFrame([("d", 0, ["p", "q"]), ("d", 1, ["x"]), ("d", 2, ["z", "w"])], row)
    assert rows(grids.weighted_alignment(a, b, "k", "at", "t"), "left_at", "right_at", "weight") == [(1, 0, 2), (2, 2, 1)]


def test_reports(spark):
    text = "Raport LA DATA: 30-JUN-26||\nCod indicator|Denumire|Incasari\n03.02|Impozit|1.000,50\n04.02|Cote|200\n|TOTAL|1.200,50"
    cells = spark.createDataFrame(grid(spark, text), CELLS)
    lines, totals = execution.report_lines(cells, {"code": "^cod", "name": "^denumire", "paid": "^incasari"}, "doc", ["paid"])
    assert rows(lines, "code", "paid") == [("03.02", D("1000.500000")), ("04.02", D("200.000000"))]
    assert execution.control_breaches(lines, totals, ["doc"], "paid").count() == 0
    assert rows(execution.control_breaches(lines.where("code = '03.02'"), totals, ["doc"], "paid"), "doc") == [("d",)]
    days = spark.createDataFrame([("LA DATA: 30-JUN-26",), ("la 1-feb-2025",), ("x",), (None,)], "t string").select(execution.report_date(F.col("t")).alias("d"))
    assert [r.d for r in days.collect()] == [date(2026, 6, 30), date(2025, 2, 1), None, None]


def test_reading_again_keeps_what_is_unchanged(spark):
    rec = "k string, h string, v long, verified boolean"
    held = spark.createDataFrame([("a", "1", 1, True), ("b", "1", 2, True), ("c", "1", 3, True)], rec)
    fresh = spark.createDataFrame([("a", "1", 9, False), ("b", "2", 8, False), ("d", "1", 7, False)], rec)
    assert rows(execution.to_ingest(fresh, held, "k", "h"), "k", "change") == [("b", "changed"), ("d", "new")]
    assert rows(execution.merged_records(held, fresh, "k", "h", ["v", "verified"]), "k", "v", "verified") == [("a", 1, True), ("b", 8, False), ("c", 3, True), ("d", 7, False)]
    q = spark.createDataFrame([("data/q1/a-q1.xlsx", "q1"), ("data/q2/b.xlsx", "q2")], "path string, q string")
    assert rows(execution.scaffold(q, "path", "q", "q1", "q2"), "path", "q") == [("data/q2/a-q2.xlsx", "q2")]


def test_repairs_need_proof(spark):
    cells = spark.createDataFrame([("a", "g", 10, 40), ("b", "g", 38, 40), ("a", "h", 5, 9), ("b", "h", 3, 9)], "k string, g string, v long, t long")
    peers = spark.createDataFrame([("b", "g", 30), ("b", "h", 7)], "k string, g string, v long")
    assert rows(repairs.proven_cells(cells, peers, ["k", "g"], ["g"], "v", "t"), "k", "g", "old", "new") == [("b", "g", 38, 30)]
    again = spark.createDataFrame([("s", 1, 10, 20, None), ("s", 2, 10, 20, 30), ("s", 3, 10, 99, 31), ("t", 1, 1, None, None), ("t", 2, 1, 2, 3)], "k string, page int, x long, y long, z long")
    assert rows(repairs.repeated_cells(again, ["k"], "page", ["x", "y", "z"]), "k", "page", "column", "new") == [("s", 1, "z", 30)]
    issues = spark.createDataFrame([("sum", "error"), ("note", "info"), ("repair", "warning")], "check string, severity string")
    fresh = spark.createDataFrame([("name", "warning")], "check string, severity string")
    assert rows(repairs.revalidated(issues, fresh), "check") == [("name",), ("note",), ("repair",)]
    log = repairs.repair_log(spark.createDataFrame([(1, 38, 30)], "id long, old long, new long"), ["id"], "sum")
    assert rows(log, "check", "note") == [("repair", "sum 38 -> 30")]


def test_gates_and_groups(spark):
    r = spark.createDataFrame([("a", 5, 2, 8, 1), ("a", 3, 2, 8, 1), ("b", 5, 2, 5, 1), ("b", None, 2, 5, 1), ("c", 5, 1, 9, 1)], "j string, v long, n int, t long, c int")
    assert rows(repairs.accepted_readings(r, ["j"], "v", "n", "t", "c"), "j", "reason") == [("a", "closes"), ("b", "incomplete"), ("c", "sum")]
    cand = spark.createDataFrame([("d", "65", 90.0), ("d", "66", 90.0), ("d", "67", 10.0), ("d", "70", 95.0)], "d string, code string, score double")
    reg = spark.createDataFrame([("65",), ("66",), ("67",)], "code string")
    have = spark.createDataFrame([("d", "66")], "d string, code string")
    assert rows(repairs.gated_codes(cand, reg, have, ["d"], "code", "score"), "code") == [("65",)]
    e = spark.createDataFrame([("d", "01", D(30)), ("d", "10", D(10)), ("d", "20", None), ("x", "01", D(5)), ("y", "01", D(5)), ("y", "10", D(5))], "d string, code string, v decimal(18,2)")
    assert rows(repairs.economic_groups(e, ["d"], "v", "01", ["10", "20"]), "d", "difference") == [("d", D("20.00"))]


def test_manifests(spark):
    m = spark.createDataFrame([(1, "Alba", "10", "p1", "converted", "e"), (2, "ALBA", "11", "p2", None, None)], "ord long, name string, siruta string, path string, status string, error string")
    q = spark.createDataFrame([("alba",), ("11",), ("zz",)], "question string")
    assert rows(manifest.found(m, q, "name", "siruta", "ord"), "question", "ord") == [("11", 2), ("alba", 1), ("zz", None)]
    fresh = spark.createDataFrame([("p2", "converted", None), ("p3", "failed", "boom")], "path string, status string, error string")
    assert rows(manifest.upserted(m.select("path", "status", "error"), fresh, "path", ["status", "error"]), "path", "status", "error") == [("p1", "converted", "e"), ("p2", "converted", None), ("p3", "failed", "boom")]
    files = spark.createDataFrame([("p1",), ("x/other.pdf",)], "path string")
    assert rows(manifest.identity_of(files, m.select("path", F.col("name").alias("title"), "siruta"), "path", ["title", "siruta"]), "title", "siruta", "in_manifest") == [("Alba", "10", True), ("other", None, False)]
    done = spark.createDataFrame([("a", "h", 2, "r2"), ("a", "h", 1, "r1"), ("b", "old", 1, "r")], "k string, h string, at int, r string")
    assert rows(manifest.valid_results(done, ["k"], "h", "h", "at"), "k", "r") == [("a", "r2")]
    failed = spark.createDataFrame([("a", 1, "m"), ("c", 1, "m"), ("c", 2, "n")], "k string, at int, message string")
    assert rows(manifest.open_failures(done, failed, ["k"], "at"), "k", "message") == [("c", "n")]
    units = spark.createDataFrame([(1, "part", None), (2, "full", 50.0), (3, "full", 10.0), (4, "part", 5.0)], "id long, scope string, rate double")
    assert [r.id for r in manifest.queue(units, "scope", "rate", ["id"]).collect()] == [3, 2, 4, 1]


def test_assembly_resets_at_titles_and_gaps(spark):
    lines = spark.createDataFrame(
        [("d", 1, 1, "T1", "FUNCTIONARE", "r", None), ("d", 2, 1, None, None, None, "School"), ("d", 3, 2, None, "DEZVOLTARE", None, None), ("d", 4, 5, None, None, None, None), ("d", 5, 5, "T2", None, "s", None), ("d", 6, 6, None, None, None, None)],
        "doc string, ord int, page int, title string, section string, region string, institution string",
    )
    got = assembly.assembled(lines, "doc", ["ord"], "page", F.col("section"), F.col("region"), F.col("institution"), F.col("title"))
    assert rows(got, "ord", "section_at", "region_at", "institution_at") == [(1, "FUNCTIONARE", "r", None), (2, None, None, "School"), (3, "DEZVOLTARE", None, "School"), (4, None, None, None), (5, None, "s", None), (6, None, "s", None)]


def test_learned_prior_and_orientation(spark):
    p = spark.createDataFrame([("d", i, i != 6, 10.0) for i in range(1, 20)], "d string, page int, up boolean, score double")
    trusted = {r.page for r in assembly.learned_prior(p, ["d"], "page", F.col("up"), "score").where("trusted").collect()}
    assert trusted == {4, 5, 6, 10, 11, 12, 13, 14, 16, 17, 18, 19}
    w = spark.createDataFrame([(1, 0, "abcd", 0.5), (1, 90, "abcd", 0.55), (2, 0, "ab", 0.1), (2, 90, "abcdef", 0.9)], "page int, turn int, text string, conf double")
    assert rows(assembly.orientation(w, ["page"], "turn", "text", "conf", usual=0), "page", "turn") == [(1, 0), (2, 90)]


def test_digital_and_coordinate_grids(spark):
    words = spark.createDataFrame([(1, 5.0, 9.0, 10.0, "a"), (1, 12.0, 18.0, 10.5, "b"), (1, 55.0, 60.0, 10.2, "c"), (1, 6.0, 8.0, 30.0, "d"), (1, 300.0, 310.0, 30.0, "out")], "page int, x0 double, x1 double, top double, text string")
    rules = spark.createDataFrame([(1, 0.0), (1, 50.0), (1, 52.0), (1, 100.0)], "page int, x double")
    assert rows(pages.column_spans(rules, ["page"], "x"), "col", "low", "high") == [(0, 0.0, 50.0), (1, 50.0, 100.0)]
    assert rows(pages.digital_grid(words, rules, ["page"]), "row", "col", "cell") == [(0, 0, "a b"), (0, 1, "c"), (1, 0, "d")]
    tokens = spark.createDataFrame([(1, 10, 1.0, "x"), (1, 52, 1.2, "y"), (1, 11, 9.0, "z"), (1, 90, 9.0, "far")], "page int, x long, y double, text string")
    centres = spark.createDataFrame([("name", 10), ("total", 50)], "column string, at long")
    assert rows(pages.coordinate_cells(tokens, centres, ["page"], 5, 2.0), "row", "column", "cell") == [(0, "name", "x"), (0, "total", "y"), (1, "name", "z")]
    told = spark.createDataFrame([(1, 1, "65", 10.0, 12.0), (1, 2, "66", 20.0, 22.0), (1, 3, "70", 30.0, 32.0)], "page int, row int, code string, top double, bottom double")
    assert rows(pages.code_band(told, spark.createDataFrame([("65",), ("66",)], "code string"), ["page"], "code", "top", "bottom"), "low", "high") == [(10.0, 22.0)]
    assert rows(pages.row_bands(told, ["page"], "row", "top", "bottom", F.lit(100.0)), "row", "from_share")[0] == (1, 0.1)


def test_page_scores(spark):
    p = spark.createDataFrame([(0.9, 1.0, 1.0, False), (0.9, 1.0, 1.0, True), (None, 2.0, None, False)], "c double, i double, h double, u boolean")
    assert [r[0] for r in p.select(pages.structural_score(F.col("c"), F.col("i"), F.col("h"), F.col("u"))).collect()] == [0.93, 0.6975, 0.2]
    t = spark.createDataFrame([("matrix 12",), ("plain",), (None,)], "t string")
    assert [r[0] for r in t.select(pages.first_rule([("matrix", F.col("t").contains("matrix")), ("plain", F.col("t") == "plain")], "unknown")).collect()] == ["matrix", "plain", "unknown"]
    n = spark.createDataFrame([(10, 1, 0.9, "table"), (0, 0, 0.9, "table"), (10, 9, 0.9, "table"), (10, 0, 0.9, "unknown"), (None, None, None, None)], "c int, u int, s double, l string")
    assert [r[0] for r in n.select(pages.needs_another_reading(F.col("c"), F.col("u"), F.col("s"), F.coalesce("l", F.lit("unknown")))).collect()] == [False, True, True, True, True]
    q = spark.createDataFrame([(95.0, 0), (95.0, 1), (75.0, 0), (10.0, 0), (None, 0)], "s double, p int")
    assert [r[0] for r in q.select(pages.quality_label(F.col("s"), F.col("p"))).collect()] == ["high", "medium", "medium", "low", "low"]


HEADED = "Denumire indicatori|Cod indicator|Total 2026|Trim I|Trim II\nImpozit pe venit|03.02|1.000,00|600,00|400,00\nCote|04.02|20|10|10"


def test_mappers(spark):
    cells = spark.createDataFrame(grid(spark, HEADED, page=1) + grid(spark, "Taxe|16.02|7|3|4", page=2) + grid(spark, "Alte|36.02|5|5|0", page=9) + grid(spark, "a|b", page=11), CELLS)
    assert {(r.page, r.basis) for r in mappers.roles_of(cells, "doc").collect()} == {(1, "header"), (2, "inherited"), (9, "position")}
    facts = {(r.page, r.code, r.column_name): r.value for r in mappers.table(cells, "doc").collect()}
    assert facts[1, "03.02", "trim1"] == 600 and facts[2, "16.02", "trim2"] == 4 and facts[9, "36.02", "total"] == 5 and len(facts) == 12
    turned = "\n".join("|".join(x) for x in zip(*(line.split("|") for line in HEADED.split("\n")), strict=True))
    assert {(r.code, r.column_name): r.value for r in mappers.transposed(spark.createDataFrame(grid(spark, turned), CELLS), "doc").collect()}["03.02", "trim1"] == 600
    square = "Indicator|Cod|65.02|66.02\nCheltuieli de personal|10|5|6\nBunuri|20|7|8"
    assert rows(mappers.matrix(spark.createDataFrame(grid(spark, square), CELLS), "doc"), "code", "func_code", "value")[0] == ("10", "65.02", D("5.000000"))
    square = "Indicator|Cod|65.02|66.02\nCheltuieli de personal|10.01|5|6\nBunuri|20.01|7|8"
    assert rows(mappers.matrix(spark.createDataFrame(grid(spark, square), CELLS), "doc"), "code", "func_code", "value") == [("10.01", "65.02", D("5.000000")), ("10.01", "66.02", D("6.000000")), ("20.01", "65.02", D("7.000000")), ("20.01", "66.02", D("8.000000"))]
    many = "Venituri|03.02 04.02|1.000,00 2,50\nrest|05.02 06.02|1,00"
    assert rows(mappers.stacked(spark.createDataFrame(grid(spark, many), CELLS), "doc"), "code", "value") == [("03.02", D("1000.000000")), ("04.02", D("2.500000"))]
    brief = "Venituri totale|x|1.200,00\nCheltuieli totale||1.100,00"
    assert rows(mappers.summary(spark.createDataFrame(grid(spark, brief), CELLS), "doc"), "name", "value") == [("Cheltuieli totale", D("1100.000000")), ("Venituri totale", D("1200.000000"))]
    layouts = spark.createDataFrame([("d", "table"), ("e", "other")], "doc string, layout string")
    assert mappers.mapped(cells, layouts, "doc").count() == 12


def test_index_rows_and_wrapped_rows(spark):
    cells = spark.createDataFrame(grid(spark, "x|y|z\n1|2|3\nImpozit|03.02|5"), CELLS)
    assert rows(mappers.index_roles(cells, "doc", ("name", "code", "total")), "col", "role") == [(0, "name"), (1, "code"), (2, "total")]
    wrapped = spark.createDataFrame(grid(spark, "Impozit pe||\n|03.02|5\nCote|04.02|6"), CELLS)
    assert rows(grids.wrapped_merged(wrapped, "doc").where("cell != ''"), "row", "col", "cell") == [(0, 0, "Impozit pe"), (0, 1, "03.02"), (0, 2, "5"), (2, 0, "Cote"), (2, 1, "04.02"), (2, 2, "6")]


def test_within_edits_equals_all_pairs(spark):
    import random

    rng = random.Random(2)
    names = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(0, 7))) for _ in range(60)})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    for edits in (1, 2):
        want = {(a, b) for a in names for b in names if a < b and distance(a, b) <= edits}
        got = joins.within_edits(spark.createDataFrame([(n,) for n in [*names, *names, None]], "n string"), "n", edits)
        assert {(r.a, r.b) for r in got.collect()} == want
