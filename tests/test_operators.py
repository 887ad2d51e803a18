import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import aggregates as A
from ledgerloom.operators import crossperiod as X
from ledgerloom.operators import graph, grids, joins, planner, rules
from ledgerloom.operators import windows as WN


def test_rank_keeps_excluded_rows_and_ties(spark):
    rows = [("a", 10, True), ("b", 20, True), ("c", 20, True), ("d", 99, False), ("e", None, True)]
    df = spark.createDataFrame(rows, "name string, v int, ok boolean")
    got = {r.name: (r.rank, r.cohort) for r in WN.rank_cohort(df, [], "v", F.col("ok")).collect()}
    assert got == {"a": (3, 3), "b": (1, 3), "c": (1, 3), "d": (None, None), "e": (None, None)}


def test_rank_is_one_plus_greater(spark):
    random.seed(3)
    rows = [(i, random.randrange(9), random.random() < 0.7) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, v int, ok boolean")
    for r in WN.rank_cohort(df, [], "v", F.col("ok")).collect():
        assert r.rank == (1 + sum(v > r.v for _, v, ok in rows if ok) if r.ok else None)


def test_previous_eligible_skips_years(spark):
    df = spark.createDataFrame([("a", 1, 5, True), ("a", 2, 6, False), ("a", 4, 7, True), ("b", 1, None, True)], "k string, y int, v int, ok boolean")
    got = {(r.k, r.y): (r.previous, r.previous_y) for r in WN.previous_eligible(df, ["k"], "y", "v", F.col("ok")).collect()}
    assert got == {("a", 1): (None, None), ("a", 2): (5, 1), ("a", 4): (5, 1), ("b", 1): (None, None)}


def test_first_wins_whatever_the_order(spark):
    rows = [("k", 2, "x"), ("k", 1, "y"), (None, 3, "z"), (None, 3, "a"), ("k", 1, "b")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, ord int, v string")
        assert {tuple(r) for r in WN.first_wins(df, ["k"], ["ord"]).collect()} == {("k", 1, "b"), (None, 3, "a")}


def test_islands_and_ranges(spark):
    df = spark.createDataFrame([("a", p) for p in (1, 2, 3, 7, 7, 9, 10)] + [("b", None)], "k string, p int")
    assert [r.spec for r in WN.compact_ranges(WN.islands(df, ["k"], "p"), ["k"]).collect()] == ["1-3,7,9-10"]


@pytest.mark.parametrize(("spec", "pages"), [("1-3", [1, 2, 3]), ("2,9", [2]), ("4-", [4, 5]), ("2,2-3", [2, 3]), ("", []), ("0-1", [1])])
def test_page_spec(spark, spec, pages):
    df = spark.createDataFrame([(spec,)], "s string")
    assert sorted(r.page for r in WN.page_spec(df, "s", F.lit(5)).collect()) == pages


def test_spread_sample(spark):
    df = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 1)], "k string, i int")
    got = sorted((r.k, r.i) for r in WN.spread_sample(df, ["k"], ["i"], 5).collect())
    assert got == [("a", 0), ("a", 2), ("a", 4), ("a", 6), ("a", 8), ("b", 1)]


def test_fallback_lookup(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y"), (4, None, None)], "id int, k string, alt string")
    registry = spark.createDataFrame([("a", "A"), ("x", "X")], "code string, label string")
    got = {r.id: (r.attempt, r.label) for r in joins.fallback_lookup(rows, registry, "code", [F.col("k"), F.col("alt")], "id").collect()}
    assert got == {1: (1, "A"), 2: (2, "X"), 3: (None, None), 4: (None, None)}


def test_merge_prefers_left(spark):
    left = spark.createDataFrame([("a", 1, None), (None, 5, 5)], "k string, v int, w int")
    right = spark.createDataFrame([("a", 2, 3), ("b", 4, 4), (None, 6, 5)], "k string, v int, w int")
    got = {r.k: (r.v, r.w, r.filled, r.conflicts) for r in joins.merge_preferring_left(left, right, ["k"], ["v", "w"]).collect()}
    assert got == {"a": (1, 3, 1, 1), "b": (4, 4, 2, 0), None: (5, 5, 0, 1)}


def test_range_join_equals_nested_loop(spark):
    random.seed(1)
    points = [(i, random.uniform(0, 100)) for i in range(80)]
    ranges = [(f"r{i}", lo, lo + random.uniform(0, 40)) for i, lo in enumerate(random.uniform(0, 90) for _ in range(25))] + [("empty", 5.0, 5.0)]
    got = {(r.i, r.name) for r in joins.range_join(spark.createDataFrame(points, "i int, x double"), "x", spark.createDataFrame(ranges, "name string, lo double, hi double"), "lo", "hi", 7.5).collect()}
    assert got == {(i, n) for i, x in points for n, lo, hi in ranges if lo <= x < hi}


def test_nearest_center_equals_search(spark):
    random.seed(2)
    centers = [(f"c{i}", random.randrange(100)) for i in range(9)]
    points = [(i, i) for i in range(-5, 110)] + [(999, None)]
    got = {r.i: r.name for r in joins.nearest_center(spark.createDataFrame(points, "i int, x int"), "x", spark.createDataFrame(centers, "name string, at int"), "at", "name", 6).collect()}
    for i, x in points:
        near = sorted((abs(x - at), at, n) for n, at in centers) if x is not None else []
        assert got[i] == (near[0][2] if near and near[0][0] <= 6 else None)


def test_one_to_one_counts_multisets(spark):
    a = spark.createDataFrame([("k", 1)] * 3 + [("m", 1)], "k string, o int")
    b = spark.createDataFrame([("k", 1)] * 2 + [("n", 1)], "k string, o int")
    got = sorted((r.k, r.expected, r.predicted) for r in joins.one_to_one(a, b, ["k"], ["o"]).collect())
    assert got == [("k", True, False), ("k", True, True), ("k", True, True), ("m", True, False), ("n", False, True)]


def test_best_of_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 5, 2), ("a", 5, 1), ("a", None, 0), ("b", None, 1)], "k string, v int, o int")
    assert [tuple(r) for r in A.best_of(df, ["k"], "v", ["o"]).collect()] == [("a", 5, 1)]


def test_hierarchy_and_identity(spark):
    parents = spark.createDataFrame([("a", Decimal("10.00")), ("b", Decimal("10.00")), ("c", Decimal("5.00")), ("d", None)], "k string, parent_value decimal(18,2)")
    children = spark.createDataFrame([("a", Decimal("4.00")), ("a", Decimal("6.00")), ("b", Decimal("4.00")), ("b", None), ("c", Decimal("0.00"))], "k string, child_value decimal(18,2)")
    assert [(r.k, r.difference) for r in rules.hierarchy(parents, children, ["k"]).collect()] == [("b", Decimal("6.00"))]
    values = spark.createDataFrame([("g", c, Decimal(v)) for c, v in (("T", 10), ("A", 7), ("B", 3))] + [("h", "T", Decimal(1)), ("h", "A", Decimal(1))], "g string, code string, value decimal(18,2)")
    terms = spark.createDataFrame([("i", "T", 1, True), ("i", "A", 1, False), ("i", "B", 1, False)], "identity string, code string, coeff int, is_target boolean")
    assert [(r.g, r.holds) for r in rules.identities(values, terms, ["g"]).collect()] == [("g", True)]


def test_duplicates_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 1, 5), ("a", 2, 5), ("b", 1, None), ("b", 2, 3)], "k string, o int, v int")
    assert {(r.k, r.rows, r.different) for r in rules.conflicting_duplicates(df, ["k"], ["o"], ["v"]).collect()} == {(None, 2, 1), ("b", 2, 1)}


def test_missing_part(spark):
    parts = spark.createDataFrame([("a", "x", Decimal(3)), ("b", "x", Decimal(3)), ("b", "y", Decimal(4)), ("c", "x", Decimal(9))], "k string, p string, v decimal(18,2)")
    wholes = spark.createDataFrame([("a", Decimal(9)), ("b", Decimal(9)), ("c", Decimal(9))], "k string, t decimal(18,2)")
    assert [(r.k, r.missing, int(r.residual)) for r in rules.residual_of_missing(parts, wholes, ["k"], "p", "v", "t", ["x", "y"]).collect()] == [("a", "y", 6)]


def test_suspects(spark):
    base = [("c", f"l{i}", 100.0 + i, (100.0 + i) * 1.1) for i in range(25)]
    keep = lambda rows: (spark.createDataFrame([(c, k, o) for c, k, o, _ in rows], "city string, line string, v double"), spark.createDataFrame([(c, k, n) for c, k, _, n in rows], "city string, line string, v double"))
    old, new = keep(base)
    pairs = X.matched(old, new, ["city", "line"], "v")
    assert X.suspects(pairs, "city").count() == 0 and X.suspects(X.matched(*keep(base[:5]), ["city", "line"], "v"), "city").count() == 0
    shifted = [(c, k, o, n * 1000 if k == "l3" else n) for c, k, o, n in base]
    told = X.suspects(X.matched(*keep(shifted), ["city", "line"], "v"), "city").collect()
    assert [(r.line, r.signature) for r in told] == [("l3", "decimal_shift")]
    all_shifted = [(c, k, o, o * 1000) for c, k, o, _ in base]
    whole = X.matched(*keep(all_shifted), ["city", "line"], "v")
    assert X.suspects(whole, "city").count() == 0 and X.summary(whole, "city").first().unit_shift == 1000


def test_greedy_equals_loop(spark):
    random.seed(5)
    rows = [(g, i, round(random.uniform(0.5, 9), 2)) for g in "ab" for i in range(40)] + [("a", 99, None)]
    df = spark.createDataFrame(rows, "g string, id int, cost double")
    got = {g: [r.id for r in planner.greedy_plan(df, "g", [F.col("id").alias("o")], "cost", 20.0, 7, "id").where(F.col("g") == g).orderBy("place").collect()] for g in "ab"}
    for g in "ab":
        spent, used, keys = 0.0, 0, []
        for _, i, c in (r for r in rows if r[0] == g):
            if c is not None and c <= 20 and spent + c <= 20 and used < 7:
                spent, used = spent + c, used + 1
                keys.append(i)
        assert got[g] == keys


def test_greedy_refuses_unbounded_groups(spark):
    with pytest.raises(ValueError):
        planner.greedy_plan(spark.range(30).withColumn("g", F.lit(1)).withColumn("c", F.lit(1.0)), "g", [F.col("id").alias("o")], "c", 5.0, 2, "id", most=10)


def test_graph_potentials(spark):
    edges = spark.createDataFrame([("a", "b", 3.0), ("b", "c", -1.0), ("x", "y", 2.0), (None, "z", 1.0)], "a string, b string, shift double")
    got = {r.node: (r.root, r.potential) for r in graph.propagate(edges).collect()}
    assert got == {"a": ("a", 0.0), "b": ("a", 3.0), "c": ("a", 2.0), "x": ("x", 0.0), "y": ("x", 2.0)}
    assert graph.propagate(edges.limit(0)).count() == 0


def test_grid_of_text(spark):
    text = "Denumire indicator | Cod | Total | Trim I\n| Taxe | 16.02.06 | 1.234,50 | x |\nPlăți | 74/02/09 | 65.151,41 |  \nproză fără celule\n"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string")
    cells = grids.cells_of_text(df, "doc_id", "text")
    got = {(r.code, r.column_name): (r.kind, r.value) for r in grids.grid_facts(cells, "doc_id").collect()}
    assert got[("16.02.06", "total")] == ("number", Decimal("1234.500000")) and got[("16.02.06", "trim1")][0] == "x"
    assert got[("74.02.09", "total")][1] == Decimal("65151.410000")


def test_mean_clusters_and_alignment(spark):
    df = spark.createDataFrame([(1, y) for y in (0.0, 0.6, 1.2, 1.8, 2.4)] + [(2, None)], "g int, y double")
    assert [r.cluster for r in grids.mean_clusters(df, ["g"], "y", 1.0).orderBy("y").collect()] == [0, 0, 0, 1, 1]
    left = spark.createDataFrame([(1, i, c) for i, c in enumerate("abcd")], "k int, at int, label string")
    right = spark.createDataFrame([(1, i, c) for i, c in enumerate("xbdc")], "k int, at int, label string")
    assert len(grids.aligned(left, right, "k", "at", "label").collect()) == 2


def test_zipped_streams_refuse_unequal(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [1, 2]), (2, ["a"], [1, 2])], "i int, n array<string>, v array<int>")
    assert [(r.i, r.n, r.v) for r in grids.zipped_streams(df, ["i"], {"n": F.col("n"), "v": F.col("v")}).collect()] == [(1, "a", 1), (1, "b", 2)]


def test_split_rows_are_joined_to_the_row_before(spark):
    rows = [(1, 0, 0, "Taxe"), (1, 0, 1, ""), (1, 1, 0, ""), (1, 1, 1, "12,5"), (1, 2, 0, "Sold"), (1, 2, 1, "3"), (1, 4, 1, "9")]
    df = spark.createDataFrame(rows, "g int, row int, col int, cell string")
    assert [(r.row, r.joined_to) for r in grids.split_rows_stitched(df, "g").collect()] == [(1, 0)]


def test_component_sums_and_witnesses(spark):
    df = spark.createDataFrame([("k", 5, "a"), ("k", 2, "b"), ("k", 3, "c"), ("k", 4, "d"), ("m", 2, "e"), ("m", 1, "f"), (None, 2, "g")], "k string, v int, o string")
    assert [tuple(r) for r in joins.component_sums(df, df, "k", "v", "o").collect()] == [("k", 5, 2, 3)]
    one = spark.createDataFrame([("x", 10.0), ("y", 5.0), ("z", None)], "k string, v double")
    two = spark.createDataFrame([("x", 10.04), ("y", 5.2)], "k string, v double")
    assert {r.k: (r.sources, r.agree) for r in joins.witnesses({"a": one, "b": two}, ["k"], "v", 0.05).collect()} == {"x": (2, True), "y": (2, False)}


def test_gates_and_bands(spark):
    df = spark.createDataFrame([("a", 50.0, 100.0), ("a", 45.0, 100.0), ("b", 10.0, 100.0), ("c", 1.0, 0.0)], "k string, part double, total double")
    assert [r.k for r in A.gated(df, ["k"], "part", "total").collect()] == ["a"]
    shares = spark.createDataFrame([("a", 50.0), ("a", 200.0), ("b", 50.0), ("c", None)], "k string, share double")
    assert sorted((r.k, r.share, r.incomplete) for r in A.all_or_nothing(shares, ["k"], "share", 2, 130).where("k != 'c'").collect()) == [("a", None, True), ("a", None, True), ("b", 50.0, False)]
    steps = A.de_cumulated(spark.createDataFrame([("a", 1, 5), ("a", 2, 9)], "k string, q int, v int"), ["k"], "q", "v")
    assert [r.step for r in steps.orderBy("q").collect()] == [5, 4]
    assert [tuple(r) for r in A.modal(spark.createDataFrame([("a", 1), ("a", 2), ("a", None)], "k string, v int"), ["k"], ["v"]).collect()] == [("a", 2, 1)]


def test_agreeing_pairs_tells_all_pairs(spark, smallest):
    rows = [(1, 10, 1, 5.0, 1), (1, 20, 2, 6.0, 2), (1, 30, 2, 6.0, 2), (1, 30, 2, 6.0, 2), (1, 40, None, 6.0, None), (2, 20, 2, 6.0, 2), (1, 50, None, 7.0, None)]
    df = spark.createDataFrame(rows, "k int, part int, a int, b double, c int")
    got = sorted(tuple(r) for r in joins.agreeing_pairs(df, ["k"], ["a", "b", "c"], "part").collect())
    # Neither pair is with the key's first row; nulls agree with nothing; a repeated row is told twice.
    assert got == [(1, 20, 30, 3), (1, 20, 30, 3)]


def test_repeat_agreement_pairs_are_those_of_every_line_with_every_other(spark, smallest):
    from itertools import combinations

    from ledgerloom.plans.join_queries import repeat_agreement_pairs
    from ledgerloom.session import table

    groups = {}
    for r in table(spark, smallest, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax").collect():
        groups.setdefault(tuple(r)[:2], []).append(tuple(r)[2:])
    expected = []
    for key, lines in groups.items():
        for x, y in combinations(sorted(lines), 2):
            equal = sum(a == b for a, b in zip(x[1:], y[1:], strict=True))
            if x[0] != y[0] and equal >= 2:
                expected.append((*key, x[0], y[0], equal))
    assert len(expected) == 53
    assert sorted(tuple(r) for r in repeat_agreement_pairs(spark, smallest).collect()) == sorted(expected)
