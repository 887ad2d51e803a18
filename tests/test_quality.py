"""The general data-quality operators on small planted cases, with nulls, ties, repeats, empty and widened tables."""

import json
import random
from datetime import datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import diff, drift, spikes, units

T0 = datetime(2025, 1, 1)
RECORDS = "record_id long, feed string, file_name string, file_kind string, written_at timestamp, payload string, label string, text string"


def records(spark, files, kind="lines", feed="f"):
    rows = []
    for day, payloads in enumerate(files):
        for p in payloads:
            rows.append((len(rows), feed, f"{feed}_{day}", kind, T0 + timedelta(days=day), p if isinstance(p, (str, type(None))) else json.dumps(p), "x", "y"))
    return spark.createDataFrame(rows, RECORDS)


def told(df):
    return sorted((r.file_name, r.change, r.old_field, r.new_field) for r in drift.changes(df).collect())


def test_drift_tells_each_kind_of_change(spark):
    base = [{"row_no": i, "name": f"n{i}", "page": i * 7, "values": {"total": i + 0.5, "trim1": i}} for i in range(6)]
    renamed = [{"row_no": i, "title": f"n{i}", "page": str(i * 7), "values": {"total": i + 0.5, "t1": i}} for i in range(6)]
    fewer = [{"row_no": i, "title": f"n{i}", "page": str(i * 7), "values": {"total": i + 0.5}, "extra": [1]} for i in range(6)]
    assert told(records(spark, [base, renamed, fewer])) == [
        ("f_1", "renamed", "name", "title"), ("f_1", "renamed", "values.trim1", "values.t1"), ("f_1", "type_changed", "page", "page"),
        ("f_2", "added", "", "extra"), ("f_2", "removed", "values.t1", ""),
    ]


def test_drift_isnt_fooled_by_unrelated_fields(spark):
    a = [{"row_no": i, "old": f"a{i}"} for i in range(6)]
    b = [{"row_no": i, "new": f"zz{i * 3}"} for i in range(6)]
    assert told(records(spark, [a, b])) == [("f_1", "added", "", "new"), ("f_1", "removed", "old", "")]


def test_drift_odd_input(spark):
    odd = ['{"row_no": 1, "a": 1', None, "", "[1, 2]", "null", {"row_no": 2, "a": None, "values": {"b": 1}}, {"row_no": 2, "a": None, "values": {"b": 1}}]
    later = [{"row_no": 2, "a": "x", "values": {"b": "1"}}, {"row_no": 2, "a": "x", "values": {"b": "1"}}, {"row_no": 3, "a": "y" * 200_000, "values": None}]
    assert told(records(spark, [odd, later])) == [("f_1", "type_changed", "values.b", "values.b")]
    assert told(records(spark, [])) == []
    late = records(spark, [[{"row_no": 1, "a": 1}], [{"row_no": 1, "a": "1"}]]).orderBy(F.desc("record_id"))
    assert told(late) == [("f_1", "type_changed", "a", "a")]


def test_consistent_table_unites_names_and_types(spark):
    base = [{"row_no": i, "page": i, "ok": True} for i in range(5)]
    then = [{"row_no": i, "page_no": str(i), "ok": "false"} for i in range(5)]
    more = [{"row_no": i, "page": i, "ok": False} for i in range(5)]
    rows = drift.consistent(records(spark, [base, then, more])).collect()
    assert len(rows) == 15 and all(r.numbers["page"] is not None and r.flags["ok"] is not None for r in rows)


SIDE = "k string, y int, v string, w string, difference string"


def test_difference_equals_full_comparison(spark):
    random.seed(7)
    left = {(f"k{i}" if i else None, i % 5): (str(random.randrange(9)), None if i % 7 == 0 else "w") for i in range(400)}
    right = dict(left)
    for key in random.sample(sorted(left, key=str), 30):
        right[key] = (str(10 + random.randrange(3)), right[key][1])
    for key in random.sample(sorted(left, key=str), 15):
        right.pop(key)
    right |= {(f"new{i}", 1): ("1", "w") for i in range(10)}
    frame = lambda side: spark.createDataFrame([(k, y, v, w, "z") for (k, y), (v, w) in side.items()], SIDE)
    want = {(k, y, "missing_in_b") for k, y in left.keys() - right.keys()} | {(k, y, "missing_in_a") for k, y in right.keys() - left.keys()}
    want |= {(*key, f) for key in left.keys() & right.keys() for f, p, q in zip("vw", left[key], right[key], strict=True) if p != q}
    for bits in (1, 4):
        got = {(r.k, r.y, r.difference) for r in diff.difference(frame(left), frame(right), ["k", "y"], ["v", "w"], ("a", "b"), bits=bits).collect()}
        assert got == want


def test_difference_of_equal_and_empty_copies(spark):
    some = spark.createDataFrame([("a", 1, "x", None, ""), (None, None, None, None, "")], SIDE)
    none = some.limit(0)
    run = lambda a, b: sorted(r.difference for r in diff.difference(a, b, ["k", "y"], ["v", "w"], ("a", "b")).collect())
    assert run(some, some) == [] and run(none, none) == []
    assert run(some, none) == ["missing_in_b"] * 2 and run(none, some) == ["missing_in_a"] * 2


def test_equal_ranges_are_not_compared(spark):
    rows = [(f"k{i}", 1, "x", "w", "") for i in range(2000)]
    a = spark.createDataFrame(rows, SIDE)
    b = spark.createDataFrame([*rows[:-1], ("k1999", 1, "y", "w", "")], SIDE)
    x, y = (diff.digested(t, ["k", "y"], ["v", "w"]) for t in (a, b))
    leaves, depth = diff.mismatched_ranges(x, y, bits=3)
    assert depth == 7 and leaves.count() == 1
    # Of 2000 rows each round sums only those of the range that still differs.
    top = diff.unequal_ranges(x, y, None, 0, 3)
    below = diff.range_sums(x, top, 3, 6, "l").agg({"l_n": "sum"}).first()[0]
    assert top.count() == 1 and below == top.first().l_n < 400
    assert diff.mismatched_ranges(x, x)[0].count() == 0


def test_latest_state(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("a", 2, "new"), (None, 1, "n"), (None, None, "o")], "k string, at int, v string")
    assert {r.k: r.v for r in diff.latest(df, ["k"], [F.col("at")]).collect()} == {"a": "new", None: "n"}


@pytest.mark.parametrize(("path", "form"), [(r"data\2022\a.xlsx", "data/2022/a.xlsx"), ("./data//2022/a.xlsx", "data/2022/a.xlsx"), (" data/x/../2022/./a.xlsx ", "data/2022/a.xlsx"), ("  ", None), (None, None), ("data/a.xls", "data/a.xls")])
def test_path_form(spark, path, form):
    assert spark.createDataFrame([(path,)], "p string").select(diff.path_form(F.col("p"))).first()[0] == form


READING = "reading_id long, source string, at timestamp, old_value decimal(38,6), new_value decimal(38,6), may_be_negative boolean, y double, level string"


def readings(spark, rows):
    return spark.createDataFrame([(i, s, T0 + timedelta(hours=i), o, n, neg, 1.0, "x") for i, (s, o, n, neg) in enumerate(rows)], READING)


def test_spikes_stuck_and_impossible(spark):
    rng = np.random.default_rng(4)
    rows = []
    for s, sigma in (("calm", 0.02), ("wild", 0.15), ("shifted", 0.02)):
        for _ in range(60):
            o = Decimal(str(round(float(rng.lognormal(7, 1)), 2)))
            factor = 10 ** rng.normal(0, sigma) * (1000 if s == "shifted" else 1)
            rows.append((s, o, Decimal(str(round(float(o) * factor, 4))), False))
    still = [("still", Decimal(100 + i), Decimal(100 + i), False) for i in range(40)]
    planted = [("calm", Decimal(1000), Decimal(2600), False), ("calm", Decimal(500), Decimal(500), False), ("wild", Decimal(1000), Decimal(2600), False), ("calm", Decimal(5), Decimal(-5), False), ("calm", Decimal(-50), Decimal(-51), True), ("wild", Decimal(10), Decimal("3e24"), False), ("shifted", Decimal(100), Decimal(101), False)]
    odd = [("calm", None, Decimal(1), False), (None, Decimal(1), Decimal(1), None), ("calm", Decimal(1000), Decimal(2600), False)]
    everything = rows + still + planted + odd
    at = len(rows) + len(still)
    got = {r.reading_id: r.reason for r in spikes.abnormal(readings(spark, everything)).collect()}
    assert got == {at: "spike", at + 1: "stuck", at + 3: "impossible", at + 5: "impossible", at + 6: "spike", at + 9: "spike"}
    # Whether a source's shares are cut into many chunks or none, rows are judged alike.
    some = readings(spark, everything).where("old_value > 0 and new_value > 0 and source is not null").selectExpr("reading_id", "source", "at", "cast(log10(new_value / old_value) as double) as y", "cast(old_value - new_value as double) as delta")
    for rows_ in (20, 4096):
        assert spikes.frozen(spikes.innovations(some, chunk_rows=rows_)).where("moves and frozen").count() == 0
    assert spikes.abnormal(readings(spark, [])).count() == 0


def drifting(spark, n=320, seed=5):
    """A source whose level rises a hundredfold, one reading three times its neighbours', 30 readings frozen on one change."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        factor = 10 ** (2 * i / n + rng.normal(0, 0.02))
        rows.append(("drifting", Decimal(100), Decimal(str(round(100 * factor * (3 if i == 100 else 1), 6))), False))
    return readings(spark, rows)


def test_the_state_decides_where_the_level_drifts(spark):
    assert [tuple(r) for r in spikes.abnormal(drifting(spark)).select("reading_id", "reason").collect()] == [(100, "spike")]
    # Without dynamics the level's own movement hides the spike.
    assert spikes.abnormal(drifting(spark), drifts=(0.0,)).count() == 0


def test_frozen_runs_have_no_innovation_variance(spark):
    rng = np.random.default_rng(6)
    rows = [("s", Decimal(200), Decimal("210") if 60 <= i < 90 else Decimal(str(round(200 * 10 ** rng.normal(0.02, 0.02), 4))), False) for i in range(200)]
    got = {r.reading_id: r.reason for r in spikes.abnormal(readings(spark, rows)).collect()}
    assert got == dict.fromkeys(range(60, 90), "stuck")
    # Seven alike are no run of eight; a source that never moves isn't judged.
    few = [("s", Decimal(200), Decimal("210") if 60 <= i < 67 else r[2], False) for i, r in enumerate(rows[:60] + rows[90:])]
    assert spikes.abnormal(readings(spark, few)).count() == 0
    # In a source cut into chunks, of a run of twice the length less one at least the longer part is found.
    many = rows + [("s", Decimal(200), Decimal(str(round(200 * 10 ** rng.normal(0.02, 0.02), 4))), False) for _ in range(1000)]
    inner = readings(spark, many).selectExpr("reading_id", "source", "at", "cast(log10(new_value / old_value) as double) as y", "cast(old_value - new_value as double) as delta")
    found = {r.reading_id for r in spikes.frozen(spikes.innovations(inner, chunk_rows=1000)).where("frozen").collect()}
    assert found <= set(range(60, 90)) and len(found) >= 15


def test_runs_are_found_alike_whatever_the_size(spark):
    rng = np.random.default_rng(7)
    held = {i for i in range(600) if i // 8 % 3 == 1}
    # Null times first, then two readings of each time, the earliest before 1970; one row thrice, a run of seven at the end.
    rows = [(i, "s", None if i < 20 else T0 + timedelta(days=40 * (i // 2 - 600)), 1.0 if i in held else 2.0 if i >= 600 else float(rng.normal(0, 0.5)), 1.0) for i in range(607)]
    some = spark.createDataFrame(rows + [rows[250]] * 2, "reading_id long, source string, at timestamp, y double, delta double")
    for chunk_rows in (10**6, 40, 1):
        got = sorted(r.reading_id for r in spikes.frozen(spikes.innovations(some, chunk_rows=chunk_rows)).where("frozen").collect())
        assert got == sorted([*held, 250, 250]), chunk_rows
    # By its default too: each run of eight of a source over the rows of one chunk.
    many = [("s", Decimal(200), Decimal("210") if i // 8 % 3 == 1 else Decimal(str(round(200 * 10 ** rng.normal(0.02, 0.02), 4))), False) for i in range(4800)]
    got = {r.reading_id for r in spikes.abnormal(readings(spark, many)).where("reason = 'stuck'").collect()}
    assert got == {i for i in range(4800) if i // 8 % 3 == 1}


def test_repeated_null_times_and_extra_columns(spark):
    rows = readings(spark, [("s", Decimal(100), Decimal(100 + i % 7), False) for i in range(40)])
    both = rows.withColumn("at", F.when(F.col("reading_id") % 2 == 0, F.col("at"))).withColumn("innovation", F.lit("x")).withColumn("b", F.lit(1))
    assert spikes.abnormal(both.unionByName(both)).where("reason = 'spike'").count() == 0


AMOUNT = "grp string, source string, rank int, entity long, amount double, power int"


def test_source_scales(spark):
    random.seed(3)
    rows = []
    for city in range(4):
        for line in range(30):
            base = random.lognormvariate(7, 1)
            for year in range(4):
                off = {(0, 2): 1000, (1, 0): 0.001, (2, 3): 1e6}.get((city, year), 1)
                rows.append((f"c{city}", f"c{city}/{year}", year, line, base * random.uniform(0.8, 1.25) * off, 9))
    rows += [(None, "x", 1, 1, 1.0, 9), ("c0", "c0/0", 0, None, 5.0, 9), ("c0", "c0/0", 0, 3, None, 9), ("c0", "c0/1", 1, 4, 0.0, 9), rows[0], rows[0]]
    got = {r.source: r.power for r in units.source_scales(spark.createDataFrame(rows, AMOUNT)).collect()}
    assert {s: p for s, p in got.items() if p} == {"c0/2": 3, "c1/0": -3, "c2/3": 6} and len(got) == 16
    assert units.source_scales(spark.createDataFrame([], AMOUNT)).count() == 0


def test_pairwise_scale_and_offset(spark):
    links = spark.createDataFrame([("a", "b", float(i), 1000.0 * i + 5) for i in range(50, 70)] + [("a", "c", 2.0, 2.1), ("a", "b", 0.0, 1.0), ("a", "b", None, 1.0)], "a string, b string, x double, y double")
    got = {r.b: (r.power, r.n_links) for r in units.pairwise_scales(links).collect()}
    assert got == {"b": (3.0, 20), "c": (None, 1)}
    assert units.pairwise_scales(links).where("b = 'b'").first().offset == 5.0


def test_consistent_values_keep_their_characters(spark):
    said = 'say "x" \\ end\nnext'
    base = [{"page": i, "name": said, "list": ["a", "b"], "size": i, "wrapped": {"text": said}, "o": {"a": 1, "b": [2]}} for i in range(5)]
    odd = [{"page": 5 + i, "name": ["a", "b"], "list": "lone", "size": [7], "wrapped": said, "o": {"text": 3}} for i in range(2)]
    rows = {r.numbers["page"]: r for r in drift.consistent(records(spark, [base, base, odd])).collect()}
    assert rows[0].texts["name"] == said and rows[0].texts["list"] == '["a","b"]' and rows[0].texts["wrapped"] == said
    assert json.loads(rows[0].texts["o"]) == {"a": 1, "b": [2]}
    assert rows[5].texts["name"] == '["a","b"]' and rows[5].texts["list"] == "lone" and rows[5].numbers["size"] == 7 and rows[5].texts["wrapped"] == said
