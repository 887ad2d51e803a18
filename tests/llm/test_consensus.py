import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import consensus as C

READING = "reading_id long, value_id long, annotator string, role string, value string, confidence double, read_at timestamp, num string, cell string, weight int"
T0 = datetime(2025, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(i, c, a, role, v, None, T0 + timedelta(minutes=i), "x", "y", 1) for i, (c, a, role, v) in enumerate(rows)], READING)


@pytest.mark.parametrize(("text", "number"), [("1.234,50", "1234.5"), ("1234.50", "1234.5"), (" 71.715 ", "71.715"), ("0,5884", "0.5884"), ("-", None), ("—", None), ("", None), (None, None), ("  ", None), ("x", None), ("−3", "-3"), ("1.000.000,5", "1000000.5")])
def test_readings(spark, text, number):
    got = spark.createDataFrame([(text,)], "v string").select(C.reading_number(F.col("v"))).first()[0]
    assert got == number


def test_readings_of_any_length(spark):
    number = lambda i: f"{i + 1}" + "8" * 70
    rows = [(i, who, "draft", text) for i in range(40) for who, text in (("a", number(i)), ("b", f"0{number(i)},0"), ("c", number(i)[:-1] + "7" if i % 4 == 0 else number(i)))]
    assert {x.cell: x.consensus for x in C.consensus(frame(spark, rows))[1].collect()} == {i: number(i) for i in range(40)}


def test_latest_reading_counts_and_blanks_dont(spark):
    rows = [(1, "a", "reviewer", "5"), (1, "a", "reviewer", "6"), (1, "a", "reviewer", "-"), (1, "b", "draft", ""), (None, "a", "ocr", "1"), (1, None, "ocr", "1")]
    got = C.votes_of(frame(spark, rows)).collect()
    assert [(r.cell, r.annotator, int(r.num)) for r in got] == [(1, "a", 6)]


def simulated(seed=1, cells=500):
    rng = random.Random(seed)
    skill = {"good1": 0.97, "good2": 0.95, "fair": 0.85, "bad1": 0.5, "bad2": 0.5, "bad3": 0.5}
    truth, rows = {}, []
    for c in range(cells):
        truth[c] = rng.randrange(10_000, 99_999)
        readers = rng.sample(sorted(skill), 4)
        original = None
        for a in readers:
            v = truth[c] if rng.random() < skill[a] else truth[c] + rng.choice([1, 10, 900])
            original = v if a == "fair" else original
            rows.append((c, a, "reviewer" if a == readers[0] else "draft", str(v)))
        if original is not None:  # somebody who mostly copies `fair`
            copied = original if rng.random() < 0.9 else truth[c]
            rows.append((c, "copycat", "draft", str(copied)))
    return truth, rows, skill


def test_reliability_and_copies(spark):
    truth, rows, skill = simulated()
    votes, decided, rated, links = C.consensus(frame(spark, rows))
    r = {x.annotator: x.reliability for x in rated.collect()}
    assert all(abs(r[a] - s) < 0.12 for a, s in skill.items())
    assert {tuple(sorted((x.child, x.parent))) for x in links.collect()} == {("copycat", "fair")}
    got = {x.cell: int(x.consensus) for x in decided.collect()}
    assert np.mean([got[c] == t for c, t in truth.items()]) > 0.95


def test_matrix_equals_all_pairs(spark):
    _, rows, _ = simulated(2, 80)
    votes = C.votes_of(frame(spark, rows))
    local = {}
    for v in votes.collect():
        local.setdefault(v.cell, []).append((v.annotator, v.num))
    want = {}
    for vs in local.values():
        for a, x in vs:
            for b, y in vs:
                if a != b:
                    n, k = want.get((a, b), (0, 0))
                    want[a, b] = (n + 1, k + (x == y))
    assert {(m.a, m.b): (m.overlap, m.agree) for m in C.agreement_matrix(votes).collect()} == want


def test_vector_is_the_eigenvector(spark):
    p = np.array([0.95, 0.9, 0.8, 0.6, 0.4])
    rng = np.random.default_rng(2)
    noise = rng.normal(0, 0.01, (5, 5))
    M = np.outer(p, p) + noise + noise.T
    m = spark.createDataFrame([(f"n{i}", f"n{j}", 50, float(M[i, j])) for i in range(5) for j in range(5) if i != j], "a string, b string, overlap long, centred double")
    got = {x.annotator: x.reliability for x in C.leading_vector(m, coincidence=0.0, tolerance=1e-10).collect()}
    u = np.array([got[f"n{i}"] for i in range(5)])
    completed = M.copy()
    np.fill_diagonal(completed, u * u)
    values, vectors = np.linalg.eigh(completed)
    v = np.abs(vectors[:, -1]) * np.sqrt(values[-1])
    assert np.allclose(u, v, atol=1e-5) and np.allclose(u, p, atol=0.03)


def test_odd_input(spark):
    none = C.consensus(frame(spark, []))
    assert none[1].count() == 0 and none[2].count() == 0
    lone = C.consensus(frame(spark, [(1, "a", "reviewer", "5"), (2, "b", None, "7")]))
    assert {(x.cell, int(x.consensus), x.agreement) for x in lone[1].collect()} == {(1, 5, 1.0), (2, 7, 1.0)}
    tie = C.consensus(frame(spark, [(1, "a", "reviewer", "5"), (1, "b", "draft", "4")]))[1].first()
    assert int(tie.consensus) == 4 and tie.agreement == 0.5
    hot = C.consensus(frame(spark, [(1, f"r{i % 5}", "draft", "9" if i % 5 else "8") for i in range(500)]))[1].first()
    assert (int(hot.consensus), hot.readers, hot.agree) == (9, 5, 4)


def test_unsettled_vector_raises(spark):
    half = [("a", "b", 10, 0.9), ("a", "c", 10, 0.5), ("b", "c", 10, 0.4)]
    matrix = spark.createDataFrame(half + [(b, a, n, c) for a, b, n, c in half], "a string, b string, overlap long, centred double")
    with pytest.raises(RuntimeError, match="still change"):
        C.leading_vector(matrix, most=4)
    assert C.leading_vector(matrix).count() == 3


def test_every_fit_goes_on_to_the_end(spark, monkeypatch):
    _, rows, _ = simulated()
    asked, fit = [], C.leading_vector

    def told(matrix, start=None, **settings):
        asked.append(settings.get("tolerance", 1e-4))
        return fit(matrix, start, **settings)

    monkeypatch.setattr(C, "leading_vector", told)
    C.reliabilities(C.votes_of(frame(spark, rows)))
    assert asked and set(asked) == {1e-4}
