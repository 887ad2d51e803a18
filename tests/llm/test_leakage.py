import random

import pytest

from ledgerloom.llm import leakage as L

random.seed(9)
WORDS = [f"{a}{b}{c}" for a in ("ba", "ko", "mir", "tel", "sun") for b in ("la", "ru", "ven") for c in ("t", "dor", "shi", "n")]


def passage(seed, n=60):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(9)) for _ in range(n))


ITEMS = [(i, passage(i)) for i in range(1, 6)]


def found(spark, docs, items=ITEMS):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(docs)], "doc_id long, text string, covered string, item_id long")
    e = spark.createDataFrame([(i, p, "x") for i, p in items], "item_id long, passage string, stock string")
    return {(r.doc_id, r.item_id) for r in L.leaks(d, e).collect()}


def filler(seed, n=80):
    rng = random.Random(1000 + seed)
    return " ".join("w" + "".join(rng.choice("aeioubcdg") for _ in range(6)) for _ in range(n))


def test_whole_part_and_short_quote(spark):
    words = ITEMS[0][1].split()
    docs = [filler(1) + " " + ITEMS[0][1] + ". " + filler(2), filler(3) + " " + " ".join(words[20:43]), filler(4) + " " + " ".join(words[5:20]) + " " + filler(5), filler(6) + " " + " ".join(words[:12]) + " " + filler(7) + " " + " ".join(words[40:52]), filler(8)]
    assert found(spark, docs) == {(0, 1), (1, 1), (3, 1)}


def test_slips_case_marks_and_breaks_dont_hide(spark):
    words = ITEMS[1][1].split()
    slipped = [w[:-2] + "q" + w[-1] if i % 9 == 4 else w for i, w in enumerate(words)]
    docs = [" ".join(slipped), ITEMS[1][1].upper().replace("A", "Á").replace(" ", " ,\r\n"), ITEMS[1][1].replace("koru", "ko-\nru").replace("miru", "mi­ru"), ITEMS[1][1].replace("a", "а").replace("o", "ο"), ITEMS[1][1].replace("l", "1").replace("o", "0")]
    assert found(spark, docs) == {(i, 2) for i in range(5)}


def test_stock_doesnt_count(spark):
    stock = " ".join(passage(77, 24).split())
    items = [(i, passage(i, 30) + " " + stock) for i in range(1, 5)]
    docs = [filler(i) + " " + stock for i in range(40)] + [passage(3, 30)]
    assert found(spark, docs, items) == {(40, 3)}


def test_same_form_other_content_isnt_a_leak(spark):
    rng = random.Random(5)
    form = lambda: " ".join(f"station {rng.choice(WORDS)}{rng.randrange(99)} returns {rng.randrange(1000, 9999)} unused bonds under the {rng.choice(WORDS)}{rng.randrange(99)} guarantee once matrix {rng.randrange(1000, 9999)} closes." for _ in range(5))
    items = [(1, form()), (2, form())]
    assert found(spark, [form() for _ in range(20)], items) == set()


def test_odd_input(spark):
    assert found(spark, [None, "", "   ", "x"]) == set()
    assert found(spark, [ITEMS[0][1]], []) == set()
    assert found(spark, [], ITEMS) == set()
    assert found(spark, [ITEMS[0][1]] * 2, [(1, ITEMS[0][1]), (1, ITEMS[0][1]), (7, None), (8, ""), (9, ITEMS[0][1])]) == {(0, 1), (1, 1), (0, 9), (1, 9)}
    assert found(spark, [filler(1, 30_000) + " " + ITEMS[2][1] + " " + filler(2, 30_000)]) == {(0, 3)}


def test_stock_is_told_over_all_items(spark):
    quote = " ".join(passage(78, 16).split())
    own = passage(79, 30).split()
    pair = [(1, " ".join(own[:15]) + " " + quote + " " + " ".join(own[15:])), (2, passage(80, 30) + " " + quote)]
    many = [(100 + i, passage(200 + i, 40)) for i in range(300)]
    docs = [filler(1) + " " + quote + " " + filler(2), " ".join(own[:15]) + " " + quote]
    assert found(spark, docs, pair) == found(spark, docs, [*pair[:1], *many, *pair[1:]]) == {(1, 1)}


def test_short_items_are_found_whole(spark):
    items = [(n, passage(300 + n, n)) for n in (1, 3, 6, 7, 9, 12)]
    docs = [filler(20 + n) + " " + p + " " + filler(40 + n) for n, p in items]
    assert found(spark, docs, items) == {(k, n) for k, (n, _) in enumerate(items)}
    parts = [filler(60) + " " + " ".join(p.split()[: n - 1]) for n, p in items if n < 7]
    assert found(spark, parts, items[:3]) == set()
    # Half of twelve words is more than a third, a quarter isn't.
    twelve = items[-1][1].split()
    assert found(spark, [filler(61) + " " + " ".join(twelve[3:9]), filler(62) + " " + " ".join(twelve[:3])], items[-1:]) == {(0, 12)}


def test_words_put_in_and_left_out_are_chained(spark):
    words = ITEMS[3][1].split()
    put_in = [x for i, w in enumerate(words) for x in ([w, "inserted"] if i % 6 == 5 else [w])]
    left_out = [w for i, w in enumerate(words) if i % 7 != 6]
    assert found(spark, [filler(1) + " " + " ".join(put_in), " ".join(left_out) + " " + filler(2)]) == {(0, 4), (1, 4)}


def test_recall_over_lengths_and_edits(spark):
    """0.95 or more of planted leaks of items of 3 to 200 words, each word replaced, put in or left out with one in twelve."""
    rng = random.Random(31)
    items = [(n, passage(500 + n, n)) for n in range(3, 201, 7)]
    docs, want = [], set()
    for n, p in items:
        words = p.split()
        for kind in range(3):
            edited = []
            for w in words:
                odd = n >= 12 and rng.random() < 1 / 12
                edited += ["swapped"] if odd and kind == 0 else [w, "added"] if odd and kind == 1 else [] if odd and kind == 2 else [w]
            want.add((len(docs), n))
            docs.append(filler(100 + len(docs)) + " " + " ".join(edited) + " " + filler(400 + len(docs)))
    got = found(spark, docs, items)
    assert got <= want and len(got) >= 0.95 * len(want)


@pytest.mark.parametrize(("a", "b", "same"), [("guarantee", "guarantes", True), ("4821", "4822", False), ("abc", "abd", False), ("house", "mouse", True), ("station", "statlon", True), ("garden", "window", False)])
def test_near(a, b, same):
    assert L.near(a, b) is same


def test_copies_of_one_text_dont_make_stock(spark):
    words = passage(5, 60).split()
    quote, more = " ".join(words[:18]), " ".join(words[40:50])
    docs = [filler(1) + " " + quote] * 8 + [filler(2) + " " + quote + " " + filler(3) + " " + more]
    got = found(spark, docs, [(1, " ".join(words))])
    assert {k[0] for k in got} == {8}


def test_whole_passage_counts_though_all_of_it_is_quoted(spark):
    words = passage(6, 60).split()
    docs = [filler(10 + 10 * q + i) + " " + " ".join(words[15 * q : 15 * q + 15]) for q in range(4) for i in range(6)]
    got = found(spark, [*docs, " ".join(words)], [(1, " ".join(words))])
    assert {k[0] for k in got} == {24}


def test_bounds_never_lose_a_piece():
    """Whatever the exact verification finds, the bound lets pass."""
    rng = random.Random(17)
    words, passages, shifts, found_ = [], [], [], []
    for _ in range(400):
        n = rng.choice((5, 9, 14, 30, 60))
        item = L.words_of(passage(rng.randrange(50), n))
        a = rng.randrange(0, max(1, n - 4))
        piece = item[a : a + rng.randrange(2, 14)]
        piece = [w[:-1] + "q" if rng.random() < 0.15 else w for w in piece]
        if rng.random() < 0.4 and len(piece) > 4:
            piece.insert(len(piece) // 2, "inserted")
        lead = L.words_of(filler(rng.randrange(99), rng.randrange(1, 9)))
        doc = [*lead, *piece, *L.words_of(filler(rng.randrange(99), 6))]
        words.append(" ".join(doc))
        passages.append(" ".join(item))
        shifts.append(L.np.array(sorted({len(lead) - a, len(lead) - a + 1})))
        found_.append(bool(L.pieces_of(doc, item, shifts[-1].tolist())))
    told = L.Bounds().possible(words, passages, shifts, [L.np.array([], dtype=int)] * len(words))
    assert all(t or not f for t, f in zip(told, found_, strict=True)) and 20 < sum(found_) < sum(told) < 400
