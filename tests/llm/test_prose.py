import random

import numpy as np
import pytest

from ledgerloom.llm import prose as P

PROSE = "Consiliul local a aprobat în ședința din 22 august rectificarea bugetului pentru piețe și oboare, dar numai o parte ajunge la școli. "
CASES = [
    (PROSE * 4, "prose"), ("The council adopted an amended budget for the town, while the revenue stayed almost flat in the quarter. " * 3, "prose"), ("Der Stadtrat hat am 7. März den geänderten Haushalt für die Bücherei beschlossen. " * 4, "prose"),
    ("A városi tanács elfogadta a módosított költségvetést. A lakosok megkérdezték, miért késik a munka. " * 3, "prose"), ("\n".join((PROSE * 4)[i : i + 45] for i in range(0, 480, 45)), "prose"), ("1. " + PROSE + "\n2. " + PROSE[:80] + " la ședință.\n" + PROSE * 3, "prose"),
    ("Anexa nr. 2\n" + "\n".join(f"- {w}" for w in ("pompe", "mese noi", "scaune mici", "lămpi", "agentul termic", "piețe și oboare")), "list"), ("\n".join(f"{i}) scaun nou;" for i in range(12)), "list"), ("\n".join(f"nr. {i} pădurea orașului" for i in range(9)), "list"),
    ("mese mici; lămpi noi; agentul termic; scaune; coșuri; spațiile verzi; pompe", "list"), ("Dotări propuse\n" + "\n".join(("Mese noi", "Lămpi", "Agentul termic", "Piețe și oboare", "Coșuri mici", "Banci")), "list"),
    ("Denumire\tCod\tTotal\n" + "\n".join(f"Taxe {i}\t16.02.0{i}\t1.23{i},50" for i in range(8)), "table"), ("\n".join(f"Plăți {i};70.02.0{i};1.234,5{i};x" for i in range(8)), "table"), ("\n".join(f"| Taxe | 16.02.0{i} | 99{i} |" for i in range(6)), "table"), ("\n".join(f"Sprijin școli      16.02.0{i}      99{i}      12,5" for i in range(6)), "table"),
    ("xx " * 60, "junk"), ("lei\n" * 30, "junk"), ("tsqfkdcp pftgzqgqg njzmjhqrf rskgqvm bddlqp gttjkm rrwcpjb qzvnqp " * 3, "junk"), ("82656877f4e50e3113cd47acc51a87e5\nd68530e27f7d8e7cb5b67ef81c6abe05\n" * 3, "junk"), ("=====\n~~~~~\n*****\n-----\n", "junk"), ("~§ $_+¦` ^¬§#*^ %<|$+,^ ' :#§+~ </ |I>§ +.=: ¦%%| *<<§." * 3, "junk"), ("Ã¤Â�â€ƒ? ÃÂ¤� â€ÃƒÂ ¤?Ã� " * 8, "junk"),
    ("88cwQvwwxglCHxJFJmyi4gHJzZCkpFAk7hQbiagBpwQChjeuP31CkgtKHQSgk1EHJDceHZOb9uILiCvx" * 3, "junk"),
]


OTHERS = {
    "fr": "Le conseil municipal a adopté le budget pour l'année prochaine. Les dépenses de la commune sont en hausse par rapport à celles de l'année dernière, mais les recettes ne suivent pas.",
    "es": "El ayuntamiento aprobó el presupuesto para el próximo año. Los gastos de la ciudad son más altos que los del año pasado, pero los ingresos no han crecido. Por eso se debe buscar una solución con los vecinos.",
    "pl": "Rada miasta przyjęła budżet na przyszły rok. Wydatki są wyższe niż w ubiegłym roku, ale dochody nie wzrosły. Dlatego trzeba znaleźć rozwiązanie, które będzie dobre dla mieszkańców.",
    "ru": "Городской совет принял бюджет на следующий год. Расходы города выше, чем в прошлом году, но доходы не выросли. Поэтому надо найти решение вместе с жителями.",
}
#: Languages without a list of function words.
UNLISTED = [
    "市议会通过了明年的预算。今年的支出比去年高，但是收入没有增加。因此，我们必须与居民一起寻找解决办法。图书馆和学校的维修工作将在春天开始，预计夏天完成。",
    "Το δημοτικό συμβούλιο ενέκρινε τον προϋπολογισμό για το επόμενο έτος. Οι δαπάνες είναι υψηλότερες από πέρυσι, αλλά τα έσοδα δεν αυξήθηκαν. Πρέπει να βρεθεί λύση.",
    "وافق مجلس المدينة على ميزانية العام المقبل. النفقات أعلى من العام الماضي، لكن الإيرادات لم ترتفع. لذلك يجب إيجاد حل مع السكان.",
    "Belediye meclisi gelecek yılın bütçesini kabul etti. Giderler geçen yıla göre daha yüksek, ancak gelirler artmadı. Bu nedenle halkla birlikte bir çözüm bulunmalıdır.",
]


def one(text):
    return P.statistics([text], {}).iloc[0]


def test_prose_of_other_languages_is_prose():
    got = P.statistics([*OTHERS.values(), *UNLISTED], {})
    assert set(got.text_kind) == {"prose"}
    assert list(got.language) == [*OTHERS, *[None] * len(UNLISTED)]


def test_the_divergences_decide():
    """Without the words' and characters' divergences the basic counts alone mistake much of what is planted."""
    m = P.Measured([t for t, _ in CASES], {})
    kinds, profiles = P.fitted()
    flat = lambda x: np.full_like(x, 1 / x.shape[1])
    wrong = lambda w, c: sum(kinds[k] != kind for k, (_, kind) in zip(P.distances(w, c, m.counts, profiles if w is m.words else (flat(profiles[0]), flat(profiles[1]), profiles[2])).argmin(axis=1), CASES, strict=True))
    assert wrong(m.words, m.chars) == 0 and wrong(flat(m.words), flat(m.chars)) >= 4


def test_profiles_are_fitted_and_tell_unseen_texts():
    rng = random.Random(3)
    words = "taxe plăți școli piețe lămpi mese scaune oboare venituri cheltuieli".split()
    make = {
        "prose": lambda: " ".join(f"Consiliul a aprobat {rng.choice(words)} pentru {rng.choice(words)} și {rng.choice(words)} din cartier." for _ in range(rng.randrange(3, 9))),
        "list": lambda: "\n".join(f"- {rng.choice(words)} {rng.choice(('noi', 'mici'))}" for _ in range(rng.randrange(5, 15))),
        "table": lambda: "\n".join(f"{rng.choice(words)}\t{rng.randrange(99)}.02\t{rng.randrange(9999)},5" for _ in range(rng.randrange(5, 15))),
        "junk": lambda: " ".join("".join(rng.choice("bcdfghklmnpqrstvwxz0123456789") for _ in range(rng.randrange(5, 40))) for _ in range(rng.randrange(5, 20))),
    }
    draw = lambda n: [(f(), kind) for kind, f in make.items() for _ in range(n)]
    seen, unseen = draw(40), draw(20)
    table = P.fit_profiles([t for t, _ in seen], [k for _, k in seen], dict.fromkeys(make, 2))
    part = lambda prefix: table[[c for c in table.columns if c.startswith(prefix)]].to_numpy()
    m = P.Measured([t for t, _ in unseen], {})
    told = table.kind.to_numpy()[P.distances(m.words, m.chars, m.counts, (part("word_"), part("char_"), part("count_"))).argmin(axis=1)]
    assert list(told) == [k for _, k in unseen]


@pytest.mark.parametrize(("text", "kind"), CASES)
def test_kinds(text, kind):
    assert one(text)["text_kind"] == kind


def test_statistics():
    s = one("Taxe și plăți.\nSold 12,5")
    assert (s["n_chars"], s["n_lines"], s["n_words"], s["line_punctuation_share"]) == (24, 2, 5, 0.5)
    assert s["mean_word_length"] == (4 + 2 + 5 + 4 + 4) / 5 and s["common_word_share"] == 1 / 5


def test_languages():
    assert [one(t)["language"] for t, _ in CASES[:4]] == ["ro", "en", "de", "hu"]


def test_divergence():
    import numpy as np

    p, q = np.array([1.0, 0.0]), np.array([0.0, 1.0])
    assert P.divergence(p, p) == 0 and P.divergence(p, q) == 1 and 0 < P.divergence(p, (p + q) / 2) < 1


def test_documents(spark):
    rows = [(1, None, "z"), (2, "", "z"), (3, " \n ", "z"), (4, PROSE * 3000, "z"), (5, "xx " * 90, "z"), (5, "xx " * 90, "z"), (None, "a", "z")]
    got = P.text_statistics(spark.createDataFrame(rows, "doc_id long, text string, text_kind string")).collect()
    assert [(r.doc_id, r.text_kind) for r in got if r.doc_id and r.doc_id < 5] == [(1, None), (2, None), (3, None), (4, "prose")]
    assert sum(r.text_kind == "junk" for r in got) == 2
    assert P.text_statistics(spark.createDataFrame([], "doc_id long, text string")).count() == 0
