"""Text statistics per document and the structural profile nearest to it."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Frequent function words of each language, most frequent first.
FUNCTION_WORDS = {
    "ro": "de și la în a pentru nu din cu pe că care o un au este al ale fost prin sau dar mai ce s-a unei unui până după fără sunt cel lui se să îl iar ori dacă către",
    "en": "the of and to in a for was that on by with is were as be from at which not are an it this or but will has more than while per before so no",
    "de": "die der und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei am um daher wurden als",
    "hu": "a az és hogy nem is egy meg de ez ki mint már vagy csak azt szerint van napján több más ezért kell miért jut volt el még az be fel",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son aux cette été mais ses elle nous",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este entre cuando muy",
    "it": "di e il la che in un a per è una del con non si da le dei nel alla della sono i come più al anche ha gli ma lo delle o questo",
    "pt": "de a o que e do da em um para com não uma os no se na por mais as dos como mas ao ele das à seu sua ou quando muito nos já",
    "pl": "w i na z do nie się że o to jest po od za dla przez ze jak a oraz tym lub przy są ich być który jego która które ma",
    "nl": "de van het een en in is dat op te zijn met voor niet aan er om ook als bij door maar uit naar wordt hij over deze was of",
    "cs": "a v se na je že s z do o i to ve pro za by ale si po jako od při nebo podle jsou který být tak která jeho",
    "ru": "и в не на что с по как это от к из за для о но до его же так при или бы быть был она они также",
    "uk": "і в не на що з у та до як за від для по про це його але або при чи бути був вона вони також між",
}
#: Share of all running words that a language's function words take in its prose; ROMANCE for those not listed.
FUNCTION_SHARE = {"ro": 0.33, "en": 0.33, "de": 0.28, "hu": 0.22, "pl": 0.24, "cs": 0.26, "ru": 0.24, "uk": 0.24, "nl": 0.36}
ROMANCE = 0.38
#: Vowels without marks, Greek and Cyrillic ones too.
VOWELS = "aeiouyаеиоуыэюяіїєαεηιουω"
#: What ends a sentence, what marks cells of a table, and what wrongly decoded text is made of.
STOPS, CELLS, MISREAD = ".!?…:。！？", "\t|¦;", "ÃÂ¤€ƒ�"
#: Marks that belong to running text.
RUNNING = ",'\"„”“«»()-–/%’，、："
BULLET = re.compile(r"\s*(?:[-–—*•▪◦●·‣➜→►✓+]\s+|\(?\d{1,3}(?:\.\d{1,3})*[.)]\s+|\(?[a-zA-Z][.)]\s+|\(?[ivxlcIVXLC]{1,6}[.)]\s+|\[\d{1,3}\]\s+|(?:nr|art|pct|lit|poz|no|punctul|pos)\.?\s*\d{1,3}[.):]?\s+)\S", re.IGNORECASE)
CELL = re.compile(r"\s*[\t|¦;]\s*| {2,}")
ENDS = re.compile(r"[.!?…:][\"'”»)\]]*(?=\s|$)|[。！？]")
LINES = re.compile(r"\r\n|\r|\n")
#: Kinds of words: band of a language's function words (frequent to rare), other words, numbers, no words of any language, words said again and again.
WORDS = ("first", "second", "third", "word", "number", "odd", "again")
#: Kinds of characters.
CHARS = ("vowel", "consonant", "capital", "digit", "space", "line", "stop", "running", "cell", "other")
#: Basic counts, each a share.
COUNTS = ("ends", "cells", "items", "fresh", "length")
BANDS = (3, 10)


def bare(word: str) -> str:
    """A word in small letters without marks and without outer punctuation."""
    w = word.lower().strip("".join(RUNNING) + STOPS + CELLS + "[]{}*•_")
    return w if w.isascii() else "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c))


def _vocabulary() -> tuple[dict[str, int], list[str], np.ndarray]:
    """Words to columns, the languages, and (language, column) to band: 0 for none, then 1 to 3."""
    languages = list(FUNCTION_WORDS)
    column: dict[str, int] = {}
    marks: list[tuple[int, int, int]] = []
    for k, lang in enumerate(languages):
        for rank, w in enumerate(dict.fromkeys(bare(w) for w in FUNCTION_WORDS[lang].split())):
            marks.append((k, column.setdefault(w, len(column) + 1), 1 + sum(rank >= b for b in BANDS)))
    bands = np.zeros((len(languages), len(column) + 1), dtype=np.int64)
    for k, c, band in marks:
        bands[k, c] = band
    return column, languages, bands


COLUMN, LANGUAGES, BAND = _vocabulary()
#: (language, column): the part of a word that is the language's own.
OWN = (BAND > 0) / np.maximum(1, (BAND > 0).sum(axis=0))


def _language_profiles() -> np.ndarray:
    """(language, 4): shares of running words in the three bands and of all others, falling off with rank like 1/(rank + 3)."""
    out = np.zeros((len(LANGUAGES), 4))
    for k, lang in enumerate(LANGUAGES):
        n = len(dict.fromkeys(FUNCTION_WORDS[lang].split()))
        weight = 1.0 / (np.arange(n) + 3)
        weight *= FUNCTION_SHARE.get(lang, ROMANCE) / weight.sum()
        out[k] = [weight[: BANDS[0]].sum(), weight[BANDS[0] : BANDS[1]].sum(), weight[BANDS[1] :].sum(), 1 - weight.sum()]
    return out


PROSE_WORDS = _language_profiles()


def _entropy(p: np.ndarray) -> np.ndarray:
    """Shannon entropy of the last axis, in bits."""
    return -(p * np.log2(np.where(p > 0, p, 1.0))).sum(axis=-1)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence of the last axes in bits, 0 to 1."""
    return np.maximum(0.0, _entropy((p + q) / 2) - (_entropy(p) + _entropy(q)) / 2)


def _char_kind(c: str) -> int:
    if c in "\r\n \x85":
        return CHARS.index("line")
    if c in MISREAD:
        return CHARS.index("other")
    if c in CELLS:
        return CHARS.index("cell")
    if c.isspace():
        return CHARS.index("space")
    if c in STOPS:
        return CHARS.index("stop")
    if c in RUNNING:
        return CHARS.index("running")
    if c.isdigit():
        return CHARS.index("digit")
    if c.isupper():
        return CHARS.index("capital")
    if unicodedata.combining(c):
        return CHARS.index("vowel")
    if c.isalpha():
        base = unicodedata.normalize("NFKD", c)[0]
        # Letters of scripts without vowel letters stand for syllables: both kinds alternate.
        return CHARS.index("vowel") if base in VOWELS or (base > "֐" and ord(base) % 2) else CHARS.index("consonant")
    return CHARS.index("other")


@lru_cache(maxsize=1)
def _char_table() -> np.ndarray:
    """Kind of every character, told on first sight; 255 is not yet seen."""
    return np.full(0x110000, 255, dtype=np.uint8)


#: Scripts that are written without blanks: a character counts as a word.
_UNSPACED = re.compile("[฀-໿က-႟ក-៿぀-ヿ㐀-鿿가-힯豈-﫿]")


def word_kind(token: str) -> int:
    """Column of a function word, else -1 for other words, -2 for numbers, -3 for what is no word of any language."""
    w = bare(token)
    if not w:
        return -3
    if (found := COLUMN.get(w)) is not None:
        return found
    if w[0].isdigit() and not any(c.isalpha() for c in w) or w.replace(".", "").replace(",", "").isdigit():
        return -2
    letters = [c for c in w if c.isalpha()]
    if len(letters) < len(w) - 2 or not letters or len(w) > 28 or any(c in MISREAD for c in token):
        return -3
    if letters[0] > "֐":
        return -1
    run = longest = 0
    for c in letters:
        run = 0 if c in VOWELS else run + 1
        longest = max(longest, run)
    turns = sum(a.islower() and b.isupper() for a, b in zip(token, token[1:], strict=False))
    shaped = longest <= 5 and longest < max(2, len(letters)) and turns <= 1
    return -1 if shaped or token.isupper() and len(letters) <= 6 else -3


#: A word's kind and its length are remembered as one number.
_SHIFT, _PLACES = 3, 1 << 12


class Measured:
    """All distributions of a batch of texts, a row per text."""

    def __init__(self, texts: list[str], known: dict[str, int]):
        n = len(texts)
        self.n_chars = np.array([len(t) for t in texts], dtype=np.int64)
        self.chars = self._chars(texts, n)
        functions = np.zeros((n, len(COLUMN) + 1))
        rest = np.zeros((n, 4), dtype=float)  # word, number, odd, again
        self.n_words, self.letters = (np.zeros(n, dtype=np.int64) for _ in range(2))
        self.n_lines, self.ends = np.zeros(n, dtype=np.int64), np.zeros(n)
        self.counts = np.zeros((n, len(COUNTS)))
        if len(known) > 1_000_000:
            known.clear()
        for i, text in enumerate(texts):
            tokens = text.split()
            if not tokens:
                continue
            if not text.isascii() and _UNSPACED.search(text):
                tokens = _UNSPACED.sub(lambda m: f"{m.group()} ", text).split()
            for t in set(tokens).difference(known):
                known[t] = word_kind(t) + _SHIFT + _PLACES * len(bare(t))
            held = np.array([known[t] for t in tokens], dtype=np.int64)
            kinds, sizes = held % _PLACES - _SHIFT, held // _PLACES
            functions[i] = np.bincount(kinds[kinds > 0], minlength=functions.shape[1])
            rest[i, :3] = [(kinds == k).sum() for k in (-1, -2, -3)]
            distinct = len(set(tokens))
            # What is said again beyond what prose of this length says again.
            if len(tokens) >= 6 and distinct < 0.25 * len(tokens):
                _, times = np.unique(np.array(tokens, dtype=object).astype(str), return_counts=True)
                rest[i, 3] = times[times > 0.15 * len(tokens)].sum()
            self.n_words[i], self.letters[i] = (sizes > 0).sum(), sizes.sum()
            lines = [x for x in LINES.split(text) if x.strip()]
            ends = cells = items = 0
            for line in lines:
                ends += line.rstrip().rstrip("'\"”»)]")[-1:] in tuple(STOPS)
                if "\t" in line or "|" in line or "¦" in line or ";" in line or "  " in line:
                    cells += len(CELL.findall(line.strip())) >= 2
                items += BULLET.match(line) is not None
            m = len(lines)
            self.n_lines[i], self.ends[i] = m, ends / m
            # Where there are hardly any lines, sentences in them count: one in ten words or more is all.
            share = ends / m if m > 3 else max(ends / m, min(1.0, 10 * len(ENDS.findall(text)) / len(tokens)))
            self.counts[i] = [share, cells / m, items / m, min(1.0, 2 * distinct / len(tokens)), min(1.0, len(tokens) / m / 16)]
        self.functions = functions
        # The language whose own function words take most of the text, shared ones counting by their share; then its bands.
        total = np.maximum(1, functions.sum(axis=1) + rest[:, :3].sum(axis=1))
        self.language = (functions @ OWN.T).argmax(axis=1)
        in_band = np.stack([(functions * (BAND[self.language] == b)).sum(axis=1) for b in (1, 2, 3)], axis=1) / total[:, None]
        self.apart = divergence(np.concatenate([in_band, 1 - in_band.sum(axis=1, keepdims=True)], axis=1), PROSE_WORDS[self.language])
        own = in_band * total[:, None]
        other = functions.sum(axis=1) - own.sum(axis=1) + rest[:, 0]
        words = np.concatenate([own, other[:, None], rest[:, 1:3]], axis=1)
        again = np.minimum(1.0, rest[:, 3] / total)
        self.words = np.concatenate([words / total[:, None] * (1 - again[:, None]), again[:, None]], axis=1)
        self.common = functions.sum(axis=1) / total

    @staticmethod
    def _chars(texts: list[str], n: int) -> np.ndarray:
        table = _char_table()
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kinds = table[points]
        if (kinds == 255).any():
            for p in np.unique(points[kinds == 255]).tolist():
                table[p] = _char_kind(chr(p))
            kinds = table[points]
        whose = np.repeat(np.arange(n), [len(t) for t in texts])
        counts = np.bincount(whose * len(CHARS) + kinds, minlength=n * len(CHARS)).reshape(n, len(CHARS)).astype(float)
        return counts / np.maximum(1, counts.sum(axis=1, keepdims=True))


def _sides(shares: np.ndarray) -> np.ndarray:
    """Shares as distributions of two sides."""
    return np.stack([shares, 1 - shares], axis=-1)


#: Texts with fewer function words of any listed language than this, and fewer odd words than that, are of a language not listed.
UNLISTED, READABLE = 0.05, 0.3
#: Profiles of each kind that are fitted.
PER_KIND = {"junk": 8, "list": 5, "prose": 4, "table": 5}


def _folded(words: np.ndarray) -> np.ndarray:
    """Function words counted as words."""
    out = words.copy()
    out[..., 3] += out[..., :3].sum(axis=-1)
    out[..., :3] = 0
    return out


def distances(words: np.ndarray, chars: np.ndarray, counts: np.ndarray, profiles: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """(text, profile): the sum of the divergences of words and of characters, and the mean one of the basic counts.

    A readable text with hardly a function word of any listed language is
    compared without them, so a language not listed doesn't count against it.
    """
    w, c, s = profiles
    told = divergence(words[:, None], w[None])
    unlisted = (words[:, :3].sum(axis=1) < UNLISTED) & (words[:, 5:].sum(axis=1) < READABLE)
    if unlisted.any():
        told[unlisted] = divergence(_folded(words[unlisted])[:, None], _folded(w)[None])
    return told + divergence(chars[:, None], c[None]) + divergence(_sides(counts)[:, None], _sides(s)[None]).mean(axis=-1)


def fit_profiles(texts: list[str], kinds: list[str], per_kind: dict[str, int] = PER_KIND, bound: int = 1500, seed: int = 1, rounds: int = 15) -> pd.DataFrame:
    """Structural profiles fitted to labelled texts: a row per profile, shares in percent.

    Of each kind at most `bound` texts (drawn by `seed`) are clustered about as
    many profiles as `per_kind` says: the first is any text, each next the text
    farthest from those there are; then texts go to their nearest profile and
    profiles to their texts' mean, `rounds` times.
    """
    measured, labels, rng = Measured(texts, {}), np.array(kinds), np.random.default_rng(seed)
    parts = (measured.words, measured.chars, measured.counts)
    rows = []
    for kind in sorted(per_kind):
        idx = rng.permutation(np.flatnonzero(labels == kind))[:bound]
        own = tuple(p[idx] for p in parts)
        chosen = [0]
        while len(chosen) < per_kind[kind]:
            chosen.append(int(distances(*own, tuple(p[chosen] for p in own)).min(axis=1).argmax()))
        middle = tuple(p[chosen] for p in own)
        for _ in range(rounds):
            nearest = distances(*own, middle).argmin(axis=1)
            middle = tuple(np.array([p[nearest == k].mean(axis=0) if (nearest == k).any() else m[k] for k in range(len(chosen))]) for p, m in zip(own, middle, strict=True))
        rows += [[kind, *np.concatenate([m[k] for m in middle]).round(2).tolist()] for k in range(len(chosen))]
    return pd.DataFrame(rows, columns=["kind", *[f"word_{x}" for x in WORDS], *[f"char_{x}" for x in CHARS], *[f"count_{x}" for x in COUNTS]])


@lru_cache(maxsize=1)
def fitted() -> tuple[list[str], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The kinds and distributions of the model that comes with this module (profiles.csv, made by fit_profiles)."""
    table = pd.read_csv(Path(__file__).with_name("profiles.csv"))
    part = lambda prefix: table[[c for c in table.columns if c.startswith(prefix)]].to_numpy(dtype=float)
    words, chars = part("word_"), part("char_")
    return table.kind.tolist(), (words / words.sum(axis=1, keepdims=True), chars / chars.sum(axis=1, keepdims=True), part("count_"))


COLUMNS = "doc_id long, n_chars int, n_lines int, n_words int, mean_word_length double, symbol_ratio double, line_punctuation_share double, common_word_share double, language string, function_word_divergence double, prose_divergence double, text_kind string"
#: Texts measured at once.
BATCH = 500


def statistics(texts: list[str | None], known: dict[str, int]) -> pd.DataFrame:
    """All statistics of each text (COLUMNS without doc_id); texts without a line have nil counts and no kind."""
    texts = [t or "" for t in texts]
    m = Measured(texts, known)
    kinds, profiles = fitted()
    apart = distances(m.words, m.chars, m.counts, profiles)
    blank = m.n_lines == 0
    symbols = m.chars[:, [CHARS.index("cell"), CHARS.index("other")]].sum(axis=1)
    prose = np.array([k == "prose" for k in kinds])
    told = lambda values: np.where(blank, None, values)
    return pd.DataFrame({
        "n_chars": m.n_chars, "n_lines": m.n_lines, "n_words": m.n_words, "mean_word_length": m.letters / np.maximum(1, m.n_words), "symbol_ratio": np.where(blank, 0.0, symbols), "line_punctuation_share": m.ends, "common_word_share": m.common,
        "language": np.where(m.common >= UNLISTED, np.array(LANGUAGES, dtype=object)[m.language], None), "function_word_divergence": np.where(blank, np.nan, m.apart), "prose_divergence": np.where(blank, np.nan, apart[:, prose].min(axis=1)), "text_kind": told(np.array(kinds, dtype=object)[apart.argmin(axis=1)]),
    })


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, int] = {}
    for pdf in batches:
        for at in range(0, len(pdf), BATCH):
            part = pdf.iloc[at : at + BATCH]
            out = statistics(list(part.text), known)
            out.insert(0, "doc_id", part.doc_id.to_numpy())
            yield out


def text_statistics(documents: DataFrame) -> DataFrame:
    """Basic counts and the nearest structural profile of every document.

    documents(doc_id, text). text_kind is prose, list, table or junk: the kind
    of the fitted profile with the least sum of Jensen-Shannon divergences from
    the text's distributions of words (its nearest language's function words by
    band, other words, numbers, odd words, words said again), of characters and
    of basic counts. The language is that whose own function words the text has most
    of; a text of a language not listed, or of another script, is compared
    without function words. Null, empty and blank texts have zero counts and a
    null kind. Of equally near profiles the alphabetically first kind is told.
    One pass without a shuffle; further columns are ignored, repeated rows are
    each measured.
    """
    return documents.select("doc_id", "text").mapInPandas(_measure, COLUMNS)
