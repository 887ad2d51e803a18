"""Text functions as column expressions; fuzzy scores as vectorised functions."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _latin_bases() -> tuple[str, str]:
    """All small Latin letters that are a letter with marks, and their bases, by the Unicode tables."""
    letters = [chr(c) for c in range(0xC0, 0x250)] + [chr(c) for c in range(0x1E00, 0x1F00)]
    pairs = [(x, unicodedata.normalize("NFKD", x)[0]) for x in letters if x.islower() and unicodedata.decomposition(x) and not unicodedata.decomposition(x).startswith("<")]
    return "".join(x for x, _ in pairs), "".join(y for _, y in pairs)


_MARKED, _BASE = _latin_bases()


def fold(c: Column) -> Column:
    """Small letters without marks: precomposed Latin letters and combining marks, in the JVM."""
    return F.regexp_replace(F.translate(F.lower(c), _MARKED, _BASE), r"\p{M}+", "")


def words(c: Column) -> Column:
    """The words of a text as an array, empty for null."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def clean_name(c: Column) -> Column:
    """A name without leading enumeration, doubled blanks and trailing punctuation."""
    bare = F.regexp_replace(c, r"^\s*(\d{1,3}[.)]|[ivxIVX]{1,5}[.)]|[-–•*])\s+", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"\s+", " "), r"[\s:;,.]+$", ""))


def safe_id(c: Column) -> Column:
    """A slug: folded, everything but letters and digits one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def cut_at(c: Column, n: int) -> Column:
    """The first n characters."""
    return F.substring(c, 1, n)


def subset_of(needle: Column, hay: Column) -> Column:
    """Every word of one text is among the words of the other; an empty text isn't."""
    return (F.size(words(needle)) > 0) & (F.size(F.array_except(words(fold(needle)), words(fold(hay)))) == 0)


def json_inside(c: Column) -> Column:
    """The JSON object inside a text that also has prose, null if there is none that parses."""
    return F.to_json(F.try_parse_json(F.regexp_extract(c, r"(?s)\{.*\}", 0)))


def semantic_words(c: Column, aliases: dict[str, str], stop: tuple[str, ...]) -> Column:
    """Folded words that matter: stop words left out, aliases told by their main word, runs of single letters joined."""
    joined = F.regexp_replace(fold(c), r"(?<=\b[a-z])[.\s]+(?=[a-z]\b)", "")
    known = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv]) if aliases else None
    named = words(joined) if known is None else F.transform(words(joined), lambda w: F.coalesce(F.try_element_at(known, w), w))
    return F.array_distinct(F.filter(named, lambda w: ~w.isin(*stop) & (F.length(w) > 0)))


def means_the_same(a: Column, b: Column, aliases: dict[str, str], stop: tuple[str, ...]) -> Column:
    """All words that matter of one text are among the other's, either way; a text without any means nothing."""
    x, y = semantic_words(a, aliases, stop), semantic_words(b, aliases, stop)
    return (F.size(x) > 0) & (F.size(y) > 0) & ((F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0))


def near_keys(c: Column) -> Column:
    """The text and all texts with one letter less: two texts one edit apart share one of them."""
    return F.array_union(F.array(c), F.transform(F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1))), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c)))))


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit rows."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & places.get(ch, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """200 * LCS / (|a| + |b|); two empty texts are equal."""
    total = len(a) + len(b)
    return 100.0 if not total else 200.0 * _common_subsequence(a, b) / total


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio among the common words and the common words with either side's rest."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common = " ".join(sorted(x & y))
    if common and (x <= y or y <= x):
        return 100.0
    left, right = (" ".join(filter(None, (common, " ".join(sorted(s))))) for s in (x - y, y - x))
    return max(indel_ratio(left, right), indel_ratio(common, left) if common else 0.0, indel_ratio(common, right) if common else 0.0)


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text with an equally long part of the longer one."""
    short, long_ = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long_ else 0.0
    return max(indel_ratio(short, long_[i : i + len(short)]) for i in range(len(long_) - len(short) + 1))


def sequence_ratio(a: str, b: str) -> float:
    """Percent of letters in matching blocks, longest first (the standard library's measure)."""
    return 100.0 * SequenceMatcher(None, a, b, autojunk=False).ratio()


def token_sort_ratio(a: str, b: str) -> float:
    """The ratio of the sorted words."""
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


#: What word scores count for, and what partial ones do by how much longer one text is.
WORD_WEIGHT, PART_FROM, PART_WEIGHTS = 0.95, 1.5, ((8.0, 0.9), (float("inf"), 0.6))


def weighted_ratio(a: str, b: str) -> float:
    """The best of the plain, word-wise and, for texts of unlike length, partial ratios, each weighed."""
    if not a or not b:
        return 0.0
    plain = indel_ratio(a, b)
    longer = max(len(a), len(b)) / min(len(a), len(b))
    if longer < PART_FROM:
        return max(plain, WORD_WEIGHT * token_sort_ratio(a, b), WORD_WEIGHT * token_set_ratio(a, b))
    part = next(w for bound, w in PART_WEIGHTS if longer < bound)
    x, y = (" ".join(sorted(t.split())) for t in (a, b))
    return max(plain, part * partial_ratio(a, b), WORD_WEIGHT * part * partial_ratio(x, y), WORD_WEIGHT * part * (100.0 if set(a.split()) & set(b.split()) else 0.0))


def _vectorised(score):
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else round(score(x, y), 6) for x, y in zip(a, b, strict=True)], dtype="float64")

    return run


def fuzzy(name: str):
    """The column function of a score: indel, token_set, token_sort, partial, weighted or sequence."""
    return _vectorised({"indel": indel_ratio, "token_set": token_set_ratio, "token_sort": token_sort_ratio, "partial": partial_ratio, "weighted": weighted_ratio, "sequence": sequence_ratio}[name])
