"""Evaluation passages inside training documents, found by spaced seeds."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import small
from ledgerloom.session import cut

#: The seeds' masks; a 0 is a position that is ignored.
MASKS = ((1, 1, 1, 1), (1, 1, 0, 1, 1), (1, 0, 1, 1, 0, 1), (1, 1, 0, 0, 1, 1), (1, 0, 1, 0, 1, 0, 1))
#: Items of fewer words than the first also have seeds of three words; of fewer than the second, only themselves as one seed.
SHORT, SHORTEST = 12, 7
#: A mismatching, left out or put in word costs this much against one for a match.
GAP_COST = 3
#: Matches, less costs, that stretches on one diagonal must have to be chained with others, and words that may lie between two.
STRETCH, GAP = 3, 3
#: Words that make a passage of several items a stock sentence.
STOCK_RUN = 6
#: Bits of the seed filter for each item seed, and at most; more seeds let more documents' seeds pass to the join, which is exact.
FILTER_BITS, MOST_BITS, PROBES = 64, 1 << 27, 4
#: Letters without a decomposition, as plain letters.
PLAIN = {"ł": "l", "đ": "d", "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i"}
#: Cyrillic and Greek letters that look like Latin ones.
LOOKALIKE = dict(zip("аеорсхуіѕјкмтнвαορντικ", "aeopcxyisjkmthbaopvtik", strict=True))
#: What scanners take for one another, brought to one letter.
SCANNED = {"0": "o", "1": "l", "i": "l", "|": "l", "5": "s", "8": "b"}
#: Odd multipliers of the words' hashes at a seed's places.
_MULTIPLIERS = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1)) & 0xFFFFFFFFFFFFFFFF | 1 for k in range(32)], dtype=np.uint64)

_BROKEN = re.compile(r"(?<=\w)[-‐‑­]\s*[\r\n]+\s*(?=\w)")
_WORD = re.compile(r"[^\W_]+")
_MARKS = re.compile(r"[̀-ͯ­͏​-‏‪-‮⁠-⁩︀-️﻿]")
_TABLE = str.maketrans(LOOKALIKE | PLAIN | SCANNED)
#: Documents read at once by a task.
BATCH = 1000
#: Words whose hashes a task remembers.
_REMEMBERED = 1_000_000


def words_of(text: str | None) -> list[str]:
    """Words of a text, without what the comparison disregards.

    Case, punctuation, diacritics, spacing, line breaks (also inside hyphenated
    words), look-alike letters and common scanning confusions don't count. Null
    and empty texts have no words.
    """
    if not text:
        return []
    if "\n" in text or "\r" in text:
        text = _BROKEN.sub("", text)
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    return _WORD.findall(text.lower().translate(_TABLE).replace("rn", "m").replace("vv", "w"))


def near(a: str, b: str) -> bool:
    """One scanning slip apart: at most one edit, two in words of nine letters and more; never between numbers."""
    if a == b:
        return True
    n, m = len(a), len(b)
    allowed = 2 if min(n, m) >= 9 else 1
    if min(n, m) < 4 or abs(n - m) > allowed or sum(c.isdigit() for c in b) * 2 > m:
        return False
    return _edits(a, b, allowed)


def _edits(a: str, b: str, allowed: int) -> bool:
    """a becomes b by `allowed` edits or fewer, which are tried where the two first part."""
    k, n, m = 0, len(a), len(b)
    least = min(n, m)
    while k < least and a[k] == b[k]:
        k += 1
    if k == n and k == m:
        return True
    if not allowed:
        return False
    x, y = a[k:], b[k:]
    return _edits(x[1:], y[1:], allowed - 1) or _edits(x[1:], y, allowed - 1) or _edits(x, y[1:], allowed - 1)


def may_be_near(a: str, b: str) -> bool:
    """A cheap test that near can only pass with."""
    least = min(len(a), len(b))
    return least >= 4 and abs(len(a) - len(b)) <= (2 if least >= 9 else 1) and (least >= 9 or a[0] == b[0] or a[-1] == b[-1])


def floor_of(n: int, share: float = 1 / 3) -> int:
    """Words that a piece of an item of n words must be worth: seven, fewer for items of which a third is less, all of the shortest."""
    return n if n < SHORTEST else max(3, min(SHORTEST, -int(-(n * share) // 1)))


def masks_of(n: int) -> list[tuple[int, ...]]:
    """The seeds' masks of an item of n words."""
    if n < SHORTEST:
        return [(1,) * n] if n else []
    return [*MASKS, (1, 1, 1)] if n < SHORT else list(MASKS)


class Hasher:
    """64-bit hashes of words, remembered."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > _REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.array([known[w] for w in words], dtype=np.uint64)


def seeds(hashes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Codes of a mask at each place of a run of word hashes, as signed 64-bit numbers."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    code = np.full(n, xxhash.xxh3_64_intdigest(bytes(mask)), dtype=np.uint64)
    for k, keep in enumerate(mask):
        if keep:
            code += hashes[k : k + n] * _MULTIPLIERS[k]
    code ^= code >> np.uint64(31)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    return (code ^ (code >> np.uint64(29))).view(np.int64)


def _read_items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hasher = Hasher()
    for pdf in batches:
        out = []
        for item_id, passage in zip(pdf.item_id, pdf.passage, strict=True):
            words = words_of(passage)
            if words:
                text = " ".join(words)
                out.append((item_id, xxhash.xxh3_64_intdigest(f"{item_id} {text}") >> 1, xxhash.xxh3_64_intdigest(text) >> 1, text, len(words), seeds(hasher(words), (1,) * STOCK_RUN).tolist()))
        yield pd.DataFrame(out, columns=["item_id", "item", "content", "words", "n", "runs"])


def items_of(items: DataFrame) -> DataFrame:
    """(item, item_id, words, n, stock) of each different item: its folded words, and the places that are stock.

    Stock are runs of STOCK_RUN words that items of other content share, told by
    one aggregation over all items' hashed runs. Items that are mostly one
    another's text are variants of one passage, not stock.
    """
    told = items.where("item_id is not null and passage is not null").select("item_id", "passage").mapInPandas(_read_items, "item_id long, item long, content long, words string, n int, runs array<long>")
    told = cut(told.dropDuplicates(["item"]))
    runs = told.select("item", "content", F.posexplode("runs").alias("at", "run"))
    shared = runs.groupBy("run").agg(F.min("content").alias("low"), F.max("content").alias("high")).where("low != high").select("run")
    places = runs.join(shared, "run").select("item", F.explode(F.sequence(F.col("at"), F.col("at") + STOCK_RUN - 1)).alias("place")).groupBy("item").agg(F.collect_set("place").alias("stock"))
    none = F.array().cast("array<int>")
    held = told.join(places, "item", "left").select("item", "item_id", "words", "n", F.coalesce("stock", none).alias("stock"))
    return cut(held.withColumn("stock", F.when(F.size("stock") * 2 <= F.col("n"), F.col("stock")).otherwise(none)))


def _item_seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hasher = Hasher()
    for pdf in batches:
        out = []
        for item, text, n, stock in zip(pdf["item"], pdf.words, pdf.n, pdf.stock, strict=True):
            hashes = hasher(text.split(" "))
            own = np.ones(n, dtype=np.int64)
            own[list(stock)] = 0
            held = np.concatenate([[0], np.cumsum(own)])
            for mask in masks_of(n):
                code = seeds(hashes, mask)
                at = np.flatnonzero(held[len(mask) :] > held[: n - len(mask) + 1])  # a seed of stock alone finds nothing that counts
                out.append(pd.DataFrame({"code": code[at], "item": item, "item_at": at.astype(np.int32)}))
        if out:
            yield pd.concat(out)


def seeds_of(items: DataFrame) -> DataFrame:
    """(code, item, item_at): the seeds of `items_of`, but those that lie in stock alone."""
    return items.mapInPandas(_item_seeds, "code long, item long, item_at int")


def _probe(code: np.ndarray, bits: int, k: int) -> np.ndarray:
    """The filter's k-th place of each code."""
    u = code.view(np.uint64)
    return ((u + np.uint64(k) * ((u >> np.uint64(32)) | np.uint64(1))) & np.uint64(bits - 1)).astype(np.int64)


def _marks(bits: int):
    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = np.unique(np.concatenate([_probe(pdf.code.to_numpy(dtype=np.int64), bits, k) for k in range(PROBES)]))
            yield pd.DataFrame({"word": at >> 6, "mark": (np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64)})

    return mark


def seed_filter(codes: DataFrame) -> np.ndarray:
    """A Bloom filter of all codes, as 64-bit words: made by an aggregation, MOST_BITS at most."""
    n = codes.count()
    bits = min(MOST_BITS, max(1 << 12, 1 << (FILTER_BITS * n).bit_length()))
    words = codes.select("code").mapInPandas(_marks(bits), "word long, mark long").groupBy("word").agg(F.bit_or("mark").alias("mark")).toPandas()
    out = np.zeros(bits >> 6, dtype=np.int64)
    out[words.word.to_numpy(dtype=np.int64)] = words.mark.to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def _scan(held, masks: list[tuple[int, ...]]):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, hasher = held.value, Hasher()
        bits = len(table) << 6
        for pdf in (whole.iloc[at : at + BATCH] for whole in batches for at in range(0, len(whole), BATCH)):
            told = [words_of(t) for t in pdf.text]
            sizes = np.array([len(w) for w in told], dtype=np.int64)
            ends = np.cumsum(sizes)
            whose = np.repeat(np.arange(len(told)), sizes)
            # All documents of the batch are one run of words; seeds across a border aren't any.
            hashes = hasher([w for words in told for w in words])
            doc, at, code = [], [], []
            for mask in masks:
                found = seeds(hashes, mask)
                inside = np.flatnonzero(whose[: len(found)] == whose[len(mask) - 1 :]) if len(found) else np.empty(0, dtype=np.int64)
                for k in range(PROBES):
                    spot = _probe(found[inside], bits, k)
                    inside = inside[(table[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1) == 1]
                doc.append(whose[inside])
                at.append(inside - (ends - sizes)[whose[inside]])
                code.append(found[inside])
            doc, at, code = np.concatenate(doc), np.concatenate(at), np.concatenate(code)
            order = np.argsort(doc, kind="stable")
            doc, at, code = doc[order], at[order], code[order]
            hit, first = np.unique(doc, return_index=True)
            if not len(hit):
                continue
            last = np.append(first[1:], len(doc))
            texts = [" ".join(told[k]) for k in hit]
            yield pd.DataFrame({
                "doc_id": pdf.doc_id.to_numpy()[hit], "text": [xxhash.xxh3_64_intdigest(t) >> 1 for t in texts], "words": texts,
                "ats": [at[a:b].astype(np.int32) for a, b in zip(first, last, strict=True)], "codes": [code[a:b] for a, b in zip(first, last, strict=True)],
            })

    return scan


def hit_documents(documents: DataFrame, codes: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    """(doc_id, text, words, ats, codes) of documents that may have a seed of an item: text is a hash of the words.

    Documents are read once, in map tasks; what the filter lets pass is little
    more than what the items' seeds hold, and the join with them decides.
    """
    held = documents.sparkSession.sparkContext.broadcast(seed_filter(codes))
    docs = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    return docs.mapInPandas(_scan(held, masks), "doc_id long, text long, words string, ats array<int>, codes array<long>")


def stretches(equal: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, worth) of maximal stretches worth STRETCH or more, a match counting 1 and a mismatch -GAP_COST."""
    found = []
    score = start = best = best_end = 0
    for k, e in enumerate(equal.tolist()):
        if score == 0 and e:
            start, best = k, 0
        if score or e:
            score += 1 if e else -GAP_COST
            if score > best:
                best, best_end = score, k + 1
            if score <= 0 or best - score > SHORTEST:
                if best >= STRETCH:
                    found.append((start, best_end, best))
                score = best = 0
    if best >= STRETCH:
        found.append((start, best_end, best))
    return found


def chained(parts: list[tuple[int, int, int, int]], least: int) -> list[list[tuple[int, int]]]:
    """Chains of stretches (start, end, shift, worth) worth `least` or more, as lists of (start, end) in the item.

    A stretch goes on another diagonal's if it follows it in the item and in the
    document with at most GAP words between on either side; each word left out,
    put in or told twice costs GAP_COST. The best chain that ends at each stretch
    is kept; a stretch in a longer chain ends none of its own.
    """
    parts = sorted(parts)
    worth, before, used = [p[3] for p in parts], [-1] * len(parts), [False] * len(parts)
    for j, (s, e, shift, own) in enumerate(parts):
        for i in range(j - 1, -1, -1):
            s0, e0, shift0, _ = parts[i]
            gap, gap_there = s - e0, (s + shift) - (e0 + shift0)
            if shift == shift0 or abs(gap) > GAP or abs(gap_there) > GAP or e <= e0 or s <= s0:
                continue
            reached = worth[i] + own - GAP_COST * (abs(shift - shift0) + max(0, -gap, -gap_there)) // 2
            if reached > worth[j] and reached > own:
                worth[j], before[j] = reached, i
    for i in before:
        if i >= 0:
            used[i] = True
    out = []
    for j in range(len(parts)):
        if not used[j] and worth[j] >= least:
            chain, k = [], j
            while k >= 0:
                chain.append((parts[k][0], parts[k][1]))
                k = before[k]
            out.append(chain)
    return out


def pieces_of(words: list[str], item: list[str], shifts: list[int]) -> list[np.ndarray]:
    """Places in the item of each of its pieces in the words, tolerating substitutions, slips and insertions around the seeds' diagonals."""
    n, parts = len(item), []
    least = floor_of(n)
    for shift in sorted(set(shifts)):
        a, b = max(0, -shift), min(n, len(words) - shift)
        here, there = words[a + shift : b + shift], item[a:b]
        equal = np.array([x == y for x, y in zip(here, there, strict=True)], dtype=bool)
        if equal.sum() < STRETCH - 1 and n >= SHORTEST:
            continue
        beside = np.zeros(len(equal), dtype=bool)
        beside[1:] |= equal[:-1]
        beside[:-1] |= equal[1:]
        for k in np.flatnonzero(~equal & beside).tolist():
            # A slip can only bridge or lengthen a piece beside a match.
            equal[k] = may_be_near(here[k], there[k]) and near(here[k], there[k])
        if n < SHORTEST:
            if equal.all() and len(equal) == n:
                return [np.arange(n, dtype=np.int32)]
            continue
        parts += [(a + s, a + e, shift, w) for s, e, w in stretches(equal)]
    return [np.unique(np.concatenate([np.arange(s, e, dtype=np.int32) for s, e in chain])) for chain in chained(parts, least)]


#: Cells of windows compared at once.
_CELLS = 4_000_000


class Bounds:
    """Upper bounds of what verification can find, for many pairs at once: which pairs may have a piece at all."""

    def __init__(self) -> None:
        self.hasher, self.shapes = Hasher(), {}

    def _flat(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All texts' words one after another, their hashes and shapes, and each text's start and size."""
        told = [t.split(" ") for t in texts]
        words = [w for t in told for w in t]
        shapes = self.shapes
        if len(shapes) > _REMEMBERED:
            shapes.clear()
        for w in set(words).difference(shapes):
            shapes[w] = (sum(map(w.count, "0123456789")) * 2 > len(w)) << 62 | min(len(w), 0xFFFFF) << 42 | ord(w[0]) << 21 | ord(w[-1])
        sizes = np.array([len(t) for t in told], dtype=np.int64)
        return words, self.hasher(words), np.array([shapes[w] for w in words], dtype=np.int64), np.cumsum(sizes) - sizes, sizes

    def possible(self, words: list[str], passages: list[str], shifts: list[np.ndarray], stocks: list[np.ndarray]) -> np.ndarray:
        """For each pair: may its stretches be worth its item's floor and hold more than stock?"""
        docs, items = list(dict.fromkeys(words)), list(dict.fromkeys(passages))
        at_doc, at_item = {t: k for k, t in enumerate(docs)}, {t: k for k, t in enumerate(items)}
        (dw, dh, ds, d0, dn), (iw, ih, is_, i0, in_) = self._flat(docs), self._flat(items)
        free = np.ones(len(ih), dtype=bool)
        for text, stock in {t: x for t, x in zip(passages, stocks, strict=True)}.items():
            free[i0[at_item[text]] + np.asarray(stock, dtype=np.int64)] = False
        which = np.repeat(np.arange(len(words)), [len(x) for x in shifts])
        shift = np.concatenate(shifts).astype(np.int64)
        doc, item = np.array([at_doc[t] for t in words])[which], np.array([at_item[t] for t in passages])[which]
        best, matches, some_ = np.zeros(len(which), dtype=np.int64), np.zeros(len(which), dtype=np.int64), np.zeros(len(which), dtype=bool)
        wide = int(in_.max())
        step = max(1, _CELLS // wide)
        for a in range(0, len(which), step):
            w, t = slice(a, a + step), np.arange(wide)
            there = shift[w, None] + t
            inside = (there >= 0) & (there < dn[doc[w], None]) & (t < in_[item[w], None])
            x, y = np.where(inside, d0[doc[w], None] + there, 0), np.where(inside, i0[item[w], None] + t, 0)
            equal = inside & (dh[x] == ih[y])
            beside = np.zeros_like(equal)
            beside[:, 1:] |= equal[:, :-1]
            beside[:, :-1] |= equal[:, 1:]
            r, c = np.nonzero(beside & inside & ~equal)
            p, q = ds[x[r, c]], is_[y[r, c]]
            n, m = (p >> 42) & 0xFFFFF, (q >> 42) & 0xFFFFF
            least = np.minimum(n, m)
            near_ = (least >= 4) & (q >> 62 == 0) & (np.abs(n - m) <= np.where(least >= 9, 2, 1)) & ((least >= 9) | ((p ^ q) & 0x1FFFFF == 0) | (((p ^ q) >> 21) & 0x1FFFFF == 0))
            r, c = r[near_], c[near_]
            # Each two words are compared once.
            both, first, back = np.unique(dh[x[r, c]] * _MULTIPLIERS[1] + ih[y[r, c]], return_index=True, return_inverse=True)
            slip = np.array([near(dw[i], iw[j]) for i, j in zip(x[r, c][first].tolist(), y[r, c][first].tolist(), strict=True)], dtype=bool)
            equal[r, c] = slip[back] if len(both) else False
            # What the best stretch through each match is worth: what ends there and what begins there.
            gain = np.where(equal, 1, -GAP_COST).astype(np.int16).T
            through = np.zeros_like(gain)
            score = np.zeros(len(equal), dtype=np.int16)
            for k in range(wide):
                score = np.maximum(0, score + gain[k])
                through[k] = score
            score[:] = 0
            for k in range(wide - 1, -1, -1):
                through[k] += score
                score = np.maximum(0, score + gain[k])
            some_[w] = through.max(axis=0) >= STRETCH
            through[~(equal & free[y]).T] = 0
            best[w], matches[w] = through.max(axis=0), equal.sum(axis=1)
        floors = np.array([floor_of(n) for n in in_.tolist()])[item]
        out = np.zeros(len(words), dtype=bool)
        out[which[best >= floors]] = True
        # Stretches of neighbouring diagonals may be chained.
        k = np.flatnonzero((np.diff(which) == 0) & (np.diff(shift) <= 2 * GAP) & some_[:-1] & some_[1:] & (np.maximum(best[:-1], best[1:]) >= STRETCH))
        held = np.zeros(len(words), dtype=np.int64)
        np.add.at(held, which, np.where(some_, matches, 0))
        out[which[k]] |= held[which[k]] >= floors[k]
        return out


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    bounds = Bounds()
    for pdf in batches:
        if not len(pdf):
            continue
        out = []
        shifts = [np.sort(np.asarray(x, dtype=np.int64)) for x in pdf.shifts]
        for k in np.flatnonzero(bounds.possible(list(pdf.words), list(pdf.passage), shifts, list(pdf.stock))).tolist():
            row = pdf.iloc[k]
            theirs = row.passage.split(" ")
            for places in pieces_of(row.words.split(" "), theirs, shifts[k].tolist()):
                own = np.setdiff1d(places, np.asarray(row.stock, dtype=np.int32))
                if len(own):
                    out.append((row.doc_id, row.item_id, row["item"], len(theirs), places, own, row.text))
        yield pd.DataFrame(out, columns=["doc_id", "item_id", "item", "item_words", "covered", "own", "text"])


def pieces_in(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, item, item_words, covered, own, text), a row per piece of an item in a document: its places in the item, those that aren't stock, and a hash of the document's words.

    The documents' seeds and the items' seeds are two tables of 8-byte hashes,
    joined on the hash; each pair that meets is verified word by word around the
    diagonals of its hits. Neither side is held by the driver; of the documents
    only those with a hit leave their map task. Rows with a null id or text give
    nothing.
    """
    told = items_of(items)
    codes = cut(seeds_of(told))
    short = [r.n for r in told.where(F.col("n") < SHORT).select(F.when(F.col("n") < SHORTEST, F.col("n")).otherwise(SHORTEST).alias("n")).distinct().collect()]
    masks = [*MASKS, *[(1, 1, 1) if n == SHORTEST else (1,) * n for n in sorted(short)]]
    docs = cut(hit_documents(documents, codes, list(dict.fromkeys(masks))))
    keyed = docs.select("doc_id", "text", F.explode(F.arrays_zip("codes", "ats")).alias("h")).select("doc_id", "text", F.col("h.codes").alias("code"), F.col("h.ats").alias("at"))
    met = keyed.join(small(codes), "code").groupBy("doc_id", "text", "item").agg(F.collect_set(F.col("at") - F.col("item_at")).alias("shifts"))
    pairs = met.join(docs.select("doc_id", "text", "words").dropDuplicates(["doc_id", "text"]), ["doc_id", "text"]).join(small(told.select("item", "item_id", "n", F.col("words").alias("passage"), "stock")), "item")
    return pairs.select("doc_id", "item_id", "item", "text", "words", "passage", "stock", "shifts").mapInPandas(_verify, "doc_id long, item_id long, item long, item_words int, covered array<int>, own array<int>, text long")


def _floor(n: Column, share: float) -> Column:
    """As floor_of, of a column."""
    return F.when(n < SHORTEST, n).otherwise(F.greatest(F.lit(3), F.least(F.lit(SHORTEST), F.ceil(n * share - 1e-9).cast("int"))))


def leaks(documents: DataFrame, items: DataFrame, share: float = 1 / 3, stock_share: float = 0.003) -> DataFrame:
    """Documents that contain an evaluation item, wholly or in pieces that make up `share` of it.

    documents(doc_id, text), items(item_id, passage); returns (doc_id, item_id,
    words, item_words, part). Seeds are the words at fixed masks' positions, so a
    substituted word doesn't hide a passage; a hit is verified word by word
    around its diagonal, tolerating slips, and stretches that a word put in or
    left out parts are chained. A piece is worth seven words or more, of items
    of fewer than 21 words a third of them; items of fewer than seven words are
    found whole. Stock sentences don't count by themselves: runs that several
    different items share, and places of an item that more different texts than
    `stock_share` of all documents have (five at least) without having a `share`
    of the item; copies of a text count once. Pieces that are the whole item
    count in any case. A piece with seven words (or its item's fewer) beside its
    stock counts whole, for then its words follow one another as in the item; of
    others only the words beside stock count. Documents and items of null or
    empty text give no rows; of repeated documents and items one row is told;
    ties don't arise; further columns are ignored; items of one text are each
    reported.
    """
    told = cut(pieces_in(documents, items))

    def united(rows: DataFrame) -> DataFrame:
        counted = F.when(F.size("own") >= _floor(F.col("item_words"), share), F.col("covered")).otherwise(F.col("own"))
        union = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
        both = rows.withColumn("counted", counted).groupBy("doc_id", "item_id", "item", "text", "item_words").agg(union("counted").alias("places"), union("covered").alias("whole"))
        return both.withColumn("places", F.when(F.size("whole") >= F.col("item_words"), F.col("whole")).otherwise(F.col("places")))

    alone = united(told).where(F.size("places") < share * F.col("item_words"))
    total = documents.agg(F.count(F.lit(1)).alias("docs"))
    common = alone.select("item", "text", F.explode("places").alias("at")).groupBy("item", "at").agg(F.count_distinct("text").alias("count")).where((F.col("count") >= 5) & (F.col("count") > stock_share * total.scalar()))
    stock = common.groupBy("item").agg(F.collect_set("at").alias("stock"))
    bare = told.join(stock, "item", "left").withColumn("own", F.array_except("own", F.coalesce("stock", F.array().cast("array<int>")))).drop("stock")
    words = F.size("places")
    hits = united(bare).where(words >= F.ceil(share * F.col("item_words") - 1e-9))
    best = hits.groupBy("doc_id", "item_id").agg(F.max(F.struct((words / F.col("item_words")).alias("part"), words.alias("words"), "item_words")).alias("m"))
    return best.select("doc_id", "item_id", "m.words", "m.item_words", "m.part")
