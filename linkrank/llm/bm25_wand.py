"""Benchmark decontamination: BM25 over test items, every training passage a query.

The items are the indexed documents. Impacts are divided by the item's score
for itself, so a passage that holds the whole item scores 1, and one threshold
serves all items. For each block of items a term keeps its largest impact
there. A passage's terms of least weight are set aside as long as together they
cannot make up ``SLACK``; the other terms' block maxima plus that bound are an
upper bound for every item of a block, and only blocks that may reach the
threshold are scored. So all items above the threshold are found, none by luck.

A passage of ``PASSAGE`` words cannot reach the threshold of a much longer item.
So an item of more than ``PIECE`` words is also indexed by overlapping pieces,
each with its own score for itself. Every run of ``PIECE`` words lies in one
passage, and a found piece makes its whole item a candidate.

Most passages are set aside before that. Words that many items have are light:
together they give no item more than ``LIGHT`` of its score. A passage whose
other words cannot make up the rest is not looked at further.

Found items are verified on the whole text, however long: of the item's 5-word shingles, four
fifths must stand in the document, and half of those of the question and of the
answer, which is the last quarter of the item's words.

Items are a reference set that does not grow with the corpus. They are indexed
in parts of ``PART_ITEMS``, each sent to the tasks; the corpus is not shuffled.
Term weights come from all items, so scores do not depend on the parts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")
SHINGLE = 5
K1, B = 1.2, 0.75
THRESHOLD, SLACK, LIGHT = 0.5, 0.15, 0.25
BLOCK = 16
PASSAGE, STRIDE = 128, 64
PIECE, PIECE_STRIDE = 64, 32  # PASSAGE - STRIDE words at most
LEAK, LEAK_PART = 0.8, 0.5
ANSWER_PART = 4
PART_ITEMS = 20_000
SEGMENT_CHARS = 1 << 19
FOUND = "array<struct<item_id: long, score: double, question_found: int, question_shingles: int, answer_found: int, answer_shingles: int>>"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def shingles(words: list[str]) -> list[tuple[str, ...]]:
    k = min(SHINGLE, len(words))
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)] if words else []


def answer_from(n_words: int) -> int:
    """Shingles from this one on hold words of the answer."""
    k = min(SHINGLE, n_words)
    return max(0, n_words - -(-n_words // ANSWER_PART) - k + 1)


def pieces_of(words: list[str]) -> list[list[str]]:
    """What an item is indexed by: all of its words and, of a long item, overlapping pieces."""
    if len(words) <= PIECE:
        return [words]
    last = len(words) - PIECE
    return [words, *(words[at : at + PIECE] for at in [*range(0, last, PIECE_STRIDE), last])]


@dataclass
class Postings:
    """Rows of (number, impact) for each term, one after the other."""

    start: np.ndarray
    number: np.ndarray
    impact: np.ndarray

    @classmethod
    def of(cls, lists: list[list[tuple[int, float]]]) -> Postings:
        start = np.cumsum([0] + [len(x) for x in lists])
        flat = [p for x in lists for p in x]
        return cls(start, np.array([p[0] for p in flat], np.int64), np.array([p[1] for p in flat], np.float64))

    def rows(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all rows of ``terms``, and which of ``terms`` each belongs to."""
        size = self.start[terms + 1] - self.start[terms]
        owner = np.repeat(np.arange(len(terms)), size)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        return self.start[terms][owner] + inside, owner


class Statistics:
    """Number of items with words, their mean length, and the items by term."""

    def __init__(self, texts: Iterable[str]) -> None:
        self.items, self.words = 0, 0
        self.spread: Counter[str] = Counter()
        for text in texts:
            w = words_of(text)
            self.items += bool(w)
            self.words += len(w)
            self.spread.update(set(w))

    @property
    def mean(self) -> float:
        return self.words / max(1, self.items)

    def idf(self, term: str) -> float:
        n = self.spread[term]
        return float(np.log1p((self.items - n + 0.5) / (n + 0.5)))


@dataclass
class ItemIndex:
    ids: list[int | None]
    item_of: np.ndarray  # item of each piece; postings have numbers of pieces
    shingles: list[list[tuple[str, ...]]]
    answers: list[int]
    vocabulary: dict[str, int]
    items: Postings
    blocks: Postings
    highest: np.ndarray  # largest impact of each term
    n_blocks: int = field(default=0)
    light: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    light_most: float = 0.0  # of any piece's score, by light words

    @classmethod
    def build(cls, rows: list[tuple[int | None, str]], statistics: Statistics | None = None) -> ItemIndex:
        """Index of ``rows``; ``statistics`` are those of all items where ``rows`` are a part of them."""
        known = statistics or Statistics(text for _, text in rows)
        counted = [(i, w, Counter(w)) for i, text in rows if (w := words_of(text))]
        terms = dict.fromkeys(t for _, _, c in counted for t in c)
        idf = {t: known.idf(t) for t in terms}
        mean = known.mean
        vocabulary = {t: i for i, t in enumerate(terms)}
        postings: list[list[tuple[int, float]]] = [[] for _ in vocabulary]
        pieces = [(j, p) for j, (_, w, _) in enumerate(counted) for p in pieces_of(w)]
        for number, (_, w) in enumerate(pieces):
            c = Counter(w)
            norm = K1 * (1 - B + B * len(w) / mean)
            impact = {t: idf[t] * n * (K1 + 1) / (n + norm) for t, n in c.items()}
            own = sum(impact.values())
            for t, value in impact.items():
                postings[vocabulary[t]].append((number, value / own))
        tops = []
        for row in postings:
            best: dict[int, float] = {}
            for number, value in row:
                best[number // BLOCK] = max(value, best.get(number // BLOCK, 0.0))
            tops.append(sorted(best.items()))
        return cls(
            [i for i, _, _ in counted],
            np.array([j for j, _ in pieces], np.int64),
            [shingles(w) for _, w, _ in counted],
            [answer_from(len(w)) for _, w, _ in counted],
            vocabulary,
            Postings.of(postings),
            Postings.of(tops),
            np.array([max(v for _, v in row) for row in postings]),
            -(-len(pieces) // BLOCK),
            *_light(postings, len(pieces)),
        )

    def retrieve(self, terms: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``owner, piece, score`` of all scores from the threshold on, for distinct (owner, term) pairs sorted by owner."""
        nothing = np.zeros(0, np.int64)
        n_owners = int(owner[-1]) + 1 if len(owner) else 0
        bound = np.bincount(owner, self.highest[terms], n_owners)
        alive = bound[owner] >= THRESHOLD
        terms, owner = terms[alive], owner[alive]
        if not len(terms):
            return nothing, nothing, nothing.astype(float)
        order = np.lexsort((self.highest[terms], owner))
        terms, owner = terms[order], owner[order]
        upto = np.cumsum(self.highest[terms])
        opening = np.ones(len(owner), bool)
        opening[1:] = owner[1:] != owner[:-1]
        before = np.maximum.accumulate(np.where(opening, upto - self.highest[terms], 0))
        light = upto - before < SLACK
        aside = np.bincount(owner[light], self.highest[terms[light]], n_owners)
        rows, of = self.blocks.rows(terms[~light])
        cell, back = np.unique(owner[~light][of] * self.n_blocks + self.blocks.number[rows], return_inverse=True)
        reach = np.bincount(back, self.blocks.impact[rows], len(cell)) + aside[cell // self.n_blocks]
        cell = cell[reach >= THRESHOLD]
        if not len(cell):
            return nothing, nothing, nothing.astype(float)
        chosen = np.isin(owner, cell // self.n_blocks)
        terms, owner = terms[chosen], owner[chosen]
        rows, of = self.items.rows(terms)
        here = np.isin(owner[of] * self.n_blocks + self.items.number[rows] // BLOCK, cell)
        rows, of = rows[here], of[here]
        pair, back = np.unique(owner[of] * len(self.item_of) + self.items.number[rows], return_inverse=True)
        score = np.bincount(back, self.items.impact[rows], len(pair))
        pair, score = pair[score >= THRESHOLD], score[score >= THRESHOLD]
        return pair // len(self.item_of), pair % len(self.item_of), score

    def candidates(self, words: list[list[str]]) -> dict[tuple[int, int], float]:
        """Best score of each (text, item) over the passages of each text and the pieces of each item."""
        get = self.vocabulary.get
        if not self.vocabulary:
            return {}
        passage, term, text_of = [], [], []
        weight = np.where(self.light, 0.0, self.highest)
        enough = THRESHOLD - self.light_most - 1e-9
        for i, w in enumerate(words):
            ids = np.fromiter(map(get, w, repeat(-1)), np.int64, len(w))
            at = np.flatnonzero(ids >= 0)
            if not len(at):
                continue
            own = weight[ids[at]]
            if own.sum() < enough:
                continue
            last = max(0, -(-(len(w) - PASSAGE) // STRIDE))  # number of the last passage
            stretch = np.bincount(at // STRIDE, own, last + PASSAGE // STRIDE + 1)
            reach = sum(stretch[shift : shift + last + 1] for shift in range(PASSAGE // STRIDE))
            for p in np.flatnonzero(reach >= enough).tolist():
                known = np.unique(ids[p * STRIDE : p * STRIDE + PASSAGE])
                known = known[known >= 0]
                passage.append(np.full(len(known), len(text_of)))
                term.append(known)
                text_of.append(i)
        if not passage:
            return {}
        owner, piece, score = self.retrieve(np.concatenate(term), np.concatenate(passage))
        item = self.item_of[piece]
        best: dict[tuple[int, int], float] = {}
        for o, j, s in zip(owner.tolist(), item.tolist(), score.tolist(), strict=True):
            best[text_of[o], j] = max(s, best.get((text_of[o], j), 0.0))
        return best

    def _hits(self, words: list[str], items: list[int]) -> Iterator[tuple[int, set[int]]]:
        """For each of ``items`` the numbers of its shingles that stand in ``words``."""
        there: dict[int, set[tuple[str, ...]]] = {}
        for j in items:
            own = self.shingles[j]
            k = len(own[0])
            if k not in there:
                there[k] = set(_runs(words, k))
            yield j, {n for n, s in enumerate(own) if s in there[k]}

    def leaks(self, texts: list[str | None]) -> list[list[tuple]]:
        """The verified items of each text, by item id."""
        scores: dict[tuple[int, int], float] = {}
        found: dict[tuple[int, int], set[int]] = {}
        long = [i for i, t in enumerate(texts) if t and len(t) > SEGMENT_CHARS]
        for owners, words in _batches([None if t and len(t) > SEGMENT_CHARS else t for t in texts]):
            wanted: dict[int, list[int]] = {}
            for (i, j), score in self.candidates(words).items():
                scores[owners[i], j] = score
                wanted.setdefault(i, []).append(j)
            for i, items in wanted.items():
                for j, hits in self._hits(words[i], items):
                    found[owners[i], j] = hits
        # An item may be found in one part of a long text and stand in others too.
        for i in long:
            for words in _parts(texts[i]):
                for (_, j), score in self.candidates([words]).items():
                    scores[i, j] = max(score, scores.get((i, j), 0.0))
            items = [j for owner, j in scores if owner == i]
            for words in _parts(texts[i]) if items else ():
                for j, hits in self._hits(words, items):
                    found.setdefault((i, j), set()).update(hits)
        result: list[list[tuple]] = [[] for _ in texts]
        for (i, j), hits in found.items():
            total, split = len(self.shingles[j]), self.answers[j]
            question = sum(n < split for n in hits)
            answer = len(hits) - question
            parts = question >= LEAK_PART * split and answer >= LEAK_PART * (total - split)
            if parts and len(hits) >= LEAK * total:
                result[i].append((self.ids[j], scores[i, j], question, split, answer, total - split))
        return [sorted(r, key=lambda x: (x[0] is None, x[0] or 0)) for r in result]


def _runs(words: list[str], k: int) -> Iterator[tuple[str, ...]]:
    return (tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def _light(postings: list[list[tuple[int, float]]], n_pieces: int) -> tuple[np.ndarray, float]:
    """Which words are light, taken from the one in most pieces on, and the most that a piece owes to them."""
    light, sums = np.zeros(len(postings), bool), np.zeros(n_pieces)
    for t in sorted(range(len(postings)), key=lambda t: (-len(postings[t]), t)):
        numbers = np.array([n for n, _ in postings[t]], np.int64)
        more = sums[numbers] + np.array([v for _, v in postings[t]])
        if more.max() > LIGHT:
            break
        sums[numbers] = more
        light[t] = True
    return light, float(sums.max(initial=0.0))


def _batches(texts: list[str | None]) -> Iterator[tuple[list[int], list[list[str]]]]:
    """Words of the texts, some ``SEGMENT_CHARS`` at a time."""
    owners: list[int] = []
    words: list[list[str]] = []
    held = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        owners.append(i)
        words.append(words_of(text))
        held += len(text)
        if held >= SEGMENT_CHARS:
            yield owners, words
            owners, words, held = [], [], 0
    if owners:
        yield owners, words


def _parts(text: str) -> Iterator[list[str]]:
    """Words of a long text in parts that overlap by a passage."""
    tail: list[str] = []
    for start, end in _cuts(text):
        words = tail + words_of(text[start:end])
        yield words
        tail = words[-PASSAGE:]


def _cuts(text: str) -> Iterator[tuple[int, int]]:
    start = 0
    while len(text) - start > SEGMENT_CHARS:
        end = start + SEGMENT_CHARS
        while end < len(text) and not text[end].isspace():
            end += 1
        yield start, end
        start = end
    if start < len(text):
        yield start, len(text)


def indexes(items: DataFrame, part_items: int = PART_ITEMS) -> list[ItemIndex]:
    """Indexes of ``item_id, text``, some ``part_items`` in each; items without words are left out."""
    rows = items.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    parts = max(1, -(-rows.count() // part_items))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    chosen = [[(r["item_id"], r["text"]) for r in rows.where(part == n).collect()] for n in range(parts)]
    statistics = Statistics(text for some in chosen for _, text in some)
    return [ItemIndex.build(sorted(some, key=lambda r: (r[0] is None, r[0] or 0, r[1])), statistics) for some in chosen]


def leaked_items(text: Column, parts: list[ItemIndex]) -> Column:
    """The items that stand in a text, an array of structs as in ``FOUND``; null and empty texts hold none."""

    def search(index: ItemIndex) -> Column:
        @F.pandas_udf(FOUND)
        def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            names = ["item_id", "score", "question_found", "question_shingles", "answer_found", "answer_shingles"]
            for batch in batches:
                yield pd.Series([[dict(zip(names, x, strict=True)) for x in row] for row in index.leaks(batch.tolist())], dtype=object)

        return leaks(text)

    return F.concat(*[search(index) for index in parts])


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """A row for each document row and test item that stands in it: ``doc_id, item_id, score`` and the shingle counts.

    Words are runs of letters, digits and underscores in lower case. Repeated
    document rows and repeated items each give rows of their own; null ids are
    kept. Null and empty texts hold nothing and are held by nothing. A document
    of any length is judged as a whole. Empty tables give no rows; other
    columns, whatever their names, are ignored.
    """
    found = docs.select("doc_id", F.explode(leaked_items(F.col("text"), indexes(items))).alias("leak"))
    return found.select("doc_id", "leak.*")


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a test item; all columns stay.

    Null and empty texts stay, as do all rows if there are no items; of repeated rows all go or stay.
    """
    return docs.where(F.size(leaked_items(F.col("text"), indexes(items))) == 0)
