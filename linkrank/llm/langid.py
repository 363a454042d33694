"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text is lower-cased, everything but letters becomes one blank, and its
character n-grams are counted in hashed dimensions. Vectors are sublinear
TF-IDF of length 1. Each language has several centroids from spherical k-means,
as its texts differ in kind; a text gets the language of the centroid with the
largest cosine. A text farther from it than that centroid's training texts is
marked as rejected.

The model is fitted on a bounded sample: about ``per_language`` texts of each
language, drawn by hash. Languages times clusters times dimensions bounds what
is broadcast: 1 MB for 4 languages, 52 MB for 200.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import stored

UNDETERMINED = "und"
DIMENSIONS = 1 << 14
SIZES = (1, 2, 3)
CLUSTERS = 4
PER_LANGUAGE = 1_500
ROUNDS = 12
REJECT_QUANTILE, REJECT_SLACK = 0.995, 1.15
CHUNK_CHARS, CHUNK_TEXTS = 1 << 19, 256
BLANK = 32


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; made once in a process."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, each run of non-letters one blank, blanks at both ends."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4")
    kept = np.where(_letters()[raw], raw, BLANK)
    blank = kept == BLANK
    first = np.ones(len(kept), bool)
    first[1:] = ~(blank[1:] & blank[:-1])
    return kept[first]


def _grams(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each n-gram size: the hashed dimension at each position of ``codes``."""
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, max(SIZES) + 1):
        if len(codes) < n:
            return
        h = h[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :].astype(np.uint64) + np.uint64(n)
        mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        if n in SIZES:
            yield n, (mixed >> np.uint64(40)).astype(np.int64) % DIMENSIONS


def counts(texts: list[str]) -> np.ndarray:
    """N-gram counts, one row of ``DIMENSIONS`` for each text. A long text comes in pieces, each n-gram in the one it starts in."""
    table = np.zeros((len(texts), DIMENSIONS), np.float32)
    rows = [letter_codes(t) for t in texts]
    long = [i for i, r in enumerate(rows) if len(r) > CHUNK_CHARS]
    for i in long:
        for at in range(0, len(rows[i]), CHUNK_CHARS):
            piece = rows[i][at : at + CHUNK_CHARS + max(SIZES) - 1]
            for n, dims in _grams(piece):
                starts = dims[:CHUNK_CHARS]
                if n == 1:
                    starts = starts[piece[: len(starts)] != BLANK]
                table[i] += np.bincount(starts, minlength=DIMENSIONS)
    rest = [i for i in range(len(rows)) if len(rows[i]) <= CHUNK_CHARS]
    if rest:
        _add(table, rest, [rows[i] for i in rest])
    return table


def _add(table: np.ndarray, owners: list[int], rows: list[np.ndarray]) -> None:
    codes = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    total = np.zeros(len(rows) * DIMENSIONS, np.int64)
    for n, dims in _grams(codes):
        inside = owner[: len(dims)] == owner[n - 1 :]
        if n == 1:
            inside &= codes != BLANK
        total += np.bincount((owner[: len(dims)] * DIMENSIONS + dims)[inside], minlength=len(total))
    table[owners] += total.reshape(len(rows), DIMENSIONS)


def in_chunks(texts: list[str]) -> Iterator[slice]:
    """Slices of ``texts`` with a bounded number of texts and characters."""
    start = held = 0
    for i, text in enumerate(texts):
        if i > start and (i - start >= CHUNK_TEXTS or held + len(text) > CHUNK_CHARS):
            yield slice(start, i)
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def weigh(table: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Counts to TF-IDF rows of length 1; a row without n-grams stays 0."""
    vectors = np.log1p(table) * idf
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(length > 0, length, 1)


def spherical_kmeans(vectors: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length 1 and each vector's cosine with its own; at most ``k``, fewer for few vectors."""
    rng = np.random.default_rng(seed)
    centroids = vectors[[int(rng.integers(len(vectors)))]]
    while len(centroids) < min(k, len(vectors)):
        nearest = (vectors @ centroids.T).max(axis=1)
        centroids = np.vstack([centroids, vectors[[int(nearest.argmin())]]])
    for _ in range(ROUNDS):
        owner = (vectors @ centroids.T).argmax(axis=1)
        sums = np.stack([vectors[owner == c].sum(axis=0) for c in range(len(centroids))])
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 0, sums / np.where(length > 0, length, 1), centroids)
    return centroids, (vectors @ centroids.T)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]  # of each centroid, sorted
    centroids: np.ndarray
    reach: np.ndarray  # largest accepted distance from each centroid
    idf: np.ndarray

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        found = pd.DataFrame({"lang_pred": UNDETERMINED, "score": 0.0, "rejected": True}, index=range(len(texts)))
        usable = [i for i, t in enumerate(texts) if t and self.languages and any(map(str.isalpha, t))]
        names = np.array(self.languages, dtype=object)
        chosen = [texts[i] for i in usable]
        for part in in_chunks(chosen):
            cosines = weigh(counts(chosen[part]), self.idf) @ self.centroids.T
            best = cosines.argmax(axis=1)
            score = np.clip(cosines[np.arange(len(best)), best], 0, 1)
            at = usable[part]
            found.loc[at, "lang_pred"] = names[best]
            found.loc[at, "score"] = score.astype(float)
            found.loc[at, "rejected"] = 1 - score > self.reach[best]
        return found


def _sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for part in in_chunks(list(batch["text"])):
            table = counts(list(batch["text"][part]))
            dims = [np.flatnonzero(row) for row in table]
            yield pd.DataFrame(
                {
                    "lang": batch["lang"][part].to_numpy(),
                    "dims": [d.tolist() for d in dims],
                    "n": [row[d].astype(int).tolist() for row, d in zip(table, dims, strict=True)],
                }
            )


def _clusters(idf: np.ndarray, k: int):
    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.iloc[np.argsort([hash((tuple(d), tuple(n))) for d, n in zip(group["dims"], group["n"], strict=True)])]
        table = np.zeros((len(group), DIMENSIONS), np.float32)
        for row, (dims, n) in enumerate(zip(group["dims"], group["n"], strict=True)):
            table[row, dims] = n
        vectors = weigh(table, idf).astype(np.float32)
        vectors = vectors[vectors.any(axis=1)]
        if not len(vectors):
            return pd.DataFrame({"lang": [], "centroid": [], "reach": []})
        centroids, cosines = spherical_kmeans(vectors, k, seed=0)
        owner = cosines.argmax(axis=1)
        rows = []
        for c, centroid in enumerate(centroids):
            own = 1 - cosines[owner == c, c]
            reach = np.quantile(own, REJECT_QUANTILE) * REJECT_SLACK if len(own) else 0.0
            rows.append((group["lang"].iloc[0], centroid.astype("<f4").tobytes(), float(min(1, reach))))
        return pd.DataFrame(rows, columns=["lang", "centroid", "reach"])

    return fit


def fit_languages(labelled: DataFrame, per_language: int = PER_LANGUAGE, clusters: int = CLUSTERS) -> LanguageModel:
    """Model from rows of ``doc_id, text, lang``; rows without text or language teach nothing.

    The sample takes each row of a language with the chance ``per_language`` /
    its rows, decided by a hash of the id.
    """
    usable = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    rows = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not rows:
        return LanguageModel([], np.zeros((0, DIMENSIONS)), np.zeros(0), np.zeros(DIMENSIONS))
    chance = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, per_language / n))) for k, n in sorted(rows.items())])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 20)) / float(1 << 20)
    sample = stored(usable.where(draw < chance).select("text", "lang").mapInPandas(_sparse, "lang string, dims array<int>, n array<int>"))
    seen = np.zeros(DIMENSIONS)
    for r in sample.select(F.explode("dims").alias("d")).groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect():
        seen[r["d"]] = r["n"]
    idf = np.log((1 + sample.count()) / (1 + seen)) + 1
    found = sample.groupBy("lang").applyInPandas(_clusters(idf, clusters), "lang string, centroid binary, reach double")
    model = sorted(found.collect(), key=lambda r: (r["lang"], r["centroid"]))
    return LanguageModel(
        [r["lang"] for r in model],
        np.stack([np.frombuffer(r["centroid"], "<f4") for r in model]) if model else np.zeros((0, DIMENSIONS)),
        np.array([r["reach"] for r in model]),
        idf,
    )


def language_of(text: Column, model: LanguageModel) -> Column:
    """``struct(lang_pred, score, rejected)`` of a text column."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield model.predict(batch.tolist())

    return predict(text)


def identify_languages(docs: DataFrame, labelled: DataFrame, **options) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row of ``docs``, learned from ``labelled``.

    A null text, one without a letter, or no language to learn from gives
    ``und`` with score 0, rejected. Equal cosines go to the first language by
    name. Texts of any length count whole. Repeated rows are kept; other columns
    are ignored; an empty table gives no rows.
    """
    model = fit_languages(labelled, **options)
    predicted = docs.select("doc_id", language_of(F.col("text"), model).alias("found"))
    return predicted.select("doc_id", "found.lang_pred", "found.score", "found.rejected")
