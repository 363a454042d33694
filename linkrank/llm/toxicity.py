"""Toxicity by weak supervision.

Voters: words and word beginnings that labelled toxic texts have far more often
than clean ones (each votes "toxic" where it occurs) or far less often (each
votes "clean"), a general list of insults, patterns of tone, and the silence of
all others. A generative label model estimates for every voter how often it
fires in toxic and in clean texts (EM; labels start it and are then one weak
voter more) and how it is correlated with the others given the class;
correlated voters share their weight. Its posteriors, not the labels, are the
targets of a logistic regression on voters, counts and density, which scores
whole texts.

All fitting is on bounded samples: ``per_class`` labelled texts of each class
and ``unlabelled`` others, drawn by hash. ``MAX_VOTERS`` bounds the terms that
vote "toxic" and ``MAX_CLEAN`` those that vote "clean"; the weakest go first, and
a text with none but those has no vote. Scoring keeps nothing but that table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import stored
from linkrank.session import discard_checkpoint

PER_CLASS, UNLABELLED = 6_000, 4_000
MAX_VOTERS, MAX_CLEAN = 384, 64
# Of a million terms that tell nothing, less than one reaches this log-likelihood ratio.
MIN_PRECISION, MIN_RATIO = 0.7, 25.0
PREFIXES = (4, 5, 6)
SHARE = 1 << 20
THRESHOLD = 0.3
BLOCK = 1024
EM_ROUNDS, LABEL_TRUST, SMOOTHING = 8, 0.9, 1.0
WORD = re.compile(r"[^\W\d_]+")

# Common insults and hostile words.
INSULTS = frozenset(
    "arsehole asshole bastard bitch clown coward creep degenerate disgusting dumb dumbass fool freak garbage idiot"
    " imbecile jerk loser lunatic moron pathetic pig retard scum scumbag stupid trash ugly vermin worthless"
    " abschaum arschloch depp dreckskerl dummkopf hurensohn idiotisch schwachkopf trottel"
    " abruti connard crétin débile imbécile ordure salaud"
    " basura cabrón estúpido gilipollas idiota imbécil inútil pendejo".split()
)
SHOUT = re.compile(r"\b[^\W\d_a-zß-ÿ]{3,}\b")
EXCLAIM = re.compile(r"[!?]{2,}")
ADDRESS = re.compile(r"\b(?:you(?:'re| are)?|your|du bist|tu es|eres)\s+(?:an?\s+|so\s+|ein[e]?\s+|une?\s+|un\s+)?([^\W\d_]+)", re.IGNORECASE)
MASKED = re.compile(r"\b[^\W\d_]+[*@#$]{1,3}[^\W\d_]+\b")
TONE = ("insult", "address", "shout", "exclaim", "masked")


def terms(text: str) -> tuple[set[str], int]:
    """The distinct words and marked word beginnings of a text, and its number of words."""
    found = WORD.findall(text.lower())
    words = set(found)
    begun = {w[:n] + "-" for w in words for n in PREFIXES if len(w) > n}
    return words | begun, len(found)


def tone(text: str, words: set[str], n: int) -> list[int]:
    """Which of the ``TONE`` patterns fire."""
    return [
        int(not INSULTS.isdisjoint(words)),
        int(any(m.lower() in INSULTS for m in ADDRESS.findall(text))),
        int(n > 0 and len(SHOUT.findall(text)) > 0.3 * n),
        int(bool(EXCLAIM.search(text))),
        int(bool(MASKED.search(text))),
    ]


@dataclass(frozen=True)
class ToxicityModel:
    voters: list[str]  # those that vote "toxic"
    clean: list[str]  # those that vote "clean"
    weights: np.ndarray  # of both, the tone patterns, any toxic voter, log count, density
    bias: float

    def features(self, texts: list[str | None]) -> np.ndarray:
        """A row for each text, from all of it."""
        index = {v: i for i, v in enumerate(self.voters + self.clean)}
        n_toxic = len(self.voters)
        table = np.zeros((len(texts), len(index) + len(TONE) + 3))
        lengths = sorted({len(v) - 1 for v in index if v.endswith("-")})
        for row, text in zip(table, texts, strict=True):
            if not text:
                continue
            found = WORD.findall(text.lower())
            hits = 0
            for word, times in Counter(found).items():
                fired = False
                if (i := index.get(word)) is not None:
                    row[i] = True
                    fired = i < n_toxic
                for n in lengths:
                    if len(word) > n and (i := index.get(word[:n] + "-")) is not None:
                        row[i] = True
                        fired |= i < n_toxic
                hits += times * fired
            row[len(index) : -3] = tone(text, set(found), len(found))
            row[-3:] = hits > 0, np.log1p(hits), min(1.0, 10 * hits / max(1, len(found)))
        return table

    def score(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights + self.bias, -35, 35)))


def _count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each class that have a term, summed over the batch."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            counts[int(toxic)].update(terms(text)[0])
        names = list(counts[0] | counts[1])
        yield pd.DataFrame({"term": names, "clean": [counts[0][t] for t in names], "toxic": [counts[1][t] for t in names]})


def choose_voters(sample: DataFrame, sizes: dict[int, int]) -> tuple[list[str], list[str]]:
    """The terms that tell toxic and clean labelled texts best by log-likelihood ratio, most telling first; ties by term."""
    counts = sample.mapInPandas(_count_terms, "term string, clean long, toxic long").groupBy("term")
    summed = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n_clean, n_toxic = sizes[0], sizes[1]
    precision = (F.col("toxic") / n_toxic) / (F.col("toxic") / n_toxic + F.col("clean") / n_clean)
    ratio = F.lit(0.0)
    for has, n in (("clean", n_clean), ("toxic", n_toxic)):
        overall = (F.col("clean") + F.col("toxic")) / (n_clean + n_toxic)
        lacks = n - F.col(has)
        ratio += F.when(F.col(has) > 0, 2 * F.col(has) * F.log(F.col(has) / (overall * n))).otherwise(0.0)
        ratio += F.when(lacks > 0, 2 * lacks * F.log(lacks / ((1 - overall) * n))).otherwise(0.0)
    telling = stored(summed.withColumns({"ratio": ratio, "precision": precision}).where(F.col("ratio") >= MIN_RATIO))
    best = lambda side, most: [r["term"] for r in telling.where(side).orderBy(F.desc("ratio"), "term").limit(most).collect()]
    chosen = best(F.col("precision") >= MIN_PRECISION, MAX_VOTERS), best(F.col("precision") <= 1 - MIN_PRECISION, MAX_CLEAN)
    discard_checkpoint(telling)
    return chosen


def label_model(votes: np.ndarray, labels: np.ndarray, base_rate: float) -> np.ndarray:
    """Posterior chance of toxic for each row of 0/1 ``votes``.

    ``labels`` is 0, 1 or -1 (none). Per voter, EM estimates the firing rate in
    either class; a voter that does not fire abstains, and one more voter fires
    where all others abstain. The covariances of the voters' residuals within the classes
    give correlations; a voter's log-likelihood ratio is divided by one plus the
    sum of its positive correlations with others, so that a word and its
    beginning count once. Labels start the estimates; afterwards a label counts
    as one more voter that is right with a chance of ``LABEL_TRUST``, whom the
    others can outvote.
    """
    votes = np.hstack([votes, votes.sum(axis=1, keepdims=True) == 0])
    known = labels >= 0
    given = np.where(labels == 1, LABEL_TRUST, 1 - LABEL_TRUST)
    prior = np.log(base_rate / (1 - base_rate))
    posterior = np.where(known, given, base_rate)
    fit = known.copy()
    discount = np.ones(votes.shape[1])
    for _ in range(EM_ROUNDS):
        toxic, clean = posterior[fit], 1 - posterior[fit]
        chosen = votes if fit.all() else votes[fit]
        fire_toxic = (toxic @ chosen + SMOOTHING * 0.1) / (toxic.sum() + SMOOTHING)
        fire_clean = (clean @ chosen + SMOOTHING * 0.01) / (clean.sum() + SMOOTHING)
        residual = np.empty(chosen.shape)  # by blocks: the driver holds few tables of this size at once
        for i in range(0, len(chosen), BLOCK):
            rows = slice(i, i + BLOCK)
            residual[rows] = chosen[rows] - np.outer(toxic[rows], fire_toxic) - np.outer(clean[rows], fire_clean)
        deviation = residual.std(axis=0)
        correlation = (residual.T @ residual) / len(residual) / np.maximum(np.outer(deviation, deviation), 1e-9)
        del residual
        np.fill_diagonal(correlation, 0)
        discount = 1 + np.where(correlation > 0.1, correlation, 0).sum(axis=1)
        fired = np.log(fire_toxic / fire_clean) / discount
        odds = prior + votes @ fired
        by_label = np.where(known, np.log(given / (1 - given)), 0.0)
        posterior = 1 / (1 + np.exp(-np.clip(odds + by_label, -30, 30)))
        fit = np.ones(len(votes), bool)
    return posterior


def logistic(features: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weighted logistic regression on soft targets by Newton steps."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    penalty = np.full(x.shape[1], ridge)
    penalty[-4:] = ridge / 100  # any voter, count and density hold for all voters
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        gradient = x.T @ (weight * (p - target)) + penalty * w
        curvature = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curvature, gradient)
        w -= step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _drawn(doc_id: Column, share: float, salt: str) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit(salt)), F.lit(SHARE)) < int(share * SHARE)


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, unlabelled: int = UNLABELLED) -> ToxicityModel:
    """Model from ``docs`` and ``labels`` (``doc_id, toxic``).

    Documents with several labels count as toxic if one says so; null labels
    and texts teach nothing. Without labels of both classes the model scores
    everything with the base rate (0 if there are no labels).
    """
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    base_rate = sizes.get(1, 0) / max(1, sum(sizes.values()))
    nothing = np.zeros(len(TONE) + 3)
    if len(sizes) < 2:
        return ToxicityModel([], [], nothing, 30.0 if base_rate else -30.0)
    picked = F.when(F.col("toxic") == 1, _drawn(F.col("doc_id"), min(1.0, per_class / sizes[1]), "labelled")).otherwise(
        _drawn(F.col("doc_id"), min(1.0, per_class / sizes[0]), "labelled")
    )
    ids = known.where(picked)  # about 2 * per_class short rows, so it may be broadcast
    texts = docs.select("doc_id", "text").where("text is not null")
    sample = stored(texts.join(F.broadcast(ids), "doc_id").select("text", "toxic"))
    drawn = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(drawn) < 2:
        return ToxicityModel([], [], nothing, float(np.log(base_rate / (1 - base_rate))))
    voters, clean = choose_voters(sample, drawn)
    total = docs.count()
    others = texts.where(_drawn(F.col("doc_id"), min(1.0, unlabelled / max(1, total)), "unlabelled")).select(
        "text", F.lit(-1).alias("toxic")
    )
    blank = ToxicityModel(voters, clean, np.zeros(0), 0.0)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = blank.features(batch["text"].tolist())
            yield pd.DataFrame({"toxic": batch["toxic"], "row": [r.astype("<f4").tobytes() for r in rows]})

    table = sample.unionByName(others).mapInPandas(vectors, "toxic int, row binary").collect()
    table.sort(key=lambda r: (r["toxic"], r["row"]))
    label = np.array([r["toxic"] for r in table])
    features = np.stack([np.frombuffer(r["row"], "<f4") for r in table]).astype(float)
    del table
    posterior = label_model(features[:, :-3], label, base_rate)
    # The classes were drawn at different rates; weights bring the base rate back.
    share = {1: sizes[1] / drawn[1], 0: sizes[0] / drawn[0], -1: sizes[1] / drawn[1]}
    weights, bias = logistic(features, posterior, np.array([share[k] for k in label]))
    return ToxicityModel(voters, clean, weights, bias)


def toxicity(text: Column, model: ToxicityModel) -> Column:
    """Chance, 0 to 1, that a text is labelled toxic; null counts as empty."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = batch.tolist()
            yield pd.Series(np.concatenate([model.score(texts[i : i + 512]) for i in range(0, len(texts), 512)]) if texts else [])

    return scored(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs``; ``predicted`` is 1 from ``threshold`` on.

    Empty and null texts get the score of a text without any voter. Repeated
    rows are kept; other columns are ignored.
    """
    model = fit_toxicity(docs, labels, **options)
    scored = docs.select("doc_id", toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    return docs.where(toxicity(F.col("text"), fit_toxicity(docs, labels, **options)) < threshold)
