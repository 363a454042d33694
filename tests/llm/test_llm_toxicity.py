"""Features, label model and score of the toxicity operator against plain versions."""

import math
import random
import tracemalloc

import numpy as np

from linkrank.llm import toxicity
from linkrank.llm.toxicity import ToxicityModel


def plain_features(model, text):
    """One row by definition: which terms a text has, which patterns fire, and the counts."""
    words = toxicity.WORD.findall((text or "").lower())
    has = lambda word, voter: word == voter or voter.endswith("-") and word.startswith(voter[:-1]) and len(word) > len(voter) - 1
    voted = [float(any(has(w, v) for w in words)) for v in model.voters + model.clean]
    hits = sum(any(has(w, v) for v in model.voters) for w in words)
    patterns = toxicity.tone(text, set(words), len(words)) if text else [0] * len(toxicity.TONE)
    return [*voted, *map(float, patterns), float(hits > 0), math.log1p(hits), min(1.0, 10 * hits / max(1, len(words)))]


def some_texts():
    draw = random.Random(4)
    words = ["vile", "vilest", "vileness", "kind", "kindly", "idiot", "IDIOT", "you are an idiot", "f*ck", "what??", "tree", "Straße"]
    return [" ".join(draw.choices(words, k=draw.randint(1, 30))) for _ in range(200)] + [None, "", "  ", "vile"]


def test_features_and_scores():
    voters, clean = ["vile", "vile-", "vilest"], ["kind-", "tree"]
    n = len(voters) + len(clean) + len(toxicity.TONE) + 3
    model = ToxicityModel(voters, clean, np.random.default_rng(2).standard_normal(n), -0.5)
    texts = some_texts()
    want = [plain_features(model, t) for t in texts]
    assert np.allclose(model.features(texts), want)
    scores = [1 / (1 + math.exp(-(sum(f * w for f, w in zip(row, model.weights, strict=True)) - 0.5))) for row in want]
    assert np.allclose(model.score(texts), scores)


def plain_label_model(votes, labels, base_rate):
    """The label model with loops in place of matrix products."""
    votes = [[*map(float, row), float(not any(row))] for row in votes]
    n = len(votes[0])
    logit = lambda p: math.log(p / (1 - p))
    trust = [{1: toxicity.LABEL_TRUST, 0: 1 - toxicity.LABEL_TRUST, -1: None}[v] for v in labels]
    posterior = [base_rate if t is None else t for t in trust]
    fit = [i for i, t in enumerate(trust) if t is not None]
    for _ in range(toxicity.EM_ROUNDS):
        toxic = sum(posterior[i] for i in fit)
        clean = len(fit) - toxic
        s = toxicity.SMOOTHING
        rate_t = [(sum(posterior[i] * votes[i][j] for i in fit) + s * 0.1) / (toxic + s) for j in range(n)]
        rate_c = [(sum((1 - posterior[i]) * votes[i][j] for i in fit) + s * 0.01) / (clean + s) for j in range(n)]
        rest = [[votes[i][j] - posterior[i] * rate_t[j] - (1 - posterior[i]) * rate_c[j] for i in fit] for j in range(n)]
        mean = [sum(r) / len(r) for r in rest]
        dev = [math.sqrt(sum((x - m) ** 2 for x in r) / len(r)) for r, m in zip(rest, mean, strict=True)]
        shared = lambda a, b: sum(x * y for x, y in zip(rest[a], rest[b], strict=True)) / len(fit) / max(dev[a] * dev[b], 1e-9)
        discount = [1 + sum(c for b in range(n) if b != a and (c := shared(a, b)) > 0.1) for a in range(n)]
        weight = [math.log(t / c) / d for t, c, d in zip(rate_t, rate_c, discount, strict=True)]
        odds = [logit(base_rate) + sum(w * v for w, v in zip(weight, row, strict=True)) for row in votes]
        odds = [o + (0 if t is None else logit(t)) for o, t in zip(odds, trust, strict=True)]
        posterior = [1 / (1 + math.exp(-min(30, max(-30, o)))) for o in odds]
        fit = range(len(votes))
    return posterior


def voted(n=300, seed=5):
    """Votes of three good voters (the second follows the first), one that says clean, and noisy labels."""
    rng = np.random.default_rng(seed)
    truth = rng.random(n) < 0.3
    fires = lambda toxic, clean: rng.random(n) < np.where(truth, toxic, clean)
    first = fires(0.8, 0.02)
    votes = np.stack([first, first & (rng.random(n) < 0.95), fires(0.6, 0.03), fires(0.05, 0.5)], axis=1).astype(float)
    labels = np.where(rng.random(n) < 0.1, 1 - truth, truth).astype(int)
    labels[rng.random(n) < 0.3] = -1
    return truth, votes, labels


def test_label_model():
    _, votes, labels = voted()
    got = toxicity.label_model(votes, labels, 0.3)
    assert np.allclose(got, plain_label_model(votes.tolist(), labels.tolist(), 0.3))


def test_voters_outvote_a_wrong_label():
    truth, votes, labels = voted(2000)
    got = toxicity.label_model(votes, labels, 0.3)
    strong = truth & (votes[:, 0] > 0) & (votes[:, 2] > 0) & (labels == 0)
    assert strong.any() and (got[strong] > 0.5).all()
    known = labels >= 0
    assert np.mean((got > 0.5)[known] == truth[known]) > np.mean(labels[known] == truth[known])


def test_the_label_model_holds_few_copies_of_the_votes():
    """It runs on the driver; the residuals of all rows are made by blocks."""
    drawn = np.random.default_rng(3)
    votes = (drawn.random((6000, 200)) < 0.1).astype(float)
    labels = drawn.integers(-1, 2, 6000)
    tracemalloc.start()
    try:
        toxicity.label_model(votes, labels, 0.1)
        assert tracemalloc.get_traced_memory()[1] < 4 * votes.nbytes
    finally:
        tracemalloc.stop()
