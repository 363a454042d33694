"""URL filters: host words by unigram Viterbi, judged by multinomial naive Bayes.

Names in hosts are words written together. Words and their counts come from the
text of all pages. Every different run of letters in a host is cut into the
words of largest probability product (Viterbi over the places in the run):
its parts are looked up by a join of all parts of all different runs with the
word counts, so neither the words nor the hosts have to fit a task.

Rules decide the URLs they fit, and those are what the classifier learns from.
It counts the words of hosts and the tokens of paths by verdict, in as many
hashed bins as ``BINS`` (a bound for what is sent to the tasks), next to a few
words that are blocked everywhere, and judges the URLs without a rule.

A host of a third of all pages is segmented and scored once; its score goes
back to its pages with the few other frequent ones, the rest by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log, log10

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import Shelf

ALLOW, BLOCK = "allow", "block"
LONGEST_WORD, LONGEST_RUN = 20, 64  # a label of a host has 63 characters; longer runs are words of their own
BINS = 1 << 18
SMOOTHING = 1.0
FREQUENT = 1_000  # a key with more than one in so many rows counts as frequent, so there are fewer of them
# Words that are blocked wherever no rule says otherwise, and how often each counts as seen.
BLOCKED_WORDS = (
    "adult betting bonus casino cheap cialis escort farm gambling jackpot loan loans lottery payday pharmacy pills poker"
    " porn replica sex slots spam torrent viagra warez xxx"
).split()
BLOCKED_COUNT = 20


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = [
    Rule("org", "/", ALLOW),
    Rule("example.org", "/es/", BLOCK),
    Rule("example.org", "/en/1", BLOCK),
    Rule("com", "/fr/", ALLOW),
    Rule("com", "/de/", BLOCK),
]


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, hash or the end, with A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct of its name and verdict; of equally long ones that of the longer host. Rules go with the plan: some hundreds at most."""
    found = F.lit(None).cast("struct<name: string, verdict: string>")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def letter_runs(text: Column) -> Column:
    return F.filter(F.split(text, r"\P{L}+"), lambda r: r != "")


def word_counts(html: DataFrame) -> DataFrame:
    """``word, n``: lower-case words of at most ``LONGEST_WORD`` letters in the text of all pages, markup and scripts left out."""
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>|&[#\w]+;", " ")
    words = html.select(F.explode(letter_runs(F.lower(text))).alias("word"))
    return words.where(F.length("word").between(1, LONGEST_WORD)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def segment(run: str, words: dict[tuple[int, int], int], total: int) -> list[str]:
    """``run`` as the words of largest probability product; ``words``: counts by start and length.

    A word never seen has a probability that falls tenfold with each letter. Of
    equally likely cuts the one with the longest last word, then the longest
    word before it, and so on, is taken.
    """
    best, back = [0.0] + [-np.inf] * len(run), [0] * (len(run) + 1)
    for end in range(1, len(run) + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            n = words.get((start, end - start), 0)
            own = log10(n / total) if n else 1.0 - log10(max(total, 1)) - (end - start)
            if best[start] + own > best[end]:
                best[end], back[end] = best[start] + own, start
    found, end = [], len(run)
    while end:
        found.append(run[back[end] : end])
        end = back[end]
    return found[::-1]


def segmented_runs(runs: DataFrame, counts: DataFrame, total: int, shelf: Shelf) -> DataFrame:
    """``run, words`` for each of the different ``run``: its parts that are words meet again by run, some hundreds each."""
    short = runs.where(F.length("run") <= LONGEST_RUN)
    places = F.sequence(F.lit(1), F.length("run"))
    parts = short.select("run", F.explode(places).alias("start")).select(
        "run", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("run") - F.col("start") + 1))).alias("size")
    )
    parts = parts.withColumn("word", F.expr("substring(run, start, size)"))
    # Single letters are parts of most runs: frequent keys.
    known = join_frequent(parts, counts, "word", shelf).where("n is not null").groupBy("run").agg(F.collect_list(F.struct(F.col("start") - 1, "size", "n")).alias("known"))

    @F.arrow_udf("array<string>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for run, parts in batches:
            rows = zip(run.to_pylist(), parts.to_pylist(), strict=True)
            yield pa.array([segment(r, {tuple(list(p.values())[:2]): p["n"] for p in known or []}, total) for r, known in rows], pa.list_(pa.string()))

    cut_runs = short.join(known, "run", "left").select("run", cut("run", "known").alias("words"))
    return cut_runs.unionByName(runs.where(F.length("run") > LONGEST_RUN).select("run", F.array("run").alias("words")))


def join_frequent(left: DataFrame, right: DataFrame, key: str, shelf: Shelf) -> DataFrame:
    """Left join on ``key``, of which ``right`` has every one once: frequent keys (less than ``FREQUENT``) are sent to the tasks."""
    counted = left.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    limit = left.count() / FREQUENT
    hot = shelf.stored(right.join(F.broadcast(counted.where(F.col("rows") > limit).select(key)), key, "left_semi"))
    keys = F.broadcast(hot.select(key))
    rest = left.join(keys, key, "left_anti").join(right, key, "left")
    return left.join(F.broadcast(hot), key).unionByName(rest)


def _numbers_marked(part: Column) -> Column:
    shape = F.concat(F.lit("#"), F.substring(part, 1, 1), F.lit("/"), F.length(part).cast("string"))
    return F.when(part.rlike("^[0-9]+$"), shape).otherwise(part)


def path_tokens(path: Column) -> Column:
    """Letter and digit runs of a path, letters in lower case, numbers by their first digit and their length."""
    parts = F.filter(F.split(F.lower(path), r"[^\p{L}\p{N}]+"), lambda p: p != "")
    return F.transform(parts, lambda p: F.concat(F.lit("/"), _numbers_marked(p)))


def bin_of(token: Column, bins: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(bins)).cast("int")


@dataclass(frozen=True)
class Weights:
    """Log odds for ``block`` of each bin and of the classes."""

    bins: np.ndarray
    prior: float

    def score(self, bins: list[int] | None) -> float:
        return float(self.bins[bins].sum()) if bins else 0.0


def weights_from(counts: dict[str, np.ndarray], urls: dict[str, int]) -> Weights:
    """Of token counts by bin and verdict. Bins that no token has met say nothing, so the vocabulary is what is smoothed."""
    met = counts[ALLOW] + counts[BLOCK] > 0
    shares = {v: np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * met.sum())) for v, c in counts.items()}
    prior = log((urls[BLOCK] + SMOOTHING) / (urls[ALLOW] + SMOOTHING))
    return Weights(np.where(met, shares[BLOCK] - shares[ALLOW], 0.0), prior)


def judge_urls(pages: DataFrame, rules: list[Rule] | None = None, learn_from: Column | None = None, bins: int = BINS) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row of ``pages``.

    The score is the log odds for ``block`` of the classifier, also where a rule
    decides; above 0 it blocks. Null URLs and URLs without ``://`` have empty
    hosts and paths and are judged by the classes' shares alone. ``learn_from``
    restricts the rows whose rules the classifier learns from. Null or empty
    html has no words. URLs and html of any length are read whole, but a run of
    more than ``LONGEST_RUN`` letters in a host, longer than a label may be, is
    one word. Repeated rows and null ids stay rows of their own; equal odds
    allow; an empty table gives no rows; other columns, whatever their names,
    are ignored.
    """
    rules = RULES if rules is None else rules
    shelf = Shelf()
    url = F.col("url")
    host, path = host_of(url), path_of(url)
    urls = pages.select("page_id", host.alias("host"), path.alias("path"), (learn_from if learn_from is not None else F.lit(True)).alias("learn"))
    urls = shelf.stored(urls.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)))
    counts = shelf.stored(word_counts(pages.select("html")))
    total = counts.agg(F.sum("n")).first()[0] or 0

    learned = F.when(F.col("learn"), F.col("rule.verdict"))
    number = lambda verdict: F.count(F.when(learned == verdict, 1)).alias(verdict)
    hosts = shelf.stored(urls.groupBy("host").agg(number(ALLOW), number(BLOCK)))
    host_runs = hosts.select("host", F.posexplode(letter_runs(F.lower("host"))).alias("place", "run"))
    runs = shelf.stored(host_runs.select("run").distinct())
    words = shelf.stored(segmented_runs(runs, counts, total, shelf))
    of_host = join_frequent(host_runs, words, "run", shelf).groupBy("host").agg(F.flatten(F.collect_list("words")).alias("tokens"))
    hosts_cut = shelf.stored(
        hosts.join(of_host, "host", "left").select("host", ALLOW, BLOCK, F.transform(F.coalesce("tokens", F.array().cast("array<string>")), lambda t: bin_of(t, bins)).alias("host_bins"))
    )

    paths = urls.where(learned.isNotNull()).groupBy("path").agg(number(ALLOW), number(BLOCK))
    tokens = F.transform(path_tokens(F.col("path")), lambda t: bin_of(t, bins))
    sums = lambda rows, column: rows.select(F.explode(column).alias("bin"), ALLOW, BLOCK)
    seen = sums(hosts_cut.where(f"{ALLOW} + {BLOCK} > 0"), F.col("host_bins")).unionByName(sums(paths, tokens))
    table = {v: np.zeros(bins) for v in (ALLOW, BLOCK)}
    blocked = pages.sparkSession.createDataFrame([(w,) for w in BLOCKED_WORDS], "word string").select(bin_of(F.col("word"), bins).alias("bin"))
    for r in blocked.collect():
        table[BLOCK][r["bin"]] += BLOCKED_COUNT
    for r in seen.groupBy("bin").agg(F.sum(ALLOW).alias(ALLOW), F.sum(BLOCK).alias(BLOCK)).collect():  # ``bins`` rows at most
        table[ALLOW][r["bin"]] += r[ALLOW]
        table[BLOCK][r["bin"]] += r[BLOCK]
    classes = hosts.agg(F.sum(ALLOW).alias(ALLOW), F.sum(BLOCK).alias(BLOCK)).first()
    weights = weights_from(table, {v: classes[v] or 0 for v in (ALLOW, BLOCK)})
    sent = pages.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([sent.value.score(None if b is None else list(b)) for b in batch], dtype=float)

    scored_hosts = shelf.stored(hosts_cut.select("host", score("host_bins").alias("host_score")))
    judged = join_frequent(urls, scored_hosts, "host", shelf)
    judged = judged.withColumn("score", F.lit(weights.prior) + F.col("host_score") + score(tokens))
    verdict = F.coalesce(F.col("rule.verdict"), F.when(F.col("score") > 0, F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    return shelf.last(judged.select("page_id", "host", "path", F.col("rule.name").alias("rule"), verdict.alias("verdict"), "score"))

