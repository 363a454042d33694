"""URL filters against a plain version."""

import re
from collections import Counter
from itertools import combinations
from math import log, log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkrank import llm
from linkrank.llm import url_filters
from linkrank.llm.common import id_remainder

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
LETTERS = re.compile(r"[^\W\d_]+")


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.split(r"[?#]", path)[0]


def rule_of(host, path):
    fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


def plain_verdicts(rows):
    """(page_id, host, path, rule, verdict) by dictionaries of tokens, without bins."""
    words = Counter()
    for _, _, html in rows:
        text = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ", html or "")
        text = re.sub(r"<[^>]*>|&[#\w]+;", " ", text)
        words.update(w for w in LETTERS.findall(text.lower()) if len(w) <= 20)
    total = sum(words.values())

    def cost(w):
        return log10(words[w] / total) if words[w] else 1 - log10(max(total, 1)) - len(w)

    def cut(run):
        if len(run) > 64:
            return [run]
        best = [(0.0, [])]
        for end in range(1, len(run) + 1):
            best.append(max(((best[s][0] + cost(run[s:end]), [*best[s][1], run[s:end]]) for s in range(max(0, end - 20), end)), key=lambda x: x[0]))
        return best[-1][1]

    def tokens(host, path):
        of_path = [p for p in re.split(r"[\W_]+", path.lower()) if p]
        return [w for r in LETTERS.findall(host.lower()) for w in cut(r)] + ["/" + (f"#{p[0]}/{len(p)}" if p.isdigit() else p) for p in of_path]

    seen, urls = {"allow": Counter(), "block": Counter({w: 20 for w in url_filters.BLOCKED_WORDS})}, Counter()
    judged = [(i, *parts_of(url)) for i, url, _ in rows]
    for _, host, path in judged:
        if v := rule_of(host, path)[1]:
            seen[v].update(tokens(host, path))
            urls[v] += 1
    size = len(seen["allow"] | seen["block"])
    share = lambda v, t: log((seen[v][t] + 1) / (sum(seen[v].values()) + size))
    prior = log((urls["block"] + 1) / (urls["allow"] + 1))
    found = {}
    for i, host, path in judged:
        name, verdict = rule_of(host, path)
        score = prior + sum(share("block", t) - share("allow", t) for t in tokens(host, path) if t in seen["allow"] or t in seen["block"])
        found[i] = host, path, name, verdict or ("block" if score > 0 else "allow"), score
    return found


def test_query_against_a_plain_version(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()
    want = plain_verdicts([tuple(r) for r in pages])
    got = llm.queries()["op12_viterbi_url_filter"](spark, SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path, rule, verdict, score = want[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert abs(r.score - score) < 1e-6 and (r.verdict == verdict or abs(score) < 1e-6)
    assert {r.verdict for r in got} == {"allow", "block"}


HTML = "<p>cheap pills and a spam farm for the thing</p><script>var hidden = 1</script>"
ODD = [
    *[(1, "http://www.CheapPills.Example.NET/en/5?x=/es/#y", HTML), (2, None, HTML), (3, "no scheme/org/", None), (4, "", ""), (5, "://", HTML)],
    *[(6, "https://example.org", HTML), (7, "https://example.org/", HTML), (8, "https://a.example.org/es/3", HTML), (9, "http://notexample.org/es/3", None)],
    *[(10, "http://example.org/en/1", HTML), (11, "http://x.com/fr/1?q=://y.org/", HTML), (12, "http://x.com/de/1#://z", HTML), (13, "http://com/fr/", None)],
    *[(14, "http://" + "a" * 70 + ".net/" + "b/" * 9_000, HTML), (15, "http://äthing.net/Über/12", HTML), (16, "http://x.net?org/es/", HTML)],
    *[(17, "http://x.net\n/a", "<p>Thing\nthing</p>" * 3_000), (18, "a://b://c.org/d", HTML), (19, "http://org.net/", HTML)],
]


def test_odd_urls(spark):
    pages = spark.createDataFrame([(*r, "h", "r", "s") for r in [*ODD, ODD[0], (None, ODD[0][1], HTML)]], "page_id long, url string, html string, host string, rule string, score string").repartition(4)
    got = url_filters.judge_urls(pages).collect()
    want = plain_verdicts([*ODD, ODD[0], (None, ODD[0][1], HTML)])
    assert Counter(r.page_id for r in got) == Counter([*(r[0] for r in ODD), 1, None])
    for r in got:
        host, path, rule, verdict, score = want[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict) and abs(r.score - score) < 1e-6
    rules = {r.page_id: r.rule for r in got}
    assert rules[6] is None and [rules[i] for i in range(7, 14)] == ["org/", "example.org/es/", "org/", "example.org/en/1", "com/fr/", "com/de/", "com/fr/"]
    assert url_filters.judge_urls(pages.limit(0)).count() == 0
    assert {r.verdict for r in url_filters.judge_urls(pages, rules=[]).collect()} <= {"allow", "block"}


def test_the_longest_rule_wins_and_then_the_longer_host(spark):
    rules = [url_filters.Rule("a.b", "/cc", "allow"), url_filters.Rule("x.a.b", "/", "block"), url_filters.Rule("b", "/", "block")]
    row = spark.createDataFrame([("x.a.b", "/ccd"), ("x.a.b", "/d"), ("y.a.b", "/cc"), ("ab", "/")], "host string, path string")
    got = row.select(url_filters.rule_of(F.col("host"), F.col("path"), rules).alias("r")).collect()
    assert [r.r and r.r["name"] for r in got] == ["a.b/cc", "x.a.b/", "a.b/cc", None] or [r.r and r.r["name"] for r in got][1:] == ["x.a.b/", "a.b/cc", None]


def test_segments_are_the_most_likely():
    words = Counter({"the": 50, "thing": 9, "in": 30, "hint": 3, "pills": 4, "cheap": 5, "a": 60})
    total = sum(words.values())
    cost = lambda w: log10(words[w] / total) if words[w] else 1 - log10(total) - len(w)
    for run in ("cheappills", "thething", "inthing", "xqthe", "a", "theathint"):
        known = {(i, n): words[run[i : i + n]] for i in range(len(run)) for n in range(1, 21) if words[run[i : i + n]] and i + n <= len(run)}
        got = url_filters.segment(run, known, total)
        every = [[run[i:j] for i, j in zip((0, *c), (*c, len(run)), strict=True)] for k in range(len(run)) for c in combinations(range(1, len(run)), k)]
        best = max(sum(map(cost, cut)) for cut in every)
        assert "".join(got) == run and abs(sum(map(cost, got)) - best) < 1e-9
    assert url_filters.segment("cheappills", {(0, 5): 5, (5, 5): 4}, total) == ["cheap", "pills"]


def test_held_out_rules_are_foreseen(spark):
    """What rules say of URLs that the classifier has not learned from."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    held_out = id_remainder(F.col("page_id"), 5) == 0
    got = url_filters.judge_urls(pages, learn_from=~held_out).where(held_out & F.col("rule").isNotNull()).collect()
    right = [(r.score > 0) == (r.verdict == "block") for r in got]
    share = np.mean([r.verdict == "block" for r in got])
    assert np.mean(right) > max(share, 1 - share) + 0.1
    blocked = [r.score > 0 for r in got if r.verdict == "block"]
    assert np.mean(blocked) > 0.5


@pytest.mark.parametrize("name", url_filters.BLOCKED_WORDS[:3])
def test_blocked_words_block(spark, name):
    pages = spark.createDataFrame([(1, f"http://{name}site.net/", f"site {name} " * 5), (2, "http://calmsite.net/", "calm"), (3, "http://a.com/fr/", "x"), (4, "http://a.com/de/", "x")], "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filters.judge_urls(pages).collect()}
    assert got[1] == "block" and got[3] == "allow" and got[4] == "block"
