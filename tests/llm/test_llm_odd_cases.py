"""Nulls, empty, blank and long texts, ties, repeated rows, empty tables, clashing column names."""

import math
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from conftest_rows import LONG, PASSAGE, odd_rows
from linkrank.llm import bm25_wand, de_bruijn, hash_tree, html_text, langid, mixing, odd_sketch, prefix_forest, token_counts, toxicity, units

ROWS = [r[:2] for r in odd_rows()]


def results(frame, *columns):
    """Rows as a multiset of tuples."""
    return Counter(tuple(r[c] for c in columns) for r in frame.collect())


def test_pages_of_every_kind():
    assert [html_text.main_text(h) for h in (None, "", "<p></p>", "plain & text", "<p>a&lt;b\n c<p>d")] == ["", "", "", "plain & text", "a<b c\n\nd"]
    page = (
        "<body><header><a href=/>Home</a></header><div class='cookie-notice'>We use cookies</div><form><article><header><h1>T</h1></header>"
        "<p>First <a href=x>linked</a> text.</p><div class=advert>Buy</div><ul><li>one<li>two</ul></article>"
        "<section id=comments><p>A long comment of a reader, longer than the article itself is.</p></section></form>"
        "<aside>More</aside><script>var x = '<p>no</p>'</script></body>"
    )
    assert html_text.main_text(page) == "T\n\nFirst linked text.\n\none\n\ntwo"
    assert html_text.main_text("<div>" * 3000 + "deep") == "deep"


SENTENCES = "A sentence of the article that says something worth reading. " * 4
NAV, P = "<nav><a href=/>Home</a></nav>", f"<p>{SENTENCES}</p>"


@pytest.mark.parametrize(
    "page, kept, gone",
    [
        (f"<article><h1>T</h1>{P}<h2 class='section-header'>Part two</h2>{P}<p class='share-price'>Shares rose.</p></article>", ["Part two", "Shares rose."], []),
        (f"<article><div class='post-header'><h1>Title</h1></div>{P}<div class='share-buttons'><a href=x>Tweet</a></div></article>", ["Title"], ["Tweet"]),
        (f"<div class='content has-sidebar'><h2>Two</h2>{P}{P}</div><div class='sidebar'><p>Buy this.</p></div>", ["Two"], ["Buy this."]),
        (f"<div class='ad-free'><h2>Two</h2>{P}{P}</div>", ["Two"], []),
        (f"<form id='form1'><div><h2>Two</h2>{P}{P}</div><div class=ad>Buy this.</div></form>", ["Two"], ["Buy this."]),
        ("Bare text that is as dense as any paragraph. " * 8 + f"<div>{P}{P}</div>", ["Bare text"], []),
    ],
)
def test_article_text_is_not_lost_to_names(page, kept, gone):
    text = html_text.main_text(f"<body>{NAV}{page}</body>")
    assert all(x in text for x in ["worth reading", *kept]) and not any(x in text for x in ["Home", *gone])


LINKED = "<p>Some <a href=a>linked words</a> of the <a href=b>article that</a> one may <a href=c>like to read</a> here.</p>"
COMMENT = "<p>A plain comment of a reader, longer and denser than what the article itself has to say about it all.</p>"


@pytest.mark.parametrize(
    "page, kept, gone",
    [
        (f"<article>{LINKED * 4}</article><div class='user-comments'>{COMMENT * 2}</div>", ["linked words"], ["plain comment"]),
        (f"<div class=post><h1>T</h1>{P * 2}</div><ol class='comments-list-items'><li>{COMMENT}<li>{COMMENT}</ol>", ["worth reading"], ["plain comment"]),
        (f"<article>{P}</article><div class='post-comments'>{COMMENT}</div><div class='left-sidebar'>{COMMENT}</div>", ["worth reading"], ["plain comment"]),
        (f"<article>{P}<div class='ad-box'>Buy this now.</div><p class='cookie-text'>Cookies.</p>{P}</article>", ["worth reading"], ["Buy this", "Cookies"]),
        (f'<article><h1 class="a"">Title</h1>{P}<p>Before <a href="x"">link</a> after.</p>{P}</article>', ["Title", "Before link after"], []),
        (f"<article><p title=it's>One.</p>{P}<p>It's two.</p></article>", ["One.", "It's two."], []),
        (f"<div>{'<a href=/cat/>Category</a> ' * 12}</div><article>{P}</article>", ["worth reading"], ["Category"]),
        (f"<article>{P}<p>a <b>b <i>c</b> d</i> e <br/> f</p>{P}</article>", ["a b c d e f"], []),
    ],
)
def test_what_is_beside_the_article(page, kept, gone):
    text = html_text.main_text(f"<body>{NAV}{page}</body>")
    assert all(x in text for x in kept) and not any(x in text for x in ["Home", *gone])


@pytest.mark.parametrize("opening", ["<div>", "<b>", "<ul><li>", "<p><span>", "<table><tr><td>", "<section><header>"])
def test_deep_pages_take_time_in_proportion(opening):
    times = []
    for n in (5_000, 40_000):
        page = f"<body>{opening * n}text at the bottom"
        start = time.perf_counter()
        assert html_text.main_text(page) == "text at the bottom"
        times.append(time.perf_counter() - start)
    assert times[1] < 8 * 4 * times[0] + 0.5


def test_links_of_a_slash_are_links():
    root = html_text.parse("<div><a href=/cat/>Category</a> text</div>")
    nodes = html_text._order(root)
    html_text.measure(nodes)
    assert (nodes[0].chars, nodes[0].link_chars) == (12, 8)


def naive(node):
    """Characters, tags, link characters and link tags by recursion over the whole subtree."""
    chars = tags = link_chars = link_tags = 0
    for c in node.children:
        if isinstance(c, str):
            chars += len("".join(c.split()))
        elif not c.dropped:
            own = naive(c)
            chars, tags, link_chars, link_tags = chars + own[0], tags + own[1] + 1, link_chars + own[2], link_tags + own[3]
    return (chars, tags, chars, link_tags + 1) if node.name == "a" else (chars, tags, link_chars, link_tags)


def naive_density(node, body):
    chars, tags, link_chars, link_tags = naive(node)
    if not chars:
        return 0.0
    share = body[2] / max(1, body[0])
    base = math.log(chars / max(1, chars - link_chars) * link_chars + share * chars + math.e)
    return chars / max(1, tags) * math.log(max(1.0, chars / max(1, link_chars) * max(1, tags) / max(1, link_tags))) / base


@pytest.mark.parametrize("seed", range(6))
def test_densities_against_recursion(seed):
    rng = np.random.default_rng(seed)

    def part(depth):
        if depth == 0 or rng.random() < 0.2:
            return " ".join("word" * int(rng.integers(1, 4)) for _ in range(rng.integers(1, 12)))
        name = str(rng.choice(["div", "section", "a", "b", "span", "ul"]))
        return f"<{name}>" + " ".join(part(depth - 1) for _ in range(rng.integers(1, 4))) + f"</{name}>"

    root = html_text.parse("<body>" + "".join(part(5) for _ in range(4)) + "</body>")
    nodes = html_text._order(root)
    html_text.measure(nodes)
    body = naive(next(n for n in nodes if n.name == "body"))
    for n in nodes:
        assert (n.chars, n.tags, n.link_chars, n.link_tags) == naive(n)
        assert n.density == pytest.approx(naive_density(n, body))
        kids = [c for c in n.children if not isinstance(c, str) and not c.dropped]
        own = sum(len("".join(c.split())) for c in n.children if isinstance(c, str))
        assert n.total == pytest.approx(own + sum(naive_density(k, body) for k in kids))


def test_pages_in_spark(spark):
    pages = spark.createDataFrame([(1, "u", None, 5), (1, "u", None, 5), (None, None, "<p>x</p>", 6)], "page_id long, url string, html string, n_chars int")
    got = results(html_text.extract_pages(pages), "page_id", "url", "text", "n_chars")
    assert got == {(1, "u", "", 0): 2, (None, None, "x", 1): 1}
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def test_languages(spark, odd_docs, no_docs):
    got = langid.identify_languages(odd_docs, odd_docs).collect()
    assert len(got) == len(ROWS)
    by_id = {r.doc_id: r for r in got if r.doc_id}
    for i in (4, 5, 6):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert {r.lang_pred for r in got} <= {"en", "de", "und"} and by_id[1].lang_pred == "en"
    assert {r.lang_pred for r in langid.identify_languages(odd_docs, no_docs).collect()} == {"und"}
    assert langid.identify_languages(no_docs, odd_docs).count() == 0


@pytest.mark.parametrize("chunk", [1, 3, 100, 1000])
def test_language_counts_do_not_depend_on_pieces(monkeypatch, chunk):
    whole = langid.counts([LONG[:3000], "ab", ""])
    monkeypatch.setattr(langid, "CHUNK_CHARS", chunk)
    assert (whole == langid.counts([LONG[:3000], "ab", ""])).all() and whole.sum() > 3000


def vectors(spark):
    rows = [(i, [float(i % 7 + 1), float(i % 5), 1.0]) for i in range(1, 30)]
    rows += [(40, None), (41, []), (42, [0.0, 0.0, 0.0]), (43, [1.0, None, 0.0]), (44, [float("nan"), 1.0, 1.0]), (45, [float("inf"), 1.0, 1.0])]
    rows += [(None, [1.0, 1.0, 1.0]), (1, [2.0, 1.0, 1.0]), (50, [3.0, 4.0])]
    return spark.createDataFrame([(*r, 0.5, 1) for r in rows], "vec_id long, embedding array<double>, score double, tree int")


@pytest.mark.parametrize("enough", [1, 10_000])
def test_neighbours(spark, enough):
    table = vectors(spark)
    got = prefix_forest.nearest(table, table.where("vec_id % 5 = 0"), k=3, enough=enough).collect()
    assert {r.query_id for r in got} <= {5, 10, 15, 20, 25}  # 50 has no candidate of its length
    assert not {r.vec_id for r in got} & {40, 41, 42, 43, 44, 45, 50, None}
    if enough > 100:  # the root: exact
        x = {i: [float(i % 7 + 1), float(i % 5), 1.0] for i in range(1, 30)}
        for q in (5, 10, 15, 20, 25):
            want = sorted((-float(np.dot(x[q], x[i])), i) for i in x if i != q)[:3]
            assert [(r.rank, r.vec_id, r.score) for r in sorted(got) if r.query_id == q] == [(n, i, -s) for n, (s, i) in enumerate(want, 1)]
    assert prefix_forest.nearest(table.limit(0), table, k=3).count() == 0


@pytest.mark.parametrize("noise", [0.3, None])
def test_neighbours_at_every_depth(spark, noise):
    """Queries start at their full strings and ascend until their neighbours are found, not until they hold some rows."""
    rng = np.random.default_rng(7)
    x = rng.standard_normal((1200, 16))
    if noise:
        x = np.repeat(x[:40], 30, axis=0) + noise * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = prefix_forest.nearest(table, table.where("vec_id % 50 = 0"), enough=1).toPandas().groupby("query_id")
    hits = 0
    for query in range(0, 1200, 50):
        score = x @ x[query]
        score[query] = -np.inf
        want = np.argsort(-score)[:20]
        hits += len(set(want) & set(got.get_group(query)["vec_id"]))
    assert hits >= 0.9 * 20 * 24


def test_neighbours_of_an_id_repeated_often(spark):
    """The id's own rows fill its prefixes; the others are found nevertheless."""
    x = np.random.default_rng(8).standard_normal((30, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist())] * 80
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = prefix_forest.nearest(table, table.where("vec_id = 0")).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == list(np.argsort(-(x[1:] @ x[0]))[:20] + 1)


def test_no_height_without_the_chance_for_it():
    cosines = np.array([-0.9, -0.2, 0.0, 0.1, 0.35, 0.6, 0.9, 1.0, np.nan])
    heights = prefix_forest.height_for(cosines)
    assert heights[-1] == 0 and (np.diff(heights[:-1]) >= 0).all() and heights[-2] == prefix_forest.TREES * prefix_forest.BITS
    for cosine, height in zip(cosines[:-1], heights[:-1], strict=True):
        assert prefix_forest.chance(cosine, height) >= prefix_forest.CHANCE
        if 0 < height < heights[-2]:
            assert prefix_forest.chance(cosine, height + 1) < prefix_forest.CHANCE
        assert (height == 0) == (cosine < 0.33)  # where half of all rows would be compared
        assert prefix_forest.lengths(height).sum() == height


def test_ranges_are_prefixes():
    """Ranges of the sorted arrays hold the rows that share a prefix, longest matches are the longest."""
    rng = np.random.default_rng(9)
    x = np.repeat(rng.standard_normal((60, 8)), 3, axis=0) + 0.05 * rng.standard_normal((180, 8))
    largest = np.linalg.norm(x, axis=1).max()
    shard = prefix_forest.Shard(np.arange(180), x, largest)
    unit = np.hstack([x / largest, np.sqrt(np.maximum(0, 1 - ((x / largest) ** 2).sum(axis=1, keepdims=True)))])
    codes = prefix_forest.strings(unit)
    q = rng.standard_normal((5, 9))
    asked = prefix_forest.strings(q / np.linalg.norm(q, axis=1, keepdims=True))
    bits = lambda c: np.unpackbits(c.astype(">u4")[..., None].view(np.uint8), axis=-1)
    shared = np.cumprod(bits(codes)[:, None] == bits(asked)[:, :, None], axis=-1).sum(axis=-1)  # tree, query, row
    assert (shard.longest(asked) == shared.max(axis=2)).all()
    for height in (0, 1, 70, 200, 64 * 12 + 5, 64 * 32):
        length = np.repeat(prefix_forest.lengths(height)[:, None], 5, axis=1)
        start, end = shard.ranges(asked, length)
        assert (end - start == (shared >= length[:, :, None]).sum(axis=2)).all()
        for t in (0, 63):
            assert set(shard.order[t, start[t, 2] : end[t, 2]]) == set(np.flatnonzero(shared[t, 2] >= length[t, 2]))
    start, end = shard.start(asked, 300)
    assert ((end - start).sum(axis=0) >= 300).all()


def test_shards(odd_docs, no_docs):
    rows = hash_tree.shard_documents(odd_docs).collect()
    assert len(rows) == len(ROWS) and {r.law for r in rows} == {"key"}
    assert {(r["size"], r.text_crc32) for r in rows if r.doc_id == 4} == {(1, 0)}
    for shard in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))
    assert hash_tree.shard_documents(no_docs).count() == 0


def test_many_copies_of_a_row_take_slots_of_their_own(spark, monkeypatch):
    """A third of all rows have neither id nor text: one row for the sort, its copies dealt by runs."""
    monkeypatch.setattr(hash_tree, "RUN", 100)
    docs = spark.range(3000).selectExpr("case when id % 3 > 0 then id end as doc_id", "case when id % 3 > 0 then concat('t', id) end as text", "id as slot", "1 as `__n`")
    rows = hash_tree.shard_documents(docs).collect()
    assert len(rows) == 3000 and sum(r.doc_id is None for r in rows) == 1000
    for shard in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))
    empty = sorted(r.slot for r in rows if r.doc_id is None)
    assert empty == list(range(empty[0], empty[0] + 1000))


def test_weights_move_rows_into_the_heavier_part_only(spark):
    tree = hash_tree.regular_tree()
    heavier = [hash_tree.Shard(s.region, s.rack, s.shard, 3.0 if s.shard == 5 else 1.0) for s in tree]
    rows = spark.range(4000)
    key = F.col("id").cast("string")
    both = hash_tree.place(hash_tree.place(rows, key, tree, "old"), key, heavier, "new").collect()
    moved = [r for r in both if r.old != r.new]
    assert moved and all(r.new in (4, 5, 6, 7) for r in moved)  # region 1 grew
    assert all(r.new in (4, 5) for r in moved if r.old in (6, 7)) and all(r.new == 5 for r in moved if r.old == 4)
    share = Counter(r.new for r in both)
    assert abs(share[5] / 4000 - 3 / 10) < 0.04 and abs(share[0] / 4000 - 1 / 10) < 0.03
    with pytest.raises(ValueError):
        hash_tree.place(rows, key, [hash_tree.Shard(0, 0, 0, 0.0)])


def test_toxicity(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, "x"), (2, 0, "x"), (None, 1, "x"), (3, None, "x"), (9, 0, "x")], "doc_id long, toxic int, text string")
    for known in (labels, labels.where("toxic = 0"), labels.limit(0)):
        got = toxicity.score_toxicity(odd_docs, known).collect()
        assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
        empty = {r.score for r in got if r.doc_id in (4, 5, 6)}
        assert len(empty) == 1
    assert toxicity.score_toxicity(no_docs, labels).count() == 0
    assert toxicity.without_toxic(odd_docs, labels.limit(0)).columns == odd_docs.columns


def test_mix(odd_docs, no_docs):
    got = mixing.mix_documents(odd_docs).collect()
    assert len(got) == len(ROWS)
    by_source = Counter()
    for r in got:
        by_source[r.source] += r["size"]
        assert r.taken == r.copies * r["size"] <= 3 * r["size"]
    assert all(r.source_size == by_source[r.source] for r in got)
    total = sum(by_source.values())
    targets = {r.source: r.target for r in got}
    assert targets[None] == 0 and abs(sum(targets.values()) - total) < 1e-6
    assert targets["a"] == 3 * by_source["a"] and targets["b"] == 3 * by_source["b"]
    assert mixing.mix_documents(no_docs).count() == 0 and mixing.mixed_corpus(no_docs).count() == 0


def test_mix_with_limits_too_large_to_send(odd_docs, monkeypatch):
    sent = results(mixing.mix_documents(odd_docs), "doc_id", "taken")
    corpus = mixing.mixed_corpus(odd_docs)
    assert corpus.columns == odd_docs.columns
    assert results(corpus, "doc_id") == Counter({(i,): n for (i,), n in _copies(odd_docs).items() if n})
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 0)
    assert results(mixing.mix_documents(odd_docs), "doc_id", "taken") == sent


def _copies(docs):
    found = Counter()
    for r in mixing.mix_documents(docs).collect():
        found[r.doc_id,] += r.copies
    return found


def test_repeats(odd_docs, no_docs):
    want = brute.kept_words(ROWS)
    got = de_bruijn.remove_repeats(odd_docs).withColumn("sha", F.sha2("kept", 256))
    assert results(got, "doc_id", "n_words", "n_removed", "sha") == Counter((r[0], *want[r]) for r in ROWS)
    assert de_bruijn.remove_repeats(no_docs).count() == 0


def test_repeats_in_small_pieces(odd_docs, monkeypatch):
    monkeypatch.setattr(de_bruijn, "PIECE_BYTES", 100)
    want = brute.kept_words(ROWS)
    got = de_bruijn.remove_repeats(odd_docs)
    assert results(got, "doc_id", "n_removed") == Counter((r[0], want[r][1]) for r in ROWS)


def test_near_duplicates(odd_docs, no_docs):
    want = brute.components(ROWS)
    got = odd_sketch.near_duplicates(odd_docs)
    assert results(got, "doc_id", "n_shingles", "component_id") == Counter((r[0], *want[r]) for r in ROWS)
    kept = odd_sketch.without_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == {1: 1, 4: 1, 5: 1, 6: 1, 7: 1, 9: 1, 11: 1, 12: 1, None: 1}
    assert odd_sketch.near_duplicates(no_docs).count() == 0 and odd_sketch.without_duplicates(no_docs).count() == 0


def test_near_duplicates_in_small_blocks(spark, monkeypatch):
    """A large group of near copies, some linked only through others, in many blocks."""
    rng = np.random.default_rng(1)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base if i < 100 else rows[i - 100][1].split())
        for at in rng.choice(120, 1 + i % 3, replace=False):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(odd_sketch, "BLOCK", 16)
    got = odd_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute.components(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {(i, want[i, t][1]) for i, t in rows}


def test_parts_of_a_group_meet(spark, monkeypatch):
    """Chains of near copies and a large group of them, where only classes of different parts are compared a second time."""
    rng = np.random.default_rng(8)
    rows, sent = [], []
    for family in range(4):
        words = [f"f{family}_{i}" for i in range(200)]
        for i in range(60):
            words = list(words) if i % 2 else [f"f{family}_{j}" if j % 3 else w for j, w in enumerate(words)]
            for at in rng.choice(200, 2, replace=False):
                words[at] = f"n{family}_{i}_{at}"
            rows.append((family * 100 + i, " ".join(words)))
    base = [f"b{i}" for i in range(300)]
    rows += [(1000 + i, " ".join(base[:i] + [f"y{i}"] + base[i + 1 :])) for i in range(200)]
    monkeypatch.setattr(odd_sketch, "BLOCK", 16)
    find = odd_sketch._across_parts
    monkeypatch.setattr(odd_sketch, "_across_parts", lambda *a: sent.append(find(*a)) or sent[-1])
    monkeypatch.setattr(odd_sketch.Shelf, "last", lambda shelf, frame: frame)  # the tables are looked at below
    found = odd_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    want = brute.components(rows)
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {(i, want[i, t][1]) for i, t in rows}
    tasks = sent[0].groupBy("component", "first", "second").agg(F.count("node").alias("n"), F.countDistinct("part").alias("parts"))
    assert all(r.parts > 1 for r in tasks.collect())


@pytest.mark.parametrize("operator", [odd_sketch.near_duplicates, odd_sketch.without_duplicates])
def test_no_percent_below_what_the_sketches_are_made_for(odd_docs, operator):
    with pytest.raises(ValueError):
        operator(odd_docs, 60)


def test_leaks(spark, odd_docs, no_docs):
    items = spark.createDataFrame(
        [(1, PASSAGE.upper(), 0.0), (2, None, 0.0), (3, "", 0.0), (4, "two one", 0.0), (None, "ONE, two!", 0.0), (5, "entirely other words stand here today", 0.0)],
        "item_id long, text string, score double",
    )
    got = bm25_wand.find_leaks(odd_docs, items)
    holding = [r[0] for r in ROWS if r[1] and PASSAGE in r[1]]
    assert results(got, "doc_id", "item_id") == Counter([*((i, 1) for i in holding), (7, None), (8, None)])
    clean = bm25_wand.clean_documents(odd_docs, items)
    assert clean.columns == odd_docs.columns and clean.count() == len(ROWS) - len(holding) - 2
    assert bm25_wand.find_leaks(no_docs, items).count() == 0
    assert bm25_wand.clean_documents(odd_docs, items.limit(0)).count() == len(ROWS)


def test_every_score_above_the_threshold_is_retrieved():
    rng = np.random.default_rng(4)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary, 20))) for i in range(200)]
    index = bm25_wand.ItemIndex.build(items)
    texts = [list(rng.choice(vocabulary, 100)) for _ in range(20)] + [items[i][1].split() for i in range(10)]
    got = index.candidates(texts)
    for t, words in enumerate(texts):
        ids = np.array(sorted({index.vocabulary[w] for w in words if w in index.vocabulary}))
        rows, _ = index.items.rows(ids)
        score = np.bincount(index.items.number[rows], index.items.impact[rows], len(items))
        for j in range(len(items)):
            if abs(score[j] - bm25_wand.THRESHOLD) > 1e-9:
                assert ((t, j) in got) == (score[j] > bm25_wand.THRESHOLD)


def test_leak_across_segments(monkeypatch):
    monkeypatch.setattr(bm25_wand, "SEGMENT_CHARS", 900)
    index = bm25_wand.ItemIndex.build([(1, PASSAGE)])
    filler = " ".join(f"f{i}" for i in range(150))
    assert [x[0] for x in index.leaks([f"{filler} {PASSAGE} {filler}"])[0]] == [1]


@pytest.mark.parametrize("segment", [700, 5_000, 1 << 19, 1 << 22])
def test_question_and_answer_far_apart(monkeypatch, segment):
    """The answer stands 600,000 characters behind the question, too short to be found by itself."""
    words = PASSAGE.split()
    items = [(1, PASSAGE), (2, " ".join(f"other{i}" for i in range(30)))]
    filler = " ".join(f"f{i}" for i in range(85_000))
    assert len(filler) > 550_000
    monkeypatch.setattr(bm25_wand, "SEGMENT_CHARS", segment)
    index = bm25_wand.ItemIndex.build(items)
    apart = " ".join(words[:32]) + f" {filler} " + " ".join(words[28:])
    found = index.leaks(["short", apart, None, f"{filler} {PASSAGE}", apart[:400_000]])
    assert [[x[0] for x in f] for f in found] == [[], [1], [], [1], []]


def test_light_words_never_decide():
    """Passages are skipped only if the light words of any item could not make up for what is missing."""
    rng = np.random.default_rng(9)
    items = [(i, " ".join(f"c{n}" for n in rng.integers(0, 30, 25)) + f" r{i} r{i + 1} r{i + 2}") for i in range(80)]
    index = bm25_wand.ItemIndex.build(items)
    assert index.light.any() and 0 < index.light_most <= bm25_wand.LIGHT
    sums = np.zeros(len(index.item_of))
    rows, of = index.items.rows(np.flatnonzero(index.light))
    np.add.at(sums, index.items.number[rows], index.items.impact[rows])
    assert abs(sums.max() - index.light_most) < 1e-9


@pytest.mark.parametrize("n_words", [65, 200, 400, 2000])
def test_leak_of_a_long_item(n_words):
    """A passage holds a small part of a long item only."""
    item = " ".join(f"long{i}" for i in range(n_words))
    index = bm25_wand.ItemIndex.build([(1, PASSAGE), (2, item), (3, "some other words")])
    filler = " ".join(f"f{i}" for i in range(150))
    assert [[x[0] for x in found] for found in index.leaks([f"{filler} {item} {filler}", filler, item[: len(item) // 2]])] == [[2], [], []]


def test_weights_do_not_depend_on_the_parts_of_the_items(spark):
    rng = np.random.default_rng(6)
    items = [(i, " ".join(f"v{n}" for n in rng.zipf(1.5, 10 + i % 90) % 200)) for i in range(60)]
    table = spark.createDataFrame(items, "item_id long, text string")
    whole = {(t, j): v for index in bm25_wand.indexes(table, 60) for t, j, v in _impacts(index)}
    dealt = {(t, j): v for index in bm25_wand.indexes(table, 7) for t, j, v in _impacts(index)}
    assert whole.keys() == dealt.keys() and all(abs(whole[k] - dealt[k]) < 1e-12 for k in whole)


def _impacts(index):
    """Term, item and largest impact among the item's pieces."""
    best = {}
    for term, n in index.vocabulary.items():
        at, _ = index.items.rows(np.array([n]))
        for row in at:
            key = term, index.ids[index.item_of[index.items.number[row]]]
            best[key] = max(best.get(key, 0), index.items.impact[row])
    return [(*k, v) for k, v in best.items()]


def test_token_counts(odd_docs, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    count = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)
    want = Counter((i, len((t or "").encode()), count(t), count(t) > 512) for i, t in ROWS)
    for call_bytes, table_bytes in ((40, 1), (40, 3_000), (token_counts.CALL_BYTES, None)):
        got = token_counts.count_tokens(odd_docs, path, call_bytes=call_bytes, table_bytes=table_bytes)
        assert results(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts.count_tokens(no_docs, path).count() == 0
    assert token_counts.count_tokens(odd_docs, public_tokenizers.path("piece_bpe_32k.model")).count() == len(ROWS)


ODD_TEXTS = [
    *["", " ", "  ", "a", " a", "a ", "  a  b  ", " \n a", "a\t b \tc", "a\x1c b \x1c c", "\x00 a \x00b", "a\xa0 b \xa0c", "e\u3000 f \u3000g"],
    *["x<|endoftext|> y <|endoftext|>z", "don't  stop ' s 's", "\n\n a \n\n b\n \n", " " * 300 + "y", "a" + " " * 300, "1 2  3 \uff14 \u0663"],
    *["a  b\n\n c " * 50, "x" * 500, "don't  stop\t\n 12 ab " * 20, "\x1c a \x85 b" * 40, "\u00e1 \u0301b", "no blank\nbut\tother white space"],
]


@pytest.mark.parametrize("call_bytes, table_bytes", [(1, 1), (30, 400), (1 << 18, None)])
def test_units_have_the_tokens_of_their_text(call_bytes, table_bytes, monkeypatch):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = token_counts.json_tokenizer(path)
    monkeypatch.setattr(units, "SLICE_CHARS", 100)
    got = token_counts.UnitCounter(path, call_bytes, table_bytes).counts([*ODD_TEXTS, None, *ODD_TEXTS])
    want = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in ODD_TEXTS]
    assert got == [*want, 0, *want]


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_units_join_to_the_text(text):
    assert " ".join(units.units(text)) == text


def test_only_byte_level_files_are_cut():
    import public_tokenizers

    assert token_counts.cuts_at_blanks(public_tokenizers.path("byte_bpe_50k.json"))
    assert not any(token_counts.cuts_at_blanks(public_tokenizers.path(n)) for n in ("word_bpe_49k.json", "piece_bpe_32k.model"))
