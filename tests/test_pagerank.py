"""Rank semantics on the 7-page toy graph and a few properties."""

import gc
import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from linkrank import RankSemantics, pagerank, pagerank_progress
from linkrank.functions import md5_bucket
from linkrank.operators import graph as graph_module
from linkrank.operators.graph import LIST_ROWS, LISTS
from linkrank.operators import DegreeRule, LinkGraph, PageNumbers, adjacency, numbering, partition_sizes, place_by_bucket, prepare_graph, rank_step
from linkrank.operators.progress import CountedSteps
from linkrank.operators.steps import page_shares, ranks_from_shares
from linkrank.plans import pagerank_after
from linkrank.session import checkpoint_in_place, shuffle_width, small_batches

ROWS_ZERO, DISTINCT_DROP = RankSemantics.ROWS_ZERO, RankSemantics.DISTINCT_DROP
TOY = [("A", "B"), ("A", "C"), ("B", "C"), ("C", "A"), ("D", "C"), ("A", "B"), ("C", "E"), ("F", "G"), ("G", "A")]
GOLDEN = {
    (ROWS_ZERO, 1): dict(A=1.425, B=0.433333333, C=2.133333333, D=0, E=0.575, F=0, G=1.0),
    (ROWS_ZERO, 2): dict(A=1.906666667, B=0.55375, C=0.922083333, D=0, E=1.056666667, F=0, G=0.15),
    (ROWS_ZERO, 3): dict(A=0.669385417, B=0.690222222, C=1.160909722, D=0, E=0.541885417, F=0, G=0.15),
    (ROWS_ZERO, 10): dict(A=0.516224166, B=0.297128552, C=0.552555109, D=0, E=0.388724166, F=0, G=0.15),
    (DISTINCT_DROP, 1): dict(A=1.425, B=0.575, C=2.275, E=0.575, G=1.0),
    (DISTINCT_DROP, 2): dict(A=1.966875, B=0.755625, C=1.244375, E=1.116875),
    (DISTINCT_DROP, 3): dict(A=0.678859375, B=0.985921875, C=1.628203125, E=0.678859375),
    (DISTINCT_DROP, 10): dict(A=0.432831523, B=0.338175487, C=0.635085547, E=0.432831523),
}


def plain_pagerank(rows, steps, d, semantics):
    """The rules once more, as a plain loop over dictionaries."""
    if semantics is DISTINCT_DROP:
        rows = [r for r in set(rows) if None not in r]
    sources = {s for s, _ in rows}
    degree = {s: sum(1 for r in rows if r[0] == s) for s in sources}
    links = {(s, t) for s, t in rows if s is not None}
    ranks = {s: 1.0 for s in sources}
    for _ in range(steps):
        sums = {}
        for s, t in links:
            if s in ranks:
                sums.setdefault(t, []).append(ranks[s] / degree[s])
        ranks = {t: (1 - d) + d * math.fsum(x) for t, x in sums.items()}
        if semantics is ROWS_ZERO:
            for s in sources:
                if s is not None:
                    ranks.setdefault(s, 0.0)
    return ranks


def as_dict(df):
    return {r["page"]: r["pagerank"] for r in df.collect()}


@pytest.fixture(scope="module")
def toy(spark):
    return spark.createDataFrame(TOY, "source STRING, target STRING")


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        F.col("l_orderkey").alias("source"), F.col("l_partkey").alias("target")
    )


@pytest.mark.parametrize("semantics,steps", list(GOLDEN), ids=lambda v: getattr(v, "value", v))
def test_toy_graph(toy, semantics, steps):
    assert as_dict(pagerank(toy, steps, semantics=semantics)) == pytest.approx(GOLDEN[semantics, steps], abs=1e-8)


@pytest.mark.parametrize("semantics", RankSemantics)
def test_no_steps_gives_sources_at_one(toy, semantics):
    assert as_dict(pagerank(toy, 0, semantics=semantics)) == dict.fromkeys("ABCDFG", 1.0)


@pytest.mark.parametrize("semantics", RankSemantics)
@pytest.mark.parametrize("hot_links,width", [(1, 3), (2, 16), (5, None), (None, 5)])
def test_salting_and_width_change_nothing(orders, semantics, hot_links, width):
    rows = [tuple(r) for r in orders.collect()]
    got = as_dict(pagerank(orders, 4, 0.7, semantics, num_partitions=width, hot_links=hot_links))
    assert got == pytest.approx(plain_pagerank(rows, 4, 0.7, semantics), abs=1e-9)


@pytest.mark.parametrize("semantics", RankSemantics)
@pytest.mark.parametrize("every", [1, 3, 20])
def test_checkpoint_interval_changes_nothing(toy, semantics, every):
    got = as_dict(pagerank(toy, 10, semantics=semantics, checkpoint_every=every))
    assert got == pytest.approx(GOLDEN[semantics, 10], abs=1e-8)


LAYOUTS = [{"numbered": True}, {"block_size": 3, "durable": True}, {"numbered": True, "block_size": 2, "num_partitions": 3}]


def page_rows(df):
    return sorted(((r.page is not None, r.page, r.out_degree), round(r.pagerank, 9)) for r in df.collect())


@pytest.mark.parametrize("semantics", list(RankSemantics))
def test_layouts_change_nothing(spark, semantics):
    rows = [(None, "a"), ("a", None), ("a", "b"), ("b", None), ("b", "a"), ("a", "b"), (None, None), ("c", "a")] + [("a", f"x{i}") for i in range(20)]
    odd = spark.createDataFrame(rows, "source string, target string")
    plain = page_rows(pagerank(odd, 3, semantics=semantics))
    want = plain_pagerank(rows, 3, 0.85, semantics)
    assert {p[1]: v for p, v in plain if p[0]} == {p: round(v, 9) for p, v in want.items() if p is not None}
    for options in LAYOUTS:
        assert page_rows(pagerank(odd, 3, semantics=semantics, **options)) == plain
        assert pagerank(odd.limit(0), 1, semantics=semantics, **options).count() == 0


def test_page_numbers_follow_the_pages(spark, orders):
    numbers = PageNumbers(orders, 5)
    rows = numbers.pages.orderBy("number").collect()
    assert [r.number for r in rows] == list(range(len(rows)))
    assert [r.page for r in rows] == sorted(r.page for r in rows)
    links = numbers.links(orders)
    assert links.count() == orders.count() and links.distinct().count() == orders.distinct().count()
    numbers.release()


@pytest.mark.parametrize("sent", [1 << 23, 0])
def test_hubs_are_numbered_in_many_tasks(spark, monkeypatch, sent):
    """A page of a third of all rows is joined in every task that holds some of them."""
    monkeypatch.setattr(numbering, "MIN_HOT_LINKS", 50)
    monkeypatch.setattr(numbering, "MAX_BROADCAST_BYTES", sent)
    rows = spark.range(3000).selectExpr("case when id % 3 = 0 then 'hub' else concat('p', id % 700) end as source", "concat('t', id) as target")
    numbers = PageNumbers(rows, 8)
    back = numbers.links(rows).join(numbers.pages.selectExpr("number as source", "page as from"), "source").join(numbers.pages.selectExpr("number as target", "page as to"), "target")
    assert back.select("from", "to").exceptAll(rows).isEmpty() and back.count() == 3000


def test_null_ends(spark):
    rows = TOY + [("A", None), (None, "A"), (None, "Z"), ("H", None)]
    df = spark.createDataFrame(rows, "source STRING, target STRING")
    got = sorted(((r.page or "", round(r.pagerank, 9), r.out_degree) for r in pagerank(df, 3).collect()))
    expected = plain_pagerank(rows, 3, 0.85, ROWS_ZERO)
    null_source = ("", 0.0, 2)
    degree = {}
    for s, _ in rows:
        degree[s] = degree.get(s, 0) + 1
    want = [(p or "", round(r, 9), degree.get(p, 0) if p else 0) for p, r in expected.items()]
    assert got == sorted(want + [null_source])
    assert sum(1 for p, _, _ in got if p == "") == 2
    dropped = as_dict(pagerank(df, 3, semantics=DISTINCT_DROP))
    assert dropped == pytest.approx(GOLDEN[DISTINCT_DROP, 3], abs=1e-8)


def test_one_page_holds_most_links(spark):
    """A hub on either side, with copies: links spread, ranks unchanged."""
    rows = [("hub", f"t{i}") for i in range(400)] + [(f"s{i}", "hub") for i in range(400)]
    rows += [("t1", "hub")] * 300 + [(f"t{i}", f"t{i + 1}") for i in range(399)]
    df = spark.createDataFrame(rows, "source STRING, target STRING")
    for semantics in RankSemantics:
        got = as_dict(pagerank(df, 3, semantics=semantics, hot_links=50))
        assert got == pytest.approx(plain_pagerank(rows, 3, 0.85, semantics), abs=1e-9)
    graph = prepare_graph(df, DegreeRule.ROWS, 8, hot_links=50)
    try:
        assert graph.salted
        per_group = graph.links.groupBy("source", "salt").count().agg(F.max("count")).first()[0]
        per_part = graph.links.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert per_group < 100 and per_part < 400
    finally:
        graph.release()


def test_duplicates_leave_distinct_drop_alone(orders):
    once = as_dict(pagerank(orders, 5, semantics=DISTINCT_DROP))
    twice = as_dict(pagerank(orders.unionAll(orders), 5, semantics=DISTINCT_DROP))
    assert twice == pytest.approx(once, abs=1e-9)
    assert min(once.values()) >= 0.15 - 1e-12


def test_rows_zero_pages_are_sources_and_targets(orders):
    rows = [tuple(r) for r in orders.collect()]
    got = pagerank(orders, 2).select("page").collect()
    assert {r.page for r in got} == {p for r in rows for p in r}
    assert len(got) == len({p for r in rows for p in r})


def test_golden_sf0001(orders):
    zero = pagerank(orders).agg(F.count("*"), F.sum((F.col("pagerank") == 0).cast("int")), F.sum("pagerank")).first()
    assert tuple(zero)[:2] == (1476, 1276) and zero[2] == pytest.approx(387.042009, abs=1e-5)
    drop = pagerank(orders, semantics=DISTINCT_DROP).agg(F.count("*"), F.sum("pagerank")).first()
    assert drop[0] == 194 and drop[1] == pytest.approx(397.877243, abs=1e-5)


def test_progress(orders):
    drop = pagerank_progress(orders, iterations=4, semantics=DISTINCT_DROP).orderBy("iteration").collect()
    assert [tuple(r) for r in drop] == [(1, 200), (2, 194), (3, 194), (4, 194)]
    zero = pagerank_progress(orders, iterations=2).orderBy("iteration").collect()
    assert [tuple(r) for r in zero] == [(1, 1476), (2, 1476)]


def test_empty_input(spark):
    empty = spark.createDataFrame([], "source STRING, target STRING")
    for semantics in RankSemantics:
        assert pagerank(empty, 2, semantics=semantics).count() == 0


@pytest.mark.parametrize("bad", [dict(iterations=-1), dict(iterations=1.5), dict(damping=1.1), dict(damping=-0.1), dict(checkpoint_every=0), dict(num_partitions=0), dict(hot_links=0)])
def test_bad_arguments(toy, bad):
    with pytest.raises(ValueError):
        pagerank(toy, **bad)


@pytest.mark.parametrize("options", [{}, {"durable": True}, {"block_size": 2}, {"numbered": True}])
def test_storage_is_given_back(spark, toy, options):
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    pagerank(toy, 2, **options)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def plan_paths(df):
    """Operator names from the root to each leaf of the physical plan."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    stack, paths = [(plan, [])], []
    while stack:
        node, above = stack.pop()
        path = above + [node.nodeName()]
        children = node.children()
        stack += [(children.apply(i), path) for i in range(children.size())]
        if children.isEmpty():
            paths.append((path, node.output().mkString(",")))
    return paths


@pytest.mark.parametrize("width", [4, 8, 16])
@pytest.mark.parametrize("hot_links", [None, 5])
@pytest.mark.parametrize("checkpoint", [False, True])
def test_links_are_not_moved_in_a_step(spark, orders, width, hot_links, checkpoint):
    """Stored links go into a merge join as they lie: no exchange, no sort. Nor are the shares of a checkpoint moved."""
    with shuffle_width(spark, width):
        graph = prepare_graph(orders, DegreeRule.ROWS, width, hot_links)
        try:
            assert graph.salted == (hot_links is not None)
            shares = page_shares(graph, rank_step(graph, None, 0.85, True), True)
            if checkpoint:
                shares = checkpoint_in_place(shares)
                assert shares.rdd.getNumPartitions() == width
            paths = plan_paths(ranks_from_shares(graph, shares, 0.85))
            links = [path for path, output in paths if "target" in output]
            assert len(links) == 2 - checkpoint
            for path in links:
                join = len(path) - 1 - path[::-1].index("SortMergeJoin")
                assert set(path[join + 1 :]) <= {"Filter", "InMemoryTableScan"}
            names = {name for path, _ in paths for name in path}
            assert not names & {"BroadcastExchange", "CartesianProduct", "BroadcastNestedLoopJoin"}
            # From the root to the first step: one exchange of sums for each step,
            # plus one of shares for salts.
            longest = max((path for path, _ in paths), key=lambda path: path.count("Exchange"))
            assert longest.count("Exchange") == (2 - checkpoint) * (1 + graph.salted)
            if checkpoint and not graph.salted:
                kept = next(path for path, _ in paths if "Scan ExistingRDD" in path[-1])
                assert kept.count("Exchange") == 1 and "Sort" not in kept
        finally:
            graph.release()


@pytest.mark.parametrize("block_size", [3, 100_000])
@pytest.mark.parametrize("durable", [False, True])
def test_blocks_are_not_moved_in_a_step(spark, orders, block_size, durable):
    """Adjacency blocks stay where they are; what a durable layout reads does not lead back to the input."""
    with shuffle_width(spark, 8):
        graph = prepare_graph(orders, DegreeRule.DISTINCT, 8, block_size=block_size, durable=durable)
        try:
            longest = graph.links.agg(F.max(F.size("neighbours"))).first()[0]
            assert graph.salted == (block_size == 3) and longest < 20 + block_size
            shares = page_shares(graph, rank_step(graph, None, 0.85, False), False)
            paths = plan_paths(ranks_from_shares(graph, shares, 0.85))
            blocks = [path for path, output in paths if "neighbours" in output]
            assert len(blocks) == 2
            for path in blocks:
                join = len(path) - 1 - path[::-1].index("SortMergeJoin")
                assert set(path[join + 1 :]) <= {"Filter", "InMemoryTableScan", "Scan ExistingRDD"}
            if durable:
                assert {path[-1] for path, _ in paths} == {"Scan ExistingRDD"}
        finally:
            graph.release()


def test_durable_links_do_not_read_the_input_again(spark, tmp_path):
    """The input may be gone once the links are laid out."""
    path = str(tmp_path / "edges")
    spark.range(500).selectExpr("id % 50 as source", "id % 7 as target").write.parquet(path)
    with shuffle_width(spark, 4):
        graph = prepare_graph(spark.read.parquet(path), DegreeRule.DISTINCT, 4, durable=True)
        spark.range(1).write.mode("overwrite").parquet(path)
        spark.catalog.clearCache()
        assert rank_step(graph, None, 0.85, False).count() == 7
        graph.release()


def test_blocks_of_a_hub_lie_in_many_tasks(spark):
    """Degrees and ranks meet the blocks of a page by page and block."""
    rows = spark.range(4000).selectExpr("case when id % 2 = 0 then 0 else id end as source", "id + 10000 as target")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        ranks = rows.selectExpr("source as page").distinct().withColumn("pagerank", F.lit(1.0))
        blocks = adjacency(rows, 10, ranks)
        sizes = blocks.where("page = 0").groupBy(F.spark_partition_id()).count().collect()
        held = [r["count"] for r in sizes]
        assert len(held) == 8 and max(held) < 0.3 * sum(held)
        assert blocks.agg(F.sum(F.size("neighbours"))).first()[0] == 4000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_rows_lie_in_the_partition_of_their_bucket(spark, orders):
    edges = orders.selectExpr("cast(source as string) as source", "target").unionByName(spark.createDataFrame([(None, 1)], "source string, target long"))
    placed = place_by_bucket(edges, 13)
    assert placed.rdd.getNumPartitions() == 13
    wrong = placed.where(F.spark_partition_id() != F.coalesce(md5_bucket(F.col("source"), 13), F.lit(0)))
    assert wrong.count() == 0 and partition_sizes(placed).agg(F.sum("n_rows")).first()[0] == edges.count()


def test_repeated_tasks_are_counted_once(toy):
    """What an observation shows of a task that ran twice, and what is reported then."""

    class Seen:
        def __init__(self, **values):
            self.get = values

    steps = []
    counted = CountedSteps(lambda *x: steps.append(x))
    counted._open = [(1, Seen(pages=7, tasks=2, parts=[0, 3]), toy), (2, Seen(pages=14, tasks=3, parts=[0, 3]), toy)]
    counted.report()
    assert steps == [(1, 7), (2, toy.count())]


def test_one_checkpoint_is_left(spark, orders):
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    gc.collect()
    before = set(folder.glob("rdd-*"))
    ranks = pagerank(orders, 10)
    left = [p for p in folder.glob("rdd-*") if p not in before and any(p.iterdir())]
    assert len(left) == 1 and ranks.count() == 1476


@pytest.mark.parametrize("width", [3, 20])
def test_the_asked_for_width_is_used(spark, orders, width):
    ranks = pagerank(orders, 2, num_partitions=width)
    assert ranks.rdd.getNumPartitions() == width and spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_single_pass_runs_no_job(spark, orders):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("single pass", "")
    try:
        rank_step(prepare_graph(orders, DegreeRule.ROWS, keep=False), None, 0.85, True)
        assert not tracker.getJobIdsForGroup("single pass")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# 300 pages that nobody links to, a ring they link into, a page without links behind it, and NULL ends.
LEAVES = [(f"s{i}", f"r{i % 10}") for i in range(300)] + [(f"r{i}", f"r{(i + 1) % 10}") for i in range(10)]
LEAVES += [("r0", "end"), ("s1", None), (None, "r1"), ("s2", "x"), ("x", "y")]


@pytest.mark.parametrize("options", [{}, {"durable": True}, {"block_size": 2}, {"numbered": True}, {"hot_links": 1}])
def test_later_steps_join_links_of_reached_pages_alone(spark, monkeypatch, options):
    """Links of pages nobody links to are joined once, and ranks are those of the plain loop."""
    df = spark.createDataFrame(LEAVES, "source STRING, target STRING")
    joined, along = [], LinkGraph.along_links

    def counted(graph, pages):
        rows = graph.links
        joined.append(rows.agg(F.sum(F.size("neighbours"))).first()[0] if "neighbours" in rows.columns else rows.count())
        return along(graph, pages)

    monkeypatch.setattr(LinkGraph, "along_links", counted)
    for semantics in RankSemantics:
        joined.clear()
        got = pagerank(df, 4, semantics=semantics, **options).where("page IS NOT NULL")
        want = {p: r for p, r in plain_pagerank(LEAVES, 4, 0.85, semantics).items() if p is not None}
        assert as_dict(got) == pytest.approx(want, abs=1e-9)
        assert joined[0] >= 313 and set(joined[1:]) == {12}


@pytest.mark.parametrize("semantics", RankSemantics)
def test_several_step_counts_come_from_one_run(spark, semantics):
    """The rank tables of a long run and of shorter ones, with copies and NULL ends."""
    rows = [*LEAVES, *LEAVES[:50], ("s1", None)]
    df = spark.createDataFrame(rows, "source STRING, target STRING")
    tables = pagerank_after(df, (3, 1), semantics=semantics)
    for steps, ranks in zip((1, 3), tables, strict=True):
        want = {p: r for p, r in plain_pagerank(rows, steps, 0.85, semantics).items() if p is not None}
        assert as_dict(ranks.where("page IS NOT NULL")) == pytest.approx(want, abs=1e-9)


def test_links_are_moved_once_unless_a_hub_fills_a_partition(spark, monkeypatch):
    """Rows go by their source alone; a hub, or a row repeated very often, is dealt by both ends first."""
    monkeypatch.setattr(graph_module, "MIN_HOT_LINKS", 100)
    even = spark.range(4000).selectExpr("concat('s', id % 900) as source", "concat('t', id % 70) as target")
    hub = even.unionAll(spark.range(4000).selectExpr("'hub' as source", "concat('t', id) as target"))
    copies = even.unionAll(spark.range(4000).selectExpr("'a' as source", "'b' as target"))
    with shuffle_width(spark, 8):
        for rows, lists, salted in ((even, True, False), (hub, False, True), (copies, False, False)):
            graph = prepare_graph(rows, DegreeRule.ROWS, 8)
            try:
                assert (graph.lists is not None, graph.salted) == (lists, salted)
                assert graph.links.select("source", "target").exceptAll(rows.distinct()).isEmpty()
                assert graph.links.count() == rows.distinct().count()
                assert graph.sources.agg(F.sum("degree")).first()[0] == rows.count()
            finally:
                graph.release()


def test_names_are_looked_up_in_a_hash_table(spark, monkeypatch):
    """Links are not sorted by name to be numbered, unless a partition would have too many pages for a hash table."""
    rows = spark.range(300).selectExpr("concat('p', id % 70) as source", "concat('t', id % 40) as target")
    for most in (1_000_000, 0):
        monkeypatch.setattr(numbering, "MAX_HASHED_PAGES", most)
        numbers = PageNumbers(rows, 4)
        links = numbers.links(rows)
        if most:
            assert "ShuffledHashJoin" in {name for path, _ in plan_paths(links) for name in path}
        assert links.count() == 300 and links.distinct().count() == rows.distinct().count()
        numbers.release()


def test_large_inputs_get_more_partitions(spark, monkeypatch):
    """Beyond ``MAX_ROWS`` rows a partition the width of the session is too small, unless the caller sets one."""
    rows = spark.range(2000).selectExpr("concat('p', id % 700) as source", "concat('p', id % 90) as target")
    plain = {r.page: round(r.pagerank, 9) for r in pagerank(rows, 3).collect()}
    monkeypatch.setattr(graph_module, "MAX_ROWS", 100)
    for wanted, width in ((None, 20), (3, 3)):
        graph = prepare_graph(rows, DegreeRule.ROWS, wanted)
        assert graph.width == width
        graph.release()
    assert {r.page: round(r.pagerank, 9) for r in pagerank(rows, 3).collect()} == plain


@pytest.mark.parametrize("options", [{}, {"block_size": 50}])
def test_lists_are_stored_on_disk_in_small_batches(spark, options):
    """Stored lists of links take no memory, in the whole graph and in its part; a batch has few rows."""
    rows = spark.range(12_000).selectExpr("concat('p', id % 6000) as source", "concat('p', id % 90) as target")
    graph = prepare_graph(rows, DegreeRule.ROWS, 2, **options)
    stored = graph.stored[1]
    with shuffle_width(spark, graph.width), small_batches(spark, LIST_ROWS):
        try:
            assert stored.storageLevel == LISTS and not LISTS.useMemory
            assert graph.links.count() >= 6000
            batches = stored._jdf.queryExecution().withCachedData().cacheBuilder().cachedColumnBuffers().count()
            assert batches >= 6000 / LIST_ROWS
            part = graph.leaving(rows.select(F.col("target").alias("page")).distinct(), 0.15)
            assert part.stored[1].storageLevel == LISTS
            part.release()
        finally:
            graph.release()
