"""Random small graphs against the plain loop."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from test_pagerank import as_dict, plain_pagerank

from linkrank import RankSemantics, pagerank
from linkrank.plans.pagerank import pagerank_progress

PAGES = st.sampled_from("abcdef")
EDGES = st.lists(st.tuples(PAGES, st.one_of(PAGES, st.none())), min_size=1, max_size=25)
QUICK = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)


@QUICK
@given(edges=EDGES, steps=st.integers(1, 4), damping=st.sampled_from([0.0, 0.5, 0.85, 1.0]), hot=st.sampled_from([None, 1, 2]))
@pytest.mark.parametrize("semantics", RankSemantics)
def test_ranks_of_random_graphs(spark, semantics, edges, steps, damping, hot):
    df = spark.createDataFrame(edges, "source STRING, target STRING")
    got = as_dict(pagerank(df, steps, damping, semantics, num_partitions=3, hot_links=hot))
    assert got == pytest.approx(plain_pagerank(edges, steps, damping, semantics), abs=1e-9)


@QUICK
@given(edges=EDGES)
def test_dropped_pages_never_return(spark, edges):
    df = spark.createDataFrame(edges, "source STRING, target STRING")
    counts = pagerank_progress(df, iterations=3, semantics=RankSemantics.DISTINCT_DROP).orderBy("iteration").collect()
    want = [len(plain_pagerank(edges, k, 0.85, RankSemantics.DISTINCT_DROP)) for k in (1, 2, 3)]
    assert [r.n_pages for r in counts] == want and want == sorted(want, reverse=True)
