"""Personalized PageRank against a direct computation."""

import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from brindle.operators import pagerank as pr
from brindle.session import work_path
from brindle.sources import readers


def brute(adjacency, sources, iterations, alpha=0.15):
    """Ranks with the edges of dangling nodes written out; mass sent to unknown ids is dropped."""
    sources = set(sources)
    links = {u: (vs or sorted(sources)) for u, vs in adjacency.items()}
    rank = {u: 1 / len(sources) if u in sources else 0.0 for u in links}
    for _ in range(iterations):
        mass = dict.fromkeys(links, 0.0)
        for u, vs in links.items():
            for v in vs:
                if v in mass:
                    mass[v] += rank[u] / len(vs)
        rank = {u: (alpha / len(sources) if u in sources else 0.0) + (1 - alpha) * mass[u] for u in links}
    return rank


def graph_of(spark, adjacency, sources, **options):
    table = spark.createDataFrame(list(adjacency.items()), "id bigint, neighbours array<bigint>")
    nodes, edges = pr.edges_from_adjacency(table)
    return pr.build_graph(nodes, edges, sources, **options)


def hub_graph():
    """One node with most edges out, one with most edges in, dangling nodes, repeated neighbours."""
    rng = random.Random(1)
    adjacency = {u: [rng.randrange(60) for _ in range(rng.choice([0, 1, 3]))] + ([7] if u % 2 else []) for u in range(60)}
    adjacency[5] = [rng.randrange(60) for _ in range(200)]
    adjacency[9] = []
    return adjacency


def close(got, expected):
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-12 for k in expected)


@pytest.mark.parametrize("shard_edges", [pr.SHARD_EDGES, 10])
@pytest.mark.parametrize("buckets", [None, 1, 5])
def test_ranks(spark, shard_edges, buckets):
    adjacency, sources = hub_graph(), [5, 9, 9, 20]
    graph = graph_of(spark, adjacency, sources, shard_edges=shard_edges)
    graph = pr.materialize(graph, buckets) if buckets else graph
    ranks = pr.iterate(graph, 4)
    close(dict(rows(ranks, "id", "rank")), brute(adjacency, sources, 4))
    assert abs(ranks.agg(F.sum("rank")).first()[0] - 1) < 1e-12
    assert (graph.edges.select("shard").distinct().count() > 1) == (shard_edges == 10)


def test_source_without_record_and_missing_targets(spark):
    adjacency = {1: [2, 99], 2: [], 3: [1]}
    graph = graph_of(spark, adjacency, [1, 50])
    base = work_path(spark, "ranks")
    ranks = pr.run_logged(graph, 2, base)
    close(dict(rows(ranks, "id", "rank")), brute(adjacency, [1, 50], 2))
    stats = pr.iteration_log(spark, base).where("iteration = 2").first()
    # 1->2, 1->99, 3->1 and 2->1, 2->50; ids 99 and 50 have no record.
    assert (stats.nodes, stats.edges, stats.messages, stats.missing) == (3, 5, 5, 2)
    assert abs(stats.mass - sum(brute(adjacency, [1, 50], 2).values())) < 1e-12 and stats.mass < 1


def test_repaired_edges_and_stats(spark):
    graph = graph_of(spark, {1: [2], 2: [], 3: [1, 1]}, [1, 3])
    assert rows(pr.repaired_edges(graph)) == [(1, 2), (2, 1), (2, 3), (3, 1), (3, 1)]
    assert tuple(pr.graph_stats(graph).first()) == (3, 3, 2)


def test_resume_equals_one_run(spark):
    graph = pr.materialize(graph_of(spark, hub_graph(), [1, 2]))
    base = work_path(spark, "ranks")
    pr.save_iteration(pr.iterate(graph, 2), base, 2)
    resumed = pr.iterate(graph, 3, pr.load_iteration(spark, base, 2))
    close(dict(rows(resumed, "id", "rank")), dict(rows(pr.iterate(graph, 5), "id", "rank")))


def test_top_ranks_break_ties_by_id(spark):
    ranks = spark.createDataFrame([(3, 0.25), (1, 0.25), (2, 0.5), (4, 0.0)], "id bigint, rank double")
    assert [tuple(r) for r in pr.top_ranks_text(ranks, 3).collect()] == [("0.50000", 2), ("0.25000", 1), ("0.25000", 3)]


def test_duplicate_node_record_fails(spark):
    table = spark.createDataFrame([(1, [2]), (1, [3])], "id bigint, neighbours array<bigint>")
    with pytest.raises(Exception, match="several node records"):
        pr.build_graph(*pr.edges_from_adjacency(table), [1])


def test_edges_without_node_record_are_left_out(spark):
    nodes = spark.createDataFrame([(1,), (2,)], "id bigint")
    edges = spark.createDataFrame([(1, 2), (7, 1), (7, 8)], "src bigint, dst bigint")
    graph = pr.build_graph(nodes, edges, [1])
    assert rows(graph.edges, "src", "dst") == [(1, 2)]
    assert rows(pr.dangling_nodes(graph)) == [(2, 1)]
    assert pr.missing_targets(graph) == 0


def test_no_source_is_an_error(spark):
    with pytest.raises(ValueError):
        graph_of(spark, {1: [2]}, [])


def test_adjacency_text(spark, tmp_path):
    path = tmp_path / "adj.txt"
    path.write_text("1 2  3\n 2\t1 1 \n\n4\n")
    assert rows(readers.adjacency_lists(spark, str(path))) == [(1, [2, 3]), (2, [1, 1]), (4, [])]


def test_stored_edges_are_not_shuffled(spark):
    graph = pr.materialize(graph_of(spark, hub_graph(), [1]))
    text = plan(pr.step(graph, pr.initial_ranks(graph).checkpoint()), "simple")
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 2 and all("Bucketed: true" in line for line in scans)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_a_cut_off_run_goes_on_by_itself(spark, monkeypatch):
    """The fourth step is cut off while it is written: it is done again, the three before it are not."""
    graph = pr.materialize(graph_of(spark, hub_graph(), [1, 2]))
    base = work_path(spark, "ranks")
    assert pr.iteration_log(spark, base).count() == 0
    saved, save = [], pr.save_iteration

    def cut(ranks, base, iteration):
        saved.append(iteration)
        save(ranks.limit(3) if len(saved) == 4 else ranks, base, iteration)
        if len(saved) == 4:
            raise OSError("lost")

    monkeypatch.setattr(pr, "save_iteration", cut)
    with pytest.raises(OSError):
        pr.run_logged(graph, 5, base)
    assert [r.iteration for r in pr.iteration_log(spark, base).orderBy("iteration").collect()] == [1, 2, 3]
    ranks = pr.run_logged(graph, 5, base)
    assert saved == [1, 2, 3, 4, 4, 5]
    close(dict(rows(ranks, "id", "rank")), brute(hub_graph(), [1, 2], 5))
    close(dict(rows(pr.run_logged(graph, 5, base), "id", "rank")), brute(hub_graph(), [1, 2], 5))
    assert len(saved) == 6 and pr.iteration_log(spark, base).count() == 5
    with pytest.raises(ValueError, match="alpha"):
        pr.run_logged(graph, 6, base, alpha=0.2)


def test_a_step_sorts_neither_edges_nor_nodes(spark):
    """At sizes where nothing is broadcast, a step builds hash tables of the ranks and sums."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nodes = spark.range(6)
        edges = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (3, 0)], "src bigint, dst bigint")
        graph = pr.materialize(pr.build_graph(nodes, edges, [0]))
        text = plan(pr.step(graph, pr.initial_ranks(graph)), "simple")
        assert "SortMergeJoin" not in text and text.count("ShuffledHashJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
