import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import graph

EDGE = "tenant_id long, src string, dst string"


def brute_components(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for t, a, b in edges:
        ra, rb = find((t, a)), find((t, b))
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    groups = {}
    for n in list(parent):
        groups.setdefault(find(n), []).append(n)
    return {n: (min(g)[1], len(g)) for g in groups.values() for n in g}


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components(spark, kind):
    if kind == "chain":
        ids = [f"n{i:04d}" for i in range(120)]
        random.Random(1).shuffle(ids)
        pairs = list(zip(ids, ids[1:]))
    elif kind == "star":
        pairs = [("hub", f"n{i}") for i in range(200)]
    else:
        rng = random.Random(2)
        pairs = [(f"n{rng.randrange(150)}", f"n{rng.randrange(150)}") for _ in range(90)]
    edges = sorted({(t, min(p), max(p)) for p in pairs if p[0] != p[1] for t in (1, 2)})
    got = graph.components(spark.createDataFrame(edges, EDGE))
    got = {(r.tenant_id, r.node): (r.component, r.community_size) for r in got.collect()}
    assert got == brute_components(edges)


def test_components_refuse_partial_answers(spark):
    edges = [(1, f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)]
    with pytest.raises(RuntimeError):
        graph.components(spark.createDataFrame(edges, EDGE), max_rounds=1)


def test_pagerank_sums_to_one_and_ranks_the_hub_first(spark):
    edges = [(1, "a-hub", f"n{i}") for i in range(20)] + [(2, "x", "y")]
    got = {(r.tenant_id, r.node): r.pagerank for r in graph.pagerank(spark.createDataFrame(edges, EDGE), 20).collect()}
    assert sum(v for (t, _), v in got.items() if t == 1) == pytest.approx(1.0)
    assert max(got, key=lambda k: got[k] if k[0] == 1 else 0)[1] == "a-hub"
    assert got[(2, "x")] == pytest.approx(0.5)


def plain_ranks(pairs, rounds, damping=0.85):
    near = {}
    for a, b in pairs:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    rank = {n: 1 / len(near) for n in near}
    for _ in range(rounds):
        rank = {n: (1 - damping) / len(near) + damping * sum(rank[m] / len(near[m]) for m in near[n]) for n in near}
    return rank


@pytest.mark.parametrize(("rounds", "hub_edges"), [(1, 1000), (7, 3), (8, 1)])
def test_split_hubs_rank_as_whole_ones(spark, rounds, hub_edges):
    pairs = [("hub", f"n{i}") for i in range(40)] + [(f"n{i}", f"n{i + 1}") for i in range(20)]
    got = graph.pagerank(spark.createDataFrame([(1, min(p), max(p)) for p in pairs], EDGE), rounds, hub_edges=hub_edges)
    assert {r.node: r.pagerank for r in got.collect()} == {n: pytest.approx(v) for n, v in plain_ranks(pairs, rounds).items()}


def test_rounds_end_when_ranks_rest(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "a")]
    df = spark.createDataFrame([(1, min(p), max(p)) for p in pairs], EDGE)
    got = graph.pagerank(df, 10_000, tolerance=1e-12, store_every=2)  # would not end in time otherwise
    assert [r.pagerank for r in got.collect()] == [pytest.approx(1 / 3)] * 3


def test_edges_stay_in_place_between_rounds(spark):
    """No exchange below a round's join on the side of the edges."""
    edges = spark.createDataFrame([(1, f"n{i % 50:02d}", f"n{50 + i}") for i in range(400)], EDGE)
    links = graph.both_ways(edges)
    nodes = links.groupBy(*graph.NODE).count().select(
        *graph.NODE, F.col("count").alias("degree"), F.lit(450).cast("long").alias("n_nodes"), F.lit(1).alias("parts")).checkpoint()
    kept = graph.placed_links(links, nodes)
    kept.count()
    ranks = nodes.withColumn("pagerank", F.lit(1.0))
    old = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = graph.rank_round(kept, nodes, ranks, 0.85)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[1])
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "InMemoryTableScan" in x and "part" in x)
    indent = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    join = max(i for i in range(at) if "SortMergeJoin" in lines[i] and len(lines[i]) - len(lines[i].lstrip(" :+-")) < indent)
    assert not any("Exchange" in x for x in lines[join:at])
    kept.unpersist()


def test_neighbor_risk(spark):
    edges = spark.createDataFrame([(1, "ACCOUNT:A", "VENDOR:V"), (1, "ACCOUNT:B", "VENDOR:V")], EDGE)
    alerts = spark.createDataFrame([(1, "A", "V", None, 999), (1, "B", "V", "", 0)], "tenant_id long, account_id string, vendor_code string, employee_id string, risk_score int")
    got = {r.node: r.avg_neighbor_risk for r in graph.neighbor_risk(edges, graph.node_risk(alerts)).collect()}
    assert got == {"VENDOR:V": pytest.approx(0.5), "ACCOUNT:A": pytest.approx(0.5), "ACCOUNT:B": pytest.approx(0.5)}
