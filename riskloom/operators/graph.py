"""Relation graph between accounts, vendors and employees: degree, communities, rank, neighbour risk.

Edges are undirected and stored once, as (tenant_id, src, dst) with src < dst. Nodes are texts such
as ``ACCOUNT:ACC-1``. Iterations are joins and map-side combined aggregations only; no neighbour
list is ever collected, so a hub costs rows, not memory.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.features import ACCOUNT
from riskloom.operators.joins import lookup_join
from riskloom.operators.scoring import graph_motifs, graph_score
from riskloom.operators.stored import release, stored

NODE = ["tenant_id", "node"]
#: Edges of one node that stay together; a node with more is split into that many parts more.
HUB_EDGES = 100_000


def node(kind: str, column: str) -> Column:
    return F.when(F.col(column) != "", F.concat(F.lit(f"{kind}:"), F.col(column)))


def edges(tx: DataFrame, expenses: DataFrame | None = None, invoices: DataFrame | None = None) -> DataFrame:
    """Distinct relations seen in transactions, and in expenses through the invoice they name."""
    account, vendor, employee = node("ACCOUNT", "account_id"), node("VENDOR", "vendor_code"), node("EMPLOYEE", "employee_id")
    pairs = F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in ((account, vendor), (account, employee), (vendor, employee))])
    found = tx.select("tenant_id", "account_id", "vendor_code", "employee_id").distinct().select("tenant_id", F.inline(pairs))
    if expenses is not None and invoices is not None:
        inv = invoices.select("tenant_id", F.col("id").alias("invoice_id"), F.col("vendor_id").alias("vendor_code")).distinct()
        via = expenses.select("tenant_id", "employee_id", "invoice_id").distinct().join(inv, ["tenant_id", "invoice_id"])
        found = found.unionByName(via.select("tenant_id", vendor.alias("a"), employee.alias("b")))
    known = found.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    return known.select("tenant_id", F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct()


def both_ways(e: DataFrame) -> DataFrame:
    """(tenant_id, node, other) in both directions."""
    ends = F.array(
        F.struct(F.col("src").alias("node"), F.col("dst").alias("other")),
        F.struct(F.col("dst").alias("node"), F.col("src").alias("other")),
    )
    return e.select("tenant_id", F.inline(ends))


def degrees(e: DataFrame) -> DataFrame:
    return both_ways(e).groupBy(*NODE).agg(F.count("*").alias("degree"))


def _star(pairs: DataFrame) -> DataFrame:
    """One contraction round over (node, other): hang every larger neighbour on the smallest one."""
    least = pairs.groupBy(*NODE).agg(F.min("other").alias("m")).withColumn("m", F.least("m", "node"))
    return lookup_join(pairs, least, NODE, "other", "inner", max_bytes=None)


def components(e: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected component of every node, named after its smallest node, with its size.

    Alternates large-star and small-star contraction, which halves path lengths, so the number of
    rounds grows with the logarithm of the longest chain. Runs until nothing changes; reaching
    ``max_rounds`` is an error, never a partial answer.
    """
    # (node, other) with other < node: every node points to a smaller one.
    links = stored(e.select("tenant_id", F.col("dst").alias("node"), F.col("src").alias("other")))
    mark = None
    for _ in range(max_rounds):
        both = both_ways(links.select("tenant_id", F.col("other").alias("src"), F.col("node").alias("dst")))
        large = _star(both).where(F.col("other") > F.col("node")).select("tenant_id", F.col("other").alias("node"), F.col("m").alias("other")).distinct()
        # Small star: a node and its smaller neighbours all hang on the smallest of them.
        least = large.groupBy(*NODE).agg(F.min("other").alias("m"))
        hung = lookup_join(large, least, NODE, "other", "inner", max_bytes=None).where(F.col("other") != F.col("m")).select("tenant_id", F.col("other").alias("node"), F.col("m").alias("other"))
        own = least.select("tenant_id", "node", F.col("m").alias("other"))
        before, links = links, stored(hung.unionByName(own).where(F.col("node") != F.col("other")).distinct())
        release(before)
        row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*links.columns).cast("decimal(38,0)")).alias("h")).first()
        if (row.n, row.h) == mark:
            break
        mark = (row.n, row.h)
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    roots = links.select("tenant_id", F.col("other").alias("node"), F.col("other").alias("component")).distinct()
    members = links.select("tenant_id", "node", F.col("other").alias("component")).unionByName(roots)
    sizes = members.groupBy("tenant_id", "component").agg(F.count("*").alias("community_size"))
    # One component may hold most nodes, hence the balanced join.
    return lookup_join(members, sizes, ["tenant_id", "component"], "node", "inner", max_bytes=None).select(*NODE, "component", "community_size")


def placed_links(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges dealt once by source node, a hub's edges over its ``parts``, and kept in that place.

    A join on (tenant_id, node, part) finds them where they are: only the ranks move between rounds.
    """
    n = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of_node = lookup_join(links, nodes.select(*NODE, "parts"), NODE, "other", "inner", max_bytes=None)
    part = F.pmod(F.xxhash64("other"), F.col("parts")).cast("int")
    return of_node.select(*NODE, "other", part.alias("part")).repartition(n, *NODE, "part").persist(StorageLevel.MEMORY_AND_DISK)


def rank_round(links: DataFrame, nodes: DataFrame, ranks: DataFrame, damping: float) -> DataFrame:
    """One round: each node passes its rank on in equal shares. ``nodes`` and ``links`` are tables of their own, so a
    round adds one step to the plan of the ranks."""
    shares = ranks.select(
        *NODE, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), (F.col("pagerank") / F.col("degree")).alias("share")
    )
    received = links.join(shares, [*NODE, "part"]).groupBy("tenant_id", F.col("other").alias("node")).agg(F.sum("share").alias("got"))
    # Every node has an edge, hence a neighbour to receive from.
    return nodes.join(received, NODE).select(
        *NODE, "degree", "n_nodes", "parts", ((1.0 - damping) / F.col("n_nodes") + damping * F.col("got")).alias("pagerank")
    )


def _largest_move(before: DataFrame, after: DataFrame) -> float:
    both = before.select(*NODE, F.col("pagerank").alias("_before")).join(after, NODE)
    return both.agg(F.max(F.abs(F.col("pagerank") - F.col("_before")))).first()[0] or 0.0


def pagerank(
    e: DataFrame, iterations: int = 10, damping: float = 0.85, tolerance: float | None = None, store_every: int = 4,
    hub_edges: int = HUB_EDGES,
) -> DataFrame:
    """Rank per tenant graph; the ranks of a tenant sum to 1.

    Runs ``iterations`` rounds, or fewer when ``tolerance`` is given and no rank moved by more between two stored
    rounds. Lineage is cut every ``store_every`` rounds; tables of earlier rounds are deleted.
    """
    links = stored(both_ways(e))
    degree = links.groupBy(*NODE).agg(F.count("*").alias("degree"))
    n = degree.groupBy("tenant_id").agg(F.count("*").alias("n_nodes"))
    parts = F.ceil(F.col("degree") / F.lit(hub_edges)).cast("int").alias("parts")
    nodes = stored(lookup_join(degree, n, ["tenant_id"], "node", "inner", max_bytes=None).select(*NODE, "degree", "n_nodes", parts))
    kept = placed_links(links, nodes)
    ranks = nodes.select("*", (F.lit(1.0) / F.col("n_nodes")).alias("pagerank"))
    before = None
    for i in range(iterations):
        ranks = rank_round(kept, nodes, ranks, damping)
        if (i + 1) % store_every == 0 or i + 1 == iterations:
            ranks = stored(ranks)
            rest = tolerance is not None and before is not None and _largest_move(before, ranks) <= tolerance
            if before is not None:
                release(before)
            before = ranks
            if rest:
                break
    kept.unpersist()
    release(links)
    return ranks.select(*NODE, "pagerank")


def node_risk(alerts: DataFrame) -> DataFrame:
    """Mean alert score of each account, vendor and employee on a 0-1 scale."""
    kinds = F.array(node("ACCOUNT", "account_id"), node("VENDOR", "vendor_code"), node("EMPLOYEE", "employee_id"))
    rows = alerts.select("tenant_id", F.explode(F.array_compact(kinds)).alias("node"), "risk_score")
    return rows.groupBy(*NODE).agg((F.sum("risk_score") / F.count("*") / 999.0).alias("node_risk"))


def neighbor_risk(e: DataFrame, risk: DataFrame) -> DataFrame:
    """Average risk of the neighbours of each node; neighbours without alerts count as 0."""
    of_other = risk.select("tenant_id", F.col("node").alias("other"), "node_risk")
    joined = lookup_join(both_ways(e), of_other, ["tenant_id", "other"], "node", max_bytes=None)
    return joined.groupBy(*NODE).agg(F.avg(F.coalesce("node_risk", F.lit(0.0))).alias("avg_neighbor_risk"))


def node_metrics(e: DataFrame, alerts: DataFrame, iterations: int = 10) -> DataFrame:
    e = stored(e)
    parts = [degrees(e), components(e).drop("component"), pagerank(e, iterations), neighbor_risk(e, node_risk(alerts))]
    return reduce(lambda a, b: a.join(b, NODE), parts)


def score_with_metrics(tx: DataFrame, metrics: DataFrame) -> DataFrame:
    """Graph score and motifs of each transaction from the metrics of its account."""
    names = ["degree", "community_size", "pagerank", "avg_neighbor_risk"]
    own = metrics.where(F.col("node").startswith("ACCOUNT:")).select(
        "tenant_id", F.substr("node", F.lit(len("ACCOUNT:") + 1)).alias("account_id"), *names
    )
    joined = lookup_join(tx.select("id", *ACCOUNT), own, ACCOUNT, "id", max_bytes=None)
    cols = {c: F.col(c) for c in names}
    return joined.select(
        "id", *ACCOUNT, graph_score(cols).alias("graph_score"), graph_motifs(cols).alias("graph_motifs")
    )
