"""Street graphs: two-way edges, distances by rounds of joins, and single routes with turn restrictions."""

import heapq
import itertools
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.session import checkpointed


def both_ways(edges: DataFrame, oneway: str) -> DataFrame:
    """Directed edges (id, source, target, dir): forward always, backward unless one-way. One explode, no second scan."""
    ways = F.array(F.struct("source", "target", F.lit("F").alias("dir")), F.struct(F.col("target").alias("source"), F.col("source").alias("target"), F.lit("T").alias("dir")))
    kept = F.when(F.col(oneway), F.slice(ways, 1, 1)).otherwise(ways)
    return edges.select("id", F.explode(kept).alias("e")).select("id", "e.*")


def distances(edges: DataFrame, starts: DataFrame, rounds: int | None = None) -> DataFrame:
    """Least cost from the start nodes to each node, by relaxation in rounds of joins; with ``rounds``, over at most so many edges.

    The graph stays distributed; a round joins the nodes that improved with their edges. Stops when nothing improves. Without
    ``rounds``, raises if nodes still improve after as many rounds as the graph has nodes: then a cycle has a negative cost."""
    best = starts.select("node", F.lit(0).cast("long").alias("cost"))
    front, most = best, rounds
    for n in itertools.count():
        if n == rounds:
            break
        step = front.join(edges, front.node == edges.source).groupBy(F.col("target").alias("node")).agg(F.min(front["cost"] + edges["cost"]).alias("cost"))
        old = best.select("node", F.col("cost").alias("_old"))
        front = checkpointed(step.join(old, "node", "left").where("_old IS NULL OR cost < _old").select("node", "cost"))
        if front.isEmpty():
            break
        if most is None:
            most = edges.select("source").union(edges.select("target")).union(starts.select("node")).distinct().count()
        if rounds is None and n >= most:
            raise ValueError(f"nodes still improve after {most} rounds: a cycle has a negative cost")
        best = checkpointed(best.unionByName(front).groupBy("node").agg(F.min("cost").alias("cost")))
    return best


def distances_with_bans(edges: DataFrame, bans: DataFrame, starts: DataFrame, penalty: int) -> DataFrame:
    """Least cost from the start nodes to each other node that is reached, where a turn from one edge into the next (``bans``: first, second) costs ``penalty`` more.

    Edges (id, source, target, cost) become nodes, turns edges between them; that graph is relaxed like any other."""
    turns = edges.select(F.col("id").alias("source"), "target").join(edges.select(F.col("id").alias("next"), F.col("source").alias("target"), "cost"), "target")
    taken = turns.join(bans.select(F.col("first").alias("source"), F.col("second").alias("next")).withColumn("_ban", F.lit(True)), ["source", "next"], "left")
    graph = taken.select("source", F.col("next").alias("target"), (F.col("cost") + F.when(F.col("_ban"), penalty).otherwise(0)).alias("cost"))
    # a node of its own stands before the edges that leave the start
    first = edges.join(starts.select(F.col("node").alias("source")), "source", "left_semi").select(F.lit(None).cast("long").alias("source"), F.col("id").alias("target"), "cost")
    nodes = edges.select(F.col("id"), F.col("target").alias("node"))
    graph = checkpointed(graph.unionByName(first.withColumn("source", F.lit(-1).cast("long"))))
    found = distances(graph, starts.sparkSession.createDataFrame([(-1,)], "node long")).where("node <> -1").withColumnRenamed("node", "id")
    return found.join(nodes, "id").groupBy("node").agg(F.min("cost").alias("cost"))


def routes(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(node, cost, route): a cheapest route to each node that is reached, as nodes in order from its start; of equal ones by the smaller node before the end.

    Costs are positive. Routes grow back from all nodes at once, doubling: a node's route is its predecessors' so far with what is known of the first of them."""
    cost = checkpointed(distances(edges, starts))
    e = edges.join(cost.select(F.col("node").alias("source"), F.col("cost").alias("_a")), "source").join(cost.select(F.col("node").alias("target"), F.col("cost").alias("_b")), "target")
    before = e.where(F.col("_a") + F.col("cost") == F.col("_b")).groupBy(F.col("target").alias("node")).agg(F.min("source").alias("at"))
    start = cost.join(before, "node", "left").join(starts.select("node", F.lit(True).alias("_s")), "node", "left")
    table = checkpointed(start.select("node", "cost", F.when(F.col("_s"), F.lit(None)).otherwise(F.col("at")).alias("at"), F.array("node").alias("route")))
    while not table.where("at is not null").isEmpty():
        ahead = table.select(F.col("node").alias("_n"), F.col("at").alias("_at"), F.col("route").alias("_route"))
        table = checkpointed(table.join(ahead, table.at == ahead._n, "left").select("node", "cost", F.col("_at").alias("at"), F.when(F.col("at").isNull(), F.col("route")).otherwise(F.concat("_route", "route")).alias("route")))
    return table.select("node", "cost", "route")


def route(edges: Iterable[tuple], source, target, banned: Iterable[tuple] = (), penalty: float = 9999.0) -> list | None:
    """Edge ids of the cheapest route of a graph of (id, source, target, cost), for graphs that fit a worker.

    The search is over edges, so that a pair of edges in ``banned`` costs ``penalty`` more."""
    out: dict = {}
    for e in edges:
        out.setdefault(e[1], []).append(e)
    bans = set(banned)
    queue, seen, order = [(0.0, 0, None, source, ())], set(), 0
    while queue:
        cost, _, last, node, path = heapq.heappop(queue)
        if node == target:
            return [*_unwind(path)]
        if (last, node) in seen:
            continue
        seen.add((last, node))
        for id_, _, to, c in out.get(node, ()):
            order += 1
            heapq.heappush(queue, (cost + c + (penalty if (last, id_) in bans else 0), order, id_, to, (path, id_)))
    return None


def _unwind(path: tuple) -> list:
    ids = []
    while path:
        path, id_ = path
        ids.append(id_)
    return ids[::-1]
