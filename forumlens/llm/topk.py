"""Exact top-k inner products by dual-tree search over cover trees.

Queries and data are indexed together: both are vectors of one set, assigned to the same pivots, so a pivot's node
holds a group of queries and the data they are likely to meet. A node has a centre and a covering radius, the
exact largest distance of its vectors from the centre. For a query node (c, r) and a data node (d, s) no score is
above c.d + |c| s + |d| r + r s; a pair of nodes is pruned when this is below the worst kth score of the query group.

1. Pivots are chosen on a bounded sample, farthest first; every vector is assigned, and large nodes are cut into shards.
2. Each query group is searched in its own node, which gives every query a first kth score.
3. A group goes on to the nodes that its bound leaves; each shard searches it by its cover tree, and the best are merged.

Vectors that are equal are one, with its `k` + 1 smallest ids: no more can be among the best of a query,
since a query leaves out its own id only. So a vector that a third of all rows share costs one entry.

Defined cases: vectors that are null, empty, of another length than most (the smallest such length if that ties), or
hold null or non-finite components take no part, nor do rows without id. Rows that repeat an id and its vector are one; an
id with several vectors is a candidate for each, and asks with each (its best by vector are merged). A query leaves out all rows of its id.
Scores are exact in 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.session import stored

K = 5
SCALE = 256
SAMPLE = 8_192
#: Vectors that a shard should hold, and pivots at most (more vectors make more shards for a pivot).
SHARD = 4_096
PIVOTS = 1_024
LEAF = 48


class Node:
    __slots__ = ("centre", "norm", "radius", "members", "children")

    def __init__(self, points: np.ndarray, members: np.ndarray, centre: np.ndarray):
        self.centre, self.members, self.children = centre, members, []
        self.norm = float(np.sqrt(centre @ centre))
        gap = points[members] - centre
        self.radius = float(np.sqrt(np.einsum("ij,ij->i", gap, gap).max(initial=0.0)))


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> Node:
    """Each level's centres are farther apart than their covering distance, which shrinks by a third from level to level."""
    root = Node(points, np.arange(len(points)), points[0])
    todo = [(root, root.radius)]
    while todo:
        node, reach = todo.pop()
        some = node.members
        if len(some) <= leaf or node.radius == 0:
            continue
        reach = min(reach, node.radius) * 2 / 3
        own = points[some]
        far = np.full(len(some), np.inf)
        to = np.zeros(len(some), np.int64)
        centre, centres = int(np.argmin(((own - node.centre) ** 2).sum(axis=1))), 0
        while True:
            gap = own - own[centre]
            now = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            nearer = now < far
            far[nearer], to[nearer] = now[nearer], centres
            centres += 1
            centre = int(np.argmax(far))
            if far[centre] <= reach or centres > len(some) // 4:
                break
        if far[centre] > reach and centres > len(some) // 4:  # no cover of this distance is smaller than the set
            continue
        for c in range(centres):
            inside = np.flatnonzero(to == c)
            if len(inside) == len(some):
                break
            child = Node(points, some[inside], own[inside[np.argmin(far[inside])]])
            node.children.append(child)
            todo.append((child, reach))
    return root


class Best:
    """The `size` best (score, smallest id) for each query of a group; ids are those of distinct vectors."""

    def __init__(self, n: int, size: int):
        self.size = size
        self.score = np.full((n, size), -np.inf)
        self.which = np.full((n, size), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        score = np.concatenate([self.score[rows], scores], axis=1)
        which = np.concatenate([self.which[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((which, -score))[:, : self.size]
        self.score[rows] = np.take_along_axis(score, order, axis=1)
        self.which[rows] = np.take_along_axis(which, order, axis=1)


def bound(a: Node, b: Node) -> float:
    return float(a.centre @ b.centre) + a.norm * b.radius + b.norm * a.radius + a.radius * b.radius


def dual_search(queries: np.ndarray, data: np.ndarray, theirs: Node, ids: np.ndarray, best: Best, floor: np.ndarray) -> None:
    """Improve `best` by the data and its tree; `floor` has a score for each query that its kth best is known to reach."""
    ours = cover_tree(queries)
    todo = [(bound(ours, theirs), ours, theirs)]
    while todo:
        most, a, b = todo.pop()
        worst = np.maximum(best.score[a.members, -1], floor[a.members]).min()
        if most + 1e-6 * abs(most) + 1e-6 < worst:  # a tie may still win by its id
            continue
        if a.children and (not b.children or a.radius >= b.radius):
            pairs = [(x, b) for x in a.children]
        elif b.children:
            pairs = [(a, y) for y in b.children]
        else:
            for part in np.array_split(b.members, len(b.members) // 4096 + 1):
                scores = queries[a.members] @ data[part].T
                least = np.maximum(best.score[a.members, -1], floor[a.members])
                some = np.flatnonzero(scores.max(axis=1) >= least)
                if len(some):
                    best.add(a.members[some], scores[some], ids[part])
            continue
        todo += sorted(((bound(x, y), x, y) for x, y in pairs), key=lambda p: p[0])  # the most promising is taken next


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale x) of each component as a double, or null if the vector takes no part."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(F.coalesce(good, F.lit(False)) & (F.size(vector) > 0), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double")))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 1))


def nearest_pivot(points: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    square = (points * points).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * points @ pivots.T
    to = square.argmin(axis=1)
    gap = points - pivots[to]
    return to, np.sqrt((gap * gap).sum(axis=1))


def choose_pivots(points: np.ndarray, number: int) -> np.ndarray:
    """Farthest first."""
    chosen = [0]
    far = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(number, len(points)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score of each query's `k` highest scores, ties to the smaller id."""
    size = k + 1
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), whole_numbers(F.col(vector_column), scale).alias("v"), is_query.alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    widths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score long"
    if widths is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.filter(F.size("v") == widths["n"]).groupBy("id", "v").agg(F.max("asks").alias("asks"))
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(f"place <= {size}")
    asking = rows.filter("asks").groupBy("v").agg(F.lit(True).alias("asks"))
    alike = ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # at most k + 1 each
    points = stored(alike.join(asking, "v", "left").withColumn("asks", F.coalesce("asks", F.lit(False))).withColumn("first", F.col("ids")[0]), "points")

    total = points.count()
    drawn = points.orderBy(F.xxhash64("first"), "first").limit(SAMPLE).toPandas()
    pivots = choose_pivots(matrix(drawn["v"]), int(np.clip(-(-total // SHARD), 1, PIVOTS)))

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                to, gap = nearest_pivot(matrix(frame["v"]), pivots)
                yield frame.assign(pivot=to, gap=gap)

    placed = stored(points.drop("ids").mapInPandas(assign, "v array<double>, asks boolean, first long, pivot int, gap double"), "placed")
    found = placed.groupBy("pivot").agg(F.count("*"), F.max("gap"), F.max(F.when(F.col("asks"), F.col("gap")))).collect()  # a row for each pivot
    shards, radius, query_radius = np.zeros(len(pivots), np.int64), np.zeros(len(pivots)), np.zeros(len(pivots))
    for pivot, n, r, q in found:
        shards[pivot], radius[pivot], query_radius[pivot] = -(-n // SHARD), r, q or 0.0
    norm = np.sqrt((pivots * pivots).sum(axis=1))
    # a shard of a pivot: its rows by hash
    shard_of = F.pmod(F.xxhash64("first"), F.element_at(F.lit(shards.tolist()), F.col("pivot") + 1))
    data = placed.withColumn("shard", shard_of)

    def to_nodes(frames: Iterator[pd.DataFrame], own: bool) -> Iterator[pd.DataFrame]:
        """The nodes that each query group must visit; at first only its own."""
        for frame in frames:
            out = []
            for home, group in frame.groupby("pivot"):
                if own:
                    nodes = [home]
                else:
                    worst = group["floor"].min()
                    most = pivots @ pivots[home] + norm[home] * radius + norm * query_radius[home] + radius * query_radius[home]
                    nodes = [n for n in np.flatnonzero(most + 1e-6 * np.abs(most) + 1e-6 >= worst) if n != home and shards[n]]
                for node in nodes:
                    for shard in range(shards[node]):
                        out.append(group[["v", "first", "floor"]].assign(home=home, pivot=np.int32(node), shard=shard))
            if out:
                yield pd.concat(out, ignore_index=True)

    asked_schema = "v array<double>, first long, floor double, home int, pivot int, shard long"
    hit_schema = "asker long, first long, score double"

    def search(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        parts = []
        data_points, ids = matrix(mine["v"]), mine["first"].to_numpy()
        tree = cover_tree(data_points) if len(mine) and len(theirs) else None  # one tree for all groups
        for _, group in theirs.groupby("home") if tree is not None else ():
            best = Best(len(group), size)
            dual_search(matrix(group["v"]), data_points, tree, ids, best, group["floor"].to_numpy())
            asker = np.repeat(group["first"].to_numpy(), size)
            good = np.isfinite(best.score.ravel())
            parts.append(pd.DataFrame({"asker": asker[good], "first": best.which.ravel()[good], "score": best.score.ravel()[good]}))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"asker": [], "first": [], "score": []}).astype({"asker": "int64", "first": "int64", "score": "float64"})

    def searched(askers: DataFrame, own: bool) -> DataFrame:
        asked = askers.mapInPandas(lambda frames: to_nodes(frames, own), asked_schema)
        met = data.select("v", "first", "pivot", "shard").groupBy("pivot", "shard").cogroup(asked.groupBy("pivot", "shard")).applyInPandas(search, hit_schema)
        return met

    order = Window.partitionBy("asker").orderBy(F.desc("score"), "first")
    askers = placed.filter("asks").select("v", "first", "pivot")
    near = stored(searched(askers.withColumn("floor", F.lit(float("-inf"))), True), "near")
    # size-th best so far; a query with fewer has no floor
    floors = near.withColumn("place", F.row_number().over(order)).filter(f"place = {size}").select(F.col("asker").alias("first"), F.col("score").alias("floor"))
    with_floor = askers.join(floors, "first", "left").select("v", "first", "pivot", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    hits = near.unionByName(searched(with_floor, False)).withColumn("place", F.row_number().over(order)).filter(f"place <= {size}").drop("place")

    ids = points.select("first", "ids")
    answers = hits.join(ids, "first").select("asker", "score", F.explode("ids").alias("vec_id"))
    named = rows.filter("asks").join(points.select("v", F.col("first").alias("asker")), "v").select(F.col("id").alias("query_id"), "asker")
    merged = named.join(answers, "asker").filter("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(last)).filter(f"rank <= {k}").select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))
