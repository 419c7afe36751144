"""Exact largest inner products by branch and bound in ball trees, one tree per shard of vectors.

A node of the tree has a center and a radius; no vector in it has a larger inner product with q than
center.q + radius * |q|. Nodes are visited by that bound, largest first, until it falls below the score that the query's
k-th best candidate has so far, over all shards that the task has searched. Shards have a bounded number of vectors;
queries come in blocks of bounded size, and every block meets every group of shards in a task of its own. The first group
is searched first, and its k-th scores are the floors that the searches in all other groups start from.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostvane.llm.shared import stored

K = 5
SCALE = 256
#: Vectors of a shard, vectors of a leaf, shards of a group (searched by one task), queries of a block; averages.
SHARD, LEAF, GROUP, BLOCK = 8192, 64, 8, 1024

_LONG = 2**63 - 1


class BallTree:
    """Vectors in order of the leaves, and nodes: center, radius, span of vectors, children (-1: a leaf)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        points = vectors.astype(np.float64)
        centers, radii, spans, children = [], [], [], []
        todo = [(0, len(ids), None)]
        while todo:
            start, end, parent = todo.pop()
            own = points[order[start:end]]
            center = own.mean(0)
            away = np.sqrt(((own - center) ** 2).sum(1))
            node = len(centers)
            centers.append(center)
            radii.append(away.max())
            spans.append((start, end))
            children.append([-1, -1])
            if parent is not None:
                children[parent[0]][parent[1]] = node
            if end - start > leaf and away.max() > 0:  # split across the direction of two distant vectors
                a = own[away.argmax()]
                b = own[((own - a) ** 2).sum(1).argmax()]
                middle = (end - start) // 2
                order[start:end] = order[start:end][np.argpartition(own @ (b - a), middle)]
                todo += [(start, start + middle, (node, 0)), (start + middle, end, (node, 1))]
        self.ids, self.vectors = ids[order], vectors[order]
        self.centers, self.radii = np.array(centers), np.array(radii)
        self.spans, self.children = spans, children


def exact(vectors: np.ndarray, other: np.ndarray) -> bool:
    """Whether sums of products are whole numbers that doubles hold exactly."""
    largest = [float(np.abs(v.astype(np.float64)).max(initial=0)) for v in (vectors, other)]
    return largest[0] * largest[1] * max(1, vectors.shape[1]) < 2**53


class Best:
    """The k best (score, id) so far, by score, then smaller id; `floor` is a score that k candidates are known to reach."""

    def __init__(self, k: int, floor: int | None):
        self.k, self.floor, self.scores, self.ids = k, floor, [], []

    def kth(self) -> float:
        own = self.scores[-1] if len(self.scores) == self.k else -np.inf
        return own if self.floor is None else max(own, self.floor)

    def add(self, scores, ids) -> None:
        found = sorted(zip([-s for s in scores] + [-s for s in self.scores], list(ids) + self.ids, strict=True))[: self.k]
        self.scores, self.ids = [-s for s, _ in found], [i for _, i in found]


def search(tree: BallTree, queries: np.ndarray, query_ids: list[int], best: list[Best]) -> None:
    """Update the best of every query with the tree's vectors; vectors with the query's own id take no part."""
    width = tree.vectors.shape[1]
    if queries.shape[1] != width:  # components that one side lacks are 0
        fitted = np.zeros((len(queries), width), dtype=queries.dtype)
        common = min(width, queries.shape[1])
        fitted[:, :common] = queries[:, :common]
        queries = fitted
    plain = exact(tree.vectors, queries)
    points = tree.vectors.astype(np.float64 if plain else object)
    asked = queries.astype(np.float64)
    norm = np.sqrt((asked**2).sum(1))
    bounds = asked @ tree.centers.T + norm[:, None] * tree.radii
    bounds += 1e-9 * (np.abs(asked) @ np.abs(tree.centers).T + norm[:, None] * tree.radii) + 1e-9
    for k, own in enumerate(best):
        q, bound = (asked[k] if plain else queries[k].astype(object)), bounds[k].tolist()
        todo = [(-bound[0], 0)]
        while todo and -todo[0][0] >= own.kth():
            _, node = heapq.heappop(todo)
            left, right = tree.children[node]
            if left >= 0:
                heapq.heappush(todo, (-bound[left], left))
                heapq.heappush(todo, (-bound[right], right))
                continue
            start, end = tree.spans[node]
            scores, ids = points[start:end] @ q, tree.ids[start:end]
            good = (scores >= own.kth()) & (ids != query_ids[k])
            if good.any():
                own.add([int(s) for s in scores[good]], ids[good].tolist())


def matrix(rows: Iterable) -> np.ndarray:
    """Vectors as rows of whole numbers, in the smallest type that holds them; shorter ones are filled with 0."""
    rows = [np.asarray(row, dtype=np.int64) for row in rows]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), dtype=np.int64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    small = np.abs(out).max(initial=0) < 2**15
    return out.astype(np.int16) if small else out


def quantised(embedding: str | Column, scale: int = SCALE) -> Column:
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))


def usable(vec_id: str, embedding: str) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & finite


def top_k(vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding", shard: int = SHARD, leaf: int = LEAF, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """Each query's k largest inner products: query_id, rank (from 1), vec_id, score.

    Components become floor(256 * x). Candidates are all vectors but those with the query's id; ties go to the smaller
    vec_id, and repeated rows are candidates of their own. Vectors that are null or hold null or non-finite components,
    and those without an id, take no part. Missing components at the end count as 0, so an empty vector scores 0
    everywhere. Scores beyond a long are cut to its range. Other columns are ignored; no vectors, no rows.
    """
    spark = vectors.sparkSession
    kept = vectors.where(usable(vec_id, embedding)).select(
        F.col(vec_id).cast("long").alias("vec_id"), quantised(embedding).alias("vector"), is_query.alias("asks")
    )
    rows = stored(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = max(1, -(-size[0] // shard)), max(1, -(-size[1] // block))
    groups = -(-shards // group)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        tree = BallTree(rows["vec_id"].to_numpy(), matrix(rows["vector"]), leaf)
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "tree": [pickle.dumps(tree)]})

    trees = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).groupBy("shard").applyInPandas(build, "shard long, tree binary")
    trees = stored(trees.withColumn("group", F.pmod("shard", F.lit(groups))), "trees")
    asked = rows.where("asks").select("row", F.col("vec_id").alias("query_id"), "vector", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).alias("block"))

    def search_cell(trees: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        best = [Best(k, None if pd.isna(f) else int(f)) for f in asked["floor"]]
        if len(asked):
            queries, ids = matrix(asked["vector"]), asked["query_id"].tolist()
            for tree in trees.sort_values("shard")["tree"]:
                search(pickle.loads(tree), queries, ids, best)
        out = [(row, query, i, max(-_LONG, min(_LONG, s))) for row, query, own in zip(asked["row"], asked["query_id"], best, strict=True) for i, s in zip(own.ids, own.scores, strict=True)]
        return pd.DataFrame(out, columns=["row", "query_id", "vec_id", "score"])

    def searched(low: int, high: int, asked: DataFrame) -> DataFrame:
        """All blocks against the groups low..high."""
        numbers = {name: F.explode(F.sequence(F.lit(a).cast("long"), F.lit(b).cast("long"))) for name, a, b in (("block", 0, blocks - 1), ("group", low, high))}
        cells = trees.where(F.col("group").between(low, high)).withColumn("block", numbers["block"])
        pairs = cells.groupBy("block", "group").cogroup(asked.withColumn("group", numbers["group"]).groupBy("block", "group"))
        return pairs.applyInPandas(search_cell, "row long, query_id long, vec_id long, score long")

    best_first = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    found = searched(0, 0, asked.withColumn("floor", F.lit(None).cast("long")))
    if groups > 1:
        found = stored(found, "first-group")
        floors = found.groupBy("row").agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") == k).drop("n")
        found = found.unionByName(searched(1, groups - 1, asked.join(floors, "row", "left")))
    ranked = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
