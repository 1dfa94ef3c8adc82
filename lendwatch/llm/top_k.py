"""Exact top-k search by inner product: a KD-tree per shard, best-first traversal.

Vectors are dealt to shards of bounded size by a hash. A shard's tree splits at medians of its
widest dimension and keeps the tight box of every node. Queries come in blocks; each block first
searches one shard, and the k-th best score found there is propagated to all others, where a node
is opened only while its box may still hold a score that counts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendwatch.llm.vectors import is_finite, packed, stacked
from lendwatch.storage import materialize

INDEX = "dim int, shard long, ids binary, points binary, nodes binary, boxes binary"
BLOCKS = "dim int, block long, queries binary, wanted binary, kth binary"
HITS = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class SearchConfig:
    k: int = 5
    shard_rows: int = 2048
    block_rows: int = 512
    leaf_rows: int = 64


def build_tree(points: np.ndarray, leaf_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the points, nodes (start, end, left, right; 0 for a leaf) and boxes (low, high)."""
    order = np.arange(len(points))
    nodes, boxes, todo = [], [], [(0, len(points), -1, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        here = len(nodes)
        if parent >= 0:
            nodes[parent][2 + side] = here
        own = points[order[start:end]]
        low, high = own.min(axis=0), own.max(axis=0)
        nodes.append([start, end, 0, 0])
        boxes.append((low, high))
        widest = int((high - low).argmax())
        if end - start > leaf_rows and high[widest] > low[widest]:
            middle = (end - start) // 2
            order[start:end] = order[start:end][np.argpartition(own[:, widest], middle)]
            todo += [(start, start + middle, here, 0), (start + middle, end, here, 1)]
    return order, np.array(nodes, np.int64), np.array(boxes)


class Tree:
    def __init__(self, ids: np.ndarray, points: np.ndarray, nodes: np.ndarray, boxes: np.ndarray):
        self.ids, self.points, self.nodes = ids, points, nodes.tolist()
        self.low, self.high = boxes[:, 0], boxes[:, 1]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product any point of a node's box can have, with room for rounding."""
        up = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        size = np.abs(queries) @ np.maximum(np.abs(self.low), np.abs(self.high)).T
        return up + 1e-12 * size

    def search(self, own: int, query: np.ndarray, bounds: np.ndarray, kth: float, k: int) -> list[tuple[float, int]]:
        """Up to ``k`` best (score, id) of at least ``kth``; ties to the smaller id."""
        best: list[tuple[float, int]] = []  # a heap of (score, -id), the worst on top
        open_ = [(-bounds[0], 0)]
        while open_:
            bound, node = heapq.heappop(open_)
            if -bound < kth:
                break  # best-first: no other node reaches further
            start, end, left, right = self.nodes[node]
            if left:
                for child in (left, right):
                    if bounds[child] >= kth:
                        heapq.heappush(open_, (-bounds[child], child))
                continue
            scores = self.points[start:end] @ query
            for at in np.flatnonzero(scores >= kth).tolist():
                item = (float(scores[at]), -int(self.ids[start + at]))
                if -item[1] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                kth = max(kth, best[0][0])
        return [(score, -negative) for score, negative in best]


def _index(vectors: DataFrame, cfg: SearchConfig) -> DataFrame:
    def build(key, rows):
        points = stacked(rows["vector"], key[0])
        order, nodes, boxes = build_tree(points, cfg.leaf_rows)
        ids = rows["vec_id"].to_numpy(np.int64)[order]
        return pd.DataFrame([[key[0], key[1], packed(ids), packed(points[order]), packed(nodes), packed(boxes)]],
                            columns=["dim", "shard", "ids", "points", "nodes", "boxes"])

    return materialize(vectors.groupBy("dim", "shard").applyInPandas(build, INDEX), "kd-trees")


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """One row per (block, shard): the block's hits in that shard."""

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                dim, hits = r["dim"], ([], [], [])
                tree = Tree(
                    np.frombuffer(r["ids"], np.int64), np.frombuffer(r["points"]).reshape(-1, dim),
                    np.frombuffer(r["nodes"], np.int64).reshape(-1, 4), np.frombuffer(r["boxes"]).reshape(-1, 2, dim),
                )
                wanted = np.frombuffer(r["wanted"]).reshape(-1, dim)
                bounds = tree.bounds(wanted)
                kths = np.frombuffer(r["kth"])
                for i, own in enumerate(np.frombuffer(r["queries"], np.int64).tolist()):
                    for score, other in tree.search(own, wanted[i], bounds[i], kths[i], k):
                        hits[0].append(own)
                        hits[1].append(other)
                        hits[2].append(score)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hits[0], pa.int64()), pa.array(hits[1], pa.int64()), pa.array(hits[2], pa.float64())],
                    ["query_id", "vec_id", "score"],
                )

    return pairs.select("dim", "ids", "points", "nodes", "boxes", "queries", "wanted", "kth").mapInArrow(search, HITS)


def _blocks(queries: DataFrame) -> DataFrame:
    def pack(key, rows):
        return pd.DataFrame(
            [[key[0], key[1], packed(rows["vec_id"].to_numpy(np.int64)), packed(stacked(rows["vector"], key[0])),
              packed(rows["kth"].to_numpy(np.float64))]], columns=["dim", "block", "queries", "wanted", "kth"])

    return queries.groupBy("dim", "block").applyInPandas(pack, BLOCKS)


def search(vectors: DataFrame, is_query: Column, cfg: SearchConfig = SearchConfig()) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows of ``vectors(vec_id, vector)`` that query.

    Candidates are all rows with another id than the query's. Rows whose id or vector is NULL, or
    whose vector is empty or has a NULL or non-finite component, take no part; vectors of
    different lengths are never compared. A repeated id queries once per distinct vector and is
    returned once per row. Scores are exact where inner products of doubles are.
    """
    valid = vectors.filter(F.col("vec_id").isNotNull() & is_finite(F.col("vector")))
    valid = materialize(
        valid.select("vec_id", F.col("vector").cast("array<double>").alias("vector"),
                     F.size("vector").alias("dim"), is_query.alias("asks")), "vectors")
    sizes = valid.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("long")).alias("q"))
    # One row per length of vectors.
    layout = materialize(
        sizes.select("dim", F.ceil(F.col("n") / cfg.shard_rows).alias("shards"),
                     F.greatest(F.lit(1), F.ceil(F.col("q") / cfg.block_rows)).alias("blocks")), "layout")
    spread = F.xxhash64("vec_id", "vector")
    dealt = valid.join(layout, "dim").withColumns(
        {"shard": F.pmod(spread, "shards"), "block": F.pmod(F.xxhash64(F.lit(1), "vec_id", "vector"), "blocks")})
    index = _index(dealt.select("dim", "shard", "vec_id", "vector"), cfg)
    asked = dealt.filter("asks").select("dim", "block", "shards", "vec_id", "vector")
    asked = asked.dropDuplicates(["vec_id", "vector"])

    home = _blocks(asked.withColumn("kth", F.lit(float("-inf")))).join(layout, "dim")
    home = home.withColumn("shard", F.pmod("block", "shards"))
    # The k-th score in one shard is a lower bound of the k-th over all. A query with fewer hits has none.
    seeds = (
        _searched(home.join(index, ["dim", "shard"]), cfg.k)
        .groupBy("query_id")
        .agg(F.min("score").alias("seed"), F.count("*").alias("found"), F.countDistinct("vec_id").alias("ids"))
        .filter((F.col("found") == cfg.k) & (F.col("ids") == cfg.k))
        .select(F.col("query_id").alias("vec_id"), "seed")
    )
    known = asked.join(seeds, "vec_id", "left").withColumn("kth", F.coalesce("seed", F.lit(float("-inf"))))
    blocks = materialize(_blocks(known), "query-blocks").join(layout, "dim")
    # A stated query set against all rows, in blocks: every block meets every shard once.
    pairs = blocks.withColumn("shard", F.explode(F.expr("sequence(0L, shards - 1)"))).join(index, ["dim", "shard"])
    hits = materialize(_searched(pairs, cfg.k), "hits")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= cfg.k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k_report(embeddings: DataFrame, every: int = 50, cfg: SearchConfig = SearchConfig()) -> DataFrame:
    """Search over ``floor(256 x)``; the rows whose id is divisible by ``every`` query.

    NULL and repeated ids as in ``search``. Components and scores beyond the range of a long are
    held at its ends; ranks follow the scores as doubles.
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    vectors = embeddings.select("vec_id", F.when(is_finite(F.col("embedding")), whole).alias("vector"))
    found = search(vectors, F.col("vec_id") % every == 0, cfg)
    end = float(1 << 63)
    score = F.when(F.col("score") >= end, F.lit((1 << 63) - 1)).when(F.col("score") <= -end, F.lit(-(1 << 63)))
    return found.withColumn("score", score.otherwise(F.col("score").cast("long")))
