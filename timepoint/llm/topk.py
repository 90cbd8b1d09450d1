"""Exact top-k by inner product: a ball tree per shard, searched by branch and bound.

All vectors are dealt over shards of bounded size; the queries come in blocks. A block first
visits one shard, which gives each query a k-th score to beat. That score travels with the
block to every shard, where the tree skips each node whose upper bound (query times centre
plus length times radius) is below it; of two children a query takes the more promising
first, and its k-th score rises as it goes. So a shard returns only what may be among the k
best, and a plain ranking of that is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timepoint.llm.common import arrow_map, durable

K, SCALE, EVERY = 5, 256, 50
SHARD, BLOCK, LEAF = 8192, 512, 64
_LOWEST = np.iinfo(np.int64).min
_HIGHEST = np.iinfo(np.int64).max


class BallTree:
    """Points halved along their widest component down to leaves; balls around the halves."""

    def __init__(self, ids: np.ndarray, points: np.ndarray) -> None:
        self._order = np.arange(len(ids))
        self.ids, self._points = ids, points
        self._nodes: list[tuple] = []
        # products of doubles are exact below 2^53, else integers are multiplied
        self._root = self._build(0, len(ids))
        self.ids, self._points = ids[self._order], points[self._order]

    def _build(self, start: int, stop: int) -> int:
        own = self._points[self._order[start:stop]].astype(np.float64)
        centre = own.mean(axis=0)
        radius = float(np.sqrt(((own - centre) ** 2).sum(axis=1).max()))
        number = len(self._nodes)
        self._nodes.append(())
        children = ()
        if stop - start > LEAF:
            widest = int(np.ptp(own, axis=0).argmax())
            middle = (stop - start) // 2
            self._order[start:stop] = self._order[start:stop][
                np.argpartition(own[:, widest], middle)
            ]
            children = (self._build(start, start + middle), self._build(start + middle, stop))
        self._nodes[number] = (centre, radius, start, stop, children)
        return number

    def search(
        self, ids: np.ndarray, queries: np.ndarray, kth: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores (queries x k) of the best points that reach ``kth``, ties by id."""
        exact = queries.astype(np.float64)
        length = np.sqrt((exact**2).sum(axis=1))
        most = float(length.max(initial=0)) * float(
            np.sqrt((self._points.astype(np.float64) ** 2).sum(axis=1)).max(initial=0)
        )
        left, points = (exact, self._points.astype(np.float64)) if most < 2**52 else (queries, self._points)
        best = np.full((len(ids), k), _LOWEST)
        found = np.full((len(ids), k), _HIGHEST)
        bound = kth.copy()
        slack = 1 + 1e-9 * most  # rounding of a bound never prunes

        def upper(node: int, some: np.ndarray) -> np.ndarray:
            centre, radius, *_ = self._nodes[node]
            return exact[some] @ centre + length[some] * radius + slack

        def visit(node: int, some: np.ndarray) -> None:
            some = some[upper(node, some) >= bound[some]]
            if not len(some):
                return
            _, _, start, stop, children = self._nodes[node]
            if children:
                one, two = children
                first = upper(one, some) >= upper(two, some)
                visit(one, some[first])
                visit(two, some[~first])
                visit(two, some[first])
                visit(one, some[~first])
                return
            scores = (left[some] @ points[start:stop].T).astype(np.int64)
            own = np.broadcast_to(self.ids[start:stop], scores.shape)
            out = (own == ids[some, None]) | (scores < bound[some, None])
            scores = np.concatenate([best[some], np.where(out, _LOWEST, scores)], axis=1)
            names = np.concatenate([found[some], np.where(out, _HIGHEST, own)], axis=1)
            # ~ instead of - : the lowest number has no negative
            order = np.lexsort((names, ~scores), axis=-1)[:, :k]
            best[some] = np.take_along_axis(scores, order, axis=1)
            found[some] = np.take_along_axis(names, order, axis=1)
            bound[some] = np.maximum(bound[some], best[some, k - 1])

        visit(self._root, np.arange(len(ids)))
        return found, best


def _quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of the vectors without NULL or non-finite components."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            ids, kept = [], []
            for vec_id, vector in zip(batch["vec_id"], batch["embedding"], strict=True):
                if vec_id is None or vector is None or None in vector:
                    continue
                x = np.array(vector, np.float64)
                if np.isfinite(x).all():
                    ids.append(vec_id)
                    kept.append(np.floor(scale * x).astype(np.int64).tobytes())
            yield {"vec_id": ids, "v": kept}

    slim = vectors.select(F.col("vec_id").cast("long"), "embedding")
    return arrow_map(slim, "vec_id bigint, v binary", work)


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    """Rows of equal width; missing components are 0."""
    out = np.zeros((len(vectors), width), np.int64)
    for row, own in enumerate(vectors):
        values = np.frombuffer(own, np.int64)
        out[row, : len(values)] = values
    return out


def _visits(shards: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """What each block of queries finds in the shard it is joined with."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        at, points, tree, width = None, [], None, 0
        for batch in batches:
            out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
            for shard, own, asked in zip(
                batch["shard"], batch["points"], batch["queries"], strict=True
            ):
                needed = max(len(x["v"]) for x in own + asked) // 8
                if shard != at or needed > width:
                    at, points, width = shard, own, needed
                    ids = np.array([p["vec_id"] for p in points], np.int64)
                    tree = BallTree(ids, _matrix([p["v"] for p in points], width))
                ids = np.array([q["vec_id"] for q in asked], np.int64)
                kth = np.array([_LOWEST if q["kth"] is None else q["kth"] for q in asked], np.int64)
                found, scores = tree.search(ids, _matrix([q["v"] for q in asked], width), kth, k)
                query, place = np.nonzero(scores != _LOWEST)
                out["query_id"] += ids[query].tolist()
                out["vec_id"] += found[query, place].tolist()
                out["score"] += scores[query, place].tolist()
            yield out

    # blocks are repeated for every shard after their size was last measured: never broadcast
    met = shards.join(blocks.hint("merge"), "shard").select("shard", "points", "queries")
    return arrow_map(met, "query_id bigint, vec_id bigint, score bigint", work)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    is_query: Column | None = None,
    k: int = K,
    scale: int = SCALE,
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """Each query's ``k`` highest inner products among the other vectors.

    Returns query_id, rank, vec_id, score; all others where there are fewer, ties to the
    smaller vec_id. Components become floor(scale * x); vectors that are NULL or hold NULL or
    non-finite components, and rows without a vec_id, take no part; missing components of
    shorter vectors count as 0; scores must fit in a long. A repeated vec_id is a candidate
    once for every row and never for itself. Queries are the rows whose vec_id is divisible by
    50 unless a condition on vec_id is given.
    """
    is_query = F.col("vec_id") % EVERY == 0 if is_query is None else is_query
    points = durable(_quantised(vectors, scale))
    n = points.count()
    queries = points.filter(is_query).dropDuplicates(["vec_id"])
    n_shards, n_blocks = max(1, -(-n // shard)), max(1, -(-points.filter(is_query).count() // block))
    at = F.monotonically_increasing_id()  # of checkpointed rows, so it stays
    shards = durable(
        points.withColumn("shard", F.pmod(F.xxhash64("vec_id", at), F.lit(n_shards)).cast("int"))
        .groupBy("shard")
        .agg(F.collect_list(F.struct("vec_id", "v")).alias("points"))
    )

    def blocks(asked: DataFrame, visited: Column) -> DataFrame:
        block_of = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_blocks)).cast("int")
        return (
            asked.groupBy(block_of.alias("block"))
            .agg(F.collect_list(F.struct("vec_id", "v", "kth")).alias("queries"))
            .select(F.explode(visited).alias("shard"), "queries")
        )

    fresh = queries.withColumn("kth", F.lit(None).cast("long"))
    one = F.array(F.pmod("block", F.lit(n_shards)).cast("int"))
    seen = _best(_visits(shards, blocks(fresh, one), k), k).filter(F.col("rank") == k)
    bounded = durable(
        queries.join(
            seen.select(F.col("query_id").alias("vec_id"), F.col("score").alias("kth")), "vec_id", "left"
        )
    )
    every = F.sequence(F.lit(0), F.lit(n_shards - 1))
    return _best(_visits(shards, blocks(bounded, every), k), k).select(
        "query_id", "rank", "vec_id", "score"
    )
