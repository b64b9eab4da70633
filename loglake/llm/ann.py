"""Approximate nearest neighbours by balanced posting lists.

A bounded sample is clustered by repeated balanced splits; its centroids make up the index
that every task holds in memory, with a neighbour graph over them. Every vector is then
posted to its nearest list and, at a boundary, to others that are nearly as near and lie in another
direction. A query walks the graph to its nearest centroids, drops lists whose distance
exceeds that of the nearest by a ratio, and is compared exactly with the vectors of the others.
Long lists are cut into blocks, so no task holds a whole list.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush, heapreplace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglake.session import written

SAMPLE = 16_384
LIST_SAMPLE = 64  # sampled vectors per list, at most twice as many
SPLIT = 8
COPIES = 4
BOUNDARY = 1.15
GRAPH_LINKS = 16
BEAM = 96
PROBES = 48
RATIO = 1.6
BLOCK = 4096
SEED = 5


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """Key and vector of doubles, where the vector is not null or empty, has finite components only and is not zero.

    Rows without a key take no part.
    """
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    doubles = vectors.select(F.col(key).alias("id"), F.col(column).cast("array<double>").alias("vector"))
    return doubles.where(F.col("id").isNotNull() & finite & F.exists(v, lambda x: x != 0))


def matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.array(rows, np.float64).reshape(len(rows), -1)


def unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale  # keeps squares from over- or underflowing
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _balanced_split(x: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """k-means of unit vectors in which a cluster's size counts against it."""
    centers = x[draw.choice(len(x), k, replace=False)]
    target, penalty = len(x) / k, np.zeros(k)
    label = np.zeros(len(x), int)
    for _ in range(12):
        label = (2 - 2 * x @ centers.T + penalty).argmin(axis=1)
        size = np.bincount(label, minlength=k)
        penalty += 0.05 * (size - target) / target
        sums = np.zeros_like(centers)
        np.add.at(sums, label, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norm > 0, sums / np.maximum(norm, 1e-12), x[draw.choice(len(x), k)])
    return label


@dataclass
class Index:
    centroids: np.ndarray
    links: np.ndarray  # neighbours of each centroid in the graph

    def walk(self, query: np.ndarray, beam: int) -> list[tuple[float, int]]:
        """(squared distance, list) of the nearest centroids found by best-first search."""
        starts = range(0, len(self.centroids), max(1, len(self.centroids) // 8))
        seen = set(starts)
        near = [(float(2 - 2 * self.centroids[s] @ query), s) for s in starts]
        best = [(-d, s) for d, s in near]
        heapify(near)
        heapify(best)
        while len(best) > beam:
            heappop(best)
        while near:
            d, at = heappop(near)
            if len(best) >= beam and d > -best[0][0]:
                break
            fresh = [n for n in self.links[at].tolist() if n not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            for e, n in zip((2 - 2 * self.centroids[fresh] @ query).tolist(), fresh):
                if len(best) < beam:
                    heappush(best, (-e, n))
                elif e < -best[0][0]:
                    heapreplace(best, (-e, n))
                else:
                    continue
                heappush(near, (e, n))
        return sorted((-d, n) for d, n in best)

    def lists_for_query(self, query: np.ndarray, probes: int, ratio: float) -> list[int]:
        """Nearest lists; those farther than ``ratio`` times the nearest are pruned."""
        found = self.walk(query, max(BEAM, probes))[:probes]
        limit = np.sqrt(max(found[0][0], 1e-9)) * ratio
        return [n for d, n in found if np.sqrt(max(d, 0.0)) <= limit]

    def posting(self, x: np.ndarray) -> list[list[int]]:
        """Lists of every row: the nearest, and at a boundary others in different directions."""
        k = min(COPIES * 2, len(self.centroids))
        distance = 2 - 2 * x @ self.centroids.T
        order = np.argpartition(distance, k - 1, axis=1)[:, :k]
        rows = np.arange(len(x))[:, None]
        order = order[rows, np.argsort(distance[rows, order], axis=1, kind="stable")]
        near = np.sqrt(np.maximum(distance[rows, order], 0))
        out = []
        for lists, d in zip(order, near):
            chosen = [int(lists[0])]
            for n, far in zip(lists[1:].tolist(), d[1:]):
                if far > BOUNDARY * d[0] or len(chosen) == COPIES:
                    break
                # a list closer to a chosen one than to the vector would be searched with that one
                if all(2 - 2 * self.centroids[n] @ self.centroids[c] > far * far for c in chosen):
                    chosen.append(n)
            out.append(chosen)
        return out


def fit(sample: np.ndarray) -> Index:
    """Splits the sample until clusters hold at most ``2 * LIST_SAMPLE`` vectors; links their centroids."""
    draw = np.random.default_rng(SEED)
    x = unit(sample)
    todo, centers = [np.arange(len(x))], []
    while todo:
        rows = todo.pop()
        label = None
        if len(rows) > 2 * LIST_SAMPLE:
            label = _balanced_split(x[rows], min(SPLIT, len(rows) // LIST_SAMPLE), draw)
            if np.bincount(label).max() == len(rows):  # nothing but copies
                label = None
        if label is None:
            mean = x[rows].mean(axis=0)
            norm = np.linalg.norm(mean)
            centers.append(mean / norm if norm > 1e-12 else x[rows[0]])
        else:
            todo += [rows[label == c] for c in np.unique(label)]
    centroids = np.array(centers)
    k = min(GRAPH_LINKS + 1, len(centroids))
    order = np.argsort(-(centroids @ centroids.T), axis=1, kind="stable")[:, :k]
    # random long links keep separated groups of centroids connected
    far = draw.integers(0, len(centroids), (len(centroids), 4))
    return Index(centroids, np.concatenate((order, far), axis=1))


def sampled(vectors: DataFrame) -> np.ndarray:
    """Up to ``SAMPLE`` vectors chosen by a hash of their key."""
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toPandas()
    return np.array(rows["vector"].tolist(), np.float64)


def _post(vectors: DataFrame, index: Index, to_query: bool, probes: int, ratio: float) -> DataFrame:
    """Rows of (list, id, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                rows = batch.slice(low, 2048)
                x = unit(matrix(rows.column("vector")))
                lists = [index.lists_for_query(q, probes, ratio) for q in x] if to_query else index.posting(x)
                take = pa.array(np.repeat(np.arange(len(lists)), [len(n) for n in lists]))
                flat = pa.array(np.array([n for own in lists for n in own], np.int32))
                yield pa.RecordBatch.from_arrays(
                    [flat, rows.column("id").take(take), rows.column("vector").take(take)], ["list", "id", "vector"]
                )

    return vectors.mapInArrow(run, f"list int, id {vectors.schema['id'].dataType.simpleString()}, vector array<double>")


def _compare(k: int):
    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Best k of one block for each query, ties to the smaller id."""
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if left.empty or right.empty:
            return empty
        q, x = (unit(np.array(side["vector"].tolist(), np.float64)) for side in (left, right))
        ids = right["id"].to_numpy()
        out = []
        for query, own in zip(q, left["id"]):
            rough = x @ query
            rough[ids == own] = -np.inf
            if len(rough) > k:
                floor = -np.partition(-rough, k - 1)[k - 1] - 1e-9
                keep = np.flatnonzero((rough >= floor) & (ids != own))
            else:
                keep = np.flatnonzero(ids != own)
            # row sums give equal vectors equal scores, wherever they stand
            exact = (x[keep] * query).sum(axis=1)
            best = np.lexsort((ids[keep], -exact))[:k]
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids[keep][best], "score": exact[best]}))
        return pd.concat(out) if out else empty

    return compare


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    distinct = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return distinct.withColumn("rank", rank).where(F.col("rank") <= k)


def search(
    vectors: DataFrame,
    queries: DataFrame,
    key: str,
    column: str,
    k: int = 5,
    probes: int = PROBES,
    ratio: float = RATIO,
) -> DataFrame:
    """The ``k`` nearest of ``vectors`` by cosine for each of ``queries``: query_id, rank, vec_id, score.

    Unusable vectors (see ``usable``) neither ask nor answer. A query never finds its own
    key. Keys are taken to be unique; of rows with one key the best counts. Equal scores go by key. Vectors must all have one length. An empty
    side gives no rows. Lists searched for a query always hold more than ``k`` vectors if there are so many.
    """
    vectors = written(usable(vectors, key, column), "vectors")
    queries = usable(queries, key, column)
    kind = vectors.schema["id"].dataType.simpleString()
    schema = f"query_id {kind}, vec_id {kind}, score double"
    points = sampled(vectors)
    if not len(points):
        return vectors.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    index = fit(points)
    posted = written(_post(vectors, index, False, probes, ratio), "postings")
    asked = written(_post(queries, index, True, probes, ratio), "probes")
    blocks = posted.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    # one row per list, at most SAMPLE / LIST_SAMPLE * 2 of them
    blocks = F.broadcast(blocks)
    cut = posted.join(blocks, "list").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    spread = asked.join(blocks, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    found = (
        spread.select("list", "block", "id", "vector")
        .groupBy("list", "block")
        .cogroup(cut.select("list", "block", "id", "vector").groupBy("list", "block"))
        .applyInPandas(_compare(k), schema)
    )
    best = written(_best(found, k), "nearest")
    # queries that found fewer than k among their lists are compared with all vectors, in blocks
    enough = best.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = written(queries.join(enough, queries["id"] == enough["query_id"], "left_anti"), "short")
    if not short.isEmpty():
        rows = vectors.count()
        parts = max(1, -(-rows // BLOCK))
        every = short.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        whole = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
        more = every.groupBy("block").cogroup(whole.groupBy("block")).applyInPandas(_compare(k), schema)
        best = _best(best.select("query_id", "vec_id", "score").unionByName(more), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
