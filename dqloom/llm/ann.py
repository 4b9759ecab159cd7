"""Approximate nearest neighbours by inner product: balanced posting lists.

Vectors get one more component so that the largest inner product is the smallest distance. Centroids are
fitted on a bounded sample (``SAMPLE`` rows by hash) with a penalty on large clusters, about one for each
square root of the rows, ``MOST_LISTS`` at most, and linked to a nearest-neighbour graph that every task holds
in memory. Every row goes to its nearest list, and a boundary row also to other lists whose centroid is at
most ``NEAR`` times as far, ``COPIES`` lists in all. A query walks the graph best first and takes the lists
that are at most ``RATIO`` times as far as the nearest one (distance-ratio pruning), and more until they hold
``LEAST_ROWS`` rows. Queries that still find fewer than asked for look into all lists.

Lists of any size are split into parts of about ``PART`` rows, and the queries of a list into blocks of as
many, so a very common vector or list is shared out between tasks. Parts and blocks meet in cogroups; each
gives its best for every query, and the best of those are the result. Scores are inner products of the
original vectors in double precision, always added in the same order, so equal vectors tie exactly.

Vectors that are null, zero, hold a null or a non-finite component, or have another length than most take no
part, and neither do rows without id. Rows that repeat an id are one candidate (and one query) with the best
score. Ties go to the smaller id. Further columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqloom.llm.common import arrow_pass, cut, ship

SAMPLE = 20_000
MOST_LISTS = 4096
COPIES, NEAR = 4, 1.25
RATIO = 1.15
LEAST_ROWS = 1000
PART = 4096
NEIGHBOURS, ENTRIES = 16, 8


@dataclass(frozen=True)
class Index:
    """Centroids, their graph, entry points of a walk, and the squared norm that vectors are filled up to."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    full: float


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def filled_up(x: np.ndarray, full: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0.0, full - (x * x).sum(1)))
    return np.concatenate([x, rest[:, None]], 1)


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """Rows that take part, as ``id`` long and ``v`` array<double>."""
    v = F.col(column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (lengths["n"] if lengths else 0))


# --- fitting --------------------------------------------------------------------------------


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """k-means whose assignment counts how many rows a cluster already has."""
    random = np.random.default_rng(seed)
    _, first = np.unique(x, axis=0, return_index=True)
    centroids = x[random.permutation(first)[:k]].copy()
    k = len(centroids)
    penalty = np.zeros(k)
    for _ in range(rounds):
        far = ((x * x).sum(1)[:, None] - 2 * x @ centroids.T) + (centroids * centroids).sum(1)
        owner = (far + penalty).argmin(1)
        sizes = np.bincount(owner, minlength=k)
        spread = float(np.maximum(far.min(1), 0).mean())
        penalty += 0.1 * spread * (sizes / max(1.0, len(x) / k) - 1)
        penalty = np.clip(penalty, -spread, spread)
        total = np.zeros_like(centroids)
        np.add.at(total, owner, x)
        has = sizes > 0
        centroids[has] = total[has] / sizes[has, None]
    return centroids


def fit(rows: DataFrame, count: int, full: float) -> Index:
    # under a bound that some more rows than needed are expected to meet; equal rows count once
    bound = min(2**63 - 1, int(-(2**63) + 2**64 * (1.1 * SAMPLE + 500) / max(1, count)))
    place = F.xxhash64("id")
    sample = rows.where(place <= bound).select(place.alias("place"), "id", "v").distinct().collect()
    sample = sorted(sample, key=lambda r: (r["place"], r["id"], r["v"]))[:SAMPLE]
    x = filled_up(np.array([r["v"] for r in sample], np.float64), full)
    centroids = balanced_centroids(x, min(MOST_LISTS, max(1, round(math.sqrt(count)))))
    far = (centroids**2).sum(1) - 2 * centroids @ centroids.T
    graph = np.argsort(far, 1)[:, 1 : NEIGHBOURS + 1]
    # the ring keeps every centroid in reach of every other
    ring = (np.arange(len(centroids)) + 1) % len(centroids)
    step = max(1, len(centroids) // ENTRIES)
    return Index(centroids, np.concatenate([graph, ring[:, None]], 1), np.arange(0, len(centroids), step), full)


def near_lists(index: Index, x: np.ndarray) -> np.ndarray:
    """Flags (rows by lists): the nearest list, and up to ``COPIES`` in all that are nearly as near."""
    far = np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ index.centroids.T + (index.centroids**2).sum(1))
    copies = min(COPIES, far.shape[1])
    nearest = np.argsort(far, 1, kind="stable")[:, :copies]
    distance = np.take_along_axis(far, nearest, 1)
    near = distance <= NEAR**2 * distance[:, :1]
    near[:, 0] = True
    flags = np.zeros(far.shape, bool)
    np.put_along_axis(flags, nearest, near, 1)
    return flags


def walk(index: Index, q: np.ndarray, sizes: np.ndarray) -> list[int]:
    """Lists for one query: best first over the graph, until all within the ratio are expanded.

    Lists are also taken, nearest first, until they hold ``LEAST_ROWS`` rows.
    """
    centroids, graph = index.centroids, index.graph
    seen = set(index.entries.tolist())
    far = ((centroids[index.entries] - q) ** 2).sum(1)
    heap = list(zip(far.tolist(), index.entries.tolist()))
    heapq.heapify(heap)
    best, found, slack, held = heap[0][0], [], 2 * NEIGHBOURS, 0
    while heap:
        distance, node = heapq.heappop(heap)
        best = min(best, distance)
        if distance > RATIO**2 * best and held >= LEAST_ROWS:
            slack -= 1
            if slack < 0:
                break
        found.append((distance, node))
        held += sizes[node]
        fresh = [n for n in graph[node].tolist() if n not in seen]
        if fresh:
            seen.update(fresh)
            for d, n in zip(((centroids[fresh] - q) ** 2).sum(1).tolist(), fresh):
                heapq.heappush(heap, (d, n))
    taken, held = [], 0
    for distance, node in sorted(found):
        if distance > RATIO**2 * best and held >= LEAST_ROWS:
            break
        taken.append(node)
        held += sizes[node]
    return taken


# --- posting lists and search ---------------------------------------------------------------


def posting_lists(rows: DataFrame, index: Index) -> DataFrame:
    """list, id, v: every row in its lists."""
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def make(batch):
        for a in range(0, batch.num_rows, 2000):
            part = batch.slice(a, 2000)
            flags = near_lists(shared.value, filled_up(matrix(part.column("v")), shared.value.full))
            row, number = np.nonzero(flags)
            taken = part.take(pa.array(row))
            yield {"list": pa.array(number.astype(np.int32)), "id": taken.column("id"), "v": taken.column("v")}

    return arrow_pass(rows, make, "list int, id long, v array<double>")


def query_lists(queries: DataFrame, index: Index, sizes: dict[int, int], all_lists: bool = False) -> DataFrame:
    """list, id, v: every query with each list it looks into."""
    rows = np.array([sizes.get(n, 0) for n in range(len(index.centroids))])
    shared = queries.sparkSession.sparkContext.broadcast((index, rows))

    def make(batch):
        held, rows = shared.value
        full = np.flatnonzero(rows).tolist()
        x = matrix(batch.column("v"))
        scaled = x * (math.sqrt(held.full) / np.sqrt((x * x).sum(1)))[:, None]
        scaled = np.concatenate([scaled, np.zeros((len(x), 1))], 1)
        lists = [full if all_lists else walk(held, q, rows) for q in scaled]
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        taken = batch.take(pa.array(row))
        number = np.concatenate([np.array(x, np.int32) for x in lists])
        yield {"list": pa.array(number), "id": taken.column("id"), "v": taken.column("v")}

    return arrow_pass(queries, make, "list int, id long, v array<double>")


def best_of(queries: np.ndarray, q_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """Query number, id and score of the k best rows of every query."""
    rough = queries @ rows.T
    rough[q_ids[:, None] == ids[None, :]] = -np.inf
    n = min(k, len(ids))
    least = np.partition(rough, len(ids) - n, axis=1)[:, len(ids) - n]
    slack = 1e-9 * (1 + np.sqrt((queries * queries).sum(1)) * np.sqrt((rows * rows).sum(1).max()))
    q, r = np.nonzero((rough >= (least - slack)[:, None]) & (rough > -np.inf))
    exact = np.concatenate([
        (queries[q[i : i + 50_000]] * rows[r[i : i + 50_000]]).sum(1) for i in range(0, len(q), 50_000)
    ] or [np.zeros(0)])
    order = np.lexsort((ids[r], -exact, q))
    q, r, exact = q[order], r[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < k
    return q[keep], ids[r[keep]], exact[keep]


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query.

    ``is_query`` is a condition on the column ``id``.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = cut(usable(vectors, id_column, column), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    count, full = rows.agg(F.count("*"), F.max(norm)).first()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = fit(rows, count, float(full) * (1 + 1e-9))
    postings = cut(posting_lists(rows, index), "postings")
    sizes = _sizes(postings)
    queries = rows.where(is_query)
    found = _nearest(postings, sizes, cut(query_lists(queries, index, sizes), "looked-up"), k)
    counts = found.groupBy("query_id").count().withColumnRenamed("query_id", "id")
    short = queries.join(counts, "id", "left").where(F.coalesce("count", F.lit(0)) < k).select("id", "v")
    if short.isEmpty():
        return found
    # repeated ids can leave a query short of candidates: it looks into all lists
    again = _nearest(postings, sizes, cut(query_lists(short, index, sizes, all_lists=True), "looked-up"), k)
    rest = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti")
    return rest.unionByName(again)


def _sizes(frame: DataFrame) -> dict[int, int]:
    """Rows by list: one number for each list, ``MOST_LISTS`` at most."""
    return {r["list"]: r["count"] for r in frame.groupBy("list").count().collect()}


def _nearest(postings: DataFrame, sizes: dict[int, int], looked: DataFrame, k: int) -> DataFrame:
    """The k best of the lists that each query looks into."""
    asked = _sizes(looked)
    table = postings.sparkSession.createDataFrame(
        [(n, -(-sizes.get(n, 1) // PART), -(-asked[n] // PART)) for n in asked] or [(-1, 1, 1)],
        "list int, parts int, blocks int",
    )

    def dealt(frame: DataFrame, own: str, other: str) -> DataFrame:
        """Each row to its own part, once for every block of the other side."""
        named = frame.join(F.broadcast(table), "list")  # a row for each list, MOST_LISTS at most
        mine = F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(own[:-1])
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[:-1])
        return named.select("list", mine, every, "id", "v")

    left = dealt(postings, "parts", "blocks").groupBy("list", "part", "block")
    right = dealt(looked, "blocks", "parts").groupBy("list", "part", "block")

    def meet(one: pa.Table, two: pa.Table) -> pa.Table:
        q, q_ids, vec, score = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.float64))
        if one.num_rows and two.num_rows:
            one, two = one.combine_chunks(), two.combine_chunks()
            q_ids = two["id"].to_numpy()
            q, vec, score = best_of(
                matrix(two["v"].chunk(0)), q_ids, matrix(one["v"].chunk(0)), one["id"].to_numpy(), k
            )
        return pa.table({"query_id": q_ids[q], "vec_id": vec, "score": score})

    met = left.cogroup(right).applyInArrow(meet, "query_id long, vec_id long, score double")
    single = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return cut(ranked.select("query_id", "rank", "vec_id", "score"), "nearest")
