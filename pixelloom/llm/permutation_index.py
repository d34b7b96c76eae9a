"""Approximate nearest neighbours by a permutation index: ordered nearest pivots, pivot inverted files, footrule, rerank."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pixelloom.llm.common import materialise

#: Rows of one block of the index and queries of one chunk: what a task holds is bounded by them at every table size.
BLOCK_ROWS, CHUNK_QUERIES = 8192, 8192


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, one for each vec_id: no null, non-finite or zero vectors.

    Rows that share a vec_id count once, with the smallest vector.
    """
    v = F.col("embedding").cast("array<double>")
    good = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("v IS NOT NULL").where(good)
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def choose_pivots(rows: DataFrame, n: int) -> dict[int, np.ndarray]:
    """For each dimension n different vectors, of at most 20 n rows with the least hashes of their ids, as unit vectors."""
    by = Window.partitionBy(F.size("v")).orderBy(F.xxhash64("vec_id"), "vec_id")
    found = rows.withColumn("o", F.row_number().over(by)).where(F.col("o") <= 20 * n).select("v").collect()
    out: dict[int, list] = {}
    for v in dict.fromkeys(tuple(r.v) for r in found):
        out.setdefault(len(v), []).append(v)
    return {d: (x := np.array(vs[:n], dtype=np.float64)) / np.linalg.norm(x, axis=1, keepdims=True) for d, vs in out.items()}


def ordered_pivots(x: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The numbers of each row's nearest pivots by inner product, nearest first."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :nearest].astype(np.int16)


class InvertedFiles:
    """For each pivot the vectors that have it among their nearest, with the place that it has in their lists."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, nearest: int):
        self.ids, self.x, self.nearest = ids, x, nearest
        order = ordered_pivots(x, pivots, nearest)
        pivot = order.ravel()
        by_pivot = np.argsort(pivot, kind="stable")
        self.ends = np.searchsorted(pivot[by_pivot], np.arange(len(pivots) + 1))
        self.row, self.place = (by_pivot // order.shape[1]).astype(np.int32), (by_pivot % order.shape[1]).astype(np.int32)

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of every vector's list from a query's list: a pivot that one of them lacks is at the place after its last.

        Only the files of the query's pivots are read. A vector that is in none of them is at the largest distance; each
        posting brings it closer by what the two places have in common.
        """
        m, parts = self.nearest, [slice(self.ends[p], self.ends[p + 1]) for p in order]
        rows = np.concatenate([self.row[s] for s in parts])
        closer = np.concatenate([2 * m - i - self.place[s] - np.abs(self.place[s] - i) for i, s in enumerate(parts)])
        return m * (m + 1) - np.bincount(rows, weights=closer, minlength=len(self.ids))

    def search(self, own: int, q: np.ndarray, order: np.ndarray, k: int, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and inner products of the k best of the share of vectors with the least footrule, ties at its edge included."""
        far = self.footrule(order)
        keep = min(len(far), max(math.ceil(share * len(far)), 40 * k))
        edge = np.partition(far, keep - 1)[keep - 1]
        near = np.flatnonzero(far <= edge)
        near = near[self.ids[near] != own]
        score = self.x[near] @ q
        best = np.lexsort((self.ids[near], -score))[:k]
        return self.ids[near][best], score[best]


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, n_pivots: int = 256, nearest: int = 48, share: float = 0.15) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row with is_query, by inner product.

    Candidates are all rows of the query's dimension but its own. Every usable row is indexed, in blocks of about
    BLOCK_ROWS rows dealt by a hash of the id: under each of its nearest pivots. A query reads the files of its own nearest
    pivots, ranks the block's rows by footrule distance and reranks the share that comes first with the original vectors
    in double precision. Ties go to the smaller vec_id; fewer candidates than k are all returned. Null, zero and
    non-finite vectors neither search nor are found. An empty table gives no rows; other columns are ignored.

    n_pivots rows of each dimension are the only sample; queries meet rows block by block, so a task's size doesn't
    depend on the table's. The work is that of queries times rows, less what share saves: where the queries are a share
    of the rows it grows with their square, and so do the copies of blocks and chunks, one for each other.
    """
    if not 0 < nearest <= n_pivots:
        raise ValueError("nearest must be 1 to n_pivots")
    rows = materialise(usable(vectors).withColumn("d", F.size("v")), "vectors")
    pivots = choose_pivots(rows, n_pivots)
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)
    n, nq = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    blocks, chunks = max(1, math.ceil(n / BLOCK_ROWS)), max(1, math.ceil(nq / CHUNK_QUERIES))

    def part(n_parts: int, seed: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n_parts)).cast("int")

    held = rows.select("vec_id", "v", "d", part(blocks, 1).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    asked = rows.where(is_query).select("vec_id", "v", "d", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), part(chunks, 2).alias("chunk"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64),) * 2 + (np.empty(0),)]
        if len(left) and len(right):
            pivots = shared.value[int(left["d"].iloc[0])]
            m = min(nearest, len(pivots))
            files = InvertedFiles(left["vec_id"].to_numpy(np.int64), np.stack(left["v"].to_numpy()), pivots, m)
            q = np.stack(right["v"].to_numpy())
            for own, v, order in zip(right["vec_id"], q, ordered_pivots(q, pivots, m), strict=True):
                ids, score = files.search(own, v, order, k, share)
                out.append((np.full(len(ids), own), ids, score))
        a, b, c = (np.concatenate(x) for x in zip(*out, strict=True))
        return pd.DataFrame({"query_id": a.astype(np.int64), "vec_id": b.astype(np.int64), "score": c})

    by_part = ["d", "block", "chunk"]
    found = held.groupBy(*by_part).cogroup(asked.groupBy(*by_part)).applyInPandas(search, "query_id long, vec_id long, score double")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
