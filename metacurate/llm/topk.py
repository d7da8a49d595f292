"""Exact top-k inner products by no-random-access aggregation over sorted lists."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metacurate.llm.registry import query, table

BLOCK = 8192
QUERY_BLOCK = 1024


def quantised(vector: Column, scale: int = 64) -> Column:
    """``floor(scale * x)`` of each component, or null where a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return F.when(vector.isNotNull() & ~bad, whole)


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _exact_dtype(a: np.ndarray, b: np.ndarray):
    """The fastest type in which every inner product is exact."""
    high = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * max(a.shape[1], 1)
    return np.float32 if high < 2**24 else np.float64 if high < 2**53 else np.int64


def nra_block(queries: np.ndarray, items: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Positions and scores of the ``k`` best items for each query row.

    Each component has a list of the items sorted by it, read from the top for
    positive query weights and from the bottom for negative ones. All lists are
    read to the same depth. Read entries count with their value; an unread one is
    between the list's frontier and its far end, which bounds every score from
    above and below without a look at a single vector. Items whose upper bound
    is under the k-th best lower bound cannot qualify; once few others are left
    their scores are resolved. ``own`` is the position of a query among the
    items, or -1; it takes no part.
    """
    n = len(items)
    kind = _exact_dtype(queries, items)
    up, down = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
    values = items.astype(kind)
    lists = np.sort(values, axis=0)  # ascending; the descending list is the same one read backwards
    low, high = lists[0], lists[-1]
    alive = np.ones((len(queries), n), bool)
    alive[np.flatnonzero(own >= 0), own[own >= 0]] = False
    k = min(k, n)
    depth = n // 8
    while 0 < depth < n and (alive.sum(axis=1) > max(4 * k, 64)).any():
        top, bottom = lists[n - depth], lists[depth - 1]
        read_up, read_down = values >= top, values <= bottom
        upper = up @ np.where(read_up, values, top).T + down @ np.where(read_down, values, bottom).T
        lower = up @ np.where(read_up, values, low).T + down @ np.where(read_down, values, high).T
        lower = np.where(alive, lower, np.iinfo(np.int64).min if kind is np.int64 else -np.inf)
        bar = np.partition(lower, n - k, axis=1)[:, n - k]
        alive &= upper >= bar[:, None]
        depth *= 2
    out = []
    for q in range(len(queries)):
        left = np.flatnonzero(alive[q])
        score = values[left] @ (up[q] + down[q])
        best = np.lexsort((ids[left], -score))[:k]
        out.append((left[best], score[best].astype(np.int64)))
    return out


def top_k(
    items: DataFrame, queries: DataFrame, k: int, block: int = BLOCK, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """The ``k`` items with the largest inner product for each query, ties to the smaller id.

    ``items`` and ``queries`` are ``(vec_id bigint, vec array<bigint>)``. Rows
    without an id or vector take no part; vectors of different length compare as
    if the shorter one ended in zeros. A row never finds its own id, so copies of
    a row under one id do not find each other; a query id that is repeated is one
    query (the smallest vector counts) and an item id too. Returns ``query_id,
    rank, vec_id, score``.

    Items are dealt into blocks of about ``block`` and queries into blocks of
    about ``query_block``; each pair of blocks is one task's work, and each
    block's best ``k`` are merged. Inner products must fit a long.
    """
    def one_per_id(df: DataFrame) -> DataFrame:
        return df.where("vec_id IS NOT NULL AND vec IS NOT NULL").groupBy("vec_id").agg(F.min("vec").alias("vec"))

    items, queries = one_per_id(items), one_per_id(queries)
    n_blocks = max(1, -(-items.count() // block))
    n_query_blocks = max(1, -(-queries.count() // query_block))
    deal = F.xxhash64("vec_id")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = items.select(F.pmod(deal, F.lit(n_blocks)).cast("int").alias("b"), every(n_query_blocks).alias("q"), "vec_id", "vec")
    right = queries.select(every(n_blocks).alias("b"), F.pmod(deal, F.lit(n_query_blocks)).cast("int").alias("q"), "vec_id", "vec")

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        if a.empty or b.empty:
            return empty
        width = max(a["vec"].map(len).max(), b["vec"].map(len).max())
        ids, asked = a["vec_id"].to_numpy(), b["vec_id"].to_numpy()
        order = np.argsort(ids)
        near = np.minimum(np.searchsorted(ids[order], asked), len(ids) - 1)
        own = np.where(ids[order][near] == asked, order[near], -1)
        found = nra_block(_matrix(b["vec"], width), _matrix(a["vec"], width), own, ids, k)
        return pd.DataFrame(
            {
                "query_id": np.repeat(asked, [len(at) for at, _ in found]),
                "vec_id": np.concatenate([ids[at] for at, _ in found]),
                "score": np.concatenate([s for _, s in found]),
            }
        )

    best = (
        left.groupBy("b", "q").cogroup(right.groupBy("b", "q")).applyInPandas(search, "query_id bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


@query(
    "op8_top_k_search",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
    ), r AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
    """,
)
def op8_top_k_search(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", quantised(F.col("embedding")).alias("vec"))
    return top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)
