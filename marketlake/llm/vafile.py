"""Exact top-k inner products by a vector-approximation file.

Components become integers floor(256 x). The approximation file keeps, for each
vector, one cell of ``CELL_BITS`` bits a component on a regular grid between
the component's smallest and largest value. A query block scans that file only:
a cell bounds every component, so it bounds the score from both sides. A vector
stays a candidate while its upper bound reaches the k-th best lower bound seen.
The exact vectors of the candidates are then read in the order of their upper
bounds: the first few of each query fix a k-th score, and only those whose bound
still reaches it are read after them. The result is exact.

Queries are taken in blocks of about ``BLOCK``, the only thing that is shipped
whole; each block is one scan, and its candidates are a written table. Of equal
vectors only the k + 1 smallest ids can be in any answer, and of a repeated row
only k, so a group of copies is cut to them (in each task, before the shuffle)
for the candidate side; every query keeps its row.

Defined results: a vector that is null or holds a null or non-finite component
takes no part, nor does a null vec_id; vectors of another length than the query
are no candidates; rows with the query's vec_id are the query's own; repeated
query rows count once; empty vectors score 0; an empty table gives an empty
result; inner products must fit a long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import staged
from marketlake.session import shared_folder

K = 5
SCALE = 256
CELL_BITS = 6
BLOCK = 16_384        # queries of one scan, on average
PART_ROWS = 16_384    # vectors of one task of a scan, on average
READ_FIRST = 4        # exact vectors read first, in multiples of k
TILE = 512            # queries scored at once


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(id, v): the rows that take part, components as floor(scale * x)."""
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return (vectors.where(x.isNotNull() & ~bad & F.col("vec_id").isNotNull())
            .select(F.col("vec_id").cast("long").alias("id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v")))


def grids(stored: DataFrame, bits: int = CELL_BITS) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """{length: (least value, cell width) of each component}: two numbers a component reach the driver."""
    ends = (stored.select(F.size("v").alias("n"), F.posexplode("v").alias("at", "x"))
            .groupBy("n", "at").agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("n", "at").collect())
    found: dict[int, list] = {0: []}
    for r in ends:
        found.setdefault(r["n"], []).append((r["low"], math.ceil((r["high"] - r["low"] + 1) / (1 << bits))))
    return {n: (np.array([a for a, _ in g], dtype=np.int64), np.array([w for _, w in g], dtype=np.int64)) for n, g in found.items()}


def approximations(stored: DataFrame, grid: dict, count: int) -> DataFrame:
    """(row, id, n, cells): the approximation file."""
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = []
            for v in batch["v"]:
                low, width = grid[len(v)]
                cells.append(((np.asarray(v, dtype=np.int64) - low) // width).astype(np.uint8).tobytes())
            yield pd.DataFrame({"row": batch["row"], "id": batch["id"], "n": [len(v) for v in batch["v"]], "cells": cells})

    parts = max(1, math.ceil(count / PART_ROWS))
    return staged(stored.mapInPandas(encode, "row long, id long, n int, cells binary").repartition(parts, "row"), "cells")


def _scan(shipped, k):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, grid = shipped.value
        best = {n: np.full((len(q[0]), k), -np.inf) for n, q in queries.items()}
        for batch in batches:
            for n, rows in batch.groupby("n", sort=False):
                if n not in queries:
                    continue
                numbers, own, q = queries[n]
                low, width = grid[n]
                cells = np.frombuffer(b"".join(rows["cells"]), dtype=np.uint8).reshape(len(rows), n)
                middle = (2 * (low + cells * width) + width - 1).astype(np.float64).T    # twice the cells' middles
                ids, at = rows["id"].to_numpy(), rows["row"].to_numpy()
                for s in range(0, len(q), TILE):
                    part = q[s:s + TILE]
                    slack = np.abs(part) @ (width - 1).astype(np.float64)[:, None]
                    mid = part @ middle
                    mid[own[s:s + TILE, None] == ids[None, :]] = -np.inf
                    top = mid if mid.shape[1] <= k else np.partition(mid, -k, axis=1)[:, -k:]
                    seen = np.concatenate([best[n][s:s + TILE], top - slack], axis=1)
                    best[n][s:s + TILE] = kept = np.partition(seen, -k, axis=1)[:, -k:]
                    a, b = np.nonzero((mid + slack >= kept.min(axis=1, keepdims=True)) & (mid > -np.inf))
                    if len(a):
                        yield pd.DataFrame({"query": numbers[s + a], "row": at[b], "low": (mid - slack)[a, b].astype(np.int64),
                                            "high": (mid + slack)[a, b].astype(np.int64)})
    return run


def top_k(vectors: DataFrame, is_query, k: int = K, bits: int = CELL_BITS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each row where ``is_query`` (of column ``id``) holds."""
    spark = vectors.sparkSession
    whole = integer_vectors(vectors)
    # a row's own number among the rows of its id, then the number of its id among those of the vector
    again = F.row_number().over(Window.partitionBy("v", "id").orderBy("id"))
    copies = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    stored = staged(whole.withColumn("again", again).where(F.col("again") <= k)
                    .withColumn("copy", copies).where(F.col("copy") <= k + 1).drop("again", "copy")
                    .withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = staged(whole.where(is_query).distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    asked, count = queries.count(), stored.count()
    grid = grids(stored, bits)
    file = approximations(stored, grid, count)
    blocks = max(1, math.ceil(asked / block))
    folder = shared_folder(spark, "candidates")
    for number in range(blocks):
        found: dict[int, list] = {}
        for r in queries.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == number).collect():
            found.setdefault(len(r["v"]), []).append(r)
        shipped = spark.sparkContext.broadcast(({n: (
            np.array([r["query"] for r in rs]), np.array([r["id"] for r in rs]),
            np.array([r["v"] for r in rs], dtype=np.float64).reshape(len(rs), n)) for n, rs in found.items()}, grid))
        file.mapInPandas(_scan(shipped, k), "query long, row long, low long, high long").write.mode("append").parquet(folder)
    candidates = spark.read.schema("query long, row long, low long, high long").parquet(folder)

    by_low = F.row_number().over(Window.partitionBy("query").orderBy(F.col("low").desc(), "row"))
    sure = (candidates.withColumn("at", by_low).where(F.col("at") <= k).groupBy("query")
            .agg(F.when(F.count(F.lit(1)) == k, F.min("low")).alias("sure")))
    # bounds are doubled scores; candidates in the order in which their vectors are read
    by_high = F.row_number().over(Window.partitionBy("query").orderBy(F.col("high").desc(), "row"))
    order = staged(candidates.join(sure, "query").where(F.col("sure").isNull() | (F.col("high") >= F.col("sure")))
                   .select("query", "row", "high").withColumn("at", by_high), "order")

    def read(part):
        q = queries.select("query", F.col("id").alias("query_id"), F.col("v").alias("q"))
        score = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
        return part.join(stored, "row").join(q, "query").select("query", "query_id", F.col("id").alias("vec_id"), score.alias("score"))

    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
    first = staged(read(order.where(F.col("at") <= READ_FIRST * k)), "first")
    certain = (first.withColumn("rank", rank).where(F.col("rank") <= k).groupBy("query")
               .agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("kth")))
    rest = read(order.where(F.col("at") > READ_FIRST * k).join(certain, "query")
                .where(F.col("kth").isNull() | (F.col("high") >= 2 * F.col("kth"))).select("query", "row"))
    return (first.unionByName(rest).withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op1_vafile(spark, folder):
    """Contract 1."""
    return top_k(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("id") % 50 == 0)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM scored)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 5
"""
