"""A stored index of pattern vectors for approximate search (PAT-04).

Inverted lists with quantised residuals: unit vectors go to the cell of their
nearest centre, and what is left of them is stored as one byte a component. The
index is a folder of Parquet tables:

* ``centres``: one row a cell, fixed when the index is built; they come from a
  bounded sample, every row is indexed. The number of cells a query has to look
  into is measured on the sample too: so many that ``TARGET`` of the true
  neighbours lie in them;
* ``entries``: one row a vector and run, in folders by run and by groups of
  cells, sorted by cell, with the code, its scale and the exact vector in columns
  of their own;
* ``replaced``: (id, run) of entries that a later run has written again.

Adding a run places its rows only; nothing of earlier runs is rewritten, until
``compact`` folds all runs into one. Searching reads the codes of the probed
cells (folders and row groups of other cells are skipped), keeps the best few
by code, and reads the exact vectors of those alone.

Search sends the queries to the codes in blocks of bounded size, one pass each,
one block on the driver at a time: a query is not copied for the cells it looks
into, and neither a crowded cell nor a cell that many queries probe is one task's
work. A task emits at most ``k * refine`` rows a query, never pairs.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.operators.similarity import DIGITS, _dense, _Top
from marketlake.session import remove_folder, shared_folder
from marketlake.sources import tables
from marketlake.sources.bronze import child_folders, path_exists

# the functions below travel to the workers by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 32_768         # rows the centres are fitted on, at most
CELLS = 4_096           # most cells: their centres are on the driver and in every task
ROUNDS = 8              # of fitting
GROUP = 16              # cells of one folder
SLICE = 8_192           # codes that a task holds at once
BLOCK = 8_192           # queries of one pass, on average
TILE = 512              # queries of one matrix product
MERGED = 500_000        # matches that wait to be merged
FIRST = 1_024           # codes of the first product, which bounds the next ones
DENSE = 0.15            # share of (query, cell) pairs that are looked into, from which all are
SLACK = 1e-9            # what rounding may take from the similarity to a centre
LEAST = -1e9            # below any guess, above what is barred
TARGET = 0.95           # share of the true neighbours that the probed cells must hold, on the sample
ASKED = 512             # queries of that measurement, and the neighbours that count for each
NEAR = 10
REFINE = 8              # rows read again exactly, as a multiple of k
LEVELS = 127            # steps of a component's code on either side of 0

ENTRY = "id string, coin_id string, embedding array<double>, cell int, code binary, scale double"
_PAIRS = "query long, match_id string, run int, cell int, guess double"


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def _matrix(column: pd.Series) -> np.ndarray:
    return _unit(np.stack(column.to_numpy()).astype("float64"))


def _fit(vectors: np.ndarray, count: int) -> np.ndarray:
    """Centres of unit vectors: each is the direction of the mean of its cell; an empty cell keeps its centre."""
    centres = vectors[np.linspace(0, len(vectors) - 1, count).astype(int)]
    for _ in range(ROUNDS):
        home = _home(vectors, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, vectors)
        means = _unit(sums)
        centres = np.where(means.any(axis=1, keepdims=True), means, centres)
    return centres


def _home(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Nearest centre of each vector, in tiles."""
    out = np.empty(len(vectors), dtype=np.int64)
    for start in range(0, len(vectors), TILE):
        out[start:start + TILE] = (vectors[start:start + TILE] @ centres.T).argmax(axis=1)
    return out


def _needed(vectors: np.ndarray, centres: np.ndarray) -> int:
    """How many of its nearest cells a query has to look into, by brute force on the sample."""
    asked = np.linspace(0, len(vectors) - 1, min(ASKED, len(vectors))).astype(int)
    near = min(NEAR, len(vectors) - 1)
    if not near:
        return 1
    alike = vectors[asked] @ vectors.T
    alike[np.arange(len(asked)), asked] = -np.inf
    found = np.argpartition(-alike, near - 1, axis=1)[:, :near]
    place = np.argsort(np.argsort(-(vectors[asked] @ centres.T), axis=1, kind="stable"), axis=1)
    needed = np.take_along_axis(place, _home(vectors, centres)[found], axis=1)
    held = np.cumsum(np.bincount(needed.ravel(), minlength=len(centres))) / needed.size
    return int(np.argmax(held >= TARGET)) + 1


class _Model:
    """The centres; small, and shipped to the tasks. ``probe``: cells a query looks into, at least."""

    def __init__(self, centres: np.ndarray, probe: int):
        self.centres, self.probe = centres, probe

    def place(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            m = _matrix(batch["embedding"])
            cell = _home(m, self.centres)
            rest = m - self.centres[cell]
            # each row has its own scale: a tight cell is told apart as well as a wide one
            scale = np.maximum(np.abs(rest).max(axis=1), 1e-300) / LEVELS
            code = np.rint(rest / scale[:, None]).astype(np.int8)
            yield batch.assign(cell=cell.astype("int32"), code=[c.tobytes() for c in code], scale=scale)

    def reach(self, vectors: np.ndarray, rows: np.ndarray, probe: int, need: int) -> tuple[np.ndarray, np.ndarray]:
        """(least similarity of a centre that each query looks into, whether each cell is looked into): the nearest cells, more until they hold enough rows."""
        least, asked = np.empty(len(vectors)), np.zeros(len(rows), dtype=bool)
        for start in range(0, len(vectors), TILE):
            near = vectors[start:start + TILE] @ self.centres.T
            order = np.argsort(-near, axis=1, kind="stable")
            before = np.cumsum(rows[order], axis=1) - rows[order]
            last = np.maximum((before < need).sum(axis=1), min(probe, len(rows))) - 1
            least[start:start + TILE] = near[np.arange(len(near)), order[np.arange(len(near)), last]] - SLACK
            asked |= (near >= least[start:start + TILE, None]).any(axis=0)
        return least, asked & (rows > 0)

    def best(self, block: _Block, keep: int, other_coin: bool, other_id: bool, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """At most ``keep`` entries per query among those that come, by the similarity to what the code stands for.

        Where the queries look into many of the cells that come, all of them look at
        all codes, which finds no less and makes larger products.
        """
        top, single, labels, seen = _Top(len(block.names), keep, np.int64), block.vectors.astype("float32"), [], 0
        known = {c: n for n, c in enumerate(dict.fromkeys(block.coins))}
        own, held, found = np.array([known[c] for c in block.coins], dtype=np.int64), [], []

        def merge() -> None:
            if found:
                top.add(*[np.concatenate(c) for c in zip(*found)])
                found.clear()

        def look(who: np.ndarray, at: np.ndarray, stands: np.ndarray, names: np.ndarray, coins: np.ndarray | None, first: int) -> None:
            for start in range(0, len(who), TILE):
                asking = who[start:start + TILE]
                guess = single[asking] @ stands[at].T
                if other_coin:
                    guess[own[asking][:, None] == coins[at][None, :]] = -np.inf
                if other_id:
                    guess[block.names[asking][:, None] == names[at][None, :]] = -np.inf
                loose = ~np.isfinite(top.low[asking])
                if loose.any() and len(at) > keep:
                    top.low[asking[loose]] = -np.partition(-guess[loose], keep - 1, axis=1)[:, keep - 1]
                row, column = np.nonzero(guess >= np.maximum(top.low[asking], LEAST).astype("float32")[:, None])
                found.append((asking[row], guess[row, column].astype("float64"), first + at[column]))
                if sum(len(f[0]) for f in found) > MERGED:
                    merge()

        def meet() -> None:
            nonlocal seen
            rows = pa.Table.from_batches(held)
            held.clear()
            labels.append(rows.select(["id", "run", "cell"]))
            cell, names = rows["cell"].to_numpy(), rows["id"].to_numpy()
            codes = np.frombuffer(b"".join(rows["code"].to_pylist()), dtype=np.int8).reshape(len(names), -1)
            stands = (self.centres[cell] + codes * rows["scale"].to_numpy()[:, None]).astype("float32")
            coins = np.array([known.get(c, -1) for c in rows["coin_id"].to_pylist()], dtype=np.int64) if other_coin else None
            numbers, place = np.unique(cell, return_inverse=True)
            asks = block.vectors @ self.centres[numbers].T >= block.least[:, None]
            first = sum(len(t) for t in labels) - len(names)
            if asks.mean() > DENSE:
                start = 0
                while start < len(names):
                    stop = min(len(names), start + max(FIRST, seen))
                    look(np.arange(len(block.names)), np.arange(start, stop), stands, names, coins, first)
                    merge()
                    seen, start = seen + stop - start, stop
            else:
                order = np.argsort(place, kind="stable")
                for n, at in enumerate(np.split(order, np.flatnonzero(np.diff(place[order])) + 1)):
                    look(np.flatnonzero(asks[:, n]), at, stands, names, coins, first)
            merge()

        for batch in batches:
            held.append(batch)
            if sum(len(h) for h in held) >= size:
                meet()
        if held:
            meet()
        if labels:
            label = pa.concat_tables(labels).take(pa.array(top.names)).combine_chunks()
            columns = [pa.array(top.row), *[label[c].cast(t).combine_chunks() for c, t in (("id", pa.string()), ("run", pa.int32()), ("cell", pa.int32()))], pa.array(top.sim)]
            columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) and c.num_chunks else c for c in columns]
            if len(top.row):
                yield pa.RecordBatch.from_arrays(columns, names=["query", "match_id", "run", "cell", "guess"])


class _Block:
    """Some queries: ids, coins, unit vectors and the least similarity of a centre that each looks into."""

    def __init__(self, rows: pa.Table):
        self.names, self.coins, self.vectors = rows["id"].to_numpy(), rows["coin_id"].to_pylist(), _dense(rows["embedding"])
        self.least = None

    def judge(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Similarities of matches whose exact vectors have come."""
        for batch in batches:
            if len(batch):
                query = batch["query"].to_numpy()
                sim = np.einsum("ij,ij->i", self.vectors[query], _dense(batch["known"]))
                yield pa.RecordBatch.from_arrays([pa.array(self.names[query], pa.string()), batch["match_id"], pa.array(np.round(sim, DIGITS))],
                                                 names=["query_id", "match_id", "similarity"])


def _load(spark: SparkSession, folder: str) -> _Model:
    rows = spark.read.parquet(f"{folder}/centres").orderBy("cell").toPandas()  # at most CELLS rows
    return _Model(np.stack(rows["centre"].to_numpy()).astype("float64"), int(rows["probe"].iloc[0]))


def _runs(spark: SparkSession, folder: str) -> list[int]:
    found = [f for f in child_folders(spark, f"{folder}/entries") if f.startswith("run=")] if path_exists(spark, f"{folder}/entries") else []
    return sorted(int(f.removeprefix("run=")) for f in found)


def entries(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """The entries that hold: of each id that of its newest run (``before`` a run, if given)."""
    rows = spark.read.schema(f"{ENTRY}, run int, cells int").parquet(f"{folder}/entries")
    if before is not None:
        rows = rows.where(F.col("run") < before)
    if not path_exists(spark, f"{folder}/replaced"):
        return rows
    gone = spark.read.schema("id string, run int, by int").parquet(f"{folder}/replaced")
    if before is not None:
        gone = gone.where(F.col("by") < before)
    return rows.join(gone.select("id", "run"), ["id", "run"], "left_anti")


def build_index(patterns: DataFrame, folder: str, cells: int | None = None) -> None:
    """A new index of ``patterns`` (id, coin_id, embedding) in an empty folder; the first run is 1.

    Ids are unique and vectors have the same number of components, none missing.
    Without ``cells`` there are about as many as the root of the number of rows.
    """
    spark = patterns.sparkSession
    if path_exists(spark, f"{folder}/centres"):
        raise FileExistsError(f"there is an index at {folder}")
    # bounded: at most SAMPLE rows, spread over the patterns by hash
    sample = patterns.orderBy(F.xxhash64("id"), "id").select("embedding").limit(SAMPLE).toPandas()
    if sample.empty:
        raise ValueError("an index needs at least one pattern")
    vectors = _matrix(sample["embedding"])
    count = min(CELLS, len(vectors), cells or max(1, math.isqrt(patterns.count())))
    centres = _fit(vectors, count)
    probe = _needed(vectors, centres)
    rows = [(n, c.tolist(), probe) for n, c in enumerate(centres)]
    spark.createDataFrame(rows, "cell int, centre array<double>, probe int").coalesce(1).write.parquet(f"{folder}/centres")
    _write(patterns, folder, 1, _Model(centres, probe))


def _write(patterns: DataFrame, folder: str, run: int, model: _Model) -> None:
    columns = ["id", F.col("coin_id").cast("string").alias("coin_id"), F.col("embedding").cast("array<double>").alias("embedding")]
    placed = patterns.select(*columns).mapInPandas(model.place, ENTRY).withColumns({"run": F.lit(run), "cells": F.floor(F.col("cell") / GROUP).cast("int")})
    # a crowded group of cells becomes several files
    (placed.hint("rebalance", "cells").sortWithinPartitions("cells", "cell").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run", "cells").parquet(f"{folder}/entries"))


def add_run(patterns: DataFrame, folder: str) -> int:
    """Add rows to the index, replacing entries of the same ids; returns the number of the run.

    ``patterns`` is read twice, so hand in a stored table. What is replaced is
    written first: a run that breaks off leaves an index without those ids, not
    with two entries of one id, and can be repeated.
    """
    spark = patterns.sparkSession
    run = max(_runs(spark, folder)) + 1
    known = entries(spark, folder, before=run).select("id", "run")
    known.join(patterns.select("id"), "id", "left_semi").withColumn("by", F.lit(run)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("by").parquet(f"{folder}/replaced")
    _write(patterns, folder, run, _load(spark, folder))
    return run


def compact(spark: SparkSession, folder: str, out: str) -> None:
    """The index with all runs folded into one, with centres fitted anew, in folder ``out``."""
    build_index(entries(spark, folder).select("id", "coin_id", "embedding"), out)


def search_index(
    queries: DataFrame, folder: str, k: int = 5, probe: int | None = None, refine: int = REFINE,
    exclude_same_coin: bool = False, exclude_self: bool = False, size: int = SLICE,
) -> DataFrame:
    """The ``k`` most similar entries per query, found in its nearest cells: query_id, match_id, similarity, rank.

    Similarities are exact; which entries are found is approximate. A query looks
    into ``probe`` cells (as many as the index measured when it was built), or
    more until they hold ``k * refine`` entries.
    ``queries`` (id, coin_id, embedding) are read twice. They go to the codes in
    blocks, one pass each; the matches of a block are written before the next.
    """
    spark = queries.sparkSession
    model = _load(spark, folder)
    # bounded: one row a cell
    counts = entries(spark, folder).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toPandas()
    rows = np.zeros(len(model.centres), dtype=np.int64)
    rows[counts["cell"].to_numpy()] = counts["n"].to_numpy()
    asked = queries.select(F.col("id").cast("string").alias("id"), F.col("coin_id").cast("string").alias("coin_id"),
                           F.col("embedding").cast("array<double>").alias("embedding"))
    blocks = -(-asked.count() // BLOCK)
    if not blocks or not rows.any():
        return spark.createDataFrame([], "query_id string, match_id string, similarity double, rank int")

    def search(part: DataFrame) -> DataFrame:
        return _search_block(part.toArrow(), model, spark, folder, rows, k, probe or model.probe, k * refine, exclude_same_coin, exclude_self, size)

    if blocks == 1:
        return search(asked)
    stored, found = shared_folder(spark, "queries"), shared_folder(spark, "matches")
    asked.withColumn("_block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).write.partitionBy("_block").parquet(stored)
    for part in child_folders(spark, stored):
        search(spark.read.schema(asked.schema).parquet(f"{stored}/{part}")).write.mode("append").parquet(found)
    return spark.read.parquet(found)


def _search_block(
    asked: pa.Table, model: _Model, spark: SparkSession, folder: str, rows: np.ndarray, k: int, probe: int, keep: int, other_coin: bool, other_id: bool, size: int
) -> DataFrame:
    block = _Block(asked)
    block.least, cells = model.reach(block.vectors, rows, probe, keep)
    # folders of cells that nobody probes are not read
    groups = sorted({int(c) // GROUP for c in np.flatnonzero(cells)})
    held = entries(spark, folder).where(F.col("cells").isin(groups))
    codes = held.select("id", "coin_id", "cell", "code", "scale", "run")
    found = codes.mapInArrow(partial(model.best, block, keep, other_coin, other_id, size), _PAIRS)
    order = Window.partitionBy("query").orderBy(F.desc("guess"), "match_id")
    few = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep).drop("place", "guess")
    # the exact vectors of the few, and of nothing else; bounded: BLOCK x keep rows
    exact = held.select(F.col("id").alias("match_id"), "run", "cell", F.col("embedding").alias("known"))
    judged = exact.join(F.broadcast(few), ["match_id", "run", "cell"]).select("query", "match_id", "known")
    scored = judged.mapInArrow(block.judge, "query_id string, match_id string, similarity double")
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "match_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def refresh_index(spark: SparkSession, patterns: str, folder: str, since: str | None = None) -> int | None:
    """Bring the index up to the stored collection ``patterns`` (a folder by date): its dates from ``since`` on, or all in a new index."""
    rows = tables.read_table(spark, patterns).select("id", "coin_id", "embedding", "date")
    if not path_exists(spark, f"{folder}/centres"):
        build_index(rows, folder)
        return 1
    fresh = rows if since is None else rows.where(F.col("date") >= since)
    stage = shared_folder(spark, "index-run")
    fresh.drop("date").write.parquet(stage)
    try:
        run = spark.read.parquet(stage)
        return None if run.isEmpty() else add_run(run, folder)
    finally:
        remove_folder(spark, stage)
