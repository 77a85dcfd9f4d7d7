"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has 64 bits, each the majority of that bit over the XXH64 hashes of
a text's word shingles. Two fingerprints that differ in at most ``BITS`` = 4 bits
agree on at least 3 of 7 blocks, so every link shares one of the 35 keys made of
three blocks (27 or 28 bits). Distinct fingerprints meet on these keys and are
checked by their real distance.

Copies are one fingerprint, so a group of copies costs one row. A crowded key is
cut into tiles of about ``TILE`` fingerprints, and every two tiles meet in a
task of their own; a task gives only a spanning forest of its links, never its
pairs. Classes are the connected components of the links.

Defined results: null, empty and white-space texts have fingerprint 0 and are
linked like any other; repeated rows stay; a null doc_id stays and is never a
class id unless no member has one; an empty table gives an empty result; other
columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import documents, staged
from marketlake.llm.graph import components

SHINGLE = 4
BITS = 4
SEED = 42
BLOCKS = 7
TILE = 4096
SLICE = 1 << 15       # hashes counted at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, width = b" ".join(words), min(shingle, len(words))
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    stop = np.cumsum(length + 1) - 1
    start = stop - length
    digest = xxhash.xxh64_intdigest
    spans = zip(start[:len(words) - width + 1].tolist(), stop[width - 1:].tolist())
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), SLICE):
        part = hashes[at:at + SLICE]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(id, key, fp) of every row: doc_id, hash of the text, fingerprint as a signed long."""
    @F.pandas_udf("long")
    def signed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in batch], dtype=np.uint64).astype(np.int64))

    return docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("key"),
                       signed(F.col("text")).alias("fp"))


def block_masks(blocks: int = BLOCKS, bits: int = BITS) -> list[int]:
    """Masks of all choices of ``blocks - bits`` blocks, as signed longs."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(parts, blocks - bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # bitwise_count of a signed number counts the bits of its absolute value
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(fps: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """Links that join what is within ``bits``, directly or by steps: each member is linked once."""
    links, rest, queue = [], fps, []
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        at = queue.pop()
        near = distance(rest, at) <= bits
        if near.any():
            found = rest[near]
            links += [(int(at), int(x)) for x in found]
            queue += list(found)
            rest = rest[~near]
    return links


def _links(bits):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by (mask, key, tiles); groups may span batches."""
        names, held = ["mask", "key", "low", "high"], None

        def solve(ids, fps):
            cut = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
            starts, stops = np.r_[0, cut], np.r_[cut, len(ids)]
            size = stops - starts
            two = starts[size == 2]
            a, b = fps[two], fps[two + 1]
            near = distance(a, b) <= bits
            out = [np.stack([a[near], b[near]], axis=1)]
            for s, e in zip(starts[size > 2], stops[size > 2]):
                out.append(np.array(forest(fps[s:e], bits), dtype=np.int64).reshape(-1, 2))
            pairs = np.unique(np.concatenate(out), axis=0)
            return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

        for batch in batches:
            ids, fps = batch[names].to_numpy(dtype=np.int64), batch["fp"].to_numpy(dtype=np.int64)
            if held is not None:
                ids, fps = np.concatenate([held[0], ids]), np.concatenate([held[1], fps])
            if not len(ids):
                continue
            change = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1))
            last = change[-1] + 1 if len(change) else 0
            held = ids[last:], fps[last:]
            if last:
                yield solve(ids[:last], fps[:last])
        if held is not None and len(held[0]):
            yield solve(*held)
    return run


def near_links(fps: DataFrame, bits: int = BITS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """(a, b): enough links between the distinct ``fp`` of the frame to give its components."""
    spark = fps.sparkSession
    masks = block_masks(blocks, bits)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "key"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = keyed.repartition(parts, "mask", "key")
    shared = keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = keyed.join(shared, ["mask", "key"])
    tiles = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    # a fingerprint goes to every pair of tiles that has its own; a small key is one tile
    laid = (members.withColumn("tiles", tiles).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
            .select("mask", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp"))
    group = ["mask", "key", "low", "high"]
    return (laid.repartition(parts, *group).sortWithinPartitions(*group)
            .mapInPandas(_links(bits), "a long, b long").distinct())


def classes(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """(fp, first): the smallest (id, key) of each fingerprint's class, null ids last."""
    member = F.struct(F.col("id").isNull().alias("unknown"), F.col("id"), F.col("key"))
    lows = rows.groupBy("fp").agg(F.min(member).alias("low"))
    roots = components(near_links(rows.select("fp").distinct(), bits))
    per_fp = staged(lows.join(roots, lows["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")), "roots")
    first = per_fp.groupBy("root").agg(F.min("low").alias("first"))
    return per_fp.join(first, "root").select("fp", "first")


def first_rows(docs: DataFrame, keep: DataFrame) -> DataFrame:
    """``keep`` with ``row``, the row of ``docs`` of that (id, key); one of equal rows."""
    known = lambda c: F.coalesce(c, F.lit(0)).alias("k1")
    others = [c for c in keep.columns if c not in ("id", "key")]
    keep = keep.select(known(F.col("id")), F.col("id").isNull().alias("k2"), F.col("key").alias("k3"), *others)
    ids, whole = F.col("doc_id").cast("long"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    judged = docs.select(whole, known(ids), ids.isNull().alias("k2"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("k3"))
    one = F.row_number().over(Window.partitionBy("k1", "k2", "k3").orderBy("k3"))
    return judged.join(keep, ["k1", "k2", "k3"]).withColumn("copy", one).where("copy = 1").select("row", *others)


def drop_near_duplicates(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """One row of each class stays: that of the smallest doc_id (null ids last, then by text; one of equal rows)."""
    rows = staged(fingerprints(docs.select("doc_id", "text"), shingle), "fingerprints")
    return first_rows(docs, classes(rows, bits).select("first.id", "first.key").distinct()).select("row.*")


def op2_simhash(spark, folder):
    """Contract 2."""
    rows = staged(fingerprints(documents(spark, folder)), "fingerprints")
    found = classes(rows)
    return rows.join(found, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.id").alias("component_id"))
