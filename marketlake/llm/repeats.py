"""Exact repeats of word windows, found from fixed blocks.

Every document is cut into non-overlapping blocks of ``(window + 1) // 2`` words:
each window of ``window`` words then holds a whole block of its own document.
The blocks are the index; every rolling stretch of a block's length in every
document probes it. A block that occurs at any second place is an anchor. Only
windows around anchors can recur; they are extended to their whole length and
matched by it, and overlapping repeated windows make the maximal repeats.

Probing moves hashes only: each task sorts the hashes of its documents, keeps
each once with two flags, cuts them by range and ships them as compressed
differences. A range's task finds the anchors and marks them in its slice of a
bitmap of fixed size (``MAP_BITS``). The bitmap only leaves out documents; when it
fills up with the data, more documents take the exact way below, none is lost.
Documents near anchors are dealt into chunks, their windows' 64-bit hashes are
matched range by range in the same way, and each chunk gets the hashes that recur
back. Copies cost one hash per task or chunk, so a group of copies of any size
is no burden. A document is handled whole in one task.

Defined results: a null text has no words; texts shorter than a window are kept;
windows of equal rows recur; null ids and repeated rows stay; an empty table gives
an empty result; other columns are not touched. Windows are told apart by 64-bit
hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import documents, staged
from marketlake.llm.packed import by_partition, expand, pack_sorted, squeeze, unpack_sorted, windows, word_hashes

WINDOW = 35
MAP_BITS = 27              # the bitmap of anchors has 2 ** MAP_BITS bits
FLUSH = 2_000_000          # hashes that a task sorts at once
STRETCH = 400_000          # words that are hashed at once
RANGE_WORDS = 4_000_000    # hashes of one range, on average
CHUNK_WORDS = 1_000_000    # words of one chunk, on average
WORD_BYTES = 6             # assumed, to size ranges and chunks only


def split_words(text: str | None) -> list[bytes]:
    """The words of a text; bytes.split() parts at exactly the contract's white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _stretches(texts) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(word lists, first word of each, hashes of all words) of texts taken together up to STRETCH words."""
    held, size = [], 0
    for text in texts:
        words = split_words(text)
        held.append(words)
        size += len(words)
        if size >= STRETCH:
            yield held, np.cumsum([0] + [len(w) for w in held]), word_hashes([x for w in held for x in w])
            held, size = [], 0
    if held:
        yield held, np.cumsum([0] + [len(w) for w in held]), word_hashes([x for w in held for x in w])


def _inside(first: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of the n windows of a stretch lie in one document."""
    position = np.arange(n)
    stop = first[np.searchsorted(first, position, side="right")]
    return position + width <= stop


def _blocks(first: np.ndarray, block: int) -> np.ndarray:
    """First words of all whole blocks of all documents of a stretch."""
    count = np.diff(first) // block
    owner = np.repeat(np.arange(len(count)), count)
    return first[owner] + block * (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count))


def _once(keys: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their flags joined; bit 2 is set where a key came more than once."""
    order = np.argsort(keys, kind="stable")
    keys, flags = keys[order], flags[order]
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    if not len(keys):
        return keys, flags
    many = np.diff(np.r_[start, len(keys)]) > 1
    return keys[start], np.bitwise_or.reduceat(flags, start) | (many.astype(np.uint8) << 1)


def _probe(block: int, parts: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each key: the top 48 bits of a window's hash; flag 1: it is a block of the index."""
        held, count = [], 0

        def flush():
            keys, flags = _once(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held]))
            rows = [(p, pack_sorted(keys[a:b]), squeeze(flags[a:b])) for p, a, b in by_partition(keys, parts)]
            return pd.DataFrame(rows, columns=["part", "keys", "flags"])

        for batch in batches:
            for _, first, hashes in _stretches(batch["text"]):
                rolling = windows(hashes, block) >> np.uint64(16) << np.uint64(16)
                flags = np.zeros(len(rolling), dtype=np.uint8)
                flags[_blocks(first, block)] = 1
                inside = _inside(first, block, len(rolling))
                held.append((rolling[inside], flags[inside]))
                count += len(rolling)
                if count >= FLUSH:
                    yield flush()
                    held, count = [], 0
        if held:
            yield flush()
    return run


def _anchors(bits: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([unpack_sorted(k) for k in rows["keys"]])
        flags = np.concatenate([expand(f, np.uint8) for f in rows["flags"]])
        keys, flags = _once(keys, flags)
        at = np.unique(keys[flags == 3] >> np.uint64(64 - bits)).astype(np.int64)
        if not len(at):
            return pd.DataFrame({"first": [], "map": []})
        first = int(at[0]) // 8
        marks = np.zeros((int(at[-1]) // 8 - first + 1) * 8, dtype=np.uint8)
        marks[at - 8 * first] = 1
        return pd.DataFrame({"first": [first], "map": [squeeze(np.packbits(marks, bitorder="little"))]})
    return run


def anchor_map(docs: DataFrame, window: int = WINDOW, bits: int = MAP_BITS, parts: int = 1) -> np.ndarray:
    """Bitmap over the top bits of the hashes of blocks that occur twice; 2 ** bits bits, whatever the data."""
    shipped = docs.select("text").mapInPandas(_probe((window + 1) // 2, parts), "part int, keys binary, flags binary")
    slices = shipped.groupBy("part").applyInPandas(_anchors(bits), "first long, map binary").collect()
    whole = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for r in slices:
        piece = expand(r["map"], np.uint8)
        whole[r["first"]:r["first"] + len(piece)] |= piece
    return whole


def _sorted_out(shipped, window, bits, digest):
    block = (window + 1) // 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Documents without an anchor are done; the others keep their text."""
        marks = shipped.value
        for batch in batches:
            n_words, kept, text = [], [], []
            at = 0
            for lists, first, hashes in _stretches(batch["text"]):
                rolling, blocks = windows(hashes, block), _blocks(first, block)
                index = (rolling[blocks] >> np.uint64(64 - bits)).astype(np.int64)
                near = np.zeros(len(lists), dtype=bool)
                hit = blocks[(marks[index >> 3] >> (index & 7).astype(np.uint8) & 1).astype(bool)]
                near[np.searchsorted(first, hit, side="right") - 1] = True
                for words, open_ in zip(lists, near):
                    open_ = open_ and len(words) >= window
                    n_words.append(len(words))
                    kept.append(None if open_ else _kept(words, digest))
                    text.append(batch["text"].iloc[at] if open_ else None)
                    at += 1
            yield pd.DataFrame({"keep": batch["keep"], "n_words": n_words, "kept": kept, "text": text})
    return run


def _kept(words, digest):
    joined = b" ".join(words)
    return hashlib.sha256(joined).hexdigest() if digest else joined.decode("utf-8", "surrogatepass")


def _window_keys(texts, window):
    for lists, first, hashes in _stretches(texts):
        rolling = windows(hashes, window)
        yield lists, first, rolling, _inside(first, window, len(rolling))


def _ask(window, parts):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found = [rolling[inside] for _, _, rolling, inside in _window_keys(rows["text"], window)]
        keys = np.concatenate(found)
        keys, flags = _once(keys, np.zeros(len(keys), dtype=np.uint8))
        out = [(int(rows["chunk"].iloc[0]), p, pack_sorted(keys[a:b]), squeeze(flags[a:b])) for p, a, b in by_partition(keys, parts)]
        return pd.DataFrame(out, columns=["chunk", "part", "keys", "flags"])
    return run


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """To every chunk: those of its windows that occur anywhere else."""
    asked = [unpack_sorted(k) for k in rows["keys"]]
    keys, flags = _once(np.concatenate(asked), np.concatenate([expand(f, np.uint8) for f in rows["flags"]]))
    again = keys[flags > 1]
    out = []
    for chunk, own in zip(rows["chunk"], asked):
        own = own[np.isin(own, again, assume_unique=True)]
        if len(own):
            out.append((chunk, pack_sorted(own)))
    return pd.DataFrame(out, columns=["chunk", "keys"])


def _finish(window, digest):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        again = np.sort(np.concatenate([unpack_sorted(k) for k in right["keys"]])) if len(right) else np.zeros(0, dtype=np.uint64)
        kept, spans = [], []
        for lists, first, rolling, inside in _window_keys(left["text"], window):
            at = np.searchsorted(again, rolling)
            hit = inside & (at < len(again))
            hit[hit] = again[at[hit]] == rolling[hit]
            cover = np.zeros(int(first[-1]) + 1, dtype=np.int64)
            np.add.at(cover, np.flatnonzero(hit), 1)
            np.add.at(cover, np.flatnonzero(hit) + window, -1)
            gone = np.cumsum(cover[:-1]) > 0
            for words, a, b in zip(lists, first[:-1], first[1:]):
                own = gone[a:b]
                edges = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8)))
                spans.append([{"start": int(s), "stop": int(e)} for s, e in edges.reshape(-1, 2)])
                kept.append(_kept(list(compress(words, ~own)), digest))
        return pd.DataFrame({"keep": left["keep"], "n_words": left["n_words"], "kept": kept, "spans": spans})
    return run


SPANS = "array<struct<start:int,stop:int>>"


def remove_repeats(docs: DataFrame, keep: str, window: int = WINDOW, digest: bool = False, bits: int = MAP_BITS) -> DataFrame:
    """(keep, n_words, kept, spans) of every row of ``docs``.

    ``keep`` is the column that is carried along. ``spans`` are the maximal repeats as word positions, ``kept`` the other words joined by one
    space, or with ``digest`` their SHA-256.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(keep).cast("string").alias("keep"), F.col("text"))
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / WORD_BYTES / RANGE_WORDS))
    shipped = spark.sparkContext.broadcast(anchor_map(own, window, bits, parts))
    sorted_out = staged(own.mapInPandas(_sorted_out(shipped, window, bits, digest), "keep string, n_words long, kept string, text string")
                        .withColumn("row", F.monotonically_increasing_id()), "near-anchors")
    near = sorted_out.where(F.col("text").isNotNull())
    words = near.agg(F.coalesce(F.sum("n_words"), F.lit(0))).head()[0]
    chunks = max(1, math.ceil(words / CHUNK_WORDS))
    near = near.select("keep", "n_words", "text", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("chunk"))
    asked = near.groupBy("chunk").applyInPandas(_ask(window, parts), "chunk int, part int, keys binary, flags binary")
    answers = asked.groupBy("part").applyInPandas(_answer, "chunk int, keys binary")
    done = near.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        _finish(window, digest), f"keep string, n_words long, kept string, spans {SPANS}")
    alone = sorted_out.where(F.col("text").isNull()).select("keep", "n_words", "kept", F.expr("array()").cast(SPANS).alias("spans"))
    return alone.unionByName(done).withColumn("keep", F.col("keep").cast(docs.schema[keep].dataType))


def op6_repeats(spark, folder):
    """Contract 6."""
    found = remove_repeats(documents(spark, folder), "doc_id", digest=True)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["stop"] - x["start"])
    return found.select(F.col("keep").cast("long").alias("doc_id"), "n_words", removed.alias("n_removed"), F.col("kept").alias("kept_sha256"),
                        F.size("spans").alias("n_spans"))


OP6_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS s FROM words, range(1, greatest(1, len(w) - 33)) t(i) WHERE len(w) >= 35),
again AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + d AS p FROM win JOIN again USING (s), range(0, 35) t(d)),
each AS (
  SELECT r, p, w[p] AS word, (r, p) IN (SELECT (r, p) FROM gone) AS out FROM words, range(1, len(w) + 1) t(p)),
kept AS (
  SELECT r, count(*) FILTER (out) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT out), '') AS kept,
         count(*) FILTER (out AND (p = 1 OR NOT coalesce(before, false))) AS n_spans
  FROM (SELECT *, lag(out) OVER (PARTITION BY r ORDER BY p) AS before FROM each) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256, CAST(coalesce(n_spans, 0) AS INTEGER) AS n_spans
FROM words LEFT JOIN kept USING (r)
"""
