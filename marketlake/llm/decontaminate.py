"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

A text is a sequence of lower-cased words; in scripts written without spaces each
character is a word. CGK's random walk reads a window word
by word and, by a random bit of (step, word), stays or moves on; two windows at
a small edit distance fall back into step, so their walks read the same word at
most steps: edit distance becomes Hamming distance. Sampling three steps of the
walk (two early ones, so that most windows are given up after a few steps, and
one from the rest of the item's length) is one hash; ``WALKS`` independent walks
are repeated to reach the recall. Windows start at every ``STRIDE``-th word of a
document and at each of the first ``STRIDE`` words of an item, so an occurrence
always has a window that starts at the same word as one of the item. Items
longer than ``LONG`` words have windows at every ``LONG``-th word too.

Items under ``SHORT`` words do without walks: an item that may have n edits is cut
into n + 1 pieces, one of which is whole in every occurrence, and the pieces are
looked up at every word. No occurrence of a short item is missed.

A hit is checked at once, in the task that holds the document: bit-parallel
approximate matching of the whole item against the words around the hit gives
the exact edit distance. A document is contaminated by an item if at most
``1 - SIMILARITY`` of the item's words are edited.

Only the index is shipped, in blocks of items of about ``BLOCK_WORDS`` words; each
block is one pass over the documents. Nothing is shuffled.

Defined results: null texts and texts and items without a word match nothing; a
repeated item is reported each time; repeated rows are judged each by itself; null
ids stay; an empty table on either side gives no hits; other columns stay.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import documents, staged
from marketlake.llm.packed import windows, word_hashes

SIMILARITY = 0.8
WALKS = 10
STRIDE = 4
SHORT = 15
LONG = 48
EARLY = 8                               # steps from which the first two samples come
LENGTHS = (9, 12, 16, 24, 32, 48, 72)   # lengths of walks; an item has the longest that fits it
BLOCK_WORDS = 200_000
STRETCH = 400_000                       # words walked at once
SEED = 11
# Han with its iteration marks, kana, Thai, Lao, Myanmar, Khmer: written without spaces
_UNSPACED = ("\u3005-\u3007\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff\u3041-\u309f\u30a1-\u30fa\u30fc-\u30ff\u31f0-\u31ff"
             "\uff66-\uff9f\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ece\u1000-\u103f\u1050-\u108f\u109a-\u109d\u1780-\u17d3")
_MARKS = "".join(c for c in map(chr, range(0x300, 0x20000)) if unicodedata.category(c)[0] == "M" and not re.match(f"[{_UNSPACED}]", c))
_WORD = re.compile(rf"[{_UNSPACED}]|(?:[^\W{_UNSPACED}]+|[{_MARKS}]+)+")
_RUN = re.compile(rb"[0-9a-z_\x80-\xff]+")
_ALONE = re.compile(f"[{_UNSPACED}]")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and underscores with their marks; single characters of unspaced scripts."""
    text = (text or "").lower()
    if not text.isascii():
        beyond = {c for c in set(text) if not c.isascii()}
        if _ALONE.search("".join(beyond)):
            return " ".join(found).encode().split(b" ") if (found := _WORD.findall(text)) else []
        for c in beyond:
            if not _WORD.match(c):
                text = text.replace(c, " ")
    return _RUN.findall(text.encode())


class Walk:
    """One random walk: what it samples and the index of the items' windows."""

    def __init__(self, seed: tuple, early: int, lengths: list[int]):
        rng = np.random.default_rng(seed)
        self.odd = np.uint64(int(rng.integers(1 << 62)) * 2 + 1)
        self.shift = [np.uint64(s) for s in rng.integers(8, 40, max(lengths))]
        self.early = sorted(int(x) for x in rng.choice(early, size=min(2, early), replace=False))
        self.late = {n: int(rng.integers(min(early, n - 1), n)) for n in lengths}

    def walk(self, tokens: np.ndarray, at: np.ndarray, one=None, two=None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, starts, keys) of the windows that start ``at``; ``tokens`` end in enough padding.

        ``one`` and ``two`` are bit tables of the first sample and of the first two: other windows are given up.
        """
        symbols = tokens * self.odd
        start = position = at
        key = np.zeros(len(at), dtype=np.uint64)
        for step, shift in enumerate(self.shift):
            if not len(start):
                return
            read = symbols[position]
            if step in self.early:
                key = (key ^ read) * _MIX
                table = one if step == self.early[0] else two
                if table is not None:
                    stay = table[(key >> np.uint64(64 - 20)).astype(np.int64)]
                    start, position, key, read = start[stay], position[stay], key[stay], read[stay]
            for length, late in self.late.items():
                if late == step:
                    yield length, start, (key ^ read) * _MIX
            position = position + ((read >> shift) & np.uint64(1)).astype(np.int64)

    def index(self, tokens: np.ndarray, starts: dict[int, np.ndarray]) -> None:
        """Index the windows of items: ``starts`` by length of the walk."""
        every = np.concatenate(list(starts.values()))
        self.one, self.two = np.zeros(1 << 20, dtype=bool), np.zeros(1 << 20, dtype=bool)
        symbols, key, position = tokens * self.odd, np.zeros(len(every), dtype=np.uint64), every
        for step in range(self.early[-1] + 1):
            read = symbols[position]
            if step in self.early:
                key = (key ^ read) * _MIX
                (self.one if step == self.early[0] else self.two)[(key >> np.uint64(44)).astype(np.int64)] = True
            position = position + ((read >> self.shift[step]) & np.uint64(1)).astype(np.int64)
        if len(self.early) == 1:
            self.two = None
        self.keys = {}
        for length, at in starts.items():
            for n, found, keys in self.walk(tokens, at):
                if n == length:
                    order = np.argsort(keys, kind="stable")
                    self.keys[n] = keys[order], found[order]

    def probe(self, tokens: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(starts, item window starts) that agree in all samples."""
        for length, start, keys in self.walk(tokens, at, self.one, self.two):
            if length not in self.keys or not len(start):
                continue
            yield from matches(start, keys, *self.keys[length])


def edit_limit(size: int) -> int:
    """Words of an item of ``size`` words that may be edited."""
    return int(size * (1 - SIMILARITY) + 1e-9)


class Pieces:
    """The pieces of short items: of one more than the edits allowed, at least one is whole."""

    def __init__(self, tokens: np.ndarray, items: list[tuple[int, int]]):
        starts: dict[int, list] = {}
        for a, size in items:
            cuts = [a + size * n // (edit_limit(size) + 1) for n in range(edit_limit(size) + 2)]
            for begin, end in zip(cuts, cuts[1:]):
                starts.setdefault(end - begin, []).append(begin)
        self.keys = {}
        for width, at in starts.items():
            found = np.array(at, dtype=np.int64)
            keys = windows(tokens, width)[found]
            order = np.argsort(keys, kind="stable")
            self.keys[width] = keys[order], found[order]

    def probe(self, tokens: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(starts, item piece starts) that are equal."""
        for width, (known, where) in self.keys.items():
            yield from matches(at, windows(tokens, width)[at], known, where)


def matches(start: np.ndarray, keys: np.ndarray, known: np.ndarray, where: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, places) of equal keys; ``known`` is sorted."""
    low, high = np.searchsorted(known, keys), np.searchsorted(known, keys, side="right")
    count = high - low
    if count.any():
        n = np.repeat(np.arange(len(start)), count)
        nth = np.arange(len(n)) - np.repeat(np.cumsum(count) - count, count)
        yield start[n], where[low[n] + nth]


class Index:
    """Items of one block: their words, the walks over their windows and the pieces of short ones."""

    def __init__(self, items: list[tuple[object, str]], walks: int = WALKS, stride: int = STRIDE):
        self.ids, lists = [], []
        for key, text in items:
            if words := words_of(text):
                self.ids.append(key)
                lists.append(words)
        self.stride, self.words = stride, [w for w in lists]
        self.first = np.cumsum([0] + [len(w) for w in lists])
        self.pad = max(LENGTHS) + 1
        self.groups: list[tuple[int, list]] = []
        if not lists:
            return
        tokens = np.r_[word_hashes([x for w in lists for x in w]), np.zeros(self.pad, dtype=np.uint64)]
        long_starts: dict[int, list] = {}
        short = []
        for n, words in enumerate(lists):
            a, size = int(self.first[n]), len(words)
            if size < SHORT:
                short.append((a, size))
                continue
            for base in range(0, max(1, size - LONG // 2), LONG):
                left = size - base - (stride - 1)
                length = max((x for x in LENGTHS if x <= 1.5 * left), default=LENGTHS[0])
                long_starts.setdefault(length, []).extend(range(a + base, a + base + stride))
        if long_starts:
            found = {n: np.array(s, dtype=np.int64) for n, s in long_starts.items()}
            group = [Walk((SEED, stride, w), EARLY, sorted(found)) for w in range(walks)]
            for walk in group:
                walk.index(tokens, found)
            self.groups.append((stride, group))
        if short:
            self.groups.append((1, [Pieces(tokens, short)]))

    def hits(self, texts) -> Iterator[list[dict]]:
        """The checked hits of every text, in order."""
        held, size = [], 0
        for text in texts:
            held.append(words_of(text))
            size += len(held[-1])
            if size >= STRETCH:
                yield from self._stretch(held)
                held, size = [], 0
        if held:
            yield from self._stretch(held)

    def _stretch(self, lists):
        first = np.cumsum([0] + [len(w) for w in lists])
        tokens = np.r_[word_hashes([x for w in lists for x in w]), np.zeros(self.pad, dtype=np.uint64)]
        position = np.arange(int(first[-1]))
        begin = np.repeat(first[:-1], np.diff(first))
        found: dict[int, dict] = {}
        for step, walks in self.groups:
            at = position[(position - begin) % step == 0]
            pairs = [p for walk in walks for p in walk.probe(tokens, at)]
            if not pairs:
                continue
            start, where = np.concatenate([s for s, _ in pairs]), np.concatenate([w for _, w in pairs])
            doc = np.searchsorted(first, start, side="right") - 1
            item = np.searchsorted(self.first, where, side="right") - 1
            guess = start - first[doc] - (where - self.first[item])     # where the item would begin in the document
            for d, i, g in np.unique(np.stack([doc, item, guess // 4 * 4], axis=1), axis=0).tolist():
                hit = self._check(lists[d], i, g)
                if hit and (i not in found.setdefault(d, {}) or hit["distance"] < found[d][i]["distance"]):
                    found[d][i] = hit
        for d in range(len(lists)):
            yield [found[d][i] for i in sorted(found[d])] if d in found else []

    def _check(self, words, item, guess):
        own = self.words[item]
        limit = edit_limit(len(own))
        slack = limit + 8
        low, high = max(0, guess - slack), min(len(words), guess + len(own) + slack + 4)
        near, wanted = words[low:high], set(own)
        if sum(w in wanted for w in near) < len(own) - limit:
            return None
        distance, stop = best_match(own, near)
        if distance > limit:
            return None
        _, back = best_match(own[::-1], near[:stop][::-1])
        return {"item": item, "distance": distance, "start": low + stop - back, "stop": low + stop}


def best_match(pattern: list, text: list) -> tuple[int, int]:
    """(edit distance, end) of the part of ``text`` nearest to the whole ``pattern``: Myers' bit vectors, the first best end."""
    n = len(pattern)
    full, top = (1 << n) - 1, 1 << (n - 1)
    equal: dict = {}
    for i, word in enumerate(pattern):
        equal[word] = equal.get(word, 0) | 1 << i
    plus, minus, score, best = full, 0, n, (n, 0)
    for end, word in enumerate(text, 1):
        eq = equal.get(word, 0)
        across = eq | minus
        down = (((eq & plus) + plus) ^ plus) | eq
        up, lower = minus | (full & ~(down | plus)), plus & down
        if up & top:
            score += 1
        elif lower & top:
            score -= 1
        up, lower = (up << 1) & full, (lower << 1) & full
        plus, minus = lower | (full & ~(across | up)), up & across
        if score < best[0]:
            best = score, end
    return best


HITS = "array<struct<item:int,distance:int,start:int,stop:int>>"


def _with_hits(docs: DataFrame, index: Index) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf(HITS)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(list(shipped.value.hits(batch)), dtype=object)

    return docs.withColumn("hits", find(F.col("text")))


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list]:
    """(item_id, text) of the items, a block of about ``block_words`` words at a time."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).head()[0]
    blocks = max(1, math.ceil(size / 5 / block_words))
    for number in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        yield sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0], r[1]))


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, distance, n_words, start, stop): one row for each document and item found in it.

    ``n_words`` is the item's length, start and stop are word positions in the document.
    """
    found = []
    kind = benchmark.schema["item_id"].dataType.simpleString()
    for items in item_blocks(benchmark):
        index = Index(items, **options)
        names = docs.sparkSession.createDataFrame(
            [(n, i, len(index.words[n])) for n, i in enumerate(index.ids)], f"item int, item_id {kind}, n_words int")
        hits = _with_hits(docs.select("doc_id", "text"), index).select("doc_id", F.inline("hits"))
        # as many rows as the block has items
        found.append(hits.join(F.broadcast(names), "item").select("doc_id", "item_id", "distance", "n_words", "start", "stop"))
    return reduce(DataFrame.unionByName, found)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows in which an item was found."""
    for number, items in enumerate(item_blocks(benchmark)):
        docs = staged(docs, "decontaminated") if number else docs
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
        docs = _with_hits(docs.select(whole, "text"), Index(items, **options)).where(F.size("hits") == 0).select("row.*")
    return docs


def op4_decontaminate(spark, folder):
    """All hits of ``benchmark`` in ``documents``."""
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return contaminated(documents(spark, folder), benchmark).withColumn("doc_id", F.col("doc_id").cast("long"))
