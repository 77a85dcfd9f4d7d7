"""Token counts that survive edits: a segment tree of pre-tokens per document.

A tokenizer splits a text into pre-tokens by a pattern and encodes each by
itself, so counts add up. Each document keeps a binary tree over leaves of about
``LEAF`` pre-tokens; every node holds the characters and tokens below it. An edit
finds its leaves by descending the character sums, and only those are encoded
again: from the start of the leaf ``CONTEXT`` characters before the edit (the
pattern looks that far ahead at most) up to the first old leaf boundary after
it at which the new split falls in step with the old one; everything to the
right of a boundary depends on nothing to its left. The new counts go to the
first leaf touched, the others become empty, and the sums above them are
updated. A leaf that grows beyond ``GROW`` times its size has the tree laid out
anew from its counts.

A tree is a struct of two int arrays, kept next to the text in any table. Work is
per row, spread as the rows are.

Defined results: a null or empty text has no tokens and an empty tree, and
inserts into it work; positions are code points of the text before the edits;
edits are taken by start, one that begins before the end of the last is left
out, as is one without a start; ends beyond the text are cut; a null replacement
deletes; repeated rows and null ids stay; an empty table gives an empty result;
other columns are not touched.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import documents

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pre-token pattern that belongs to this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTEXT = 4
LEAF = 64
GROW = 8
CACHE = 100_000      # pre-tokens a task remembers at once
TREE = "struct<chars:array<int>,tokens:array<int>>"
EDITS = "array<struct<start:int,stop:int,text:string>>"


class Counter(dict):
    """Tokens of a pre-token, remembered."""

    def __init__(self, ranks: bytes, pattern: str):
        import regex
        import tiktoken

        super().__init__()
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.split = regex.compile(pattern).finditer
        self.pieces = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[piece] = n = len(self.encoding._encode_single_piece(piece))
        return n


@lru_cache(maxsize=2)
def _counter(ranks: bytes, pattern: str) -> Counter:
    return Counter(ranks, pattern)


class Tree:
    """Sums of characters and tokens; node 1 is the root, the leaves are the upper half."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.half = len(chars) // 2

    @classmethod
    def over(cls, chars, tokens) -> Tree:
        """From the leaves' numbers."""
        half = 1 << max(0, len(chars) - 1).bit_length() if len(chars) else 1
        sums = []
        for leaves in (chars, tokens):
            tree = np.zeros(2 * half, dtype=np.int64)
            tree[half:half + len(leaves)] = leaves
            level = half
            while level > 1:
                tree[level // 2:level] = tree[level:2 * level:2] + tree[level + 1:2 * level:2]
                level //= 2
            sums.append(tree)
        return cls(*sums)

    @classmethod
    def of(cls, pieces: list[str], counter: Counter) -> Tree:
        chars = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        tokens = np.fromiter(map(counter.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        if not len(pieces):
            return cls.over([], [])
        at = np.arange(0, len(pieces), LEAF)
        return cls.over(np.add.reduceat(chars, at), np.add.reduceat(tokens, at))

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def find(self, position: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds a position (the last leaf with text for the end)."""
        position = max(0, min(position, int(self.chars[1]) - 1))
        node, first = 1, 0
        while node < self.half:
            node *= 2
            if position - first >= self.chars[node]:
                first += int(self.chars[node])
                node += 1
        return node - self.half, first

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.half
        more = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more[0]
            self.tokens[node] += more[1]
            node //= 2


def apply_edits(text: str, tree: Tree, edits: list[tuple[int, int, str]], counter: Counter) -> tuple[str, Tree, int, int]:
    """(new text, new tree, characters encoded again, edits applied)."""
    again = applied = 0
    moved, last = 0, -1
    for start, stop, new in edits:
        if start < last or start > len(text) - moved:
            continue
        stop = min(max(stop, start), len(text) - moved)
        last = stop
        applied += 1
        a, b = start + moved, stop + moved
        text = text[:a] + new + text[b:]
        grown = len(new) - (b - a)
        moved += grown
        leaf, first = tree.find(a - CONTEXT)
        # old leaf boundaries at or after the edit, as positions of the new text
        leaves, bound = leaf, first + int(tree.chars[tree.half + leaf])
        size = tokens = pieces = 0
        end = first
        for match in counter.split(text, first):
            end = match.end()
            size, tokens, pieces = end - first, tokens + counter[match.group()], pieces + 1
            while leaves + 1 < tree.half and (bound < b or bound + grown < end):
                leaves += 1
                bound += int(tree.chars[tree.half + leaves])
            if bound >= b and bound + grown == end:
                break
        else:
            leaves = tree.half - 1
        again += size
        tree.put(leaf, size, tokens)
        for other in range(leaf + 1, leaves + 1):
            if tree.chars[tree.half + other]:
                tree.put(other, 0, 0)
        if pieces > GROW * LEAF:
            # lay the grown leaf out as leaves of the usual size
            parts = [m.group() for m in counter.split(text, first) if m.end() <= end]
            own = Tree.of(parts, counter)
            keep = own.chars[own.half:] > 0
            spread = [np.concatenate([old[tree.half:tree.half + leaf], mine[own.half:][keep], old[tree.half + leaf + 1:]])
                      for old, mine in ((tree.chars, own.chars), (tree.tokens, own.tokens))]
            full = spread[0] > 0
            tree = Tree.over(spread[0][full], spread[1][full])
    return text, tree, again, applied


def _wanted(edits) -> list[tuple[int, int, str]]:
    """The edits that have a start, by start; pandas gives a missing number as NaN."""
    found = []
    for e in edits:
        if e is not None and pd.notna(e["start"]) and e["start"] >= 0:
            start = int(e["start"])
            found.append((start, int(e["stop"]) if pd.notna(e["stop"]) else start, e["text"] or ""))
    return sorted(found, key=lambda e: e[:2])


def _ranks(vocabulary: str) -> bytes:
    with open(vocabulary, "rb") as file:
        return file.read()


def with_trees(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, column: str = "tree") -> DataFrame:
    """Add each text's tree. The vocabulary is read by the driver and shipped."""
    ranks = docs.sparkSession.sparkContext.broadcast(_ranks(vocabulary))

    @F.pandas_udf(TREE)
    def build(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = _counter(ranks.value, pattern)
        for batch in texts:
            trees = [Tree.of(counter.pieces(t or ""), counter) for t in batch]
            yield pd.DataFrame({"chars": [t.chars.astype(np.int32) for t in trees], "tokens": [t.tokens.astype(np.int32) for t in trees]})

    return docs.withColumn(column, build(F.col("text")))


RESULT = f"struct<text:string,tree:{TREE},n_tokens:long,again:long,n_edits:int>"


def with_edits(docs: DataFrame, edits: Column, vocabulary: str = VOCABULARY, pattern: str = PATTERN, column: str = "edited",
               keep_text: bool = True) -> DataFrame:
    """Apply ``edits`` (an array of start, stop, text) to the rows' ``text`` and ``tree``.

    Adds a struct: the new text (null unless ``keep_text``), its tree, its
    tokens, the characters that were encoded again and the edits applied.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(_ranks(vocabulary))

    @F.pandas_udf(RESULT)
    def edit(batches: Iterator[tuple[pd.Series, pd.DataFrame, pd.Series]]) -> Iterator[pd.DataFrame]:
        counter = _counter(ranks.value, pattern)
        for texts, trees, lists in batches:
            out = []
            for text, chars, tokens, own in zip(texts, trees["chars"], trees["tokens"], lists):
                own = _wanted(own if own is not None else [])
                tree = Tree(np.array(chars, dtype=np.int64), np.array(tokens, dtype=np.int64))
                new, tree, again, applied = apply_edits(text or "", tree, own, counter)
                out.append((new if keep_text else None, {"chars": tree.chars.astype(np.int32), "tokens": tree.tokens.astype(np.int32)},
                            tree.total, again, applied))
            yield pd.DataFrame(out, columns=["text", "tree", "n_tokens", "again", "n_edits"])

    return docs.withColumn(column, edit(F.col("text"), F.col("tree"), edits))


def redactions(docs: DataFrame, column: str = "edits") -> DataFrame:
    """The edits of a preparation run: a language mark in front, mail addresses and long numbers replaced."""
    import re

    wanted = re.compile(r"(?P<number>[0-9]{4,})|(?<![A-Za-z0-9_.+-])(?P<mail>[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+)")
    number = re.compile(r"(?P<number>[0-9]{4,})")

    @F.pandas_udf(EDITS)
    def find(texts: pd.Series, langs: pd.Series) -> pd.Series:
        out = []
        for text, lang in zip(texts, langs):
            found = (wanted if "@" in (text or "") else number).finditer(text or "")
            out.append([{"start": 0, "stop": 0, "text": f"[{lang or 'und'}] "}, *(
                {"start": m.start(), "stop": m.end(), "text": f"<{m.lastgroup}>"} for m in found)])
        return pd.Series(out)

    return docs.withColumn(column, find(F.col("text"), F.col("lang")))


def op9_token_counts(spark, folder, vocabulary: str = VOCABULARY):
    """Tokens of every document before and after the edits of a preparation run."""
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    edited = with_edits(with_trees(redactions(docs), vocabulary), F.col("edits"), vocabulary, keep_text=False)
    return edited.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.get("tree.tokens", F.lit(1)), F.lit(0)).cast("long").alias("n_tokens"),
        F.col("edited.n_tokens").alias("n_tokens_edited"), F.col("edited.n_edits").alias("n_edits"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), F.col("edited.again").alias("n_chars_encoded_again"))
