"""Katz backoff language model, counted and evaluated range by range.

Tokens are lower-cased words and one end mark a text; the mark is also the
history of the first word. Words that training lacks are one more type. For a
history h with training count c(h) and a word w that follows it c times:

    P(w | h) = d(c) c / c(h)          if c > 0
             = alpha(h) P(w)          otherwise; P(w) if h was never seen
    P(w)     = d(c(w)) c(w) / N       if c(w) > 0, else what the others leave

d(c) are Good-Turing discounts for c up to ``CUT``, from counts of counts of the
whole training data, 1 above; where they are not between 0 and 1 (tiny data),
absolute discounting takes their place. alpha(h) shares out exactly what h's
seen words leave over the probability of its unseen words. A history whose words
are all beyond the cut has one count set aside for the unseen.

How it runs. Texts become chunks of about ``CHUNK`` tokens, a written table: the
sorted hashes of a chunk's words and its tokens as positions in them. Word
counts: each chunk's words go to the task of their hash range, which adds up the
counts, numbers the words, and answers every chunk. Word pairs: each chunk's
distinct pairs go to the task of their history's range, with their training
counts, the words' counts and the documents they stand in; that task holds the
complete bigram table of its range and returns the sum of log probabilities it
finds for each document. A history with more than ``HOT`` ranges' worth of the
training data is spread over all ranges by word; its sums are added up first.
All that is shipped are sorted, compressed arrays.

Defined results: null and empty texts are one end mark; null ids count as the
empty id and stay; repeated rows are counted and scored each; without training
data every token has probability 1 as unknown; an empty table gives an empty
result; other columns are not touched. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import documents, remainder, staged
from marketlake.llm.packed import by_partition, expand, pack_sorted, squeeze, unpack_sorted, word_hashes

CUT = 5
CHUNK = 1_000_000
RANGE_TOKENS = 4_000_000    # tokens to a range, on average
HOT = 4
FOLDS, HELD = 7, 2
END = b""


def words_of(text: str | None) -> list[bytes]:
    """bytes.lower() changes A-Z only, bytes.split() parts at the contract's white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def discounts(numbers: list[int], cut: int = CUT) -> np.ndarray:
    """d(0..cut) from n_1 .. n_(cut+1), the numbers of types seen that often."""
    n = [0.0, *map(float, numbers)]
    d = np.ones(cut + 1)
    if all(x > 0 for x in n[1:cut + 2]):
        common = (cut + 1) * n[cut + 1] / n[1]
        good = [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if common < 1 else 0.0 for r in range(1, cut + 1)]
        if all(0 < x < 1 for x in good):
            d[1:] = good
            return d
    share = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    d[1:] = [1 - share / r for r in range(1, cut + 1)]
    return d


class Unigrams:
    """P(w) from a word's training count."""

    def __init__(self, total: int, numbers: list[int]):
        self.total, self.d = total, discounts(numbers)
        left = sum(r * n * (1 - self.d[r]) for r, n in enumerate(numbers[:CUT], 1)) if total else 1.0
        self.base = float(total) if left > 1e-9 else total + 1.0
        self.unknown = (left if left > 1e-9 else 1.0) / max(self.base, 1.0)

    def __call__(self, count: np.ndarray) -> np.ndarray:
        d = np.where(count <= CUT, self.d[np.minimum(count, CUT).astype(np.int64)], 1.0)
        return np.where(count > 0, d * count / max(self.base, 1.0), self.unknown)


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    end = word_hashes([END])
    ids, held, hashes, count = [], [], [], 0

    def flush():
        size = np.array([len(h) for h in hashes], dtype=np.uint64)
        vocabulary, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
        train = np.repeat(~np.array(held, dtype=bool), size.astype(np.int64))
        counts = np.bincount(tokens[train], minlength=len(vocabulary)).astype(np.uint64)
        return pd.DataFrame({"ids": [ids], "held": [held], "sizes": [squeeze(size)], "words": [pack_sorted(vocabulary)],
                             "counts": [squeeze(counts)], "tokens": [squeeze(tokens.astype(np.uint32))], "trained": [int(train.sum())]})

    for batch in batches:
        for key, text, out in zip(batch["id"], batch["text"], batch["held"]):
            ids.append(key)
            held.append(bool(out))
            hashes.append(np.r_[word_hashes(words_of(text)), end])
            count += len(hashes[-1])
            if count >= CHUNK:
                yield flush()
                ids, held, hashes, count = [], [], [], 0
    if ids:
        yield flush()


CHUNKS = "ids array<string>, held array<boolean>, sizes binary, words binary, counts binary, tokens binary, trained long"


def _ask_words(parts):
    def run(batches):
        for batch in batches:
            for chunk, words, counts in zip(batch["chunk"], batch["words"], batch["counts"]):
                words, counts = unpack_sorted(words), expand(counts, np.uint64)
                rows = [(p, chunk, pack_sorted(words[a:b]), squeeze(counts[a:b])) for p, a, b in by_partition(words, parts)]
                yield pd.DataFrame(rows, columns=["part", "chunk", "words", "counts"])
    return run


def _numbers(total: np.ndarray) -> list[int]:
    """n_1 .. n_(CUT+1)"""
    return np.bincount(total[(total > 0) & (total <= CUT + 1)].astype(np.int64), minlength=CUT + 2)[1:].tolist()


def _count_words(rows: pd.DataFrame) -> pd.DataFrame:
    """Answers: the words' places in this range and their training counts; one row of statistics (chunk -1)."""
    asked = [unpack_sorted(w) for w in rows["words"]]
    known, place = np.unique(np.concatenate(asked), return_inverse=True)
    counts = np.concatenate([expand(c, np.uint64) for c in rows["counts"]])
    total = np.bincount(place, weights=counts.astype(np.float64), minlength=len(known)).astype(np.uint64)
    part, at, out = int(rows["part"].iloc[0]), 0, []
    for chunk, own in zip(rows["chunk"], asked):
        here = place[at:at + len(own)]
        at += len(own)
        out.append((chunk, part, pack_sorted(here.astype(np.uint64)), squeeze(total[here]), None))
    out.append((-1, part, None, None, [len(known), int((total > 0).sum()), *_numbers(total)]))
    return pd.DataFrame(out, columns=["chunk", "part", "places", "counts", "stats"])


PAIRS = ("part int, chunk long, n_docs int, hot boolean, pairs binary, trained binary, counts binary, occurs binary, docs binary, "
         "ids array<string>, held array<boolean>, n_tokens array<long>, n_known array<long>, base array<double>")
_EMPTY = [None] * 5


def _pairs(offsets, vocabulary, total, types, parts):
    """A chunk's word pairs by range, and what its documents score without history."""
    hot_count = HOT * total / parts

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame(columns=[c.split()[0] for c in PAIRS.split(", ")])
        row = left.iloc[0]
        answers = right.sort_values("part")     # the chunk's words are sorted by range already
        ids = np.concatenate([unpack_sorted(p) + np.uint64(offsets[n]) for n, p in zip(answers["part"], answers["places"])])
        count = np.concatenate([expand(c, np.uint64) for c in answers["counts"]])
        # a chunk has far fewer than 2**31 tokens: small numbers keep the arrays small
        tokens, sizes = expand(row["tokens"], np.uint32).view(np.int32), expand(row["sizes"], np.uint64).astype(np.int64)
        doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        stop = np.cumsum(sizes)
        history = np.r_[np.int32(0), tokens[:-1]]
        history[stop - sizes] = tokens[stop - 1]    # the end mark stands before a text too
        seen = count[tokens]
        base = np.bincount(doc, weights=np.log10((seen + 1.0) / (total + 1.0 * (types + 1))), minlength=len(sizes))
        known = np.bincount(doc[seen > 0], minlength=len(sizes))
        del seen
        out = [(-1 - int(row["chunk"]) % parts, row["chunk"], len(sizes), False, *_EMPTY, list(row["ids"]), list(row["held"]),
                sizes.tolist(), known.tolist(), base.tolist())]

        pair = ids[history] << np.uint64(32) | ids[tokens]
        order = np.argsort(pair, kind="stable").astype(np.int32)
        pair, doc_of = pair[order], doc[order]
        del doc
        start = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        occurs = np.diff(np.r_[start, len(pair)])
        train = ~np.array(row["held"], dtype=bool)
        trained = np.add.reduceat(train[doc_of].astype(np.int64), start)
        first = order[start]
        pair, word_count, history_count = pair[start], count[tokens[first]], count[history[first]]
        del order, tokens, history
        hot = history_count > hot_count
        mixed = pair * np.uint64(0x9E3779B97F4A7C15)
        part = np.where(hot, (mixed >> np.uint64(32)) % np.uint64(parts), (pair >> np.uint64(32)) * np.uint64(parts) // np.uint64(vocabulary))
        kind = np.uint16 if len(sizes) < 1 << 16 else np.uint32
        for is_hot in (False, True):
            at = np.flatnonzero(hot == is_hot)
            at = at[np.argsort(part[at], kind="stable")]        # by range, pairs in order within each
            if not len(at):
                continue
            stops = np.cumsum(occurs[at])
            docs = doc_of[np.repeat(start[at] - (stops - occurs[at]), occurs[at]) + np.arange(stops[-1])].astype(kind)
            cuts = np.r_[np.flatnonzero(np.r_[True, part[at][1:] != part[at][:-1]]), len(at)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                own, first_doc = at[a:b], int(stops[a] - occurs[at[a]])
                out.append((int(part[own[0]]), row["chunk"], len(sizes), is_hot, pack_sorted(pair[own]),
                            squeeze(trained[own].astype(np.uint32)), squeeze(word_count[own]), squeeze(occurs[own].astype(np.uint32)),
                            squeeze(docs[first_doc:stops[b - 1]]), None, None, None, None, None))
        return pd.DataFrame(out, columns=[c.split()[0] for c in PAIRS.split(", ")])
    return run


class Range:
    """The bigram table of one range of histories (or of its share of the hot ones), and what each chunk asks of it."""

    def __init__(self, rows: pd.DataFrame):
        self.rows, self.asked = rows, [unpack_sorted(p) for p in rows["pairs"]]
        self.pairs, self.place = np.unique(np.concatenate(self.asked), return_inverse=True)
        trained = np.concatenate([expand(t, np.uint32) for t in rows["trained"]])
        self.count = np.bincount(self.place, weights=trained, minlength=len(self.pairs))
        self.word = np.zeros(len(self.pairs), dtype=np.float64)
        self.word[self.place] = np.concatenate([expand(c, np.uint64) for c in rows["counts"]])
        self.ids = self.pairs >> np.uint64(32)
        self.start = np.flatnonzero(np.r_[True, self.ids[1:] != self.ids[:-1]])

    def sums(self, unigrams: Unigrams) -> np.ndarray:
        """For each history: its training count in seen pairs of 1 .. CUT and of more, and the probability of its seen words."""
        low = [np.where(self.count == r, self.count, 0) for r in range(1, CUT + 1)]
        columns = [*low, np.where(self.count > CUT, self.count, 0), np.where(self.count > 0, unigrams(self.word), 0.0)]
        return np.stack([np.add.reduceat(c, self.start) for c in columns], axis=1)

    def scores(self, sums: np.ndarray, d: np.ndarray, unigrams: Unigrams) -> Iterator[tuple[int, np.ndarray]]:
        """(chunk, sum of log10 probabilities of each of its documents over this range's pairs)."""
        total = sums[:, :CUT + 1].sum(axis=1)
        left = (sums[:, :CUT] * (1 - d[1:])).sum(axis=1)
        spare = left > 1e-9 * np.maximum(total, 1)
        base = np.where(spare, total, total + 1.0)
        left = np.where(spare, left, 1.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            alpha = np.where(total > 0, left / np.maximum(base, 1) / (1 - sums[:, CUT + 1]), 1.0)
        owner = np.repeat(np.arange(len(self.start)), np.diff(np.r_[self.start, len(self.pairs)]))
        discounted = self.count * np.where(self.count <= CUT, d[np.minimum(self.count, CUT).astype(np.int64)], 1.0)
        p = np.where(self.count > 0, discounted / np.maximum(base[owner], 1), alpha[owner] * unigrams(self.word))
        log, at = np.log10(p), 0
        for row, own in zip(self.rows.itertuples(index=False), self.asked):
            mine = log[self.place[at:at + len(own)]]
            at += len(own)
            kind = np.uint16 if row.n_docs < 1 << 16 else np.uint32
            yield row.chunk, np.bincount(expand(row.docs, kind), weights=np.repeat(mine, expand(row.occurs, np.uint32)), minlength=row.n_docs)


def _statistics(unigrams):
    """Counts of counts (id -1), and the sums of the shares of spread histories (by history)."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if rows["part"].iloc[0] >= 0:
            for is_hot, own in rows.groupby("hot"):
                table = Range(own)
                out.append((-1, [float(n) for n in _numbers(table.count)] + [0.0]))
                if is_hot:
                    out += [(int(i), s.tolist()) for i, s in zip(table.ids[table.start], table.sums(unigrams))]
        return pd.DataFrame(out, columns=["id", "sums"])
    return run


SCORED = "chunk long, scores array<double>, ids array<string>, held array<boolean>, n_tokens array<long>, n_known array<long>, base array<double>"


def _score(unigrams):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        names = ["chunk", "scores", "ids", "held", "n_tokens", "n_known", "base"]
        if rows["part"].iloc[0] < 0:
            return rows.assign(scores=None)[names]
        model = {m["id"]: np.array(m["sums"]) for m in json.loads(rows["model"].iloc[0])}
        d = discounts([int(x) for x in model[-1][:CUT + 1]])
        scores: dict[int, np.ndarray] = {}
        for is_hot, own in rows.groupby("hot"):
            table = Range(own)
            sums = np.array([model[int(i)] for i in table.ids[table.start]]) if is_hot else table.sums(unigrams)
            for chunk, found in table.scores(sums, d, unigrams):
                scores[chunk] = scores[chunk] + found if chunk in scores else found
        return pd.DataFrame([(c, s.tolist(), *[None] * 5) for c, s in scores.items()], columns=names)
    return run


def _per_document(rows: pd.DataFrame) -> pd.DataFrame:
    docs = rows[rows["ids"].notna()].iloc[0]
    total = np.sum([np.asarray(s) for s in rows["scores"] if s is not None], axis=0)
    return pd.DataFrame({"id": list(docs["ids"]), "held": list(docs["held"]), "n_tokens": docs["n_tokens"], "n_known": docs["n_known"],
                         "base": docs["base"], "score": total})


def score_documents(docs: DataFrame, keep: str, held: str) -> DataFrame:
    """(id, held, n_tokens, n_known, train_tokens, base_score, score) of every row; rows where ``held`` is true are not learnt from."""
    spark = docs.sparkSession
    own = docs.select(F.col(keep).cast("string").alias("id"), "text", F.coalesce(F.col(held), F.lit(False)).alias("held"))
    chunks = staged(own.mapInPandas(_chunks, CHUNKS).withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    total = chunks.agg(F.coalesce(F.sum("trained"), F.lit(0))).head()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / RANGE_TOKENS))
    answers = staged(chunks.select("chunk", "words", "counts").mapInPandas(_ask_words(parts), "part int, chunk long, words binary, counts binary")
                     .groupBy("part").applyInPandas(_count_words, "chunk long, part int, places binary, counts binary, stats array<long>"), "words")
    stats = sorted(answers.where("chunk = -1").select("part", "stats").collect())
    offsets, vocabulary = {}, 0
    for part, s in stats:
        offsets[part] = vocabulary
        vocabulary += s[0]
    types = sum(s[1] for _, s in stats)
    unigrams = Unigrams(total, [sum(s[i] for _, s in stats) for i in range(2, CUT + 3)])
    pairs = (chunks.select("chunk", "ids", "held", "sizes", "tokens").groupBy("chunk").cogroup(answers.where("chunk >= 0").groupBy("chunk"))
             .applyInPandas(_pairs(offsets, max(1, vocabulary), total, types, parts), PAIRS).repartition(parts, "part"))
    # read twice by one query, so the exchange of the pairs is made once
    sums = (pairs.groupBy("part").applyInPandas(_statistics(unigrams), "id long, sums array<double>")
            .groupBy("id").agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(CUT + 2)])
            .agg(F.to_json(F.collect_list(F.struct("id", F.array(*[f"s{i}" for i in range(CUT + 2)]).alias("sums")))).alias("model")))
    scored = pairs.withColumn("model", sums.scalar()).groupBy("part").applyInPandas(_score(unigrams), SCORED)
    per_doc = scored.groupBy("chunk").applyInPandas(
        _per_document, "id string, held boolean, n_tokens long, n_known long, base double, score double")
    return per_doc.select(F.col("id").cast(docs.schema[keep].dataType).alias("id"), "held", "n_tokens", "n_known",
                          F.lit(total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def op8_katz(spark, folder):
    """Contract 8."""
    docs = documents(spark, folder).select("doc_id", "text", (remainder(F.col("doc_id"), FOLDS) == HELD).alias("held"))
    return score_documents(docs, "doc_id", "held").select(
        F.col("id").cast("long").alias("doc_id"), F.col("held").alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")
