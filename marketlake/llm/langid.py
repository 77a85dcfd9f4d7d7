"""Language identification: averaged hashed subword embeddings, linear softmax.

A text's subwords are the 2 to 4 letter pieces of its lower-cased words, word
ends included, hashed to ``BUCKETS`` rows of an embedding table. A text is the
mean of its subwords' embeddings, classified by a linear softmax. Table and
softmax are trained together by stochastic gradient descent in numpy, on a
bounded sample: ``SAMPLE`` rows at most, shared out equally to at most
``LANGUAGES`` languages (the most frequent ones), chosen by a hash of the id.

A fifth of the sample is kept for calibration: a temperature is fitted there,
and a document is rejected if its calibrated probability is below the level at
which the calibration rows above it are right ``TARGET`` of the time, at most
``REJECT`` (one half: likelier wrong than right). Texts without a letter are
rejected always.

The model is a table of BUCKETS x languages numbers. Prediction reads whole
texts, in slices of ``SLICE`` characters, and takes only the text as input.

Defined results: a null text, an empty one and one without a letter give
``und`` with score 0; a null lang or doc_id takes no part in training; equal
texts get equal results; without any labelled row everything is ``und``; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marketlake.llm.common import documents, remainder

BITS = 14
BUCKETS = 1 << BITS
SAMPLE = 4000
LANGUAGES = 200
MARGIN, HASHES = 2, 1 << 40
WIDTH = 16
EPOCHS = 12
BATCH = 32
STEPS = 600           # at least so many, however small the sample
RATE = 0.5
REJECT = 0.5
TARGET = 0.999
SLICE = 1 << 20
UNKNOWN = "und"
FOLDS = 5

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _letters


def _slice_buckets(text: str) -> np.ndarray:
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _is_letter()[code]
    marked = np.zeros(len(code) + 2, dtype=np.uint32)
    marked[1:-1] = np.where(letter, code, 0)
    gap = marked == 0
    again = np.zeros(len(marked), dtype=bool)
    again[1:] = gap[1:] & gap[:-1]
    marked = marked[~again]
    if len(marked) < 3:
        return np.zeros(0, dtype=np.int64)
    found, piece, inside = [], marked, np.ones(len(marked), dtype=bool)
    for width in (2, 3, 4):
        if len(marked) < width:
            break
        if width > 2:  # letters only between the two ends
            inside = (inside[:-1] if width > 3 else np.ones(len(marked) - 2, dtype=bool)) & (marked[width - 2:len(marked) - 1] != 0)
        piece = piece[:-1] * np.uint32(0x01000193) ^ marked[width - 1:]
        mixed = (piece ^ (piece >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(width * 0x9E3779B1 & 0xFFFFFFFF)
        bucket = ((mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)
        found.append(bucket if width == 2 else bucket[inside])
    return np.concatenate(found).astype(np.int64)


def subword_counts(text: str | None) -> np.ndarray:
    """How often each bucket occurs in the whole text."""
    total = np.zeros(BUCKETS, dtype=np.float32)
    for start in range(0, len(text or ""), SLICE):
        total += np.bincount(_slice_buckets(text[start:start + SLICE]), minlength=BUCKETS)
    return total


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray      # BUCKETS x languages: embeddings times the softmax layer
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        total = counts.sum()
        z = (counts @ self.weights / max(total, 1.0) + self.bias) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def train(counts: list[np.ndarray], labels: list[str], held: np.ndarray, seed: int = 7) -> Model:
    """Fit by SGD on the rows not ``held``; calibrate on the held ones. ``counts``: sparse (buckets, numbers) pairs."""
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    layer = rng.uniform(-0.5, 0.5, (WIDTH, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    rows = np.flatnonzero(~held)
    batches = max(1, -(-len(rows) // BATCH))
    epochs, step = max(EPOCHS, -(-STEPS // batches)), 0

    def dense(chosen):
        x = np.zeros((len(chosen), BUCKETS), dtype=np.float32)
        for i, r in enumerate(chosen):
            x[i, counts[r][0]] = counts[r][1]
        return x / np.maximum(x.sum(axis=1, keepdims=True), 1)

    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(rows), batches):
            if not len(batch):
                continue
            rate, step = RATE * (1 - step / (epochs * batches)), step + 1
            x = dense(batch)
            hidden = x @ table
            z = hidden @ layer + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), target[batch]] -= 1
            back = p @ layer.T
            layer -= rate * hidden.T @ p / len(batch) * 16
            bias -= rate * p.mean(axis=0)
            table -= (rate * 64) * (x.T @ back) / len(batch) * 16
    model = Model(languages, (table @ layer).astype(np.float32), bias, 1.0, REJECT)
    check = np.flatnonzero(held)
    if len(check):
        x = np.concatenate([dense(part) @ model.weights for part in np.array_split(check, -(-len(check) // 256))]) + bias

        def spread(t):
            e = np.exp((x - x.max(axis=1, keepdims=True)) / t)
            return e / e.sum(axis=1, keepdims=True)

        right_p = lambda t: spread(t)[np.arange(len(check)), target[check]]
        model.temperature = float(min(np.geomspace(0.1, 8, 45), key=lambda t: -np.log(np.maximum(right_p(t), 1e-12)).sum()))
        p = spread(model.temperature)
        score, right = p.max(axis=1), p.argmax(axis=1) == target[check]
        order = np.argsort(-score)
        good = np.flatnonzero(np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= TARGET)
        model.threshold = float(min(REJECT, score[order][good[-1]] if len(good) else REJECT))
    return model


def fit(docs: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES) -> Model | None:
    """Train on a bounded sample of the labelled rows outside the held-out fold; None without any."""
    learn = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), FOLDS) != 0))
    known = {r["lang"]: r["count"] for r in learn.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()}
    if not known:
        return None
    per = max(2, sample // len(known))
    # hashes low enough that about MARGIN times the rows wanted are left, so that few rows are ever put in order
    low = F.create_map(*[F.lit(x) for lang, n in known.items() for x in (lang, min(1.0, MARGIN * per / n) * HASHES)])
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(HASHES))
    pick = F.row_number().over(Window.partitionBy("lang").orderBy(hashed, "doc_id"))
    ids = (learn.where(F.col("lang").isin(list(known)) & (hashed < low[F.col("lang")])).select("lang", "doc_id").withColumn("pick", pick)
           .where(F.col("pick") <= per).select(F.col("doc_id").alias("picked")).distinct())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                c = subword_counts(text)
                at = np.flatnonzero(c)
                out.append((at.astype(np.uint16).tobytes(), c[at].astype(np.float32).tobytes()))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang": batch["lang"], "at": [a for a, _ in out], "n": [n for _, n in out]})

    # at most ``sample`` ids, so the look-up side is bounded
    rows = (learn.where(F.col("text").isNotNull()).join(F.broadcast(ids), F.col("doc_id") == F.col("picked"), "left_semi")
            .select("doc_id", "lang", "text").mapInPandas(count, "doc_id long, lang string, at binary, n binary")
            .where("length(at) > 0").limit(2 * sample).collect())
    rows = sorted(rows, key=lambda r: (r["lang"], r["doc_id"], bytes(r["at"])))
    if not rows:
        return None
    counts = [(np.frombuffer(r["at"], dtype=np.uint16), np.frombuffer(r["n"], dtype=np.float32)) for r in rows]
    return train(counts, [r["lang"] for r in rows], np.arange(len(rows)) % 5 == 4)


RESULT = T.StructType([
    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])


def predict(docs: DataFrame, model: Model | None, column: str = "_lang") -> DataFrame:
    """Add a struct (lang_pred, score, rejected); only the text is looked at."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def classify(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        use = shipped.value
        for batch in texts:
            out = []
            for text in batch:
                counts = subword_counts(text) if text is not None and use is not None else None
                if counts is None or not counts.any():
                    out.append((UNKNOWN, 0.0, True))
                    continue
                p = use.probabilities(counts)
                best = int(p.argmax())
                out.append((use.languages[best], float(p[best]), bool(p[best] < use.threshold)))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "rejected"])

    return docs.withColumn(column, classify(F.col("text")))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without those whose language the classifier rejects."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    judged = predict(docs.select(whole, "text"), fit(docs.select("doc_id", "lang", "text")))
    return judged.where(~F.col("_lang.rejected")).select("row.*")


def op3_langid(spark, folder):
    """Contract 3."""
    docs = documents(spark, folder).select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    return predict(docs.select("doc_id", "text"), fit(docs)).select(
        "doc_id", (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"), F.col("_lang.lang_pred").alias("lang_pred"),
        F.col("_lang.score").alias("score"), F.col("_lang.rejected").alias("rejected"))
