"""The manifest tree against hashlib and a plain tree."""

import hashlib
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import merkle, sha
from marketlake.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos int, `key` string, kids string, n string"


def _write(spark, path, rows):
    spark.createDataFrame([(d, t, lang, s, n, 1, "k", "k", "n") for d, s, lang, n, t in rows], SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_resumed_states_equal_whole_hashes():
    rng = np.random.default_rng(1)
    blocks = rng.integers(0, 256, (7, 5, 64)).astype(np.uint8)
    states = np.tile(sha.START, (7, 1))
    for i in range(5):
        got = sha.closed(states, np.full(7, i))
        assert [g.tobytes().decode() for g in got] == [hashlib.sha256(b[:i].tobytes()).hexdigest() for b in blocks]
        states = sha.resume(states, blocks[:, i])


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16}, {None: 17, "a": 1}, {"b": 300, "é": 2, "a": 33, "": 16, None: 1, "z": 257},
                                   {f"s{i}": 1 + i % 3 for i in range(40)}])
def test_tree(spark, tmp_path, sizes):
    rng = random.Random(2)
    ids = iter(rng.sample(range(-500, 5000), sum(sizes.values())))
    rows = [(next(ids), s, rng.choice(["en", None]), i, rng.choice(["Ab É", "lower", "", None])) for s, n in sizes.items() for i in range(n)]
    got = QUERIES["op11_merkle"](spark, _write(spark, tmp_path, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.merkle(rows))
    changed = {r[0] for r in rows if brute.fold(r[0], 5) == 0 and r[4] == "Ab É"}
    assert {r["doc_id"] for r in got if not r["verified"]} == changed


def test_nulls_ties_and_repeated_rows(spark, tmp_path):
    rows = [(5, "a", "en", 1, "X")] * 40 + [(5, "a", "en", 2, "Y")] * 3 + [(None, "a", None, None, None)] * 3 + [(None, None, None, None, "T" * 300_000)]
    got = QUERIES["op11_merkle"](spark, _write(spark, tmp_path, rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute.merkle(rows)))


def test_a_replacement_gives_the_root_of_the_changed_table(spark):
    rows = [(f"s{i % 3}", i, brute.sha(str(i)), None) for i in range(400)]
    schema = "source string, id long, leaf string, alt string"
    other = brute.sha("other")
    frame = spark.createDataFrame(rows, schema)
    changed = frame.withColumn("leaf", F.when(F.col("id") == 200, other).otherwise(F.col("leaf")))
    folded = merkle.fold(merkle.build_manifest(frame.withColumn("alt", F.when(F.col("id") == 200, other)))).where("id = 200").head()
    assert folded["folded_root"] == merkle.build_manifest(changed).root
