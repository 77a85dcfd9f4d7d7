"""The prefix trie against a plain one."""

import random

import brute
import pytest

from marketlake.llm import prefixes
from marketlake.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, conv string, depth int, weight string, `a` int, ends string"


def _nodes(spark, path, rows):
    spark.createDataFrame([(*r, "c", 1, "w", 2, "e") for r in rows], SCHEMA).repartition(3).write.parquet(f"{path}/conversations.parquet")
    return sorted(map(str, map(tuple, QUERIES["op12_prefixes"](spark, str(path)).collect())))


def _conversations(seed, ids, longest=7, texts=3):
    rng = random.Random(seed)
    return [(c, t, rng.choice("ua"), "é" * rng.randrange(texts) + "x") for c in ids for t in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("ids", [range(150), [*range(-130, 40), 10**12, 10**12 + 1, 999], [700], [5, 7]])
def test_trie(spark, tmp_path, ids):
    rows = _conversations(3, ids)
    assert _nodes(spark, tmp_path, rows) == sorted(map(str, brute.trie(rows)))


def test_blocks_and_pieces(spark, tmp_path, monkeypatch):
    """Long conversations and long end lists, cut into many blocks and pieces."""
    monkeypatch.setattr(prefixes, "BLOCK", 5)
    monkeypatch.setattr(prefixes, "CHUNK", 3)
    same = [(c, t, "u", f"turn {t}") for c in range(200, 330) for t in range(8)]
    rows = same + [(200 + 1000 * i, t, "u", f"turn {t}") for i in range(1, 4) for t in range(60 + i)] + _conversations(4, range(20), 30, 2)
    assert _nodes(spark, tmp_path, rows) == sorted(map(str, brute.trie(rows)))


def test_nulls_ties_repeated_rows_and_turnless(spark, tmp_path):
    rows = [(None, 1, "u", "x"), (100, None, "u", None), (100, 0, None, "a"), (100, 0, None, "a"), (100, 0, "a", ""), (100, 1, "", "é" * 90_000)]
    rows += [(c, None, None, None) for c in range(301, 320)] + [(c, 3, "u", "b") for c in range(100, 110) for _ in range(3)]
    want = sorted(map(str, brute.trie(rows)))
    assert _nodes(spark, tmp_path, rows) == want
    root = next(n for n in brute.trie(rows) if n[1] == 0)
    assert root[7] != brute.sha("")  # some conversations have no turns left
