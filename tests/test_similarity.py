"""Exact search against brute force, hot cells and coins, approximate recall."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlake.operators import similarity


def unit(m):
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def brute(q, p, k, other_coin=False, other_id=False):
    sims = np.round(unit(np.stack(q["embedding"])) @ unit(np.stack(p["embedding"])).T, similarity.DIGITS)
    out = []
    for i, (qid, coin) in enumerate(zip(q["id"], q["coin_id"])):
        rows = [
            (-s, pid) for s, pid, pc in zip(sims[i], p["id"], p["coin_id"])
            if not (other_coin and pc == coin) and not (other_id and pid == qid)
        ]
        out += [(qid, pid, n + 1, -s) for n, (s, pid) in enumerate(sorted(rows)[:k])]
    return sorted(out)


def clustered(n, dims, seed, hot=0.4):
    """Low-dimensional clusters, one of them holding a large share; one coin too; copies and a zero vector."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, dims))
    at = np.where(rng.random(n) < hot, 0, rng.integers(0, 12, n))
    m = centers[at] + rng.normal(scale=0.1, size=(n, dims))
    m[5] = m[6] = m[7]
    m[8] = 0.0
    coin = np.where(rng.random(n) < hot, "c0", np.char.add("c", rng.integers(1, 20, n).astype(str)))
    return pd.DataFrame({"id": [f"v{i}" for i in range(n)], "embedding": m.tolist(), "coin_id": coin})


@pytest.fixture(scope="module")
def data(spark):
    pdf = clustered(900, 6, 3)
    return pdf, spark.createDataFrame(pdf, "id string, embedding array<double>, coin_id string")


def rows(df):
    return sorted((r["query_id"], r["match_id"], r["rank"], r["similarity"]) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"exclude_same_coin": True}, {"exclude_self": True}])
@pytest.mark.parametrize("ship", [True, False])
def test_exact_search(data, options, ship, monkeypatch):
    monkeypatch.setattr(similarity, "SHIPPED", 400)  # several blocks
    pdf, df = data
    got = rows(similarity.similar_patterns(df, df, 4, ship=ship, chunk=64, **options))
    want = brute(pdf, pdf, 4, options.get("exclude_same_coin", False), options.get("exclude_self", False))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    np.testing.assert_allclose([g[3] for g in got], [w[3] for w in want], atol=1e-8)


@pytest.mark.parametrize("chunk", [16, 300])
def test_exact_search_of_crowded_cells(spark, chunk):
    """Copies of one vector, opposite vectors and queries that are no patterns."""
    rng = np.random.default_rng(8)
    m = np.concatenate([np.ones((120, 4)), -np.ones((30, 4)), rng.normal(size=(150, 4)), np.zeros((3, 4))])
    pdf = pd.DataFrame({"id": [f"v{i}" for i in range(len(m))], "embedding": m.tolist(), "coin_id": [f"c{i % 3}" for i in range(len(m))]})
    ask = pd.DataFrame({"id": [f"q{i}" for i in range(40)], "embedding": rng.normal(size=(40, 4)).tolist(), "coin_id": "c1"})
    ask.at[0, "embedding"] = [0.0] * 4
    schema = "id string, embedding array<double>, coin_id string"
    for q in (pdf, ask):
        got = rows(similarity.similar_patterns(spark.createDataFrame(q, schema), spark.createDataFrame(pdf, schema), 6, exclude_same_coin=True, chunk=chunk))
        assert [g[:3] for g in got] == [w[:3] for w in brute(q, pdf, 6, other_coin=True)]


def test_copies_of_a_query_grow_less_than_the_chunks(spark):
    seen = {}
    for n in (900, 3600):
        pdf = clustered(n, 4, 3)
        df = spark.createDataFrame(pdf, "id string, embedding array<double>, coin_id string")
        asked, first, placed, _ = similarity._routed(df, df, 4, False, False, None, 32)
        seen[n] = asked.count() / n, placed.select("cell", "ring", "slice").distinct().count()
        assert first.groupBy("query_id").count().agg(F.max("count")).first()[0] <= 4
    assert seen[3600][1] > 2.5 * seen[900][1]
    assert seen[3600][0] < 0.5 * seen[3600][1] and seen[3600][0] / seen[900][0] < 0.75 * seen[3600][1] / seen[900][1]


def test_fewer_patterns_than_k(data, spark):
    pdf, df = data
    few = df.where("id in ('v1', 'v2')")
    assert similarity.similar_patterns(df, few, 5).groupBy("query_id").count().agg(F.max("count")).first()[0] == 2
    none = df.where("id = 'absent'")
    assert similarity.similar_patterns(df, none, 5).count() == 0
    assert similarity.similar_patterns(df, none, 5, ship=True).count() == 0
    assert similarity.similar_patterns(none, df, 5, ship=True).count() == 0


def test_approximate_recall(data):
    pdf, df = data
    want = {(q, m) for q, m, _, _ in brute(pdf, pdf, 5)}
    found = similarity.similar_patterns(df, df, 5, probe=3, chunk=64)
    got = {(r["query_id"], r["match_id"]) for r in found.collect()}
    assert len(got & want) / len(want) > 0.85


def test_approximate_always_finds_k(data):
    """Cells too small for k are not the end of the search."""
    pdf, df = data
    few = df.where("cast(substring(id, 2) as int) < 300")
    found = similarity.similar_patterns(few, few, 20, exclude_same_coin=True, probe=1, chunk=16)
    assert found.groupBy("query_id").count().where("count < 20").count() == 0


def test_query_copies_come_in_slices(data, monkeypatch):
    pdf, _ = data
    pivots = unit(np.stack(pdf["embedding"][100:130]))
    placed = pd.concat(similarity._nearest(iter([pdf]), pivots, np.arange(30)))
    table = placed.groupby(["cell", "bin"]).agg(n=("id", "size"), low=("gap", "min"), high=("gap", "max")).reset_index()
    table = similarity._merged(table.assign(rows=table["n"]), 10**6)
    assert set(table["ring"]) == {0} and set(table["slices"]) == {1}
    rings = similarity._Rings(pivots, table.assign(slices=3))
    asking = placed.assign(ring=0, met=1, bound=np.inf)
    whole = pd.concat(rings.route(iter([asking]), 4, None))
    monkeypatch.setattr(similarity, "COPIES", 700)
    parts = list(rings.route(iter([asking]), 4, None))
    assert max(map(len, parts)) <= 700
    key = ["id", "cell", "slice"]
    pd.testing.assert_frame_equal(pd.concat(parts)[key].reset_index(drop=True), whole[key].reset_index(drop=True))
    assert not whole.duplicated(key).any() and set(whole["slice"]) == {0, 1, 2}
    # the slice of the first round is not met again
    home = whole.merge(placed[["id", "cell"]], on=["id", "cell"])
    assert set(home["slice"]) == {0, 2}


def test_cosine_expression(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([1.0, 0.0], [0.0, 0.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(similarity.cosine(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([0.96, 0.0])


def test_vectors_store_and_errors(spark):
    fields = {c: 1.0 for c in [*similarity.FEATURES, *similarity.META]}
    snapshots = pd.DataFrame([
        {**fields, "coin_id": c, "symbol": c, "name": c, "date": "2024-01-01", "signal": s, "rsi_14": r, "confidence": 50}
        for c, s, r in (("a", "bullish", 10.0), ("b", "bearish", 20.0), ("c", "neutral", 40.0))
    ]).drop(columns=["signal_code", "macd_histogram_percent"])
    df = similarity.pattern_vectors(spark.createDataFrame(snapshots))
    m = np.stack([r["embedding"] for r in df.orderBy("id").collect()])
    # 1 for all other fields: 100 percent and a daily return of 1 are cut at 4
    want = unit(np.array([[(r - 50) / 15, 4, 0.1, 1 / 15, 0.5 / 0.3, 0, 1 / 3, s, 4] for r, s in ((10, 1), (20, -1), (40, 0))]))
    np.testing.assert_allclose(m, want, atol=1e-12)
    # the same state has the same vector in any other run
    alone = similarity.pattern_vectors(spark.createDataFrame(snapshots[:1])).first()["embedding"]
    np.testing.assert_allclose(alone, m[0], atol=1e-12)

    stored = df.withColumn("document", F.lit("old"))
    again = df.where("coin_id = 'a'").withColumn("price_usd", F.lit(9.0))
    merged = {r["id"]: r for r in similarity.store(stored, again, F.lit("new")).collect()}
    assert len(merged) == 3 and merged["a_2024-01-01"]["document"] == "new"
    assert merged["a_2024-01-01"]["price_usd"] == 9.0 and merged["b_2024-01-01"]["document"] == "old"

    broken = df.withColumn("embedding", F.when(F.col("coin_id") == "b", F.array(F.lit(float("nan")))).otherwise(F.col("embedding")))
    errors = {r["coin_id"]: r["error"] for r in similarity.split_storable(broken).collect()}
    assert errors == {"a": None, "b": "vector has missing values", "c": None}
