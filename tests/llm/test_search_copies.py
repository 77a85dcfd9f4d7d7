"""Repeated query rows inside a group of more than k equal vectors."""

import pytest
from pyspark.sql import functions as F

from marketlake.llm import vafile


@pytest.mark.parametrize("times", [2, 7])
def test_repeats_of_a_query_hide_no_copy(spark, times):
    rows = [(50, [.5, .5])] * times + [(i, [.5, .5]) for i in range(51, 60)] + [(70, [.25, .5]), (100, [.5, .25])] + [(53, [.5, .5])] * 6
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    score = lambda a, b: sum(int(x * 256) * int(y * 256) for x, y in zip(a, b))
    want = []
    for q in (50, 100):
        own = next(v for i, v in rows if i == q)
        best = sorted((-score(own, v), i) for i, v in rows if i != q)[:5]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    got = vafile.top_k(df, F.col("id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_the_last_copy_is_found(spark):
    df = spark.createDataFrame([(i, [.5, .5]) for i in (50, 50, 51, 52, 53, 54, 55)], "vec_id long, embedding array<float>")
    got = vafile.top_k(df, F.col("id") % 50 == 0).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [51, 52, 53, 54, 55]
