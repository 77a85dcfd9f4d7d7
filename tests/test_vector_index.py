"""The stored index: recall against brute force, runs, replaced entries, folders that are not read."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_similarity import brute, clustered

from marketlake.operators import vector_index
from marketlake.sources.bronze import child_folders

SCHEMA = "id string, embedding array<double>, coin_id string"


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    spread = pd.DataFrame({"id": [f"w{i}" for i in range(600)], "embedding": rng.normal(size=(600, 6)).tolist(),
                           "coin_id": [f"c{i % 7}" for i in range(600)]})
    pdf = pd.concat([clustered(900, 6, 3), spread], ignore_index=True)
    return pdf, spark.createDataFrame(pdf, SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, data, tmp_path_factory):
    """Built from two thirds, the rest added, and every tenth row written again."""
    _, df = data
    path = str(tmp_path_factory.mktemp("index") / "i")
    number = F.substring("id", 2, 9).cast("int")
    vector_index.build_index(df.where(number % 3 > 0), path, cells=48)
    assert vector_index.add_run(df.where((number % 3 == 0) | (number % 10 == 0)), path) == 2
    return path


@pytest.mark.parametrize("options,size", [({}, 8192), ({"exclude_same_coin": True}, 8192), ({"exclude_self": True}, 40)])
def test_recall(spark, data, folder, options, size):
    pdf, df = data
    want = {(q, m): s for q, m, _, s in brute(pdf, pdf, 5, options.get("exclude_same_coin", False), options.get("exclude_self", False))}
    found = vector_index.search_index(df, folder, 5, size=size, **options).collect()
    assert len({(r["query_id"], r["match_id"]) for r in found}) == len(found)
    got = {(r["query_id"], r["match_id"]): r["similarity"] for r in found}
    assert len(got.keys() & want.keys()) / len(want) >= 0.9
    for pair in got.keys() & want.keys():
        assert got[pair] == pytest.approx(want[pair], abs=1e-8)
    per_query = pd.Series([r["query_id"] for r in found]).value_counts()
    assert len(per_query) == len(pdf) and set(per_query) == {5}


def test_runs_replace_and_keep(spark, data, folder):
    rows = vector_index.entries(spark, folder)
    assert rows.count() == rows.select("id").distinct().count() == len(data[0])
    assert rows.where(F.substring("id", 2, 9).cast("int") % 10 == 0).select("run").distinct().collect() == [(2,)]


def test_a_changed_vector_is_found_at_its_new_place(spark, tmp_path):
    path = str(tmp_path / "i")
    first = spark.createDataFrame([(f"v{i}", [float(np.cos(i)), float(np.sin(i))], "c") for i in range(40)], SCHEMA)
    vector_index.build_index(first, path)
    moved = spark.createDataFrame([("v3", [1.0, 0.001], "c"), ("n", [0.0, 1.0], "c")], SCHEMA)
    # adding the same run twice more changes nothing
    for run in (2, 3, 4):
        assert vector_index.add_run(moved, path) == run
    asked = spark.createDataFrame([("q", [1.0, 0.0011], "c"), ("old", [float(np.cos(3)), float(np.sin(3))], "c")], SCHEMA)
    best = {r["query_id"]: r["match_id"] for r in vector_index.search_index(asked, path, 1, probe=3).collect()}
    assert best["q"] == "v3" and best["old"] != "v3" and vector_index.entries(spark, path).count() == 41
    vector_index.compact(spark, path, str(tmp_path / "j"))
    again = vector_index.search_index(asked, str(tmp_path / "j"), 1, probe=3).collect()
    assert {r["query_id"]: r["match_id"] for r in again} == best
    assert child_folders(spark, f"{tmp_path}/j/entries") == ["run=1"]


def test_other_cells_are_not_read(spark, data, folder):
    plan = vector_index.search_index(data[1].limit(1), folder, 1, probe=1, refine=1)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "code#" in line]
    assert scans and all("cells#" in line.split("PartitionFilters: ")[1].split("]")[0] for line in scans)
    # the codes are read without the vectors
    assert all("embedding" not in line.split("ReadSchema")[1] for line in scans)


def test_errors(spark, data, folder):
    with pytest.raises(FileExistsError):
        vector_index.build_index(data[1], folder)
    with pytest.raises(ValueError):
        vector_index.build_index(data[1].where("id = 'absent'"), f"{folder}-none")
    assert vector_index.search_index(data[1].where("id = 'absent'"), folder, 3).count() == 0
