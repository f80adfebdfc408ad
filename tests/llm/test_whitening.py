"""Whitening against an eigenvalue decomposition of the exact covariance."""

import math
from decimal import Decimal

import numpy as np
import pyarrow.parquet as pq
import pytest
from stocktrail.llm import whitening
from stocktrail.llm.queries import QUERIES


def check(got, vectors, components=8):
    """``vectors`` by id, only usable ones."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors.values()], object)
    n, sums = len(x), x.sum(axis=0)
    far = dict(zip(vectors, ((n * x - sums) ** 2).sum(axis=1)))
    centred = ((n * x - sums) / n).astype(float)
    values, right = np.linalg.eigh(centred.T @ centred / n)
    values, right = values[::-1], right[:, ::-1].T
    some = min(components, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == n * some
    want = centred @ right[:some].T / np.sqrt(values[:some])
    at = {v: i for i, v in enumerate(vectors)}
    made = np.zeros((n, some))
    for r in got:
        assert r["n"] == n and r["deviation"] == far[r["vec_id"]]
        k = r["component"] - 1
        assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-6) and r["identity_error"] < 1e-9
        made[at[r["vec_id"]], k] = r["whitened"]
    made *= np.sign((made * want).sum(axis=0))
    assert np.abs(made - want).max() < 1e-7


def test_query(spark, folder):
    rows = pq.read_table(f"{folder}/embeddings.parquet").to_pylist()
    got = QUERIES["op13_whitening"](spark, folder).collect()
    check(got, {r["vec_id"]: r["embedding"] for r in rows})


def test_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 4)) * [100, 1, 0.01, 5]
    whole = np.floor(base * 1024) / 1024
    rows = np.column_stack([whole, whole[:, 0] + whole[:, 1], np.full(300, 7.0), whole[:, 3], whole[:, 2] * 2])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id int, embedding array<double>")
    got = whitening.whiten(df.repartition(5)).collect()
    assert {r["component"] for r in got} == {1, 2, 3, 4}
    check(got, dict(enumerate(rows.tolist())))


def test_badly_scaled_dimensions(spark):
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(500, 6)) * [1e6, 1e4, 1e2, 1, 0.1, 0.01]
    rows[:, 1] += rows[:, 0]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id int, embedding array<double>")
    got = whitening.whiten(df, components=3).collect()
    check(got, dict(enumerate(rows.tolist())), 3)


def test_rows_left_out_ties_and_empty(spark):
    bad = [None, [1.0, None, 2.0], [float("nan")] * 3, [float("inf"), 0.0, 0.0], [1.0], [], [1e30, 0.0, 0.0]]
    good = [[float(i % 3), float(i * i % 7), 1.0 * i] for i in range(20)]
    rows = [(i, v, "x") for i, v in enumerate(good)] + [(100 + i, v, "y") for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, component string")
    check(whitening.whiten(df).collect(), dict(enumerate(good)))
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.where("vec_id >= 100")).collect() == []
    same = spark.createDataFrame([(None, [1.0, 2.0])] * 4, "vec_id int, embedding array<float>")
    assert whitening.whiten(same).collect() == []
    twice = same.unionByName(spark.createDataFrame([(1, [3.0, 2.0])], "vec_id int, embedding array<float>"))
    got = whitening.whiten(twice).collect()
    assert len(got) == 5 and sum(r["vec_id"] is None for r in got) == 4


def test_deviation_beyond_long():
    x = np.array([[10**15, 3], [-(10**15), 5]])
    sums = x.sum(axis=0)
    n = 10**6
    want = [Decimal((n * 10**15) ** 2 + (n * 3 - 8) ** 2)]
    assert whitening.squares(x[:1], n, sums)[0] in (None, *want)
    assert whitening.squares(np.array([[10**9, 3]]), 1000, np.array([0, 0])) == [Decimal(10**24 + 9 * 10**6)]
    assert whitening.squares(np.array([[10, 3]]), 2, np.array([1, 1])) == [Decimal(19**2 + 5**2)]


@pytest.mark.parametrize("d", [1, 5])
def test_independent_columns(d):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(50, d))
    both = np.column_stack([a, a.sum(axis=1)])
    assert len(whitening.independent(both.T @ both)) == d
