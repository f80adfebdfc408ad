"""Quality model: held-out accuracy, folds, lookup tables and odd rows."""

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from stocktrail.llm import quality_gam as q
from stocktrail.llm.common import held_out
from stocktrail.llm.queries import QUERIES

LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    return {r["doc_id"]: r for r in QUERIES["op10_quality"](spark, LARGER).collect()}


def test_held_out_accuracy(scored):
    labels = pq.read_table(f"{LARGER}/labels.parquet").to_pylist()
    held = [r for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    right = [scored[r["doc_id"]]["predicted"] == r["quality"] for r in held]
    assert len(held) > 50 and sum(right) / len(right) >= 0.97


def test_every_row_with_its_fold(scored):
    assert len(scored) == 1000
    for doc_id, r in scored.items():
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_held_out_labels_change_nothing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    other = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - quality else quality end as quality")
    a, b = q.train(docs, labels), q.train(docs, other)
    assert a.base == b.base and all(np.array_equal(x, y) for x, y in zip(a.tables, b.tables, strict=True))


def test_interaction_is_learnt():
    rng = np.random.default_rng(0)
    x = np.zeros((4000, len(q.FEATURES)))
    x[:, :3] = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = q.fit(x, y)
    assert (0, 1) in [(i, j) for i, j, _ in model.pairs]
    assert ((model.scores(x) > 0.5) == y).mean() > 0.9


def test_scores_add_table_entries():
    rng = np.random.default_rng(1)
    x = rng.random((500, len(q.FEATURES)))
    model = q.fit(x, (x[:, 2] > 0.3).astype(float))
    for row, got in zip(x[:20], model.scores(x[:20]), strict=True):
        bins = [int(np.sum(e <= v)) for e, v in zip(model.edges, row, strict=True)]
        total = model.base + sum(t[b] for t, b in zip(model.tables, bins, strict=True))
        total += sum(t[bins[i], bins[j]] for i, j, t in model.pairs)
        assert abs(1 / (1 + np.exp(-total)) - got) < 1e-12


def test_few_or_no_labels(spark, odd_rows):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert q.train(odd_rows, none).scores(np.zeros((1, len(q.FEATURES)))).tolist() == [1.0]
    one = spark.createDataFrame([(1, 1), (None, 0), (3, None), (4, 7)], "doc_id bigint, quality int")
    model = q.train(odd_rows, one)
    rows = q.score(odd_rows.withColumnRenamed("extra", "score"), "text", model).collect()
    assert len(rows) == 7 and len({r["score"] for r in rows}) == 1
    assert q.score(odd_rows.limit(0), "text", model).count() == 0
    assert odd_rows.where(held_out(odd_rows.doc_id) & odd_rows.doc_id.isNull()).count() == 0


def test_sample_bound(spark, odd_rows):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 1), (4, 0)], "doc_id bigint, quality int")
    assert q.train(odd_rows, labels, sample=1).tables == []  # one row is one label only
