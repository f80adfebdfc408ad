"""Importance resampling against SQL and a plain version."""

import math
import random
from hashlib import sha256
from zlib import crc32

import duckdb
import pytest
from stocktrail.llm import importance_sample as sample
from stocktrail.llm.check_sql import SQL
from stocktrail.llm.queries import QUERIES
from tests_llm_helpers import words


def slow(docs, items, longest=1, buckets=10_000, share=(10, 100), min_words=20):
    def places(text):
        w = words(text)
        joined = [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
        return [crc32(x.encode()) % buckets for x in joined]

    found, target = [places(t) for _, t in docs], [b for _, t in items for b in places(t)]
    s, t = [0] * buckets, [0] * buckets
    for b in (b for f in found for b in f):
        s[b] += 1
    for b in target:
        t[b] += 1
    gain = [math.floor(1000 * math.log((y + 1.0) * (sum(s) + buckets) / ((x + 1.0) * (len(target) + buckets)))) for x, y in zip(s, t)]
    rows = []
    for (doc, text), f in zip(docs, found, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(words(text)), len(f), weight, score, None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, *r[1:4]))
    for k, row in enumerate(able[: len(able) * share[0] // share[1]]):
        row[5] = k + 1
    return sorted(map(tuple, rows), key=str)


def test_query_against_sql(spark, folder):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    want = con.sql(SQL["op12_importance_sample"])
    got = [tuple(r) for r in QUERIES["op12_importance_sample"](spark, folder).select(*want.columns).collect()]
    assert sorted(got) == sorted(want.fetchall())


@pytest.mark.parametrize("longest,buckets,share", [(1, 10_000, (10, 100)), (3, 64, (1, 3))])
def test_against_plain_version(spark, longest, buckets, share):
    rng = random.Random(longest)
    text = lambda n: " ".join(rng.choice(["Alpha", "beta", "ÉTÉ", "x9", "--", "中文", "z"]) for _ in range(n))
    docs = [(i, text(rng.randrange(0, 60))) for i in range(150)] + [(None, text(40)), (7, None), (8, ""), (9, "y" * 200_000)]
    docs += [docs[3]] * 5 + [(None, docs[3][1])] * 4 + [(11, text(30_000))]
    items = [(0, text(50)), (1, None), (2, "")]
    df = spark.createDataFrame([(*d, "rank") for d in docs], "doc_id bigint, text string, score string")
    target = spark.createDataFrame(items, "item_id int, text string")
    got = sample.resample(df, target, longest=longest, buckets=buckets, share=share).collect()
    assert sorted(map(tuple, got), key=str) == slow(docs, items, longest, buckets, share)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    some = spark.createDataFrame([(i, "a b c " * 9) for i in range(20)], "doc_id bigint, text string")
    assert sample.resample(none, some).collect() == []
    assert sample.resample(some, none).where("rank is not null").count() == 2
    assert sample.resample(some, some, min_words=100).where("rank is not null").count() == 0


@pytest.mark.parametrize("k", [1, 2, 499, 500, 777, 4000])
def test_cutoff_whatever_the_sketch_says(spark, monkeypatch, k):
    """A sketch of two ranks only gives wrong brackets, which are widened."""
    monkeypatch.setattr(sample, "ACCURACY", 2)
    rng = random.Random(k)
    rows = [(i, rng.choice([0, 0, 0, 5, rng.randrange(-9999, 9999)])) for i in range(4000)]
    got = sample.cutoff(spark.createDataFrame(rows, "id int, score bigint"), "score", "id", k)
    assert (got["id"], got["score"]) == sorted(rows, key=lambda r: (-r[1], r[0]))[k - 1]
