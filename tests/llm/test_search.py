"""Top-k search against SQL and brute force."""

import random

import duckdb
import pytest

from stocktrail.llm import hamming_search as hs
from stocktrail.llm.check_sql import SQL
from stocktrail.llm.queries import QUERIES
from pyspark.sql import functions as F


def signed(code, bits):
    return [w - (1 << 64) if w >> 63 else w for w in ((code >> at) & ((1 << 64) - 1) for at in range(0, bits, 64))]


@pytest.mark.parametrize("shell", [0, 1000])
@pytest.mark.parametrize("bits,k", [(64, 3), (100, 5), (7, 4)])
def test_against_brute_force(spark, monkeypatch, bits, k, shell):
    monkeypatch.setattr(hs, "SHELL", shell)
    rng = random.Random(bits)
    codes = [rng.getrandbits(bits) for _ in range(40)]
    rows = [(i, rng.choice(codes) ^ (1 << rng.randrange(bits) if rng.random() < 0.5 else 0)) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(10)] + [(7, rows[7][1]), (None, rows[3][1])]
    base = spark.createDataFrame([(i, signed(c, bits)) for i, c in rows] + [(999, None)], "vec_id int, code array<bigint>")
    asked = rows[:6] + [(500, rng.getrandbits(bits))]
    queries = spark.createDataFrame([(i, signed(c, bits)) for i, c in asked] + [(501, None)], "query_id int, code array<bigint>")
    got = {}
    for r in hs.top_k(base, queries, k, bits).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["distance"], r["vec_id"]))
    for qid, code in asked:
        near = sorted(((code ^ c).bit_count(), i is None, i or 0) for i, c in rows)[:k]
        assert got[qid] == [(d, None if gone else i) for d, gone, i in near]
    assert 501 not in got


def test_fewer_rows_than_k_and_none(spark):
    base = spark.createDataFrame([(1, [5]), (2, [0])], "vec_id int, code array<bigint>")
    queries = base.withColumnRenamed("vec_id", "query_id")
    assert hs.top_k(base, queries, 10, 8).count() == 4
    assert hs.top_k(base.limit(0), queries, 10, 8).count() == 0
    assert hs.top_k(base, queries.limit(0), 10, 8).count() == 0


def test_sign_code(spark):
    rows = [([0.5, -1.0, None, float("nan")] + [1.0] * 66,), ([1.0],), (None,)]
    got = [r["c"] for r in spark.createDataFrame(rows, "v array<double>").select(hs.sign_code(F.col("v"), 70).alias("c")).collect()]
    assert got[0] == signed(sum(1 << i for i in (0, 3, *range(4, 70))), 70) and got[1:] == [None, None]


def test_query_against_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet'")
    want = con.sql(SQL["op1_topk_search"])
    got = [tuple(r) for r in QUERIES["op1_topk_search"](spark, folder).select(*want.columns).collect()]
    assert sorted(got) == sorted(want.fetchall())


@pytest.mark.parametrize("more", [{0: 65}, {0: 65, 3: 63, 100: 0}])
def test_vectors_of_other_sizes_against_sql(spark, tmp_path, more):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(more.get(i, 64))]) for i in range(180)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.sql(SQL["op1_topk_search"])
    got = [tuple(r) for r in QUERIES["op1_topk_search"](spark, str(tmp_path)).select(*want.columns).collect()]
    assert sorted(got) == sorted(want.fetchall()) and len(got) == 40


def test_same_query_id_beyond_the_common_entries(spark):
    schema = "id int, v array<int>"
    base = spark.createDataFrame([(1, [1]), (2, [1, 1]), (3, [1, -1]), (4, None)], schema)
    asked = spark.createDataFrame([(9, [1, 1]), (9, [1, -1]), (8, None)], schema)
    got = [tuple(r) for r in hs.top_k_signs(base, asked, 2, "id", "id", "v").collect()]
    assert sorted(got) == [(9, 1, 1, 0), (9, 1, 1, 0), (9, 2, 2, 0), (9, 2, 3, 0)]
