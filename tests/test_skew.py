"""Hot keys: the split plans give the same rows as the plain ones and as plain Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stocktrail.operators import skew
from stocktrail.operators.allocate import allocate_layers
from stocktrail.operators.skew import hot_groups, left_join
from stocktrail.operators.windows import fill_gaps, fill_within_group, number_rows

LIMIT = 20


def rows_of(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def skewed(n, seed, copies=0):
    """Rows in which key 1 holds most rows, and one row is repeated ``copies`` times."""
    rng = random.Random(seed)
    out = [(1 if rng.random() < 0.6 else rng.randint(2, 9), i, rng.choice([None, 0, 1, 2, 5])) for i in range(n)]
    return out + [(1, -5, 3)] * copies


@pytest.fixture
def block_sizes(monkeypatch):
    seen = []
    real = skew.materialize

    def spy(df):
        out = real(df)
        if skew.BLOCK in out.columns:
            seen.append([r["count"] for r in out.groupBy(skew.BLOCK).count().collect()])
        return out

    monkeypatch.setattr(skew, "materialize", spy)
    return seen


def test_blocks_split_a_group(spark, block_sizes):
    """One key with most rows, and one row repeated, spread over blocks of similar size."""
    data = skewed(300, 1, 150)
    df = spark.createDataFrame(data, "k int, o int, q int").repartition(5)
    assert fill_gaps(df, ["k"], ["o"], ["q"], limit=LIMIT).count() == len(data)
    assert max(block_sizes[0]) < 0.4 * sum(block_sizes[0])


@pytest.mark.parametrize("backward", [False, True])
def test_tied_order_gives_equal_rows_at_every_limit(spark, backward):
    rng = random.Random(8)
    data = [(rng.choice([1, 1, 1, None]), rng.randrange(2), rng.choice([None, None, 1, 2, 3]), i % 5) for i in range(60)]
    df = spark.createDataFrame(data, "k int, o int, v int, w int")
    got = [rows_of(fill_gaps(df.repartition(n), ["k"], ["o"], ["v"], backward, limit), "k", "o", "v", "w") for n, limit in ((1, 1), (4, 3), (5, 1000))]
    assert got[0] == got[1] == got[2]


def test_known_bound_saves_the_count(spark):
    df = spark.createDataFrame([(1,)] * 21, "k int")
    assert hot_groups(df, ["k"], LIMIT, most=LIMIT) is None
    assert hot_groups(df, ["k"], LIMIT, most=1000).count() == 1


def test_scatter_reads_the_named_columns_only(spark, tmp_path):
    rows = [(None if i % 2 else i, i, i, "x", "y") for i in range(100)]
    spark.createDataFrame(rows, "a int, i int, v int, w string, z string").write.parquet(str(tmp_path / "t"))
    left = spark.read.parquet(str(tmp_path / "t"))
    right = spark.createDataFrame([(1, 7)], "b int, r int")
    first = left_join(left, right, [("a", "b")], most=1, by=["i"], keep_spread=True)
    second = left_join(first, right.withColumnsRenamed({"b": "c", "r": "s"}), [("a", "c")], most=1, by=["i"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = second.select("i", "v", "r", "s")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "ReadSchema: struct<a:int,i:int,v:int>" in plan
    assert plan.count("Exchange hashpartitioning(a#") == 1, plan  # the second join needs no new shuffle of the left side


@pytest.mark.parametrize("parts", [1, 7, None])
def test_number_rows(spark, parts):
    values = list(range(500)) + [7] * 100
    random.Random(2).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(6)
    got = number_rows(df, [F.col("v").desc_nulls_last()], "n", parts)
    pairs = sorted((r["n"], r["v"]) for r in got.collect())
    assert [n for n, _ in pairs] == list(range(1, 601))
    assert [v for _, v in pairs] == sorted(values, reverse=True)


def test_number_rows_with_distinct_order(spark):
    df = spark.range(1000).repartition(5).withColumn("w", F.col("id") % 3)
    got = number_rows(df, [F.col("w").desc(), F.col("id")], "n", distinct_order=True)
    rows = got.orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(1, 1001))
    assert [(r["w"], r["id"]) for r in rows] == sorted(((i % 3, i) for i in range(1000)), key=lambda p: (-p[0], p[1]))


def python_fill(data, backward):
    out, groups = [], defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    for k, rows in groups.items():
        rows.sort(key=lambda r: r[1])
        for i, (_, o, v) in enumerate(rows):
            known = [x[2] for x in rows[: i + 1] if x[2] is not None]
            later = [x[2] for x in rows[i:] if x[2] is not None]
            value = known[-1] if known else (later[0] if backward and later else None)
            out.append((k, o, value))
    return Counter(out)


@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("limit", [LIMIT, 10_000])
def test_fill_gaps(spark, backward, limit):
    rng = random.Random(3)
    data = [(1 if i < 200 else i % 7, i, rng.randint(1, 9) if rng.random() < 0.04 else None) for i in range(300)]
    df = spark.createDataFrame(data, "k int, o int, v int").repartition(5)
    got = fill_gaps(df, ["k"], ["o"], ["v"], backward, limit)
    assert rows_of(got, "k", "o", "v") == python_fill(data, backward)


def test_fill_within_group_fixture(spark):
    data = [
        ("X", 1, "OF", None),
        ("X", 2, "OF", "p"),
        ("X", 3, "OF", None),
        ("X", 4, "ST", None),
        (None, 5, "OF", "q"),
        (None, 6, "ST", "r"),
    ]
    df = spark.createDataFrame(data, "base string, o int, charge string, v string")
    for limit in (1, 100):
        got = fill_within_group(df, "base", ["o"], ["v"], F.col("charge") == "OF", limit)
        assert {r["o"]: r["v"] for r in got.collect()} == {1: "p", 2: "p", 3: "p", 4: None, 5: None, 6: "r"}


@pytest.mark.parametrize("limit", [LIMIT, 10_000])
def test_left_join_with_hot_right_key(spark, limit):
    rng = random.Random(4)
    left = [(rng.choice([1, 2, 3, 99, None]), i) for i in range(40)]
    right = [(1, i % 3) for i in range(200)] + [(2, 5), (3, 6), (3, 7), (None, 8)] + [(1, 42)] * 100
    got = left_join(
        spark.createDataFrame(left, "a int, i int"),
        spark.createDataFrame(right, "b int, v int").repartition(4),
        [("a", "b")],
        limit,
    )
    want = Counter()
    for a, i in left:
        hits = [v for b, v in right if a is not None and a == b] or [None]
        want.update((a, i, v) for v in hits)
    assert rows_of(got, "a", "i", "v") == want


def test_salting_spreads_exact_copies(spark):
    left = spark.createDataFrame([(1,)], "a int")
    right = spark.createDataFrame([(1, 7)] * 400, "b int, v int")
    plan = left_join(left, right, [("a", "b")], LIMIT)
    assert plan.count() == 400
    assert "_lsalt" in plan._jdf.queryExecution().optimizedPlan().toString()


def test_hot_groups_only_above_limit(spark):
    df = spark.createDataFrame([(1,)] * 21 + [(2,)] * 20, "k int")
    assert [tuple(r) for r in hot_groups(df, ["k"], LIMIT).collect()] == [(1, 21)]
    assert hot_groups(df, ["k"], 21) is None


def python_allocation(layers, stock, strict):
    """The walk over layers, newest first."""
    out, used, done = [], defaultdict(float), set()
    for item, o, q in sorted(layers, key=lambda r: -r[1]):
        if item not in stock or item in done:
            continue
        want = stock[item]
        if used[item] is not None and used[item] >= want:
            done.add(item)
            continue
        if q is None and not strict:
            q = 0.0
        if used[item] is None:
            take = q
        else:
            take = None if q is None else min(q, want - used[item])
        out.append((item, o, q, take))
        used[item] = None if used[item] is None or take is None else used[item] + take
    return Counter(out)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("limit", [6, 10_000])
@pytest.mark.parametrize("seed", range(4))
def test_allocation_equals_loop(spark, strict, limit, seed):
    rng = random.Random(seed)
    layers = [
        (1 if rng.random() < 0.5 else rng.randint(2, 8), i, rng.choice([0.0, 1.0, 4.0, 6.0, None if rng.random() < 0.2 else 2.0]))
        for i in range(120)
    ]
    stock = {k: float(rng.choice([-3, 0, 5, 17, 60, 100])) for k in range(1, 9)}
    if limit == 6:
        stock[1] = float([37, 90, 400, 5][seed])
    got = allocate_layers(
        spark.createDataFrame(layers, "item int, o int, q double").repartition(3),
        spark.createDataFrame(list(stock.items()), "item int, on_hand double"),
        item="item",
        qty="q",
        on_hand="on_hand",
        order=[F.col("o").desc()],
        null_qty="strict" if strict else "zero",
        limit=limit,
    )
    assert rows_of(got, "item", "o", "q", "taken") == python_allocation(layers, stock, strict)
    if not strict:
        totals = {r["item"]: r["t"] for r in got.groupBy("item").agg(F.sum("taken").alias("t")).collect()}
        for item, want in stock.items():
            offered = sum(q or 0 for k, _, q in layers if k == item)
            if want > 0 and item in totals:
                assert totals[item] == min(want, offered)


def test_null_keys_are_scattered(spark):
    """Left rows without a key go to many partitions and come back once each."""
    left = spark.createDataFrame([(None, i) for i in range(200)] + [(1, 500)], "a int, i int")
    right = spark.createDataFrame([(1, 7), (1, 8), (None, 9)], "b int, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = left_join(left, right, [("a", "b")])
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert rows_of(got, "a", "i", "v") == Counter([(None, i, None) for i in range(200)] + [(1, 500, 7), (1, 500, 8)])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(sizes) < 100
