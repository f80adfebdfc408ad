"""Column functions on hand-made values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocktrail import functions as fx
from stocktrail.operators.aggregates import distinct_sum, stage_counts, sum_by_key
from stocktrail.operators.collapse import collapse_repeated, split_by
from stocktrail.operators.links import assert_unique_key, lookup, snapshot_pick
from stocktrail.plans.receipts import inbound_filter


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_clean_number_text(spark):
    values = ["1,234.5", "", " ", "None", None, "NULL", "7"]
    assert column(spark, values, "string", fx.clean_number) == [1234.5, 0, 0, 0, 0, 0, 7]


def test_clean_number_keeps_or_fills_float_nan(spark):
    kept = column(spark, [float("nan"), 2.0], "double", fx.clean_number)
    assert kept[0] != kept[0] and kept[1] == 2.0
    assert column(spark, [float("nan"), 2.0], "double", lambda c: fx.clean_number(c, "fill")) == [0, 2]


def test_clean_number_pattern(spark):
    values = ["  ", "xNonex", "nan", "3,000", None]
    assert column(spark, values, "string", lambda c: fx.clean_number(c, "pattern")) == [0, 0, 0, 3000, 0]


def test_clean_number_bad_text(spark):
    assert column(spark, ["abc"], "string", lambda c: fx.clean_number(c, safe=True)) == [None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(spark, ["abc"], "string", fx.clean_number)


def test_date_plus_hhmm(spark):
    df = spark.sql("SELECT DATE '2024-03-01' AS d, 905 AS t UNION ALL SELECT DATE '2024-03-01', 7")
    got = sorted(r[0] for r in df.select(fx.date_plus_hhmm(F.col("d"), F.col("t"))).collect())
    assert got == [dt.datetime(2024, 3, 1, 0, 7), dt.datetime(2024, 3, 1, 9, 5)]


def test_age(spark):
    cutoff = dt.date(2025, 1, 1)
    days = [cutoff - dt.timedelta(days=n) for n in (0, 364, 365, 1825)] + [None]
    got = column(spark, days, "date", lambda c: fx.age_bucket(fx.age_years(c, F.lit(cutoff))))
    assert got == ["[0-1]", "[0-1]", "<1-2]", "<5-más]", "[0-1]"]


def test_net_layer_qty(spark):
    df = spark.createDataFrame([(5.0, 2.0), (5.0, 9.0), (5.0, None), (None, 1.0)], "q double, u double")
    q, u = F.col("q"), F.col("u")
    assert [r[0] for r in df.select(fx.net_layer_qty(q, u)).collect()] == [3, 0, 5, None]
    assert [r[0] for r in df.select(fx.net_layer_qty(q, u, "strict")).collect()] == [3, 0, None, None]


def test_three_valued_account_filter(spark):
    rows = [
        ("a", "59", None),
        ("b", "59", "42111090000"),
        ("c", "59", "999"),
        ("d", "20", None),
        ("e", None, "999"),
    ]
    df = spark.createDataFrame(rows, "id string, kind string, account string")
    flags = {k: F.lit(None).cast("string") for k in ("18", "20", "59")}
    keep = inbound_filter(
        F.col("kind"),
        F.lit(dt.date(2020, 1, 1)),
        F.lit(1),
        flags,
        F.lit("Ajuste"),
        F.lit(None).cast("string"),
        F.lit("A1"),
        F.col("account"),
        F.lit(dt.date(2020, 1, 1)),
    )
    assert sorted(r["id"] for r in df.filter(keep).collect()) == ["c", "d"]


def test_keep_not_in(spark):
    df = spark.createDataFrame([(None,), ("HERRAMIENTAS",), ("OTRA",)], "v string")
    got = df.filter(fx.keep_not_in(F.col("v"), ["HERRAMIENTAS"])).collect()
    assert {r["v"] for r in got} == {None, "OTRA"}


def test_states(spark):
    df = spark.createDataFrame([("y", 1.0), ("N", 0.0), (None, None), ("N", 2.0)], "c string, b double")
    assert [r[0] for r in df.select(fx.balance_status(F.col("c"), F.col("b"))).collect()] == ["C", "Ce", "A", "A"]
    made = df.select(fx.production_status(F.lit("R"), F.col("b"))).collect()
    assert [r[0] for r in made] == ["A", "Ce", "Ce", "A"]


def test_replace_when_keeps_null(spark):
    got = column(spark, ["M", None, "x"], "string", lambda c: fx.replace_when(c, "M", F.lit("p")))
    assert got == ["p", None, "x"]


def test_collapse(spark):
    rows = [("1", "A", 2, "old", 1), ("1", "A", 3, None, 2), ("1", None, 4, "n", 3), ("1", None, 5, "n", 4)]
    rows += [("", "A", 6, "e", 5), ("2", "B", 7, "s", 6)]
    df = spark.createDataFrame(rows, "doc string, item string, qty int, v string, no int")
    got = sorted(collapse_repeated(df, ["doc", "item"], "qty", ["no"]).collect(), key=lambda r: r["no"])
    assert [tuple(r) for r in got] == [("1", "A", 5, "old", 2), *rows[2:]]


def test_split_by_keeps_null_in_rest(spark):
    df = spark.createDataFrame([("a",), (None,), ("z",)], "c string")
    parts, rest = split_by(df, "c", ["a"])
    assert parts["a"].count() == 1 and {r["c"] for r in rest.collect()} == {None, "z"}


def test_snapshot_pick(spark):
    d1, d2, d3 = dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31)
    df = spark.createDataFrame([(d1, 1), (d2, 2), (d3, 3)], "period date, v int")
    assert [r["v"] for r in snapshot_pick(df, "period", F.lit(d2)).collect()] == [2]
    assert [r["v"] for r in snapshot_pick(df, "period", F.lit(dt.date(2030, 1, 31))).collect()] == [3]


def test_unique_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "k int, v string")
    with pytest.raises(ValueError, match="not unique"):
        assert_unique_key(df, ["k"])
    left = spark.createDataFrame([(1,), (2,)], "x int")
    assert lookup(left, df, [("x", "k")], {"v": "w"}).count() == 3


def test_sums(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, 5.0)], "k int, q double")
    assert [tuple(r) for r in sum_by_key(df, ["k"], {"q": F.col("q")}).collect()] == [(1, 0.0)]
    rows = spark.createDataFrame([(1, 1, 2.0), (1, 1, 2.0), (1, 2, 2.0)], "k int, line int, q double")
    assert distinct_sum(rows, ["k"], ["line"], "q", "t").first()["t"] == 4.0


def test_stage_counts_shows_empty_stage(spark):
    df = spark.createDataFrame([(1,)], "k int")
    got = stage_counts({"all": df, "none": df.filter("k > 5")}).collect()
    assert {r["stage"]: r["n_rows"] for r in got} == {"all": 1, "none": 0}
