"""Numbers by a narrow frame."""

from pyspark.sql import functions as F

from stocktrail.operators import windows


def test_numbers_from_a_narrow_frame(spark, monkeypatch):
    rows = spark.range(500).select(
        F.when(F.col("id") > 0, F.col("id")).alias("id"), (F.col("id") * 37 % 101).alias("o"), F.lit("wide").alias("text")
    )
    written, write = [], windows.materialize
    monkeypatch.setattr(windows, "materialize", lambda df: written.append(df.columns) or write(df))
    order = [F.col("o").desc(), F.col("id").asc()]
    want = windows.number_rows(rows, order, "n", distinct_order=True).collect()
    written.clear()
    got = windows.number_rows(rows, order, "n", distinct_order=True, narrow=rows.select("o", "id"), key="id")
    assert sorted(map(str, got.collect())) == sorted(map(str, want)) and len(want) == 500
    assert [c for c in written if "text" in c] == [["id", "o", "text", "n"]]
