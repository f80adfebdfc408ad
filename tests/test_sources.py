"""Readers and writers."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stocktrail.plans.report import REPORT_COLUMNS, published
from stocktrail.runtime import WORK_DIR_CONF, materialize, remove_work, shared_dir
from stocktrail.sources import readers, writers
from stocktrail.sources.schemas import DDL, schema
from stocktrail.sources.snapshots import SnapshotTable
from stocktrail.sources.versions import ResultTable

DAY = dt.date(2024, 5, 31)


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "n int, t string")
    path = writers.write_tsv(df, str(tmp_path), DAY)
    assert path.endswith("Resultado_20240531")
    back = spark.read.option("sep", "\t").option("header", True).schema("n int, t string").csv(path)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_append_twice_keeps_one_copy(spark, tmp_path):
    path = str(tmp_path / "result")
    df = spark.createDataFrame([(1, "x")], "n int, t string")
    for _ in range(2):
        writers.append_table(df, path, DAY)
    writers.append_table(df, path, DAY + dt.timedelta(days=1))
    writers.append_table(df.filter("n > 9"), path, DAY)
    got = spark.read.parquet(path)
    assert got.groupBy("fecha_corte").count().count() == 2 and got.count() == 2
    assert dict(got.dtypes)["n"] == "string"


def test_text_rows(spark):
    df = spark.sql("SELECT 1 AS n, DATE '2024-01-02' AS d, TIMESTAMP_NTZ '2024-01-02 03:04:05' AS t, "
                   "CAST('NaN' AS DOUBLE) AS x, CAST(NULL AS STRING) AS s")
    assert tuple(writers.text_rows(df).first()) == ("1", "2024-01-02", "2024-01-02T03:04:05", None, None)


def test_scan_or_empty(spark, tmp_path):
    missing = lambda: spark.read.parquet(str(tmp_path / "nothing"))
    got = readers.scan_or_empty(spark, missing, schema("OCRD"), on_error="empty")
    assert got.columns == ["CardCode", "CardName"] and got.count() == 0
    with pytest.raises(PySparkException):
        readers.scan_or_empty(spark, missing, schema("OCRD"))


def test_scan_or_empty_without_a_database(spark):
    unreachable = lambda: readers.jdbc_query(
        spark, "jdbc:derby:memory:none", "SELECT 1 FROM T", options={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    )
    assert readers.scan_or_empty(spark, unreachable, schema("OCRD"), on_error="empty").count() == 0
    no_driver = lambda: readers.jdbc_query(spark, "jdbc:none:x", "SELECT 1", options={"driver": "no.such.Driver"})
    assert readers.scan_or_empty(spark, no_driver, schema("OCRD"), on_error="empty").count() == 0
    with pytest.raises(Exception, match="Driver|none"):
        readers.scan_or_empty(spark, no_driver, schema("OCRD"))


def test_all_schemas_parse():
    assert all(len(schema(name)) > 0 for name in DDL)


def test_jdbc_round_trip(spark):
    url = "jdbc:derby:memory:stock;create=true"
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "N int, T string")
    df.write.format("jdbc").options(url=url, dbtable="SRC", **options).mode("append").save()
    got = readers.jdbc_query(spark, url, "SELECT N, T FROM SRC WHERE N >= 4", options=options)
    assert got.count() == 6
    split = readers.jdbc_query(spark, url, "SELECT N, T FROM SRC", split=("N", 0, 10, 3), options=options)
    assert split.rdd.getNumPartitions() == 3 and split.count() == 10
    writers.append_jdbc(df.limit(3), url, "RESULT", DAY, options=options)
    assert spark.read.format("jdbc").options(url=url, dbtable="RESULT", **options).load().count() == 3


def test_table_function(spark):
    spark.createDataFrame([(1, "a"), (2, "b")], "n int, t string").createOrReplaceTempView("pairs")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION above(low INT) RETURNS TABLE(t STRING) "
              "RETURN SELECT t FROM pairs WHERE n > low")
    assert readers.call_function(spark, "above", [1]) == "b"
    assert readers.table_function_scan(spark, "above", [0]).count() == 2
    with pytest.raises(ValueError):
        readers.table_function_scan(spark, "above(1); DROP TABLE x", [])


def test_read_rows(spark):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    assert readers.read_first(spark, "SELECT n FROM {src} WHERE n > :low", {"low": 1}, src=df)["n"] == 2
    assert readers.read_first(spark, "SELECT n FROM {src} WHERE n > :low", {"low": 5}, src=df) is None


def test_as_of_scan_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.sql("SELECT DATE '2024-01-01' + CAST(id AS INT) AS d, id FROM range(300)").write.parquet(path)
    got = readers.as_of_scan(spark.read.parquet(path), "d", DAY)
    assert got.count() == 152
    assert "LessThanOrEqual(d,2024-05-31)" in got._jdf.queryExecution().executedPlan().toString()


def test_materialize_uses_shared_folder(spark):
    df = spark.range(5).withColumn("Año.x", F.lit("ñ"))
    got = materialize(df)
    assert got.schema.names == df.schema.names and got.count() == 5
    assert shared_dir(spark).split(":")[-1] in got.inputFiles()[0]


def test_work_folder(spark, tmp_path):
    spark.conf.set(WORK_DIR_CONF, str(tmp_path / "work"))
    try:
        assert materialize(spark.range(3)).count() == 3
        assert list((tmp_path / "work").rglob("*.parquet"))
        remove_work(spark)
        assert not list((tmp_path / "work").rglob("*.parquet"))
    finally:
        spark.conf.unset(WORK_DIR_CONF)


def test_published_names(spark):
    df = spark.createDataFrame([tuple("x" for _ in REPORT_COLUMNS)], list(REPORT_COLUMNS))
    assert published(df).columns == list(REPORT_COLUMNS.values()) and len(REPORT_COLUMNS) == 41


def test_source_that_fails_while_it_is_read(spark):
    """The error comes with the last rows; a frame over them would fail wherever it is used."""
    rows = spark.range(1000).repartition(4).select(F.col("id").cast("string").alias("CardCode"), F.lit("n").alias("CardName"))
    broken = rows.withColumn("CardName", F.when(F.col("CardCode") == "999", F.raise_error(F.lit("gone"))).otherwise("n"))
    assert readers.scan_or_empty(spark, lambda: broken, schema("OCRD"), on_error="empty").count() == 0
    assert readers.scan_or_empty(spark, lambda: rows, schema("OCRD"), on_error="empty").count() == 1000
    with pytest.raises(Exception, match="gone"):
        readers.scan_or_empty(spark, lambda: broken, schema("OCRD")).collect()


def test_versions_switch_whole(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, t string")
    table = ResultTable(spark, str(tmp_path / "result"))
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.read(df.schema).count() == 0
    table.publish(df, DAY)
    table.publish(df.filter("n = 1"), DAY + dt.timedelta(days=1))
    broken = df.withColumn("t", F.when(F.col("n") == 2, F.raise_error(F.lit("gone"))).otherwise("z"))
    with pytest.raises(Exception, match="gone"):
        table.publish(broken, DAY)
    assert sorted((r["n"], r["t"]) for r in table.read().collect()) == [("1", "a"), ("1", "a"), ("2", "b")]
    table.publish(df.filter("n = 2"), DAY)
    assert sorted(r["n"] for r in table.read().filter(F.col("fecha_corte") == F.lit(DAY)).collect()) == ["2"]
    table.publish(df.limit(0), DAY)  # an empty rerun replaces the rows
    assert [r["n"] for r in table.read().collect()] == ["1"]
    assert table.vacuum() == 3 and [r["n"] for r in table.read().collect()] == ["1"]
    table.remove(DAY + dt.timedelta(days=1))
    assert table.read().count() == 0 and list(table.current()) == [DAY]


def test_reader_that_began_keeps_its_version(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    table = ResultTable(spark, str(tmp_path / "result"))
    table.publish(df, DAY)
    begun = table.read()
    table.publish(df.filter("n = 1"), DAY)
    assert begun.count() == 2 and table.read().count() == 1


def test_even_split_of_a_skewed_column(spark):
    """Equal ranges would put nearly all rows into one task."""
    url, options = "jdbc:derby:memory:even;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = [(int(1.02**i), f"t{i}") for i in range(900)] + [(None, "none")] * 3
    spark.createDataFrame(rows, "N bigint, T string").write.format("jdbc").options(url=url, dbtable="SKEWED", **options).mode("append").save()
    numbered = "SELECT v, ROW_NUMBER() OVER () AS n FROM ({values} ORDER BY v) numbered_values"
    got = readers.jdbc_even_query(spark, url, "SELECT N, T FROM SKEWED", "N", 6, numbered=numbered, options=options)
    sizes = got.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(sizes) == 903 and len(sizes) == 6 and max(sizes) <= 2 * min(sizes)
    assert sorted(map(str, got.collect())) == sorted(map(str, spark.createDataFrame(rows, "N bigint, T string").collect()))


def test_even_ranges_hold_every_value_once():
    ranges = readers.even_ranges("c", ["a'b", "m"])
    assert ranges == ["c <= 'a''b' OR c IS NULL", "c > 'a''b' AND c <= 'm'", "c > 'm'"]
    assert readers.even_ranges("c", []) == ["1 = 1"]


def test_snapshot_reads_one_period(spark, tmp_path):
    rows = [(dt.date(2024, m, 28), f"i{i}", m) for m in (1, 2, 3) for i in range(5)] + [(None, "x", 0)]
    table = SnapshotTable(spark, str(tmp_path / "rotation"))
    with pytest.raises(FileNotFoundError):
        table.pick(DAY)
    table.write(spark.createDataFrame(rows, "period date, item_key string, category int"))
    assert table.periods() == [dt.date(2024, m, 28) for m in (1, 2, 3)]
    got = table.pick(dt.date(2024, 2, 28))
    assert {r["category"] for r in got.collect()} == {2} and got.count() == 5
    assert all("period=2024-02-28" in f for f in got.inputFiles())
    assert {r["category"] for r in table.pick(DAY).collect()} == {3}


def test_jdbc_append_is_one_unit(spark):
    url, options = "jdbc:derby:memory:unit;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.range(40).repartition(4).select(F.col("id").cast("int").alias("N"), F.lit("t").alias("T"))
    broken = df.withColumn("T", F.when(F.col("N") == 39, F.raise_error(F.lit("gone"))).otherwise("z"))
    stored = lambda: readers.jdbc_query(spark, url, "SELECT * FROM RESULT", options=options)
    writers.append_jdbc(df.filter("N < 5"), url, "RESULT", DAY, options=options)
    with pytest.raises(Exception, match="gone"):
        writers.append_jdbc(broken, url, "RESULT", DAY, options=options)
    assert stored().count() == 5 and {r["T"] for r in stored().collect()} == {"t"}
    writers.append_jdbc(df, url, "RESULT", DAY, options=options)
    assert stored().count() == 45
    left = readers.jdbc_query(spark, url, "SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T'", options=options)
    assert [r[0] for r in left.collect()] == ["RESULT"]
