"""What stage writes and numbering leave behind or move."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stocktrail.operators.windows import number_rows
from stocktrail.plans import ledger
from stocktrail.plans.erp_tables import erp_tables
from stocktrail.runtime import FILE_CLEANUP_CONF, materialize

DATA = Path("/root/testdata/sf0.001")


def shuffle_files(spark) -> int:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().toList()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def test_a_stage_write_leaves_no_shuffle_files(spark):
    frame = spark.range(10_000).repartition(4, F.col("id") % 7).groupBy((F.col("id") % 11).alias("k")).count()
    before, conf = shuffle_files(spark), spark.conf.get(FILE_CLEANUP_CONF, None)
    written = materialize(frame)
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert spark.conf.get(FILE_CLEANUP_CONF, None) == conf
    # The frame itself still runs, and so does its stage table, more than once.
    for _ in range(2):
        assert frame.agg(F.sum("count")).first()[0] == written.agg(F.sum("count")).first()[0] == 10_000


def test_a_failed_stage_write_restores_the_session(spark):
    conf = spark.conf.get(FILE_CLEANUP_CONF, None)
    with pytest.raises(Exception, match="gone"):
        materialize(spark.range(5).select(F.raise_error(F.lit("gone")).alias("x")))
    assert spark.conf.get(FILE_CLEANUP_CONF, None) == conf


def test_numbering_does_not_shuffle_the_placed_rows(spark):
    rows = spark.range(1_000).select((F.col("id") * 37 % 1_000).alias("id"), F.lit("wide").alias("text"))
    got = number_rows(rows, [F.col("id").asc()], "n", distinct_order=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert [(r["id"], r["n"]) for r in got.orderBy("n").collect()] == [(i, i + 1) for i in range(1_000)]


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_only_types_found_by_their_creating_key_are_dealt_by_it(spark, monkeypatch):
    dealt, deal = {}, ledger.deal

    def seen(df, key, *args, **kwargs):
        dealt.setdefault(str(key), df)
        return deal(df, key, *args, **kwargs)

    monkeypatch.setattr(ledger, "deal", seen)
    t = erp_tables(spark, str(DATA))
    ledger.movement_ledger(t)
    (moved,) = [df for key, df in dealt.items() if "CreatedBy" in key]
    kinds = {r["TransType"] for r in moved.select("TransType").distinct().collect()}
    assert kinds == set(ledger.BY_ENTRY) < {r["TransType"] for r in t["OINM"].select("TransType").distinct().collect()}
