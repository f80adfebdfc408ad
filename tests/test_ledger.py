"""The ledger: columns asked for, parts written first, bounds of keys."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_shuffles import shuffled, with_column

from stocktrail.plans import ledger
from stocktrail.plans.erp_tables import erp_tables
from stocktrail.plans.key_sizes import SLOTS, SizedTables, sized
from stocktrail.plans.queries import QUERIES
from stocktrail.runtime import COMPILED_BYTES, METHOD_LIMIT_CONF

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")
ASKED = ["created", "qty_in", "final_client", "item"]


def counted(df):
    return Counter(tuple(r) for r in df.collect())


def with_repeats(spark):
    """The ERP tables with movements given twice, and twice but for one column or for where a value stands."""
    t = dict(erp_tables(spark, str(DATA)))
    some = t["OINM"].filter(F.col("TransNum") % 7 == 0)
    swapped = some.withColumns({"Comments": F.col("CardName"), "CardName": F.lit(None).cast("string")})
    t["OINM"] = reduce_union([t["OINM"], some, some.withColumn("Warehouse", F.lit("other")), swapped])
    return t


def reduce_union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def test_columns_asked_for_come_once_per_ledger_row(spark):
    t = with_repeats(spark)
    want = counted(ledger.movement_ledger(t).select(*ASKED))
    assert max(want.values()) > 1
    assert counted(ledger.movement_ledger(t, only=ASKED)) == want


def test_large_ledger_writes_its_parts_first(spark, monkeypatch):
    t = with_repeats(spark)
    want = counted(ledger.movement_ledger(t))
    written, write = [], ledger.materialize
    monkeypatch.setattr(ledger, "materialize", lambda df: written.append(df) or write(df))
    assert counted(ledger.movement_ledger(t, limit=1_000)) == want
    assert len(written) == 2


def test_what_is_found_by_entry_moves_without_the_movement(spark):
    """Neither number nor reference of a movement goes along, and other types stay where they are."""
    exchanges = shuffled(spark, QUERIES["movement_ledger"](spark, str(DATA)))
    assert with_column(exchanges, "TransNum") == 1
    asked = shuffled(spark, ledger.movement_ledger(erp_tables(spark, str(DATA)), only=["item", "created"]))
    assert with_column(asked, "JrnlMemo", "Warehouse", "TransValue") == 0


def test_bounds_of_a_product_are_counted_finer(spark):
    keys = [("T", "a"), ("U", "a")]
    many = spark.range(40 * SLOTS).select(F.col("id").alias("a"))
    t = SizedTables({"T": many, "U": many.unionByName(many)}, keys)
    coarse = t.most("T", "a") * t.most("U", "a")
    assert coarse > 2_000
    assert 2 <= t.product(*keys, limit=2_000) < 100
    assert t.most("U", "a") >= 2
    # Below the limit nothing is counted again.
    assert SizedTables(t.tables, keys).product(*keys, limit=10 * coarse) == coarse


def test_datasets_run_compiled(spark):
    spark.conf.unset(METHOD_LIMIT_CONF)
    sized(erp_tables(spark, str(DATA)), [])
    assert int(spark.conf.get(METHOD_LIMIT_CONF)) == COMPILED_BYTES
