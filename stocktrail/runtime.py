"""Session helpers: run folder, written intermediate tables, size threshold."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

HOT_ROWS_CONF = "spark.stocktrail.hotRows"
DEFAULT_HOT_ROWS = 1_000_000
WORK_DIR_CONF = "spark.stocktrail.workDir"
CHECKPOINT_CONF = "spark.checkpoint.dir"

SHARED_SHUFFLE_CONF = "spark.sql.requireAllClusterKeysForCoPartition"
# HotSpot only compiles methods of up to 8000 bytes of bytecode; Spark's own limit lets far longer ones be interpreted.
METHOD_LIMIT_CONF = "spark.sql.codegen.hugeMethodLimit"
COMPILED_BYTES = 8000
# Spark deletes a query's shuffle files when it ends, not when the driver next collects garbage.
FILE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_rows: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def hot_rows(spark: SparkSession) -> int:
    """Rows one group may hold before its work is split over several tasks."""
    return int(spark.conf.get(HOT_ROWS_CONF, str(DEFAULT_HOT_ROWS)))


def share_shuffles(spark: SparkSession) -> None:
    """Let joins on a key and further columns use rows that lie by the key alone.

    With Spark's default a join shuffles both sides by all of its keys, so the rows of a chain of document
    joins move at every step, although the document number deals them well.
    """
    spark.conf.set(SHARED_SHUFFLE_CONF, "false")


def compiled_methods(spark: SparkSession) -> None:
    """Let a stage whose generated method would be too long for the compiler run operator by operator.

    Wide rows of computed columns make such methods. Operators on their own split their expressions into short ones.
    """
    spark.conf.set(METHOD_LIMIT_CONF, str(COMPILED_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """Folder of this application that every executor can reach.

    It lies below ``spark.stocktrail.workDir``, else ``spark.checkpoint.dir``. Where neither is set, a session
    whose executors run inside the driver gets a temporary folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    base = (
        spark.conf.get(WORK_DIR_CONF, None)
        or spark.conf.get(CHECKPOINT_CONF, None)
        or sc.getConf().get(CHECKPOINT_CONF)
    )
    if not base:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="stocktrail-")
        spark.conf.set(WORK_DIR_CONF, base)
    return f"{base.rstrip('/')}/stocktrail/{sc.applicationId}"


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files; others of the session are as before."""
    before = spark.conf.get(FILE_CLEANUP_CONF, None)
    spark.conf.set(FILE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FILE_CLEANUP_CONF)
        else:
            spark.conf.set(FILE_CLEANUP_CONF, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the run's folder and read it back.

    Unlike a cached result this survives lost executors, and readers still get
    column pruning and filter pushdown. The same job counts the rows, see `written_rows`.
    Nothing reads the shuffles of the write again, so they are deleted with its end: a chain of stage
    tables holds the files of one stage on disk, not those of all.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    counted = Observation()
    with _shuffles_deleted(spark):
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    rows = counted.get.get("rows")
    _rows[written] = written.count() if rows is None else rows
    return written


def written_rows(df: DataFrame) -> int | None:
    """Rows of a table that `materialize` has written; None for any other."""
    return _rows.get(df)


def with_rows_of(df: DataFrame, written: DataFrame) -> DataFrame:
    """``df``, noted to have as many rows as the written table it was made from."""
    _rows[df] = _rows[written]
    return df


def remove_work(spark: SparkSession) -> None:
    """Delete what this application wrote with `materialize`; frames built on it are void then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
