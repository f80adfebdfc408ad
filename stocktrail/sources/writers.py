"""Writing results: tab-separated text, CSV, and the appended result table."""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text_value

log = logging.getLogger(__name__)


def text_rows(df: DataFrame) -> DataFrame:
    """Every column as sink text."""
    return df.select(*[text_value(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def write_tsv(df: DataFrame, folder: str, cutoff: dt.date) -> str:
    """Tab-separated files with header in a folder named after the cutoff."""
    path = f"{folder.rstrip('/')}/Resultado_{cutoff:%Y%m%d}"
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def with_load_columns(df: DataFrame, cutoff: dt.date) -> DataFrame:
    return text_rows(df).select(
        F.lit(cutoff).alias("fecha_corte"), F.current_timestamp().alias("fecha_carga"), "*"
    )


def append_table(df: DataFrame, path: str, cutoff: dt.date) -> None:
    """Add one cutoff's rows to the result table at ``path``.

    The table is partitioned by cutoff and a rerun replaces its own partition, so publishing
    twice keeps one copy.  An empty result leaves the table as it is: dynamic overwrite
    touches only the partitions it has rows for; `remove_cutoff` clears one.
    """
    (
        with_load_columns(df, cutoff)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("fecha_corte")
        .parquet(path)
    )


def remove_cutoff(spark: SparkSession, path: str, cutoff: dt.date) -> None:
    """Take one cutoff's rows out of the result table at ``path``."""
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/fecha_corte={cutoff.isoformat()}")
    part.getFileSystem(spark._jsc.hadoopConfiguration()).delete(part, True)


def append_jdbc(
    df: DataFrame, url: str, table: str, cutoff: dt.date, *, batch: int = 10_000, options: dict[str, str] | None = None
) -> None:
    """Append to a database table as one unit, creating it when missing.

    Tasks insert in batches into a stage table of this run. When all of them have, one transaction in the
    database moves the rows to ``table``; a run that fails before leaves it as it was, and a retried
    task cannot add rows twice. The stage table goes either way.
    """
    spark, options = df.sparkSession, options or {}
    rows, stage = with_load_columns(df, cutoff), f"{table}_{uuid.uuid4().hex[:12]}"

    def write(part: DataFrame, name: str) -> None:
        writer = part.write.format("jdbc").mode("append")
        writer.option("url", url).option("dbtable", name).option("batchsize", str(batch)).options(**options).save()

    names = ", ".join(f'"{c}"' for c in rows.columns)
    try:
        write(rows, stage)
        write(rows.limit(0), table)
        _in_transaction(spark, url, options, f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage}")
    finally:
        try:
            _in_transaction(spark, url, options, f"DROP TABLE {stage}")
        except Py4JJavaError as error:  # the stage table was never made
            log.warning("stage table %s not dropped: %s", stage, error.java_exception.getMessage())


def _in_transaction(spark: SparkSession, url: str, options: dict[str, str], statement: str) -> None:
    """Run one statement at the database and commit it."""
    given = spark._jvm.java.util.Properties()
    for key, value in options.items():
        given.setProperty(key, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        connection.setAutoCommit(False)
        connection.createStatement().executeUpdate(statement)
        connection.commit()
    except Py4JJavaError:
        connection.rollback()
        raise
    finally:
        connection.close()
