"""Helpers the operators share: appending columns batch by batch, the row-wise fold, run folders."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Called once per task; returns a function from the batch's texts to one list per new column.
Starter = Callable[[], Callable[..., list[list]]]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def append_columns(
    df: DataFrame, inputs: list[str], fields: str, start: Starter, drop: Iterable[str] = ()
) -> DataFrame:
    """Add columns computed from ``inputs``, without a shuffle.

    ``fields`` is a DDL string of the new columns. A column of ``df`` with the name of a new one
    is replaced. ``drop`` names columns that are not sent back from the Python worker.
    """
    added = T.StructType.fromDDL(fields)
    gone = {name.lower() for name in (*added.fieldNames(), *drop)}
    kept = [name for name in df.columns if name.lower() not in gone]
    out = T.StructType([*(df.schema[name] for name in kept), *added])
    df = df.select(*[_quoted(c) for c in kept], *[_quoted(c).alias(f"__in{i}") for i, c in enumerate(inputs)])
    arrow = to_arrow_schema(out)
    width, count = len(kept), len(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            texts = [batch.column(width + i).to_pylist() for i in range(count)]
            columns = work(*texts)
            types = [arrow.field(width + i).type for i in range(len(columns))]
            made = [c.cast(t) if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *made], names=out.fieldNames())

    return df.mapInArrow(run, out)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def held_out(doc_id: Column) -> Column:
    """The quarter of documents no label may be learnt from; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
