"""Documents to tokens: quality, near duplicates, benchmark passages, secrets, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``. A stage carries the whole row in one struct, so columns of any name pass.
Null and empty texts are scored, fingerprinted and encoded as empty texts; null ids are kept
apart from all ids; an empty table passes every stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktrail.llm import decontaminate, quality_gam, secret_scan, simhash_dedup
from stocktrail.llm.bpe_codec import round_trip_digests
from stocktrail.llm.common import read_table
from stocktrail.llm.queries import VOCABULARY
from stocktrail.runtime import materialize


def _packed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct("*").alias("row"), F.col("text").alias("body"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = quality_gam.train(docs, read_table(spark, sf_dir, "labels"))
    scored = quality_gam.score(_packed(docs), "body", model, drop=["body"])
    return scored.where(F.col("score") >= quality_gam.THRESHOLD).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each class of near duplicates."""
    return simhash_dedup.keep_one(docs, "doc_id", "text")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = decontaminate.find_contamination(
        _packed(docs), "body", read_table(spark, sf_dir, "benchmark"), drop=["body"]
    )
    return found.where(F.size("hits") == 0).select("row.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark; n_chars follows where a text changed."""
    clean = secret_scan.redact(_packed(docs), "body")
    changed = F.col("n_secrets") > 0
    columns = []
    for name in docs.columns:
        old = F.col("row").getField(name)
        if name == "text":
            old = F.col("body")
        elif name == "n_chars":
            old = F.when(changed, F.length("body").cast(docs.schema[name].dataType)).otherwise(old)
        columns.append(old.alias(name))
    return clean.select(*columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of the ids and of the text they decode to."""
    path = public_tokenizers.path(VOCABULARY)
    return round_trip_digests(docs.select("doc_id", "text"), "text", path, ids="ids", drop=["text"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("BPE encoding and decoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# A trained classifier and byte-pair encoding are not expressible in SQL; tests/llm compares the
# stages with brute-force versions.
ORACLE_SQL = None
