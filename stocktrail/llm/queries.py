"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktrail.llm.bpe_codec import round_trip_digests
from stocktrail.llm import (
    chunk_dedup, hamming_search, html_text, importance_sample, quality_gam, secret_scan, source_mix, url_filter, whitening,
)
from stocktrail.llm.common import held_out, read_table
from stocktrail.llm.decontaminate import find_contamination, hit_words
from stocktrail.llm.simhash_dedup import hex_digits, near_duplicate_classes
from stocktrail.llm.token_counts import count_tokens

VOCABULARY = "byte_bpe_50k.json"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents").select("doc_id", "text")


def op1_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest sign codes, by Hamming distance, to every row whose id is divisible by 50.

    Vectors of different sizes are compared over the entries both have.
    """
    vectors = read_table(spark, folder, "embeddings").select("vec_id", "embedding")
    queries = vectors.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    return hamming_search.top_k_signs(vectors, queries, 10, "vec_id", "query_id", "embedding")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = chunk_dedup.repeated_passages(documents(spark, folder), "doc_id", "text")
    return found.select("doc_id", "start", "end", "n_chunks", "first_here", "first_doc_id")


def op3_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return round_trip_digests(documents(spark, folder), "text", path, drop=["text"])


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages").select("page_id", "url", "html")
    model = html_text.train(pages)
    return html_text.extract(pages, "html", model, drop=["html"]).withColumn("n_chars", F.length("text").cast("bigint"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(documents(spark, folder), "text", drop=["text"])
    names = F.transform("secrets", lambda s: s["kind"])
    count = lambda kind: F.size(F.filter(names, lambda k: k == kind)).cast("bigint")
    base = F.filter("secrets", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secret_scan.BASE_KINDS],
        F.sha2(secret_scan.written(base), 256).alias("base_sha256"),
        secret_scan.written(F.col("secrets")).alias("spans"),
    )


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return count_tokens(documents(spark, folder), "text", path, drop=["text"])


# Explicit rules of the URL query: verdict, then host and path.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def labelled_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Page URLs that end in the number of a labelled document, which is bad if of low quality or toxic."""
    number = F.regexp_extract(url_filter.path(F.col("url")), r"([0-9]{1,18})(?:\.[A-Za-z0-9]+)?/?$", 1)
    urls = read_table(spark, folder, "pages").select("url", number.alias("n"))
    labels = read_table(spark, folder, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return urls.where("n <> ''").join(labels, F.col("n").cast("bigint") == F.col("doc_id")).select("url", "bad")


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, "url", labelled_urls(spark, folder), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined")


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = find_contamination(documents(spark, folder), "text", read_table(spark, folder, "benchmark"), drop=["text"])
    n_hit = hit_words()
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op9_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    classes = near_duplicate_classes(documents(spark, folder), "doc_id", "text")
    return classes.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = quality_gam.train(docs, read_table(spark, folder, "labels"))
    scored = quality_gam.score(docs, "text", model, drop=["text"])
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality_gam.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "source", "text")
    mixed = source_mix.mix(source_mix.count_words(docs, "text", drop=("text",)))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op12_importance_sample(spark: SparkSession, folder: str) -> DataFrame:
    drawn = importance_sample.resample(documents(spark, folder), read_table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    whitened = whitening.whiten(read_table(spark, folder, "embeddings"))
    return whitened.withColumn("deviation", F.col("deviation").cast("bigint"))


QUERIES = {
    "op1_topk_search": op1_topk_search,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_bpe_codec": op3_bpe_codec,
    "op4_html_text": op4_html_text,
    "op5_secret_scan": op5_secret_scan,
    "op6_token_counts": op6_token_counts,
    "op7_url_filter": op7_url_filter,
    "op8_decontaminate": op8_decontaminate,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_quality": op10_quality,
    "op11_source_mix": op11_source_mix,
    "op12_importance_sample": op12_importance_sample,
    "op13_whitening": op13_whitening,
}
