"""Importance resampling towards a target text: hashed word-run weights, noise, and the highest scores."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktrail.llm.common import append_columns
from stocktrail.operators.windows import number_rows
from stocktrail.runtime import materialize

BUCKETS = 10_000
CACHE = 1 << 17  # word runs a task remembers the bucket of
ACCURACY = 1000  # of the quantile sketch: ranks are right to one in so many
_NO_WORD = bytes(b for b in range(128) if not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A))
_WORD_BYTES = bytes.maketrans(_NO_WORD, b" " * len(_NO_WORD))


class _Places(dict):
    """Bucket of each word run, of a bounded number of them remembered."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, run: bytes) -> int:
        place = zlib.crc32(run) % self.buckets
        if len(self) < CACHE:
            self[run] = place
        return place


def split_words(text: str | None) -> list[bytes]:
    """Runs of digits, letters a-z and all characters beyond ASCII, after lower-casing A-Z only."""
    return (text or "").encode().lower().translate(_WORD_BYTES).split()


def runs(words: list[bytes], longest: int) -> list[bytes]:
    """All runs of 1 to ``longest`` consecutive words, joined by one space."""
    out = list(words)
    for size in range(2, longest + 1):
        out += [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    return out


def bucket_counts(df: DataFrame, text: str, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Word runs of all texts by bucket.

    Each task adds up its own texts and sends at most one row per bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, total = _Places(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                found = list(map(places.__getitem__, runs(split_words(value), longest)))
                if found:
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    parts = df.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "bucket int, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # `buckets` rows at most
        out[row["bucket"]] = row["n"]
    return out


def gains(of_all: np.ndarray, of_target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target share over corpus share of each bucket, one added to each count."""
    buckets, s_all, t_all = len(of_all), float(of_all.sum()), float(of_target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
            for s, t in zip(of_all.tolist(), of_target.tolist(), strict=True)
        ],
        np.int64,
    )


def weigh(df: DataFrame, text: str, gain: np.ndarray, longest: int = 1, drop: tuple[str, ...] = ()) -> DataFrame:
    """Add n_words, n_features and weight, the floored mean gain of the text's word runs (0 without any)."""

    def start():
        places = _Places(len(gain))

        def work(texts: list[str | None]) -> list[list[int]]:
            n_words, n_features, weight = [], [], []
            for text in texts:
                words = split_words(text)
                found = list(map(places.__getitem__, runs(words, longest)))
                n_words.append(len(words))
                n_features.append(len(found))
                weight.append(int(gain[found].sum()) // len(found) if found else 0)
            return [n_words, n_features, weight]

        return work

    return append_columns(df, [text], "n_words bigint, n_features bigint, weight bigint", start, drop)


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variable from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def resample(
    df: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    share: tuple[int, int] = (10, 100), min_words: int = 20, longest: int = 1, buckets: int = BUCKETS, seed: int = 2024,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``df``.

    A word run's gain compares its bucket's share in ``target`` with that in ``df``; a document's
    weight is the mean gain of its runs, its score the weight plus noise drawn from its id. Of the N documents with at
    least ``min_words`` words the floor(share x N) of highest score are drawn and ranked from 1,
    ties to the smaller id (null last, then by the other columns); ``rank`` is null for all others.

    Null and empty texts have no words and weight 0; null ids draw the noise of an empty id; rows that
    repeat count each. An empty target gives every bucket the same target count. An empty table gives
    no rows. Further columns are not used.

    The draw sorts no more than it must: `cutoff` finds the last drawn row, and only rows down to it are numbered.
    """
    of_all = bucket_counts(df, text, longest, buckets)
    gain = gains(of_all, bucket_counts(target, target_text, longest, buckets))
    texts = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("__text"))
    weighed = weigh(texts, "__text", gain, longest, drop=("__text",))
    scored = materialize(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    able = scored.where(F.col("n_words") >= min_words)
    drawn = able.count() * share[0] // share[1]
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    nothing = F.lit(None).cast("bigint").alias("rank")
    last = cutoff(able, "score", "doc_id", drawn)
    if last is None:
        return scored.select(*columns, nothing)
    at = F.col("score") == F.lit(last["score"])
    if last["doc_id"] is not None:
        at = at & F.coalesce(F.col("doc_id") <= F.lit(last["doc_id"]), F.lit(False))
    reached = (F.col("n_words") >= min_words) & ((F.col("score") > F.lit(last["score"])) | at)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = number_rows(scored.where(reached), order, "place")
    ranked = ranked.select(*columns, F.when(F.col("place") <= drawn, F.col("place")).alias("rank"))
    return ranked.unionByName(scored.where(~reached).select(*columns, nothing))


def cutoff(rows: DataFrame, score: str, tie: str, k: int):
    """The k-th row in order of falling score, then rising ``tie``; None for k = 0.

    A quantile sketch gives two scores around the k-th. Rows above and between them are counted
    exactly; if the k-th is not between them, the bracket is widened. Only the rows of the bracket are sorted.
    """
    if k < 1:
        return None
    n = rows.count()
    middle, width = 1 - k / n, 2 / ACCURACY
    value = F.col(score)
    while True:
        low = high = None
        if middle - width > 0 or middle + width < 1:
            ends = [max(0.0, middle - width), min(1.0, middle + width)]
            low, high = rows.agg(F.percentile_approx(value, ends, ACCURACY)).first()[0]
        low = low if middle - width > 0 else None
        high = high if middle + width < 1 else None
        above = value > high if high is not None else F.lit(False)
        inside = ~above & (value >= low if low is not None else F.lit(True))
        counted = rows.agg(F.count(F.when(above, 1)).alias("above"), F.count(F.when(inside, 1)).alias("inside")).first()
        if counted["above"] < k <= counted["above"] + counted["inside"]:
            break
        width *= 4
    order = [value.desc(), F.col(tie).asc_nulls_last()]
    placed = number_rows(rows.where(inside), order, "__place")
    return placed.where(F.col("__place") == k - counted["above"]).drop("__place").first()
