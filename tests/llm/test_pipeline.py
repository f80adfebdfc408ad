"""The corpus pipeline, stage by stage, against brute-force versions."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from stocktrail.llm import secret_scan
from tests_llm_helpers import slow_classes, slow_fingerprint, slow_hit  # noqa: I001
from stocktrail.runtime import materialize

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(materialize(stage(spark, out[-1], FOLDER)))
    return [[r.asDict() for r in d.collect()] for d in out], [d.columns for d in out]


def ids(rows):
    return {r["doc_id"] for r in rows}


def test_columns_and_names(stages):
    assert [n for n, _ in cp.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scans", "BPE encoding and decoding",
    ]
    assert all(c == stages[1][0] for c in stages[1][:-1])


def test_quality_rejects_bad_and_keeps_good(stages):
    before, after = ids(stages[0][0]), ids(stages[0][1])
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{FOLDER}/labels.parquet").to_pylist()}
    held = [d for d in labels if zlib.crc32(str(d).encode()) % 4 == 2]
    assert after < before
    assert sum((d in after) == (labels[d] == 1) for d in held) / len(held) >= 0.97


def test_one_of_each_class_stays(stages):
    rows = stages[0][1]
    prints = {r["doc_id"]: slow_fingerprint(r["text"]) for r in rows}
    label = slow_classes(sorted(set(prints.values())), 4)
    least = {}
    for d, f in prints.items():
        least[label[f]] = min(d, least.get(label[f], d))
    assert sorted(r["doc_id"] for r in stages[0][2]) == sorted(least.values())


def test_contaminated_documents_go(stages):
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()]
    clean = {r["doc_id"] for r in stages[0][2] if not slow_hit(r["text"], items)}
    assert ids(stages[0][3]) == clean and len(clean) < len(stages[0][2])


def test_secrets_are_replaced(stages):
    before = {r["doc_id"]: r for r in stages[0][3]}
    assert ids(stages[0][4]) == before.keys()
    changed = 0
    for r in stages[0][4]:
        old = before[r["doc_id"]]
        spans = secret_scan.scan(old["text"])
        if not spans:
            assert r == old
            continue
        changed += 1
        assert r["n_chars"] == len(r["text"]) and "[SECRET]" in r["text"]
        assert all(old["text"][a:b] not in r["text"] for _, a, b in spans)
    assert changed


def test_tokens(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in stages[0][4]}
    assert ids(stages[0][5]) == texts.keys()
    for r in stages[0][5]:
        want = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == want and r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_odd_documents_pass_every_stage(spark, folder):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, score double, hits string, fp string"
    rows = [(1, None, None, None, None, "r", 1.0, "h", "f"), (None, "", None, None, 0, None, None, None, None),
            (2, "plain words of no harm", "en", "s", 22, "r", 0.0, "h", "f"), (2, "plain words of no harm", "en", "s", 22, "r", 0.0, "h", "f")]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and stage(spark, docs.limit(0), folder).count() == 0
        out.collect()
    assert cp.near_duplicates(spark, docs, folder).count() == 2
    assert cp.encoding(spark, docs, folder).count() == 4
    assert cp.encoding(spark, docs.limit(0), folder).count() == 0


def test_run_is_the_stages_in_turn(spark, stages):
    got = sorted((r["doc_id"], r["ids_sha256"]) for r in cp.run(spark, FOLDER).collect())
    assert got == sorted((r["doc_id"], r["ids_sha256"]) for r in stages[0][5])
