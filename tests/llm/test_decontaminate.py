"""Benchmark windows in documents against SQL and against a plain search."""

import random
import re

import duckdb
import pytest

from stocktrail.llm.check_sql import SQL
from stocktrail.llm.decontaminate import find_contamination
from stocktrail.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def slow(text, items, window=10):
    words = WORD.findall(lower(text))
    hit, ids = set(), set()
    for item_id, item in items:
        own = WORD.findall(lower(item))
        size = min(window, len(own))
        for k in range(len(own) - size + 1) if own else ():
            for at in range(len(words) - size + 1):
                if words[at : at + size] == own[k : k + size]:
                    hit.update(range(at, at + size))
                    if item_id is not None:
                        ids.add(str(item_id))
    return len(words), len(hit), sorted(ids)


@pytest.mark.parametrize("room", [1 << 20, 60])
def test_random_texts(spark, room):
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice(["a", "B", "c3", "Dé", "x-y"]) for _ in range(n))
    items = [(i, say(rng.choice((1, 3, 12, 14)))) for i in range(2, 8)] + [(None, "zz yy"), (9, ""), (9, None), (10, "...")]
    texts = [(i, say(rng.randint(0, 60)) + rng.choice(["", " ZZ, yy!"])) for i in range(25)] + [(99, None)]
    docs = spark.createDataFrame(texts, "doc_id int, text string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    found = find_contamination(docs, "text", bench, automaton_bytes=room).collect()
    assert len(found) == len(texts)
    for r in found:
        n, hit, ids = slow(r["text"], items)
        assert (r["n_words"], sum(h["last"] - h["first"] + 1 for h in r["hits"]), r["item_ids"]) == (n, hit, ids)
        marked = [w for s in r["spans"] for w in WORD.findall(lower(r["text"][s["start"] : s["end"]]))]
        assert len(marked) == hit


def test_spans_are_of_the_original_text(spark):
    docs = spark.createDataFrame([("Éa, THE--quick!  brown fox",)], "text string")
    bench = spark.createDataFrame([(1, "the quick brown")], "item_id int, text string")
    row = find_contamination(docs, "text", bench).first()
    assert [row["text"][s["start"] : s["end"]] for s in row["spans"]] == ["THE--quick!  brown"]


def test_query_against_sql(spark, folder):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    want = con.sql(SQL["op8_decontaminate"])
    got = [tuple(r) for r in QUERIES["op8_decontaminate"](spark, folder).select(*want.columns).collect()]
    assert sorted(got) == sorted(want.fetchall())


def test_odd_rows(spark, odd_rows):
    none = spark.createDataFrame([], "item_id bigint, text string")
    rows = find_contamination(odd_rows.withColumnRenamed("extra", "hits"), "text", none).collect()
    assert len(rows) == 7 and all(r["hits"] == [] and r["item_ids"] == [] for r in rows)
    twice = spark.createDataFrame([(1, "two three"), (1, "two three"), (1, "six")], "item_id bigint, text string")
    rows = find_contamination(odd_rows, "text", twice).where("doc_id = 1").collect()
    assert [r["item_ids"] for r in rows] == [["1"], ["1"]]
    assert find_contamination(odd_rows.limit(0), "text", twice).count() == 0
