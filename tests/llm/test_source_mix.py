"""Source mix: targets against a plain water level, balance of every source, the flight itself."""

import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from stocktrail.llm import source_mix as sm
from stocktrail.llm.queries import QUERIES


def slow_targets(sizes, weights=(5, 2, 1), cap=3):
    """Share by weight, stop whoever is over, share the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = Fraction(sum(sizes.values())), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > cap * sizes[s]}
        if not over:
            out |= {s: float(weight[s] * level) for s in free}
            break
        out |= {s: float(cap * sizes[s]) for s in over}
        left -= sum(cap * sizes[s] for s in over)
        free -= over
    return out


def check(rows, sizes, slack):
    """``slack`` words at most between what a source gives and its target."""
    targets = slow_targets(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]], rel=1e-9)
        rate = targets[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] in (int(rate + 1e-9), int(rate + 1e-9) + 1)
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, target in targets.items():
        assert abs(taken[s] - target) <= slack, (s, taken[s], target)


def test_query(spark, folder):
    import pyarrow.parquet as pq

    docs = pq.read_table(f"{folder}/documents.parquet").to_pylist()
    sizes, own = defaultdict(int), {}
    for d in docs:
        own[d["doc_id"]] = len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or ""))
        sizes[d["source"]] += own[d["doc_id"]]
    got = QUERIES["op11_source_mix"](spark, folder).collect()
    assert {r["doc_id"]: r["size"] for r in got} == own and len(got) == len(docs)
    # Ten documents a source here, some of a fifth of its words: the landing decides all.
    check(got, sizes, 200)
    assert sorted(map(tuple, got)) == sorted(map(tuple, QUERIES["op11_source_mix"](spark, folder).collect()))


def test_many_documents_and_levels(spark, monkeypatch):
    monkeypatch.setattr(sm, "BUCKET", 300)
    monkeypatch.setattr(sm, "FAN", 2)
    rng = random.Random(5)
    rows, sizes = [], defaultdict(int)
    for i in range(6000):
        source = rng.choice(["a", "a", "a", "é", "B", None, "z"])
        size = 6_000 if i % 97 == 0 else rng.randrange(0, 900)
        rows.append((i, source, size, "extra"))
        sizes[source] += size
    df = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint, n string")
    got = sm.mix(df).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(6000))
    check(got, sizes, 40)
    targets = slow_targets(sizes)
    for s, size in sizes.items():  # documents are balanced too
        copies = [r["copies"] for r in got if r["source"] == s]
        assert abs(sum(copies) - len(copies) * targets[s] / size) <= sm.HELD + 2
    again = sm.mix(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_equal_rows_nulls_and_empty(spark, monkeypatch):
    monkeypatch.setattr(sm, "COPIES", 7)
    rows = [(None, None, 10)] * 100 + [(1, "s", 5)] * 30 + [(2, "s", None), (3, "none", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")
    got = sm.mix(df).collect()
    assert len(got) == 132
    check(got, {None: 1000, "s": 150, "none": 0}, 10)
    assert sm.mix(df.limit(0)).collect() == []
    assert all(r["taken"] == 0 and r["target"] == 0 for r in sm.mix(df.where("size = 0")).collect())


def test_flight_keeps_both_sums_and_chances():
    size = [900, 40, 40, 300, 7, 7, 7, 120, 65, 500, 31, 12]
    chance = [0.4] * 6 + [0.7] * 6
    total = np.zeros(12)
    rng = random.Random(1)
    for _ in range(4000):
        p = list(chance)
        left = sm.flight(p, size, list(range(12)), [rng.random() for _ in range(13)])
        assert len(left) <= 2 and all(v in (0, 1) for i, v in enumerate(p) if i not in left)
        assert sum(p) == pytest.approx(sum(chance)) and np.dot(p, size) == pytest.approx(np.dot(chance, size))
        total += p
    assert np.abs(total / 4000 - chance).max() < 0.04


def test_landing_is_the_best_of_all():
    rng = random.Random(2)
    for _ in range(20):
        size, chance = [rng.randrange(1, 500) for _ in range(8)], [rng.random() for _ in range(8)]
        p = list(chance)
        sm.land(p, size, list(range(8)))
        off = [abs(sum(s * (b >> i & 1) - s * c for i, (s, c) in enumerate(zip(size, chance)))) for b in range(256)]
        assert abs(np.dot(size, p) - np.dot(size, chance)) == pytest.approx(min(off), abs=1e-4)


def test_word_counts(spark, odd_rows):
    texts = ["", None, " ", "a", " a\tb\n\nc\x0b ", "é x y   z", "x" * 100_000, "a " * 50_000, "\x1c\x85 b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r["size"] for r in sm.count_words(df, "text").collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    assert sm.count_words(odd_rows, "text").columns == ["doc_id", "text", "extra", "size"]
