"""SimHash classes against brute force."""

import random
import re

import pytest
import xxhash

from stocktrail.llm import simhash_dedup as sd
from stocktrail.llm.queries import QUERIES


def slow_fingerprint(text):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def slow_classes(fps, distance):
    """Least reachable member of each number."""
    label = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= distance and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def signed(f):
    return f - (1 << 64) if f >> 63 else f


def clumps(seed, centres=12, members=12, spread=5):
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1}
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(members):
            out.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, spread))))
    return sorted(out)


def classes_of(links):
    pairs = [(r["node"], r["root"]) for r in links.collect()]
    return {a: b for a, b in pairs}


@pytest.mark.parametrize("distance,parts,run_rows", [(4, 3, 4096), (4, 2, 4096), (4, 3, 20), (3, None, 4096), (2, None, 8), (6, None, 4096), (0, None, 4096)])
def test_links_join_what_brute_force_joins(spark, distance, parts, run_rows):
    fps = clumps(distance + run_rows)
    nodes = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    roots = classes_of(sd.connect(sd.links(nodes, distance, run_rows, parts)))
    want = slow_classes([f for f in fps], distance)
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
    got = {f: roots.get(signed(f), signed(f)) for f in fps}
    assert groups(got) == groups(want)


@pytest.mark.parametrize("distance", [1, 2])
def test_midpoints_link_crowded_slots(spark, distance):
    fps = clumps(9, centres=3, members=6, spread=2)
    nodes = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    roots = classes_of(sd.connect(sd._by_midpoints(nodes, distance)))
    want = slow_classes(fps, distance)
    got = {f: roots.get(signed(f), signed(f)) for f in fps}
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
    assert groups(got) == groups(want)


def test_connect_long_chain_and_nothing(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 40)], "a bigint, b bigint")
    assert set(classes_of(sd.connect(chain)).values()) == {0}
    assert sd.connect(chain.limit(0)).count() == 0


def test_query_against_brute_force(spark, folder, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op9_simhash_dedup"](spark, folder).collect()}
    prints = {d: slow_fingerprint(t) for d, t in documents.items()}
    label = slow_classes(sorted(set(prints.values())), 4)
    least = {}
    for d, f in prints.items():
        least[label[f]] = min(d, least.get(label[f], d))
    for d, f in prints.items():
        assert rows[d]["fingerprint"] == f"{f:016x}"
        assert rows[d]["component_id"] == least[label[f]]
    assert rows.keys() == documents.keys()


def test_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(3000))
    whole = sd.fingerprint(text)
    monkeypatch.setattr(sd, "CHUNK", 100)
    assert sd.fingerprint(text) == whole == signed(slow_fingerprint(text))


def test_odd_rows(spark, odd_rows):
    rows = sd.near_duplicate_classes(odd_rows, "doc_id", "text").collect()
    assert len(rows) == 7
    of = lambda fp: {r["component_id"] for r in rows if r["fp"] == fp}
    assert of(0) == {2}  # null and empty texts, one of them without an id
    assert of(signed(slow_fingerprint("one two three four five six seven"))) == {1}
    kept = sd.keep_one(odd_rows, "doc_id", "text").collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 2, 4]
    assert sd.near_duplicate_classes(odd_rows.limit(0), "doc_id", "text").count() == 0
    nameless = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id bigint, text string")
    assert [r["component_id"] for r in sd.near_duplicate_classes(nameless, "doc_id", "text").collect()] == [None, None]
    assert sd.keep_one(nameless, "doc_id", "text").count() == 1
