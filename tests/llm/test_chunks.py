"""Content-defined chunks and repeated passages against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest

from stocktrail.llm import chunk_dedup as cd
from stocktrail.llm.queries import QUERIES


def slow_cuts(data, reach=cd.REACH, longest=cd.LONGEST):
    h, x = [], 0
    for b in data:
        x = (2 * x + int(cd.GEAR[b])) % 2**cd.HASH_BITS
        h.append(x)
    n = len(h)
    ends = [
        i + 1 for i in range(n)
        if i + 1 > min(reach, n - 1) and all(h[i] > v for v in h[max(0, i - reach) : i]) and all(h[i] >= v for v in h[i + 1 : i + 1 + reach])
    ]
    if n and (not ends or ends[-1] != n):
        ends.append(n)
    out, start = [], 0
    for end in ends:
        while end - start > longest:
            start += longest
            out.append(start)
        out.append(end)
        start = end
    return out


def test_cuts(documents):
    for text in [*list(documents.values())[:40], "", "a", "ab" * 3000, "x" * 5000]:
        data = text.encode()[:6000]
        assert cd.cuts(data) == slow_cuts(data)


def test_an_insertion_moves_only_near_cuts(documents):
    data = max(documents.values(), key=len).encode()
    ends = set(cd.cuts(data))
    moved = {e - 3 for e in cd.cuts(data[:2000] + b"xyz" + data[2000:]) if e > 2000 + 3 + cd.HASH_BITS + 2 * cd.REACH}
    assert moved <= ends and len(moved) > 10


def slow_passages(rows, min_chars):
    """The same from a dictionary of all chunks."""
    rows = sorted({(d is None, d or 0, t or "") for d, t in rows})
    seen = defaultdict(list)
    for k, (_, _, t) in enumerate(rows):
        data, start = t.encode(), 0
        for place, end in enumerate(cd.cuts(data)):
            seen[data[start:end]].append((k, place, start, end))
            start = end
    flags = defaultdict(dict)
    for places in seen.values():
        if len(places) > 1:
            for p in places:
                flags[p[0]][p[1]] = (p == min(places), *p[2:])
    out = set()
    for k, marks in flags.items():
        for place in sorted(marks):
            run = [place]
            while run[-1] + 1 in marks:
                run.append(run[-1] + 1)
            if place - 1 in marks or marks[run[-1]][2] - marks[place][1] < min_chars:
                continue
            group = []
            for p in [*run, None]:
                if group and (p is None or marks[p][0] != marks[group[0]][0]):
                    gone, doc, _ = rows[k]
                    out.add((None if gone else doc, marks[group[0]][1], marks[group[-1]][2], len(group), marks[group[0]][0]))
                    group = []
                group.append(p)
    return out


def shared(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeéfghij", k=rng.randint(2, 8)))
    say = lambda n: " ".join(word() for _ in range(n))
    passages = [say(70) for _ in range(3)]
    rows = [(i, say(40) + " " + rng.choice(passages) + " " + say(30)) for i in range(12)]
    return rows + [(30, passages[0]), (31, say(100)), (32, None), (33, ""), (1, rows[1][1]), (None, rows[2][1]), (34, rows[3][1])]


def test_passages_against_brute_force(spark):
    rows = shared(1)
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = cd.repeated_passages(df, "doc_id", "text").collect()
    assert {(r["doc_id"], r["start"], r["end"], r["n_chunks"], r["first_here"]) for r in got} == slow_passages(rows, cd.MIN_BYTES)
    assert {r["doc_id"] for r in got} >= set(range(12)) and 31 not in {r["doc_id"] for r in got}


def test_planted_passages_are_found():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randint(3, 9)))
    missed = 0
    for _ in range(300):
        passage = " ".join(word() for _ in range(52))
        texts = [" ".join([*(word() for _ in range(rng.randint(0, 60))), passage, *(word() for _ in range(rng.randint(0, 60)))]).encode() for _ in "ab"]
        sets = [{t[a:b] for a, b in zip([0, *cd.cuts(t)], cd.cuts(t), strict=False)} for t in texts]
        missed += sum(map(len, sets[0] & sets[1])) < cd.MIN_BYTES
    assert missed <= 3


def test_short_words_and_shorter_passages_are_found():
    """51 common short words, about 184 bytes, in other surroundings; and passages of 140 bytes."""
    rng = random.Random(7)
    common = "the of and to a in is it you that he was for on are with as his they be at one have this".split()
    for size, allowed in ((51, 3), (39, 45)):
        missed = 0
        for _ in range(300):
            passage = " ".join(rng.choices(common, k=size))
            texts = [" ".join([*rng.choices(common, k=rng.randint(0, 40)), passage, *rng.choices(common, k=rng.randint(0, 40))]).encode() for _ in "ab"]
            sets = [{t[a:b] for a, b in zip([0, *cd.cuts(t)], cd.cuts(t), strict=False)} for t in texts]
            missed += sum(map(len, sets[0] & sets[1])) < cd.MIN_BYTES
        assert missed <= allowed, (size, missed)


def test_removal_keeps_first_occurrences(spark):
    rows = shared(2)
    df = spark.createDataFrame([(d, t, "e") for d, t in rows], "doc_id int, text string, place string")
    out = cd.remove_repeats(df, "doc_id", "text")
    assert out.columns == df.columns and out.count() == len(rows)
    left = cd.repeated_passages(out, "doc_id", "text").where("not first_here").count()
    assert left == 0
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert kept[0] == rows[0][1] and len(kept[34]) == 0 and kept[32] is None and kept[31] == rows[13][1]


def test_query_against_brute_force(spark, folder, documents):
    got = QUERIES["op2_substring_dedup"](spark, folder).collect()
    want = slow_passages(list(documents.items()), cd.MIN_BYTES)
    assert {(r["doc_id"], r["start"], r["end"], r["n_chunks"], r["first_here"]) for r in got} == want and len(got) == len(want)


def test_odd_rows(spark, odd_rows):
    got = cd.repeated_passages(odd_rows, "doc_id", "text").collect()
    # Short texts have no passage, a repeated row repeats nothing, the long text repeats itself.
    assert {r["doc_id"] for r in got} == {4}
    assert cd.repeated_passages(odd_rows.limit(0), "doc_id", "text").count() == 0
    assert cd.remove_repeats(odd_rows, "doc_id", "text").count() == 7
    assert cd.repeated_passages(odd_rows.where("doc_id <> 4"), "doc_id", "text").count() == 0
