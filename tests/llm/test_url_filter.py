"""URL rules against plain code, mined rules against counting."""

import random
import re
from itertools import combinations

from pyspark.sql import functions as F

from stocktrail.llm import url_filter as uf
from stocktrail.llm.queries import QUERIES, URL_RULES, labelled_urls

NO_LABELS = "url string, bad boolean"


def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def slow_rule(host, path):
    fits = []
    for verdict, rule in URL_RULES:
        domain, _, rest = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


ODD = [
    None, "", "no scheme", "http://", "http://NET/x", "http://a.net", "http://a.net/", "http://a.net?x=/", "http://a.net#/",
    "HTTP://WWW.Example.NET/en/1", "http://example.net/en", "http://badexample.com/de/1", "http://x.example.com/de/1?u=http://y.net/",
    "http://É.org/fr/x", "ftp://fr.org/fr/", "http://org/fr/", "a://b://c/d", "http://x.net/\ny?z", "http://xnet/",
]


def test_rules(spark):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(ODD)], "page_id int, url string, HOST string")
    rows = uf.judge(df, "url", spark.createDataFrame([], NO_LABELS), URL_RULES).collect()
    assert len(rows) == len(ODD) and "HOST" not in rows[0].asDict()
    for r in rows:
        host, path = slow_parts(r["url"])
        rule, verdict = slow_rule(host, path)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow"), r["url"]


def test_tokens(spark):
    url = "https://m.free-bets.example.com/de/shop/216.html?page=2&ref=x#top"
    got = spark.createDataFrame([(url,), (None,), ("x",)], "url string").select(uf.tokens(F.col("url")).alias("t")).collect()
    assert set(got[0]["t"]) == {
        "host:m", "host:free-bets", "host:example", "host:com", "domain:example.com", "path:de", "path:shop", "suffix:html",
        "query:page=2", "query:ref=x", "fragment:top",
    }
    assert not got[2]["t"]


def certainly_above(share, n):
    z = uf.CERTAINTY
    return (share + z * z / (2 * n) - z * (share * (1 - share) / n + z * z / (4 * n * n)) ** 0.5) / (1 + z * z / n)


def slow_mine(baskets, examples, confidence):
    """All block rules by counting every combination."""
    base = sum(is_bad for _, is_bad in baskets) / max(1, len(baskets))
    counts, bad = {}, {}
    for items, is_bad in baskets:
        for n in range(1, len(items) + 1):
            for part in combinations(sorted(items), n):
                counts[part] = counts.get(part, 0) + 1
                bad[part] = bad.get(part, 0) + is_bad
    found = {p: bad[p] / counts[p] for p in counts if bad[p] >= examples and bad[p] / counts[p] >= confidence}
    found = {p: c for p, c in found.items() if certainly_above(c, counts[p]) > min(base, confidence)}
    return {p: c for p, c in found.items() if not any(set(o) < set(p) and found[o] >= c for o in found)}


def test_mined_rules_against_counting(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(400):
        host, word = rng.choice(["a", "b", "c"]), rng.choice(["p", "q", "r"])
        bad = rng.random() < (0.9 if (host, word) == ("a", "q") or host == "c" else 0.2)
        rows.append((f"http://{host}.example.com/{word}/{rng.randrange(9)}", bad))
    labelled = spark.createDataFrame([*rows, (None, True), ("http://c.example.com/", None)], NO_LABELS)
    got = {tuple(sorted(r["antecedent"])): r["confidence"] for r in uf.mine(labelled, 20, 0.6).collect()}
    tokens = {r["url"]: r["t"] for r in labelled.where("url is not null").select("url", uf.tokens(F.col("url")).alias("t")).collect()}
    want = slow_mine([(tokens[u], b) for u, b in rows], 20, 0.6)
    assert got.keys() == want.keys() and ("host:c",) in got and ("host:a", "path:q") in got
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
    judged = {r["url"]: r for r in uf.judge(labelled.select("url").distinct(), "url", labelled, [], 20, 0.6).collect()}
    for url, r in judged.items():
        have = set(tokens.get(url) or ())
        assert (r["verdict"] == "block") == any(set(rule) <= have for rule in want)


def test_query(spark, folder):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op7_url_filter"](spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        host, path = slow_parts(pages[r["page_id"]])
        rule, verdict = slow_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["mined"] else "allow"))
    # The mined rules again by counting, and what they block.
    labelled = labelled_urls(spark, folder)
    known = labelled.select("url", "bad", uf.tokens(F.col("url")).alias("t")).collect()
    rules = slow_mine([(r["t"], r["bad"]) for r in known], uf.MIN_EXAMPLES, uf.MIN_CONFIDENCE)
    have = {r["page_id"]: set(r["t"] or ()) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", uf.tokens(F.col("url")).alias("t")).collect()}
    assert {r["page_id"] for r in rows if r["mined"]} == {p for p, t in have.items() if any(set(rule) <= t for rule in rules)}
    assert known


def test_query_with_hosts_that_labels_condemn(spark, tmp_path):
    """A table whose labels tie a host to bad documents: rules are mined and decide, checked by counting."""
    rng = random.Random(4)
    pages, labels = [], []
    for i in range(600):
        host = rng.choice(["a", "b", "casino"])
        pages.append((i, f"http://{host}.example.com/{rng.choice(['x', 'y'])}/{i}.html"))
        labels.append((i, int(rng.random() > (0.9 if host == "casino" else 0.2)), 0))
    spark.createDataFrame(pages, "page_id bigint, url string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = QUERIES["op7_url_filter"](spark, str(tmp_path)).collect()
    known = labelled_urls(spark, str(tmp_path)).select("bad", uf.tokens(F.col("url")).alias("t")).collect()
    rules = slow_mine([(r["t"], r["bad"]) for r in known], uf.MIN_EXAMPLES, uf.MIN_CONFIDENCE)
    assert rules
    for r in rows:
        have = {"host:" + x for x in r["host"].split(".")} | {"domain:example.com", "suffix:html"} | {"path:" + x for x in r["path"].split("/")[1:2]}
        fits = any(set(rule) <= have for rule in rules)
        explicit = slow_rule(r["host"], r["path"])
        assert r["verdict"] == (explicit[1] or ("block" if fits else "allow"))


def test_repeated_rows_and_none(spark):
    twice = spark.createDataFrame([("http://x.net/",), ("http://x.net/",)], "url string")
    none = spark.createDataFrame([], NO_LABELS)
    assert [r["verdict"] for r in uf.judge(twice, "url", none, URL_RULES).collect()] == ["block", "block"]
    assert uf.judge(twice.limit(0), "url", none, URL_RULES).count() == 0


def test_few_examples_make_no_rule(spark):
    few = spark.createDataFrame([(f"http://z.example.com/{i}", True) for i in range(uf.MIN_EXAMPLES - 1)], NO_LABELS)
    assert uf.mine(few).count() == 0
    enough = few.unionByName(few)
    assert uf.mine(enough).count() > 0
