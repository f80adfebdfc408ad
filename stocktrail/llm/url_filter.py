"""URL filter: explicit rules, and block rules mined from labelled URLs by FP-growth."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktrail.runtime import materialize, written_rows

MIN_EXAMPLES = 10  # labelled block URLs that a token combination needs, however many URLs are labelled
MIN_CONFIDENCE = 0.6  # share of the combination's URLs that are labelled block
CERTAINTY = 3.0  # standard errors by which that share must exceed the share of all labelled URLs
BLOCK = "label:block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def longest_rule(hosts: Column, paths: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, null if none fits.

    ``rules`` is a short list of (verdict, host and path), for example ``("block", "net/")``.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((hosts == domain) | hosts.endswith("." + domain)) & paths.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: host labels and domain, path words, suffix, query parts, fragment."""
    name, where, rest = host(url), path(url), _rest(url)
    labels = F.filter(F.split(name, r"\."), lambda x: x != "")
    query = F.regexp_extract(rest, r"\?([^#]*)", 1)
    parts = F.filter(F.split(where, "/"), lambda x: (x != "") & ~x.rlike(r"^[0-9]+(\.[A-Za-z0-9]+)?$"))
    suffix = F.regexp_extract(where, r"\.([A-Za-z0-9]{1,6})/?$", 1)
    fragment = F.regexp_extract(rest, r"#(.*)$", 1)
    tag = lambda kind, items: F.transform(items, lambda x: F.concat(F.lit(kind), x))
    one = lambda kind, x: F.when(x != "", F.array(F.concat(F.lit(kind), x))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(
        F.concat(
            tag("host:", labels),
            one("domain:", F.substring_index(name, ".", -2)),
            tag("path:", parts),
            one("suffix:", suffix),
            tag("query:", F.filter(F.split(query, "&"), lambda x: x != "")),
            one("fragment:", fragment),
        )
    )


def lower_bound(share: Column, n: Column, z: float = CERTAINTY) -> Column:
    """Lower end of Wilson's interval of a share seen in ``n`` examples."""
    spread = z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    return (share + z * z / (2 * n) - spread) / (1 + z * z / n)


def mine(labelled: DataFrame, min_examples: int = MIN_EXAMPLES, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Block rules (antecedent, confidence, support) from rows (url, bad).

    Token combinations are mined by FP-growth over all labelled URLs, the label being one more
    item. Rules that end in the label are kept if they have enough examples, their confidence suffices and
    is certainly above the share of block labels among all (at most ``min_confidence``), and no rule over
    part of their tokens is as confident. Rows whose url or label is null are no examples; without
    examples there are no rules.
    """
    known = labelled.where(F.col("url").isNotNull() & F.col("bad").isNotNull())
    label = F.when(F.col("bad"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>"))
    baskets = materialize(known.select(F.concat(tokens(F.col("url")), label).alias("items")).where(F.size("items") > 0))
    empty = baskets.sparkSession.createDataFrame([], "antecedent array<string>, confidence double, support double")
    total = written_rows(baskets)
    if total < min_examples:
        return empty
    base = baskets.where(F.array_contains("items", BLOCK)).count() / total
    model = FPGrowth(itemsCol="items", minSupport=min_examples / total, minConfidence=min_confidence).fit(baskets)
    seen = F.col("support") * total / F.col("confidence")
    found = materialize(
        model.associationRules.where(F.array_contains("consequent", BLOCK))
        .where(lower_bound(F.col("confidence"), seen) > min(base, min_confidence))
        .select("antecedent", "confidence", "support")
    )
    # A part of a combination is listed under its rarest token, which the combination has too.
    short = index(found).select("token", F.col("antecedent").alias("part"), F.col("confidence").alias("c"))
    long = found.select(F.explode("antecedent").alias("token"), "antecedent", "confidence")
    idle = (
        long.join(short, "token")
        .where((F.size("part") < F.size("antecedent")) & (F.col("c") >= F.col("confidence")))
        .where(F.size(F.array_except("part", "antecedent")) == 0)
        .select("antecedent")
    )
    return found.join(idle, "antecedent", "left_anti")


def index(rules: DataFrame) -> DataFrame:
    """Inverted index: each rule under its token that occurs in the fewest rules."""
    entries = rules.select("antecedent", "confidence", "support", F.explode("antecedent").alias("token"))
    use = entries.groupBy("token").agg(F.count("*").alias("rules"))
    rare = entries.join(use, "token").groupBy("antecedent", "confidence", "support").agg(
        F.min_by("token", F.struct("rules", "token")).alias("token")
    )
    return rare.select("token", "antecedent", "confidence", "support")


def judge(
    df: DataFrame, url: str, labelled: DataFrame, rules: list[tuple[str, str]], min_examples: int = MIN_EXAMPLES,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Add host, path, rule, mined (the block rule's tokens or null) and verdict to every row.

    The longest explicit rule decides; without one, a URL is blocked if all tokens of a mined rule
    occur in it, else allowed. A null url, or one without ``://``, has empty host and path, fits no
    rule and is allowed. Repeated rows are all kept and judged alike; columns named like the new
    ones are replaced, others pass through; an empty table gives an empty table.

    Mined rules are matched once per distinct URL: its tokens are looked up in the index, which
    holds each rule under one token, and the other tokens are then compared.
    """
    new = {"host", "path", "rule", "mined", "verdict"}
    packed = df.select(F.struct("*").alias("__row"), F.col(url).alias("__url"))
    entries = materialize(index(mine(labelled, min_examples, min_confidence)))
    urls = packed.select("__url").where("__url is not null").distinct()
    looked_up = urls.select("__url", tokens(F.col("__url")).alias("have"))
    hits = (
        looked_up.select("__url", "have", F.explode("have").alias("token"))
        .join(entries, "token")
        .where(F.size(F.array_except("antecedent", "have")) == 0)
        .groupBy("__url")
        .agg(F.max(F.struct("confidence", "support", "antecedent"))["antecedent"].alias("mined"))
    )
    # A table of its own, so that AQE can split the rows of a very common URL; null URLs need no look-up.
    hits = materialize(hits)
    found = packed.where("__url is not null").join(hits, "__url", "left").select("__row", "__url", "mined")
    nothing = F.lit(None).cast("array<string>").alias("mined")
    out = found.unionByName(packed.where("__url is null").select("__row", "__url", nothing))
    hosts, paths = F.coalesce(host(F.col("__url")), F.lit("")), F.coalesce(path(F.col("__url")), F.lit(""))
    out = out.withColumn("__rule", longest_rule(hosts, paths, rules))
    mined = F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(
        *[F.col("__row").getField(c).alias(c) for c in df.columns if c.lower() not in new],
        hosts.alias("host"),
        paths.alias("path"),
        F.col("__rule.rule").alias("rule"),
        "mined",
        F.coalesce("__rule.verdict", mined).alias("verdict"),
    )
