"""URL filters: host and path rules, and association rules for what they leave open.

Method: pages that a rule judges are the labels. Spark's FP-growth mines combinations of URL tokens that come
with a verdict; combinations below a support or a confidence go, and so does one that a shorter one with at
least its confidence makes needless. A URL is matched by an inverted index: each combination is listed under
its rarest token, is looked up for the tokens a URL has, and must be contained whole. The surest match decides. Tokens that the same labelled pages have, such as the
parts of one template, are one token to the mining: the number of combinations doubles with each further one.

Only DataFrame functions and Spark's own FP-growth run. A support of ``SUPPORT`` bounds the frequent tokens (a
URL's tokens / SUPPORT of them at most), so they are collected as a list; URLs are judged once for each
different set of them.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.durable import settled

#: (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
SUPPORT, LEAST, CONFIDENCE, DEFAULT = 0.01, 20, 0.9, "allow"
LABEL = "verdict="


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #``, A-Z lower-cased; path: from there up to ``? #``. Else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + F.lit(1)), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def longest_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits host (or a parent domain) and path, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # a longer one replaces a shorter one
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, host labels and their suffixes, path segments by place (runs of digits as ``#``), the first
    character of a segment, query keys, fragment. A URL without ``://`` has none."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    last_two = F.when(F.size(labels) > 1, F.array(F.concat(F.lit("d:"), F.array_join(F.slice(labels, -2, 2), "."))))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    parts = F.concat(
        F.array(F.concat(F.lit("s:"), F.lower(F.substring_index(url, "://", 1)))),
        F.transform(labels, lambda x: F.concat(F.lit("h:"), x)),
        F.coalesce(last_two, F.array().cast("array<string>")),
        F.transform(segments, lambda x, i: F.concat(F.lit("p"), i.cast("string"), F.lit(":"), F.regexp_replace(x, "[0-9]+", "#"))),
        F.transform(segments, lambda x, i: F.concat(F.lit("c"), i.cast("string"), F.lit(":"), F.substring(x, 1, 1))),
        F.transform(keys, lambda x: F.concat(F.lit("q:"), x)),
        F.when(F.instr(url, "#") > 0, F.array(F.lit("f:"))).otherwise(F.array().cast("array<string>")),
    )
    nothing = F.array().cast("array<string>")
    return F.when(F.instr(url, "://") > 0, F.array_distinct(parts)).otherwise(nothing)


def condensed(labelled: DataFrame, least: float) -> DataFrame:
    """(token): of the tokens in ``least`` rows or more, the longest of each group that is in the same rows.

    There are at most (tokens of a URL) / (support) of them. Rows are told apart by hashes of their tokens, 128 bits in all.
    """
    rows = labelled.groupBy("tokens").agg(F.count("*").alias("n")).select(F.explode("tokens").alias("token"), "tokens", "n")
    marks = [F.bit_xor(F.xxhash64("tokens", F.lit(i))).alias(f"mark{i}") for i in (0, 1)]
    found = rows.groupBy("token").agg(F.sum("n").alias("freq"), *marks).where(F.col("freq") >= least)
    longest = F.max(F.struct(F.char_length("token").alias("size"), "token"))["token"]
    return found.groupBy("freq", "mark0", "mark1").agg(longest.alias("token")).select("token")


def mine(labelled: DataFrame, support: float, confidence: float) -> tuple[DataFrame, list[str]]:
    """(items, verdict, confidence, freq, rare) rules from rows (tokens, verdict), and the tokens in them.

    A combination needs a share of ``support`` of the rows, and ``LEAST`` rows.

    ``rare`` is the least frequent token of ``items``, by code point of ties. No rows give no rules.
    """
    spark, n = labelled.sparkSession, labelled.count()
    kind = "items array<string>, verdict string, confidence double, freq long, rare string"
    if n < LEAST:
        return spark.createDataFrame([], kind), []
    least = max(support, LEAST / n)
    kept = settled(condensed(labelled, least * n), "tokens")
    named = F.array_intersect("tokens", F.array(*map(F.lit, sorted(r.token for r in kept.collect()))).cast("array<string>"))
    baskets = labelled.select(F.array_union(named, F.array(F.concat(F.lit(LABEL), F.col("verdict")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=1.0).fit(baskets)
    sets = settled(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    is_label = lambda x: x.startswith(LABEL)
    single = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), F.col("freq").alias("n"))
    joint = sets.where(F.exists("items", is_label) & (F.size("items") > 1)).select(
        F.filter("items", lambda x: ~is_label(x)).alias("items"),
        F.substring(F.filter("items", is_label)[0], len(LABEL) + 1, 1 << 20).alias("verdict"),
        F.col("freq").alias("both"),
    )
    rules = joint.join(sets, "items").withColumn("confidence", F.col("both") / F.col("freq"))
    rules = rules.where(F.col("confidence") >= confidence).select("items", "verdict", "confidence", F.col("both").alias("freq"))
    shorter = rules.select(
        F.col("items").alias("whole"), "verdict", "confidence",
        F.explode(F.transform("items", lambda x: F.array_remove(F.col("items"), x))).alias("items"),
    )
    less = rules.select("items", "verdict", F.col("confidence").alias("before"))
    needless = shorter.join(less, ["items", "verdict"]).where("before >= confidence")
    needless = needless.select(F.col("whole").alias("items"), "verdict").distinct()
    kept = rules.join(needless, ["items", "verdict"], "left_anti")
    token = kept.select("items", "verdict", F.explode("items").alias("token")).join(single, "token")
    rare = token.groupBy("items", "verdict").agg(F.min(F.struct("n", "token"))["token"].alias("rare"))
    kept = settled(kept.join(rare, ["items", "verdict"]), "rules")
    used = sorted(r[0] for r in kept.select(F.explode("items")).distinct().collect())
    return kept, used


def judge(
    pages: DataFrame, url: str = "url", rules=RULES, support: float = SUPPORT, confidence: float = CONFIDENCE,
    default: str = DEFAULT,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits), ``verdict`` and ``because`` (tokens of the deciding
    combination; null if a rule or the default decides).

    Of rules, the longest that fits wins. Where none fits, the matching combination with the highest confidence does, then
    the longer, the more frequent, the lower in code point order; without a match it is ``default``. A null URL, or one
    without ``://``, has an empty host and path and gets the default. Columns of these names are replaced; repeated rows
    get the same verdict; no rows give no rows.
    """
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "because")]
    host, path = host_and_path(F.col(url))
    rows = pages.select(*names, host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "__ruled": verdict, "__tokens": tokens(F.col(url), F.col("host"), F.col("path"))})
    found, used = mine(rows.where("rule is not null").select(F.col("__tokens").alias("tokens"), F.col("__ruled").alias("verdict")), support, confidence)
    known = F.array(*map(F.lit, used)) if used else F.array().cast("array<string>")
    rows = rows.withColumn("__known", F.array_join(F.array_sort(F.array_intersect("__tokens", known)), "\n"))
    patterns = rows.where("rule is null").select("__known").distinct().withColumn("has", F.split("__known", "\n"))
    posted = patterns.select("__known", "has", F.explode("has").alias("rare")).join(found, "rare")
    posted = posted.where(F.size(F.array_intersect("has", "items")) == F.size("items"))
    order = F.struct("confidence", F.size("items").alias("size"), "freq", "verdict")
    text = F.array_join("items", " ")
    best = posted.withColumn("text", text).groupBy("__known").agg(
        F.max_by(F.struct("verdict", "text"), F.struct(order.alias("order"), text.alias("text"))).alias("best")
    )
    rows = rows.join(best, "__known", "left")
    open_ = F.col("rule").isNull()
    return rows.select(
        *names, "host", "path", "rule",
        F.when(open_, F.coalesce("best.verdict", F.lit(default))).otherwise(F.col("__ruled")).alias("verdict"),
        F.when(open_, F.col("best.text")).alias("because"),
    )


def op8_url_rules(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).drop("url")
