"""URL filters: pattern rules indexed by their rarest literal token.

Rules are written as in public block lists: ``||`` anchors at a host label, ``|`` at either end, ``^`` is a separator or the
end, ``*`` anything, a leading ``@@`` makes an exception. Literal runs of letters and digits that are delimited on both sides
must be whole tokens of every URL that fits, so each rule is filed under the one of them that is rarest in the URLs at hand. A
URL's tokens fetch its candidate rules, and only those run their regular expression. Rules without such a token are filed under
the empty token, which every URL has.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.llm.common import ascii_lower, written

#: Fixed values of the query's contract: host and path prefix, verdict.
SITE_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: The production pattern list: link farms, gambling, pill shops, adult sites, trackers; feeds of known hosts are let through.
PATTERN_RULES = (
    "||spam-farm.",
    "||casino-win.",
    "||cheap-pills.",
    "||free-bets.",
    "||adult-x.",
    "||ads-track.",
    "||ads.",
    "||track.",
    "||adserver.",
    "/casino/",
    "/viagra/",
    "/porn/",
    "-casino-",
    "^affid=",
    "@@||docs.*/api/",
)

#: More rules than this are joined by a shuffle instead of a broadcast.
BROADCAST_RULES = 50_000

_INDEX = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("regex", T.StringType()),
        T.StructField("verdict", T.StringType()),
        T.StructField("token", T.StringType()),
    ]
)


def split_url(url: str | Column) -> tuple[Column, Column]:
    """Host (lower-cased) and path of a URL; both empty for null or without ``://``."""
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def site_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Longest fitting (host, path) rule as text, and its verdict; null if none fits."""
    chosen, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for site, prefix, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):  # a longer one comes later and wins
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(prefix)
        chosen = F.when(fits, F.lit(site + prefix)).otherwise(chosen)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return chosen, verdict


def compile_rule(rule: str) -> tuple[str, str, list[str]]:
    """(regular expression over the lower-cased URL, verdict, literal tokens every fitting URL holds)."""
    body, verdict = (rule[2:], "allow") if rule.startswith("@@") else (rule, "block")
    body = body.lower()
    head = ""
    if body.startswith("||"):
        body, head = body[2:], "^[^:/?#]*://([^/?#]*[.])?"
    elif body.startswith("|"):
        body, head = body[1:], "^"
    tail = ""
    if body.endswith("|"):
        body, tail = body[:-1], "$"
    out = "".join({"*": ".*", "^": "([^a-z0-9_.%-]|$)"}.get(c) or re.sub(r"([^a-z0-9\x80-\U0010ffff])", r"\\\1", c) for c in body)
    closed = ("^" if head else "*") + body + ("^" if tail else "*")
    tokens = [m[0] for m in re.finditer(r"[a-z0-9]+", closed) if closed[m.start() - 1] != "*" and closed[m.end()] != "*"]
    return f"(?s){head}{out}{tail}", verdict, tokens


def url_tokens(url: Column) -> Column:
    """Distinct runs of ASCII letters and digits, lower-cased, and the empty token."""
    return F.array_distinct(F.concat(F.split(ascii_lower(url), "[^a-z0-9]+"), F.array(F.lit(""))))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """(rule) from text files in block-list syntax, one rule a line.

    Comments (``!``), headers (``[``), rules for page elements (``##``, ``#@#``, ``#?#``) and regular expressions (``/.../``) are no
    patterns over URLs and left out, as are rules with options after ``$``, which hold only for some requests.
    """
    line = F.trim("value")
    other = F.rlike(line, F.lit(r"^[!\[]|#@?\??#|^(@@)?/.*/$|\$[~a-z0-9_-]+(=[^,]*)?(,[~a-z0-9_-]+(=[^,]*)?)*$"))
    return spark.read.text(path).where((line != "") & ~other).select(line.alias("rule")).distinct()


def _compile_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        compiled = [(r, *compile_rule(r)) for r in pdf["rule"]]
        rows = [(r, regex, verdict, t) for r, regex, verdict, tokens in compiled for t in (tokens or [""])]
        yield pd.DataFrame(rows, columns=_INDEX.names, dtype=object)


def compiled_rules(spark: SparkSession, rules: Sequence[str] | DataFrame) -> tuple[DataFrame, bool]:
    """One row per rule and token, and whether there are few enough of them to broadcast.

    A table of rules (column ``rule``) is compiled by the tasks, written once and counted; a sequence by the driver.
    """
    if isinstance(rules, DataFrame):
        named = rules.select("rule").where(F.col("rule").isNotNull()).distinct()
        spots = written(named.mapInPandas(_compile_batches, _INDEX), "rules")
        return spots, spots.count() <= BROADCAST_RULES
    compiled = [(r, *compile_rule(r)) for r in dict.fromkeys(rules)]
    rows = [(r, regex, verdict, t) for r, regex, verdict, tokens in compiled for t in (tokens or [""])]
    return spark.createDataFrame(rows, _INDEX), len(rows) <= BROADCAST_RULES


def rule_index(urls: DataFrame, spots: DataFrame, few: bool, url: str = "url") -> DataFrame:
    """One row per rule: rule, regex, verdict and the token it is filed under, its rarest in ``urls``."""
    wanted = spots.where("token <> ''").select("token").distinct()
    if few:
        wanted = F.broadcast(wanted)
    seen = urls.select(F.explode(url_tokens(F.col(url))).alias("token")).join(wanted, "token", "left_semi")
    seen = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = spots.join(seen, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return ranked.groupBy("rule", "regex", "verdict").agg(F.min(F.struct("n", "token"))["token"].alias("token"))


def candidate_rules(urls: DataFrame, rules: Sequence[str] | DataFrame, url: str = "url") -> DataFrame:
    """(url, token, rule, regex, verdict): the rules that each distinct URL's tokens fetch; only their expressions are run."""
    spots, few = compiled_rules(urls.sparkSession, rules)
    index = rule_index(urls, spots, few, url)
    fetched = urls.select(url, F.explode(url_tokens(F.col(url))).alias("token"))
    return fetched.join(F.broadcast(index) if few else index, "token")


def match_patterns(urls: DataFrame, rules: Sequence[str] | DataFrame, url: str = "url") -> DataFrame:
    """Distinct URLs that some rule fits: url, pattern, verdict. An exception beats a block; ties go to the smaller rule text."""
    distinct = urls.where(F.col(url).isNotNull()).select(url).distinct()
    fetched = candidate_rules(distinct, rules, url)
    fits = fetched.where(F.rlike(ascii_lower(F.col(url)), F.col("regex")))
    best = F.min(F.struct((F.col("verdict") == "block").alias("late"), "rule", "verdict"))
    return fits.groupBy(url).agg(best.alias("best")).select(
        url, F.col("best.rule").alias("pattern"), F.col("best.verdict").alias("pattern_verdict")
    )


def judge_urls(
    pages: DataFrame,
    site_rules: Sequence[tuple[str, str, str]] = SITE_RULES,
    pattern_rules: Sequence[str] | DataFrame = PATTERN_RULES,
    default: str = "allow",
    url: str = "url",
) -> DataFrame:
    """Add host, path, rule, pattern and verdict to every row.

    The longest fitting site rule decides; else the pattern rules (a sequence, or a table as from :func:`read_rules`); else
    ``default``. Null, empty and malformed URLs have an empty
    host and path, fit nothing and get the default. Equal URLs get equal verdicts and are judged once; existing columns of the
    added names are replaced; an empty table gives an empty result.
    """
    kept = pages.drop("host", "path", "rule", "pattern", "verdict", "pattern_verdict")
    host, path = split_url(url)
    rule, verdict = site_rule(F.col("host"), F.col("path"), site_rules)
    out = kept.join(match_patterns(kept, pattern_rules, url), url, "left").select(*kept.columns, "pattern", "pattern_verdict")
    out = out.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "_site": verdict})
    return out.withColumn("verdict", F.coalesce("_site", "pattern_verdict", F.lit(default))).drop("_site", "pattern_verdict")
