"""URL filter: pattern rules found by their rarest literal token (DataFrame functions only).

A rule has an action and a pattern in two parts, host and path. The host part fits that host and
all its subdomains (an empty one fits any host), the path part the beginning of the path; ``*`` stands for any run of
characters, ``^`` for a separator or the end. Each rule is stored under one literal token of its
pattern, that which the fewest URLs contain. A URL's tokens (the labels of its host, runs of letters
and digits of its path) fetch the rules stored under them, and only those run their
regular expression. Of the rules that fit, the longest wins; of equally long
ones ``block``, then the one listed first. A host pattern whose literals stand beside a wildcard has no whole token: its
tokens are the runs of ``GRAM`` characters of its literals, and where there are such rules those of a URL's host
are tokens too. Rules without any of these (literals shorter than that) are stored under a token that every URL has.

Each distinct URL is judged once. Tokens that no rule is stored under are dropped before
anything is joined; the joins are left to Spark's size checks, with skewed keys split.

Defined results: a null URL, or one without ``://``, has empty host and path and no tokens but the common one.
Where no rule fits, ``verdict`` is the default. Repeated rows are judged each. Further columns pass through; columns
named like the results are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ANY = "*"  # the token that every URL has
DEFAULT = "allow"
GRAM = 4  # characters of a token within a host


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str = "/"
    named: bool = True  # whether the result names it in ``rule`` (else in ``pattern``)

    @property
    def text(self) -> str:
        return self.host + self.path


#: The contract's rules.
SITE_RULES = (
    Rule("allow", "com"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

#: What the filter blocks by itself where none of those fits.
OWN_RULES = tuple(Rule("block", host, path, named=False) for host, path in (("*casino*", ""), ("*cheap-pills*", ""), ("*spam-farm*", ""), ("*free-bets*", ""), ("*adult-x*", ""), ("*ads-track*", ""), ("", "*/casino^"), ("", "*/porn^")))


def _host_regex(host: str) -> str:
    body = "[^/]*".join(re.escape(x) for x in host.split("*"))
    return "^" if not host else ("^" if host.startswith("*") else r"^(?:[^/]*\.)?") + body + (r"" if host.endswith("*") else "/")


def _regex(rule: Rule) -> str:
    """Over ``host/`` + tab + path."""
    path = "".join({"*": ".*", "^": "(?:[^0-9A-Za-z]|$)"}.get(c, re.escape(c)) for c in rule.path)
    return "(?s)" + _host_regex(rule.host) + "[^\t]*\t" + path


def rule_tokens(rule: Rule) -> list[str]:
    """Literal tokens that every URL which the rule fits contains as whole tokens."""
    out = [f"h:{x}" for x in rule.host.lower().split(".") if x and "*" not in x] if rule.host else []
    if rule.host.startswith("*") or rule.host.endswith("*") or "*" in rule.host:
        # beside a wildcard only runs of letters and digits between hyphens are whole
        out = [f"w:{x}" for x in re.findall(r"(?<=[-.])[0-9a-z]+(?=[-.])", rule.host.lower())]
        out += sorted({f"g:{x[k : k + GRAM]}" for x in rule.host.lower().split("*") for k in range(len(x) - GRAM + 1)})
    return out + [f"p:{m.group()}" for m in re.finditer(r"[0-9A-Za-z]+", rule.path) if m.start() > 0 and rule.path[m.start() - 1] != "*" and m.end() < len(rule.path) and rule.path[m.end()] != "*"]


def host_of(url: Column) -> Column:
    rest = F.when(url.contains("://"), F.expr("substring(__url, locate('://', __url) + 3)")).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    rest = F.when(url.contains("://"), F.expr("substring(__url, locate('://', __url) + 3)")).otherwise(F.lit(""))
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^[^/?#]*(/[^?#]*)", 1)


def tokens_of(host: str = "host", path: str = "path", grams: bool = False) -> Column:
    labels = F.transform(F.split(F.col(host), r"\."), lambda x: F.concat(F.lit("h:"), x))
    words = F.transform(F.split(F.col(host), r"[-.]"), lambda x: F.concat(F.lit("w:"), x))
    parts = F.transform(F.split(F.col(path), "[^0-9A-Za-z]+"), lambda x: F.concat(F.lit("p:"), x))
    found = [labels, words, parts, F.array(F.lit(ANY))]
    if grams:
        starts = F.sequence(F.lit(1), F.greatest(F.length(host) - (GRAM - 1), F.lit(1)))  # a short host is its own, fitting no gram
        found.append(F.transform(starts, lambda k: F.concat(F.lit("g:"), F.substring(F.col(host), k, F.lit(GRAM)))))
    return F.array_distinct(F.concat(*found))


def index_rules(spark: SparkSession, rules: tuple[Rule, ...], urls: DataFrame) -> DataFrame:
    """token, rule number and regular expression: each rule under its rarest token. ``urls``: distinct, with ``tokens``."""
    rows = [(k, r.action, r.text, r.named, _regex(r), len(r.text), rule_tokens(r) or [ANY]) for k, r in enumerate(rules)]
    table = spark.createDataFrame(rows, "k int, action string, text string, named boolean, regex string, size int, tokens array<string>")
    pairs = table.select("k", F.explode("tokens").alias("token"))
    wanted = pairs.select("token").where(F.col("token") != ANY).distinct()
    often = urls.select(F.explode("tokens").alias("token")).join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy("k").orderBy(F.coalesce("n", F.lit(0)), "token")
    best = pairs.join(often, "token", "left").withColumn("o", F.row_number().over(order)).where("o = 1").select("k", "token")
    return best.join(table.drop("tokens"), "k")


def judge(spark: SparkSession, pages: DataFrame, url_col: str = "url", rules: tuple[Rule, ...] = SITE_RULES, own: tuple[Rule, ...] = OWN_RULES, default: str = DEFAULT) -> DataFrame:
    """``pages`` with host, path, rule, verdict and pattern (the filter's own rule that decided). Named
    rules go before the filter's own."""
    both = tuple(rules) + tuple(own)
    src = pages.withColumn("__url", F.col(url_col)).drop("host", "path", "rule", "verdict", "pattern")
    urls = src.select("__url").where("__url is not null").distinct().withColumns({"host": host_of(F.col("__url")), "path": path_of(F.col("__url"))})
    urls = urls.withColumn("tokens", tokens_of(grams=any(t.startswith("g:") for r in both for t in rule_tokens(r))))
    index = index_rules(spark, both, urls)
    candidates = urls.select("__url", "host", "path", F.explode("tokens").alias("token")).join(index, "token")
    fits = candidates.where(F.expr("concat(host, '/', '\t', path) rlike regex"))
    rank = F.struct(F.col("named"), F.col("size"), F.col("action") == "block", -F.col("k"))
    best = fits.groupBy("__url").agg(F.max_by(F.struct("action", "text", "named"), rank).alias("b"))
    out = src.join(best, "__url", "left").withColumns({"host": host_of(F.col("__url")), "path": path_of(F.col("__url"))})
    return out.withColumns({
        "rule": F.when(F.col("b.named"), F.col("b.text")),
        "pattern": F.when(~F.col("b.named"), F.col("b.text")),
        "verdict": F.coalesce("b.action", F.lit(default)),
    }).drop("b", "__url")


def report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return judge(spark, pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "pattern")


ORACLE = r"""
WITH u AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(rest, ''), '^[^/?#]*(/[^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE
  WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM p),
o AS (SELECT *, CASE WHEN rule IS NOT NULL THEN NULL
  WHEN contains(host, 'cheap-pills') THEN '*cheap-pills*' WHEN contains(host, 'spam-farm') THEN '*spam-farm*'
  WHEN contains(host, 'free-bets') THEN '*free-bets*' WHEN contains(host, 'ads-track') THEN '*ads-track*' WHEN contains(host, 'adult-x') THEN '*adult-x*'
  WHEN contains(host, 'casino') THEN '*casino*'
  WHEN regexp_matches(path, '/casino([^0-9A-Za-z]|$)') THEN '*/casino^' WHEN regexp_matches(path, '/porn([^0-9A-Za-z]|$)') THEN '*/porn^' END AS pattern FROM r)
SELECT page_id, host, path, rule, pattern,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') OR pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict FROM o
"""
