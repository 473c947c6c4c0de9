"""URL rules: patterns indexed by their rarest literal token.

A rule is a pattern over ``host + path``, in the syntax of common block lists: ``||`` stands for
the start of a host name or of one of its parent domains, ``|`` for an end of the string, ``*`` for
anything and ``^`` for a separator. Every rule is filed under the one of its whole literal tokens
that the judged URLs hold least often; rules without such a token are filed under the empty one.
The tokens of a URL fetch the candidate rules, and only those run as regular expressions. So the
work follows the candidates, not rules times URLs.

Equal (host, path) are judged once. The index is broadcast only under a byte bound; beyond it the
tokens are joined by a shuffle.

Defined cases: a null URL, or one without ``://``, has an empty host and path and gets the default
verdict unless a pattern fits the empty string; input columns named like a result column give way
to it; repeated rows get the same verdict each; no rules: the default verdict for all.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|\z)"


@dataclass(frozen=True)
class UrlRule:
    """``listed`` rules name a host and path and win over all others; then the longest pattern wins."""

    pattern: str
    verdict: str
    name: str | None = None
    listed: bool = False


def host_path_rule(verdict: str, host: str, path: str) -> UrlRule:
    """A rule for a host and its subdomains, for paths that start with ``path``."""
    return UrlRule(f"||{host}{path}", verdict, f"{host}{path}", True)


#: Verdicts for single hosts and paths.
LISTED = (
    host_path_rule("allow", "com", "/"),
    host_path_rule("block", "example.com", "/en/"),
    host_path_rule("allow", "www.example.com", "/en/"),
    host_path_rule("block", "net", "/es/"),
    host_path_rule("block", "net", "/fr/"),
)
#: Pages that hold no prose: shops' carts, logins, search results, feeds.
PATTERNS = tuple(
    UrlRule(p, "block")
    for p in ("/wp-login.php", "/cart^", "/checkout^", "/login^", "/signin^", "/search^", "/feed^|", "||doubleclick.*^", "||adserver.")
)


def parts(pattern: str) -> list[str]:
    """The pattern cut into its marks (``||``, ``|``, ``*``, ``^``) and literal runs."""
    return re.findall(r"^\|\||\||\*|\^|[^|*^]+", pattern)


def regular_expression(pattern: str) -> str:
    found, last = [], len(parts(pattern)) - 1
    for i, part in enumerate(parts(pattern)):
        if part == "||":
            found.append(r"^(?:[^/]*\.)?")
        elif part == "|":
            found.append(r"\z" if i == last and i else "^" if i == 0 else r"\|")
        elif part == "*":
            found.append(r"[\s\S]*")
        elif part == "^":
            found.append(SEPARATOR)
        else:
            found.append(re.sub(r"([^A-Za-z0-9])", r"\\\1", part))
    return "".join(found)


def whole_tokens(pattern: str) -> list[str]:
    """Tokens that every matching URL holds as whole tokens: bounded on both sides in the pattern."""
    marks = parts(pattern)
    found = set()
    for i, part in enumerate(marks):
        if part in ("||", "|", "*", "^"):
            continue
        # Beside an anchor or a separator a literal is bounded; beside anything else it may go on.
        left = i > 0 and (marks[i - 1] in ("||", "^") or i == 1 and marks[0] == "|")
        right = i + 1 < len(marks) and (marks[i + 1] == "^" or i + 2 == len(marks) and marks[i + 1] == "|")
        for m in re.finditer(r"[a-z0-9]+", part.translate(str.maketrans(UPPER, LOWER))):
            if (m.start() > 0 or left) and (m.end() < len(part) or right):
                found.add(m.group())
    return sorted(found)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _index(urls: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    """One row for each rule, filed under its rarest token. ``urls`` has an array ``tokens``."""
    spark = urls.sparkSession
    rows = [
        (i, regular_expression(r.pattern), len(r.pattern.lstrip("|")), r.verdict, r.name, r.listed, whole_tokens(r.pattern) or [""])
        for i, r in enumerate(rules)
    ]
    schema = "rule_id long, regex string, length int, said string, rule_name string, listed boolean, literals array<string>"
    compiled = spark.createDataFrame(rows, schema)
    size = sum(len(str(r)) * 4 for r in rows)
    literals = compiled.select("rule_id", F.explode("literals").alias("token"))
    seen = (
        urls.select(F.explode("tokens").alias("token"))
        .join(small(literals.select("token").distinct(), size), "token")
        .groupBy("token")
        .count()
    )
    rarest = (
        literals.join(seen, "token", "left")
        .groupBy("rule_id")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token")).alias("rarest"))
    )
    filed = compiled.drop("literals").join(rarest, "rule_id").select("*", F.col("rarest.token").alias("token"))
    # The count ran over all URLs; its result has a row for each rule, so it is kept.
    return small(cut(filed.drop("rarest")), size)


def judge_urls(
    pages: DataFrame, url: str = "url", rules: Sequence[UrlRule] = (*LISTED, *PATTERNS), default: str = "allow"
) -> DataFrame:
    """Every row with ``host``, ``path``, the ``rule`` (name of a listed rule) and the ``verdict``."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.struct("*").alias("_row"), host.alias("host"), path.alias("path"))
    address = F.concat("host", "path")
    tokens = F.split(F.translate(address, UPPER, LOWER), "[^a-z0-9]+")
    # An empty token on every URL fetches the rules without one.
    tokens = F.array_distinct(F.concat(tokens, F.array(F.lit(""))))
    distinct = pages.select(host.alias("host"), path.alias("path")).distinct()
    urls = cut(distinct).withColumn("tokens", tokens)
    candidates = urls.select("host", "path", F.explode("tokens").alias("token")).join(_index(urls, rules), "token")
    best = F.max(F.struct("listed", "length", "rule_name", "said", "rule_id"))
    matched = candidates.where(F.rlike(address, F.col("regex"))).groupBy("host", "path").agg(best.alias("best"))
    judged = rows.join(matched, ["host", "path"], "left")
    new = {
        "host": F.col("host"),
        "path": F.col("path"),
        "rule": F.when(F.col("best.listed"), F.col("best.rule_name")),
        "verdict": F.coalesce("best.said", F.lit(default)),
    }
    kept = [F.col("_row")[c].alias(c) for c in pages.columns if c.lower() not in new]
    return judged.select(*kept, *[c.alias(n) for n, c in new.items()])
