"""URL filtering with pattern rules that are indexed by their rarest literal token.

Two kinds of rules share one index:

* host rules `(verdict, host, path)` fit a host with all its subdomains where the path starts with
  the rule's; the longest one that fits decides;
* pattern rules `(verdict, pattern)` decide where no host rule fits. In a pattern `*` stands for
  anything, `^` for a separator or the end, `||` at its start for the start of a host label.

Every rule is filed under the literal token of it that is rarest among the URLs (a token counts only
if the pattern bounds it on both sides). A URL's tokens fetch candidate rules from the index, and
only those run regular expressions. All of it is native expressions in one pass without an exchange,
so no host, however common, meets in one task. The index is a literal of at most INDEX_RULES rules;
longer lists are worked through in as many literals, all of them over every URL.

Null or malformed URLs (no `://`): empty host and path, no rule, the default verdict. Repeated rows
are judged each for itself; other columns of the input are not read and may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules in one literal index.
INDEX_RULES = 5_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[a-z0-9]+"
#: Where a rule without a usable token is filed; every URL has it.
ANYWHERE = ""


@dataclass(frozen=True)
class Rule:
    """A rule in its compiled form: regex over host + path, usable tokens, precedence."""

    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    weight: int


def _quote(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9_/])", lambda m: f"\\x{{{ord(m[1]):x}}}", text)


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host, its subdomains and a path prefix, named by its text."""
    tokens = set(re.findall(TOKEN, host.lower()))
    # The last token of a path may go on in the URL unless something follows it.
    tokens |= {m[0] for m in re.finditer(TOKEN, path.lower()) if m.end() < len(path)}
    regex = f"^(?:[^/]*\\x{{2e}})?{_quote(host)}{_quote(path)}"
    if not path:
        regex += "(?=/|$)"
    return Rule(host + path, verdict, regex, tuple(sorted(tokens)), len(host + path))


def pattern_rule(verdict: str, pattern: str) -> Rule:
    """A rule in the wildcard language, matched against the lower-cased host + path."""
    body = pattern.lower()
    anchored = body.startswith("||")
    body = body[2:] if anchored else body
    regex = "".join(
        ".*" if c == "*" else "(?:[^a-z0-9_.%-]|$)" if c == "^" else _quote(c) for c in body
    )
    tokens = set()
    for m in re.finditer(TOKEN, body):
        opens = m.start() > 0 and body[m.start() - 1] != "*" or m.start() == 0 and anchored
        closes = m.end() < len(body) and body[m.end()] != "*"
        if opens and closes:
            tokens.add(m[0])
    start = "(?s)^(?:[^/]*\\x{2e})?" if anchored else "(?s)"
    return Rule(pattern, verdict, start + regex, tuple(sorted(tokens)), len(pattern))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def _tokens(text: Column) -> Column:
    found = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({TOKEN})"), F.lit(1))
    return F.array_distinct(F.concat(F.array(F.lit(ANYWHERE)), found))


def token_counts(urls: DataFrame, url: str, tokens: Sequence[str]) -> dict[str, int]:
    """How many URLs hold each of the rules' tokens: as many rows as rules have tokens, at most."""
    host, path = split_url(F.col(url))
    wanted = F.array(*[F.lit(t) for t in tokens]) if tokens else F.array().cast("array<string>")
    held = urls.select(F.explode(F.array_intersect(_tokens(F.concat(host, path)), wanted)).alias("t"))
    return {r["t"]: r["n"] for r in held.groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}


def _index(rules: Sequence[Rule], counts: dict[str, int]) -> Column:
    filed: dict[str, list[Rule]] = {}
    for rule in rules:
        token = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=ANYWHERE)
        filed.setdefault(token, []).append(rule)
    entries = []
    for token, own in sorted(filed.items()):
        packed = [
            F.struct(
                F.lit(r.weight).alias("weight"),
                F.lit(r.name).alias("name"),
                F.lit(r.verdict).alias("verdict"),
                F.lit(r.regex).alias("regex"),
            )
            for r in own
        ]
        entries += [F.lit(token), F.array(*packed)]
    return F.create_map(*entries)


def _best(text: Column, tokens: Column, rules: Sequence[Rule], counts: dict[str, int]) -> Column:
    """The heaviest rule that fits (ties: the later name); null if none."""
    best = []
    for i in range(0, len(rules), INDEX_RULES):
        index = _index(rules[i : i + INDEX_RULES], counts)
        fetched = F.filter(F.transform(tokens, lambda t: F.try_element_at(index, t)), lambda r: r.isNotNull())
        fits = F.filter(F.flatten(fetched), lambda r: F.rlike(text, r["regex"]))
        best.append(F.array_max(fits))
    if not best:
        return F.lit(None).cast("struct<weight:int,name:string,verdict:string,regex:string>")
    return best[0] if len(best) == 1 else F.greatest(*best)


def judge_urls(
    pages: DataFrame,
    host_rules: Sequence[Rule],
    pattern_rules: Sequence[Rule],
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per page: key, host, path, rule, pattern, verdict.

    `rule` names the longest host rule that fits, `pattern` the longest pattern rule (both null if
    none); the verdict is the host rule's, else the pattern rule's, else `default`.
    """
    every = sorted({t for r in [*host_rules, *pattern_rules] for t in r.tokens})
    counts = token_counts(pages, url, every)
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    text = F.concat("host", "path")
    lowered = F.translate(text, UPPER, LOWER)
    rows = rows.withColumn("_tokens", _tokens(text))
    rows = rows.withColumn("_rule", _best(text, F.col("_tokens"), host_rules, counts))
    rows = rows.withColumn("_pattern", _best(lowered, F.col("_tokens"), pattern_rules, counts))
    return rows.select(
        key,
        "host",
        "path",
        F.col("_rule.name").alias("rule"),
        F.coalesce("_rule.verdict", "_pattern.verdict", F.lit(default)).alias("verdict"),
        F.col("_pattern.name").alias("pattern"),
    )


#: Patterns for pages that sell pills, bets and casinos, wherever they are hosted.
PATTERNS = (
    ("block", "||cheap-pills."),
    ("block", "||casino-win."),
    ("block", "||free-bets."),
    ("block", "*/ads/*"),
    ("block", "*.adserver.*"),
)
