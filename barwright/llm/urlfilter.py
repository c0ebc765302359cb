"""URL filter: pattern rules found by their rarest literal token.

A rule's pattern is text in which ``*`` stands for any characters, ``^`` for a separator or an end of the
url, a leading ``||`` anchors at the start of a host label, and ``|`` at either end anchors there. Its literal
tokens are runs of [a-z0-9%] that the pattern bounds on both sides, so that a url can only match if it has
each of them as a whole token. The rule is filed under the one that occurs in the fewest urls; the tokens of a
url fetch candidate rules by an equi-join, and only those run their regular expression. Rules without a literal
token are tried on every url in place. All of it is DataFrame code.

Null or malformed urls (no ``://``) have an empty host and path and match only rules that match an empty
text. Repeated pages give repeated rows. An empty table gives no rows; columns beside ``page_id`` and
``url`` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.sources.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEPARATOR = "[^a-z0-9%]"
#: Up to so many rules are sent to every task; more are joined through a shuffle.
BROADCAST_RULES = 50_000


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    action: str  # block or allow
    by_host: bool = False  # a host rule: the longest that fits decides before any other rule


def host_rule(action: str, name: str) -> Rule:
    """``host/path-prefix``: fits the host and its subdomains."""
    return Rule(name, f"||{name}", action, True)


def parse_rules(text: str) -> list[Rule]:
    """Rules from lines: a pattern blocks, ``@@`` before it allows, ``host block net/`` and ``host allow org/fr/`` are
    host rules; ``!`` starts a comment. Two equal lines are one rule. Patterns have no options (``$`` is literal)."""
    rules: dict[Rule, None] = {}
    for line in map(str.strip, text.splitlines()):
        if not line or line.startswith("!"):
            continue
        if m := re.fullmatch(r"host\s+(block|allow)\s+(\S+)", line):
            rules[host_rule(m[1], m[2])] = None
            continue
        pattern = line.removeprefix("@@")
        if not pattern.strip("*|^") or re.search(r"\s", pattern):
            raise ValueError(f"no rule: {line!r}")
        rules[Rule(pattern, pattern.lower(), "allow" if line.startswith("@@") else "block")] = None
    return list(rules)


def _body(rule: Rule) -> tuple[str, str, str]:
    """(what stands before, the pattern without anchors, what stands behind), as regular expressions but the middle."""
    body, head, tail = rule.pattern, "", ""
    if body.startswith("||"):
        body, head = body[2:], r"^(?:[^/?#]*\.)?"
    elif body.startswith("|"):
        body, head = body[1:], "^"
    if body.endswith("|") and not rule.by_host:
        body, tail = body[:-1], r"\z"
    return head, body, tail


def regex(rule: Rule) -> str:
    """The rule as a regular expression over host + path + rest, the host lower-cased."""
    head, body, tail = _body(rule)
    out = []
    for i, c in enumerate(body):
        if c == "*":
            out.append(r"[\s\S]*")
        elif c == "^":
            out.append(rf"(?:^|{_SEPARATOR})" if not head and i == 0 else rf"(?:{_SEPARATOR}|\z)")
        else:
            out.append(re.escape(c))
    return head + "".join(out) + tail


def literal_tokens(rule: Rule) -> list[str]:
    """Tokens that every matching url has whole."""
    head, body, tail = _body(rule)
    found = []
    for m in re.finditer(r"[a-z0-9%]+", body.lower()):
        left = body[m.start() - 1] if m.start() else ("^" if head else "*")
        right = body[m.end()] if m.end() < len(body) else ("^" if tail else "*")
        if left != "*" and right != "*":
            found.append(m.group())
    return sorted(set(found))


def _fold(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def _parts(url: Column) -> dict[str, Column]:
    rest = F.expr("substring(url, locate('://', url) + 3)")
    rest = F.when(F.locate("://", url) > 0, rest).otherwise(F.lit(""))
    host = _fold(F.regexp_extract(rest, r"^[^/?#]*", 0))
    after = F.substring(rest, F.length(F.regexp_extract(rest, r"^[^/?#]*", 0)) + 1, F.length(rest))
    return {"host": host, "path": F.regexp_extract(after, r"^[^?#]*", 0), "target": F.concat(host, after)}


def _index(spark, urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(token, rule columns): each rule that has a literal token under its rarest one."""
    small = F.broadcast if len(rules) <= BROADCAST_RULES else lambda df: df
    table = spark.createDataFrame(
        [(i, r.name, regex(r), r.action, r.by_host) for i, r in enumerate(rules)],
        "rule_no int, name string, regex string, action string, by_host boolean",
    )
    literals = spark.createDataFrame([(i, t) for i, r in enumerate(rules) for t in literal_tokens(r)], "rule_no int, token string")
    seen = urls.select(F.explode("tokens").alias("token")).join(small(literals.select("token").distinct()), "token")
    counts = seen.groupBy("token").agg(F.count("*").alias("n_urls"))
    rarest = (
        literals.join(counts, "token", "left")
        .groupBy("rule_no")
        .agg(F.min(F.struct(F.coalesce("n_urls", F.lit(0)).alias("n"), "token")).alias("best"))
        .select("rule_no", F.col("best.token").alias("token"))
    )
    return small(stage(rarest.join(table, "rule_no").drop("rule_no"), "url-rules"))


def fetch_candidates(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows of ``urls`` (target, folded) with each rule whose rarest token they have: name, regex, action, by_host."""
    tokens = F.array_distinct(F.split("folded", f"{_SEPARATOR}+"))
    urls = urls.withColumn("tokens", tokens)
    index = _index(urls.sparkSession, urls, [r for r in rules if literal_tokens(r)])
    return urls.select("target", "folded", F.explode("tokens").alias("token")).join(index, "token").drop("token")


def _in_place(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows of ``urls`` with each of a few rules."""
    structs = [F.struct(F.lit(r.name).alias("name"), F.lit(regex(r)).alias("regex"), F.lit(r.action).alias("action"), F.lit(r.by_host).alias("by_host")) for r in rules]
    return urls.select("target", "folded", F.explode(F.array(*structs)).alias("r")).select("target", "folded", "r.*")


def judge_urls(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule (the deciding host rule or null), verdict.

    The longest fitting host rule decides. Else a url is blocked if a block rule matches it and no allow
    rule does.
    """
    named = pages.select("page_id", F.col("url").cast("string").alias("url")).withColumns(_parts(F.col("url")))
    # each distinct target is judged once: a url that a third of the pages share is one row here
    urls = named.select("target").distinct()
    urls = stage(urls.withColumn("folded", _fold(F.col("target"))), "urls")
    candidates = fetch_candidates(urls, rules)
    if everywhere := [r for r in rules if not literal_tokens(r)]:
        candidates = candidates.unionByName(_in_place(urls, everywhere))
    subject = F.when(F.col("by_host"), F.col("target")).otherwise(F.col("folded"))
    hits = candidates.filter(F.regexp_like(subject, F.col("regex")))
    generic = ~F.col("by_host")
    verdicts = hits.groupBy("target").agg(
        F.max(F.when(F.col("by_host"), F.struct(F.length("name").alias("n"), "name", "action"))).alias("best"),
        F.max(generic & (F.col("action") == "block")).alias("blocked"),
        F.max(generic & (F.col("action") == "allow")).alias("allowed"),
    )
    verdicts = stage(verdicts, "url-verdicts")  # written, so that the join can split a url that many pages have
    by_pattern = F.when(
        F.coalesce(F.col("blocked"), F.lit(False)) & ~F.coalesce(F.col("allowed"), F.lit(False)), "block"
    ).otherwise("allow")
    return named.join(verdicts, "target", "left").select(
        "page_id", "host", "path", F.col("best.name").alias("rule"),
        F.coalesce(F.col("best.action"), by_pattern).alias("verdict"),
    )
