from __future__ import annotations

import random
import re
from functools import cache

import pytest

from barwright.llm import queries, urlfilter
from barwright.llm.urlfilter import Rule, host_rule

from .conftest import plain

URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "http://A.B.NET/x", "http://x.example.net/en/", "http://x.example.net/EN/",
    "http://x.example.net/en", "http://example.com/de/a?b#c", "http://notexample.com/de/", "http://w.org/fr/x", "http://org/fr/", "ftp://w.org?/fr/",
    "http://w.org#/fr/", "http://casino.example.com/", "http://my-casino-win.com/", "http://mycasino.com/", "http://a.com/CASINO", "http://a.com/casino\n",
    "http://a.com/?utm_source=feed&x=casino", "a://b://net/", "http://É.net/", "http://cheap-pills.com", "http://x.com/free-bets", "http://x.com/%casino",
]


@cache
def compiled(rule):
    return re.compile(urlfilter.regex(rule).replace(r"\z", r"\Z"))


def judge(url, rules=queries.URL_RULES):
    """The same rules, every one tried on every url."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    fold = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)
    raw = re.match(r"[^/?#]*", rest)[0]
    host, after = fold(raw), rest[len(raw) :]
    path = re.match(r"[^?#]*", after)[0]
    fits = []
    for r in rules:
        if r.by_host:
            h, _, p = r.name.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((len(r.name), r.name, r.action))
    hits = {r.action for r in rules if not r.by_host and compiled(r).search(fold(rest))}
    by_pattern = "block" if hits == {"block"} else "allow"
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else by_pattern


def test_equals_every_rule_on_every_url(spark):
    pages = spark.createDataFrame([(i, u, 0, "z") for i, u in enumerate(URLS * 2)], "page_id long, url string, host int, target string")
    found = {r["page_id"]: tuple(r)[1:] for r in urlfilter.judge_urls(pages, queries.URL_RULES).collect()}
    assert found == {i: judge(u) for i, u in enumerate(URLS * 2)}


@pytest.mark.parametrize("pattern, tokens", [("^casino^", ["casino"]), ("||a.net/en/", ["a", "en", "net"]), ("||a.net/en", ["a", "net"]), ("ads*", []), ("^a^*b^", ["a"]), ("x/y/z", ["y"])])
def test_literal_tokens_are_bounded_on_both_sides(pattern, tokens):
    assert urlfilter.literal_tokens(Rule("r", pattern, "block")) == tokens


def test_rules_without_a_token_and_rarest_token(spark):
    rules = [Rule("ads", "ads*1", "block"), Rule("two", "^common^rare^", "block"), host_rule("allow", "ok.com/")]
    urls = ["http://x.com/common", "http://x.com/common/rare", "http://x.com/badsx1", "http://ok.com/common/rare", "http://x.com/rare/common"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r["page_id"]: r["verdict"] for r in urlfilter.judge_urls(pages, rules).collect()}
    assert found == {0: "allow", 1: "block", 2: "block", 3: "allow", 4: "allow"}
    named = pages.withColumns(urlfilter._parts(pages["url"])).select("target").distinct().withColumn("folded", urlfilter.F.col("target"))
    urls = named.withColumn("tokens", urlfilter.F.split("folded", "[^a-z0-9%]+"))
    assert urlfilter.literal_tokens(rules[0]) == []  # tried in place
    assert {r["name"]: r["token"] for r in urlfilter._index(spark, urls, rules[1:]).collect()} == {"two": "rare", "ok.com/": "ok"}


def test_null_ids_repeated_rows_and_empty_table(spark):
    pages = spark.createDataFrame([(None, "http://a.net/"), (None, "http://a.net/"), (1, None)], "page_id long, url string")
    assert plain(urlfilter.judge_urls(pages, queries.URL_RULES).collect()) == plain(
        [(None, "a.net", "/", "net/", "block")] * 2 + [(1, "", "", None, "allow")]
    )
    assert urlfilter.judge_urls(pages.limit(0), queries.URL_RULES).count() == 0


def test_rules_from_text():
    rules = urlfilter.parse_rules("! a comment\n\nhost block net/\n ^Casino^ \n@@||ok.com^\n|start*end|\n^Casino^\n")
    assert rules == [host_rule("block", "net/"), Rule("^Casino^", "^casino^", "block"), Rule("||ok.com^", "||ok.com^", "allow"), Rule("|start*end|", "|start*end|", "block")]
    for bad in ("host net/", "*", "@@", "two words"):
        with pytest.raises(ValueError):
            urlfilter.parse_rules(bad)


@pytest.mark.parametrize("pattern, url, hit", [("|x.com/a|", "x.com/a", True), ("|x.com/a|", "x.com/ab", False), ("com/a|", "x.com/a", True), ("|com", "x.com/", False), ("/a$b", "q/a$b", True)])
def test_anchors(pattern, url, hit):
    assert bool(re.search(urlfilter.regex(Rule("r", pattern, "block")).replace(r"\z", r"\Z"), url)) == hit


def test_thousands_of_rules_and_few_candidates(spark):
    """Each url runs a handful of 4,000 rules and is judged as if it had run them all."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.choice([1, 2, 3, 3, 4])))
    shapes = ["^{}^", "||{}.com^", "||{}.{}^{}", "/{}/{}|", "@@^{}^{}^", "*{}^{}*", "^{}={}^", "@@||{}.com/{}^", "|{}.com^"]
    lines = [rng.choice(shapes).format(word(), word(), word()) for _ in range(4000)] + ["^hot^zzz^", "jjjj*jjjj", "host block com/a", "host allow b.com/"]
    rules = urlfilter.parse_rules("\n".join(lines))
    urls = [f"http://{word()}.{word()}.com/{word()}/{word()}/hot?{word()}={word()}&{word()}" for _ in range(400)] + ["http://same.com/hot"] * 400
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r["page_id"]: tuple(r)[1:] for r in urlfilter.judge_urls(pages, rules).collect()}
    wanted = {u: judge(u, rules) for u in dict.fromkeys(urls)}
    assert found == {i: wanted[u] for i, u in enumerate(urls)}
    assert {"block", "allow"} == {v[3] for v in wanted.values()}
    targets = pages.withColumns(urlfilter._parts(pages["url"])).select("target").distinct().withColumn("folded", urlfilter.F.col("target"))
    assert urlfilter.fetch_candidates(targets, rules).count() < 60 * targets.count()


def test_a_url_that_most_pages_have(spark):
    rows = [(i, "http://hot.net/x" if i % 5 else f"http://h{i}.org/fr/casino") for i in range(3000)]
    found = urlfilter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), queries.URL_RULES)
    assert found.groupBy("rule", "verdict").count().orderBy("rule").collect() == [("net/", "block", 2400), ("org/fr/", "allow", 600)]
