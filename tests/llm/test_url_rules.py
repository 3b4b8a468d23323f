import pytest
from pyspark.errors import PySparkException

from tenurelake.llm import url_rules as U
from tenurelake.llm.catalog import URL_RULES

URLS = [
    None, "", "no scheme/en/", "http://a.com", "http://a.com/", "https://A.Example.COM/en/x?y#z", "http://www.example.com/en/",
    "http://www.example.com/EN/", "http://example.com/english", "http://xexample.com/en/", "http://b.net/es/1", "http://b.net/es",
    "http://net/fr/", "http://planet/fr/", "http://a.com:80/", "ftp://u@c.com/a//b", "http://x.org/casino/", "http://x.org/casinos",
    "http://my-CASINO.org", "http://a.com/?u=http://b.net/es/", "://com/", "http://a.com#/x", "http://a.com/\nen", "http://com.evil.org/",
    "http://" + "long." * 3000 + "com/" + "p/" * 3000,
]


def expected(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    import re

    spam = re.search(r"(?:^|[\W_])casino(?:$|[\W_])", host + path, re.I)
    return host, path, "word:casino" if spam else None, "block" if spam else "allow"


def rules(spark):
    return U.rule_table(spark, [U.path_rule(*r) for r in URL_RULES] + [U.word_rule("casino")])


def test_rules_agree_with_plain_python(spark):
    pages = spark.createDataFrame(list(enumerate(URLS + URLS[5:9])), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(pages, rules(spark)).collect()}
    assert got == {i: expected(u) for i, u in enumerate(URLS + URLS[5:9])}


def test_extra_columns_empty_tables_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x", "old", 5)], "page_id long, url string, verdict string, _target int")
    got = U.judge_urls(pages, rules(spark)).first().asDict()
    assert got == {"page_id": 1, "url": "http://a.com/x", "_target": 5, "host": "a.com", "path": "/x", "rule": "com/", "verdict": "allow"}
    assert U.judge_urls(pages.limit(0), rules(spark)).count() == 0
    none = U.judge_urls(pages, U.rule_table(spark, [])).first()
    assert none.rule is None and none.verdict == "allow"


def test_a_rule_is_filed_under_its_rarest_token(spark):
    name, pattern, tokens, *_ = U.path_rule("example.com", "/en", "block")
    assert tokens == ["example", "com"]  # "en" could go on as "english"
    assert U.path_rule("example.com", "/en/", "block")[2] == ["example", "com", "en"]


def test_a_rule_without_a_token_is_refused(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    with pytest.raises(PySparkException):
        U.judge_urls(pages, U.rule_table(spark, [("any", ".*", [], "block", 1)])).collect()


def test_of_thousands_of_rules_only_candidates_run(spark):
    """A pattern that cannot be compiled fails the query if it is run: those filed under a token that no URL
    holds never are, though they share their other tokens with every URL."""
    broken = [(f"broken:{k}", "(", ["com", f"site{k}"], "block", 5000 + k) for k in range(3000)]
    real = [U.path_rule(f"s{k}.com", "/a/", "block") for k in range(0, 3000, 3)]
    pages = spark.range(600).selectExpr("id as page_id", "concat('http://www.s', id, '.com/a/', id % 7) as url")
    got = {r.page_id: (r.rule, r.verdict) for r in U.judge_urls(pages, U.rule_table(spark, broken + real)).collect()}
    assert got == {i: (f"s{i}.com/a/", "block") if i % 3 == 0 else (None, "allow") for i in range(600)}
    with pytest.raises(Exception, match="Unclosed group"):
        U.judge_urls(pages, U.rule_table(spark, [("broken", "(", ["com"], "block", 1)])).collect()
