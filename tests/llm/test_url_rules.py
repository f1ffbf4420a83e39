import random
import re

import pytest
from pyspark.sql import functions as F

from lectern.llm import url_rules
from lectern.llm.queries import QUERIES
from lectern.llm.url_rules import host_rule, judge, pattern_rule

FOLDER = "/root/testdata/sf0.001"


def parts(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    after = rest[len(host) :]
    host = small(host)
    return host, re.match(r"[^?#]*", after)[0], host + after


def small(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def glob(pattern):
    """A pattern as a matcher of its own: tries every start and walks the pattern character by character."""
    body = small(pattern.removeprefix("@@"))
    label, start = body.startswith("||"), body.startswith("|")
    body = body.lstrip("|")
    end = body.endswith("|")
    body = body.rstrip("|")

    def at(text, i, j):
        if j == len(body):
            return i == len(text) if end else True
        if body[j] == "*":
            return any(at(text, k, j + 1) for k in range(i, len(text) + 1))
        if body[j] == "^":
            if i == len(text) and at(text, i, j + 1):
                return True
            return i < len(text) and not re.match(r"[A-Za-z0-9_.%-]", text[i]) and at(text, i + 1, j + 1)
        return i < len(text) and text[i] == body[j] and at(text, i + 1, j + 1)

    def fits(subject):
        text, host = small(subject), re.match(r"[^/?#]*", subject)[0]
        if label:
            starts = [0] + [k + 1 for k, c in enumerate(host) if c == "."]
        else:
            starts = [0] if start else range(len(text) + 1)
        return any(at(text, k, 0) for k in starts)

    return fits


def brute(url, hosts, patterns):
    host, path, subject = parts(url)
    best = None
    for text, verdict in hosts:
        h, _, p = text.partition("/")
        if subject and (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = max(best or (), (len(text), len(h), text, verdict))
    if best:
        return host, path, best[2], None, best[3]
    fit = [p for p in patterns if subject and glob(p)(subject)]
    if fit:
        p = min(fit, key=lambda p: (not p.startswith("@@"), -len(p), p))
        return host, path, None, p, "allow" if p.startswith("@@") else "block"
    return host, path, None, None, "allow"


HOSTS = [("net/", "block"), ("a.net/x/", "allow"), ("b.com/de", "block"), ("org/", "allow"), ("ads.org/", "block"), ("É.org/", "block")]
PATTERNS = ["||ads.", "@@||ads.*/ok^", "banner^", "|a.", "x|", "-pop-", "^id=", "||b.com^", "ad*er", "*", "@@ok/", "é^"]
ODD = [
    None, "", "no scheme", "http://", "http:///", "http://?q=://a.net/x/", "://net/", "http://NET/", "http://net", "http://net?x", "ftp://A.Net/x/",
    "http://a.net/X/", "http://xnet/", "http://u@a.net:80/x/", "http://b.com/de\nx", "http://é.org/é", "http://b.com", "http://b.com#a", "a" * 70000,
    "http://ads.org/" + "y/" * 40000 + "x",
]


def random_urls(n):
    rng = random.Random(7)
    bits = ["a", "ads", "b", "net", "com", "org", "x", "de", "banner", "ok", "-pop-", "id=1", "ader", "É", "é", "ADS", "%20", ".", ".", "/", "/", "?", "#", "://"]
    return ["http://" + "".join(rng.choices(bits, k=rng.randint(1, 9))) for _ in range(n)]


@pytest.mark.parametrize("patterns", [PATTERNS, [p for p in PATTERNS if p not in ("*", "ad*er")], []])
def test_against_trying_every_rule(spark, patterns):
    urls = ODD + random_urls(1500)
    df = spark.createDataFrame([(k, u, "f", "r") for k, u in enumerate(urls)], "id int, url string, found string, subject string")
    rules = [host_rule(*r) for r in HOSTS] + [pattern_rule(p) for p in patterns]
    rows = judge(df.repartition(3), "url", rules, "found").collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert tuple(r.found) == brute(urls[r.id], HOSTS, patterns), urls[r.id]
        assert r.subject == "r"


def test_a_rule_is_filed_under_its_rarest_fixed_token(spark):
    rules = [host_rule("common.rare/x/", "block"), pattern_rule("||common.*half"), pattern_rule("loose*"), host_rule("common.never/", "block")]
    urls = spark.createDataFrame([(["common", "rare", "x"],), (["common", "x"],), (["common"],)], "tokens array<string>")
    filed = {r.text: r.token for r in url_rules._filed(urls, rules).collect()}
    assert filed == {"common.rare/x/": "rare", "||common.*half": "common", "loose*": "", "common.never/": "never"}


def test_only_fetched_rules_are_run(spark):
    """As many rules as URLs: the regular expressions that run are few, not rules times URLs."""
    n = 3000
    urls = spark.range(n).select(F.array(F.lit("shop"), F.concat(F.lit("s"), "id")).alias("tokens"), F.concat(F.lit("s"), "id", F.lit(".shop/")).alias("subject"))
    rules = [host_rule(f"s{k}.shop/", "block") for k in range(n)]
    assert url_rules._candidates(urls, url_rules._filed(urls, rules)).count() == n


def test_no_rules_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "http://a.net/x/"), (1, "http://a.net/x/"), (None, None)], "id int, url string")
    assert {(r.id, r.found.host, r.found.verdict) for r in judge(df, "url", [], "found", "block").collect()} == {(1, "a.net", "block"), (None, "", "block")}
    rules = [host_rule("net/", "block")]
    assert [r.found.rule for r in judge(df, "url", rules, "found").orderBy("id").collect()] == [None, "net/", "net/"]
    assert judge(df.limit(0), "url", rules, "found").count() == 0
    for bad in ("net", "/x", "net/?q"):
        with pytest.raises(ValueError):
            host_rule(bad, "block")


def test_query_keeps_every_page(spark):
    rows = QUERIES["op11_url_rules"](spark, FOLDER).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    from lectern.llm.queries import HOST_RULES, URL_PATTERNS

    for r in rows:
        assert (r.host, r.path, r.rule, r.pattern, r.verdict) == brute(pages[r.page_id], HOST_RULES, URL_PATTERNS)
