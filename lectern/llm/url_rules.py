r"""URL filters: rules found by their rarest literal token, then decided by their regular expression.

A rule is ``host/path`` (``host_rule``: that host and its subdomains, paths that start with
the given one) or a pattern (``pattern_rule``: ``*`` any run, ``^`` a separator or the end,
``||`` the start of a host label, ``|`` at either end the start or end; the case of A-Z is ignored
and a leading ``@@`` allows).  A token is a maximal run of a-z and 0-9.  One that
the rule fixes on both sides stands in every URL the rule fits, so a rule is filed under
the one of its tokens that the fewest distinct URLs hold, and a URL fetches only the
rules filed under its own tokens.  A rule without a fixed token is tried on every URL.

Host rules come before patterns, the longest first (then the longer host, then the
smaller text); of patterns, those that allow come first, then the longest.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lowered, the
path what follows up to ``?``, ``#`` or the end.  A null URL, or one without ``://``, has an empty host
and path, fits no rule and gets the default.  Every row is kept, repeated rows too; equal
URLs are judged once.  Other columns pass through, whatever their names; one named like the
result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.session import stage

ALLOW, BLOCK = "allow", "block"
TOKEN = re.compile("[a-z0-9]+")
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = "[^A-Za-z0-9_.%-]"


@dataclass(frozen=True)
class Rule:
    """``rank`` orders rules that fit the same URL, highest first; ``tokens`` are the fixed ones."""

    text: str
    verdict: str
    is_host: bool
    rank: tuple[int, int, int]
    regex: str
    tokens: tuple[str, ...]


def _lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def _tokens(literal: str, left: bool, right: bool) -> list[str]:
    """Tokens of a literal part that cannot go on beyond it; left, right: its ends are fixed."""
    found = [m for m in TOKEN.finditer(_lower(literal))]
    return [m[0] for m in found if (m.start() or left) and (m.end() < len(literal) or right)]


def host_rule(text: str, verdict: str) -> Rule:
    """``host/path``; the path begins at the first slash."""
    host, slash, rest = text.partition("/")
    if not host or not slash or re.search("[?#]", text) or verdict not in (ALLOW, BLOCK):
        raise ValueError(f"not a host rule: {text!r}, {verdict!r}")
    host, path = _lower(host), slash + rest
    regex = rf"^(?:[^/?#]*\.)?{re.escape(host)}{re.escape(path)}"
    return Rule(text, verdict, True, (2, len(text), len(host)), regex, tuple(_tokens(host + path, True, False)))


def pattern_rule(text: str) -> Rule:
    """A pattern over host and all that follows it; ``@@`` in front makes it allow."""
    body = text.removeprefix("@@")
    verdict = BLOCK if body == text else ALLOW
    head = re.match(r"\|{0,2}", body)[0]
    tail = "|" if body.endswith("|") and len(body) > len(head) else ""
    parts = re.split(r"([*^])", body[len(head) : len(body) - len(tail)])
    if not any(parts):
        raise ValueError(f"not a pattern: {text!r}")
    regex, tokens = {"": "", "|": "^", "||": r"^(?:[^/?#]*\.)?"}[head], []
    for k in range(0, len(parts), 2):
        left = head != "" if k == 0 else parts[k - 1] == "^"
        right = tail != "" if k == len(parts) - 1 else parts[k + 1] == "^"
        tokens += _tokens(parts[k], left, right)
        regex += re.escape(parts[k])
        if k + 1 < len(parts):
            regex += ".*" if parts[k + 1] == "*" else rf"(?:{SEPARATOR}|\z)"
    regex = "(?is)" + regex + (r"\z" if tail else "")
    return Rule(text, verdict, False, (int(verdict == ALLOW), len(text), 0), regex, tuple(tokens))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), UPPER, SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after(url), r"^[^/?#]*(/[^?#]*)", 1)


def _after(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _subject(url: Column) -> Column:
    return F.concat(host_of(url), F.regexp_extract(_after(url), r"(?s)^[^/?#]*(.*)", 1))


def _filed(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rules under their rarest token among the ``tokens`` of ``urls``."""
    spark = urls.sparkSession
    rows = [(n, t) for n, r in enumerate(rules) for t in dict.fromkeys(r.tokens or ("",))]
    wanted = spark.createDataFrame(rows, "id int, token string")
    seen = urls.select(F.explode("tokens").alias("token")).join(wanted.select("token").distinct(), "token", "left_semi")
    often = seen.groupBy("token").agg(F.count("*").alias("n"))
    rarest = F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), -F.length("token"), "token")).alias("token")
    chosen = wanted.join(often, "token", "left").groupBy("id").agg(rarest)
    kinds = "id int, text string, verdict string, is_host boolean, rank array<int>, regex string"
    content = spark.createDataFrame([(n, *astuple(r)[:3], list(r.rank), r.regex) for n, r in enumerate(rules)], kinds)
    return stage(content.join(chosen, "id"), "rules")


def _candidates(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(subject, rule) for every rule that a token of the URL fetches."""
    return urls.select("subject", F.explode("tokens").alias("token")).join(rules, "token")


def judge(df: DataFrame, url: str, rules: Sequence[Rule], out: str, default: str = ALLOW) -> DataFrame:
    """``df`` with the struct ``out`` (host, path, rule, pattern, verdict); rule or pattern is the text that decided."""
    rows = df.select(F.struct(*[df[c] for c in df.columns if c != out]).alias("row"), df[url].alias("url"))
    rows = rows.withColumn("subject", F.coalesce(_subject(F.col("url")), F.lit("")))
    found = rows.select("subject").filter("subject <> ''").distinct()
    tokens = F.array_distinct(F.regexp_extract_all(F.translate("subject", UPPER, SMALL), F.lit("[a-z0-9]+"), 0))
    if not all(r.tokens for r in rules):
        tokens = F.array_append(tokens, "")
    if rules:
        found = stage(found.withColumn("tokens", tokens), "urls")
        fits = _candidates(found, _filed(found, rules)).filter("subject RLIKE regex")
        # The smaller text wins the last tie: of equal ranks, the least one is taken.
        order = F.struct(*[-F.col("rank")[k] for k in range(3)], F.col("text"), F.col("verdict"))
        best = fits.groupBy("subject").agg(F.min_by(F.struct("text", "verdict", "is_host"), order).alias("best"))
        rows = rows.join(best, "subject", "left")
    else:
        rows = rows.withColumn("best", F.lit(None).cast("struct<text: string, verdict: string, is_host: boolean>"))
    made = F.struct(
        F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"),
        F.when(F.col("best.is_host"), F.col("best.text")).alias("rule"),
        F.when(~F.col("best.is_host"), F.col("best.text")).alias("pattern"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
    return rows.select("row.*", made.alias(out))
