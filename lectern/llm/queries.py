"""The queries of this subpackage: one per operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import chat, periodic, pieces, quality, spelling, toxicity, url_rules, warc
from lectern.llm.embeddings import near_duplicates
from lectern.llm.jaccard import jaccard_components
from lectern.llm.language import fit, language
from lectern.llm.packing import pack
from lectern.llm.token_counts import token_count
from lectern.operators.skew import null_safe_join
from lectern.session import configure, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

# Quality: a line in more than so many documents of a source goes; a document must keep this part of its words.
LINE_LIMIT, LEAST_KEPT = 20, 0.5


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(configure(spark), folder)

    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op4_token_counts(spark, folder):
    docs = table(spark, folder, "documents")
    counts = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(F.col("text"), public_tokenizers.path("piece_bpe_32k.model")).alias("n_tokens"),
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


@query
def op8_packing(spark, folder):
    docs = table(spark, folder, "documents")
    pieces = pack(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op7_quality(spark, folder):
    docs = table(spark, folder, "documents")
    rows = stage(quality.with_identity(quality.measured(docs, "doc_id", "text", "source")), "lines")
    depleted = quality.verdicts(rows, quality.frequent_lines(rows, LINE_LIMIT), LEAST_KEPT)
    joined = null_safe_join(rows.drop("host", "lines"), depleted, ["key", "own"], "left")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return joined.select(
        F.col("key").alias("doc_id"), *quality.MEASURES, failed.alias("base_failed"),
        (~failed & ~F.coalesce("depleted", F.lit(False))).alias("kept"),
        F.coalesce("lines_removed", F.lit(0)).alias("lines_removed"),
        F.coalesce("words_removed", F.lit(0)).alias("words_removed"),
    )


@query
def op6_ngram_jaccard(spark, folder):
    found = jaccard_components(table(spark, folder, "documents"), "doc_id", "text", width=4, percent=85)
    return found.toDF("doc_id", "n_shingles", "component_id")


def held_out():
    """Rows never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


@query
def op2_language(spark, folder):
    docs = table(spark, folder, "documents")
    model = fit(docs.filter(~held_out()), "doc_id", "text", "lang")
    found = docs.select("doc_id", held_out().alias("held_out"), language(model, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")


# A document with this score or more counts as toxic.
TOXIC_FROM = 0.3


def toxic_model(docs, labels):
    """Learn from the labelled rows that are not held out."""
    labelled = docs.filter(~held_out()).join(labels.select("doc_id", "toxic"), "doc_id")
    return toxicity.fit(labelled, "doc_id", "text", "toxic")


@query
def op3_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxic_model(docs, table(spark, folder, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity.toxicity(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


@query
def op9_embeddings(spark, folder):
    found = near_duplicates(table(spark, folder, "embeddings"), "vec_id", "embedding", "label", 0.93)
    found = found.toDF("vec_id", "n_links", "component_id")
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


@query
def op1_chat(spark, folder):
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], conversations.schema)
    pieces = chat.format_conversations(conversations.unionByName(added), "conv_id", "turn", "role", "text")
    return chat.digests(pieces).withColumnRenamed("conversation", "conv_id")


@query
def op10_warc(spark, folder):
    read = warc.round_trip(table(spark, folder, "pages"), "page_id", "url", "html")
    return read.withColumnsRenamed({"page": "page_id", "type": "record_type"})


CHECKS["op10_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, CASE WHEN strlen(payload) >= 100 THEN min(page_id) OVER (PARTITION BY payload) ELSE page_id END AS least FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type, nullif(least, page_id) AS refers_to
FROM f
"""


@query
def op5_pieces(spark, folder):
    """Two sampled segmentations of each text, and whether they decode to it."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("own", F.xxhash64(F.replace(F.coalesce("text", F.lit("")), F.lit("\u2581"), F.lit(" "))))
    made = pieces.sampled(docs, "doc_id", "text", model, k=2, keep=["own"], decoded="decoded")
    return made.select(
        "doc_id", "sample", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"),
        "log_prob", "perturbed", F.exp("log_inclusion").alias("inclusion"), "log_inclusion",
        (F.xxhash64("decoded") == F.col("own")).alias("decoded"),
    )


# URL rules: hosts with paths decide first; the patterns are the method's verdict on all other URLs.
HOST_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
URL_PATTERNS = ("||ads-", "||adult-", "||casino-", "||cheap-pills", "||free-bets", "||spam-")


@query
def op11_url_rules(spark, folder):
    rules = [url_rules.host_rule(*r) for r in HOST_RULES] + [url_rules.pattern_rule(p) for p in URL_PATTERNS]
    judged = url_rules.judge(table(spark, folder, "pages").select("page_id", "url"), "url", rules, "found")
    return judged.select("page_id", "found.host", "found.path", "found.rule", "found.verdict", "found.pattern")


CHECKS["op11_url_rules"] = r"""
WITH a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM a),
r AS (SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p),
m AS (SELECT *, CASE WHEN rule IS NULL THEN
    regexp_extract(host, '(?i)(?:^|[.])(cheap-pills|free-bets)', 1) || regexp_extract(host, '(?i)(?:^|[.])((?:ads|adult|casino|spam)-)', 1)
    END AS word FROM r)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN word <> '' THEN 'block' ELSE 'allow' END AS verdict, '||' || nullif(word, '') AS pattern
FROM m
"""


def with_planted_period(docs):
    """(doc_id, text): in each tenth document by crc32, the words from some place on repeat with some period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), "")
    docs = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    docs = docs.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    docs = docs.withColumn("rest", F.col("n") - F.col("a"))
    docs = docs.withColumn("p", 1 + F.floor(F.col("rest") / (3 + F.col("g") % 8)))
    cycle = F.slice("words", F.col("a") + 1, F.col("p"))
    cycles = F.flatten(F.array_repeat(cycle, F.ceil(F.col("rest") / F.col("p")).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(cycles, F.lit(1), F.col("rest")))
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic(spark, folder):
    docs = with_planted_period(table(spark, folder, "documents").select("doc_id", "text"))
    found = docs.select("doc_id", periodic.periodic("text").alias("f")).select("doc_id", "f.runs", "f.collapsed")
    found = found.withColumn("best", periodic.longest_exponent("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# Spelling: words of at least so many code points and occurrences.
WORD_POINTS, WORD_COUNT = 5, 3


def damaged_words(docs):
    """(word, n): counts of all words; of one (document, word) in 97 by crc32, a code point is taken out."""
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z\u00c0-\u00ff]+"), 0)
    words = docs.select("doc_id", F.explode(runs).alias("run"))
    words = words.select("doc_id", F.translate("run", url_rules.UPPER, url_rules.SMALL).alias("word"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")))
    at = (h % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    words = words.select(F.when(h % 97 == 0, cut).otherwise(F.col("word")).alias("word"))
    words = words.filter(F.length("word") >= WORD_POINTS).groupBy("word").agg(F.count("*").alias("n"))
    return words.filter(F.col("n") >= WORD_COUNT)


@query
def op13_spelling(spark, folder):
    return spelling.forms(damaged_words(table(spark, folder, "documents").select("doc_id", "text")))
