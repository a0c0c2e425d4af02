"""URL verdicts: host rules first, then naive Bayes over segmented host and path words.

Rules (verdict, "host/path") fit their host and its subdomains where the url's path starts with theirs; the longest
wins. Other urls are judged by the method. Host labels are split into words by unigram Viterbi: word counts come from
the visible words of all pages, every substring of a distinct label up to ``longest_word`` signs is joined
with the counts, and a dynamic program picks the most likely split; unknown strings cost a factor of ten a sign. A
multinomial naive Bayes then scores the segmented host words and the path words. It learns from the urls that the rules
decide (words that occur in a rule itself are left out, as they only repeat the rule) and from a short list of seed
words. A word is taught by *hosts*: each host that has it counts once, shared between the verdicts of its urls, so a
host of many pages weighs no more than another one. Host words and path words are a multinomial each, and a word whose
hosts are blocked about as often as all hosts says nothing. Both classes start alike (no prior): what no telling word
speaks against is allowed. Counts, labels and scores are joins and aggregations over distinct hosts and urls; nothing is
collected.

Defined results: null urls or urls without ``://`` have an empty host and path, fit no rule, have no word and are
allowed. Repeated rows give repeated results, null page_ids are kept, extra columns are ignored. An empty table gives an
empty result. Scores above 0 are blocked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words that mark unwanted hosts before any url is seen.
BLOCK_SEEDS = ("adult", "bet", "bets", "casino", "cheap", "farm", "free", "loan", "pills", "poker", "porn", "spam", "win", "xxx")


@dataclass(frozen=True)
class UrlConfig:
    rules: tuple[tuple[str, str], ...]
    longest_word: int = 20
    smoothing: float = 1.0
    seeds: tuple[str, ...] = BLOCK_SEEDS
    seed_weight: float = 20.0  #: hosts that a seed word counts for
    least_deviation: float = 1.0  #: of a telling word's blocked hosts from the share of all, in standard deviations
    host_words: bool = True  #: off: path words alone are judged (to see what the host words change)


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty if it is null or has no ``://``."""
    rest = F.coalesce(F.expr("substring(u, instr(u, '://') + 3)"), F.lit(""))
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def split_urls(pages: DataFrame) -> DataFrame:
    """(page_id, host, path)."""
    host, path = parts(F.col("u"))
    return pages.select("page_id", F.col("url").alias("u")).select("page_id", host.alias("host"), path.alias("path"))


def rule_of(cfg: UrlConfig) -> Column:
    """The longest fitting rule, as struct(rule, verdict), or null; ties go to the longer host."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(cfg.rules, key=lambda r: (len(r[1]), len(r[1].split("/")[0]))):
        host, _, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def letters(text: Column) -> Column:
    """Runs of a-z of a text (A-Z lowered)."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), "[^a-z]+"), lambda w: w != "")


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n) over the visible words of every page; not of urls, whose labels are what is to be split."""
    visible = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    words = F.explode(letters(visible)).alias("word")
    return pages.select(words).groupBy("word").agg(F.count("*").alias("n"))


def segment_labels(spark: SparkSession, labels: DataFrame, counts: DataFrame, cfg: UrlConfig) -> DataFrame:
    """(label, words) of distinct labels (runs of a-z) by unigram Viterbi."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    longest = cfg.longest_word
    spots = labels.select("label", F.explode(F.sequence(F.lit(1), F.length("label"))).alias("start"))
    spots = spots.select("label", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("label") - F.col("start") + 1))).alias("size"))
    spots = spots.select("label", "start", "size", F.expr("substring(label, start, size)").alias("word"))
    known = spots.join(counts, "word").groupBy("label").agg(F.collect_list(F.struct("start", "size", "n")).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for label, found in zip(batch.column("label").to_pylist(), batch.column("known").to_pylist()):
                seen = {(k["start"] - 1, k["size"]): k["n"] for k in found or ()}
                words.append(viterbi(label, seen, total, longest))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(words, pa.list_(pa.string()))], ["label", "words"])

    return labels.join(known, "label", "left").mapInArrow(run, "label string, words array<string>")


def viterbi(label: str, seen: dict[tuple[int, int], int], total: float, longest: int) -> list[str]:
    """The most likely split; equally likely splits end in the longer last word."""
    unknown = [math.log(10.0 / total) - size * math.log(10.0) for size in range(longest + 1)]
    known = {k: math.log(n / total) for k, n in seen.items()}
    best, back = [0.0], [0]
    for end in range(1, len(label) + 1):
        top, last = -math.inf, 0
        for size in range(1, min(longest, end) + 1):
            p = best[end - size] + known.get((end - size, size), unknown[size])
            if p >= top:
                top, last = p, size
        best.append(top)
        back.append(last)
    out, end = [], len(label)
    while end:
        out.append(label[end - back[end] : end])
        end -= back[end]
    return out[::-1]


def url_tokens(spark: SparkSession, urls: DataFrame, counts: DataFrame, cfg: UrlConfig) -> DataFrame:
    """(host, path, token) of distinct urls: host words after segmentation and path words; digits count as ``<num>``."""
    own = sorted({w for _, rule in cfg.rules for w in rule.replace("/", ".").split(".") if w})
    hosts = urls.select("host").distinct()
    labels = hosts.select("host", F.explode(letters(F.col("host"))).alias("label")).where(~F.col("label").isin(own))
    split = segment_labels(spark, labels.select("label").distinct(), counts, cfg)
    host_words = labels.join(split, "label").groupBy("host").agg(F.flatten(F.collect_list("words")).alias("host_words"))
    path_words = F.filter(
        F.split(F.regexp_replace(F.translate("path", UPPER, LOWER), "[0-9]+", " 0 "), "[^a-z0]+"), lambda w: (w != "") & ~w.isin(own)
    )
    marked = F.transform(path_words, lambda w: F.concat(F.lit("/"), F.when(w == "0", "<num>").otherwise(w)))
    empty = F.array().cast("array<string>")
    tokens = F.concat(F.coalesce("host_words", empty) if cfg.host_words else empty, marked)
    return urls.join(host_words, "host", "left").select("host", "path", F.explode(tokens).alias("token"))


def judged(spark: SparkSession, pages: DataFrame, cfg: UrlConfig) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, n_words) of every row of (page_id, url, html): score is null under a rule,
    n_words counts the telling words it comes from."""
    rows = split_urls(pages).withColumn("hit", rule_of(cfg))
    urls = materialise(
        spark, rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.first("hit").alias("hit")), "urls"
    )
    known = spark.createDataFrame([(w, int(cfg.seed_weight)) for w in cfg.seeds], "word string, n long")
    counts = materialise(spark, word_counts(pages).unionByName(known).groupBy("word").agg(F.sum("n").alias("n")), "url-words")
    tokens = materialise(spark, url_tokens(spark, urls.select("host", "path"), counts, cfg), "url-tokens")
    blocked = F.when(F.col("hit.verdict") == "block", F.col("n")).otherwise(0)
    by_host = tokens.distinct().join(urls.where("hit is not null"), ["host", "path"]).groupBy("token", "host").agg(
        (F.sum(blocked) / F.sum("n")).alias("share"))
    taught = by_host.groupBy("token").agg(F.sum("share").alias("block"), F.sum(1 - F.col("share")).alias("allow"))
    seeds = spark.createDataFrame([(w, cfg.seed_weight, 0.0) for w in cfg.seeds], "token string, seed_block double, seed double")
    # Host words and path words are a multinomial each. The classes' sizes are those of the taught words: seeds speak for
    # themselves, not against every other word.
    model = materialise(spark, taught.join(seeds, "token", "full_outer").select(
        "token", F.col("token").startswith("/").alias("of_path"), F.col("seed").isNotNull().alias("seeded"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("block", "allow", "seed_block")]), "url-model")
    sizes = model.groupBy("of_path").agg(F.sum("block").alias("b"), F.sum("allow").alias("a"), F.count("*").alias("v"))
    s = cfg.smoothing
    sized = model.join(F.broadcast(sizes), "of_path")  # two rows
    share = urls.where("hit is not null").groupBy("host").agg((F.sum(blocked) / F.sum("n")).alias("share")).agg(F.avg("share")).first()[0]
    hosts, base = F.col("block") + F.col("allow"), F.lit(share or 0.0)  # of all taught hosts, blocked
    deviation = F.abs(F.col("block") - hosts * base) / F.nullif(F.sqrt(hosts * base * (1 - base)), F.lit(0.0))
    b, a = F.col("block") + F.col("seed_block"), F.col("allow")
    weight = F.log((b + s) / (F.col("b") + s * F.col("v"))) - F.log((a + s) / (F.col("a") + s * F.col("v")))
    telling = sized.where(F.col("seeded") | (deviation >= cfg.least_deviation)).select("token", weight.alias("weight"))
    scores = tokens.join(telling, "token").groupBy("host", "path").agg(F.sum("weight").alias("evidence"), F.count("*").alias("found"))
    verdicts = urls.join(scores, ["host", "path"], "left").select(
        "host", "path", F.col("hit.rule").alias("rule"), F.col("hit.verdict").alias("given"),
        F.when(F.col("hit").isNull(), F.coalesce("evidence", F.lit(0.0))).alias("score"), F.coalesce("found", F.lit(0)).alias("n_words"),
    )
    out = rows.drop("hit").join(verdicts, ["host", "path"])
    return out.select(
        "page_id", "host", "path", "rule",
        F.coalesce("given", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score", "n_words",
    )
