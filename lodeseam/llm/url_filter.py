"""URL filters: allow and block rules by host and path, and for the rest a logistic regression.

The regression works on hashed character n-grams of `^host$path`, and is trained on the driver from
a small labelled table of URLs: at most `MAX_LABELLED` rows of it are used, the first by the md5
of the URL. Weights are whole thousandths, so that scores are exact sums. Hosts, rules, features
and scores are DataFrame functions; each row is judged alone, without any shuffle.

Defined cases. A null URL, or one without `://`, has an empty host and path, which fit no rule; an
URL too short for an n-gram is judged by the intercept. Equal URLs get equal verdicts. Columns of
the names that are added (host, path, rule, score, verdict) are replaced; others are not looked at. An
empty table gives an empty result.
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_az

GRAM = 4
BUCKETS = 4096
MAX_LABELLED = 100_000
ROUNDS = 300
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
#: Words of the labelled table's hosts.
BLOCKED_WORDS = ["casino", "poker", "betting", "free-bets", "bets", "jackpot", "slots", "lottery", "pills", "cheap-pills", "viagra", "pharma-deals", "spam", "spam-farm", "link-farm", "adult", "adult-x", "xxx", "porn", "escort", "ads", "ads-track", "adserver", "tracker", "clickbait", "malware", "phishing", "warez", "payday-loans", "fake-watches", "win-prize", "casino-win"]
ALLOWED_WORDS = ["news", "library", "university", "school", "museum", "science", "garden", "history", "weather", "theatre", "music", "travel", "recipes", "journal", "archive", "the-times", "city-council", "health", "sports", "docs", "there", "other", "thing", "tion", "nation", "station", "herein", "inland", "thereon", "ering", "ention", "onion", "anderen", "heredity", "threshold", "ethnic"]
SHAPES = ["http://{}.example.com/en/{}", "https://www.{}.example.org/de/{}.html", "https://m.{}.example.net/fr/{}/", "http://blog.{}.example.com/es/{}?page=2", "https://{}-online.example.net/en/{}#top", "https://{}.example.com/page/{}"]


def labelled_urls() -> list[tuple[str, int]]:
    """The small labelled table: (url, 1 to block or 0 to allow)."""
    return [(shape.format(word, 1009 * (i + 1) * (k + 1) % 90_000), label) for words, label in ((BLOCKED_WORDS, 1), (ALLOWED_WORDS, 0)) for i, word in enumerate(words) for k, shape in enumerate(SHAPES)]


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = lower_az(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _parts(df: DataFrame) -> DataFrame:
    host, path = host_path(F.col("url"))
    return df.withColumns({"host": host, "path": path})


def grams(df: DataFrame) -> DataFrame:
    """Adds _f: the hashed n-grams of `^host$path`, from columns host and path."""
    text = F.concat(F.lit("^"), F.col("host"), F.lit("$"), lower_az(F.col("path")))
    places = F.sequence(F.lit(1), F.length("_u") - (GRAM - 1))
    hashed = F.transform(places, lambda i: F.conv(F.substring(F.md5(F.substring("_u", i, F.lit(GRAM))), 1, 3), 16, 10).cast("int"))
    return df.withColumn("_u", text).withColumn("_f", F.when(F.length("_u") >= GRAM, hashed).otherwise(F.array().cast("array<int>"))).drop("_u")


def fit(rows: list[list[int]], labels: list[int]) -> tuple[list[int], int]:
    """Weights of the buckets and the intercept in thousandths, by gradient descent with a small ridge."""
    x = np.zeros((len(rows), BUCKETS))
    for r, features in zip(x, rows, strict=True):
        np.add.at(r, features, 1.0)
    y, w, b = np.array(labels, float), np.zeros(BUCKETS), 0.0
    for _ in range(ROUNDS):
        e = 1 / (1 + np.exp(-(x @ w + b))) - y
        w -= 0.5 * (x.T @ e / len(y) + 0.001 * w)
        b -= 0.5 * e.mean()
    return [int(v) for v in np.round(w * 1000)], int(round(b * 1000))


@cache
def default_model(spark: SparkSession) -> tuple[list[int], int]:
    return train(spark.createDataFrame(labelled_urls(), "url string, label int"))


def train(labelled: DataFrame) -> tuple[list[int], int]:
    """A model from (url, label 0 or 1); rows without either are left out."""
    rows = grams(_parts(labelled.filter("url IS NOT NULL AND label IS NOT NULL"))).orderBy(F.md5("url"), "label").limit(MAX_LABELLED).select("_f", "label").collect()
    if not rows:
        return [0] * BUCKETS, -1
    return fit([r["_f"] for r in rows], [r["label"] for r in rows])


def _fits(rule: str) -> Column:
    host, slash, path = rule.partition("/")
    return ((F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))) & F.startswith(F.col("path"), F.lit(slash + path))


def judge(df: DataFrame, rules: list[tuple[str, str]], model: tuple[list[int], int]) -> DataFrame:
    """The rows of `df` (url and others) with host, path, rule, score (thousandths of log odds) and verdict."""
    weights, intercept = model
    x = grams(_parts(df))
    rule = F.coalesce(*(F.when(_fits(r), r) for r, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0]))), F.lit(None).cast("string"))
    table = F.from_json(F.lit(json.dumps(weights)), "array<int>")
    score = F.aggregate("_f", F.lit(intercept).cast("long"), lambda t, f: t + F.get(table, f))
    x = x.withColumns({"rule": rule, "score": score}).drop("_f")
    verdict = F.when(F.col("score") > 0, "block").otherwise("allow")
    for r, v in rules:
        verdict = F.when(F.col("rule") == r, v).otherwise(verdict)
    return x.withColumn("verdict", verdict)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, RULES, default_model(spark)).select("page_id", "host", "path", "rule", "verdict")


def oracle() -> str:
    """SQL for DuckDB, with the weights of the model written out. It counts n-grams in Python only to train."""
    import hashlib

    def features(url: str) -> list[int]:
        host, slash, path = url.split("://")[1].split("?")[0].split("#")[0].partition("/")
        u = f"^{host.lower()}${(slash + path).lower()}"
        return [int(hashlib.md5(u[i : i + GRAM].encode()).hexdigest()[:3], 16) for i in range(len(u) - GRAM + 1)]

    rows = sorted(labelled_urls(), key=lambda r: (hashlib.md5(r[0].encode()).hexdigest(), r[1]))
    weights, intercept = fit([features(u) for u, _ in rows], [y for _, y in rows])
    fits = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN '{h}/{p}'" for h, p in (r.split("/", 1) for r, _ in sorted(RULES, key=lambda r: (-len(r[0]), r[0]))))
    verdicts = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES)
    az = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""
WITH r AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), {az}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
q AS (SELECT *, CASE {fits} END AS rule, '^' || host || '$' || translate(path, {az}) AS u FROM p),
s AS (SELECT page_id, host, path, rule, {intercept} + coalesce(list_sum(list_transform(range(1, length(u) - {GRAM - 2}), lambda i: ([{", ".join(map(str, weights))}])[('0x' || substr(md5(substr(u, i, {GRAM})), 1, 3))::INT + 1])), 0) AS score FROM q)
SELECT page_id, host, path, rule, CASE rule {verdicts} ELSE CASE WHEN score > 0 THEN 'block' ELSE 'allow' END END AS verdict FROM s
"""
