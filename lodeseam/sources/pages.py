"""Fetched pages, robots files and crawl logs as tables.

Fetching itself is a matter of a connector outside Spark: what it brings (url, final_url, status,
content_type, body) is taken from a table, and the rules on it are native columns. `http_pages`
is such a connector as a Python data source; it reads nothing unless it is asked to.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import urls

HTML_BYTES, ROBOTS_BYTES = 2_000_000, 512_000
HTML_TYPES = ["text/html", "application/xhtml+xml"]
AGENT = "lodeseam-discovery/0.1 (HTML only)"
TRANSIENT = (429, 500, 502, 503, 504)


@F.pandas_udf(T.StringType())
def decoded(body: pd.Series, charset: pd.Series) -> pd.Series:
    """Bodies as text in their charset, or UTF-8; null where they aren't, or the charset is unknown."""

    def one(raw, name):
        try:
            return None if raw is None else bytes(raw).decode(name or "utf-8")
        except (UnicodeDecodeError, LookupError):
            return None

    return pd.Series([one(b, c) for b, c in zip(body, charset, strict=True)], dtype=object)


def html_pages(fetched: DataFrame, base: str = "base_url") -> tuple[DataFrame, DataFrame]:
    """(pages, rejected) of (url, final_url, content_type, body, base_url): pages have html; the others a failure.

    A final URL outside the domain, another content type, a body over the limit, or one that isn't text in
    its charset (UTF-8 where none is said) is rejected whole.
    """
    kind = F.lower(F.trim(F.substring_index("content_type", ";", 1)))
    final = urls.normalize(F.col("final_url"))
    failure = F.when(~urls.within(final, urls.normalize(F.col(base))), "external_redirect").when(~kind.isin(HTML_TYPES), "non_html").when(F.octet_length("body") > HTML_BYTES, "truncated_response").when(F.col("html").isNull(), "page_read_error")
    charset = F.regexp_extract(F.lower("content_type"), r"charset\s*=\s*[\"']?([^\s\"';]+)", 1)
    x = fetched.withColumn("html", decoded(F.when(F.octet_length("body") <= HTML_BYTES, F.col("body")), charset)).withColumns({"final_url": final, "failure": F.when(F.col("content_type").isNull() | F.col("body").isNull(), "network_error").otherwise(failure)})
    return x.filter("failure IS NULL").drop("failure", "body"), x.filter("failure IS NOT NULL").drop("body", "html")


def redirect_aliases(pages: DataFrame, order: str = "seq") -> DataFrame:
    """Pages without those whose final URL was reached before, as itself or by an earlier redirect."""
    names = pages.select(F.explode(F.array_distinct(F.array("url", "final_url"))).alias("name"), F.col(order).alias("_at")).groupBy("name").agg(F.min("_at").alias("_first"))
    x = pages.join(names, pages["final_url"] == names["name"]).drop("name")
    return x.filter(F.col("_first") >= F.col(order)).drop("_first")


def log_records(spark: SparkSession, path: str) -> DataFrame:
    """ts, level, key, value of crawl logs: one row for each key=value of a line."""
    lines = spark.read.text(path)
    parts = lines.select(F.regexp_extract("value", r"^(\S+ \S+) (\w+) (.*)$", 1).alias("ts"), F.regexp_extract("value", r"^(\S+ \S+) (\w+) (.*)$", 2).alias("level"), F.regexp_extract("value", r"^(\S+ \S+) (\w+) (.*)$", 3).alias("message"))
    pairs = F.arrays_zip(F.regexp_extract_all("message", F.lit(r"(\w+)=(\S+)"), F.lit(1)).alias("key"), F.regexp_extract_all("message", F.lit(r"(\w+)=(\S+)"), F.lit(2)).alias("value"))
    return parts.filter("level <> ''").select("ts", "level", F.explode(pairs).alias("p")).select("ts", "level", "p.key", "p.value")


class _Part(InputPartition):
    def __init__(self, urls_: list[str]) -> None:
        super().__init__(0)
        self.urls = urls_


def seconds_asked(header: str) -> float:
    """The wait that a Retry-After header asks for; 0 where it says nothing."""
    if header.strip().isdigit():
        return float(header)
    try:
        return max(0.0, (parsedate_to_datetime(header) - datetime.now(UTC)).total_seconds())
    except (TypeError, ValueError):
        return 0.0


def same_site(url: str, first: str) -> bool:
    """Whether a hop stays on the host of the first URL, or below it, by HTTP(S)."""
    a, b = urllib.parse.urlsplit(url), urllib.parse.urlsplit(first)
    return a.scheme in ("http", "https") and bool(a.hostname) and (a.hostname == b.hostname or a.hostname.endswith(f".{b.hostname}"))


class _Hops(urllib.request.HTTPRedirectHandler):
    """Follows redirects within the site only, and asks for each hop whether there is a request left."""

    def __init__(self, first: str, charge) -> None:
        self.first, self.charge = first, charge

    def redirect_request(self, req, fp, code, msg, headers, newurl):
        if not same_site(newurl, self.first) or not self.charge():
            return None
        return super().redirect_request(req, fp, code, msg, headers, newurl)


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.urls = options.get("urls", "").split()
        self.delay, self.timeout, self.retries = float(options.get("delay", 1)), float(options.get("timeout", 15)), int(options.get("retries", 2))
        self.max_wait, self.max_requests, self.max_seconds = float(options.get("max_wait", 30)), int(options.get("max_requests", 250)), float(options.get("max_seconds", 300))
        self.left, self.end = self.max_requests, None

    def partitions(self):
        """One part for each host, so that a host is asked by one task, politely."""
        hosts: dict[str, list[str]] = {}
        for u in self.urls:
            hosts.setdefault(u.split("/")[2] if u.count("/") > 1 else "", []).append(u)
        return [_Part(x) for x in hosts.values()] or [_Part([])]

    def _charge(self) -> bool:
        """Takes one request off the host's budget; false where none, or no time, is left."""
        self.left -= 1
        return self.left >= 0 and (self.end is None or time.monotonic() < self.end)

    def _get(self, url: str) -> tuple:
        opener = urllib.request.build_opener(_Hops(url, self._charge))
        for attempt in range(self.retries + 1):
            if not self._charge():
                break
            try:
                with opener.open(urllib.request.Request(url, headers={"User-Agent": AGENT}), timeout=self.timeout) as r:
                    return url, r.geturl(), r.status, r.headers.get_content_type(), r.read(HTML_BYTES + 1)
            except urllib.error.HTTPError as e:
                status = e.code
                asked = e.headers.get("Retry-After", "") if e.headers else ""
            except OSError:
                status, asked = None, ""
            wait = max(2.0**attempt, seconds_asked(asked))
            if attempt == self.retries or wait > self.max_wait or status is not None and status not in TRANSIENT:
                return url, url, status, None, None
            time.sleep(wait)
        return url, url, None, None, None

    def read(self, partition):
        self.left, self.end = self.max_requests, time.monotonic() + self.max_seconds
        for i, url in enumerate(partition.urls):
            time.sleep(self.delay if i else 0)
            yield self._get(url)


class HttpPages(DataSource):
    """spark.read.format("http_pages").option("urls", "..."): url, final_url, status, content_type, body."""

    @classmethod
    def name(cls) -> str:
        return "http_pages"

    def schema(self) -> str:
        return "url string, final_url string, status int, content_type string, body binary"

    def reader(self, schema):
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(HttpPages)
