"""Queries that hold operators without tables of their own against values worked out by hand, or against SQL over made-up columns of the driver's tables.

The names in brackets are those of the operator inventory.
"""

from __future__ import annotations

import csv
import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from ..functions import html, text, urls
from ..functions import vocabulary as V
from ..operators import corpus, crawl, links
from ..sources import catalog, config, pages
from .queries import query, table

SITE = "https://school.test/"


def values(rows: list[tuple], names: str) -> str:
    """SQL for rows of plain values."""
    def cell(x) -> str:
        return "NULL" if x is None else str(x).upper() if isinstance(x, (bool, int, float)) else f"'{x}'"

    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) t({names})"


# ---------------------------------------------------------------- over the driver's tables

@query("SELECT event_id, user_id, sum(CASE WHEN event_type <> coalesce(was, '') THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS version FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS was FROM events)")
def content_versions(spark, sf_dir):
    """[O3] Versions of each URL, counted where its content's hash changes."""
    x = table(spark, sf_dir, "events").select(F.col("user_id").alias("url"), F.col("event_id").alias("ts"), F.col("event_type").alias("sha256"))
    return corpus.versions(x).select(F.col("ts").alias("event_id"), F.col("url").alias("user_id"), F.col("version").cast("long").alias("version"))


@query("SELECT sha256(p_name) AS sha256, list_aggregate(list_sort(list_distinct(list(p_brand))), 'string_agg', ',') AS urls FROM part GROUP BY p_name")
def artifact_aliases(spark, sf_dir):
    """[O3] One artifact for each content, with all its names."""
    x = table(spark, sf_dir, "part").select(F.col("p_brand").alias("url"), F.col("p_name").cast("binary").alias("content"))
    return corpus.artifacts(x).select("sha256", F.array_join("urls", ",").alias("urls"))


@query("SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'pdf' WHEN 1 THEN 'zip' WHEN 2 THEN 'html' WHEN 3 THEN 'unknown' ELSE CASE WHEN regexp_matches(ltrim(html), '(?i)^(<!doctype html|<html)') THEN 'html' ELSE 'unknown' END END AS kind FROM pages")
def detected_types(spark, sf_dir):
    """[O2] Kinds by the first bytes; HTML that calls itself something else is found out."""
    heads = F.get(F.array(*map(F.lit, ["%PDF-1.7 ", "PK\x03\x04", " \n<HTML>", "PDF ", ""])), (F.col("page_id") % 5).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", corpus.detected_type(F.concat(heads, "html").cast("binary")).alias("kind"))


@query("SELECT doc_id FROM documents WHERE length(text) < 50 OR CASE WHEN length(text) = 0 THEN 0 ELSE round(length(regexp_replace(text, '[^\\p{L}]', '', 'g')) / length(text), 6) END < 0.3")
def ocr_queue(spark, sf_dir):
    """[O6] Documents whose text is too thin."""
    return corpus.needs_ocr(corpus.page_checks(table(spark, sf_dir, "documents").select("doc_id", "text"))).select("doc_id")


@query("SELECT o_orderkey AS doc_id FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 3 <> 0 AND o_orderkey % 10 <> 1")
def download_eligibility(spark, sf_dir):
    """[O1] Discovered rows with a URL that aren't pilots."""
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "O", "DISCOVERED").otherwise("READY")
    x = o.select(F.col("o_orderkey").alias("doc_id"), status.alias("status"), F.when(F.col("o_orderkey") % 3 != 0, "https://x.test/").otherwise("").alias("source_url"))
    return corpus.download_queue(x, o.filter("o_orderkey % 10 = 1").select(F.col("o_orderkey").alias("doc_id"))).select("doc_id")


@query("""
SELECT p_partkey, array_to_string(list_filter([CASE WHEN len(o) < 2 THEN 'too_few_options' END, CASE WHEN len(list_distinct(o)) < len(o) THEN 'repeated_options' END,
  CASE WHEN list_contains(o, '') THEN 'empty_option' END, CASE WHEN p_partkey % 6 = 5 OR p_partkey % 6 >= len(o) THEN 'no_answer' END], lambda x: x IS NOT NULL), ',') AS problems
FROM (SELECT p_partkey, list_transform(string_split(p_name, ' ') || CASE p_partkey % 4 WHEN 0 THEN ['', 'x'] WHEN 1 THEN [upper(string_split(p_name, ' ')[1]) || ' '] ELSE [] END, lambda s: lower(trim(s))) AS o FROM part)""")
def question_structure(spark, sf_dir):
    """[O14] Problems of multiple-choice items made of the parts' names."""
    own, k = F.split("p_name", " "), F.col("p_partkey")
    more = F.when(k % 4 == 0, F.array(F.lit(""), F.lit("x"))).when(k % 4 == 1, F.array(F.concat(F.upper(F.get(own, F.lit(0))), F.lit(" ")))).otherwise(F.array().cast("array<string>"))
    x = table(spark, sf_dir, "part").select("p_partkey", F.concat(own, more).alias("options"), F.when(k % 6 == 5, None).otherwise(k % 6).cast("int").alias("answer"))
    return corpus.question_checks(x).select("p_partkey", F.array_join("problems", ",").alias("problems"))


@query("""
WITH p AS (SELECT c_custkey AS id, c_nationkey AS n, c_custkey % 40 AS y FROM customer), s AS (SELECT s_suppkey AS id, s_nationkey AS n, s_suppkey % 40 AS y FROM supplier),
p1 AS (SELECT n, y, min(id) AS id FROM p GROUP BY n, y HAVING count(*) = 1), s1 AS (SELECT n, y, min(id) AS id FROM s GROUP BY n, y HAVING count(*) = 1)
SELECT p1.id::VARCHAR AS paper_id, s1.id::VARCHAR AS scheme_id FROM p1 JOIN s1 USING (n, y)""")
def paper_scheme_pairs(spark, sf_dir):
    """[O15] Papers and marking schemes by all keys, where both are the only ones."""
    keyed = lambda name, i, n: table(spark, sf_dir, name).select(F.col(i).cast("string").alias("doc_id"), F.col(n).cast("string").alias("subject"), (F.col(i) % 40).cast("string").alias("year"))
    return corpus.paper_pairs(keyed("customer", "c_custkey", "c_nationkey"), keyed("supplier", "s_suppkey", "s_nationkey"), ["subject", "year"]).select("paper_id", "scheme_id")


@query("SELECT sum(s_suppkey)::BIGINT AS parameters, sum(s_suppkey) <= 8000000000 AS size_ok, false AS dates_ok FROM supplier")
def model_limits(spark, sf_dir):
    """[O21] Summed parameters and the cutoff date."""
    x = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("parameters"), F.date_add(F.lit("2025-01-01").cast("date"), (F.col("s_suppkey") % 400).cast("int")).alias("release_date"))
    return corpus.model_manifest(x, 8_000_000_000, "2025-01-01")


@query("SELECT n_nationkey::VARCHAR AS id, CASE WHEN n_nationkey % 4 = 0 THEN 'disabled' WHEN n_nationkey % 3 = 0 THEN 'unverified' WHEN n_nationkey % 5 = 0 THEN 'missing_url' ELSE '' END AS skip_reason FROM nation")
def source_eligibility(spark, sf_dir):
    """[E3, E4] Why sources are left out."""
    k = F.col("n_nationkey")
    x = table(spark, sf_dir, "nation").select(k.cast("string").alias("id"), (k % 4 != 0).alias("enabled"), (k % 3 != 0).alias("verified"), F.when(k % 5 != 0, "https://x.test/").otherwise("").alias("base_url"))
    return crawl.eligibility(x).select("id", F.coalesce("skip_reason", F.lit("")).alias("skip_reason"))


@query("SELECT event_id, CASE WHEN w <= 30 THEN w END AS wait FROM (SELECT event_id, greatest(power(2.0, event_id % 6), CASE event_id % 7 WHEN 0 THEN 17.0 WHEN 1 THEN 31.0 ELSE 0.0 END)::DOUBLE AS w FROM events)")
def retry_waits(spark, sf_dir):
    """[L3] Waits before the next attempt; none where it is over the budget."""
    k = F.col("event_id")
    said = F.when(k % 7 == 0, " 17").when(k % 7 == 1, "31").otherwise("soon")
    return table(spark, sf_dir, "events").select("event_id", crawl.retry_wait((k % 6).cast("double"), text.retry_after_seconds(said, F.lit("2024-01-01 00:00:00").cast("timestamp")), 30.0).alias("wait"))


@query("""
SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey % 50 ORDER BY l_orderkey, l_linenumber) AS n FROM lineitem WHERE l_quantity < 10) WHERE n <= 20""")
def rejected_samples(spark, sf_dir):
    """[I1] The first rejected decisions of each source."""
    x = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 50).alias("source_id"), (F.col("l_quantity") >= 10).alias("accepted"), "l_orderkey", "l_linenumber")
    return crawl.samples(x, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


@query("""
WITH d AS (SELECT l_orderkey % 20 AS source_id, l_partkey % 300 AS t, l_quantity >= 25 AS accepted, l_orderkey * 10 + l_linenumber AS seq,
  CASE l_suppkey % 4 WHEN 0 THEN 'navigation' WHEN 1 THEN 'site infrastructure' WHEN 2 THEN 'category/listing page' ELSE 'below candidate threshold' END AS why FROM lineitem),
f AS (SELECT * FROM d WHERE t % 10 <> 0 QUALIFY row_number() OVER (PARTITION BY source_id, t, accepted ORDER BY seq) = 1)
SELECT source_id, count(*) FILTER (WHERE accepted) AS candidates_discovered, count(*) FILTER (WHERE NOT accepted AND why IN ('navigation', 'site infrastructure')) AS navigation_pages_excluded,
  count(*) FILTER (WHERE NOT accepted AND why = 'category/listing page') AS listing_pages_excluded FROM f GROUP BY source_id""")
def first_decision_counts(spark, sf_dir):
    """[G3, G4, H1] First decisions of each URL within its source's domain, and what was left out by kind."""
    reasons = F.array(*map(F.lit, ["navigation", "site infrastructure", "category/listing page", "below candidate threshold"]))
    t = F.col("l_partkey") % 300
    x = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 20).alias("source_id"), (F.col("l_quantity") >= 25).alias("accepted"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.get(reasons, (F.col("l_suppkey") % 4).cast("int")).alias("rejection_reason"), F.concat(F.when(t % 10 == 0, "https://other.test/").otherwise(SITE), t).alias("target"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    # orders repeat their line numbers: among rows of one seq the first of the table goes first
    return crawl.excluded_counts(crawl.first_decisions(x, F.lit(SITE), ["seq", "file", "row"]))


@query("""
WITH n AS (SELECT doc_id, t, nfc_normalize(t) AS c FROM (SELECT doc_id, text || CASE doc_id % 4 WHEN 0 THEN chr(10) || 'e' || chr(769) || ' 5  km' WHEN 1 THEN chr(10) || ' ' WHEN 2 THEN ' not\t0.5 ' ELSE '' END AS t FROM documents)),
s AS (SELECT *, array_to_string(list_transform(string_split(c, chr(10)), lambda s: trim(regexp_replace(s, '[ \t\r\f]+', ' ', 'g'))), chr(10)) AS q FROM n),
f AS (SELECT *, coalesce(array_to_string(list_filter(string_split(q, chr(10)), lambda s: s <> ''), chr(10)), '') AS r FROM s)
SELECT doc_id, md5(r) AS cleaned_md5, array_to_string(list_filter([CASE WHEN c <> t THEN 'nfc' END, CASE WHEN q <> c THEN 'white_space' END, CASE WHEN r <> q THEN 'empty_lines' END], lambda x: x IS NOT NULL), ',') AS transforms FROM f""")
def clean_log(spark, sf_dir):
    """[O7] Conservative cleaning with a record of what was done; texts get decomposed letters, units and white space put on."""
    k = F.col("doc_id") % 4
    more = F.when(k == 0, "\ne\u0301 5  km").when(k == 1, "\n ").when(k == 2, " not\t0.5 ").otherwise("")
    x = corpus.cleaned(table(spark, sf_dir, "documents").select("doc_id", F.concat("text", more).alias("text")))
    return x.select("doc_id", F.md5("cleaned").alias("cleaned_md5"), F.array_join("transforms", ",").alias("transforms"))


@query("""
WITH l AS (SELECT doc_id, i, raw, trim(raw) AS line FROM (SELECT doc_id, unnest(ls) AS raw, unnest(range(len(ls))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))),
o AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT doc_id) >= 3), x AS (SELECT l.*, line IN (SELECT line FROM o) AS gone FROM l)
SELECT doc_id, md5(coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_md5, coalesce(string_agg(i::VARCHAR, ',' ORDER BY i) FILTER (WHERE gone), '') AS removed_at FROM x GROUP BY doc_id""")
def boilerplate_removal(spark, sf_dir):
    """[O8] Lines of three documents or more taken out, with their places as evidence."""
    x = corpus.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), 3)
    return x.select("doc_id", F.md5("kept_text").alias("kept_md5"), F.array_join(F.transform("removed", lambda p: p["at"].cast("string")), ",").alias("removed_at"))


@query("""
WITH s AS (SELECT doc_id, lang, n_chars, count(*) OVER (PARTITION BY lang) AS t, row_number() OVER (PARTITION BY lang ORDER BY md5('share:' || doc_id), doc_id) AS k FROM documents)
SELECT lang, n, stratum_size, round(p, 9) AS share, round(sqrt(p * (1 - p) / n * CASE WHEN stratum_size > 1 THEN (stratum_size - n) / (stratum_size - 1) ELSE 0 END), 9) AS standard_error
FROM (SELECT lang, count(*) AS n, max(t) AS stratum_size, avg((n_chars >= 1000)::INT) AS p FROM s WHERE k <= 20 GROUP BY lang)""")
def sample_uncertainty(spark, sf_dir):
    """[O13] Shares in a stratified sample, with their standard errors."""
    x = corpus.stratified_sample(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), ["lang"], 20, "share")
    out = corpus.sampled_share(x, ["lang"], F.col("n_chars") >= 1000)
    return out.select("lang", "n", "stratum_size", F.round("share", 9).alias("share"), F.round("standard_error", 9).alias("standard_error"))


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type, event_id % 3 ORDER BY ts, event_id) = 1 AS fresh FROM events")
def stage_idempotency(spark, sf_dir):
    """[O19] Stage events that repeat an input, stage and version needn't run."""
    x = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", (F.col("event_id") % 3).alias("version"))
    return corpus.stage_runs(x, ["user_id", "event_type", "version"], ["ts", "event_id"]).select("event_id", "fresh")


@query("SELECT count(*) AS n, count(*) FILTER (WHERE a AND NOT b) AS gained, count(*) FILTER (WHERE b AND NOT a) AS lost, round((count(*) FILTER (WHERE a AND NOT b) - count(*) FILTER (WHERE b AND NOT a)) / count(*), 9) AS change FROM (SELECT quality = 1 AS b, doc_id % 3 <> 0 AS a FROM labels WHERE doc_id % 5 <> 0)")
def paired_accuracy_change(spark, sf_dir):
    """[O20] Items that two runs judge differently."""
    x = table(spark, sf_dir, "labels")
    return corpus.paired_change(x.select("doc_id", (F.col("quality") == 1).alias("ok")), x.filter("doc_id % 5 <> 0").select("doc_id", (F.col("doc_id") % 3 != 0).alias("ok")), "doc_id", "ok")


# ---------------------------------------------------------------- values worked out by hand

BLOCK_PAGE = "<title>T</title><nav><a>Menu</a></nav><header>Top</header><h1>Unit <b>1</b></h1>Intro<p>One &amp; two</p><ul><li>a<ul><li>b</li></ul></li><li>c</li></ul><h3>Next</h3><table><tr><th>k</th><td>v</td></tr></table><script>x()</script><footer>End</footer>"
BLOCKS = [(0, "heading", 1, "Unit 1"), (1, "paragraph", 0, "Intro"), (2, "paragraph", 0, "One & two"), (3, "item", 1, "a"), (4, "item", 2, "b"), (5, "item", 1, "c"), (6, "heading", 3, "Next"), (7, "cell", 0, "k"), (8, "cell", 0, "v")]


@query(values(BLOCKS, "i, kind, level, text"))
def content_block_goldens(spark, sf_dir):
    """[O4] Headings, lists, paragraphs and cells of a page, without its navigation."""
    x = spark.createDataFrame([(BLOCK_PAGE,)], "html string").select(F.posexplode(html.blocks(F.col("html"))).alias("i", "b"))
    return x.select("i", "b.kind", "b.level", "b.text")

ROBOTS = [("http://a.test", 200, "# c\nUser-agent: *\nDisallow: /private # all\nAllow: /\n\nUser-agent: lode\nDisallow: /x\n"), ("http://b.test", 404, ""), ("http://c.test", 403, ""), ("http://d.test", 503, ""), ("http://e.test", 200, "User-agent: *\nDisallow:\n"), ("http://f.test", 410, "")]
ASKED = [
    ("other/1", "http://a.test/private/1", False), ("other/1", "http://a.test/x", True), ("other/1", "http://a.test/", True), ("lodeseam/1", "http://a.test/x", False), ("lodeseam/1", "http://a.test/private/1", True),
    ("other/1", "http://b.test/", True), ("other/1", "http://c.test/a", False), ("other/1", "http://d.test/a", False), ("other/1", "http://e.test/a", True), ("other/1", "http://f.test/a", True),
]


@query(values(ASKED, "agent, url, robots_ok"))
def robots_goldens(spark, sf_dir):
    """[A6, L4] What robots files allow: absent ones all, forbidden and unavailable ones nothing."""
    robots = spark.createDataFrame(ROBOTS, "origin string, status int, body string")
    asked = spark.createDataFrame(ASKED, "agent string, url string, want boolean").drop("want")
    parts = [crawl.robots_allowed(asked.filter(F.col("agent") == a), crawl.robots_rules(robots, a)) for a in ("other/1", "lodeseam/1")]
    return parts[0].unionByName(parts[1])


FETCHED = [
    ("a", f"{SITE}a", "text/html; charset=utf-8", "<p>é", ""), ("b", "https://other.test/", "text/html", "", "external_redirect"), ("c", SITE, "application/pdf", "", "non_html"),
    ("d", f"{SITE}d", " Application/XHTML+xml ", "ok", ""), ("e", SITE, None, None, "network_error"), ("f", f"{SITE}f", "text/html; Charset='utf-16-le'", "o\0k\0", ""),
    ("g", f"{SITE}g", "text/html; charset=no-such", "x", "page_read_error"), ("h", f"{SITE}h", "text/html; charset=ascii", "é", "page_read_error"),
]


@query(values([(u, f, h.replace("\0", "") if not f else "") for u, _, _, h, f in FETCHED], "url, failure, html"))
def fetched_goldens(spark, sf_dir):
    """[A5, K2, L5, L6] Which fetched pages are taken, and why the others aren't."""
    x = spark.createDataFrame(FETCHED, "url string, final_url string, content_type string, body string, want string").drop("want").withColumns({"body": F.col("body").cast("binary"), "base_url": F.lit(SITE)})
    good, bad = pages.html_pages(x)
    return good.select("url", F.lit("").alias("failure"), "html").unionByName(bad.select("url", "failure", F.lit("").alias("html")))


@query(values([("u1",), ("u3",)], "url"))
def redirect_goldens(spark, sf_dir):
    """[F8] Pages whose final URL was reached before are left out."""
    x = spark.createDataFrame([("u1", "u1", 0), ("u2", "u1", 1), ("u3", "u4", 2), ("u4", "u4", 3)], "url string, final_url string, seq int")
    return pages.redirect_aliases(x).select("url")


#: A small site, and a crawl with limits: depth, pages, queue; then the pages in their order, the queue's peak, what was dropped, why it ended.
LINKS = {"0": ["1", "2", "3", "x.pdf"], "1": ["4", "0"], "2": ["4", "5"], "3": [], "4": ["6"]}
CRAWLS = [(3, 100, 1000, "0 1 2 3 4 5 6", 3, 0, ""), (1, 100, 1000, "0 1 2 3", 3, 0, ""), (3, 2, 1000, "0 1", 3, 0, "page_limit"), (3, 100, 2, "0 1 2 4 5 6", 2, 1, "queue_limit"), (0, 100, 1000, "0", 1, 0, "")]


@query(values(CRAWLS, "max_depth, max_pages, max_queue, visited, queue_peak, queue_dropped, stop_reason"))
def crawl_goldens(spark, sf_dir):
    """[E6, G12, I3, I4] Exact crawls with limits of depth, pages and queue."""
    rows = []
    for depth, most, queue, *_ in CRAWLS:
        seen, stats = crawl.crawl_one("0", LINKS, lambda u: not u.endswith(".pdf"), {"max_depth": depth, "max_pages_per_source": most, "max_queue": queue})
        rows.append((depth, most, queue, " ".join(seen), stats["queue_peak"], stats["queue_dropped"], stats["stop_reason"]))
    return spark.createDataFrame(rows, "max_depth int, max_pages int, max_queue int, visited string, queue_peak int, queue_dropped int, stop_reason string")


SCALARS = [
    ("last_segment", "https://x.test/a/b.pdf?q=1", "b.pdf"), ("origin", "https://x.test:81/a?b", "https://x.test:81"), ("squeezed", "  a \t b ", "a b"), ("looks_educational", "https://x.test/a.pdf", "true"),
    ("looks_educational", "https://x.test/about", "false"), ("looks_educational", "https://x.test/Physics-notes", "true"), ("retry_after", "7", "7.0"), ("retry_after", "Mon, 01 Jan 2024 00:01:00 GMT", "60.0"), ("retry_after", "Sun, 31 Dec 2023 00:01:00 GMT", "0.0"), ("retry_after", "Monday, 01-Jan-24 00:02:00 GMT", "120.0"), ("retry_after", "Mon Jan  1 00:00:30 2024", "30.0"),
    ("positive_int", "007", "true"), ("positive_int", "0", "false"), ("finite", "Infinity", "false"), ("finite", "1e3", "true"), ("grade_range", "8-9", "true"), ("grade_range", "9-8", "false"), ("doc_number", "LK-EDU-000012", "12"), ("doc_number", "LK-EDU-12", ""), ("unquoted", "a%20b", "a b"),
]


@query(values(SCALARS, "f, arg, want"))
def scalar_goldens(spark, sf_dir):
    """[B10, C5, C8, C9, C10, C11, I5] Small functions."""
    x, now = spark.createDataFrame([r[:2] for r in SCALARS], "f string, arg string"), F.lit("2024-01-01 00:00:00").cast("timestamp")
    arg = F.col("arg")
    made = {
        "last_segment": urls.last_segment(arg), "origin": urls.origin(arg), "squeezed": text.squeezed(arg), "looks_educational": text.looks_educational(arg, F.lit(""), ["physics"]), "retry_after": text.retry_after_seconds(arg, now), "positive_int": text.positive_int(arg),
        "finite": text.finite(arg), "grade_range": text.grade_range(arg), "doc_number": text.doc_number(arg), "unquoted": text.unquoted(arg),
    }
    want = F.coalesce(*(F.when(F.col("f") == k, v.cast("string")) for k, v in made.items()), F.lit(""))
    return x.select("f", "arg", want.alias("want"))


TITLES = [("/files/grade_8-maths.pdf", "Download", "", "grade 8 maths"), ("/a/b-c_d.html", "", "", "b c d"), ("/x", " Said ", "Title", "Said"), ("/x", " ", "Title", "Title"), ("/y.pdf", "Click Here", "", "y"), ("/Z", "read more", "t", "Z")]


@query(values(TITLES, "href, text, title, link_title"))
def link_title_goldens(spark, sf_dir):
    """[B7, B8, B9, D9, J2] Titles of links: what they say, or their file's name where that is generic."""
    rows = [(SITE, h, t, n, "", "") for h, t, n, _ in TITLES]
    x = spark.createDataFrame(rows, "page_url string, href string, text string, title string, before string, after string")
    return links.evaluate_links(x, V.default_taxonomy()).select("href", "text", "title", "link_title")


@query(values([("subjects", 40), ("levels", 3), ("pilots", 1)], "name, n"))
def configuration_tables(spark, sf_dir):
    """[A1, A2, A3, N5] The taxonomy (32 subjects and 8 aliases) and a pilot file as tables."""
    t = config.check_taxonomy(V.default_taxonomy())
    pilots = config.check_pilots(f'{{"schema_version": "{V.PILOT_SCHEMA}", "pilots": [{{"doc_id": "LK-EDU-000001", "title": "x"}}]}}')
    made = {"subjects": config.subjects_table(spark, t), "levels": config.levels_table(spark, t), "pilots": config.pilots_table(spark, pilots)}
    parts = [df.agg(F.lit(k).alias("name"), F.count(F.lit(1)).alias("n")) for k, df in made.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(values([("LK-EDU-000009", "https://x.test/old", "kept, so"), ("LK-EDU-000010", "https://x.test/a.pdf", ""), ("LK-EDU-000011", "https://x.test/b", "")], "doc_id, source_url, note"))
def catalog_goldens(spark, sf_dir):
    """[A4, A7, B11, E8, F5, F6, H2, H5, J1, J3, M1, M2, M3] New candidates added to a catalog file with a column of its own, twice; the second time nothing is new."""
    with tempfile.TemporaryDirectory() as folder:  # the catalog is the driver's file
        path = Path(folder, "documents.csv")
        old = dict.fromkeys(V.CATALOG_COLUMNS, "") | {"doc_id": "LK-EDU-000009", "title": "old", "status": "DISCOVERED", "document_type": "other", "source": "s", "source_url": "https://x.test/old", "note": "kept, so"}
        with path.open("w", newline="", encoding="utf-8") as f:
            w = csv.DictWriter(f, old)
            w.writeheader()
            w.writerow(old)
        new = spark.createDataFrame([(i, f"t{i}", "s", u, "other") for i, u in enumerate(["https://x.test/a.pdf#one", "https://x.test/a.pdf#two", "https://x.test/old", "https://x.test/b"])], "seq long, title string, source string, source_url string, document_type string")
        for _ in range(2):
            catalog.append_catalog(spark, str(path), new)
        with path.open(newline="", encoding="utf-8") as f:
            rows = [(r["doc_id"], r["source_url"], r["note"]) for r in csv.DictReader(f)]
    return spark.createDataFrame(rows, "doc_id string, source_url string, note string")
