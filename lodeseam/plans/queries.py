"""The engine's queries over the driver's tables, and DuckDB SQL for those that SQL can express.

Operators with no data of their own kind here (an educational link, a catalog, a run) get it from
the tables by plain expressions, or from the golden cases at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import html, text, urls
from ..functions import vocabulary as V
from ..operators import corpus, crawl, links
from ..sources import catalog

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- pages and links

_Q = r"/%:@!$&''()*+,;=\-._~A-Za-z0-9"
_UNESCAPE = "{}"
for _name, _char in html.ENTITIES:
    _UNESCAPE = f"replace({_UNESCAPE}, '{_name}', '{_char.replace(chr(39), chr(39) * 2)}')"
_SHOWN = "regexp_replace(html, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<template\\b.*?</template\\s*>|<!--.*?-->', '', 'g')"
_NORM = "CASE WHEN regexp_matches(u, '^https?://[^/?]+$') THEN u || '/' ELSE u END"
_LINKS = f"""
links AS (SELECT page_id, url, unnest(hs) AS href, unnest(range(len(hs))) AS link_idx FROM (SELECT page_id, url, list_transform(regexp_extract_all({_SHOWN}, '(?is)<a\\s[^>]*?href="([^"]+)"', 1), lambda h: {_UNESCAPE.format("h")}) AS hs FROM pages)),
targets AS (SELECT page_id, link_idx, href, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host,
  regexp_extract(url, '^(https?://[^/?#]*)', 1) || coalesce(list_aggregate(list_transform(string_split(href, ''), lambda c: CASE WHEN regexp_matches(c, '[{_Q}]') THEN c ELSE url_encode(c) END), 'string_agg', ''), '') AS target FROM links)"""


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = pages.select("page_id", "url", F.posexplode(html.hrefs(F.col("html"))).alias("link_idx", "href"))
    return out.withColumn("target", urls.resolve(F.col("url"), F.col("href")))


@query(f"SELECT page_id, {_NORM} AS norm FROM (SELECT page_id, regexp_replace(url, '#.*$', '') AS u FROM pages)")
def url_normalize(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.normalize(F.col("url")).alias("norm"))


@query(f"WITH {_LINKS} SELECT page_id, link_idx::INT AS link_idx, href FROM targets")
def link_explode(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", "link_idx", "href")


@query(f"WITH {_LINKS} SELECT page_id, link_idx::INT AS link_idx, target FROM targets")
def link_resolve(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", "link_idx", "target")


@query(f"WITH {_LINKS} SELECT host, count(*) AS n_links, count(*) FILTER (WHERE host = 'example.org' OR ends_with(host, '.example.org')) AS n_in_domain, count(DISTINCT target) AS n_targets FROM targets GROUP BY host")
def link_domains(spark, sf_dir):
    """Links by the host of their page, and those of them within one domain."""
    x = _links(spark, sf_dir)
    return x.groupBy(urls.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n_links"), F.count_if(urls.within(F.col("target"), F.lit("https://example.org/"))).alias("n_in_domain"), F.count_distinct("target").alias("n_targets"))


@query("""
WITH h AS (SELECT DISTINCT regexp_extract(url, '^https?://([^/?#]*)', 1) AS host FROM pages),
b AS (SELECT host AS base FROM h UNION SELECT regexp_replace(host, '^[^.]*[.]', '') FROM h)
SELECT base, count(*) AS n_hosts FROM h JOIN b ON host = base OR ends_with(host, '.' || base) GROUP BY base""")
def in_domain_hosts(spark, sf_dir):
    """Hosts within each base: hosts have few labels, so each is joined by its suffixes, not with all bases."""
    host = table(spark, sf_dir, "pages").select(urls.host(F.col("url")).alias("host")).distinct()
    base = host.select(F.col("host").alias("base")).union(host.select(F.regexp_replace("host", "^[^.]*[.]", ""))).distinct()
    labels = F.split("host", "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    pairs = host.select("host", F.explode(suffixes).alias("base")).join(base, "base")
    inside = urls.within(F.concat(F.lit("https://"), F.col("host"), F.lit("/")), F.concat(F.lit("https://"), F.col("base"), F.lit("/")))
    return pairs.filter(inside).groupBy("base").agg(F.count(F.lit(1)).alias("n_hosts"))


@query(f"SELECT page_id, trim(regexp_replace({_UNESCAPE.format(f"regexp_extract({_SHOWN}, '(?is)<title[^>]*>(.*?)</title>', 1)")}, '\\s+', ' ', 'g')) AS title FROM pages")
def page_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.titles(F.col("html")).alias("title"))


@query(f"SELECT page_id, md5(trim(regexp_replace({_UNESCAPE.format(f"regexp_replace({_SHOWN}, '(?s)<[^>]*>', ' ', 'g')")}, '\\s+', ' ', 'g'))) AS text_md5 FROM pages")
def page_visible_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(html.visible(F.col("html"))).alias("text_md5"))


@query("""
SELECT page_id, regexp_matches(f, '[.](pdf|doc|docx)$') AS is_document, regexp_matches(f, '[.](pdf|doc|docx|zip|jpg)$') AS is_file, NOT regexp_matches(f, '[.](pdf|doc|docx|zip|jpg)$') AS crawl
FROM (SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', '') || ['.pdf', '.zip', '.jpg', '.docx', '', '.txt', '.htm'][page_id % 7 + 1] AS f FROM pages)""")
def file_url_flag(spark, sf_dir):
    """The pages' URLs, with different endings put on, as documents, files and pages."""
    ends = F.get(F.array(*map(F.lit, [".PDF", ".zip", ".jpg", ".docx", "", ".txt", ".htm"])), (F.col("page_id") % 7).cast("int"))
    u = urls.normalize(F.concat(F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "/$", ""), ends, F.lit("?q=1")))
    return table(spark, sf_dir, "pages").select("page_id", urls.is_document(u).alias("is_document"), urls.is_file(u).alias("is_file"), urls.should_crawl(u).alias("crawl"))


@query()
def html_context_window(spark, sf_dir):
    """Each page's links with their texts before and after, by the exact parser."""
    x = links.explode_links(table(spark, sf_dir, "pages"))
    return x.filter("link_idx >= 0").select("page_id", "link_idx", "href", "text", "before", "after")


@query()
def classify_links(spark, sf_dir):
    """The decision on every link of every page, and on each page itself."""
    x = links.explode_links(table(spark, sf_dir, "pages")).withColumnRenamed("url", "page_url")
    x = links.evaluate_links(x, V.default_taxonomy())
    return x.select("page_id", "link_idx", "target", "link_title", "accepted", "score", "rejection_reason", "document_type", F.array_join("reasons", "; ").alias("reasons"))


@query(f"WITH {_LINKS} SELECT target, page_id AS first_page, link_idx::INT AS link_idx FROM targets QUALIFY row_number() OVER (PARTITION BY target ORDER BY page_id, link_idx) = 1")
def first_wins_url(spark, sf_dir):
    first = F.min(F.struct("page_id", "link_idx")).alias("m")
    return _links(spark, sf_dir).groupBy("target").agg(first).select("target", F.col("m.page_id").alias("first_page"), F.col("m.link_idx").alias("link_idx"))


@query(f"""
WITH n AS (SELECT page_id, {_NORM} AS source_url FROM (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '[0-9]+', ''), '([^:])//+', '\\1/') AS u FROM pages))
SELECT source_url, min(page_id) AS seq FROM n a WHERE page_id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM n b WHERE b.page_id % 2 = 0 AND b.source_url = a.source_url) GROUP BY 1""")
def new_vs_catalog(spark, sf_dir):
    """Even pages as the catalog, odd ones as candidates (numbers taken out of the URLs, so that some meet)."""
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("seq"), F.regexp_replace(F.regexp_replace("url", "#.*$", ""), "^([^0-9]*)[0-9]+", "$1").alias("source_url"))
    return catalog.new_candidates(p.filter("seq % 2 = 1"), p.filter("seq % 2 = 0")).select("source_url", "seq")


@query("SELECT o_orderkey, printf('LK-EDU-%06d', 41 + row_number() OVER (ORDER BY o_orderkey)) AS doc_id FROM orders")
def allocate_ids(spark, sf_dir):
    return catalog.allocate_ids(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 42)


@query("""
WITH r AS (SELECT doc_id + 2 AS row_no, doc_id AS i FROM documents)
SELECT row_no, CASE WHEN i % 11 = 3 THEN 'invalid doc_id' WHEN i % 13 = 5 THEN 'title is required' WHEN i % 17 = 2 THEN 'unknown status'
  WHEN i % 19 = 7 THEN 'source_url must be a valid HTTP(S) URL' WHEN i % 29 = 4 THEN 'grade must be a grade or a rising range' WHEN i % 31 = 6 THEN 'quality_score must be a finite number' END AS first_error,
  ((i % 11 = 3)::INT + (i % 13 = 5)::INT + (i % 17 = 2)::INT + 2 * (i % 19 = 7)::INT + (i % 29 = 4)::INT + (i % 31 = 6)::INT)::INT AS n_errors
FROM r WHERE n_errors > 0""")
def row_violations(spark, sf_dir):
    """Documents as catalog rows with errors put in by their number."""
    i = F.col("i")
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("i"))
    cells = {c: F.lit("") for c in V.CATALOG_COLUMNS} | {
        "doc_id": F.when(i % 11 == 3, F.concat(F.lit("EDU-"), i)).otherwise(text.doc_id(i + 1)), "title": F.when(i % 13 == 5, "  ").otherwise("Title"),
        "status": F.when(i % 17 == 2, "LOST").otherwise("DISCOVERED"), "document_type": F.lit("other"), "source": F.lit("s"),
        "source_url": F.when(i % 19 == 7, "ftp://x.test/a").otherwise(F.concat(F.lit("https://x.test/"), i)),
        "grade": F.when(i % 29 == 4, "9-8").otherwise("8-9"), "quality_score": F.when(i % 31 == 6, "nan").otherwise("0.5"),
    }
    x = rows.select(*(v.alias(c) for c, v in cells.items()), (i + 2).alias("row_no"))
    return catalog.violations(x).select("row_no", F.get("errors", F.lit(0)).alias("first_error"), F.size("errors").alias("n_errors"))


_STATS = """
stats AS (SELECT 's' || user_id % 40 AS source_id, count(*) AS pages_visited, count(*) FILTER (WHERE event_type = 'view') AS pages_succeeded, count(*) FILTER (WHERE event_type = 'error' AND user_id % 40 > 30) AS pages_failed,
  count(*) FILTER (WHERE event_type = 'purchase' AND user_id % 40 > 20) AS candidates_discovered, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1),
outs AS (SELECT *, CASE WHEN pages_succeeded > 0 THEN CASE WHEN pages_failed > 0 THEN 'partial' WHEN candidates_discovered = 0 THEN 'success_empty' ELSE 'success' END WHEN pages_failed > 0 THEN 'failed' ELSE 'skipped' END AS outcome FROM stats)"""


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the counters of forty sources."""
    kind, user = F.col("event_type"), F.col("user_id") % 40
    x = table(spark, sf_dir, "events").groupBy(F.concat(F.lit("s"), user).alias("source_id")).agg(
        F.count(F.lit(1)).alias("pages_visited"), F.count_if(kind == "view").alias("pages_succeeded"), F.count_if((kind == "error") & (user > 30)).alias("pages_failed"),
        F.count_if((kind == "purchase") & (user > 20)).alias("candidates_discovered"), F.count_if(kind == "error").alias("errors"))
    zero = {c: F.lit(0).cast("long") for c in ("pages_skipped", "navigation_pages_excluded", "listing_pages_excluded", "duplicates_skipped")}
    return x.withColumns(zero | {"stop_reason": F.lit(""), "policy_unavailable": F.lit(False)})


@query(f"WITH {_STATS} SELECT source_id, outcome FROM outs")
def source_outcomes(spark, sf_dir):
    return crawl.source_outcomes(_stats(spark, sf_dir)).select("source_id", "outcome")


@query(f"""WITH {_STATS} SELECT CASE WHEN u THEN CASE WHEN i THEN 'partial' ELSE 'success' END WHEN f THEN 'failed' ELSE 'skipped' END AS outcome, CASE WHEN u AND i THEN 1 WHEN u THEN 0 ELSE 2 END AS exit_code
FROM (SELECT bool_or(outcome IN ('success', 'success_empty', 'partial')) AS u, bool_or(outcome IN ('failed', 'partial')) AS i, bool_or(outcome = 'failed') AS f FROM outs)""")
def run_outcome(spark, sf_dir):
    return crawl.run_outcome(crawl.source_outcomes(_stats(spark, sf_dir)))


@query(f"WITH {_STATS} SELECT source_id, sum(pages_visited)::BIGINT AS pages_visited, sum(errors)::BIGINT AS errors FROM stats GROUP BY ROLLUP (source_id)")
def run_totals(spark, sf_dir):
    return crawl.run_totals(_stats(spark, sf_dir)).select("source_id", "pages_visited", "errors")


@query("SELECT event_id, user_id % 40 AS source_id, row_number() OVER (PARTITION BY user_id % 40 ORDER BY ts) AS request_no FROM events QUALIFY request_no <= 25")
def request_budget(spark, sf_dir):
    x = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 40).alias("source_id"), "ts")
    return crawl.within_budget(x, 25).select("event_id", "source_id", F.col("request_no").cast("long").alias("request_no"))


@query("""
WITH RECURSIVE e AS (SELECT n_nationkey AS a, (n_nationkey * 2 + 1) % 25 AS b FROM nation UNION SELECT n_nationkey, (n_nationkey * 3 + 2) % 25 FROM nation),
w AS (SELECT 0 AS n, 0 AS depth UNION SELECT b, depth + 1 FROM w JOIN e ON a = n WHERE depth < 4)
SELECT 'https://site.test/p' || n AS url, min(depth)::INT AS depth FROM w GROUP BY n""")
def bfs_depths(spark, sf_dir):
    """Depths of the pages reached from page 0 in a graph made of the nations."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("a"))
    page = lambda c: F.concat(F.lit("https://site.test/p"), c.cast("string"))
    edges = n.select(page(F.col("a")).alias("url"), F.posexplode(F.array((F.col("a") * 2 + 1) % 25, (F.col("a") * 3 + 2) % 25)).alias("link_idx", "b")).withColumn("target", page(F.col("b"))).drop("b")
    start = n.filter("a = 0").select(F.lit("s").alias("source"), page(F.col("a")).alias("url"))
    return crawl.crawl_levels(spark, start, edges, 4).select("url", "depth")


# ---------------------------------------------------------------- text and dictionaries

@query("SELECT doc_id, md5(trim(regexp_replace(replace(lower(nfc_normalize(text)), 'ß', 'ss'), '[\\s_-]+', ' ', 'g'))) AS norm_md5 FROM documents")
def norm_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.normal(F.col("text"))).alias("norm_md5"))


PART_SUBJECTS = {"domains": {"heat": {"subjects": [{"name": "hot"}, {"name": "hot plate"}, {"name": "cold"}]}, "tools": {"subjects": [{"name": "gear", "aliases": ["rod", "bolt"]}, {"name": "ring"}]}}}


@query("""
SELECT p_partkey, CASE WHEN n = 1 THEN s ELSE '' END AS subject, CASE WHEN n = 1 THEN CASE WHEN s IN ('gear', 'ring') THEN 'tools' ELSE 'heat' END ELSE '' END AS domain
FROM (SELECT p_partkey, len(l) AS n, l[1] AS s FROM (SELECT p_partkey, list_distinct(list_filter([
  CASE WHEN p_name LIKE 'hot plate' THEN 'hot plate' WHEN p_name LIKE 'hot %' THEN 'hot' WHEN p_name LIKE 'cold %' THEN 'cold' END,
  CASE WHEN p_name LIKE '% gear' OR p_name LIKE '% rod' OR p_name LIKE '% bolt' THEN 'gear' WHEN p_name LIKE '% ring' THEN 'ring' END], lambda x: x IS NOT NULL)) AS l FROM part))""")
def phrase_dictionary(spark, sf_dir):
    """Names and aliases found in the parts' names: the specific before the contained, and one only."""
    s = text.subject_and_domain(F.col("norm"), PART_SUBJECTS)
    x = table(spark, sf_dir, "part").withColumn("norm", text.normal(F.col("p_name"))).select("p_partkey", s.alias("s"))
    return x.select("p_partkey", "s.subject", "s.domain")


# ---------------------------------------------------------------- corpus stages

@query("SELECT sha256(text) AS content_sha256, min(doc_id) AS canonical_id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_dup_groups(spark, sf_dir):
    return corpus.exact_duplicates(table(spark, sf_dir, "documents"), F.col("text"))


@query("""
SELECT doc_id, md5(coalesce(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda s: trim(regexp_replace(s, '[ \\t\\r\\f]+', ' ', 'g'))), lambda s: s <> ''), chr(10)), '')) AS clean_md5 FROM documents""")
def clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(corpus.clean(F.col("text"))).alias("clean_md5"))


@query("""
SELECT line, count(DISTINCT doc_id) AS n_docs FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS line FROM documents) WHERE line <> '' GROUP BY line HAVING n_docs >= 3""")
def repeated_lines(spark, sf_dir):
    return corpus.repeated_lines(table(spark, sf_dir, "documents"), 3)


@query("""
SELECT doc_id, length(text) AS n_chars, round(CASE WHEN length(text) = 0 THEN 0 ELSE length(regexp_replace(text, '[^\\p{L}]', '', 'g')) / length(text) END, 6) AS letter_share,
  length(text) - length(replace(text, chr(65533), '')) AS n_replacement, len(list_filter(string_split(text, chr(10)), lambda s: trim(s) = '')) AS n_empty_lines FROM documents""")
def page_checks(spark, sf_dir):
    return corpus.page_checks(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").drop("text")


_GATE = """
gate AS (SELECT doc_id, array_to_string(list_filter([CASE WHEN n < 100 THEN 'too_short' END, CASE WHEN n - length(translate(text, '#*$%&|<>{}[]~^', '')) > n * 0.2::DOUBLE THEN 'too_many_symbols' END,
  CASE WHEN len(list_distinct(w)) < len(w) * 0.3::DOUBLE THEN 'too_repetitive' END], lambda x: x IS NOT NULL), ',') AS reasons
  FROM (SELECT doc_id, text, length(text) AS n, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM documents))"""


@query(f"WITH {_GATE} SELECT doc_id, reasons = '' AS accepted, reasons FROM gate")
def quality_gate(spark, sf_dir):
    return corpus.quality_gate(table(spark, sf_dir, "documents"))


@query(f"""WITH {_GATE}, j AS (SELECT reasons = '' AS a, quality = 1 AS p FROM gate JOIN labels USING (doc_id))
SELECT n, accepted, positives, true_positives, correct, round(true_positives / accepted, 9) AS precision, round(true_positives / positives, 9) AS recall
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE a) AS accepted, count(*) FILTER (WHERE p) AS positives, count(*) FILTER (WHERE a AND p) AS true_positives, count(*) FILTER (WHERE a = p) AS correct FROM j)""")
def precision_recall(spark, sf_dir):
    x = corpus.quality_gate(table(spark, sf_dir, "documents")).join(table(spark, sf_dir, "labels"), "doc_id")
    return corpus.precision_recall(x, F.col("accepted"), F.col("quality") == 1)


@query("SELECT lang, source, count(*) AS n, count(*) FILTER (WHERE n_chars >= 100) AS n_usable, grouping_id(lang, source)::BIGINT AS level FROM documents GROUP BY GROUPING SETS ((lang), (source), (lang, source), ())")
def coverage(spark, sf_dir):
    return corpus.coverage(table(spark, sf_dir, "documents"), ["lang", "source"], F.col("n_chars") >= 100)


@query("""
SELECT doc_id, lang, source, stratum_size FROM (SELECT doc_id, lang, source, count(*) OVER (PARTITION BY lang, source) AS stratum_size, row_number() OVER (PARTITION BY lang, source ORDER BY md5('sample:' || doc_id), doc_id) AS k FROM documents) WHERE k <= 3""")
def stratified_sample(spark, sf_dir):
    x = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return corpus.stratified_sample(x, ["lang", "source"], 3, "sample")


def _grams(t: str, key: str) -> str:
    return f"(SELECT DISTINCT {key}, array_to_string(w[i : i + 7], ' ') AS g FROM (SELECT {key}, w, unnest(range(1, len(w) - 6)) AS i FROM (SELECT {key}, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM {t}) WHERE len(w) >= 8))"


@query(f"SELECT d.doc_id, count(DISTINCT g) AS n_shared, count(DISTINCT item_id) AS n_items FROM {_grams('documents', 'doc_id')} d JOIN {_grams('benchmark', 'item_id')} b USING (g) GROUP BY d.doc_id")
def contamination_ngrams(spark, sf_dir):
    return corpus.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SPLIT = """
splits AS (SELECT doc_id, g AS group_id, CASE WHEN h < 80 THEN 'train' WHEN h < 90 THEN 'dev' ELSE 'test' END AS split FROM
  (SELECT doc_id, g, ('0x' || substr(md5('split:' || g), 1, 6))::BIGINT % 100 AS h FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS g FROM documents)))"""


@query(f"WITH {_SPLIT} SELECT * FROM splits")
def grouped_split(spark, sf_dir):
    return corpus.grouped_split(table(spark, sf_dir, "documents"))


@query(f"""WITH {_SPLIT}, alone AS (SELECT group_id, CASE WHEN h < 80 THEN 'train' WHEN h < 90 THEN 'dev' ELSE 'test' END AS split FROM (SELECT group_id, ('0x' || substr(md5('split:' || doc_id), 1, 6))::BIGINT % 100 AS h FROM splits))
SELECT group_id, count(DISTINCT split) AS n_splits FROM alone GROUP BY 1 HAVING n_splits > 1
UNION ALL SELECT -1, count(*) FROM (SELECT group_id FROM splits GROUP BY 1 HAVING count(DISTINCT split) > 1)""")
def split_overlap(spark, sf_dir):
    """Groups in two splits when documents are dealt one by one, and (as -1) how many there are when groups are dealt."""
    splits = corpus.grouped_split(table(spark, sf_dir, "documents"))
    alone = corpus.split_overlap(splits.withColumn("split", corpus.split_of(F.col("doc_id"), "split")))
    return alone.unionByName(corpus.split_overlap(splits).agg(F.lit(-1).cast("long").alias("group_id"), F.count(F.lit(1)).alias("n_splits")))


@query(f"""WITH {_SPLIT}, hits AS (SELECT DISTINCT d.doc_id FROM {_grams('documents', 'doc_id')} d JOIN {_grams('benchmark', 'item_id')} b USING (g))
SELECT count(*) AS n_docs, sum(length(text))::BIGINT AS n_chars, count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'dev') AS n_dev, count(*) FILTER (WHERE split = 'test') AS n_test,
  count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM hits)) AS n_overlap, sum(('0x' || substr(md5(text), 1, 8))::BIGINT)::BIGINT AS content_sum, 'split' AS seed FROM documents JOIN splits USING (doc_id)""")
def release_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return corpus.release_manifest(docs, corpus.grouped_split(docs), corpus.contaminated(docs, table(spark, sf_dir, "benchmark")), "split")


@query("SELECT user_id, last(event_type ORDER BY ts, event_type) AS last_value, max(ts) AS last_ts, count(*) AS n_events FROM events GROUP BY user_id")
def latest_stage_event(spark, sf_dir):
    return corpus.latest_events(table(spark, sf_dir, "events"), "user_id", "ts", "event_type")


@query("""
SELECT event_id, user_id, f AS from_state, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS f FROM events)
WHERE f IS NOT NULL AND (f, event_type) NOT IN (('view', 'click'), ('click', 'view'), ('click', 'purchase'), ('view', 'view'), ('signup', 'view'))""")
def bad_transitions(spark, sf_dir):
    allowed = [("view", "click"), ("click", "view"), ("click", "purchase"), ("view", "view"), ("signup", "view")]
    return corpus.bad_transitions(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "event_type", allowed).select("event_id", "user_id", "from_state", "event_type")


@query("SELECT sum(n)::BIGINT AS n, round(sum(h) / sum(n), 9) AS accuracy, round(avg(h / n), 9) AS macro_accuracy FROM (SELECT lang, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS h FROM labels JOIN documents USING (doc_id) GROUP BY lang)")
def macro_accuracy(spark, sf_dir):
    x = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return corpus.evaluation(x, "lang", F.col("quality") == 1)


@query("SELECT count(*) AS n_rows, count(*) FILTER (WHERE coalesce(trim(c_name), '') = '') AS blank_c_name, count(*) FILTER (WHERE coalesce(trim(c_mktsegment), '') = '') AS blank_c_mktsegment FROM customer")
def completeness(spark, sf_dir):
    return corpus.completeness(table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment"])


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def event_windows(spark, sf_dir):
    from ..streaming import audit

    return audit.windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type")


@query("SELECT o_orderpriority AS document_type, count(*) AS n FROM orders GROUP BY 1")
def type_histogram(spark, sf_dir):
    return crawl.type_counts(table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "document_type"))


@query("SELECT count(*) FILTER (WHERE page_id % 3 = 0) AS direct, count(*) FILTER (WHERE page_id % 3 <> 0) AS other FROM pages")
def direct_vs_other(spark, sf_dir):
    u = F.concat(F.lit("https://x.test/a"), F.col("page_id"), F.when(F.col("page_id") % 3 == 0, ".docx").otherwise(".html"))
    return crawl.direct_or_other(table(spark, sf_dir, "pages").select(urls.normalize(u).alias("source_url")))


# ---------------------------------------------------------------- golden cases (fixed values)

GRADES = [
    ("Grade 8-9 History", "8-9", "Junior Secondary"), ("Grades 10–11", "10-11", "O-Level"), ("8 ශ්‍රේණිය ඉතිහාසය", "8", "Junior Secondary"), ("ශ්‍රේණිය 8", "8", "Junior Secondary"),
    ("10-11 ශ්‍රේණිය", "10-11", "O-Level"), ("උසස් පෙළ ආර්ථික විද්‍යාව", "12-13", "A-Level"), ("සාමාන්‍ය පෙළ", "10-11", "O-Level"), ("GCE O / L Grade 11", "11", "O-Level"),
    ("Grade 8 Grade 9", "", ""), ("Grade 8 O/L", "", ""), ("A/L and O/L", "", ""), ("Grade 15", "", ""), ("Grade 9-8", "", ""), ("2024 History Paper", "", ""),
]
SUBJECT_CASES = [
    ("History of Sri Lanka", "History of Sri Lanka", "Humanities"), ("Sinhala Language and Literature", "Sinhala Language and Literature", "Language"),
    ("Business and Accounting Studies", "Business and Accounting Studies", "Business Studies"), ("History of Sri Lanka and History", "", ""), ("History and Science", "", ""),
    ("ඉතිහාසය සටහන්", "History", "Humanities"), ("භෞතික විද්‍යාව", "Physics", "STEM"), ("දේශපාලන විද්‍යාව", "Political Science", "Social Science"),
    ("ඉතිහාසයේ", "", ""), ("ඉතිහාසය සහ විද්‍යාව", "", ""), ("Eastern Music and Oriental Music", "", ""), ("Dancing and Dancing Indigenous", "", ""),
    ("Buddhism and Buddhist Civilization", "", ""), ("Christianity and Catholicism", "", ""),
]
LINK_CASES = [
    ("/teacher-guides?subject=Biology", "Biology", False), ("/category/economics", "2024 Economics past papers", False), ("/Paper", "Paper Hub", False), ("/Note", "Note Hub", False),
    ("/home", "Home", False), ("/AboutEng", "About", False), ("/Contact", "Contact", False), ("/files/history.pdf", "History textbook", True), ("/Paper/physics-2024", "2024 Physics past paper", True),
    ("/files/history-marking.pdf", "History marking scheme", True), ("/teacher-guides/history-grade-11", "Grade 11 History Teacher Guide", True), ("/history-notes", "ඉතිහාසය සටහන්", True), ("/resource", "8 ශ්‍රේණිය ඉතිහාසය", True),
]


def _values(rows: list[tuple], names: str) -> str:
    cell = lambda x: str(x).upper() if isinstance(x, bool) else f"'{x}'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) t({names})"


@query(_values(GRADES, "text, grade, level"))
def grade_extract(spark, sf_dir):
    x = spark.createDataFrame([(r[0],) for r in GRADES], "text string").withColumn("g", text.grade_form(F.col("text")))
    x = x.withColumn("n", text.normal(F.col("g")))
    return x.select("text", text.grade_and_level(F.col("g"), F.col("n"), V.default_taxonomy()).alias("r")).select("text", "r.grade", "r.level")


@query(_values(SUBJECT_CASES, "text, subject, domain"))
def subject_matches(spark, sf_dir):
    x = spark.createDataFrame([(r[0],) for r in SUBJECT_CASES], "text string").withColumn("n", text.normal(F.col("text")))
    return x.select("text", text.subject_and_domain(F.col("n"), V.default_taxonomy()).alias("r")).select("text", "r.subject", "r.domain")


@query(_values(LINK_CASES, "href, text, accepted"))
def classify_goldens(spark, sf_dir):
    rows = [("https://school.test/", h, t, "", "", "") for h, t, _ in LINK_CASES]
    x = spark.createDataFrame(rows, "page_url string, href string, text string, title string, before string, after string")
    return links.evaluate_links(x, V.default_taxonomy()).select("href", "text", "accepted")


#: What each rule of the decision makes of a link: href, text, before; accepted, score, subject, grade, level, type, reasons, why not.
DECISIONS = [
    ("/files/history.pdf", "History textbook", "", True, 14, "History", "", "", "textbook", "direct_document_link +5; configured_subject:History +3; educational_keyword:textbook +2; resource_title +4", ""),
    ("/teacher-guides/history-grade-11", "Grade 11 History Teacher Guide", "", True, 12, "History", "11", "O-Level", "teacher_guide", "configured_subject:History +3; explicit_grade_or_level:11 +3; educational_keyword:teacher guide +2; resource_title +4", ""),
    ("/download?id=7", "Past paper 2023 download", "", True, 11, "", "", "", "past_paper", "direct_document_link +5; educational_keyword:past paper +2; resource_title +4", ""),
    ("/resource", "8 ශ්‍රේණිය ඉතිහාසය", "", True, 8, "History", "8", "Junior Secondary", "other", "configured_subject:History +3; explicit_grade_or_level:8 +3; educational_keyword:resource +2", ""),
    ("/category/notes.pdf", "Notes", "", True, 4, "", "", "", "lesson", "direct_document_link +5; educational_keyword:notes +2; category_or_listing_page -3", "category/listing page"),
    ("/item", "Open", "Here is a syllabus", False, 1, "", "", "", "other", "educational_surrounding_text +1", "below candidate threshold"),
    ("/misc", "Something", "", False, 0, "", "", "", "other", "", "below candidate threshold"),
    ("/exam-timetable", "Exam timetable", "a syllabus", False, 6, "", "", "", "other", "educational_keyword:exam +2; resource_title +4", "timetable/non-document page"),
    ("/Paper", "Paper Hub", "", False, -1, "", "", "", "other", "educational_keyword:paper +2; category_or_listing_page -3", "category/listing page"),
    ("/category/economics", "2024 Economics past papers", "", False, 0, "Economics", "", "", "past_paper", "configured_subject:Economics +3; category_or_listing_page -3", "category/listing page"),
    ("/", "Welcome", "", False, -3, "", "", "", "other", "category_or_listing_page -3", "category/listing page"),
    ("/home", "Home", "", False, -4, "", "", "", "other", "navigation_page -4", "navigation"),
    ("/privacy-policy", "Privacy policy", "", False, -5, "", "", "", "other", "site_infrastructure -5", "site infrastructure"),
    ("mailto:x@school.test", "Mail", "", False, -999, "", "", "", "other", "", "invalid URL"),
]
#: Pages, and what the exact parser has of each link: page, link, href, text, title, before, after, the page's title and text.
PAGES = [
    "<title>T &amp; x</title><p>one</p><script>var a = '<a href=z>';</script><template><a href=t>t</a></template><a href=\"/a\" title=\" q \">A <b>b</b></a> after <i>it</i><a href=/b>B<a href=/c>C</a>end",
    "<p>1</p><p>2</p><p>3</p><p>4</p><p>5</p><p>6</p><p>7</p><a href=x>x</a><style>p</style><p>" + "w" * 100 + "</p><p>" + "v" * 100 + "</p><p>u</p>",
    "<h1>" + "y" * 290 + "</h1><p>" + "z" * 20 + "</p><a>no target</a><a href=''>empty</a><A HREF='q.pdf'>Q</A>",
]
CONTEXTS = [
    (0, 0, "/a", "A b", "q", "T & x one", "after it", "T & x", "T & x one A b after it B C end"),
    (0, 1, "/b", "B", "", "T & x one A b after it", "", "T & x", "T & x one A b after it B C end"),
    (0, 2, "/c", "C", "", "one A b after it B", "end", "T & x", "T & x one A b after it B C end"),
    (1, 0, "x", "x", "", "2 3 4 5 6 7", "w" * 100 + " " + "v" * 80, "", "1 2 3 4 5 6 7 x " + "w" * 100 + " " + "v" * 100 + " u"),
    (2, 0, "q.pdf", "Q", "", "y" * 263 + " " + "z" * 20 + " no target empty", "", "", "y" * 290 + " " + "z" * 20 + " no target empty Q"),
]


def _decisions_sql() -> str:
    cell = lambda x: str(x).upper() if isinstance(x, (bool, int)) else f"'{x}'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r[:2] + r[3:])) + ')' for r in DECISIONS)}) t(href, text, accepted, score, subject, grade, education_level, document_type, reasons, rejection_reason)"


@query(_decisions_sql())
def decision_goldens(spark, sf_dir):
    rows = [("https://school.test/", r[0], r[1], "", r[2], "") for r in DECISIONS]
    x = spark.createDataFrame(rows, "page_url string, href string, text string, title string, before string, after string")
    x = links.evaluate_links(x, V.default_taxonomy())
    return x.select("href", "text", "accepted", "score", "subject", "grade", "education_level", "document_type", F.array_join("reasons", "; ").alias("reasons"), "rejection_reason")


@query(f"SELECT * FROM (VALUES {', '.join(repr(r) for r in CONTEXTS)}) t(page_id, link_idx, href, text, title, before, after, page_title, page_text)")
def context_goldens(spark, sf_dir):
    """Links with their surroundings, titles and visible texts, by the exact parser."""
    pages = spark.createDataFrame(list(enumerate(PAGES)), "page_id int, html string").withColumn("url", F.lit("https://school.test/"))
    texts = pages.select("page_id", html.parsed(F.col("html"))["text"].alias("page_text"))
    return links.explode_links(pages).filter("link_idx >= 0").join(texts, "page_id").select("page_id", "link_idx", "href", "text", "title", "before", "after", "page_title", "page_text")
