import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodeseam.functions import vocabulary as V
from lodeseam.operators import corpus, crawl, links
from lodeseam.plans import discover
from lodeseam.sources import catalog, config, pages
from lodeseam.streaming import audit

SITE = "https://school.test/"


def decide(spark, rows, taxonomy=None):
    df = spark.createDataFrame([(SITE, h, t, "", "", after) for h, t, after in rows], "page_url string, href string, text string, title string, before string, after string")
    return {r["href"]: r for r in links.evaluate_links(df, taxonomy or V.default_taxonomy()).collect()}


def test_decisions(spark):
    got = decide(spark, [("/files/history.pdf", "History textbook", ""), ("/timetable", "Exam timetable", "past paper"), ("/login", "Login", ""), ("ftp://x/y", "x", ""), ("/files/grade_8-maths.pdf", "Download", ""), ("/x", "Resource", "")])
    a = got["/files/history.pdf"]
    assert (a["score"], a["subject"], a["document_type"], a["rejection_reason"]) == (17 - 3, "History", "textbook", "")
    assert a["reasons"] == ["direct_document_link +5", "configured_subject:History +3", "educational_keyword:textbook +2", "resource_title +4"]
    assert got["/timetable"]["rejection_reason"] == "timetable/non-document page"
    assert got["/login"]["rejection_reason"] == "site infrastructure" and got["/login"]["score"] == -5
    assert (got["ftp://x/y"]["score"], got["ftp://x/y"]["rejection_reason"]) == (-999, "invalid URL")
    assert got["/files/grade_8-maths.pdf"]["link_title"] == "grade 8 maths" and got["/files/grade_8-maths.pdf"]["grade"] == "8"
    assert got["/x"]["score"] == 2 and got["/x"]["rejection_reason"] == "below candidate threshold"


def test_pages_to_links(spark):
    table = spark.createDataFrame([(SITE, "<title>Hi</title><a href='/a'>A</a>"), (SITE + "b", None)], "url string, html string")
    got = sorted((r["url"], r["link_idx"], r["href"], r["text"]) for r in links.explode_links(table).collect())
    assert got == [(SITE, -1, SITE, "Hi"), (SITE, 0, "/a", "A"), (SITE + "b", -1, SITE + "b", "")]


def test_crawl(spark):
    edges = [(SITE, 0, SITE + "a"), (SITE, 1, SITE + "b"), (SITE, 2, "https://other.test/"), (SITE, 3, SITE + "x.pdf"), (SITE + "a", 0, SITE + "c"), (SITE + "b", 0, SITE), (SITE + "c", 0, SITE + "d")]
    df = spark.createDataFrame(edges, "url string, link_idx int, target string")
    start = spark.createDataFrame([("s", SITE)], "source string, url string")
    got = {r["url"][len(SITE) :]: (r["depth"], r["seq"]) for r in crawl.crawl_levels(spark, start, df, 2).collect()}
    assert got == {"": (0, 0), "a": (1, 1), "b": (1, 2), "c": (2, 3)}
    assert crawl.crawl_levels(spark, start, df, 2, max_pages=2).count() == 2
    lists = {}
    for u, _, t in edges:
        lists.setdefault(u, []).append(t)
    visited, stats = crawl.crawl_one(SITE, lists, lambda u: u.startswith(SITE) and not u.endswith(".pdf"), {"max_queue": 1})
    assert (stats["queue_peak"], stats["queue_dropped"], stats["stop_reason"]) == (1, 1, "queue_limit")
    for bad in ({"max_queue": 0}, {"max_depth": -1}, {"timeout_seconds": 0.0}, {"max_seconds": float("nan")}):
        with pytest.raises(ValueError, match="must be"):
            crawl.crawl_one(SITE, {}, bool, bad)


def test_outcomes(spark):
    rows = [("a", 1, 0, "", False, 2, "success"), ("b", 1, 0, "", False, 0, "success_empty"), ("c", 1, 1, "", False, 1, "partial"), ("d", 0, 0, "", True, 0, "failed"), ("e", 0, 0, "", False, 0, "skipped")]
    df = spark.createDataFrame(rows, "source_id string, pages_succeeded int, pages_failed int, stop_reason string, policy_unavailable boolean, candidates_discovered int, want string")
    out = crawl.source_outcomes(df)
    assert all(r["want"] == r["outcome"] for r in out.collect())
    assert crawl.run_outcome(out).first().asDict() == {"outcome": "partial", "exit_code": 1}
    assert crawl.run_outcome(out.filter("source_id = 'e'")).first().asDict() == {"outcome": "skipped", "exit_code": 2}
    assert crawl.run_outcome(out.filter("source_id < 'c'")).first().asDict() == {"outcome": "success", "exit_code": 0}


def test_sources(spark):
    s = [{"id": "a", "base_url": SITE, "enabled": True, "verified": True}, {"id": "b", "base_url": "", "enabled": False, "verified": True}, {"id": "c", "base_url": "", "enabled": True, "verified": False}]
    t = config.sources_table(spark, config.check_sources({"sources": s}))
    assert {r["id"]: r["skip_reason"] for r in crawl.eligibility(t).collect()} == {"a": None, "b": "disabled", "c": "unverified"}
    with pytest.raises(ValueError, match="Unknown"):
        crawl.select_source(t, "z")


def test_robots(spark):
    body = "# c\nUser-agent: *\nDisallow: /private\nAllow: /\n\nUser-agent: lode\nDisallow: /x\n"
    robots = spark.createDataFrame([("http://a.test", 200, body), ("http://b.test", 404, ""), ("http://c.test", 403, ""), ("http://d.test", 503, "")], "origin string, status int, body string")
    asked = spark.createDataFrame([(u,) for u in ("http://a.test/private/1", "http://a.test/x", "http://b.test/", "http://c.test/a", "http://d.test/")], "url string")
    ask = lambda agent: {r["url"]: r["robots_ok"] for r in crawl.robots_allowed(asked, crawl.robots_rules(robots, agent)).collect()}
    assert ask("other/1") == {"http://a.test/private/1": False, "http://a.test/x": True, "http://b.test/": True, "http://c.test/a": False, "http://d.test/": False}
    assert ask("lodeseam/1")["http://a.test/x"] is False and ask("lodeseam/1")["http://a.test/private/1"] is True


@pytest.mark.parametrize("bad", [None, {"sources": [None]}, {"sources": [{"id": "a", "enabled": True, "verified": True, "base_url": SITE}] * 2}, {"sources": [{"id": "a", "enabled": "yes", "verified": True}]}, {"sources": [{"id": "a", "enabled": True, "verified": True, "base_url": "ftp://x"}]}])
def test_bad_sources(bad):
    with pytest.raises(ValueError, match="source|sources"):
        config.check_sources(bad)


@pytest.mark.parametrize("change", [{"domains": {"d": None}}, {"education_levels": {"x": None}}, {"grade_markers": []}, {"domains": {"d": {"subjects": [{"name": "n", "grade_min": 0, "grade_max": 3}]}}}])
def test_bad_taxonomy(change):
    with pytest.raises(ValueError):  # noqa: PT011
        config.check_taxonomy(V.default_taxonomy() | change)


def test_tables(spark):
    t = config.check_taxonomy(V.default_taxonomy())
    assert config.subjects_table(spark, t).count() == 32 + 8 and config.levels_table(spark, t).count() == 3
    text = json.dumps({"schema_version": V.PILOT_SCHEMA, "pilots": [{"doc_id": "LK-EDU-000001", "title": "x"}]})
    assert config.pilots_table(spark, config.check_pilots(text)).count() == 1
    with pytest.raises(ValueError, match="pilots"):
        config.check_pilots('{"schema_version": "2", "pilots": []}')


def write_catalog(path: Path, rows, extra=()):
    with path.open("w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, [*V.CATALOG_COLUMNS, *extra])
        w.writeheader()
        w.writerows({c: "" for c in [*V.CATALOG_COLUMNS, *extra]} | r for r in rows)


OLD = {"doc_id": "LK-EDU-000009", "title": "old", "status": "DISCOVERED", "document_type": "other", "source": "s", "source_url": "https://x.test/old"}


def candidates(spark, *rows):
    return spark.createDataFrame([(i, f"t{i}", "s", u, "other") for i, u in enumerate(rows)], "seq long, title string, source string, source_url string, document_type string")


def test_append(spark, tmp_path):
    path = tmp_path / "documents.csv"
    write_catalog(path, [OLD | {"note": "kept, \"so\"\nyes"}], ["note"])
    new = candidates(spark, "https://x.test/a.pdf#one", "https://x.test/a.pdf#two", "https://x.test/old", "https://x.test/b")
    added = catalog.append_catalog(spark, str(path), new)
    assert [(r["doc_id"], r["source_url"]) for r in added] == [("LK-EDU-000010", "https://x.test/a.pdf"), ("LK-EDU-000011", "https://x.test/b")]
    before = path.read_bytes()
    assert catalog.append_catalog(spark, str(path), new) == [] and path.read_bytes() == before
    with path.open(newline="") as f:
        rows = list(csv.DictReader(f))
    assert rows[0]["note"] == 'kept, "so"\nyes' and len(rows) == 3
    for bad in (candidates(spark, "https://x.test/c", "ftp://x"), candidates(spark, "https://x.test/c").withColumn("title", F.lit(" ")), candidates(spark, "https://x.test/c").withColumn("odd", F.lit("1")), candidates(spark, "https://x.test/c").withColumn("status", F.lit("READY"))):
        with pytest.raises(catalog.CatalogError):
            catalog.append_catalog(spark, str(path), bad)
        assert path.read_bytes() == before


@pytest.mark.parametrize("bad", [{"doc_id": "x"}, {"title": ""}, {"status": "NEW"}, {"document_type": "poem"}, {"source_url": "ftp://x"}, {"source": ""}, {"sha256": "AB"}, {"status": "READY"}, {"page_count": "0"}, {"grade": "14"}, {"quality_score": "inf"}, {"ocr_required": "yes"}])
def test_invalid_rows(spark, tmp_path, bad):
    path = tmp_path / "documents.csv"
    write_catalog(path, [OLD | bad])
    with pytest.raises(catalog.CatalogError, match="row 2"):
        catalog.read_catalog(spark, str(path))


def test_pilots_and_header(spark, tmp_path):
    path = tmp_path / "documents.csv"
    write_catalog(path, [OLD | {"source_url": "", "source": ""}])
    pilots = spark.createDataFrame([("LK-EDU-000009", "old")], "doc_id string, title string")
    assert catalog.read_catalog(spark, str(path), pilots).count() == 1
    path.write_text("doc_id,doc_id\n")
    with pytest.raises(catalog.CatalogError):
        catalog.read_catalog(spark, str(path))


def test_corpus_parts(spark):
    q = spark.createDataFrame([(["a", "b"], 1), (["a", "A "], 0), (["a"], 3)], "options array<string>, answer int")
    assert [r["problems"] for r in corpus.question_checks(q).collect()] == [[], ["repeated_options"], ["too_few_options", "no_answer"]]
    p = spark.createDataFrame([("p1", "2020", "m"), ("p2", "2021", "m"), ("p3", "2021", "m")], "doc_id string, year string, subject string")
    assert [r["paper_id"] for r in corpus.paper_pairs(p, p.filter("doc_id <> 'p3'"), ["year", "subject"]).collect()] == ["p1"]
    c = spark.createDataFrame([(bytearray(b"%PDF-1"),), (bytearray(b" <HTML>"),), (bytearray(b"PK\x03\x04"),), (bytearray(b""),)], "c binary")
    assert [r["t"] for r in c.select(corpus.detected_type(F.col("c")).alias("t")).collect()] == ["pdf", "html", "zip", "unknown"]
    a = spark.createDataFrame([("u", bytearray(b"1"), 1), ("v", bytearray(b"1"), 2)], "url string, content binary, ts int")
    assert corpus.artifacts(a).first()["urls"] == ["u", "v"]
    m = spark.createDataFrame([(5, "2024-01-01"), (6, "2023-01-01")], "parameters long, release_date string").withColumn("release_date", F.col("release_date").cast("date"))
    assert corpus.model_manifest(m, 10, "2025-01-01").first().asDict() == {"parameters": 11, "size_ok": False, "dates_ok": True}
    e = spark.createDataFrame([("a", 1, "DISCOVERED"), ("a", 2, "DOWNLOADED"), ("a", 3, "READY")], "k string, i int, s string")
    assert [r["i"] for r in corpus.bad_transitions(e, "k", ["i"], "s", corpus.allowed_transitions()).collect()] == [3]
    v = spark.createDataFrame([("u", 1, "x"), ("u", 2, "x"), ("u", 3, "y")], "url string, ts int, sha256 string")
    assert [r["version"] for r in corpus.versions(v).orderBy("ts").collect()] == [1, 1, 2]


def test_audit_stream(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01 00:10:00"), ("a", "2024-01-01 00:20:00"), ("b", "2024-01-01 01:00:00")], "kind string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = audit.windowed_counts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "ts", "kind")
    q = stream.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["kind"], r["n"]) for r in spark.table("counts").collect()) == [("a", 2), ("b", 1)]
    d = links.evaluate_links(spark.createDataFrame([("s", SITE, "/a.pdf", "Textbook", "", "", "")], "source_id string, page_url string, href string, text string, title string, before string, after string"), V.default_taxonomy())
    records = audit.decision_records(d.withColumn("in_domain", F.lit(True)), "run1")
    audit.write_records(records, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first()["evidence"]["anchor"] == "Textbook"


def test_discovery_run(spark, tmp_path):
    path = tmp_path / "documents.csv"
    write_catalog(path, [OLD | {"source_url": SITE + "files/old.pdf"}])
    home = '<title>Home</title><a href="/files/history.pdf">History textbook</a><a href="/files/old.pdf#p2">Old textbook</a><a href="/more">More</a><a href="/login">Login</a>'
    more = '<a href="/files/grade-8.pdf">Grade 8 Science workbook</a><a href="/files/history.pdf">again</a><a href="https://other.test/x.pdf">textbook</a>'
    fetched = spark.createDataFrame([(SITE, home), (SITE + "more", more)], "url string, html string")
    sources = config.check_sources({"sources": [{"id": "a", "name": "A", "base_url": SITE, "enabled": True, "verified": True}, {"id": "b", "base_url": "", "enabled": False, "verified": True}]})
    dry = discover.run(spark, fetched, sources, V.default_taxonomy(), str(path), str(tmp_path / "dry"), dry_run=True)
    assert dry["candidates_to_add"] == 2 and dry["preview"]["direct"] == 2 and dry["totals"]["duplicates_skipped"] == 1
    done = discover.run(spark, fetched, sources, V.default_taxonomy(), str(path), str(tmp_path / "out"))
    # the page behind /login was reached and isn't in the table of pages
    assert (done["rows_committed"], done["outcome"], done["exit_code"]) == (2, "partial", 1)
    with path.open(newline="") as f:
        rows = list(csv.DictReader(f))
    assert [(r["doc_id"], r["source_url"], r["document_type"], r["grade"]) for r in rows[1:]] == [("LK-EDU-000010", SITE + "files/history.pdf", "textbook", ""), ("LK-EDU-000011", SITE + "files/grade-8.pdf", "workbook", "8")]
    records = spark.read.json(str(tmp_path / "out" / "decisions"))
    assert records.filter("accepted").count() == 4 and records.filter("rejection_reason = 'invalid or external URL'").count() == 1
    bad = discover.run(spark, fetched, sources, V.default_taxonomy(), str(path), str(tmp_path / "bad"), source_id="zz")
    assert bad["exit_code"] == 2 and "zz" in bad["error"]


def test_run_over_fetched_pages_with_robots(spark, tmp_path):
    """Robots files, rejected bodies, charsets and redirects hold in a run; a sink gets the decisions, and the log is a file."""
    path = tmp_path / "documents.csv"
    write_catalog(path, [OLD])
    page = lambda u, body, final=None, kind="text/html": (u, final or u, kind, bytearray(body.encode("latin-1")))
    rows = [page(SITE, "<a href='/caf\xe9'>Science workbook</a><a href='/old'>a</a><a href='/private/x'>b</a><a href='/bad'>c</a>", kind="text/html; charset=iso-8859-1"), page(SITE + "old", "<a href='/files/history.pdf'>History textbook</a>", SITE + "new"), page(SITE + "private/x", "<a href='/files/secret.pdf'>Secret textbook</a>"), page(SITE + "bad", "<a href='/files/bad.pdf'>Bad textbook \xe9</a>")]
    table = spark.createDataFrame(rows, "url string, final_url string, content_type string, body binary")
    robots = spark.createDataFrame([(SITE.rstrip("/"), 200, "User-agent: *\nDisallow: /private\n")], "origin string, status int, body string")
    sources = config.check_sources({"sources": [{"id": "a", "name": "A", "base_url": SITE, "enabled": True, "verified": True}]})
    seen = []
    done = discover.run(spark, table, sources, V.default_taxonomy(), str(path), str(tmp_path / "out"), robots=robots, decision_sink=lambda df: seen.extend(r["target"] for r in df.collect()))
    assert done["outcome"] == "partial" and SITE + "files/history.pdf" in seen and SITE + "caf%C3%A9" in seen
    assert SITE + "files/secret.pdf" not in seen and SITE + "files/bad.pdf" not in seen
    assert "outcome=partial" in next((tmp_path / "out").glob("discovery_*.log")).read_text()
    few = discover.run(spark, table, sources, V.default_taxonomy(), str(path), str(tmp_path / "few"), dry_run=True, limits={"max_requests": 1})
    assert few["totals"]["pages_visited"] == 1


def test_connector_stays_on_its_site_and_budget():
    assert pages.same_site("https://a.school.test/x", SITE) and pages.same_site("http://school.test/", SITE)
    assert not pages.same_site("https://school.test.evil.net/", SITE) and not pages.same_site("ftp://school.test/", SITE)
    assert pages.seconds_asked(" 7 ") == 7 and pages.seconds_asked("soon") == 0 and pages.seconds_asked("Mon, 01 Jan 2001 00:00:00 GMT") == 0
    reader = pages._Reader({"urls": SITE, "max_requests": "2"})
    assert [reader._charge() for _ in range(3)] == [True, True, False]
    assert list(pages._Reader({"max_requests": "0"}).read(pages._Part([SITE]))) == [(SITE, SITE, None, None, None)]


def test_file_hashes(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    rows = corpus.file_hashes(spark.read.format("binaryFile").load(str(tmp_path))).collect()
    assert [(r["name"], r["bytes"], r["sha256"][:8]) for r in rows] == [("a.bin", 3, "ba7816bf")]


def test_fetched_pages(spark):
    big = bytearray(b"x" * 2_000_001)
    rows = [("a", SITE + "a", "text/html; charset=utf-8", bytearray(b"<p>"), SITE), ("b", "https://other.test/", "text/html", bytearray(b""), SITE), ("c", SITE, "application/pdf", bytearray(b""), SITE), ("d", SITE, "text/html", big, SITE), ("e", SITE, None, None, SITE)]
    good, bad = pages.html_pages(spark.createDataFrame(rows, "url string, final_url string, content_type string, body binary, base_url string"))
    assert [(r["url"], r["html"]) for r in good.collect()] == [("a", "<p>")]
    assert {r["url"]: r["failure"] for r in bad.collect()} == {"b": "external_redirect", "c": "non_html", "d": "truncated_response", "e": "network_error"}
    p = spark.createDataFrame([("u1", "u1", 0), ("u2", "u1", 1), ("u3", "u4", 2), ("u4", "u4", 3)], "url string, final_url string, seq int")
    assert sorted(r["url"] for r in pages.redirect_aliases(p).collect()) == ["u1", "u3"]


def test_log_records(spark, tmp_path):
    (tmp_path / "x.log").write_text("2026-01-01 00:00:00,1 INFO Source a pages_visited=3\nodd line\n2026-01-01 00:00:01,2 INFO done n=1 elapsed_seconds=2.5\n")
    got = [(r["key"], r["value"]) for r in pages.log_records(spark, str(tmp_path / "x.log")).collect()]
    assert got == [("pages_visited", "3"), ("n", "1"), ("elapsed_seconds", "2.5")]
