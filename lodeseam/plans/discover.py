"""A discovery run over a table of fetched pages: from configuration to catalog, decisions and summary.

    python -m lodeseam.plans.discover --pages DIR --sources sources.yaml --subjects subjects.yaml --catalog documents.csv --out DIR [--dry-run]
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
import uuid
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..functions import vocabulary as V
from ..operators import crawl, links
from ..sources import catalog, config
from ..sources import pages as fetched
from ..sources.shared import saved
from ..streaming import audit

ORDER = ["seq", "link_idx"]
log = logging.getLogger("lodeseam.discover")


def run_id() -> str:
    return f"{datetime.now(UTC):%Y%m%dT%H%M%SZ}_{uuid.uuid4().hex[:8]}"


def file_log(folder: str, name: str) -> logging.Handler:
    """The log of a run as a file of its own, beside the console's."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    handler = logging.FileHandler(Path(folder, f"discovery_{name}.log"), encoding="utf-8")
    handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    log.addHandler(handler)
    log.setLevel(min(log.getEffectiveLevel(), logging.INFO))
    return handler


def taken(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """url, html of a table of fetched pages (url, final_url, content_type, body): those that may be read, under their own and their final URL."""
    if "html" in pages.columns:
        return pages.select("url", "html")
    starts = sources.select(urls.normalize(F.col("base_url")).alias("base_url")).distinct()
    based = pages.withColumn("_u", urls.normalize(F.col("url"))).join(F.broadcast(starts), urls.within(F.col("_u"), F.col("base_url"))).drop("_u")
    good, _ = fetched.html_pages(based)
    return good.select(F.explode(F.array_distinct(F.array("final_url", urls.normalize(F.col("url"))))).alias("url"), "html")


def decisions(spark: SparkSession, pages: DataFrame, sources: DataFrame, taxonomy: dict, limits: dict, robots: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(decisions, visited): every evaluated link of every page reached from the sources' base URLs.

    `pages` has url and html. Links are parsed once; the crawl runs over their resolved targets, those that
    `robots` (origin, status, body) denies left out. A page is a request, so max_requests bounds pages too.
    """
    starts = sources.select(F.col("id").alias("source"), urls.normalize(F.col("base_url")).alias("url"))
    named = pages.withColumn("url", urls.normalize(F.col("url"))).dropDuplicates(["url"])
    parsed = saved(links.explode_links(named.select("url", "html")))
    edges = parsed.filter("link_idx >= 0").select("url", "link_idx", urls.resolve(F.col("url"), F.col("href")).alias("target")).filter("target <> ''")
    if robots is not None:
        rules = saved(crawl.robots_rules(robots, fetched.AGENT))
        denied = crawl.robots_allowed(edges.select("target").distinct(), rules, "target").filter("NOT robots_ok").select("target")
        edges = saved(edges.join(denied, "target", "left_anti").select("url", "link_idx", "target"))
        starts = saved(crawl.robots_allowed(starts, rules).filter("robots_ok").drop("robots_ok"))
    visited = saved(crawl.crawl_levels(spark, starts, edges, limits["max_depth"], min(limits["max_pages_per_source"], limits["max_requests"])))
    seen = visited.join(parsed, "url").withColumnRenamed("url", "page_url").withColumnRenamed("source", "source_id")
    based = seen.join(starts.select(F.col("source").alias("source_id"), F.col("url").alias("base")), "source_id")
    out = links.evaluate_links(based, taxonomy)
    return saved(out.withColumn("in_domain", (F.col("target") != "") & urls.within(F.col("target"), F.col("base")))), visited


def source_stats(decided: DataFrame, visited: DataFrame, pages: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stats, firsts): counters and outcome of each source, and first decisions of each URL."""
    firsts = saved(crawl.first_decisions(decided, F.col("base"), ORDER))
    there = pages.select(urls.normalize(F.col("url")).alias("url"), F.lit(1).alias("_there")).distinct()
    reached = visited.join(there, "url", "left").groupBy(F.col("source").alias("source_id")).agg(F.count(F.lit(1)).alias("pages_visited"), F.count("_there").alias("pages_succeeded"))
    x = sources.select(F.col("id").alias("source_id")).join(reached, "source_id", "left").join(crawl.excluded_counts(firsts), "source_id", "left").na.fill(0)
    x = x.withColumns({"pages_failed": F.col("pages_visited") - F.col("pages_succeeded"), "pages_skipped": F.col("pages_visited") - F.col("pages_succeeded"), "errors": F.lit(0).cast("long"), "duplicates_skipped": F.lit(0).cast("long"), "stop_reason": F.lit(""), "policy_unavailable": F.lit(False)})
    return saved(crawl.source_outcomes(x)), firsts


def candidates(firsts: DataFrame, sources: DataFrame) -> DataFrame:
    """Accepted first decisions as catalog candidates, with seq, their order over all sources."""
    place = F.struct("source_id", *ORDER)
    x = firsts.filter("accepted").join(sources.select(F.col("id").alias("source_id"), F.col("name").alias("source"), F.col("language").alias("_language_hint")), "source_id")
    keys = {"title": "link_title", "subject": "subject", "domain": "domain", "grade": "grade", "education_level": "education_level", "document_type": "document_type", "source": "source", "source_url": "target"}
    named = x.select(*(F.col(v).alias(k) for k, v in keys.items()), F.lit("").alias("language"), "_language_hint", F.lit("DISCOVERED").alias("status"), F.col("score").cast("string").alias("_candidate_score"), F.array_join("reasons", "; ").alias("_candidate_reasons"), place.alias("_order"))
    numbered = catalog.allocate_ids(named, ["_order"], 0)
    return numbered.withColumn("seq", catalog.text.doc_number(F.col("doc_id"))).drop("doc_id", "_order")


def run(spark: SparkSession, pages: DataFrame, source_list: list[dict], taxonomy: dict, catalog_path: str, out_dir: str, source_id: str | None = None, dry_run: bool = False, limits: dict | None = None, robots: DataFrame | None = None, decision_sink: Callable[[DataFrame], None] | None = None) -> dict:
    """The whole run; the summary is returned and written as JSON. Decisions are written, and given to `decision_sink`, before the catalog is."""
    limits = {**V.DEFAULT_LIMITS, **(limits or {})}
    crawl.check_limits(limits)
    name = run_id()
    summary = {"schema_version": V.RUN_SCHEMA, "run_id": name, "dry_run": dry_run, "limits": limits, "started_at_utc": datetime.now(UTC).isoformat(), "outcome": "failed", "exit_code": 2, "sources": []}
    handler = file_log(out_dir, name)
    try:
        chosen = crawl.eligibility(crawl.select_source(config.sources_table(spark, source_list), source_id))
        old = catalog.read_catalog(spark, catalog_path)
        good = saved(chosen.filter("skip_reason IS NULL"))
        pages = taken(pages, good)
        decided, visited = decisions(spark, pages, good, taxonomy, limits, robots)
        audit.write_records(audit.decision_records(decided, name), f"{out_dir}/decisions")
        if decision_sink:
            decision_sink(decided)
        stats, firsts = source_stats(decided, visited, pages, good)
        found = saved(candidates(firsts, good))
        fresh = saved(catalog.new_candidates(found, old))
        skipped = chosen.filter("skip_reason IS NOT NULL").select(F.col("id").alias("source_id"), F.lit("skipped").alias("outcome"), F.col("skip_reason").alias("reason"))
        summary["sources"] = [r.asDict() for r in stats.collect()] + [r.asDict() for r in skipped.collect()]
        outcome = crawl.run_outcome(stats.select("outcome").union(skipped.select("outcome"))).first()
        summary |= {"outcome": outcome["outcome"], "exit_code": outcome["exit_code"], "candidates_to_add": fresh.count()}
        totals = crawl.run_totals(stats).filter("source_id IS NULL").first()
        summary["totals"] = {k: v or 0 for k, v in totals.asDict().items() if k != "source_id"} if totals else {}
        summary["totals"]["duplicates_skipped"] = found.count() - summary["candidates_to_add"]
        if dry_run:
            summary["preview"] = preview(fresh, firsts)
        else:
            summary["rows_committed"] = len(catalog.append_catalog(spark, catalog_path, fresh))
    except (ValueError, OSError, catalog.CatalogError) as problem:
        log.error("the run failed: %s", problem)
        summary |= {"error": str(problem), "outcome": "failed", "exit_code": 2}
    log.info("run %s ended: outcome=%s exit_code=%s candidates_to_add=%s", name, summary["outcome"], summary["exit_code"], summary.get("candidates_to_add", 0))
    log.removeHandler(handler)
    handler.close()
    summary["finished_at_utc"] = datetime.now(UTC).isoformat()
    Path(out_dir).mkdir(parents=True, exist_ok=True)
    Path(out_dir, f"{name}.summary.json").write_text(json.dumps(summary, ensure_ascii=False, indent=2, default=str) + "\n", encoding="utf-8")
    return summary


def preview(fresh: DataFrame, firsts: DataFrame) -> dict:
    """What a dry run reports: kinds, direct files, the first accepted and rejected decisions."""
    accepted = [r.asDict() for r in fresh.orderBy("seq").limit(20).collect()]
    rejected = crawl.samples(firsts, ORDER).orderBy("source_id", *ORDER).select("decision_title", "score", "rejection_reason", "target")
    return {"types": {r["document_type"]: r["n"] for r in crawl.type_counts(fresh).collect()}, **crawl.direct_or_other(fresh).first().asDict(), "accepted": accepted, "rejected": [r.asDict() for r in rejected.collect()]}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Discover educational resources in a table of fetched pages.")
    for name in ("pages", "sources", "subjects", "catalog", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--source", help="only this source")
    p.add_argument("--robots", help="a table of robots files: origin, status, body")
    for flag, name in (("--max-pages", "max_pages_per_source"), ("--max-depth", "max_depth"), ("--max-queue", "max_queue"), ("--max-requests", "max_requests"), ("--max-retries", "max_retries")):
        own = name in ("max_queue", "max_retries")
        p.add_argument(flag, dest=name, type=int, default=V.DEFAULT_LIMITS[name], help="of the connector, or of exact crawls of one source" if own else None)
    for flag, name in (("--delay", "request_delay_seconds"), ("--timeout", "timeout_seconds"), ("--max-seconds", "max_seconds"), ("--max-retry-wait", "max_retry_wait")):
        p.add_argument(flag, dest=name, type=float, default=V.DEFAULT_LIMITS[name], help="of the connector that fetches pages; recorded in the summary of a run over a table")
    p.add_argument("--dry-run", action="store_true")
    return p


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    limits = {k: getattr(a, k) for k in V.DEFAULT_LIMITS}
    try:
        crawl.check_limits(limits)
        source_list, taxonomy = config.load(a.sources, a.subjects)
    except (ValueError, OSError) as problem:
        log.error("%s", problem)
        return 2
    spark = SparkSession.builder.getOrCreate()
    robots = spark.read.parquet(a.robots) if a.robots else None
    return run(spark, spark.read.parquet(a.pages), source_list, taxonomy, a.catalog, a.out, a.source, a.dry_run, limits, robots)["exit_code"]


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    sys.exit(main())
