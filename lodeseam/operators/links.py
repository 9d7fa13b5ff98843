"""Links of pages, and the scored decision on each of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html, text, urls
from ..functions import vocabulary as V

ADDED = ["accepted", "score", "decision_title", "subject", "domain", "grade", "education_level", "document_type", "reasons", "rejection_reason"]


def explode_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each link of a page, and one (link_idx -1) for the page itself with its title as text.

    The other columns of `pages` stay; href, text, title, before, after, link_idx and page_title come.
    """
    p = pages.withColumn("_p", html.parsed(F.col(html_col))).withColumn("page_title", F.col("_p.title"))
    itself = F.array(F.struct(F.col(url_col).alias("href"), F.col("page_title").alias("text"), *(F.lit("").alias(c) for c in ("title", "before", "after"))))
    out = p.select("*", F.posexplode(F.concat(itself, F.col("_p.links"))).alias("_i", "_l")).drop("_p", html_col)
    return out.select(*(c for c in out.columns if c not in ("_i", "_l")), (F.col("_i") - 1).alias("link_idx"), "_l.*")


def evaluate_links(links: DataFrame, config: dict, page_url: str = "page_url", threshold: int = V.THRESHOLD) -> DataFrame:
    """Resolves each link (href, text, title, before, after), finds its title, and classifies it.

    Adds target, link_title, filename and the columns of `classify`.
    """
    x = links.withColumn("target", urls.resolve(F.col(page_url), F.col("href")))
    x = x.withColumn("filename", F.coalesce(text.unquoted(urls.last_segment(F.col("target"))), F.lit("")))
    said = F.trim(F.col("text"))
    said = F.when(said == "", F.trim("title")).otherwise(said)
    stem = F.trim(F.translate(F.regexp_replace("filename", r"\.[^.]*$", ""), "_-", "  "))
    generic = (said == "") | F.lower(F.trim(said)).isin(V.GENERIC_ANCHORS)
    x = x.withColumn("link_title", F.when(generic & (F.col("target") != ""), stem).otherwise(said))
    x = x.withColumns({"_anchor": F.trim("text"), "_around": F.trim(F.concat_ws(" ", "before", "after"))})
    return classify(x, "target", "link_title", "_anchor", "filename", "_around", config, threshold).drop("_anchor", "_around")


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def classify(df: DataFrame, url: str, title: str, anchor: str, filename: str, around: str, config: dict, threshold: int = V.THRESHOLD) -> DataFrame:
    """Adds the decision on each row (see `ADDED`). `url` has to be in normal form or empty.

    Normal forms are made once, as columns; flags, score, reasons and verdict are native expressions.
    """
    said = F.when(F.coalesce(title, F.lit("")) == "", F.col(anchor)).otherwise(F.col(title))
    x = df.withColumns({"decision_title": said, "_path": urls.path(F.col(url))})
    x = x.withColumn("_evidence", F.concat_ws(" ", "_path", filename, anchor, "decision_title"))
    last = F.replace(F.regexp_replace(urls.last_segment(F.col(url)), r"(?i)\.[a-z0-9]{1,5}$", " "), F.lit("+"), F.lit(" "))
    forms = {"_t": F.col("decision_title"), "_p": last, "_e": F.col("_evidence"), "_full": F.col("_path"), "_f": F.col(filename), "_a": F.col(anchor), "_s": F.col(around), "_u": F.concat_ws(" ", url, "_evidence")}
    x = x.withColumns({k: F.coalesce(text.normal(v), F.lit("")) for k, v in forms.items()})
    x = x.withColumn("_g", F.coalesce(text.grade_form(F.col("_evidence")), F.lit("")))
    x = x.withColumn("_gn", text.normal(F.col("_g")))
    fields = [F.col(c) for c in ("_full", "_f", "_a", "_t")]
    x = x.withColumns({
        "_doc": urls.is_document(F.col(url)),
        "_sub": text.subject_and_domain(F.col("_e"), config),
        "_grade": text.grade_and_level(F.col("_g"), F.col("_gn"), config),
        "_word": text.first_phrase(fields, V.POSITIVE),
        "_specific": _any([text.has_phrase(f, V.SPECIFIC) for f in fields]),
        "_timetable": text.has_phrase(F.col("_t"), "timetable"),
        "_nav_text": F.concat_ws(" ", "_t", "_p"),
    })
    hint = F.rlike("_e", F.lit("download|attachment|file"))
    x = x.withColumns({
        "_direct": F.col("_doc") | (hint & text.has_phrase(F.col("_e"), V.POSITIVE)),
        "_near": ~F.col("_timetable") & text.has_phrase(F.col("_s"), V.NEARBY),
        "_infra": text.has_phrase(F.col("_nav_text"), V.INFRASTRUCTURE),
        "_nav": _any([(F.col("_t") == t) | (F.col("_p") == t) | F.endswith("_p", F.lit(f" {t}")) for t in V.NAVIGATION]),
        "_category": F.arrays_overlap(F.transform(F.split("_full", "/"), F.trim), F.array(*map(F.lit, V.CATEGORY_ROUTES))),
        "_hub": F.col("_t") == "paper hub",
    })
    root = (F.regexp_replace("_path", "/+$", "") == "") & ~F.col("_specific")
    x = x.withColumn("_listing", text.has_phrase(F.col("_nav_text"), V.LISTING) | F.col("_p").isin(V.LISTING_PATHS) | F.col("_t").isin(V.LISTING_PATHS) | F.col("_category") | root | F.col("_hub"))
    year = F.rlike("_evidence", F.lit(r"(?U)\b(?:19|20)\d{2}\b"))
    concrete = F.col("_specific") & ((F.col("_grade.grade") != "") | (F.col("_sub.subject") != "") | year)
    strong = F.col("_doc") | (concrete & ~F.col("_category") & ~F.col("_p").isin(V.LISTING_ROUTES))
    infra, nav = F.col("_infra"), ~F.col("_infra") & F.col("_nav")
    plain = ~F.col("_infra") & ~F.col("_nav") & F.col("_listing") & ~F.col("_hub")
    rules = [
        (F.col("_direct"), 5, F.lit("direct_document_link +5")),
        (F.col("_sub.subject") != "", 3, F.concat(F.lit("configured_subject:"), F.col("_sub.subject"), F.lit(" +3"))),
        (F.col("_grade.grade") != "", 3, F.concat(F.lit("explicit_grade_or_level:"), F.col("_grade.grade"), F.lit(" +3"))),
        (F.col("_word").isNotNull(), 2, F.concat(F.lit("educational_keyword:"), F.col("_word"), F.lit(" +2"))),
        (F.col("_specific"), 4, F.lit("resource_title +4")),
        (F.col("_near"), 1, F.lit("educational_surrounding_text +1")),
        (F.col("_hub"), -3, F.lit("category_or_listing_page -3")),
        (infra, -5, F.lit("site_infrastructure -5")),
        (nav, -4, F.lit("navigation_page -4")),
        (plain, -3, F.lit("category_or_listing_page -3")),
    ]
    score = reduce(lambda a, b: a + b, (F.when(on, points).otherwise(0) for on, points, _ in rules))
    x = x.withColumns({"_score": score, "_reasons": F.array_compact(F.array(*(F.when(on, why) for on, _, why in rules)))})
    bad = F.coalesce(F.col(url) == "", F.lit(True))
    ok = (F.col("_score") >= threshold) & ~F.col("_timetable") & (~(F.col("_infra") | F.col("_nav") | F.col("_listing")) | strong)
    x = x.withColumn("accepted", ~bad & ok)
    why = (
        F.when(bad, "invalid URL").when(infra, "site infrastructure").when(nav, "navigation").when(F.col("_hub") | plain, "category/listing page")
        .when(~F.col("accepted") & F.col("_timetable"), "timetable/non-document page").when(~F.col("accepted"), "below candidate threshold").otherwise("")
    )
    empty = F.array().cast("array<string>")
    x = x.withColumns({
        "score": F.when(bad, -999).otherwise(F.col("_score")),
        "subject": F.when(bad, "").otherwise(F.col("_sub.subject")), "domain": F.when(bad, "").otherwise(F.col("_sub.domain")),
        "grade": F.when(bad, "").otherwise(F.col("_grade.grade")), "education_level": F.when(bad, "").otherwise(F.col("_grade.level")),
        "document_type": F.when(bad, "other").otherwise(text.document_type(F.col("_u"))),
        "reasons": F.when(bad, empty).otherwise(F.col("_reasons")), "rejection_reason": why,
    })
    return x.select(*df.columns, *ADDED)
