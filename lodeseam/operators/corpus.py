"""Corpus stages: cleaning, duplicates, repeated lines, gates, coverage, samples, splits, contamination, events, manifests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import vocabulary as V
from ..functions.text import composed
from ..functions.urls import let

#: Project constants of this repository (nothing outside gives them).
SPLITS = [("train", 80), ("dev", 10), ("test", 10)]
MIN_QUALITY_CHARS, MAX_SYMBOL_SHARE, MIN_DISTINCT_SHARE = 100, 0.2, 0.3


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def clean(text: Column) -> Column:
    """White space squeezed within lines, empty lines dropped; joiners, negations and units stay."""
    lines = F.transform(F.split(text, "\n"), lambda s: F.trim(F.regexp_replace(s, r"[ \t\r\f]+", " ")))
    return F.array_join(F.filter(lines, lambda s: s != ""), "\n")


def cleaned(df: DataFrame) -> DataFrame:
    """Adds cleaned and transforms (what was done: nfc, white_space, empty_lines) to rows with a text; the text itself stays."""
    nfc = df.withColumn("_nfc", composed(F.col("text")))
    squeezed = F.array_join(F.transform(F.split("_nfc", "\n"), lambda s: F.trim(F.regexp_replace(s, r"[ \t\r\f]+", " "))), "\n")
    done = nfc.withColumn("_squeezed", squeezed).withColumn("cleaned", clean(F.col("_nfc")))
    steps = [("nfc", F.col("_nfc") != F.col("text")), ("white_space", F.col("_squeezed") != F.col("_nfc")), ("empty_lines", F.col("cleaned") != F.col("_squeezed"))]
    return done.withColumn("transforms", F.array_compact(F.array(*(F.when(on, name) for name, on in steps)))).drop("_nfc", "_squeezed")


def download_queue(catalog: DataFrame, pilots: DataFrame) -> DataFrame:
    """DISCOVERED rows with a URL that aren't pilots."""
    return catalog.filter("status = 'DISCOVERED' AND source_url <> ''").join(pilots.select("doc_id"), "doc_id", "left_anti")


def detected_type(content: Column) -> Column:
    """pdf, zip, html or unknown by the first bytes; white space may stand before HTML."""
    head = F.hex(F.substring(content, 1, 4))
    text = F.lower(F.substring(F.regexp_replace(F.decode(F.substring(content, 1, 256), "ISO-8859-1"), r"^\s+", ""), 1, 14))
    return F.when(head == "25504446", "pdf").when(F.startswith(head, F.lit("504B0304")), "zip").when(F.startswith(text, F.lit("<!doctype html")) | F.startswith(text, F.lit("<html")), "html").otherwise("unknown")


def artifacts(rows: DataFrame) -> DataFrame:
    """sha256, urls (all aliases) of (url, content)."""
    return rows.groupBy(F.sha2("content", 256).alias("sha256")).agg(F.sort_array(F.collect_set("url")).alias("urls"))


def versions(rows: DataFrame) -> DataFrame:
    """Adds version: the number of the content of each URL, in the order of ts, counted where the hash changes."""
    by = W.partitionBy("url").orderBy("ts")
    new = F.when(F.col("sha256") != F.coalesce(F.lag("sha256").over(by), F.lit("")), 1).otherwise(0)
    return rows.withColumn("_new", new).withColumn("version", F.sum("_new").over(by)).drop("_new")


def page_checks(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_chars, letter_share, n_replacement, n_empty_lines of each text."""
    t = F.col(text)
    n = F.length(t)
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]", ""))
    return df.withColumns({
        "n_chars": n.cast("long"),
        "letter_share": F.round(F.coalesce(F.try_divide(letters, n), F.lit(0.0)), 6),
        "n_replacement": (n - F.length(F.translate(t, "�", ""))).cast("long"),
        "n_empty_lines": F.size(F.filter(F.split(t, "\n"), lambda s: F.trim(s) == "")).cast("long"),
    })


def needs_ocr(checked: DataFrame, min_chars: int = 50, min_letters: float = 0.3) -> DataFrame:
    """Pages whose text is too thin."""
    return checked.filter((F.col("n_chars") < min_chars) | (F.col("letter_share") < min_letters))


def exact_duplicates(df: DataFrame, key: Column, id_col: str = "doc_id") -> DataFrame:
    """canonical_id, n for each group of equal keys with two rows or more."""
    return df.groupBy(F.sha2(key, 256).alias("content_sha256")).agg(F.min(id_col).alias("canonical_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")


def repeated_lines(df: DataFrame, min_docs: int, id_col: str = "doc_id") -> DataFrame:
    """line, n_docs: trimmed lines found in `min_docs` documents or more (a line counts once in each)."""
    lines = df.select(id_col, F.explode(F.array_distinct(F.transform(F.split("text", "\n"), lambda s: F.trim(s)))).alias("line")).filter("line <> ''")
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") >= min_docs)


def without_repeated_lines(df: DataFrame, min_docs: int, id_col: str = "doc_id") -> DataFrame:
    """Adds kept_text and removed, array<struct<at, line>>: the repeated lines that were taken out, with their places.

    Documents that have repeated lines get the list of theirs; no list of all lines is held anywhere.
    """
    trimmed = F.transform(F.split("text", "\n"), lambda s: F.trim(s))
    own = df.select(id_col, F.explode(F.array_distinct(trimmed)).alias("line")).join(repeated_lines(df, min_docs, id_col).select("line"), "line")
    x = df.join(own.groupBy(id_col).agg(F.collect_set("line").alias("_found")), id_col, "left").withColumn("_found", F.coalesce("_found", F.array().cast("array<string>")))
    numbered = F.transform(F.split("text", "\n"), lambda s, i: F.struct(i.alias("at"), F.trim(s).alias("line"), s.alias("raw")))
    x = x.withColumn("_lines", numbered)
    kept = F.transform(F.filter("_lines", lambda p: ~F.array_contains("_found", p["line"])), lambda p: p["raw"])
    gone = F.transform(F.filter("_lines", lambda p: F.array_contains("_found", p["line"])), lambda p: F.struct(p["at"].alias("at"), p["line"].alias("line")))
    return x.withColumns({"kept_text": F.array_join(kept, "\n"), "removed": gone}).drop("_found", "_lines")


def quality_gate(df: DataFrame) -> DataFrame:
    """doc_id, accepted, reasons: several measures of each text, each with its reason."""
    t = F.col("text")
    n, w = F.length(t), words(t)
    symbols = n - F.length(F.translate(t, "#*$%&|<>{}[]~^", ""))
    reasons = F.array_compact(F.array(
        F.when(n < MIN_QUALITY_CHARS, "too_short"),
        F.when(symbols > n * F.lit(MAX_SYMBOL_SHARE), "too_many_symbols"),
        F.when(F.size(F.array_distinct(w)) < F.size(w) * F.lit(MIN_DISTINCT_SHARE), "too_repetitive"),
    ))
    x = df.select("doc_id", reasons.alias("reasons"))
    return x.select("doc_id", (F.size("reasons") == 0).alias("accepted"), F.array_join("reasons", ",").alias("reasons"))


def coverage(df: DataFrame, keys: list[str], usable: Column) -> DataFrame:
    """Rows and usable rows for every grouping set of one key, all keys, and none."""
    sets = [[k] for k in keys] + [keys, []]
    return df.withColumn("_u", usable).groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"), F.count_if("_u").alias("n_usable"), F.grouping_id().cast("long").alias("level"))


def stratified_sample(df: DataFrame, strata: list[str], n: int, seed: str, id_col: str = "doc_id") -> DataFrame:
    """n rows of each stratum, the first by a seeded hash of the id, with the stratum's size.

    Rows of a stratum are first cut to those below a bound of the hash that holds 4n of them on average,
    so that only these are sorted; where a stratum has fewer than 4n rows all are.
    """
    h = F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col)))
    sizes = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("stratum_size"))
    share = F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    near = df.join(sizes, strata).withColumn("_h", h).filter(share * F.col("stratum_size") <= 4 * n + 64)
    return near.withColumn("_n", F.row_number().over(W.partitionBy(*strata).orderBy("_h", id_col))).filter(F.col("_n") <= n).drop("_n", "_h")


def sampled_share(sample: DataFrame, strata: list[str], hit: Column) -> DataFrame:
    """For each stratum of a sample (with stratum_size): n, share of hits, and its standard error for a sample without replacement."""
    x = sample.groupBy(*strata).agg(F.count(F.lit(1)).alias("n"), F.max("stratum_size").alias("stratum_size"), F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("share"))
    left = F.when(F.col("stratum_size") > 1, (F.col("stratum_size") - F.col("n")) / (F.col("stratum_size") - 1)).otherwise(0.0)
    return x.withColumn("standard_error", F.sqrt(F.col("share") * (1 - F.col("share")) / F.col("n") * left))


def _windows(text: Column, n: int, of: Callable[[Column], Column]) -> Column:
    """`of` every distinct window of n words; the words are worked out once."""
    each = lambda w: F.when(F.size(w) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: of(F.slice(w, i, n)))))
    return let(words(text), each)


def ngrams(text: Column, n: int) -> Column:
    """The distinct word n-grams of a text; null if it has fewer words."""
    return _windows(text, n, lambda w: F.array_join(w, " "))


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 8) -> DataFrame:
    """doc_id, n_shared, n_items: documents that share word n-grams with items of an authorised benchmark.

    64-bit hashes of n-grams find the documents that may; only their n-grams are compared as texts.
    """
    marks = benchmark.select("item_id", F.explode(ngrams(F.col("text"), n)).alias("gram"))
    hashed = lambda t: _windows(t, n, lambda w: F.xxhash64(w))
    sought = benchmark.select(F.explode(hashed(F.col("text"))).alias("h")).distinct()
    maybe = docs.select("doc_id", F.explode(hashed(F.col("text"))).alias("h")).join(sought, "h", "left_semi").select("doc_id").distinct()
    own = docs.join(maybe, "doc_id", "left_semi").select("doc_id", F.explode(ngrams(F.col("text"), n)).alias("gram"))
    return own.join(marks, "gram").groupBy("doc_id").agg(F.count_distinct("gram").alias("n_shared"), F.count_distinct("item_id").alias("n_items"))


def split_of(group: Column, seed: str) -> Column:
    """The split of a group: whole groups go by a seeded hash, so none is in two."""
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), group)), 1, 6), 16, 10).cast("long") % 100
    out, upto = F.lit(SPLITS[-1][0]), sum(share for _, share in SPLITS[:-1])
    for name, share in SPLITS[-2::-1]:
        out = F.when(place < upto, name).otherwise(out)
        upto -= share
    return out


def grouped_split(docs: DataFrame, seed: str = "split") -> DataFrame:
    """doc_id, group_id, split, by groups of equal texts."""
    groups = docs.groupBy(F.sha2("text", 256).alias("_k")).agg(F.min("doc_id").alias("group_id"))
    return docs.withColumn("_k", F.sha2("text", 256)).join(groups, "_k").select("doc_id", "group_id", split_of(F.col("group_id"), seed).alias("split"))


def split_overlap(splits: DataFrame) -> DataFrame:
    """Groups that are in more than one split (none should be)."""
    return splits.groupBy("group_id").agg(F.count_distinct("split").alias("n_splits")).filter("n_splits > 1")


def latest_events(events: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """The last value of each key; ties go to the largest value."""
    last = F.max(F.struct(F.col(ts), F.col(value))).alias("m")
    return events.groupBy(key).agg(last, F.count(F.lit(1)).alias("n_events")).select(key, F.col(f"m.{value}").alias("last_value"), F.col(f"m.{ts}").alias("last_ts"), "n_events")


def stage_runs(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds fresh: whether a stage has to run, i.e. no event before has the same input hash, stage and version (the keys)."""
    return events.withColumn("fresh", F.row_number().over(W.partitionBy(*keys).orderBy(*order)) == 1)


def allowed_transitions() -> list[tuple[str, str]]:
    """Each state to the next; any working state to its failure; failures back to the state before."""
    steps = list(zip(V.LIFECYCLE, V.LIFECYCLE[1:], strict=False))
    return steps + [("DISCOVERED", "DOWNLOAD_FAILED"), ("DOWNLOADED", "EXTRACTION_FAILED"), ("DOWNLOADED", "OCR_FAILED"), ("CLEANED", "DUPLICATE"), ("DEDUPLICATED", "QUALITY_FAILED"), ("DOWNLOAD_FAILED", "DOWNLOADED"), ("EXTRACTION_FAILED", "EXTRACTED"), ("OCR_FAILED", "EXTRACTED"), ("QUALITY_FAILED", "VALIDATED")]


def bad_transitions(events: DataFrame, key: str, order: list[str], state: str, allowed: list[tuple[str, str]]) -> DataFrame:
    """Rows whose state may not follow the one before it."""
    before = F.lag(state).over(W.partitionBy(key).orderBy(*order))
    pairs = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in allowed))
    x = events.withColumn("from_state", before).filter("from_state IS NOT NULL")
    return x.filter(~F.array_contains(pairs, F.struct(F.col("from_state").alias("a"), F.col(state).alias("b"))))


def evaluation(rows: DataFrame, group: str, correct: Column) -> DataFrame:
    """One row: n, accuracy over all rows, and the mean of the groups' accuracies."""
    each = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.count_if(correct).alias("hits"))
    return each.agg(F.sum("n").alias("n"), F.round(F.sum("hits") / F.sum("n"), 9).alias("accuracy"), F.round(F.avg(F.col("hits") / F.col("n")), 9).alias("macro_accuracy"))


def paired_change(before: DataFrame, after: DataFrame, id_col: str, correct: str) -> DataFrame:
    """One row: n items in both runs, gained (wrong, then right), lost, and the change of accuracy."""
    both = before.select(id_col, F.col(correct).alias("_b")).join(after.select(id_col, F.col(correct).alias("_a")), id_col)
    x = both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_a") & ~F.col("_b")).alias("gained"), F.count_if(F.col("_b") & ~F.col("_a")).alias("lost"))
    return x.withColumn("change", F.round(F.try_divide(F.col("gained") - F.col("lost"), F.col("n")), 9))


def precision_recall(rows: DataFrame, accepted: Column, positive: Column) -> DataFrame:
    x = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(accepted).alias("accepted"), F.count_if(positive).alias("positives"), F.count_if(accepted & positive).alias("true_positives"), F.count_if(accepted == positive).alias("correct"))
    return x.withColumns({"precision": F.round(F.try_divide("true_positives", "accepted"), 9), "recall": F.round(F.try_divide("true_positives", "positives"), 9)})


def completeness(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, and blank cells of each column."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), *(F.count_if(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "").alias(f"blank_{c}") for c in columns))


def question_checks(items: DataFrame) -> DataFrame:
    """Adds problems of multiple-choice items (options array<string>, answer int from 0)."""
    return items.withColumn("problems", F.array_compact(F.array(
        F.when(F.size("options") < 2, "too_few_options"),
        F.when(F.size(F.array_distinct(F.transform("options", lambda o: F.lower(F.trim(o))))) < F.size("options"), "repeated_options"),
        F.when(F.exists("options", lambda o: F.trim(o) == ""), "empty_option"),
        F.when(F.coalesce((F.col("answer") < 0) | (F.col("answer") >= F.size("options")), F.lit(True)), "no_answer"),
    )))


def paper_pairs(papers: DataFrame, schemes: DataFrame, keys: list[str]) -> DataFrame:
    """Papers with their marking scheme by all keys, where both are the only ones of those keys."""
    def single(df: DataFrame) -> DataFrame:
        return df.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(*keys))).filter("_n = 1").drop("_n").filter(" AND ".join(f"`{k}` <> ''" for k in keys))

    return single(papers).select(*keys, F.col("doc_id").alias("paper_id")).join(single(schemes).select(*keys, F.col("doc_id").alias("scheme_id")), keys)


def release_manifest(docs: DataFrame, splits: DataFrame, overlap: DataFrame, seed: str) -> DataFrame:
    """One row: rows, characters, rows of each split, contaminated rows, the seed and a hash of all texts' hashes."""
    joined = docs.join(splits.select("doc_id", "split"), "doc_id").join(overlap.select("doc_id", F.lit(True).alias("_hit")), "doc_id", "left")
    digest = F.sum(F.conv(F.substring(F.md5("text"), 1, 8), 16, 10).cast("long"))
    return joined.agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.length("text")).alias("n_chars"), *(F.count_if(F.col("split") == s).alias(f"n_{s}") for s, _ in SPLITS), F.count_if("_hit").alias("n_overlap"), digest.alias("content_sum"), F.lit(seed).alias("seed"))


def file_hashes(files: DataFrame) -> DataFrame:
    """name, bytes, sha256 of each file of a `binaryFile` table, for a release's manifest."""
    return files.select(F.substring_index("path", "/", -1).alias("name"), F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def model_manifest(models: DataFrame, max_parameters: int, cutoff: str) -> DataFrame:
    """One row: summed parameters, whether they are few enough, and whether all were released before the cutoff."""
    return models.agg(F.sum("parameters").alias("parameters"), (F.sum("parameters") <= max_parameters).alias("size_ok"), F.bool_and(F.col("release_date") < F.lit(cutoff).cast("date")).alias("dates_ok"))
