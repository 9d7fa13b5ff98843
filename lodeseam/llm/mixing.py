"""Mixing sources to target weights by hierarchical budgeting.

Supply is counted for each leaf of a domain-language-source tree. From the root down, each node's
budget is dealt to its children by weight, up to what each can give (`max_epochs` times its supply):
what a child can't give goes to its siblings by weight, and only what no sibling can give is missing
above them, where the same rule holds for the parent's siblings. All budgets are whole numbers of
tokens (words), and those of a node's children add up to its own.

A leaf with budget A and supply S takes A // S whole epochs, and of one more epoch the longest
prefix of documents, in an order seeded by (seed, epoch, id), that fits in A % S. The cut is found
by narrowing: token sums for 256 cells of the order's hash, then for 256 cells within the cell of
the cut, and so on; only the last cell's documents are sorted. No leaf's rows meet in one task.

Defined cases. Null language or source counts as the empty text, which is a leaf of its own; nodes
without a given weight weigh 1. Null or empty texts have no tokens: they come with each epoch
they precede the cut in, and a leaf without tokens gives each document once. Rows with equal ids have one place in
the order, and stand or fall together. Other columns pass through, whatever their names: those added stand
under `new_prefix` of them. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import documents, new_prefix, words_of, written

LEAF = ["_domain", "_lang", "_source"]
LEVELS = 3
NAMES = ("domain", "lang", "source", "tokens", "epoch")
#: The weights of the query; what isn't named here weighs 1.
DOMAIN_WEIGHTS = {"crawl": 40, "books": 30, "news": 20, "forums": 10}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}
BUDGET_PER_MILLE = 1000
MAX_EPOCHS = 2
SEED = 7


def domain_of(source: Column) -> Column:
    """The query's domains: the first source is a crawl, the others are dealt by their number."""
    number = F.expr("try_cast(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) AS BIGINT)")
    return F.when(source == "src0", "crawl").when(number % 3 == 0, "books").when(number % 3 == 1, "news").otherwise("forums")


def _weight(column: str, weights: dict[str, int]) -> Column:
    if any(not isinstance(w, int) or w < 1 for w in weights.values()):
        raise ValueError("weights must be whole numbers of 1 or more")
    out = F.lit(1)
    for k, w in weights.items():
        out = F.when(F.col(column) == k, w).otherwise(out)
    return out.cast("long")


def _dealt(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds `got`: each parent's budget `have` dealt to its children by `w`, up to `cap` each."""
    wide = "decimal(38,0)"
    group = W.partitionBy(*parent) if parent else W.partitionBy(F.lit(0))
    order = group.orderBy((F.col("cap") / F.col("w")).asc(), F.col(name))
    upto = F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, 0)).cast(wide)
    after = F.coalesce(F.sum("w").over(order.rowsBetween(1, W.unboundedFollowing)), F.lit(0)).cast(wide)
    full = upto * F.col("w") + F.col("cap").cast(wide) * after <= F.col("have").cast(wide) * F.col("w")
    x = children.withColumn("full", full)
    x = x.withColumn("left", F.col("have") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0)))
    x = x.withColumn("heavy", F.sum(F.when(~F.col("full"), F.col("w"))).over(group))
    x = x.withColumn("part", F.when(F.col("full"), F.col("cap")).otherwise(F.expr("cast(cast(left AS decimal(38,0)) * w div heavy AS bigint)")))
    x = x.withColumn("spare", F.col("left") - F.coalesce(F.sum(F.when(~F.col("full"), F.col("part"))).over(group), F.lit(0)))
    x = x.withColumn("turn", F.sum(F.when(~F.col("full"), 1).otherwise(0)).over(group.orderBy(name).rowsBetween(W.unboundedPreceding, 0)))
    got = F.col("part") + F.when(~F.col("full") & (F.col("turn") <= F.col("spare")), 1).otherwise(0)
    return x.withColumn("got", got).drop("full", "left", "heavy", "part", "spare", "turn", "have", "w", "cap")


def budgets(supply: DataFrame, domain_weights: dict, lang_weights: dict, source_weights: dict, per_mille: int, max_epochs: int) -> DataFrame:
    """_domain, _lang, _source, supply, got: the token budget of each leaf of `supply` (leaf, supply)."""
    leaves = supply.withColumn("cap", F.col("supply") * max_epochs)
    langs = leaves.groupBy("_domain", "_lang").agg(F.sum("cap").alias("cap"))
    domains = langs.groupBy("_domain").agg(F.sum("cap").alias("cap"))
    whole = leaves.agg(F.expr(f"cast(sum(supply) AS decimal(38,0)) * {per_mille} div 1000").cast("long").alias("have"))
    total = whole.first()["have"] or 0
    d = _dealt(domains.withColumn("w", _weight("_domain", domain_weights)).withColumn("have", F.lit(total).cast("long")), [], "_domain")
    g = _dealt(langs.join(d.withColumnRenamed("got", "have"), "_domain").withColumn("w", _weight("_lang", lang_weights)), ["_domain"], "_lang")
    return _dealt(leaves.join(g.withColumnRenamed("got", "have"), ["_domain", "_lang"]).withColumn("w", _weight("_source", source_weights)), ["_domain", "_lang"], "_source")


def mix(df: DataFrame, domain: Column, domain_weights: dict | None = None, lang_weights: dict | None = None, source_weights: dict | None = None, per_mille: int = 1000, max_epochs: int = 2, seed: int = 0) -> DataFrame:
    """The chosen rows of `df` (doc_id, text, lang, source and any others), once for each epoch, with epoch, tokens, domain, lang and source under `new_prefix(df, NAMES)`: mostly `_epoch` and so on."""
    prefix = new_prefix(df, NAMES)
    whole_row = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row")
    named = df.select(whole_row, "doc_id", domain.alias("_domain"), F.coalesce("lang", F.lit("")).alias("_lang"), F.coalesce("source", F.lit("")).alias("_source"), F.size(words_of(F.col("text"))).cast("long").alias("_tokens"))
    rows = written(named.select("doc_id", *LEAF, "_tokens"))
    supply = rows.groupBy(*LEAF).agg(F.sum("_tokens").alias("supply"))
    got = budgets(supply, domain_weights or {}, lang_weights or {}, source_weights or {}, per_mille, max_epochs)
    whole = F.when(F.col("supply") > 0, F.expr("got div supply")).otherwise(1)
    state = written(got.select(*LEAF, whole.alias("_whole"), F.when(F.col("supply") > 0, F.col("got") % F.col("supply")).otherwise(0).alias("_rest"), F.lit("").alias("_at")))
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    for level in range(LEVELS):
        inside = rows.join(state, LEAF).withColumn("_h", place).filter(F.expr(f"left(_h, {2 * level}) = _at"))
        cells = inside.groupBy(*LEAF, F.expr(f"left(_h, {2 * level + 2})").alias("_cell")).agg(F.sum("_tokens").alias("_sum"))
        before = F.coalesce(F.sum("_sum").over(W.partitionBy(*LEAF).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        placed = cells.withColumn("_before", before).join(state.select(*LEAF, "_rest"), LEAF)
        cut = placed.filter("_before + _sum > _rest").groupBy(*LEAF).agg(F.min(F.struct("_cell", "_before")).alias("_cut"))
        state = written(state.join(cut, LEAF, "left").select(*LEAF, "_whole", (F.col("_rest") - F.coalesce("_cut._before", F.lit(0))).alias("_rest"), F.coalesce("_cut._cell", F.lit("-")).alias("_at")))
    last = rows.join(state, LEAF).withColumn("_h", place).filter(F.expr(f"left(_h, {2 * LEVELS}) = _at"))
    sums = last.groupBy(*LEAF, "_h", "_rest").agg(F.sum("_tokens").alias("_sum"))
    sums = sums.withColumn("_upto", F.sum("_sum").over(W.partitionBy(*LEAF).orderBy("_h")))
    ends = sums.filter("_upto <= _rest").groupBy(*LEAF).agg(F.max("_h").alias("_end"))
    state = written(state.join(ends, LEAF, "left").select(*LEAF, "_whole", F.coalesce("_end", F.when(F.col("_at") == "-", F.lit("-")).otherwise(F.col("_at"))).alias("_end")))
    chosen = named.join(state, LEAF).withColumn("_part", (F.col("_whole") < max_epochs) & (place <= F.col("_end")))
    chosen = chosen.withColumn("_epoch", F.explode(F.sequence(F.lit(0), (F.col("_whole") - F.when(F.col("_part"), 0).otherwise(1)).cast("int")))).filter("_epoch >= 0 AND (_epoch < _whole OR _part)")
    return chosen.select("_row.*", *(F.col(f"_{c}").alias(prefix + c) for c in NAMES))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    out = mix(docs, domain_of(F.col("source")), DOMAIN_WEIGHTS, LANG_WEIGHTS, {}, BUDGET_PER_MILLE, MAX_EPOCHS, SEED)
    return out.select("doc_id", F.col("_epoch").cast("long").alias("epoch"), F.col("_domain").alias("domain"), F.col("_lang").alias("lang"), F.col("_source").alias("source"), F.col("_tokens").alias("n_tokens"))


def _sql_case(column: str, weights: dict[str, int]) -> str:
    return "CASE " + "".join(f"WHEN {column} = '{k}' THEN {w} " for k, w in weights.items()) + "ELSE 1 END" if weights else "1"


def _sql_dealt(name: str, children: str, parent: str, child: str) -> str:
    by = f"PARTITION BY {parent}" if parent else ""
    return f"""
{name}1 AS (SELECT *, (sum(cap) OVER (o ROWS UNBOUNDED PRECEDING))::HUGEINT * w + cap::HUGEINT * coalesce(sum(w) OVER (o ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) <= have::HUGEINT * w AS sat
  FROM ({children}) WINDOW o AS ({by} ORDER BY cap / w, {child})),
{name}2 AS (SELECT *, have - coalesce(sum(cap) FILTER (WHERE sat) OVER (p), 0) AS rest, sum(w) FILTER (WHERE NOT sat) OVER (p) AS heavy FROM {name}1 WINDOW p AS ({by})),
{name}3 AS (SELECT *, CASE WHEN sat THEN cap ELSE rest::HUGEINT * w // heavy END AS part FROM {name}2),
{name}4 AS (SELECT *, rest - coalesce(sum(part) FILTER (WHERE NOT sat) OVER (p), 0) AS spare, sum(CASE WHEN sat THEN 0 ELSE 1 END) OVER ({by} ORDER BY {child} ROWS UNBOUNDED PRECEDING) AS turn FROM {name}3 WINDOW p AS ({by})),
{name} AS (SELECT *, part + CASE WHEN NOT sat AND turn <= spare THEN 1 ELSE 0 END AS got FROM {name}4),"""


SQL = f"""
WITH d AS (SELECT doc_id, CASE WHEN source = 'src0' THEN 'crawl' WHEN n % 3 = 0 THEN 'books' WHEN n % 3 = 1 THEN 'news' ELSE 'forums' END AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source, tokens
  FROM (SELECT *, try_cast(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) AS BIGINT) AS n, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS tokens FROM documents)),
leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS supply, {MAX_EPOCHS} * supply AS cap, 1 AS w FROM d GROUP BY 1, 2, 3),
tongue AS (SELECT domain, lang, sum(cap) AS cap, {_sql_case("lang", LANG_WEIGHTS)} AS w FROM leaf GROUP BY 1, 2),
dom AS (SELECT domain, sum(cap) AS cap, {_sql_case("domain", DOMAIN_WEIGHTS)} AS w FROM tongue GROUP BY 1),
{_sql_dealt("a", f"SELECT *, (SELECT sum(supply)::HUGEINT * {BUDGET_PER_MILLE} // 1000 FROM leaf) AS have FROM dom", "", "domain")}
{_sql_dealt("b", "SELECT t.*, a.got AS have FROM tongue t JOIN a USING (domain)", "domain", "lang")}
{_sql_dealt("c", "SELECT l.*, b.got AS have FROM leaf l JOIN b USING (domain, lang)", "domain, lang", "source")}
e AS (SELECT domain, lang, source, CASE WHEN supply > 0 THEN (got // supply)::BIGINT ELSE 1 END AS whole, CASE WHEN supply > 0 THEN got % supply ELSE -1 END AS rest FROM c),
f AS (SELECT d.*, whole, rest, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5(concat_ws(':', '{SEED}', whole, doc_id))) AS upto FROM d JOIN e USING (domain, lang, source))
SELECT doc_id, epoch, domain, lang, source, tokens::BIGINT AS n_tokens
FROM (SELECT *, unnest(range(whole + CASE WHEN whole < {MAX_EPOCHS} AND upto <= rest THEN 1 ELSE 0 END)) AS epoch FROM f)
"""
