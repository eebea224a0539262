"""Mixing sources to target weights: hierarchical budgets, then seeded token prefixes. DataFrame functions only.

The token budget flows down a tree of domains, languages and sources by their weights. A node can't take
more than its documents hold over the allowed epochs; what it can't take goes to its siblings first, and
only what all siblings together can't take goes to the parent's siblings. Each leaf then reads its
documents in a seeded order, a new one each epoch, until its tokens are reached.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import buckets_for, forget, shielded, stored

LEVELS = ["domain", "lang", "source"]
#: Integer weights by level and name; other names weigh DEFAULT_WEIGHT.
WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 6, "fr": 2, "de": 2, "es": 2}, "source": {}}
DEFAULT_WEIGHT = 1
BUDGET_PERCENT, MAX_EPOCHS, SEED = 60, 3, 42
WORD = r"[^\x20\x09-\x0D]+"


def domain_of(source: Column) -> Column:
    """The domain of a source by its trailing number; sources without one are `other`."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    third = F.when(number != "", number.cast("long") % 3)
    return F.when(third == 0, "web").when(third == 1, "books").when(third == 2, "code").otherwise("other")


def weight_of(level: str, weights: dict) -> Column:
    return reduce(lambda rest, kv: F.when(F.col(level) == kv[0], F.lit(kv[1]).cast("long")).otherwise(rest), sorted(weights.get(level, {}).items()), F.lit(DEFAULT_WEIGHT).cast("long"))


def leaf_columns(docs: DataFrame) -> DataFrame:
    """docs with the tree's columns as _domain, _lang and _source; nulls are the empty name."""
    source = F.coalesce(F.col("source"), F.lit(""))
    return docs.withColumn("_domain", domain_of(source)).withColumn("_lang", F.coalesce(F.col("lang"), F.lit(""))).withColumn("_source", source)


def order_key(epoch: Column, seed: int) -> Column:
    """Where a document stands in its leaf's order in an epoch: hex digits that sort as text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def share_out(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """nodes(parents, name, cap, weight, budget: the parent's) with `given`: integers that add up to the
    budget, or to all caps if those are less.

    Nodes fill up in the order of cap / weight. Node i is full if its cap is at most its weight's share of
    what the nodes before it leave. The others share the rest by weight, rounded so that no token is lost.
    """
    by = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = by.orderBy((F.col("cap") / F.col("weight")).cast("double"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    n = nodes.withColumn("_w", F.sum("weight").over(by) - zero(F.sum("weight").over(before))).withColumn("_b", F.col("budget") - zero(F.sum("cap").over(before))).withColumn("_i", F.row_number().over(order))
    n = n.withColumn("_open", F.min(F.when(F.col("cap") * F.col("_w") > F.col("weight") * F.col("_b"), F.col("_i"))).over(by))
    n = n.withColumn("_full", F.coalesce(F.col("_i") < F.col("_open"), F.lit(True)))
    n = n.withColumn("_r", F.col("budget") - F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(by)).withColumn("_t", F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(by))
    upto = F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    n = n.withColumn("_upto", upto)
    part = F.expr("(_upto * _r) div _t - ((_upto - weight) * _r) div _t")
    return n.withColumn("given", F.when(F.col("_full"), F.col("cap")).otherwise(part)).drop("_w", "_b", "_i", "_open", "_full", "_r", "_t", "_upto")


def budgets(supply: DataFrame, weights: dict, budget_percent: int, max_epochs: int) -> DataFrame:
    """supply(LEVELS, supply) with each leaf's budget in tokens."""
    leaves = supply.withColumn("cap", F.col("supply") * max_epochs)
    above = leaves.agg((F.sum("supply") * budget_percent).alias("t")).select(F.expr("t div 100").alias("budget"))
    for depth, level in enumerate(LEVELS):
        parents = LEVELS[:depth]
        nodes = leaves.groupBy(*parents, level).agg(F.sum("cap").alias("cap"), F.sum("supply").alias("supply")).withColumn("weight", weight_of(level, weights))
        nodes = nodes.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(0)).withColumn("weight", F.greatest("weight", F.lit(1).cast("long")))
        joined = nodes.join(above, parents) if parents else nodes.join(F.broadcast(above))
        above = share_out(joined, parents, level).select(*parents, level, "supply", F.col("given").alias("budget"))
        if depth + 1 < len(LEVELS):
            above = above.drop("supply")
    return above


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def count_tokens(docs: DataFrame) -> DataFrame:
    """doc_id, the tree's columns and n_tokens (words of the whole text; a null text has none)."""
    rows = leaf_columns(docs.select("doc_id", "lang", "source", tokens_of(F.col("text")).alias("n_tokens")))
    return rows.select("doc_id", F.col("_domain").alias("domain"), F.col("_lang").alias("lang"), F.col("_source").alias("source"), "n_tokens")


def cuts(counted: DataFrame, weights: dict, budget_percent: int, max_epochs: int, seed: int) -> DataFrame:
    """One row a leaf: LEVELS, full (epochs read whole), cut_key (the last document of the epoch after them,
    null if none) and cut_take (its tokens).

    Keys are cut into ranges, so a leaf with a third of all rows is summed by range on the map side;
    only the one range in which a leaf's tokens end is ordered row by row.
    """
    supply = counted.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("supply"))
    plan = stored(budgets(supply, weights, budget_percent, max_epochs).where("supply > 0").withColumn("full", F.expr("budget div supply")).withColumn("rest", F.expr("budget % supply")))
    ranges = 8 * buckets_for(counted.count())
    rows = counted.where("n_tokens > 0").join(plan.where("rest > 0"), LEVELS).withColumn("key", order_key(F.col("full") + 1, seed))
    rows = rows.withColumn("range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * ranges / (1 << 32)).cast("int"))
    by_range = rows.groupBy(*LEVELS, "range", "rest").agg(F.sum("n_tokens").alias("n"))
    running = Window.partitionBy(*LEVELS).orderBy("range")
    by_range = by_range.withColumn("before", F.sum("n").over(running.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    last = by_range.where("before < rest and before + n >= rest").select(*LEVELS, "range", "before")
    inside = rows.join(last, [*LEVELS, "range"]).groupBy(*LEVELS, "key", "rest", "before").agg(F.sum("n_tokens").alias("n"))
    inside = inside.withColumn("start", F.col("before") + F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("key").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    ends = inside.where("start < rest and start + n >= rest").select(*LEVELS, F.col("key").alias("cut_key"), (F.col("rest") - F.col("start")).alias("cut_take"))
    return plan.join(ends, LEVELS, "left").select(*LEVELS, "full", "cut_key", "cut_take")


def mix(docs: DataFrame, weights: dict = WEIGHTS, budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """doc_id, domain, lang, source, epoch, n_tokens and take_tokens: a row for each reading of a document.

    The budget is budget_percent of all tokens. take_tokens is n_tokens but for the document at which a
    leaf's tokens end. Documents without words are never read. Null languages and sources are leaves
    named by the empty text. Rows that share a doc_id and a leaf share their place; if the tokens end at
    them, each gives up to what is left. An empty table gives no rows; other columns are not read.
    """
    counted = stored(count_tokens(docs))
    plan = cuts(counted, weights, budget_percent, max_epochs, seed)
    rows = counted.where("n_tokens > 0").join(plan, LEVELS).withColumn("key", order_key(F.col("full") + 1, seed))
    whole = F.when(F.col("full") > 0, F.sequence(F.lit(1).cast("long"), F.col("full"))).otherwise(F.array().cast("array<long>"))
    epochs = F.when(F.col("key") <= F.col("cut_key"), F.array_append(whole, F.col("full") + 1)).otherwise(whole)
    rows = rows.withColumn("epoch", F.explode(epochs))
    take = F.when((F.col("epoch") > F.col("full")) & (F.col("key") == F.col("cut_key")), F.least("n_tokens", "cut_take")).otherwise(F.col("n_tokens"))
    return rows.select("doc_id", *LEVELS, "epoch", "n_tokens", take.alias("take_tokens"))


def choose(docs: DataFrame, weights: dict = WEIGHTS, budget_percent: int = BUDGET_PERCENT, seed: int = SEED) -> DataFrame:
    """The rows of docs that one epoch of mix() reads, whole and with all their columns; texts aren't shuffled.

    Null and empty texts, and those without words, go. Null languages and sources are leaves named by the empty
    text; null ids share a place in their leaf's order, as rows that repeat an id do, and stay or go together. An
    empty table gives no rows; texts of any length count whole; extra columns stay, whatever their names.
    """
    docs, names = shielded(docs, ["doc_id", "text", "lang", "source"])
    counted = stored(count_tokens(docs))
    plan = stored(cuts(counted, weights, budget_percent, 1, seed))
    forget(counted)
    leaf = [F.col(c).alias(f"_{c}") for c in LEVELS]
    rows = leaf_columns(docs).join(plan.select(*leaf, "full", "cut_key"), [f"_{c}" for c in LEVELS])
    rows = rows.where((F.col("full") > 0) | (order_key(F.col("full") + 1, seed) <= F.col("cut_key"))).where(tokens_of(F.col("text")) > 0)
    return rows.select(*(docs[c] for c in docs.columns)).toDF(*names)


ORACLE = r"""
WITH counted AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CASE CAST(nullif(regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1), '') AS BIGINT) % 3
      WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'code' ELSE 'other' END AS domain,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS supply, (sum(n_tokens) * {epochs})::BIGINT AS cap FROM counted GROUP BY ALL),
d0 AS (SELECT domain, sum(cap)::BIGINT AS cap, CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'code' THEN 2 ELSE 1 END AS weight,
    (SELECT sum(supply)::BIGINT * {percent} // 100 FROM leaves) AS budget FROM leaves GROUP BY domain),
{fill_d}
l0 AS (SELECT a.domain, a.lang, sum(a.cap)::BIGINT AS cap, CASE a.lang WHEN 'en' THEN 6 WHEN 'fr' THEN 2 WHEN 'de' THEN 2 WHEN 'es' THEN 2 ELSE 1 END AS weight, any_value(b.given) AS budget
  FROM leaves a JOIN d3 b USING (domain) GROUP BY a.domain, a.lang),
{fill_l}
s0 AS (SELECT a.domain, a.lang, a.source, a.supply, a.cap, 1 AS weight, b.given AS budget FROM leaves a JOIN l3 b USING (domain, lang)),
{fill_s}
plan AS (SELECT domain, lang, source, given // supply AS whole, given % supply AS rest FROM s3 WHERE supply > 0),
keyed AS (SELECT c.*, p.whole, p.rest, md5(concat('{seed}:', p.whole + 1, ':', coalesce(c.doc_id::VARCHAR, ''))) AS key FROM counted c JOIN plan p USING (domain, lang, source) WHERE n_tokens > 0),
started AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key ROWS UNBOUNDED PRECEDING) - n_tokens AS start FROM keyed)
SELECT doc_id, domain, lang, source, unnest(range(1, whole + 1)) AS epoch, n_tokens, n_tokens AS take_tokens FROM keyed
UNION ALL
SELECT doc_id, domain, lang, source, whole + 1 AS epoch, n_tokens, least(n_tokens, rest - start)::BIGINT AS take_tokens FROM started WHERE start < rest
"""
FILL = """
{x}1 AS (SELECT *, row_number() OVER o AS i, sum(weight) OVER p - coalesce(sum(weight) OVER b, 0) AS w, budget - coalesce(sum(cap) OVER b, 0) AS r FROM {x}0
  WINDOW p AS ({by}), o AS ({by} ORDER BY cap::DOUBLE / weight, {name}), b AS ({by} ORDER BY cap::DOUBLE / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{x}2 AS (SELECT * EXCLUDE (w, r), coalesce(i < min(CASE WHEN cap::HUGEINT * w > weight * r THEN i END) OVER ({by}), true) AS sated FROM {x}1),
{x}25 AS (SELECT *, (budget - sum(CASE WHEN sated THEN cap ELSE 0 END) OVER ({by}))::HUGEINT AS r, (sum(CASE WHEN sated THEN 0 ELSE weight END) OVER ({by}))::HUGEINT AS t, (sum(CASE WHEN sated THEN 0 ELSE weight END) OVER ({by} ORDER BY i ROWS UNBOUNDED PRECEDING))::HUGEINT AS u FROM {x}2),
{x}3 AS (SELECT * EXCLUDE (r, t, u), (CASE WHEN sated THEN cap ELSE (u * r) // t - ((u - weight) * r) // t END)::BIGINT AS given FROM {x}25),
"""


def oracle(budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """DuckDB SQL for mix() of documents with WEIGHTS."""
    fills = {f"fill_{x}": FILL.format(x=x, by=by, name=name) for x, by, name in (("d", "", "domain"), ("l", "PARTITION BY domain", "lang"), ("s", "PARTITION BY domain, lang", "source"))}
    text = ORACLE.replace("{1,9}", "{{1,9}}")
    return text.format(percent=budget_percent, epochs=max_epochs, seed=seed, **fills)
