"""Ranked boolean search: filters, one pass of statistics, one scored pass, a total order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import fold, symbol_key
from quire.plans import textql

K1, B, FLOOR = 1.5, 0.75, 0.01


def in_scope(column: str, scope: str) -> Column:
    return F.lit(True) if scope == "all" else F.col(column) == scope


def year_between(year: Column, first: int | None, last: int | None) -> Column:
    """Inclusive; null years pass; a bound of 0 or None is none."""
    ok = F.lit(True)
    if first:
        ok = ok & (year >= first)
    if last:
        ok = ok & (year <= last)
    return year.isNull() | ok


def year_between_strict(year: Column, first: int | None, last: int | None) -> Column:
    """Only if both bounds are set; a missing year counts as 0."""
    return F.coalesce(year, F.lit(0)).between(first, last) if first and last else F.lit(True)


def any_of(values: Column, wanted: list[str]) -> Column:
    return F.arrays_overlap(values, F.array(*map(F.lit, wanted))) if wanted else F.lit(True)


def all_of(values: Column, wanted: list[str]) -> Column:
    return F.size(F.array_except(F.array(*map(F.lit, wanted)), values)) == 0 if wanted else F.lit(True)


def one_of(columns: list[str], wanted: list[str]) -> Column:
    """Any of the columns holds any of the values."""
    return reduce(lambda a, b: a | b, (F.coalesce(F.col(c).isin(wanted), F.lit(False)) for c in columns)) if wanted else F.lit(True)


def text_stats(rows: DataFrame, terms: list[textql.Node], body: Column, folded: Column) -> dict:
    """N, the mean length and each term's document frequency: one aggregate over the scope, one row to the driver."""
    dfs = [F.sum(textql.test(t, folded).cast("long")).alias(f"df{i}") for i, t in enumerate(terms)]
    return rows.agg(F.count(F.lit(1)).alias("n"), F.avg(F.length(body)).alias("mean"), *dfs).first().asDict()


def idf(n: int, df: Column) -> Column:
    return F.log(F.lit(1.0) + (F.lit(float(n)) - df + 0.5) / (df + 0.5))


def score(terms: list[textql.Node], stats: dict, body: Column, folded: Column) -> Column:
    """BM25 with lengths in characters; FLOOR where a match has no scoring occurrence."""
    norm = K1 * (1 - B + B * F.length(body) / F.lit(float(stats["mean"] or 1.0)))
    total = F.lit(0.0)
    for i, t in enumerate(terms):
        occ = textql.count(t, folded).cast("double")
        total = total + idf(stats["n"], F.lit(float(stats[f"df{i}"] or 0))) * occ * (K1 + 1) / (occ + norm)
    return F.when(total == 0, F.lit(FLOOR)).otherwise(total)


def search(rows: DataFrame, query: str, body: str = "body", where: Column | None = None, notes: str | None = None) -> DataFrame:
    """rows that match, with score: statistics over all rows, filters (cheap ones first) and the query after them.

    An empty query matches all with score 0. Footnotes in `notes` match but never score.
    """
    tree = textql.parse(query)
    folded = fold(F.col(body))
    hay = folded if notes is None else F.concat_ws(" ", folded, fold(F.col(notes)))
    terms = textql.leaves(tree)
    kept = rows if where is None else rows.where(where)
    if not textql.tokenize(query):
        return kept.withColumn("score", F.lit(0.0))
    hits = kept.where(textql.test(tree, hay))
    if not terms:
        return hits.withColumn("score", F.lit(FLOOR))
    return hits.withColumn("score", score(terms, text_stats(rows, terms, F.col(body), folded), F.col(body), folded))


def page(hits: DataFrame, number: int, size: int, order: list[Column], cap: int = 5000) -> DataFrame:
    """Rows of one page (from 1) of the first `cap`, by a total order: a top-k, not a global sort."""
    last = min(number * size, cap)
    top = hits.orderBy(*order).limit(last)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order))).where(F.col("rank") > (number - 1) * size)


def footnote_only(tree: textql.Node, body: Column, notes: Column) -> Column:
    """The note matches and the body does not."""
    return textql.test(tree, fold(notes)) & ~textql.test(tree, fold(body))


def long_enough(query: str, least: int = 4) -> bool:
    """Whether a query (or a remark) has the characters that it needs to be run."""
    return len(query.strip()) >= least


def in_document(body: Column, query: str, least: int = 3) -> Column:
    """Paragraphs to show for a search within a document: all for a query under `least` characters, else those that hold it."""
    return F.contains(F.lower(body), F.lit(query.strip().lower())) if long_enough(query, least) else F.lit(True)


def in_fields(fields: list[Column], terms: str) -> Column:
    """Every term of a query stands in one of the chosen fields."""
    hay = F.lower(F.concat_ws(" ", *fields))
    return reduce(lambda a, b: a & b, (F.contains(hay, F.lit(t)) for t in terms.lower().split()), F.lit(True))


def on_topic(fields: list[Column], topics: list[str]) -> Column:
    """Any topic stands in the fields; without topics, all rows."""
    hay = F.lower(F.concat_ws(" ", *fields))
    return reduce(lambda a, b: a | b, (F.contains(hay, F.lit(t.lower())) for t in topics)) if topics else F.lit(True)


def symbol_guard(symbol: Column, prefixes: list[str], excluded: list[str]) -> Column:
    """Symbols under one of the prefixes that are not excluded by name; case and blanks don't count."""
    key = symbol_key(symbol)
    return reduce(lambda a, b: a | b, (F.startswith(key, F.lit(p.upper())) for p in prefixes), F.lit(False)) & ~key.isin(*excluded)


def order_for(query: str, sort: str, score: Column, date: Column, *ties: Column) -> list[Column]:
    """Relevance: score, then date; date: date, then score, which an empty query always takes. Then the ties."""
    by_date = sort == "date" or not textql.tokenize(query)
    first = [date.desc(), score.desc()] if by_date else [score.desc(), date.desc()]
    return [*first, *ties]


def envelope(hits: DataFrame, query: str, scope: str, number: int, size: int, kind: str, kinds: list[str], order: list[Column], fields: list[str], also: list[str]) -> DataFrame:
    """One row, as a server answers: query, scope, total, page, page_size, breakdown and hits (JSON), and also_try if there is no hit.

    The hits of one page are gathered, never all.
    """
    counts = hits.agg(F.count(F.lit(1)).alias("total"), *(F.coalesce(F.sum((F.col(kind) == k).cast("long")), F.lit(0)).alias(f"k{i}") for i, k in enumerate(kinds)))
    shown = page(hits, number, size, order).agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("rank", *fields))), lambda x: x)).alias("hits"))
    parts = F.to_json(F.struct(*(F.col(f"k{i}").alias(k) for i, k in enumerate(kinds))))
    suggestions = F.when(F.col("total") == 0, F.array(*map(F.lit, also)) if also else F.array().cast("array<string>")).otherwise(F.array().cast("array<string>"))
    return counts.join(shown).select(F.lit(query).alias("query"), F.lit(scope).alias("scope"), "total", F.lit(number).alias("page"), F.lit(size).alias("page_size"), parts.alias("breakdown"), "hits", F.array_join(suggestions, ",").alias("also_try"))
