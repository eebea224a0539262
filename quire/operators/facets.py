"""Facets, groups and rollups of a result set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _entry(name: str):
    return lambda v: F.struct(F.lit(name).alias("facet"), v.cast("string").alias("value"))


def counts(df: DataFrame, values: dict[str, Column], weight: Column | None = None) -> DataFrame:
    """(facet, value, n) of several facets in one pass: each row gives one entry a facet (or one a value of an array)."""
    weight = F.lit(1) if weight is None else weight
    entries = []
    for name, c in values.items():
        wide = df.select(c.alias("c")).schema["c"].dataType.typeName() == "array"
        entries.append(F.transform(c if wide else F.array(c), _entry(name)))
    rows = df.select(F.explode(F.concat(*entries)).alias("e"), weight.cast("long").alias("w"))
    return rows.where("e.value is not null").groupBy("e.facet", "e.value").agg(F.sum("w").alias("n"))


def self_excluding(df: DataFrame, filters: dict[str, tuple[Column, Column]], where: Column) -> DataFrame:
    """(facet, value, n): each facet counted under all filters but its own, in one scan.

    filters: facet -> (value, predicate). A row gives an entry to each facet whose other filters it passes.
    """
    entries = []
    for name, (value, _) in filters.items():
        others = reduce(lambda a, b: a & b, (p for other, (_, p) in filters.items() if other != name), F.lit(True))
        entries.append(F.when(F.coalesce(others, F.lit(False)), F.struct(F.lit(name).alias("facet"), value.cast("string").alias("value"))))
    rows = df.where(where).select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
    return rows.where("e.value is not null").groupBy("e.facet", "e.value").agg(F.count(F.lit(1)).alias("n"))


def merge(*facets: DataFrame) -> DataFrame:
    """Counts of several lists added up by grain, facet and value."""
    return reduce(DataFrame.unionByName, facets).groupBy("grain", "facet", "value").agg(F.sum("n").alias("n"))


def by_document(hits: DataFrame, key: str = "doc_id") -> DataFrame:
    return hits.groupBy(key).agg(F.count(F.lit(1)).alias("hits"), F.max("score").alias("best"))


def body_rollup(hits: DataFrame, body: str, key: str) -> DataFrame:
    """Hits by body and document, with subtotals: level 0 a document, 1 a body, 3 all."""
    return hits.rollup(body, key).agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("hits"))


def breakdown(df: DataFrame, kind: str, kinds: list[str]) -> DataFrame:
    """One row: the total and the count of each kind."""
    return df.agg(F.count(F.lit(1)).alias("total"), *(F.sum((F.col(kind) == k).cast("long")).alias(k) for k in kinds))


def sorted_merge(*facets: DataFrame) -> DataFrame:
    """merge() with each value's place in its facet: by count, then by value."""
    place = F.row_number().over(Window.partitionBy("grain", "facet").orderBy(F.desc("n"), "value"))
    return merge(*facets).withColumn("place", place)


def year_merge(*years: DataFrame) -> DataFrame:
    """(year, n) of several histograms added up, with the first and last year of all."""
    rows = reduce(DataFrame.unionByName, years)
    ends = rows.agg(F.min("year").alias("first"), F.max("year").alias("last"))
    return rows.groupBy("year").agg(F.sum("n").alias("n")).join(F.broadcast(ends))


def matching(counts: DataFrame, text: str) -> DataFrame:
    """Facet values that hold what was typed."""
    return counts.where(F.contains(F.lower("value"), F.lit(text.strip().lower())))


def totals(hits: DataFrame, body: str, key: str) -> DataFrame:
    """Per body: hits and documents, with a row for all (null)."""
    return hits.rollup(body).agg(F.count(F.lit(1)).alias("hits"), F.countDistinct(key).alias("documents"))


def cited(refs: DataFrame, signature: str, title: str, position: str) -> DataFrame:
    """Citations of each signature and the title of the first; of several at one place, the least title."""
    first = F.min(F.struct(F.col(position).alias("at"), F.col(title).alias("title")))
    return refs.groupBy(signature).agg(F.count(F.lit(1)).alias("n"), first.alias("f")).select(signature, "n", F.col("f.title").alias("title"))
