"""Page blocks (as any PDF library gives them) to numbered paragraphs: filters, a mode and a state per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.sequences import carried


def body_blocks(blocks: DataFrame, top: float, bottom: float, indent: float) -> DataFrame:
    """blocks(doc, page, x, y, text) within the page's band, at most `indent` left of or right of the document's most frequent x."""
    kept = blocks.where(F.col("y").between(top, bottom))
    usual = kept.groupBy("doc").agg(F.mode("x", True).alias("usual"))
    return kept.join(usual, "doc").where(F.abs(F.col("x") - F.col("usual")) <= indent).drop("usual")


def numbered(lines: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """keys, n and text: lines joined under the number (`12.` or `12.3`) that the last numbered line began with."""
    marker = F.regexp_extract(F.col(text), r"^\s*(\d{1,3}(?:\.\d{1,3})?)[.)]?\s+\S", 1)
    rows = carried(lines, keys, order, F.nullif(marker, F.lit("")), "n").where(F.col("n").isNotNull())
    body = F.trim(F.regexp_replace(F.col(text), r"^\s*\d{1,3}(?:\.\d{1,3})?[.)]?\s+(?=\S)", ""))
    part = F.struct(F.col(order).alias("o"), F.when(marker != "", body).otherwise(F.trim(F.col(text))).alias("t"))
    joined = rows.groupBy(*keys, "n").agg(F.array_sort(F.collect_list(part)).alias("l"))
    return joined.select(*keys, "n", F.array_join(F.transform("l", lambda x: x["t"]), " ").alias("text"))


def is_heading(text: Column) -> Column:
    """A short line without a final stop that is all capitals, or begins with a Roman numeral or a letter and a stop."""
    short = (F.length(F.trim(text)) <= 120) & ~F.trim(text).rlike(r"[.;:,]$")
    return short & (F.trim(text).rlike(r"^[IVXLC]{1,7}\.\s+\S") | F.trim(text).rlike(r"^[A-Z]\.\s+\S") | ((F.upper(text) == text) & text.rlike("[A-Z]{3}")))


def is_signature(text: Column) -> Column:
    return F.trim(text).rlike(r"(?i)^\(?\s*(signed|done at|adopted in)\b") | F.trim(text).rlike(r"^_{3,}$")


def first_result(candidates: dict[str, Column]) -> tuple[Column, Column]:
    """(text, method) of the first candidate that isn't null or empty, in order."""
    text, method = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, c in reversed(candidates.items()):
        some = F.coalesce(F.length(F.trim(c)) > 0, F.lit(False))
        text, method = F.when(some, c).otherwise(text), F.when(some, F.lit(name)).otherwise(method)
    return text, method
