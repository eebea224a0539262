"""Selection and aggregation over OCR candidates; recognition itself is an external tool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def candidate_score(confidence: Column, low_ratio: Column, chars: Column, violations: Column) -> Column:
    """Confidence, less low-confidence words and order violations, plus up to 9 for length."""
    return confidence - 20 * low_ratio + F.least(F.log1p(chars), F.lit(9.0)) - 15 * violations


def best_candidate(candidates: DataFrame, page: list[str], score: str, name: str) -> DataFrame:
    """The candidate with the best score of each page, then the first name: a partial aggregate."""
    best = candidates.groupBy(*page).agg(F.min_by(F.struct(name, score), F.struct(-F.col(score), F.col(name))).alias("b"))
    return best.select(*page, "b.*")


def status(score: Column, good: float, fair: float) -> Column:
    return F.when(score >= good, "pass").when(score >= fair, "review").otherwise("fail")


def weighted_quality(pages: DataFrame, keys: list[str], confidence: Column, low: Column, words: Column) -> DataFrame:
    """Mean confidence and share of low confidence, weighted by words (1 at least)."""
    w = F.greatest(words, F.lit(1))
    return pages.groupBy(*keys).agg((F.sum(confidence * w) / F.sum(w)).alias("conf"), (F.sum(low.cast("int") * w) / F.sum(w)).alias("low"))


def assemble(words: DataFrame, keys: list[str], order: str, word: Column, out: str) -> DataFrame:
    """The words of a line in order, with spaces."""
    lines = words.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), word.alias("w")))).alias("l"))
    return lines.select(*keys, F.array_join(F.transform("l", lambda x: x["w"]), " ").alias(out))


def warnings(confidence: Column, chars: Column, violations: Column) -> Column:
    found = [(confidence < 60, "low confidence"), (chars < 50, "little text"), (violations > 0, "numbers out of order")]
    return F.array_compact(F.array(*(F.when(c, F.lit(w)) for c, w in found)))


def audit(pages: DataFrame, status: str, confidence: Column) -> DataFrame:
    """Pages and mean confidence of each status."""
    return pages.groupBy(status).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(confidence), 2).alias("conf"))


def review_list(pages: DataFrame, status: str, order: list[str]) -> DataFrame:
    """What a person should look at, in order."""
    return pages.where(F.col(status) == "review").select(*order).orderBy(*order)
