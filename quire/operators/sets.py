"""Set operations over ids, vocabularies and versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import split_list


def new_rows(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not known."""
    return rows.join(known, key, "left_anti")


def last_wins(rows: DataFrame, keys: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """One row a key, the last by order: a max over a struct, summed on the map side."""
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("b"))
    return best.select(*keys, "b.*")


def vocabulary(df: DataFrame, text: Column, separator: str, out: str) -> DataFrame:
    """Distinct trimmed parts of a delimited column."""
    return df.select(F.explode(split_list(text, separator)).alias(out)).distinct()


def id_union(*ids: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, ids).distinct()


def stop_words(spark, *lists: list[str]) -> DataFrame:
    """word: the union of several stop lists, folded to lower case."""
    return spark.createDataFrame([(w,) for words in lists for w in words], "word string").select(F.lower(F.trim("word")).alias("word")).where("word <> ''").distinct()
