"""What the query modules share: the registry, the paragraph view and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import fold
from quire.operators.corpus import paragraphs
from quire.sources.readers import spread, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: paras: the paragraph view; p.folded is what searches read.
PARAS = """paras AS (
  SELECT doc_id, lang, source, unnest(range(1, len(l) + 1))::INTEGER AS idx, unnest(l) AS body
  FROM (SELECT doc_id, lang, source, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS l FROM documents)),
folded AS (SELECT *, strip_accents(lower(body)) AS folded FROM paras)"""


def query(sql: str | None = None, paras: bool = False):
    """Registers a query under its function's name, with its SQL; paras puts the paragraph view before it."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = (f"WITH {PARAS}" + ("" if sql.lstrip().startswith(",") else "\n") + sql) if paras else sql
        return f

    return register


def paras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs(spread(tables(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")), keep=["lang", "source"])


def folded_paras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paras(spark, sf_dir).withColumn("folded", fold(F.col("body")))
