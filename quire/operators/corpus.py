"""The corpus model: documents to numbered paragraphs, ids, facets, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import short_digest, slugify


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None, preamble: bool = False) -> DataFrame:
    """key, idx, body and the kept columns: a row for each line that isn't blank, numbered from 1 without gaps; with preamble, the first line too.

    A generator over the split text: no shuffle and no window, whatever the length of a document.
    """
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.trim(x) != "")
    first = [F.get(lines, 0).alias("preamble")] if preamble else []
    rows = docs.select(key, *(keep or []), *first, F.posexplode(lines).alias("pos", "body"))
    return rows.select(key, (F.col("pos") + 1).alias("idx"), *(keep or []), *(["preamble"] if preamble else []), "body")


def without_repeated_preamble(paras: DataFrame) -> DataFrame:
    """Paragraphs but those that repeat their document's first; within the row, so nothing is joined or shuffled."""
    return paras.where((F.col("idx") == 1) | (F.col("body") != F.col("preamble")))


def hide_preambles(paras: DataFrame, hidden: bool) -> DataFrame:
    """Without preambles if they are toggled off."""
    return paras.where(F.col("idx") > 1) if hidden else paras


def is_noise(text: Column, least: int = 40) -> Column:
    """Page headers, bare numbers, month and year crumbs, and lines under `least` characters."""
    return F.trim(text).rlike("^(Page [0-9]+|[0-9]+|[A-Za-z]+ [0-9]{4})$") | (F.length(text) < least)


def date_key(text: Column, year: Column) -> Column:
    """The parsed date, else the first of January of the year, else the epoch."""
    return F.coalesce(F.try_to_date(text, "d MMMM yyyy"), F.make_date(year, F.lit(1), F.lit(1)), F.lit("1970-01-01").cast("date"))


def footnote_stats(paras: DataFrame, keys: list[str], notes: Column) -> DataFrame:
    """Paragraphs, those with footnotes, and footnotes."""
    n = F.coalesce(F.size(notes), F.lit(0))
    return paras.groupBy(*keys).agg(F.count(F.lit(1)).alias("paragraphs"), F.sum((n > 0).cast("long")).alias("with_notes"), F.sum(n.cast("long")).alias("notes"))


def paragraph_id(key: Column, idx: Column) -> Column:
    return F.format_string("%s-%04d", key.cast("string"), idx)


def document_ids(files: DataFrame, signature: str, stem: str, out: str = "docId") -> DataFrame:
    """Slug of the signature where it is unique, else of the file's stem; a digest is added where slugs still collide."""
    by_sig = Window.partitionBy(signature)
    slug = F.when((F.count(F.lit(1)).over(by_sig) == 1) & (F.coalesce(F.col(signature), F.lit("")) != ""), slugify(F.col(signature))).otherwise(slugify(F.col(stem)))
    ids = files.withColumn("_slug", slug)
    clash = F.row_number().over(Window.partitionBy("_slug").orderBy(stem)) > 1
    return ids.withColumn(out, F.when(clash, F.concat_ws("-", "_slug", F.substring(F.sha1(F.col(stem)), 1, 6))).otherwise(F.col("_slug"))).drop("_slug")


def compact(df: DataFrame) -> DataFrame:
    """Empty texts and arrays as null, so that sinks leave them out."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        out.append((F.nullif(c, F.lit("")) if kind == "string" else F.when(F.size(c) > 0, c) if kind.startswith("array") else c).alias(name))
    return df.select(*out)


def document_rollup(paras: DataFrame, key: str, body: Column, labels: Column) -> DataFrame:
    """Paragraphs, words, labels and labelled paragraphs of each document."""
    words = F.regexp_count(body, F.lit(r"[^\s]+"))
    return paras.groupBy(key).agg(F.count(F.lit(1)).alias("n_paragraphs"), F.sum(words).cast("long").alias("n_words"), F.sum(F.size(labels)).cast("long").alias("n_labels"), F.sum((F.size(labels) > 0).cast("long")).alias("n_labelled"))


def manifest_row(docs: DataFrame, paras: DataFrame, kind: str) -> DataFrame:
    """One row of counts: documents, paragraphs and those of each kind as a map, and how many kinds and sources there are."""
    kinds = paras.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))
    by = kinds.agg(F.sum("n").cast("long").alias("paragraphs"), F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(kind, "n"))))).alias("by_kind"))
    return docs.agg(F.count(F.lit(1)).alias("documents"), F.countDistinct(kind).alias("kinds"), F.countDistinct("source").alias("sources"), F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest"), short_digest(F.max(F.col("doc_id").cast("string"))).alias("sha")).join(F.broadcast(by))
