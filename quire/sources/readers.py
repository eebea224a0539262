"""Scans: explicit schemas, bad records kept apart, file names as columns."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARAGRAPH = "ID string, Text string, Labels array<string>, Section string, Footnotes array<struct<n:int,text:string>>, _corrupt string"


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df, dealt to all cores if its scan has fewer than half as many splits (one large row group, say); else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def json_paragraphs(spark: SparkSession, path: str, schema: str = PARAGRAPH) -> tuple[DataFrame, DataFrame]:
    """(paragraphs with file and position, files that could not be parsed) of a folder of JSON arrays."""
    raw = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.col("value"))
    fields = schema.replace(", _corrupt string", "")
    parsed = raw.withColumn("rows", F.from_json("value", f"array<struct<{', '.join(re.sub(r' ', ':', f, count=1) for f in _fields(fields))}>>"))
    bad = parsed.where(F.col("rows").isNull()).select("file", F.lit("not a list of paragraphs").alias("reason"))
    good = parsed.where(F.col("rows").isNotNull()).select("file", F.posexplode("rows").alias("pos", "row")).select("file", "pos", "row.*")
    return good, bad


def _fields(schema: str) -> list[str]:
    """Top-level fields of a DDL string."""
    out, depth, word = [], 0, ""
    for c in schema + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(word.strip())
            word = ""
        else:
            word += c
    return out


def preferred_path(spark: SparkSession, paths: list[str]) -> str | None:
    """The first of the paths that exists."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).exists(p):
            return path
    return None


def shards(spark: SparkSession, path: str, by: str, keys: list[str] | None = None) -> DataFrame:
    """Shards that write_shards() wrote: only the folders of these keys are listed and read, in parallel; all without keys."""
    df = spark.read.parquet(path)
    return df if keys is None else df.where(F.col(by).cast("string").isin(*keys))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line; blank lines are dropped."""
    return spark.read.schema(schema).json(path)


def csv_table(spark: SparkSession, path: str, schema: str | None = None, tabs: bool = False) -> DataFrame:
    reader = spark.read.option("header", True).option("sep", "\t" if tabs else ",").option("quote", "" if tabs else '"').option("escape", '"').option("multiLine", not tabs)
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.toDF(*(c.strip().lower() for c in df.columns))


def spreadsheet(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet of a workbook, with trimmed headers; rows need an ID and a Text. One workbook is small, so the driver reads it."""
    import pandas as pd

    frame = pd.read_excel(path, dtype=str).rename(columns=str.strip)
    return paragraph_rows(spark.createDataFrame(frame.astype(object).where(frame.notna(), None)))


def paragraph_rows(df: DataFrame) -> DataFrame:
    return df.where("ID is not null and Text is not null").withColumn("ID", F.coalesce(F.col("ID").try_cast("double").cast("int").cast("string"), F.col("ID")))


class Blocks(HTMLParser):
    """Texts of block elements, in order, without scripts, styles and navigation."""

    SKIP = {"script", "style", "nav", "head", "noscript", "template"}
    BLOCK = {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "blockquote", "div", "article", "section", "pre", "body"}
    HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.now, self.tag, self.skipped = [], [], "", 0

    def flush(self):
        text = " ".join("".join(self.now).split())
        if text:
            self.out.append((self.tag, text))
        self.now = []

    def handle_starttag(self, tag, attrs):
        self.skipped += tag in self.SKIP
        if tag in self.BLOCK:
            self.flush()
            self.tag = tag
        elif tag == "br":
            self.now.append(" ")

    def handle_endtag(self, tag):
        if tag in self.SKIP and self.skipped:
            self.skipped -= 1
        if tag in self.BLOCK:
            self.flush()

    def handle_data(self, data):
        if not self.skipped:
            self.now.append(data)


def html_blocks(page: str | None) -> list[tuple[str, str]]:
    parser = Blocks()
    parser.feed(html.unescape(page) if page and "&amp;lt;" in page else page or "")
    parser.close()
    parser.flush()
    return parser.out


def html_paragraphs(pages: DataFrame, key: str = "page_id", column: str = "html", least: int = 1) -> DataFrame:
    """key, idx, text and is_heading of each block of a page; blocks under `least` characters go."""
    kind = dict(pages.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for k, page in zip(batch[key].to_pylist(), batch[column].to_pylist(), strict=True):
                for i, (tag, text) in enumerate((t for t in html_blocks(page) if len(t[1]) >= least), 1):
                    for c, v in zip(cols, (k, i, text, tag in Blocks.HEADING), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch[key].type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.bool_())], names=[key, "idx", "text", "is_heading"])

    return pages.select(key, column).mapInArrow(run, f"`{key}` {kind}, idx int, text string, is_heading boolean")


def decoded(content: bytes, encodings: tuple[str, ...] = ("utf-8-sig", "cp1252", "latin-1")) -> str:
    """Text of bytes by the first encoding that fits."""
    for e in encodings:
        try:
            return content.decode(e)
        except UnicodeDecodeError:
            continue
    return content.decode("utf-8", errors="replace")
