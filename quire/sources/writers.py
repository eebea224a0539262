"""Sinks: Parquet, JSON, shards, manifests and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import escape_csv, short_digest


def write_json(df: DataFrame, path: str, files: int | None = None) -> None:
    (df.coalesce(files) if files else df).write.mode("overwrite").option("ignoreNullFields", True).json(path)


def write_shards(df: DataFrame, path: str, by: list[str]) -> None:
    """A folder a shard; shards of an earlier run that are not in df go, as the whole path is replaced."""
    df.repartition(*by).write.mode("overwrite").partitionBy(*by).parquet(path)


def write_back(df: DataFrame, path: str, by: str) -> None:
    """Replaces only the folders of the keys that df holds."""
    df.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


BOM = "\ufeff"


def csv_file(df: DataFrame, order: list[str]) -> DataFrame:
    """One text: a byte order mark, the header and a line a row, each ended by CRLF. An export is one user's result, of a bounded number of rows."""
    line = F.struct(*order, csv_lines(df).alias("line"))
    rows = F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"])
    return df.agg(F.concat(F.lit(BOM), F.array_join(F.concat(F.array(F.lit(",".join(df.columns))), rows), "\r\n"), F.lit("\r\n")).alias("text"))


def write_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """csv_file() as one file: mark, header, quotes doubled, CRLF."""
    csv_file(df, order).coalesce(1).write.mode("overwrite").option("lineSep", "\x00").text(path)


def json_file(df: DataFrame, order: list[str], **envelope: str) -> DataFrame:
    """One JSON text: the envelope's fields, the number of rows and the rows in order. As bounded as csv_file()."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.struct(*df.columns).alias("row"))))
    head = [F.lit(v).alias(k) for k, v in envelope.items()]
    return df.agg(F.to_json(F.struct(*head, F.count(F.lit(1)).alias("total"), F.transform(rows, lambda x: x["row"]).alias("rows"))).alias("json"))


def cached(df: DataFrame, path: str, key: str) -> DataFrame:
    """df as a table kept under path and its key (a corpus digest, say): read if it is there, else written first. Other keys go."""
    spark, full = df.sparkSession, f"{path.rstrip('/')}/key={key}"
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{full}/_SUCCESS")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        df.withColumn("key", F.lit(key)).write.mode("overwrite").partitionBy("key").parquet(path)
        df.limit(0).write.mode("append").parquet(full)
    return spark.read.schema(df.schema).parquet(full)


def append_checked(df: DataFrame, path: str, key: str) -> int:
    """Appends rows whose key the table doesn't hold; the number of new rows. A key that is null or repeated in df is refused."""
    spark = df.sparkSession
    bad = df.groupBy(key).count().where(f"count > 1 or {key} is null").limit(1).collect()
    if bad:
        raise ValueError(f"{key} {bad[0][key]} is not unique")
    fresh = df.join(spark.read.parquet(path).select(key), key, "left_anti").persist()
    n = fresh.count()
    fresh.write.mode("append").parquet(path)
    fresh.unpersist()
    return n


#: Hex digits that name a bucket of a manifest: 16 ** DIGITS buckets.
DIGITS = 3


def manifest(df: DataFrame, group: str, row: Column, order: list[str]) -> DataFrame:
    """group, n, bytes and digest: rows are hashed, then each bucket of them (by the first digits of their hashes) in
    order, then the buckets, so a group with a third of all rows is spread over 16 ** DIGITS groups."""
    lines = df.select(group, *order, F.octet_length(row).alias("size"), short_digest(row).alias("d")).withColumn("bucket", F.substring("d", 1, DIGITS))
    parts = lines.groupBy(group, "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("size").cast("long").alias("bytes"), short_digest(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "d"))), lambda x: x["d"]), "")).alias("ds"))
    agg = parts.groupBy(group).agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "ds"))), lambda x: x["ds"]), "").alias("ds"))
    return agg.select(group, "n", "bytes", short_digest(F.col("ds")).alias("digest"))


def csv_lines(df: DataFrame) -> Column:
    """One RFC 4180 line a row; nulls are empty."""
    return F.concat_ws(",", *(F.coalesce(escape_csv(F.col(c).cast("string")), F.lit("")) for c in df.columns))


def bibtex(df: DataFrame, doc: str, title: Column, year: Column, number: Column) -> DataFrame:
    """One entry a document, with its paragraph numbers in order."""
    per = df.groupBy(doc, title.alias("title"), year.alias("year")).agg(F.array_join(F.transform(F.array_sort(F.collect_set(number)), lambda x: x.cast("string")), ", ").alias("paras"))
    return per.select(doc, F.format_string("@misc{d%s, title={%s}, year={%s}, note={paras. %s}}", F.col(doc).cast("string"), "title", F.col("year").cast("string"), "paras").alias("entry"))


def workspace(items: DataFrame, kind: str) -> DataFrame:
    """One text of a workspace's items(id, title, text, note) in order of id, as md, tex or json. A workspace is a user's own list."""
    from quire.functions.text import escape_tex

    note = F.coalesce(F.col("note"), F.lit(""))
    if kind == "json":
        line = F.to_json(F.struct("id", "title", "text", "note"))
    elif kind == "tex":
        line = F.concat(F.lit("\\item "), escape_tex(F.col("title")), F.lit(": "), escape_tex(F.col("text")), F.when(note != "", F.concat(F.lit(" \\emph{"), escape_tex(note), F.lit("}"))).otherwise(""))
    else:
        line = F.concat(F.lit("- **"), F.col("title"), F.lit("** "), F.col("text"), F.when(note != "", F.concat(F.lit("\n  > "), note)).otherwise(""))
    rows = F.array_sort(F.collect_list(F.struct("id", line.alias("line"))))
    return items.agg(F.array_join(F.transform(rows, lambda x: x["line"]), "\n").alias("text"))


def write_spreadsheet(df: DataFrame, path: str, most: int = 1_000_000) -> None:
    """A result as a workbook, by the driver: a sheet has an upper limit of rows, beyond which this refuses."""
    rows = df.limit(most + 1).toPandas()
    if len(rows) > most:
        raise ValueError(f"over {most} rows do not fit in a sheet")
    rows.to_excel(path, index=False)
