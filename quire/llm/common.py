"""What the training-data operators share: stored intermediates and distributed ranks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows that one (key, bucket) group of a distributed rank holds on average at most.
ROWS_PER_BUCKET = 10_000


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share. Unset, a local one on a local master; elsewhere an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is unset: intermediates need a folder that all executors share")
    return path or "/tmp/quire-checkpoints"


def stored(df: DataFrame) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: it cuts the lineage and outlives lost executors.

    What forget() hasn't deleted goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/quire-{uuid.uuid4().hex}"
    files, p = _folder(spark, path)
    files.deleteOnExit(p)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quire_path = path
    return out


def _folder(spark: SparkSession, path: str) -> tuple:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def forget(df: DataFrame) -> None:
    """Delete what stored() wrote, once nothing reads it any more."""
    path = getattr(df, "_quire_path", None)
    if path:
        files, p = _folder(df.sparkSession, path)
        files.delete(p, True)


def shielded(docs: DataFrame, own: list[str]) -> tuple[DataFrame, list[str]]:
    """docs with every column but those in `own` renamed to _x0, _x1, ..., and the names that it had, for toDF().

    No operator gives an inner column such a name, so extra columns may be called what they like.
    """
    return docs.toDF(*(c if c in own and c not in docs.columns[:i] else f"_x{i}" for i, c in enumerate(docs.columns))), docs.columns


def sliced(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `most` bytes of a binary column (a longer value alone), which bounds a task's memory."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def buckets_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_BUCKET))


def bucket_counts(df: DataFrame, keys: list[str], bucket: str = "bucket") -> DataFrame:
    """(keys, bucket, n): partial counts on the map side, so a hot key costs one row a task and bucket."""
    return df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("n"))


def with_rank(df: DataFrame, counts: DataFrame, keys: list[str], order: list[str], bucket: str = "bucket", rank: str = "rank") -> DataFrame:
    """df with each row's rank (from 0) among the rows of its keys, ordered by bucket, then order.

    A key's rows are numbered bucket by bucket: the window over one bucket is bounded by ROWS_PER_BUCKET
    on average, and the buckets before it count by a running sum over `counts`, which is small. So a key
    with a third of all rows is spread over a third of all (key, bucket) groups.
    """
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*keys, bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    ranked = df.withColumn("_inside", F.row_number().over(inside) - 1)
    return ranked.join(base, [*keys, bucket]).withColumn(rank, F.col("_base") + F.col("_inside")).drop("_base", "_inside")


def schema_of(docs: DataFrame, keep: list[str], more: str) -> StructType:
    """The fields of the columns in keep, whatever their kinds, and those of a DDL string."""
    return StructType([*docs.select(*keep).schema.fields, *StructType.fromDDL(more).fields])
