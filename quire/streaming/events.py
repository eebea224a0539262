"""Event operators, as batch queries and as Structured Streaming (an extension: the corpus model has no streams)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def quiet(events: DataFrame, keys: list[str], seconds: int) -> DataFrame:
    """Events with none of the same keys within so many seconds before."""
    w = Window.partitionBy(*keys).orderBy("ts", "event_id")
    before = F.lag("ts").over(w)
    return events.withColumn("_p", before).where(F.col("_p").isNull() | (F.col("ts") > F.col("_p") + F.expr(f"INTERVAL {seconds} SECONDS"))).drop("_p")


def sessions(events: DataFrame, key: str, gap: str) -> DataFrame:
    """key, start, last and n of runs of events with less than gap between them."""
    s = events.groupBy(key, F.session_window("ts", gap).alias("w")).agg(F.min("ts").alias("start"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"))
    return s.select(key, "start", "last", "n")


def tumbling(events: DataFrame, size: str) -> DataFrame:
    w = events.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select(F.col("w.start").alias("day"), "event_type", "n", "total")


def stream(spark: SparkSession, path: str, late: str = "2 days") -> DataFrame:
    """Events of a folder of Parquet files as they come, with a watermark."""
    raw = spark.readStream.schema(SCHEMA).parquet(path)
    return raw.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def deduplicated(events: DataFrame, keys: list[str]) -> DataFrame:
    """Each key once within the watermark; state older than that is dropped."""
    return events.dropDuplicatesWithinWatermark(keys)


def streamed_tumbling(spark: SparkSession, sf_dir: str, size: str = "1 day") -> DataFrame:
    """tumbling() by an incremental query that reads what there is and stops; its result is a table in memory."""
    name = f"tumbling_{uuid.uuid4().hex}"
    counted = stream(spark, f"{sf_dir}/events.parquet*").groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    query = counted.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name).select(F.col("w.start").cast("timestamp_ntz").alias("day"), "event_type", "n", "total")


def collapse_recent(queries: list[tuple[float, str]], keep: int = 12, pause: float = 2.0) -> list[str]:
    """The latest `keep` queries: those typed within `pause` seconds of the next, or that the next begins with, go."""
    out: list[str] = []
    for i, (at, text) in enumerate(queries):
        if i + 1 < len(queries) and queries[i + 1][0] - at < pause:
            continue
        text = text.strip()
        if len(text) < 2:
            continue
        out = [q for q in out if q != text and not text.startswith(q)]
        out.append(text)
    return out[::-1][:keep]


def recent(events: DataFrame, key: str, at: str, text: str, keep: int = 12) -> DataFrame:
    """key, place and query of collapse_recent() over each key's rows (one user's typing)."""
    kind = dict(events.dtypes)[key]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(at)
        latest = collapse_recent(list(zip(group[at], group[text], strict=True)), keep)
        return pd.DataFrame({key: [group[key].iloc[0]] * len(latest), "place": range(1, len(latest) + 1), "query": latest})

    return events.select(key, at, text).groupBy(key).applyInPandas(run, f"{key} {kind}, place int, query string")


def recent_stream(events: DataFrame, key: str, text: str, keep: int = 12) -> DataFrame:
    """recent() with state: each user's latest queries are kept between batches."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def update(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out = list(state.get[0]) if state.exists else []
        for group in batches:
            for q in group.sort_values("ts")[text]:
                q = q.strip()
                if len(q) > 1:
                    out = [x for x in out if x != q and not q.startswith(x)] + [q]
        out = out[-keep:]
        state.update((out,))
        yield pd.DataFrame({key: [k[0]], "queries": [out[::-1]]})

    kind = dict(events.dtypes)[key]
    return events.groupBy(key).applyInPandasWithState(update, f"{key} {kind}, queries array<string>", "queries array<string>", "update", GroupStateTimeout.NoTimeout)
