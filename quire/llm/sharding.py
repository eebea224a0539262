"""Sharding: a consistent-hash ring with virtual nodes and bounded loads.

A document's key hash falls on an arc of the ring; the arc's virtual node names its home shard. A shard
has a fixed capacity. Keys beyond it continue clockwise to the next virtual node whose shard has room,
so balance is guaranteed and only the overflow leaves home. The driver plans this over the counts of
the arcs (shards x virtual nodes, a parameter's size); the documents take their places by their rank
within their arc.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import bucket_counts, buckets_for, stored, with_rank

VIRTUAL_NODES = 64
#: Positions on the ring.
CIRCLE = 1 << 32


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> tuple[np.ndarray, np.ndarray]:
    """Sorted positions of the virtual nodes and their shards. More shards only add positions."""
    nodes = sorted((xxhash.xxh64_intdigest(f"{s}:{v}", 42) % CIRCLE, s) for s in range(shards) for v in range(virtual_nodes))
    return np.array([p for p, _ in nodes]), np.array([s for _, s in nodes])


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows that each shard may hold. Without slack they add up to all rows and differ by one at most."""
    if slack:
        return [int(np.ceil(rows * (1 + slack) / shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def bounded_loads(counts: dict[int, int], owners: np.ndarray, room: list[int]) -> list[tuple[int, int, int, int]]:
    """(arc, first rank, shard, first slot) for runs of ranks, sorted: home shards first, then clockwise.

    Each shard first serves its own arcs, in ring order; what it can't hold goes on to the next virtual
    nodes. The lists are as long as the arcs and shards at most, whatever the number of documents.
    """
    room, used, runs, over = list(room), [0] * len(room), [], []

    def serve(arc: int, first: int, wanted: int, shard: int) -> int:
        taken = min(wanted, room[shard])
        if taken:
            runs.append((arc, first, shard, used[shard]))
            room[shard] -= taken
            used[shard] += taken
        return taken

    for arc in sorted(counts):
        taken = serve(arc, 0, counts[arc], owners[arc])
        if taken < counts[arc]:
            over.append((arc, taken, counts[arc] - taken))
    for arc, first, wanted in over:
        at = arc
        while wanted:
            at = (at + 1) % len(owners)
            taken = serve(arc, first, wanted, owners[at])
            first, wanted = first + taken, wanted - taken
    return sorted(runs)


def shard(docs: DataFrame, shards: int, size: Column, extra: dict[str, Column] | None = None, slack: float = 0.0, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """doc_id, size, the extra columns, shard and slot (gapless from 0 in each shard) of every row.

    With slack 0, shards differ by one row at most; with more, no shard exceeds (1 + slack) x the mean
    and fewer keys leave home. A null doc_id is a key like any other; rows that repeat a key sit on one
    arc and overflow from it. An empty table gives no rows. Columns beside doc_id and those in `size`
    and `extra` are not read.
    """
    extra = extra or {}
    positions, owners = ring(shards, virtual_nodes)

    @F.pandas_udf("int")
    def arc_of(hashes: pd.Series) -> pd.Series:
        at = np.searchsorted(positions, hashes.to_numpy(), side="left") % len(positions)
        return pd.Series(at.astype(np.int32))

    key = F.shiftrightunsigned(F.xxhash64("doc_id"), 32)
    rows = stored(docs.select("doc_id", size.alias("size"), *(c.alias(n) for n, c in extra.items()), key.alias("_key")).withColumn("_arc", arc_of("_key")))
    n = rows.count()
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", *extra), F.lit(buckets_for(n))).cast("int"))
    counts = bucket_counts(rows, ["_arc"])
    arcs = {r["_arc"]: r["n"] for r in counts.groupBy("_arc").agg(F.sum("n").alias("n")).collect()}
    runs = bounded_loads(arcs, owners, capacities(n, shards, slack))
    step = n + 1
    starts = np.array([a * step + f for a, f, _, _ in runs], dtype=np.int64)
    first, to, slot = (np.array([r[i] for r in runs], dtype=np.int64) for i in (1, 2, 3))
    names = ["doc_id", "size", *extra]
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.select(*names).dtypes) + ", shard int, slot long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arc, rank = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_arc", "rank"))
            at = np.searchsorted(starts, arc * step + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(to[at].astype(np.int32)), pa.array(slot[at] + rank - first[at])], names=[*names, "shard", "slot"])

    return with_rank(rows, counts, ["_arc"], ["_key", "doc_id", "size", *extra]).mapInArrow(place, schema)


