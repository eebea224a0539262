"""SimHash near-dedup: vantage-point trees over fingerprints, and the components of their links.

Distances between unrelated 64-bit fingerprints crowd around 32, so triangle bounds on all 64 bits cut
little (README). The bits are therefore dealt into blocks. Hamming distance within a block is a metric
too, and two fingerprints at distance R or less are, in at least one block, no farther apart than that
block's radius, if the radii plus one add up to R + 1. Each block has a vantage-point tree: a node
splits by the distance to its vantage point, and a triangle bound sends a query into one child or, near
the boundary, into both. The leaves are shards. A shard compares its own fingerprints with each other
and with those that visit it from across a boundary, on all 64 bits, and reports links as a forest.

near_groups() links 64-bit fingerprints at 4 bits, exactly. one_each() finds near copies by similarity:
at a Jaccard similarity of 0.8, about 10 of 64 bits differ, far too many for the pigeonhole, so it takes
WIDE_WORDS x 64 bits of distinct five-word shingles and WIDE_BLOCKS trees, of which one block suffices to
agree. Links found so are confirmed on the shingles themselves and join up most families cheaply. They
decide nothing alone: of two texts at the similarity, the rarest shingles of each have one in common
(rarest()), so all that share one and aren't joined yet are compared too (rest()), and no pair is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import buckets_for, forget, schema_of, shielded, stored

SHINGLE, SEED, RADIUS, BLOCKS = 4, 42, 4, 4
#: Fingerprints that the driver draws to place vantage points, at most.
SAMPLE = 1 << 16
#: Fingerprints of its own that a shard is planned for, and the most that one task compares at once.
SHARD_ROWS, TASK_ROWS = 2048, 32_768
#: The wide fingerprint of near copies: words of a shingle, 64-bit words, blocks and their bits.
WIDE_SHINGLE, WIDE_WORDS, WIDE_BLOCKS, WIDE_BITS = 5, 8, 32, 12
SIMILARITY = 0.8
#: Fingerprints that a shard of a wide block is planned for: it sorts them by the block and compares only equals.
WIDE_SHARD_ROWS = 8192
#: Rows of one component that a task confirms at once, and bytes of their shingles' hashes.
CONFIRM_ROWS, CONFIRM_BYTES = 1024, 1 << 27
#: Distances that one task holds at once.
CELLS = 1 << 20
#: Shingles whose bits are counted at once.
PIECE = 1 << 14
#: Shingles known to be common, at most, and the texts that they are counted in.
COMMON, COMMON_TEXTS = 1 << 16, 1 << 13
#: 64-bit words of a text's parities: bit i tells whether an odd number of its shingles has hash i.
PARITY_WORDS = 16
#: Rare shingles that a bucket is planned for.
BUCKET_SHINGLES = 1 << 19


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is 1 if it is 1 in over half of the XXH64 of all word shingles; 0 for a text without words."""
    words = text.lower().split()  # of bytes: only A-Z change, and only ASCII white space splits
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        return xxhash.xxh64_intdigest(line, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    digest = xxhash.xxh64_digest
    stops = (ends[shingle - 1 :] - 1).tolist()
    starts = [0, *ends[: n - 1].tolist()]
    hashes = np.frombuffer(b"".join([digest(line[a:b], seed) for a, b in zip(starts, stops, strict=True)]), np.uint8).reshape(n, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, PIECE):
        ones += np.unpackbits(hashes[at : at + PIECE], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = SHINGLE, seed: int = SEED, name: str = "fp") -> DataFrame:
    """The columns in keep and `name` (the fingerprint's bits as a signed long) of every whole text; null is empty."""
    schema = "".join(f"`{c}` {t}, " for c, t in docs.select(*keep).dtypes) + f"{name} long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(x.as_buffer().to_pybytes(), shingle, seed) if x.is_valid else 0 for x in batch["_text"]]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(np.array(fps, np.uint64).view(np.int64))], names=[*keep, name])

    return docs.select(*keep, F.col("text").cast("binary").alias("_text")).mapInArrow(run, schema)


def radii(radius: int, blocks: int) -> list[int]:
    """Radii whose successors add up to radius + 1: the pigeonhole leaves no pair at that distance out."""
    left = radius + 1 - blocks
    if left < 0:
        raise ValueError("more blocks than differing bits and one")
    return [left // blocks + (b >= blocks - left % blocks) for b in range(blocks)]


def masks(blocks: int) -> list[int]:
    """Every blocks-th bit, so that a block doesn't depend on where in the word a difference falls."""
    return [sum(1 << i for i in range(b, 64, blocks)) for b in range(blocks)]


def grow(sample: np.ndarray, mask: int, depth: int, rng: np.random.Generator) -> tuple | None:
    """A tree over the masked distance: (vantage point, boundary, inner tree, outer tree); None is a leaf.

    The boundary is the distance that parts the sample most evenly; where the sample is all at one
    distance, no split helps and the node is a leaf.
    """
    if depth == 0 or len(sample) < 2:
        return None
    vantage = sample[rng.integers(len(sample))]
    d = np.bitwise_count((sample ^ vantage) & np.uint64(mask))
    inside = np.cumsum(np.bincount(d))
    boundary = int(np.argmin(np.abs(2 * inside - len(sample))))
    if inside[boundary] == len(sample):
        return None
    inner = d <= boundary
    return int(vantage), boundary, grow(sample[inner], mask, depth - 1, rng), grow(sample[~inner], mask, depth - 1, rng)


def visits(tree: tuple | None, mask: int, radius: int, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, home): every leaf that may hold a fingerprint within radius of the row's; home is the leaf that holds it."""
    rows, leaves, homes = [], [], []
    todo = [(tree, np.arange(len(fps)), np.ones(len(fps), bool))]
    leaf = 0
    while todo:
        node, at, home = todo.pop()
        if node is None:
            rows.append(at)
            leaves.append(np.full(len(at), leaf, np.int32))
            homes.append(home)
            leaf += 1
            continue
        vantage, boundary, inner, outer = node
        d = np.bitwise_count((fps[at] ^ np.uint64(vantage)) & np.uint64(mask)).astype(np.int16)
        near, far = d - radius <= boundary, d + radius > boundary
        todo.append((outer, at[far], home[far] & (d[far] > boundary)))
        todo.append((inner, at[near], home[near] & (d[near] <= boundary)))
    return np.concatenate(rows), np.concatenate(leaves), np.concatenate(homes)


def join_up(label: np.ndarray, a: np.ndarray, b: np.ndarray, block: np.ndarray) -> None:
    """Brings the labels of linked pairs (block[a], b) to the smaller one."""
    a = block[a]
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label[:] = label[label]


def forest(fps: np.ndarray, home: np.ndarray, radius: int, cells: int = CELLS) -> np.ndarray:
    """For each fingerprint, the index of the first one that it reaches by links of which one end is at home.

    At most `cells` distances are held at once; in a dense family, pairs already joined are left out
    before their places are listed.
    """
    n = len(fps)
    label = np.arange(n, dtype=np.int32)
    own = np.flatnonzero(home)
    rows = max(1, cells // max(1, n))
    for at in range(0, len(own), rows):
        block = own[at : at + rows]
        near = np.bitwise_count(fps[block][:, None] ^ fps[None, :]) <= radius
        if np.count_nonzero(near) > 4 * len(block):
            near &= label[block][:, None] != label[None, :]
        join_up(label, *np.nonzero(near), block)
    return label


def in_parts(rows: DataFrame, keys: list[str], task_rows: int, size: Column | None = None, task_size: int = 1) -> DataFrame:
    """rows with the task (i, j) of each: (0, 0), or in a group of over task_rows (or whose sizes add up to over
    task_size), its part with each part."""
    tasks = F.greatest(F.count(F.lit(1)) / task_rows, F.sum(F.lit(0) if size is None else size) / task_size)
    sizes = rows.groupBy(*keys).agg(tasks.alias("n")).where(F.col("n") > 1)
    many = stored(sizes.select(*keys, F.ceil(2 * F.col("n")).cast("int").alias("parts")))
    if many.isEmpty():
        forget(many)
        return rows.withColumn("i", F.lit(0)).withColumn("j", F.lit(0))
    parts = F.coalesce("parts", F.lit(1))
    rows = rows.join(many, keys, "left").withColumn("own", F.pmod(F.xxhash64("fp"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("parts", "own", "other")


def links(nodes: DataFrame, rows: int, radius: int = RADIUS, blocks: int = BLOCKS, shard_rows: int = SHARD_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """(a, b): links that join up all of nodes' distinct fp at distance radius or less, as each shard's forest.

    A shard that holds more than task_rows (one family of near copies may fill it) is dealt into parts,
    and its tasks compare each part with itself and each other part, so none holds more and none is left out.
    """
    share = min(1.0, 0.8 * SAMPLE / max(1, rows))
    drawn = [r["fp"] for r in nodes.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))).select("fp").limit(SAMPLE).collect()]
    sample = np.sort(np.array(drawn, np.int64)).view(np.uint64)
    depth = max(0, min(math.ceil(math.log2(max(1, rows) / shard_rows)), int(math.log2(max(1, len(sample)))) - 3))
    trees = [(t, m, r) for t, (m, r) in enumerate(zip(masks(blocks), radii(radius, blocks), strict=True))]
    grown = [grow(sample, m, depth, np.random.default_rng(t)) for t, m, _ in trees]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            for (t, m, r), tree in zip(trees, grown, strict=True):
                at, leaf, home = visits(tree, m, r, fps)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t, np.int32)), pa.array(leaf), pa.array(fps[at].view(np.int64)), pa.array(home)], names=["tree", "leaf", "fp", "home"])

    visited = nodes.select("fp").mapInArrow(assign, "tree int, leaf int, fp long, home boolean")
    visited = in_parts(visited, ["tree", "leaf"], task_rows)

    def compare(shard: pa.Table) -> pa.Table:
        order = np.argsort(shard["fp"].to_numpy())
        fps = shard["fp"].to_numpy()[order].view(np.uint64)
        label = forest(fps, shard["home"].to_numpy()[order], radius)
        moved = np.flatnonzero(label != np.arange(len(fps)))
        return pa.table({"a": fps[moved].view(np.int64), "b": fps[label[moved]].view(np.int64)})

    return visited.groupBy("tree", "leaf", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node reaches, for every node but the roots themselves.

    Large-star and small-star rounds: each node's neighbours move to its smallest neighbour until the
    links are stars. The smallest neighbour is a partial aggregate, so a hub costs one row a task; the join
    back is one that Spark splits where a hub is large. Each round is stored, and nothing reaches the driver but a count and a sum.
    """
    now, seen = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()), None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        after = stored(small)
        mark = after.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        forget(now)
        now = after
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark


def grouped(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """fp and component_id (smallest doc_id of all that fp reaches) for each row of nodes(fp, first)."""
    roots = components(edges)
    rooted = stored(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def lanes() -> np.ndarray:
    """For each byte, its bits as eight bytes of a 64-bit number: sums of up to 255 of them count each bit."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view(np.uint64)[:, 0]


LANES = lanes()
MIX = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1)) % (1 << 64)) for i in range(WIDE_WORDS)]


def shingle_hashes(text: bytes, shingle: int = WIDE_SHINGLE, seed: int = SEED) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; of the whole sequence if words are fewer; none without words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    digest = xxhash.xxh64_digest
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    starts = [0, *ends[: n - 1].tolist()]
    return np.unique(np.frombuffer(b"".join([digest(line[a:b], seed) for a, b in zip(starts, stops, strict=True)]), np.uint64))


def wide_fingerprint(h: np.ndarray) -> bytes:
    """WIDE_WORDS x 64 bits over distinct shingle hashes; zero without any."""
    ones = np.zeros((8 * WIDE_WORDS, 8), np.int64)
    for at in range(0, len(h), 255):
        part = h[at : at + 255]
        spread = np.empty((len(part), WIDE_WORDS), np.uint64)
        for i, odd in enumerate(MIX):
            x = (part ^ odd) * MIX[0]
            x ^= x >> np.uint64(32)
            x *= MIX[1]
            spread[:, i] = x ^ (x >> np.uint64(29))
        ones += LANES[spread.view(np.uint8)].sum(axis=0).view(np.uint8).reshape(-1, 8)
    return np.packbits(2 * ones > len(h), axis=1, bitorder="little").tobytes()


def set_id(hashes: np.ndarray) -> int:
    """Of the shingles, not of their fingerprint: texts that differ in few of many shingles can share that."""
    h = xxhash.xxh3_64_intdigest(hashes.tobytes())
    return h - (h >> 63 << 64)


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles that recur in a sample of the texts, and how often.

    They only set the order of rarest(): any order finds the same pairs, this one in small groups.
    """
    share = min(1.0, COMMON_TEXTS / max(1, docs.count()))
    drawn = docs.where(F.pmod(F.xxhash64(F.col("text").cast("binary")), F.lit(1 << 20)) < F.lit(math.ceil(share * (1 << 20))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for x in batch["_text"]:
                hashes = shingle_hashes(x.as_buffer().to_pybytes() if x.is_valid else b"")
                if (own := set_id(hashes)) not in seen:
                    seen.add(own)
                    yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], names=["h"])

    found = drawn.select(F.col("text").cast("binary").alias("_text")).mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
    rows = found.orderBy(F.desc("n"), "h").limit(COMMON).collect()
    h = np.array([r["h"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], np.array([r["n"] for r in rows], np.int64)[order]


def rarest(h: np.ndarray, similarity: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles by rarity, then hash, so many that two sets at the similarity have one of them in common.

    Such sets share at least similarity x n of either's n shingles. All but these and one more can't hold them all.
    """
    known, times = common
    if len(known) and len(h):
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        h = h[np.argsort(np.where(known[at] == h, times[at], 0), kind="stable")]
    return h[: len(h) - math.ceil(similarity * len(h) - 1e-9) + 1]


def parities(h: np.ndarray) -> bytes:
    """Of two sets, no more bits differ here than the sets differ in shingles."""
    odd = np.bincount((h >> np.uint64(20)) % np.uint64(64 * PARITY_WORDS), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def wide_fingerprints(docs: DataFrame, keep: list[str], name: str = "fp", similarity: float = SIMILARITY, common: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """The columns in keep, `name` (a hash of the shingles) and wide (the fingerprint's bytes) of every whole text; given common, rare (the hashes of rarest()), size (how many shingles) and parity too."""
    schema = schema_of(docs, keep, f"{name} long, wide binary" + (", rare binary, size int, parity binary" if common else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wide, rare, sizes, parity = [], [], [], [], []
            for x in batch["_text"]:
                hashes = shingle_hashes(x.as_buffer().to_pybytes() if x.is_valid else b"")
                ids.append(set_id(hashes))
                wide.append(wide_fingerprint(hashes))
                if common:
                    rare.append(rarest(hashes, similarity, common).tobytes())
                    sizes.append(len(hashes))
                    parity.append(parities(hashes))
            more = [pa.array(rare, pa.binary()), pa.array(sizes, pa.int32()), pa.array(parity, pa.binary())] if common else []
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(ids, pa.int64()), pa.array(wide, pa.binary()), *more], names=[*keep, name, "wide", *(["rare", "size", "parity"] if common else [])])

    return docs.select(*keep, F.col("text").cast("binary").alias("_text")).mapInArrow(run, schema)


def shared_shingles(marked: DataFrame) -> DataFrame:
    """(h, fp): the rare shingles of marked(fp, rare) that two or more fp have, with each of these.

    They travel packed, batch by batch; copies of a text collapse in each task before.
    """
    total = marked.agg(F.sum(F.octet_length("rare"))).first()[0] or 0
    buckets = max(1, -(-total // (8 * BUCKET_SHINGLES)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            ids, rare = [], []
            for fp, r in zip(batch["fp"].to_pylist(), batch["rare"].to_pylist(), strict=True):
                if fp not in seen:
                    seen.add(fp)
                    ids.append(fp)
                    rare.append(r)
            h = np.frombuffer(b"".join(rare), np.uint64)
            pairs = np.stack([h.view(np.int64), np.repeat(np.array(ids, np.int64), [len(r) // 8 for r in rare])], axis=1)
            bucket = (h % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            edges = np.append(np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])), len(order)) if len(order) else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bucket[order][edges[:-1]], pa.int32()), pa.array([pairs[order[x:y]].tobytes() for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)], pa.binary())], names=["bucket", "pairs"])

    def meet(group: pa.Table) -> pa.Table:
        pairs = np.frombuffer(b"".join(group["pairs"].to_pylist()), np.int64).reshape(-1, 2)
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        pairs = pairs[np.append(True, (pairs[1:] != pairs[:-1]).any(axis=1))]
        same = pairs[1:, 0] == pairs[:-1, 0]
        pairs = pairs[np.append(same, False) | np.append(False, same)]
        return pa.table({"h": np.ascontiguousarray(pairs[:, 0]), "fp": np.ascontiguousarray(pairs[:, 1])})

    return marked.select("fp", "rare").mapInArrow(deal, "bucket int, pairs binary").groupBy("bucket").applyInArrow(meet, "h long, fp long")


def wide_radius(similarity: float) -> int:
    """Differing bits of a pair at this Jaccard similarity, and two standard deviations more."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    bits = 64 * WIDE_WORDS
    return round(bits * share + 2 * math.sqrt(bits * share * (1 - share)))


def wide_forest(fps: np.ndarray, radius: int, cells: int = CELLS) -> np.ndarray:
    """forest() of rows of words."""
    n = len(fps)
    label = np.arange(n, dtype=np.int32)
    rows = max(1, cells // (n * fps.shape[1]))
    for at in range(0, n, rows):
        block = np.arange(at, min(n, at + rows))
        near = np.bitwise_count(fps[block][:, None, :] ^ fps[None, :, :]).sum(axis=2, dtype=np.uint16) <= radius
        near &= label[block][:, None] != label[None, :]
        join_up(label, *np.nonzero(near), block)
    return label


def wide_links(nodes: DataFrame, rows: int, similarity: float = SIMILARITY, shard_rows: int = WIDE_SHARD_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """(a, b): links between nodes(fp, wide) whose wide fingerprints are within wide_radius(), as each shard's forest; not all of them.

    A tree for each block of WIDE_BITS bits, with radius 0. Of a pair at 0.8, a block agrees with
    probability 0.138, so one of 32 does with 0.991; of a pair at 0.9, with more than 0.9999. Both this and
    the radius lose pairs, most of all of short texts; rest() finds those.
    """
    per_word = 64 // WIDE_BITS
    blocks = [(b // per_word, ((1 << WIDE_BITS) - 1) << (WIDE_BITS * (b % per_word))) for b in range(WIDE_BLOCKS)]
    radius = wide_radius(similarity)
    share = min(1.0, 0.8 * SAMPLE / 8 / max(1, rows))
    drawn = [bytes(r["wide"]) for r in nodes.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))).select("wide").limit(SAMPLE // 8).collect()]
    sample = np.frombuffer(b"".join(sorted(drawn)), np.uint64).reshape(-1, WIDE_WORDS)
    depth = max(0, min(math.ceil(math.log2(max(1, rows) / shard_rows)), int(math.log2(max(1, len(sample)))) - 3))
    grown = [grow(sample[:, w], m, depth, np.random.default_rng(t)) for t, (w, m) in enumerate(blocks)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.frombuffer(b"".join(batch["wide"].to_pylist()), np.uint64).reshape(-1, WIDE_WORDS)
            for t, ((w, m), tree) in enumerate(zip(blocks, grown, strict=True)):
                at, leaf, _ = visits(tree, m, 0, np.ascontiguousarray(fps[:, w]))
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t, np.int32)), pa.array(leaf), batch["fp"].take(take), batch["wide"].take(take)], names=["tree", "leaf", "fp", "wide"])

    visited = in_parts(nodes.select("fp", "wide").mapInArrow(assign, "tree int, leaf int, fp long, wide binary"), ["tree", "leaf"], task_rows)

    def compare(shard: pa.Table) -> pa.Table:
        w, m = blocks[shard["tree"][0].as_py()]
        fps = np.frombuffer(b"".join(shard["wide"].to_pylist()), np.uint64).reshape(-1, WIDE_WORDS)
        ids, value = shard["fp"].to_numpy(), fps[:, w] & np.uint64(m)
        order = np.argsort(value, kind="stable")
        edges = np.append(np.flatnonzero(np.append(True, value[order][1:] != value[order][:-1])), len(order))
        a, b = [], []
        for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if y - x > 1:
                run = order[x:y]
                label = wide_forest(fps[run], radius)
                moved = np.flatnonzero(label != np.arange(len(run)))
                a.append(ids[run[moved]])
                b.append(ids[run[label[moved]]])
        none = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])})

    return visited.groupBy("tree", "leaf", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def alike(wide: np.ndarray, sets: list[np.ndarray], radius: int, similarity: float) -> np.ndarray:
    """For each row, the first that it reaches by pairs whose shingles have this Jaccard similarity or more.

    Pairs are tried by differing bits, nearest first, and those already joined are passed over: a family
    of copies of one text takes about as many trials as it has rows.
    """
    n = len(sets)
    label = np.arange(n, dtype=np.int32)
    rows = max(1, CELLS // (n * wide.shape[1]))
    for at in range(0, n, rows):
        d = np.bitwise_count(wide[at : at + rows, None, :] ^ wide[None, :, :]).sum(axis=2, dtype=np.uint16)
        a, b = np.nonzero(d <= radius)
        ahead = b > a + at
        a, b = a[ahead], b[ahead]
        order = np.argsort(d[a, b], kind="stable")
        for x, y in zip((a[order] + at).tolist(), b[order].tolist(), strict=True):
            if label[x] != label[y] and jaccard(sets[x], sets[y], similarity) >= similarity:
                low, high = sorted((label[x], label[y]))
                label[label == high] = low
    return label


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Similarity of two sorted sets; 0 where their sizes alone keep it under `least`."""
    if not len(a) and not len(b):
        return 1.0
    if min(len(a), len(b)) < least * max(len(a), len(b)) - 1e-9:
        return 0.0
    both = len(a) + len(b) - len(np.union1d(a, b))
    return both / (len(a) + len(b) - both)


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit(b"")))


def shingle_sets(docs: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """fp, root, wide and hashes (its shingles) for found(fp, root)."""
    members = found.join(nodes.select("fp", F.col("first").alias("_first"), F.col("key").alias("_key")), "fp")
    # the key keeps null ids, and other texts under one id, apart
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("_text")).join(members, F.col("doc_id").eqNullSafe(F.col("_first")) & (text_key(F.col("_text")) == F.col("_key")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for fp, root, text in zip(batch["fp"].to_pylist(), batch["root"].to_pylist(), batch["_text"], strict=True):
                hashes = shingle_hashes(text.as_buffer().to_pybytes() if text.is_valid else b"")
                if set_id(hashes) == fp:  # else another text under the same doc_id
                    for c, v in zip(cols, (fp, root, wide_fingerprint(hashes), hashes.tobytes()), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["fp", "root", "wide", "hashes"])

    # rows that repeat a doc_id and a text repeat here
    return stored(texts.select("fp", "root", "_text").mapInArrow(read, "fp long, root long, wide binary, hashes binary"))


def confirmed(docs: DataFrame, nodes: DataFrame, edges: DataFrame, similarity: float, task_rows: int = CONFIRM_ROWS, task_size: int = CONFIRM_BYTES) -> DataFrame:
    """(a, b): links within the components of edges that hold on the shingles of the texts themselves.

    Only members of a component meet, and a component of over task_rows, or of over task_size bytes of
    hashes, is compared part by part.
    """
    roots = components(edges)
    rows = shingle_sets(docs, nodes, roots.select(F.col("node").alias("fp"), "root").unionByName(roots.select(F.col("root").alias("fp"), "root").distinct()))
    size = F.octet_length("hashes")
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("size")).first()
    buckets = max(buckets_for(20 * total["n"]), -(-total["size"] // CONFIRM_BYTES))
    # large components have tasks of their own, the others share buckets
    dealt = in_parts(rows, ["root"], task_rows, size, task_size).withColumn("bucket", F.pmod(F.xxhash64("root"), F.lit(buckets)).cast("int"))
    radius = wide_radius(similarity)

    def compare(group: pa.Table) -> pa.Table:
        root, ids = group["root"].to_numpy(), group["fp"].to_numpy()
        wide = np.frombuffer(b"".join(group["wide"].to_pylist()), np.uint64).reshape(-1, WIDE_WORDS)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group["hashes"]]
        order = np.argsort(root, kind="stable")
        edges = np.append(np.flatnonzero(np.append(True, root[order][1:] != root[order][:-1])), len(order))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            run = order[x:y]
            label = alike(wide[run], [sets[i] for i in run.tolist()], radius, similarity)
            moved = np.flatnonzero(label != np.arange(len(run)))
            a.append(ids[run[moved]])
            b.append(ids[run[label[moved]]])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    out = stored(dealt.groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long").distinct())
    forget(rows)
    return out


def rest(docs: DataFrame, nodes: DataFrame, links_of: DataFrame, shared: DataFrame, similarity: float) -> DataFrame:
    """(a, b): all pairs at the similarity that links_of doesn't join, confirmed on their shingles.

    Each shares rare shingles, and how many at least follows from the sizes: where the order of rarest()
    passes the end of one set's rare shingles first, all that both have so far is rare in both, and at most
    the others of that set are to come. The sets' parities differ in no more bits than such sets in shingles,
    which tells nearly all other texts of a family apart before a pair is made. Of those that share a shingle,
    the largest component meets the others but not itself. So only pairs that may hold have their texts read.
    """
    roots = components(links_of)
    places = nodes.select("fp", "size").join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "size", F.coalesce("root", "fp").alias("root"))
    at = stored(shared.join(places, "fp"))
    # a family that is joined already meets nobody
    by_root = at.groupBy("h", "root").agg(F.count(F.lit(1)).alias("n"))
    several = by_root.groupBy("h").agg(F.count(F.lit(1)).alias("roots"), F.max(F.struct("n", "root")).alias("m")).where("roots > 1").select("h", F.col("m.root").alias("main"))
    words = [f"p{i}" for i in range(PARITY_WORDS)]
    word = lambda i: F.conv(F.hex(F.substring("parity", 8 * i + 1, 8)), 16, -10).cast("long")
    parity = nodes.select("fp", *(word(i).alias(w) for i, w in enumerate(words)))
    met = stored(at.join(several, "h").join(parity, "fp"))
    a, b = (met.select("h", "main", *(F.col(c).alias(f"{c}_{x}") for c in ("fp", "size", "root", *words))) for x in "ab")
    large, small = F.greatest("size_a", "size_b"), F.least("size_a", "size_b")
    shares = F.ceil(similarity / (1 + similarity) * (large + small) - 1e-6)  # at the similarity, so many at least
    differ = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in words))
    others = (F.col("root_a") != F.col("root_b")) & ((F.col("root_b") == F.col("main")) | (F.col("fp_a") < F.col("fp_b")))
    near = others & (small + 1e-6 >= similarity * large) & (differ <= large + small - 2 * shares)
    both = a.where("root_a <> main").join(b.drop("main"), "h").where(near).groupBy(F.least("fp_a", "fp_b").alias("fp_a"), F.greatest("fp_a", "fp_b").alias("fp_b"), large.alias("large"), small.alias("small")).agg(F.count(F.lit(1)).alias("n"))
    least = F.ceil(similarity / (1 + similarity) * (F.col("large") + F.col("small")) - 1e-6) - F.ceil(similarity * F.col("large") - 1e-6) + 1
    pairs = found = stored(both.where(F.col("n") >= least).select("fp_a", "fp_b"))
    ends = pairs.select(F.col("fp_a").alias("fp")).union(pairs.select(F.col("fp_b").alias("fp"))).distinct()
    sets_of = shingle_sets(docs, nodes, ends.select("fp", F.lit(0).cast("long").alias("root")))
    for x in "ab":
        pairs = pairs.join(sets_of.select(F.col("fp").alias(f"fp_{x}"), F.col("hashes").alias(f"hashes_{x}")), f"fp_{x}")

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = ([np.frombuffer(x.as_buffer(), np.uint64) for x in batch[f"hashes_{y}"]] for y in "ab")
            holds = pa.array([jaccard(p, q, similarity) >= similarity for p, q in zip(*sets, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["fp_a"].filter(holds), batch["fp_b"].filter(holds)], names=["a", "b"])

    out = stored(pairs.mapInArrow(hold, "a long, b long"))
    for written in (at, met, found, sets_of):
        forget(written)
    return out


def hex_of(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id for every row.

    Texts without words (null, empty, blank) share fingerprint zero and link like any others. A null
    doc_id is never the smallest unless its component has no other. Repeated rows return as often as
    they come; an empty table gives no rows; other columns are not read.
    """
    marked = stored(fingerprints(docs, ["doc_id"]))
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    return marked.join(grouped(nodes, links(nodes, nodes.count())), "fp").select("doc_id", hex_of("fp").alias("fingerprint"), "component_id")


def one_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs without near copies: of each component, the row with the smallest doc_id.

    Near copies are texts whose distinct five-word shingles have this Jaccard similarity or more. Wide fingerprints
    find most pairs, rest() finds all others, and each is confirmed on the shingles. Texts without words (null, empty,
    blank) are copies of each other. A null id is the smallest only among null ids. Of rows that repeat a doc_id and a
    text, one stays; a component of null ids alone keeps one row too. An empty table gives no rows; extra columns stay,
    whatever their names.
    """
    docs, names = shielded(docs, ["doc_id", "text"])
    keyed = docs.withColumn("_key", text_key(F.col("text").cast("binary")))
    marked = stored(wide_fingerprints(keyed, ["doc_id", "_key"], similarity=similarity, common=common_shingles(docs)))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key")).alias("least")
    nodes = stored(marked.groupBy("fp").agg(least, F.first("wide").alias("wide"), F.first("size").alias("size"), F.first("parity").alias("parity")).select("fp", F.col("least.doc_id").alias("first"), F.col("least._key").alias("key"), "wide", "size", "parity"))
    shared = stored(shared_shingles(marked))
    links_of = confirmed(docs, nodes, wide_links(nodes, nodes.count(), similarity), similarity)
    more = rest(docs, nodes, links_of, shared, similarity)
    components_of = grouped(nodes.select("fp", "first"), links_of.unionByName(more))
    stays = stored(marked.select("doc_id", "fp").join(components_of, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "fp").agg(F.count(F.lit(1)).alias("n")))
    for written in (marked, nodes, shared, links_of, more):
        forget(written)
    ids = stays.select(F.col("doc_id").alias("_id"))
    # the ids grow with the corpus, so they are never broadcast
    kept = docs.join(ids.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    rows = stays.agg(F.count(F.lit(1)).alias("ids"), F.sum("n").alias("rows"), F.countDistinct(F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull()).alias("different")).first()
    if rows["ids"] == rows["rows"] == rows["different"]:
        return kept.toDF(*names)
    places = stays.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"))
    again = wide_fingerprints(kept, kept.columns, name="_simhash").drop("wide")
    rows = again.join(places, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_simhash") == F.col("_fp")), "left_semi").dropDuplicates(["doc_id", "_simhash"])
    return rows.drop("_simhash").toDF(*names)
