"""Suffix-array dedup: every byte covered by a string of LENGTH bytes that starts earlier goes.

All windows of LENGTH bytes are dealt out by an anchor: of the GRAM-byte strings in a window, the one with
the least hash (the last of equals). Equal windows have equal anchors, so they meet. Neighbouring windows
with one anchor travel as one segment, and first only as hashes: equal segments are settled by their
earliest one (at 64 bits of hash and 32 or more of anchor: among n different segments that share a bucket and
an anchor, some two are taken for equal with a chance under n squared / 2**65). Where an anchor is left with different segments, their bytes follow, cut in two at the
anchor so that each part's windows share over half their bytes. A shard joins its parts to one text and
runs the named method on it: breadth-first backward extension on the Burrows-Wheeler transform, by
increasing common prefix, which stops at LENGTH. What it leaves unsplit are the classes of equal windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import forget, shielded, sliced, stored

LENGTH, GRAM = 100, 32
#: Windows that one pass over a batch's bytes reads; their positions take POSITION_BITS of a key.
CHUNK, POSITION_BITS = 1 << 18, 20
#: Segments that a bucket is planned for.
BUCKET_ROWS = 500_000
#: Bytes whose suffixes are sorted at once; a larger family of segments with one key is sorted alone.
SORTED_BYTES = 1 << 20
POSITION = np.uint64((1 << POSITION_BITS) - 1)
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
SPANS = "doc long, tie long, start long, length long"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    if have < width:
        x = np.minimum(x[: len(x) - (width - have)], x[width - have :])
    return x


def segments(raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(doc, begin, windows, anchor, hash) of the segments of all texts in raw; text i is raw[offsets[i]:offsets[i + 1]].

    doc is i, begin the first window's place in raw, windows their number, anchor the anchor's place
    after begin and hash a hash of its bytes. Every window of every text is in exactly one segment.
    """
    words = gram // 8
    out: list[tuple] = []
    last = len(raw) - length + 1
    for a in range(0, max(0, last), CHUNK):
        b = min(a + CHUNK, last)
        part = np.ascontiguousarray(raw[a : b + length - 1])
        n = len(part) - gram + 1
        eight = np.ndarray((len(part) - 7,), np.uint64, part, strides=(1,))
        h = eight[:n] * ODD[0]
        for w in range(1, words):
            h += eight[8 * w : 8 * w + n] * (ODD[w % 4] + np.uint64(2 * (w // 4)))
            h ^= h >> np.uint64(29)
            h *= ODD[(w + 1) % 4]
        h ^= h >> np.uint64(32)
        h |= POSITION
        h ^= np.arange(n, dtype=np.uint64)  # the low bits are now POSITION - place: the last of equals is the least
        least = sliding_min(h, length - gram + 1)
        place = (POSITION - (least & POSITION)).astype(np.int64)
        cuts = np.flatnonzero(place[1:] != place[:-1]) + 1
        inner = offsets[np.searchsorted(offsets, a, "right") : np.searchsorted(offsets, b + length, "left") + 1] - a
        starts = np.concatenate([[0], cuts, inner, inner - length + 1])
        starts = np.unique(starts[(starts >= 0) & (starts < b - a)])
        doc = np.searchsorted(offsets, starts + a, "right") - 1
        whole = starts + a + length <= offsets[doc + 1]
        stops = np.append(starts[1:], b - a)
        starts, stops, doc = starts[whole], stops[whole], doc[whole]
        out.append((doc, starts + a, stops - starts, place[starts] - starts, least[starts] >> np.uint64(POSITION_BITS)))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def text_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and where each begins and the last ends."""
    col = batch[name]
    wide = pa.types.is_large_binary(col.type)
    offsets = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def later(keys: list[np.ndarray], doc: np.ndarray, tie: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first, dup) over rows sorted by keys, then place: whether a row begins a group of equal keys,
    and whether it stands later than its group's first (a repeated row stands at the same place)."""
    order = np.lexsort((start, tie, doc, *reversed(keys)))
    new = np.ones(len(order), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    dup = np.zeros(len(order), bool)
    for v in (doc, tie, start):
        s = v[order]
        dup |= s != s[head]
    return order, new, dup


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans joined where they touch."""
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > stop[:-1]
    at = np.flatnonzero(new)
    return start[at], stop[np.append(at[1:], len(start)) - 1] if len(at) else stop


PACKED = ("gram", "ctx", "doc", "tie", "start", "windows", "anchor")
KINDS = (np.uint32, np.uint64, np.int64, np.int32, np.uint32, np.uint8, np.uint8)


def hashed(docs: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """Segments as packed arrays, a row a batch and bucket, and spans that a batch settles by itself (bucket -1)."""
    names = ["bucket", *PACKED]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "_text"):
            raw, offsets = text_column(batch, "_text")
            if len(raw) < length:
                continue
            ids, ties = batch["_doc"].to_numpy(zero_copy_only=False), batch["_tie"].to_numpy(zero_copy_only=False)
            doc, begin, windows, anchor, grams = segments(raw, offsets, length, gram)
            view, digest = memoryview(np.ascontiguousarray(raw)), xxhash.xxh3_64_intdigest
            ctx = np.array([digest(view[a:b]) for a, b in zip(begin.tolist(), (begin + windows + length - 1).tolist(), strict=True)], np.uint64)
            start = begin - offsets[doc]
            order, first, dup = later([ctx], ids[doc], ties[doc], start)
            rows = []
            gone = order[dup]
            if len(gone):
                # spans of all texts at once: texts stand apart in raw, with one byte more between them
                spread = begin[gone] + doc[gone]
                a, b = merged(spread, spread + windows[gone] + length - 1)
                d = np.searchsorted(offsets + np.arange(len(offsets)), a, "right") - 1
                rows.append((-1, None, None, ids[d].astype(np.int64), ties[d].astype(np.int32), (a - offsets[d] - d).astype(np.uint32), None, (b - a).astype(np.uint32)))
            keep = order[first]
            bucket = (grams[keep] % np.uint64(buckets)).astype(np.int64)
            keep, bucket = keep[np.argsort(bucket, kind="stable")], np.sort(bucket)
            cols = [(grams[keep] // np.uint64(buckets)).astype(np.uint32), ctx[keep], ids[doc[keep]], ties[doc[keep]].astype(np.int32), start[keep].astype(np.uint32), windows[keep].astype(np.uint8), anchor[keep].astype(np.uint8)]
            edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket)) if len(bucket) else [0]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                rows.append((int(bucket[a]), *(c[a:b] for c in cols)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] if r[i] is None else np.ascontiguousarray(r[i]).tobytes() for r in rows], pa.binary()) for i in range(1, len(names)))], names=names)

    return docs.select("_doc", "_tie", F.col("_text")).mapInArrow(run, "bucket int, " + ", ".join(f"{c} binary" for c in PACKED))


FOUND = "need boolean, doc long, tie long, start long, length long, anchor int"


def found_table(need: np.ndarray | bool, doc: np.ndarray, tie: np.ndarray, start: np.ndarray, length: np.ndarray, anchor: np.ndarray | int = 0) -> pa.Table:
    n = len(doc)
    return pa.table({"need": pa.array(np.broadcast_to(need, n).copy(), pa.bool_()), "doc": pa.array(doc.astype(np.int64)), "tie": pa.array(tie.astype(np.int64)), "start": pa.array(start.astype(np.int64)), "length": pa.array(length.astype(np.int64)), "anchor": pa.array(np.broadcast_to(anchor, n).astype(np.int32))})


def settle(packed: DataFrame, length: int) -> DataFrame:
    """FOUND: segments equal to an earlier one (need false, to be removed), and the segments whose bytes are needed."""

    def run(group: pa.Table) -> pa.Table:
        gram, ctx, doc, tie, start, windows, anchor = (np.concatenate([np.frombuffer(x.as_buffer(), k) for x in group[c]]) for c, k in zip(PACKED, KINDS, strict=True))
        order, first, dup = later([gram, ctx], doc, tie, start)
        gone, heads = order[dup], order[first]
        many = np.zeros(len(heads), bool)
        same = gram[heads][1:] == gram[heads][:-1]
        many[1:] |= same
        many[:-1] |= same
        need = heads[many]
        span = windows.astype(np.int64) + length - 1
        return pa.concat_tables([found_table(False, doc[gone], tie[gone], start[gone], span[gone]), found_table(True, doc[need], tie[need], start[need], span[need], anchor[need])])

    return packed.where("bucket >= 0").groupBy("bucket").applyInArrow(run, FOUND)


def settled_in_batches(packed: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [np.concatenate([np.zeros(0, k), *(np.frombuffer(x.as_buffer(), k) for x in batch[c])]) for c, k in (("doc", np.int64), ("tie", np.int32), ("start", np.uint32), ("anchor", np.uint32))]
            yield from found_table(False, *cols).to_batches()

    return packed.where("bucket < 0").mapInArrow(run, FOUND)


PARTS = "shard int, key long, doc long, tie long, start long, part binary"


def parts(docs: DataFrame, found: DataFrame, shards: int, length: int, gram: int) -> DataFrame:
    """The bytes of the needed segments, as two parts each, under keys that equal windows share.

    A window with half or more of its other bytes before the anchor goes by those bytes and the anchor;
    any other by the anchor and as many bytes after it.
    """
    half = (length - gram) // 2
    wanted = found.where("need").groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "length", "anchor")).alias("wanted"))
    joined = docs.join(wanted, (F.col("_doc") == F.col("doc")) & (F.col("_tie") == F.col("tie")))
    schema = pa.schema([("shard", pa.int32()), ("key", pa.int64()), ("doc", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("part", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            cols: list[list] = [[] for _ in schema]
            for doc, tie, text, wanted in zip(batch["doc"].to_pylist(), batch["tie"].to_pylist(), batch["_text"], batch["wanted"], strict=True):
                text = memoryview(text.as_buffer())
                w = wanted.values
                for s, n, at in zip(w.field("start").to_pylist(), w.field("length").to_pylist(), w.field("anchor").to_pylist(), strict=True):
                    p, last = s + at, s + n - length
                    split = min(max(p - half + 1, s), last + 1)  # the first window with fewer than half before the anchor
                    for a, b, key in ((s, split - 1, text[p - half : p + gram] if split > s else None), (split, last, text[p : p + length - half] if split <= last else None)):
                        if key is not None:
                            h = digest(key)
                            for col, v in zip(cols, ((h >> 40) % shards, (h & ((1 << 63) - 1)), doc, tie, a, bytes(text[a : b + length])), strict=True):
                                col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return joined.select("doc", "tie", "_text", "wanted").mapInArrow(run, PARTS)


def suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Places in text, sorted by the depth symbols from there on at least. text must end with its only 0."""
    bits = max(1, int(text.max()).bit_length())
    have = 63 // bits
    padded = np.concatenate([text.astype(np.int64), np.zeros(have, np.int64)])
    rank = np.zeros(len(text), np.int64)
    for i in range(have):
        rank = (rank << bits) | padded[i : i + len(text)]
    while True:
        order = np.argsort(rank, kind="stable")
        ranked = rank[order]
        new = np.append(0, np.cumsum(ranked[1:] != ranked[:-1]))
        if have >= depth or new[-1] == len(text) - 1:
            return order
        rank = np.empty(len(text), np.int64)
        rank[order] = new + 1
        after = np.zeros(len(text), np.int64)
        after[: max(0, len(text) - have)] = rank[have:]
        rank = rank * (len(text) + 1) + after
        have *= 2


def classes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, class): the sorted suffixes and a number that those with a common prefix of length or more share.

    Breadth-first: all intervals of strings of n symbols are extended by one symbol to the left at once. An
    interval whose right end is not yet a border makes it one, with common prefix n, and goes on to the
    next round; the others end. After `length` rounds the borders are those of shorter common prefixes.
    """
    places = suffixes(text, length)
    n = len(text)
    bwt = text[places - 1]  # before the first place stands the end
    counts = np.bincount(bwt, minlength=int(text.max()) + 1)
    by_symbol = np.argsort(bwt, kind="stable")
    step = np.empty(n, np.int64)
    step[by_symbol] = np.arange(n)
    starts_symbol = np.zeros(n + 1, bool)
    starts_symbol[np.cumsum(counts)] = True
    border = np.zeros(n + 1, bool)
    border[n] = border[0] = True
    left, right = np.array([0]), np.array([n - 1])
    owner = np.full(n, -1, np.int32)
    for _ in range(length):
        if not len(left):
            break
        sizes = right - left + 1
        total = int(sizes.sum())
        rows = np.repeat(left - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
        to = step[rows]
        owner[to] = np.repeat(np.arange(len(left), dtype=np.int32), sizes)
        if total * 16 > n:
            marked = np.zeros(n, bool)
            marked[to] = True
            to = np.flatnonzero(marked)
        else:
            to = np.sort(to)
        own = owner[to]
        ends = np.append((to[1:] != to[:-1] + 1) | (own[1:] != own[:-1]) | starts_symbol[to[1:]], True)
        right = to[ends]
        left = to[np.append(True, ends[:-1])]
        fresh = ~border[right + 1]
        left, right = left[fresh], right[fresh]
        border[right + 1] = True
    return places, np.cumsum(border[:n]) - 1


def repeats(key: np.ndarray, doc: np.ndarray, tie: np.ndarray, start: np.ndarray, raw: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, tie, start, length) of the spans that earlier windows among the parts cover."""
    out = []
    index: dict[bytes, int] = {}
    content = np.fromiter((index.setdefault(x, len(index)) for x in raw), np.int64, len(raw))
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    order, first, dup = later([key, content], doc, tie, start)
    gone = order[dup]
    out.append((doc[gone], tie[gone], start[gone], size[gone]))
    heads = order[first]
    same = key[heads][1:] == key[heads][:-1]
    many = np.zeros(len(heads), bool)
    many[1:] |= same
    many[:-1] |= same
    heads = heads[many]
    new = np.append(True, key[heads][1:] != key[heads][:-1])[: len(heads)]
    begins = np.append(np.flatnonzero(new), len(heads))
    ends = np.append(0, np.cumsum(size[heads] + 1))
    a = 0
    while a < len(begins) - 1:
        b = a + 1
        while b < len(begins) - 1 and ends[begins[b + 1]] - ends[begins[a]] <= SORTED_BYTES:
            b += 1
        out.append(repeats_in(heads[begins[a] : begins[b]], doc, tie, start, raw, length))
        a = b
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def repeats_in(rows: np.ndarray, doc: np.ndarray, tie: np.ndarray, start: np.ndarray, raw: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    sizes = np.array([len(raw[i]) for i in rows.tolist()])
    text = np.frombuffer(b"".join(raw[i] + b"\0" for i in rows.tolist()) + b"\0", np.uint8).astype(np.int16) + 2
    ends = np.cumsum(sizes + 1)
    text[ends - 1] = 1  # between parts; bytes are 2 and above
    text[-1] = 0
    used, text = np.unique(text, return_inverse=True)
    places, number = classes(text, length)
    part = np.searchsorted(ends, places, "right")
    inside = part < len(sizes)
    inside[inside] = places[inside] + length <= ends[part[inside]] - 1
    shared = np.zeros(len(places), bool)
    same = number[1:] == number[:-1]
    shared[1:] |= same
    shared[:-1] |= same
    use = np.flatnonzero(inside & shared)
    row = rows[part[use]]
    at = start[row] + places[use] - (ends - sizes - 1)[part[use]]
    order, _, dup = later([number[use]], doc[row], tie[row], at)
    gone = order[dup]
    return doc[row][gone], tie[row][gone], at[gone], np.full(len(gone), length, np.int64)


def compared(shards: DataFrame, length: int) -> DataFrame:
    """SPANS that each shard's parts prove to be repeated."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        cols = [group[c].to_numpy() for c in ("key", "doc", "tie", "start")]
        d, t, s, n = repeats(*cols, group["part"].to_pylist(), length)
        if len(d):  # windows beside each other as one span
            order = np.lexsort((s, t, d))
            d, t, s, n = d[order], t[order], s[order], n[order]
            stop = s + n
            new = np.append(True, (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (s[1:] > stop[:-1]))
            at = np.flatnonzero(new)
            d, t, s, n = d[at], t[at], s[at], np.maximum.reduceat(stop, at) - s[at]
        return pa.table({"doc": d, "tie": t, "start": s, "length": n}).cast(pa.schema([(c, pa.int64()) for c in ("doc", "tie", "start", "length")]))

    return shards.groupBy("shard").applyInArrow(run, SPANS)


def keyed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns in keep, _text (bytes; a null text has none) and the place of the document: _doc (a null id
    comes before all), then _tie (other texts under one id)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(*keep, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_doc"), F.pmod(F.xxhash64(text), F.lit(1 << 31)).alias("_tie"), text.cast("binary").alias("_text"))


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc, tie, gone): for each document with any, the spans [start, length] to remove; they may overlap."""
    if gram % 8 or not 8 <= gram <= length:
        raise ValueError("gram must be a multiple of 8, up to length")
    texts = keyed(docs, [])
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-2 * size // ((length - gram + 2) * bucket_rows)))
    packed = stored(hashed(texts, buckets, length, gram))
    found = stored(settle(packed, length).unionByName(settled_in_batches(packed)))
    forget(packed)
    more = compared(parts(texts, found, buckets, length, gram), length)
    gone = found.where("not need").select("doc", "tie", "start", "length").unionByName(more)
    return gone.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "length")).alias("gone"))


def cut(text: bytes, start: np.ndarray, size: np.ndarray) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, maximal removed runs)."""
    if not len(start):
        return text, 0, 0
    a, b = merged(start, start + size)
    left, at = [], 0
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        left.append(text[at:x])
        at = y
    left.append(text[at:])
    return b"".join(left), int((b - a).sum()), len(a)


def with_spans(docs: DataFrame, keep: list[str], gone: DataFrame) -> DataFrame:
    rows = keyed(docs, keep)
    return rows.join(gone, (F.col("_doc") == F.col("doc")) & (F.col("_tie") == F.col("tie")), "left").select(*keep, "_text", "gone")


def cut_column(batch: pa.RecordBatch) -> Iterator[tuple[bytes, int, int, int]]:
    """(what is left, bytes before, bytes removed, runs) of each row."""
    none = np.zeros(0, np.int64)
    for text, gone in zip(batch["_text"], batch["gone"], strict=True):
        raw = text.as_buffer().to_pybytes()
        where = (none, none) if not gone.is_valid else tuple(gone.values.field(f).to_numpy() for f in ("start", "length"))
        left, removed, runs = cut(raw, *where)
        yield left, len(raw), removed, runs


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row.

    Null and empty texts, and those shorter than length, stay as they are. Rows that repeat a doc_id and
    its text are one document and get one result; other texts under one doc_id are documents after each
    other, in an order by hash. An empty table gives no rows; other columns are not read.
    """
    schema = f"`doc_id` {dict(docs.dtypes)['doc_id']}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(n, removed, runs, hashlib.sha256(left).hexdigest()) for left, n, removed, runs in cut_column(batch)]
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, pa.string() if i == 3 else pa.int64()) for i, c in enumerate(cols))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return with_spans(docs, ["doc_id"], spans(docs, length, gram, bucket_rows)).mapInArrow(run, schema)


def deduped(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """docs with the repeated bytes taken out of text (a null text stays null). A character of which only some
    bytes are repeated goes whole. Null ids come before all others, texts of any length are read whole, rows that
    repeat a doc_id and its text stay and are cut alike, an empty table gives no rows, and extra columns stay,
    whatever their names."""
    from pyspark.sql.pandas.types import to_arrow_schema

    docs, names = shielded(docs, ["doc_id", "text"])
    others = [c for c in docs.columns if c != "text"]
    marked = docs.withColumn("_null", F.col("text").isNull())
    target = to_arrow_schema(docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [None if null else x[0].decode(errors="ignore") for x, null in zip(cut_column(batch), batch["_null"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(left, f.type) if f.name == "text" else batch[f.name] for f in target], names=target.names)

    return with_spans(marked, [*others, "_null"], spans(docs, length, gram, bucket_rows)).mapInArrow(run, docs.schema).toDF(*names)
