"""Packing: documents into fixed-length token sequences, shortest pack first over the length histogram.

The executors tokenise whole texts and cut each document into full sequences and one remainder. The
driver sees only the histogram of piece lengths (at most `capacity` rows, whatever the corpus) and packs
it longest length first: a length goes to the packs with most room left, counts at a time, so one step
moves all documents of a length. The resulting patterns come back to the pieces by rank: pattern slots
take consecutive ranks among the pieces of their length.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import bucket_counts, buckets_for, stored, with_rank

CAPACITY = 4096
END_ID = 2
#: Words whose ids a worker remembers.
CACHED_WORDS = 800_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: The vocabulary's own word rule, for lower-cased text of code points up to U+00FF.
LATIN_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^\s0-9a-z\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-\xff]+")
#: Code points that the word rule may treat otherwise than the tokenizer does.
UNSURE = re.compile(r"[^\x00-\x1b\x20-\x84\x86-\xff]")


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: its own if it is visible, else the next from U+0100."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


class WordIds(dict):
    """Word -> its ids as little-endian unsigned 32-bit bytes; asks the vocabulary's model once a word."""

    def __init__(self, tokenizer):
        super().__init__()
        self.model = tokenizer.model
        self.letters = byte_letters()

    def __missing__(self, word: str) -> bytes:
        ids = array("I", [t.id for t in self.model.tokenize("".join(map(self.letters.__getitem__, word.encode())))]).tobytes()
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = ids
        return ids


class WordTokenizer:
    """Ids of whole texts by a tokenizers file with a word rule as above.

    Words are independent in such a vocabulary, so texts up to U+00FF are split here and only new words
    reach the tokenizer; any other text, and one that holds an added token, goes to it whole. Both ways give
    the same ids (tested).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = WordIds(self.tokenizer)
        added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")

    def id_bytes(self, text: str) -> bytes:
        low = text.lower()
        if UNSURE.search(text) or self.added.search(low):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.words.__getitem__, LATIN_WORD.findall(low)))


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row a piece: at most `capacity` consecutive ids of a document, whose ids end with end_id."""
    end = array("I", [end_id]).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(tokenizer_path)
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = tokenizer.id_bytes(text.as_py() or "") + end
                for at in range(0, len(ids), 4 * capacity):
                    piece = ids[at : at + 4 * capacity]
                    for col, v in zip(cols, (doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, PIECES)


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple]]:
    """[(count, lengths)]: how many sequences have which piece lengths, shortest pack first.

    Lengths are placed longest first. Each goes to the packs with the most room; where their number and
    the length's number differ, the smaller number moves and the rest stays. Every step uses up a pack
    group or a length, so the steps grow with the number of distinct lengths, not of documents.
    """
    room: dict[int, list] = {}
    most: list[int] = []

    def put(left: int, group: tuple) -> None:
        if left not in room:
            room[left] = []
            heapq.heappush(most, -left)
        room[left].append(group)

    for length in sorted(histogram, reverse=True):
        todo = histogram[length]
        while todo:
            while most and not room[-most[0]]:
                del room[-heapq.heappop(most)]
            left = -most[0] if most else 0
            if left >= length:
                count, pattern = room[left].pop()
                moved = min(count, todo)
                if count > moved:
                    room[left].append((count - moved, pattern))
                put(left - length, (moved, (pattern, length)))
                todo -= moved
            else:  # a new pack then has the most room: it takes this length until it can't
                most_in_one = capacity // length
                copies = min(most_in_one, todo)
                pattern = None
                for _ in range(copies):
                    pattern = (pattern, length)
                put(capacity - copies * length, (todo // copies, pattern))
                todo %= copies
    return [group for left in sorted(room) for group in room[left]]


def slot_table(groups: list[tuple[int, tuple]]) -> dict[str, np.ndarray]:
    """A row for each slot of each pattern, sorted by (length, first): ranks first.. of that length sit at
    `offset` of the sequences from `sequence`."""
    rows, taken, sequence = [], {}, 0
    for count, pattern in groups:
        lengths = []
        while pattern is not None:
            pattern, length = pattern
            lengths.append(length)
        offset = 0
        for length in reversed(lengths):
            first = taken.get(length, 0)
            rows.append((length, first, sequence, offset))
            taken[length] = first + count
            offset += length
        sequence += count
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "first": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document with its place.

    Columns: those of pieces(), sequence_id and offset. Null texts are empty: their one id is end_id. An
    empty table gives no rows; repeated rows are packed as often as they come; other columns are not read.
    """
    cut = stored(pieces(docs, tokenizer_path, capacity, end_id))
    n = buckets_for(cut.count())
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(n)).cast("int"))
    counts = bucket_counts(cut, ["length"])
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = slot_table(pack_histogram(histogram, capacity))
    step = max([1, *histogram.values()])
    starts = slots["length"] * step + slots["first"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch[c].to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(starts, length * step + rank, side="right") - 1
            sequence = slots["sequence"][at] + rank - slots["first"][at]
            keep = [batch[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(slots["offset"][at])], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return with_rank(cut, counts, ["length"], ["doc_id", "start", "ids_crc32"]).mapInArrow(place, PIECES + ", sequence_id long, offset long")
