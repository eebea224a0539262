"""Media columns: GIF. Decode LZW code streams, palettes, disposal, transparency and timing to frames.

decode() reads any GIF (87a or 89a): sub-blocks, variable code widths, deferred clears, local palettes,
interlacing, disposal 0 to 3 and transparent indices. write() stores bytes losslessly as 8-bit samples,
one palette index a byte, in rows of 64, as LZW codes with growing tables; long payloads become several
timed frames.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 64
#: Rows of a written frame at most, and its time in hundredths of a second.
FRAME_ROWS, DELAY = 2048, 4
#: Levels of each colour channel in a histogram.
LEVELS = 4
GREY = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 3, axis=1)
#: Pixels of a canvas at most, unless a frame fills a quarter of it: a header alone may claim any size.
MOST_PIXELS = 1 << 24


class GifError(ValueError):
    pass


@dataclass
class Frame:
    """One shown picture: the whole canvas after drawing, and the frame's own rectangle of indices."""

    left: int
    top: int
    delay_ms: int
    disposal: int
    transparent: int | None
    indices: np.ndarray
    canvas: np.ndarray
    shown: np.ndarray


@functools.cache
def code_widths(least: int) -> np.ndarray:
    """Bits of the j-th code after a clear, for j up to 4095 (and all later ones): the table grows by one entry a code."""
    j = np.arange(4096)
    return np.minimum(12, np.floor(np.log2(j + (1 << least) + 1)).astype(np.int64) + 1)


def read_codes(stream: np.ndarray, bit: int, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, bit after each) of codes of these widths from a bit on; as many as the stream (with two bytes behind it) has."""
    stops = bit + np.cumsum(widths)
    n = int(np.searchsorted(stops, 8 * (len(stream) - 2), "right"))
    stops, widths = stops[:n], widths[:n]
    at = stops - widths
    byte = at >> 3
    three = stream[byte].astype(np.int64) | stream[byte + 1].astype(np.int64) << 8 | stream[byte + 2].astype(np.int64) << 16
    return three >> (at & 7) & ((1 << widths) - 1), stops


def strings(codes: np.ndarray, clear: int, most: int) -> np.ndarray:
    """The samples, `most` at most, of the codes between two clears.

    The entry that code j completes is what code j - 1 gave and one sample more, so each code is a stretch of the
    output itself. Lengths and samples follow their references by pointer doubling, all codes at once.
    """
    j = np.arange(len(codes))
    refers = codes > clear
    entry = np.where(refers, codes - clear - 2, j)  # the code whose stretch, and one more sample, this one repeats
    # an entry is there once the code after its own has begun; a full table takes no more
    if (entry[refers] >= j[refers]).any():
        raise GifError("code before its entry")
    length, to = refers.astype(np.int64), entry
    while True:
        more = to[to]
        if (more == to).all():
            break
        length, to = length + np.where(to != j, length[to], 0), more
    length += 1
    stops = np.cumsum(length)
    use = int(np.searchsorted(stops, most)) + 1
    codes, refers, entry, length, stops = codes[:use], refers[:use], entry[:use], length[:use], stops[:use]
    if not len(codes):
        return np.zeros(0, np.uint8)
    starts = stops - length
    total = int(min(stops[-1], most))
    shift = np.where(refers, starts - starts[entry], 0)
    source = np.arange(total) - np.repeat(shift, length)[:total]
    while True:
        nearer = source[source]
        if (nearer == source).all():
            break
        source = nearer
    first = np.zeros(total, np.uint8)
    literal = ~refers & (starts < total)
    first[starts[literal]] = codes[literal]
    return first[source]


def unlzw(stream: bytes, least: int, n: int) -> np.ndarray:
    """Samples of an LZW code stream with minimum code size `least`; n of them at most."""
    if not 1 <= least <= 11:
        raise GifError(f"code size {least}")
    clear, end = 1 << least, (1 << least) + 1
    raw = np.frombuffer(stream + b"\0\0", np.uint8)
    widths = code_widths(least)
    out, have, bit, ended = [], 0, 0, False
    while have < n and not ended:
        codes, stops, chunk = np.zeros(0, np.int64), np.zeros(0, np.int64), 512
        while True:  # up to the next clear, end or the stream's end
            j = np.arange(len(codes), len(codes) + chunk)
            more, ends = read_codes(raw, int(stops[-1]) if len(stops) else bit, widths[np.minimum(j, 4095)])
            marks = np.flatnonzero((more == clear) | (more == end))
            codes, stops = np.concatenate([codes, more]), np.concatenate([stops, ends])
            if len(marks):
                at = len(codes) - len(more) + int(marks[0])
                ended, bit, codes = bool(codes[at] == end), int(stops[at]), codes[:at]
                break
            if len(more) < chunk:
                ended = True
                break
            chunk = min(4 * chunk, 1 << 16)
        part = strings(codes, clear, n - have)
        out.append(part)
        have += len(part)
    return np.concatenate(out) if out else np.zeros(0, np.uint8)


def lzw(samples: bytes, least: int = 8) -> bytes:
    """An LZW code stream that grows its table to 4096 entries, then clears it."""
    clear, end = 1 << least, (1 << least) + 1
    codes, table, free = [clear], {}, end + 1
    rest = iter(samples)
    word = next(rest, None)
    put, known = codes.append, table.get
    for sample in rest:
        longer = word << 8 | sample
        code = known(longer)
        if code is not None:
            word = code
            continue
        put(word)
        if free < 4096:
            table[longer] = free
            free += 1
        else:
            put(clear)
            table.clear()
            free = end + 1
        word = sample
    if word is not None:
        put(word)
    put(end)
    codes = np.array(codes, np.int64)
    after = np.arange(len(codes))
    last = np.maximum.accumulate(np.where(codes == clear, after, 0))
    j = after - 1 - np.append(0, last[:-1])  # codes since the clear before
    widths = code_widths(least)[np.clip(j, 0, 4095)]
    stops = np.cumsum(widths)
    at = stops - widths
    value, byte, size = codes << (at & 7), at >> 3, int(stops[-1] + 7) // 8
    out = sum(np.bincount(byte + i, weights=(value >> 8 * i & 255), minlength=size + 2) for i in range(3))
    return out.astype(np.uint8)[:size].tobytes()


def sub_blocks(data: bytes) -> bytes:
    full = len(data) // 255
    rows = np.full((full, 256), 255, np.uint8)
    rows[:, 1:] = np.frombuffer(data, np.uint8, full * 255).reshape(full, 255)
    rest = data[full * 255 :]
    return rows.tobytes() + (bytes([len(rest)]) + rest if rest else b"") + b"\0"


def write(payload: bytes, width: int = WIDTH, frame_rows: int = FRAME_ROWS) -> bytes:
    """A GIF89a whose frames' palette indices are the payload; its length must be a positive multiple of width."""
    rows = len(payload) // width
    if not rows or len(payload) % width:
        raise GifError("payload must be a positive multiple of the width")
    out = [b"GIF89a", struct.pack("<HHBBB", width, min(rows, frame_rows), 0xF7, 0, 0), GREY.tobytes()]
    for at in range(0, rows, frame_rows):
        samples = payload[at * width : (at + frame_rows) * width]
        out += [b"\x21\xf9\x04", struct.pack("<BHB", 1 << 2, DELAY, 0), b"\0", b"\x2c", struct.pack("<HHHHB", 0, 0, width, len(samples) // width, 0), b"\x08", sub_blocks(lzw(samples))]
    return b"".join([*out, b"\x3b"])


def interlaced_rows(height: int) -> np.ndarray:
    return np.concatenate([np.arange(a, height, step) for a, step in ((0, 8), (4, 8), (2, 4), (1, 2))])


def decode(data: bytes) -> Iterator[Frame]:
    """Every frame in turn, composed on the canvas. GifError if the bytes are no whole GIF."""
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        raise GifError("no GIF header")
    view = memoryview(data)
    try:
        yield from _frames(view)
    except (IndexError, struct.error, ValueError) as e:
        raise e if isinstance(e, GifError) else GifError(f"truncated or broken: {e}") from e


def _frames(view: memoryview) -> Iterator[Frame]:
    width, height, flags, _, _ = struct.unpack_from("<HHBBB", view, 6)
    at = 13

    def palette(bits: int) -> np.ndarray:
        nonlocal at
        n = 2 << bits
        if at + 3 * n > len(view):
            raise GifError("palette cut off")
        colours = np.zeros((256, 3), np.uint8)
        colours[:n] = np.frombuffer(view, np.uint8, 3 * n, at).reshape(n, 3)
        at += 3 * n
        return colours

    def blocks() -> bytes:
        nonlocal at
        parts = []
        while n := view[at]:
            if at + 1 + n > len(view):
                raise GifError("block cut off")
            parts.append(view[at + 1 : at + 1 + n])
            at += 1 + n
        at += 1
        return b"".join(parts)

    shared = palette(flags & 7) if flags & 0x80 else None
    canvas = shown = None
    delay, disposal, transparent = 0, 0, None
    while (kind := view[at]) != 0x3B:
        at += 1
        if kind == 0x21:
            label = view[at]
            at += 1
            body = blocks()
            if label == 0xF9:
                packed, delay, index = struct.unpack("<BHB", body[:4])
                disposal, transparent = packed >> 2 & 7, index if packed & 1 else None
        elif kind == 0x2C:
            left, top, w, h, packed = struct.unpack_from("<HHHHB", view, at)
            at += 9
            colours = palette(packed & 7) if packed & 0x80 else shared
            if colours is None:
                raise GifError("no palette")
            least = view[at]
            at += 1
            samples = unlzw(blocks(), least, w * h)
            if len(samples) < w * h:
                raise GifError("too few samples")
            if canvas is None:
                if height * width > max(MOST_PIXELS, 4 * len(samples)):
                    raise GifError(f"canvas of {width} x {height}")
                canvas, shown = np.zeros((height, width, 3), np.uint8), np.zeros((height, width), bool)
            indices = samples.reshape(h, w)
            if packed & 0x40:
                rows = np.empty_like(indices)
                rows[interlaced_rows(h)] = indices
                indices = rows
            before = (canvas.copy(), shown.copy()) if disposal == 3 else None
            box = np.s_[top : top + h, left : left + w]
            part = indices[: max(0, height - top), : max(0, width - left)]
            drawn = part != transparent if transparent is not None else None
            if drawn is None:
                canvas[box], shown[box] = colours[part], True
            else:
                canvas[box][drawn], shown[box] = colours[part][drawn], shown[box] | drawn
            yield Frame(left, top, delay * 10, disposal, transparent, indices, canvas.copy(), shown.copy())
            if disposal == 2:
                canvas[box], shown[box] = 0, False
            elif before:
                canvas, shown = before
            delay, disposal, transparent = 0, 0, None
        else:
            raise GifError(f"unknown block {kind}")


def histogram(colours: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Pixels in each of levels**3 boxes of the colour cube."""
    step = 256 // levels
    c = colours.reshape(-1, 3)
    box = (c[:, 0] // step).astype(np.int64) * levels * levels + (c[:, 1] // step) * levels + c[:, 2] // step
    return np.bincount(box, minlength=levels**3)


def timed(data: bytes) -> Iterator[tuple[int, int, Frame, np.ndarray]]:
    """(number, milliseconds before it, frame, colour histogram of what has been drawn so far) of each frame."""
    at = 0
    for i, frame in enumerate(decode(data)):
        yield i, at, frame, histogram(frame.canvas[frame.shown])
        at += frame.delay_ms


FRAMES = "frame int, at_ms long, delay_ms int, left int, top int, width int, height int, disposal int, transparent int, rgb binary, histogram array<long>"


def frames(media: DataFrame, key: str, column: str) -> DataFrame:
    """The timed frames of a binary column: key, FRAMES and error.

    at_ms is the sum of the delays before; rgb is the composed canvas, rows of three bytes a pixel. The
    histogram leaves out pixels that nothing has drawn. A null or broken file gives one row, with null
    in all but key and error, after the frames that could be read.
    """
    fields = [f.split()[0] for f in FRAMES.split(", ")]
    schema = f"`{key}` {dict(media.dtypes)[key]}, {FRAMES}, error string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pandas as pd

        for batch in batches:
            for k, data in zip(batch[key], batch[column], strict=True):
                rows = []
                try:
                    for i, at, f, boxes in timed(data.as_py() or b""):
                        h, w, _ = f.canvas.shape
                        rows.append((i, at, f.delay_ms, f.left, f.top, w, h, f.disposal, f.transparent, f.canvas.tobytes(), boxes.tolist(), None))
                except GifError as e:
                    rows.append((*[None] * len(fields), str(e)))
                if rows:
                    df = pd.DataFrame(rows, columns=[*fields, "error"], dtype=object)
                    df.insert(0, key, [k.as_py()] * len(rows))
                    yield pa.RecordBatch.from_pandas(df, schema=target, preserve_index=False)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))
    return media.select(key, column).mapInArrow(run, schema)


def padded(text: bytes, unit: int = WIDTH) -> bytes:
    return text + bytes(max(unit, -(-len(text) // unit) * unit) - len(text))


def stored_text(text: bytes) -> tuple:
    """What the digest columns hold of one text: the payload as the decoder reads it back, and its timed frames' histogram."""
    media = write(padded(text))
    sha, tail, size, ms, total = hashlib.sha256(), b"", 0, 0, np.zeros(LEVELS**3, np.int64)
    for i, at, frame, boxes in timed(media):
        h, w = frame.indices.shape
        box = frame.canvas[frame.top : frame.top + h, frame.left : frame.left + w]
        back = np.ascontiguousarray(box[:, :, 0]).tobytes()  # grey level = index
        sha.update(back)
        tail, size, n, ms = (tail + back)[-64:], size + len(back), i + 1, at + frame.delay_ms
        total += boxes
    boxes = ",".join(f"{i}:{v}" for i, v in enumerate(total.tolist()) if v)
    return len(text), size, sha.hexdigest(), zlib.crc32(tail), len(media), hashlib.sha256(media).hexdigest(), f"frames={n};ms={ms};{boxes}"


TEXT_COLUMNS = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id and TEXT_COLUMNS for every row: each whole text written as a GIF, decoded again and described.

    A null text is empty, and an empty one is 64 zero bytes. Equal texts give equal values. An empty
    table gives no rows; other columns are not read.
    """
    names = ["doc_id", *(c.split()[0] for c in TEXT_COLUMNS.split(", "))]
    kinds = [pa.string() if " string" in c else pa.int64() for c in TEXT_COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [stored_text(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in batch["_text"]]
            cols = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=names)

    return docs.select("doc_id", F.col("text").cast("binary").alias("_text")).mapInArrow(run, f"`doc_id` {dict(docs.dtypes)['doc_id']}, {TEXT_COLUMNS}")
