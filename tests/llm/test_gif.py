import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from quire.llm import gif
from tests.llm.data import documents, empty


@pytest.mark.parametrize("n", [64, 128, 64 * 254, 64 * 255, 64 * 5000])
def test_round_trip(n):
    payload = random.Random(n).randbytes(n // 2) + b"abcabcab" * (n // 16)
    shown = list(gif.decode(gif.write(payload, frame_rows=777)))
    assert b"".join(f.indices.tobytes() for f in shown) == payload
    assert b"".join(f.canvas[: len(f.indices), :, 1].tobytes() for f in shown) == payload


def simple_decoder(stream, least):
    """The textbook decoder, with a table of strings."""
    bits = "".join(f"{b:08b}"[::-1] for b in stream)
    clear, at, out = 1 << least, 0, b""
    table, width, last = {}, least + 1, None
    while at + width <= len(bits):
        code = int(bits[at : at + width][::-1], 2)
        at += width
        if code == clear:
            table, width, last = {i: bytes([i]) for i in range(clear)}, least + 1, None
            n = clear + 2
            continue
        if code == clear + 1:
            break
        word = table[code] if code in table else last + last[:1]
        if last is not None and n < 4096:
            table[n] = last + word[:1]
            n += 1
        if n == 1 << width and width < 12:
            width += 1
        out += word
        last = word
    return out


@pytest.mark.parametrize("least", [2, 3, 8])
def test_lzw_against_the_textbook(least):
    rng = random.Random(least)
    for n in (1, 2, 50, 5000, 60_000):
        samples = bytes(rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
        stream = gif.lzw(samples, least)
        assert simple_decoder(stream, least) == samples
        assert gif.unlzw(stream, least, n).tobytes() == samples


def test_clears_at_any_place():
    """A stream may clear its table whenever it likes, and needs no end."""
    samples = random.Random(7).randbytes(3000)
    bits = ""
    for at in range(0, len(samples), 100):
        bits += f"{256:09b}"[::-1] + "".join(f"{b:09b}"[::-1] for b in samples[at : at + 100])
    stream = bytes(int(bits[i : i + 8][::-1], 2) for i in range(0, len(bits), 8))
    assert simple_decoder(stream, 8) == samples
    assert gif.unlzw(stream, 8, len(samples)).tobytes() == samples
    with pytest.raises(gif.GifError):
        gif.unlzw((256 | 65 << 9 | 300 << 18).to_bytes(4, "little"), 8, 10)


def test_long_runs_and_deferred_clears():
    for samples in (bytes(300_000), b"ab" * 100_000, random.Random(8).randbytes(9000)):
        stream = gif.lzw(samples)
        assert simple_decoder(stream[:4000], 8)[:2000] == samples[:2000]
        assert gif.unlzw(stream, 8, len(samples)).tobytes() == samples
        assert gif.unlzw(stream, 8, 1000).tobytes() == samples[:1000]


def test_a_header_that_claims_any_size():
    data = b"GIF89a" + struct.pack("<HHBBB", 65535, 65535, 0x80, 0, 0) + bytes(6) + b"\x2c" + struct.pack("<HHHHB", 0, 0, 2, 2, 0) + b"\x02" + gif.sub_blocks(gif.lzw(bytes(4), 2)) + b"\x3b"
    with pytest.raises(gif.GifError, match="canvas"):
        list(gif.decode(data))


def picture(parts, size=(4, 4), palette=((0, 0, 0), (255, 0, 0), (0, 255, 0), (0, 0, 255))):
    out = b"GIF89a" + struct.pack("<HHBBB", *size, 0x81, 0, 0) + bytes(c for p in palette for c in p)
    for left, top, rows, disposal, transparent, interlaced in parts:
        h, w = len(rows), len(rows[0])
        out += b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (transparent is not None), 7, transparent or 0) + b"\0"
        order = gif.interlaced_rows(h) if interlaced else range(h)
        out += b"\x2c" + struct.pack("<HHHHB", left, top, w, h, 0x40 * interlaced) + b"\x02"
        out += gif.sub_blocks(gif.lzw(bytes(v for i in order for v in rows[i]), 2))
    return out + b"\x3b"


def test_disposal_transparency_and_interlacing():
    full = [[1, 1, 1, 1], [2, 2, 2, 2], [3, 3, 3, 3], [1, 2, 3, 0]]
    data = picture([(0, 0, full, 1, None, True), (1, 1, [[0, 3], [3, 0]], 3, 0, False), (0, 0, [[2]], 2, None, False), (3, 3, [[1]], 0, None, False)])
    a, b, c, d = gif.decode(data)
    colours = np.array([(0, 0, 0), (255, 0, 0), (0, 255, 0), (0, 0, 255)], np.uint8)
    want = colours[np.array(full)]
    assert (a.canvas == want).all() and a.delay_ms == 70
    want[1, 2] = want[2, 1] = colours[3]
    assert (b.canvas == want).all()
    want = colours[np.array(full)]  # the second frame is taken back
    want[0, 0] = colours[2]
    assert (c.canvas == want).all()
    want[0, 0] = 0  # the third is cleared
    want[3, 3] = colours[1]
    assert (d.canvas == want).all() and not d.shown[0, 0]


def test_frames_table(spark):
    full = [[1, 1], [2, 0]]
    rows = [(1, picture([(0, 0, full, 1, None, False), (0, 0, [[3]], 1, None, False)], (2, 2))), (2, None), (3, b"GIF89a"), (4, gif.write(b"x" * 64)[:-40])]
    got = gif.frames(spark.createDataFrame(rows, "k long, media binary"), "k", "media").orderBy("k", "frame").collect()
    assert [(r["k"], r["frame"], r["at_ms"], r["error"] is None) for r in got] == [(1, 0, 0, True), (1, 1, 70, True), (2, None, None, False), (3, None, None, False), (4, None, None, False)]
    assert sum(got[0]["histogram"]) == 4 and len(got[1]["rgb"]) == 12


def test_store_texts(spark):
    rows, docs = documents(spark, 40)
    rows.append((99, "ä" * 150_000, None, None, 0))
    docs = docs.select("doc_id", "text").union(spark.createDataFrame([rows[-1][:2]], "doc_id long, text string"))
    got = sorted(gif.store_texts(docs).collect(), key=str)
    want = []
    for doc_id, text, *_ in rows:
        raw = (text or "").encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        media = gif.write(payload)
        want.append((doc_id, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest()))
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(want, key=str)
    assert gif.store_texts(empty(spark)).collect() == []
