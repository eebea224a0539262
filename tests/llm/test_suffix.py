import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import suffix
from tests.llm.data import documents, empty


def brute(rows, length):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, sha, left)} over rows (doc_id, text)."""
    key = lambda r: (r[0] is not None, r[0] or 0)
    distinct = sorted(set(rows), key=lambda r: (key(r), r[1] or ""))
    seen, out = set(), {}
    for doc_id, text in distinct:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id, text] = (len(raw), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [prose(rng.randint(10, 80)) for _ in range(8)]
    out = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.15 and out:
            t = rng.choice(out)
            if rng.random() < 0.6:
                at = rng.randint(0, len(t))
                t = t[:at] + rng.choice(["", "x", "new words"]) + t[at + rng.randint(0, 5) :]
        elif kind < 0.25:
            t = rng.choice(["a", "ab", "abc "]) * rng.randint(1, 200)
        else:
            t = prose(rng.randint(0, 120)) + "".join(rng.choice([" ", "\n"]) + rng.choice(passages) + prose(rng.randint(0, 9)) for _ in range(rng.randint(0, 3)))
        out.append(t)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_classes_by_sorting(seed):
    rng = np.random.default_rng(seed)
    text = np.append(rng.integers(1, 4, 3000), 0)
    text[2000:2400] = text[100:500]
    text[2600:2650] = 2
    places, number = suffix.classes(text, 20)
    windows = [tuple(text[p : p + 20]) for p in places]
    for i in range(1, len(places)):
        assert (windows[i] == windows[i - 1] and len(windows[i]) == 20) == (number[i] == number[i - 1]), i
    assert sorted(places) == list(range(len(text)))


@pytest.mark.parametrize("chunk", [64, 1000, 1 << 18])
def test_every_window_in_one_segment_and_equal_windows_by_one_anchor(monkeypatch, chunk):
    monkeypatch.setattr(suffix, "CHUNK", chunk)
    texts = [t.encode() for t in corpus(7, 40)]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    doc, begin, windows, anchor, gram = suffix.segments(raw, offsets)
    got, by_window = Counter(), {}
    for d, b, n, a, g in zip(doc.tolist(), begin.tolist(), windows.tolist(), anchor.tolist(), gram.tolist(), strict=True):
        assert offsets[d] <= b and b + n + 99 <= offsets[d + 1]
        for i in range(b, b + n):
            got[i] += 1
            assert i <= b + a <= i + 100 - suffix.GRAM
            assert by_window.setdefault(raw[i : i + 100].tobytes(), (g, b + a - i)) == (g, b + a - i)
    assert got == Counter(i for d in range(len(texts)) for i in range(offsets[d], offsets[d + 1] - 99))


@pytest.mark.parametrize("seed,bucket_rows,batch", [(1, 500_000, 10_000), (2, 20, 7), (3, 100, 1), (4, 40, 10_000)])
def test_dedup_by_brute_force(spark, monkeypatch, seed, bucket_rows, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    rows = [(i * 7 % 61, t) for i, t in enumerate(corpus(seed))]
    want = brute(rows, 100)
    got = suffix.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), bucket_rows=bucket_rows).collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == {k[0]: v for k, v in want.items()}
    assert sum(v[1] for v in want.values()) > 1000


def test_odd_rows(spark):
    rows, docs = documents(spark, 60)
    want = brute([r[:2] for r in rows], 100)
    got = Counter(tuple(r) for r in suffix.dedup(docs).collect())
    assert got == Counter((r[0], *want[r[:2]]) for r in rows)
    assert suffix.dedup(empty(spark)).collect() == []


def test_other_texts_under_one_id_and_a_null_id(spark):
    a, b = "0123456789" * 11 + "x", "y" + "0123456789" * 11
    got = sorted(suffix.dedup(spark.createDataFrame([(1, a), (1, b), (None, a)], "doc_id long, text string")).collect(), key=str)
    assert sum(r["n_removed"] for r in got) > 200 and next(r for r in got if r["doc_id"] is None)["n_removed"] == 100


def test_deduped_keeps_rows_and_columns(spark):
    text = "é" * 80 + "abc"
    rows = [(1, text, "en"), (2, "z" + text, None), (3, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = suffix.deduped(docs)
    assert got.schema.simpleString() == docs.schema.simpleString()
    left = {r["doc_id"]: r["text"] for r in got.collect()}
    # within 1, all but the first 100 bytes and 2 that only start a window repeat; 2 repeats 1 whole
    first = brute([(1, text), (2, "z" + text)], 100)
    assert len(left[1].encode()) == first[1, text][0] - first[1, text][1] and left[2] == "z" and left[3] is None


def test_a_key_larger_than_one_sort(monkeypatch):
    monkeypatch.setattr(suffix, "SORTED_BYTES", 500)
    rng = random.Random(1)
    common = bytes(rng.choices(b"abcdefgh", k=80))
    raw = [bytes(rng.choices(b"xyz", k=60)) + common + bytes(rng.choices(b"uvw", k=20)) for _ in range(30)]
    raw += raw[:10] + [raw[3][10:]]
    n = len(raw)
    d, t, s, size = suffix.repeats(np.arange(n) % 3 // 3, np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), raw, 100)
    covered = {}
    for a, b, c in zip(d.tolist(), s.tolist(), size.tolist(), strict=True):
        covered.setdefault(a, set()).update(range(b, b + c))
    want = brute([(i, x.decode()) for i, x in enumerate(raw)], 100)
    assert {i: len(covered.get(i, ())) for i in range(n)} == {k[0]: v[1] for k, v in want.items()}


def test_cut_joins_spans():
    left, removed, runs = suffix.cut(b"0123456789", np.array([7, 1, 2]), np.array([2, 3, 2]))
    assert (left, removed, runs) == (b"04569", 5, 2)


def test_arrow_slices():
    batch = pa.RecordBatch.from_arrays([pa.array([b"ab", b"", b"cde"], pa.binary())], names=["x"]).slice(1)
    raw, offsets = suffix.text_column(batch, "x")
    assert raw.tobytes() == b"cde" and offsets.tolist() == [0, 0, 3]
