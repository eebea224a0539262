import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import language
from tests.llm.data import documents, empty

SF = "/root/testdata/sf0.01"


def test_svm_separates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 5))
    y = np.where(x @ [1, -2, 0.5, 0, 1] > 0.3, 1.0, -1.0)
    w = language.train_svm(x, y, cost=100, rounds=300)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.label(docs).join(docs.select("doc_id", "lang", F.length("text").alias("n")), "doc_id").collect()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    tested = [r for r in got if r["held_out"] and r["n"] >= 40]
    assert np.mean([r["lang"] == r["lang_pred"] for r in tested]) > 0.95


def test_odd_rows(spark):
    rows, docs = documents(spark)
    got = language.label(docs).collect()
    assert len(got) == len(rows)
    by_text = {}
    letters = {r[0]: any(c.isalpha() for c in r[1] or "") for r in rows}
    for r in got:
        assert (r["lang_pred"] == "und") == (not letters[r["doc_id"]]) and 0 <= r["score"] <= 1
        text = next(x[1] for x in rows if x[0] == r["doc_id"])
        assert by_text.setdefault(text, (r["lang_pred"], r["score"])) == (r["lang_pred"], r["score"])
    assert language.label(empty(spark)).collect() == []
    assert {r["lang_pred"] for r in language.label(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


@pytest.mark.parametrize("n", [language.PIECE - 1, language.PIECE, 3 * language.PIECE + 5])
def test_long_texts_are_read_whole(n):
    text = ("le chat noir " * (n // 13 + 1))[:n].encode()
    whole = language.TABLE[np.frombuffer(b" " + text + b" ", np.uint8)].astype(np.uint32)
    code = (((whole[:-2] << 16) | (whole[1:-1] << 8) | whole[2:]) * np.uint32(2654435761)) >> np.uint32(32 - language.BITS)
    counts = np.sqrt(np.bincount(code, minlength=1 << language.BITS))
    assert np.allclose(language.features(text), counts / np.linalg.norm(counts))


def plain_features(text):
    """Trigram counts by hand: letters lower-cased, other ASCII as a space, bytes above as they are."""
    raw = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in b" " + text.encode() + b" "]
    counts = {}
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        k = (((a << 16 | b << 8 | c) * 2654435761) & 0xFFFFFFFF) >> 32 - language.BITS
        counts[k] = counts.get(k, 0) + 1
    return {k: (n / sum(counts.values())) ** 0.5 for k, n in counts.items()}


def plain_vote(model, v):
    names = model["names"]
    wins, sums = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
    sure = dict.fromkeys(names, 1.0)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    for (a, b), w in zip(pairs, model["w"], strict=True):
        m = sum(x * w[k] for k, x in v.items()) + w[-1]
        wins[a if m >= 0 else b] += 1
        sums[a] += m
        sums[b] -= m
        p = 1 / (1 + math.exp(-4 * m))
        sure[a], sure[b] = min(sure[a], p), min(sure[b], 1 - p)
    best = max(names, key=lambda n: (wins[n], sums[n], [-ord(c) for c in n]))
    return best, sure[best]


def test_predictions_by_a_plain_hierarchy(spark):
    """Family by votes of all pairs of families, then the language by votes of all pairs within it."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    more = [(10_000 + i, t, lang) for i, (t, lang) in enumerate([("kieli on suomi " * 9, "fi"), ("ez magyar nyelv " * 9, "hu"), ("ez szép ház " * 9, "hu"), (None, "fi"), ("1 2 3", "fi"), ("", None)] * 4)]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"))
    model = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    assert set(model["families"]["names"]) == {"germanic", "romance", "other"} and model["within"]["other"]["names"] == ["fi", "hu"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.label(docs).collect()}
    for r in docs.collect():
        want = ("und", 0.0)
        if r["text"] and any(c.isalpha() for c in r["text"]):
            v = plain_features(r["text"])
            family, sure = plain_vote(model["families"], v)
            lang, surer = plain_vote(model["within"][family], v)
            want = (lang, sure * surer)
        assert got[r["doc_id"]][0] == want[0] and got[r["doc_id"]][1] == pytest.approx(want[1], abs=1e-6)


def test_dirty_labels_are_bounded(spark):
    rows = [(i, f"word{i % 300} of label {i % 300}", f"l{i % 300}") for i in range(900)] + [(1000 + i, f"the text {i}", "en") for i in range(50)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), languages=5)
    known = [n for m in model["within"].values() for n in m["names"]]
    assert len(known) == 5 and "en" in known


def test_copies_leave_room_for_other_texts(spark):
    rows = [(i, "one text again and again", "en") for i in range(3000)] + [(5000 + i, f"another text {i}", "en") for i in range(30)] + [(9000, "une phrase", "fr")]
    seen = []
    fit = language.fit
    language.fit = lambda x, langs: seen.append((x, langs)) or fit(x, langs)
    try:
        language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    finally:
        language.fit = fit
    assert sum(seen[0][1] == "en") == 31
