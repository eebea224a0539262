import re
from collections import Counter

import pytest

from quire.llm import quality
from tests.llm.data import documents, empty, texts


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_stats_by_brute_force():
    for t in [*texts(80), "a b c a b c", "a a a a", "x\nx\n x\n\n\nx", "#*$%&|<> é#", "a\x1cb c\x85d", "a b"]:
        assert quality.text_stats((t or "").encode()) == brute(t)


@pytest.mark.parametrize("bound", [0.3, 1.0, 9.0])
def test_judge(spark, bound):
    rows, docs = documents(spark, 80)
    got = Counter(tuple(r) for r in quality.judge(docs, max_rate=0.6, bound=bound).select("doc_id", *quality.STATS, "host", "base_failed", "kept").collect())
    stats = [(r[0], *brute(r[1]), r[3]) for r in rows]
    failed = [s[1] < 50 or 100 * s[5] > 50 * s[1] for s in stats]
    n, k = Counter(s[6] for s in stats), Counter(s[6] for s, f in zip(stats, failed, strict=True) if f)
    rates = [k[h] / n[h] for h in n]
    mean = sum(rates) / len(rates)
    var = sum((x - mean) ** 2 for x in rates) / (len(rates) - 1)
    weight = mean * (1 - mean) / var - 1 if 0 < var < mean * (1 - mean) else len(rows)
    rate = {h: (k[h] + mean * weight) / (n[h] + weight) for h in n}
    bad = {h: r > 0.6 or r > mean + bound * (r * (1 - r) / (n[h] + weight + 1)) ** 0.5 for h, r in rate.items()}
    assert bound != 0.3 or any(bad.values())
    assert got == Counter((*s, f, not f and not bad[s[6]]) for s, f in zip(stats, failed, strict=True))


def test_host_takes_its_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "bad", f"h{i % 40}") for i in range(400) if i % 40 == 0] + [(i, good, f"h{i % 40}") for i in range(400) if i % 40] + [(1000, good, "h0")]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not got[1000] and all(got[i] == bool(i % 40) for i in range(400))


def test_a_host_above_the_corpus_fails_in_the_query(spark):
    from quire.llm.queries import op9_quality

    got = op9_quality(spark, "/root/testdata/sf0.01").collect()
    assert any(not r["kept"] and not r["base_failed"] for r in got) and sum(r["kept"] for r in got) > 0.75 * len(got)


@pytest.mark.parametrize("text", ["bad", " ".join(f"w{i}" for i in range(60))])
def test_one_host(spark, text):
    got = quality.judge(spark.createDataFrame([(1, text, None)], "doc_id long, text string, source string")).collect()
    assert got[0]["kept"] == (text != "bad")


def test_empty(spark):
    assert quality.judge(empty(spark)).collect() == []
