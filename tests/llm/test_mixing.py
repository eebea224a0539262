from collections import Counter, defaultdict

import duckdb
import pytest

from quire.llm import mixing
from tests.llm.data import documents, empty


def fill(budget, nodes):
    """Integers by repeated rounds: nodes that can't take their share are given their cap, the others share anew."""
    given, left, open_ = {}, budget, dict(nodes)
    while open_:
        total = sum(w for _, w in open_.values())
        full = {k for k, (cap, w) in open_.items() if cap * total <= w * left}
        if not full:
            order, up = sorted(open_, key=lambda k: (open_[k][0] / open_[k][1], k)), 0
            for k in order:
                w = open_[k][1]
                given[k] = (up + w) * left // total - up * left // total
                up += w
            return given
        for k in full:
            given[k] = open_.pop(k)[0]
            left -= given[k]
    return given


@pytest.mark.parametrize("percent,epochs", [(60, 3), (5, 1), (100, 1), (250, 3), (400, 3)])
def test_budgets_by_rounds(spark, percent, epochs):
    supply = [(d, lang, s, n) for d, lang, s, n in [("web", "en", "a", 1000), ("web", "en", "b", 10), ("web", "fr", "a", 3), ("books", "en", "c", 700), ("books", "de", "d", 0), ("code", "", "e", 50), ("other", "xx", "f", 9)]]
    got = {tuple(r)[:3]: r["budget"] for r in mixing.budgets(spark.createDataFrame(supply, "domain string, lang string, source string, supply long"), mixing.WEIGHTS, percent, epochs).collect()}
    caps = {s[:3]: s[3] * epochs for s in supply}

    def level(prefix, budget):
        depth = len(prefix)
        names = {k[depth] for k in caps if k[:depth] == prefix}
        nodes = {n: (sum(c for k, c in caps.items() if k[: depth + 1] == (*prefix, n)), mixing.WEIGHTS[mixing.LEVELS[depth]].get(n, 1)) for n in names}
        for n, b in fill(budget, nodes).items():
            if depth == 2:
                want[*prefix, n] = b
            else:
                level((*prefix, n), b)

    want = {}
    budget = sum(s[3] for s in supply) * percent // 100
    level((), budget)
    assert got == want
    assert sum(got.values()) == min(budget, sum(caps.values()))


def test_mix_against_sql(spark):
    rows, docs = documents(spark, 120, repeat=False)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    for percent, epochs in ((60, 3), (10, 2), (300, 3), (500, 2)):
        got = mixing.mix(docs, budget_percent=percent, max_epochs=epochs).collect()
        want = con.sql(mixing.oracle(percent, epochs)).fetchall()
        key = lambda r: (r["doc_id"] if r["doc_id"] is not None else -1, r["domain"], r["lang"], r["source"], r["epoch"], r["n_tokens"], r["take_tokens"])
        clean = lambda v: -1 if v is None or v != v else v
        assert Counter(map(key, got)) == Counter(tuple(map(clean, r)) for r in want)


def test_repeated_rows_and_prefix(spark):
    _, docs = documents(spark, 100)
    got = mixing.mix(docs, budget_percent=130, max_epochs=2).collect()
    taken = defaultdict(int)
    for r in got:
        assert 0 < r["take_tokens"] <= r["n_tokens"] and r["epoch"] in (1, 2)
        taken[r["domain"], r["lang"], r["source"]] += r["take_tokens"]
    assert taken


def test_choose_keeps_rows_whole(spark):
    rows, docs = documents(spark, 100, repeat=False)
    got = mixing.choose(docs, budget_percent=70)
    assert got.columns == docs.columns
    kept = {r["doc_id"] for r in got.collect()}
    once = {r["doc_id"] for r in mixing.mix(docs, budget_percent=70, max_epochs=1).collect()}
    assert kept == once and len(kept) < len(rows)


def test_empty(spark):
    assert mixing.mix(empty(spark)).collect() == []
    assert mixing.choose(empty(spark)).collect() == []
