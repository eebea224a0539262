import zlib
from array import array
from collections import Counter

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from quire.llm import language, mixing, packing
from tests.llm.data import documents, empty
from tests.llm.test_simhash import jaccard
from tests.llm.test_suffix import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    _, df = documents(spark, 120, repeat=True)
    return df.select(*COLUMNS).cache()


def rows(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_names_and_columns(spark, docs):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "near_duplicates", "repeated_passages", "mixing", "packing"]
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == COLUMNS


def inner_names():
    """Every name that a module of the stages uses for a column, as far as quoted words tell."""
    import inspect
    import re

    from quire.llm import common, packing, simhash, suffix

    words = set()
    for m in (common, language, mixing, packing, simhash, suffix):
        source = inspect.getsource(m)
        words |= set(re.findall(r"[\"'`]([A-Za-z_][A-Za-z_0-9]*)[\"'`]", source)) | set(re.findall(r"\b([a-z_]+) (?:long|int|binary|string|double|boolean)\b", source))
    return sorted({w.lower() for w in words} - set(COLUMNS))


@pytest.mark.parametrize("stage", range(4))
def test_stages_with_clashing_names(spark, stage):
    _, df = documents(spark, 40, repeat=True)
    df = df.select(*COLUMNS)
    names = inner_names()
    assert {"score", "lang_pred", "_id", "doc", "tie", "gone", "_null", "full", "cut_key", "_lang"} <= set(names)
    extra = df.select(*COLUMNS, *(F.lit(i).alias(n) for i, n in enumerate(names)))
    got = pipeline.STAGES[stage][1](spark, extra, "")
    assert got.columns == extra.columns
    plain = pipeline.STAGES[stage][1](spark, df, "")
    assert rows(got) == rows(plain)
    assert all(r[n] == i for r in got.select(*names).distinct().collect() for i, n in enumerate(names))


def test_language_stage(spark, docs):
    got = rows(pipeline.language_id(spark, docs, ""))
    want = Counter((r["doc_id"], r["text"], r["source"]) for r in docs.collect() if language.has_letter(r["text"]))
    assert Counter((k[0], k[1], k[3]) for k in got.elements()) == want
    assert {k[2] for k in got} <= {"en", "fr", "de", "es"}


def test_near_duplicate_stage(spark, docs):
    every = docs.collect()
    root = list(range(len(every)))
    for i, a in enumerate(every):
        for j, b in enumerate(every[:i]):
            if jaccard(a["text"], b["text"]) >= 0.8:
                root = [root[j] if r == root[i] else r for r in root]
    least = {}
    for r, g in zip(every, root, strict=True):
        if r["doc_id"] is not None:
            least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    got = [r["doc_id"] for r in pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted(x for x in got if x is not None) == sorted(least.values())


def test_passage_stage(spark, docs):
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], 100)
    for r in pipeline.repeated_passages(spark, docs, "").collect():
        options = [v for k, v in want.items() if k[0] == r["doc_id"]]
        assert any((r["text"] is None) or len(r["text"].encode()) <= v[0] - v[1] for v in options)


def test_mixing_stage(spark, docs):
    once = docs.dropDuplicates(["doc_id"])
    con = duckdb.connect()
    con.register("documents", once.toArrow())
    want = {r[0] for r in con.sql(mixing.oracle(max_epochs=1)).fetchall()}
    assert {r["doc_id"] for r in pipeline.mixing_stage(spark, once, "").collect()} == want


def test_packing_stage(spark, docs):
    tokenizer = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((r["doc_id"], len(tokenizer.id_bytes(r["text"] or "")) // 4 + 1, zlib.crc32(tokenizer.id_bytes(r["text"] or "") + array("I", [2]).tobytes())) for r in docs.collect())
    assert Counter((r["doc_id"], r["length"], r["ids_crc32"]) for r in pipeline.pack(spark, docs, "").collect()) == want


def test_run_equals_the_stages_one_by_one(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = pipeline.run(spark, str(tmp_path))
    step = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, step, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        step = spark.read.parquet(f"{tmp_path}/{i}")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert Counter(tuple(r[c] for c in names) for r in got.collect()) == Counter(tuple(r[c] for c in names) for r in step.collect())


def test_empty(spark, tmp_path):
    empty(spark).select(*COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []
