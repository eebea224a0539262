"""Queries over all rows and whole texts, on small tables."""

import pytest

from quire.plans import catalogue


@pytest.fixture
def table(spark, tmp_path):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def rows_of(spark, name, sf_dir):
    return sorted(tuple(r) for r in catalogue.QUERIES[name](spark, sf_dir).collect())


def test_corrections_in_every_paragraph(spark, table):
    sf = table("documents", [(1, "en", "s", "First nation\n\nSecond station worth it")], "doc_id long, lang string, source string, text string")
    assert rows_of(spark, "safe_corrections", sf) == [(1, 1, "first naxion", 1), (1, 2, "second staxion wrth it", 2)]


def test_clusters_in_every_paragraph(spark, table):
    text = "tion\nno hit\n" + "ab tion" * 3 + " " * 300 + "tion tion"
    sf = table("documents", [(1, "en", "s", text)], "doc_id long, lang string, source string, text string")
    assert rows_of(spark, "dense_cluster", sf) == [(1, 1, 1, 1), (1, 3, 4, 3)]


def test_whole_texts(spark, table):
    table("pages", [(1, "<b>&" * 200)], "page_id long, html string")
    sf = table("documents", [(1, "fr", "\u00c9t\u00e9 " * 200)], "doc_id long, lang string, text string")
    assert rows_of(spark, "html_escape", sf) == [(1, "&lt;b&gt;&amp;" * 200)]
    assert rows_of(spark, "fold_text", sf) == [(1, "fr", "ete " * 200)]


def test_an_entry_for_every_customer(spark, table):
    sf = table("orders", [(c, 100 * c + k) for c in range(1, 21) for k in (2, 1)], "o_custkey long, o_orderkey long")
    want = [(c, f"@misc{{d{c}, title={{Customer {c}}}, year={{1999}}, note={{paras. {100 * c + 1}, {100 * c + 2}}}}}") for c in range(1, 21)]
    assert rows_of(spark, "bibtex_export", sf) == want


def test_ids_of_every_row(spark, table):
    sf = table("part", [(i, "Brand#1", 7, "a b") for i in range(1, 1201)], "p_partkey long, p_brand string, p_size int, p_name string")
    got = rows_of(spark, "document_ids", sf)
    by = {p: d for d, p in got}
    assert len(got) == len(set(by.values())) == 1200 and by[1000] == "a-b-500" and by[1001].startswith("a-b-500-")
    table("orders", [(i, i + 1) for i in range(150)], "o_orderkey long, o_custkey long")
    assert rows_of(spark, "dotted_ids", sf) == [(i, f"{(i + 1) % 7},{i % 11},3") for i in range(150)]
