import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.functions import rules, text, urlstate
from quire.operators import blocks, corpus, facets, joins, ocr, search, sequences, sets
from quire.sources import docx, readers, writers
from quire.streaming import events


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


def test_years(spark):
    df = spark.createDataFrame([(2000,), (2010,), (None,)], "y int")
    assert {r["y"] for r in df.where(search.year_between(F.col("y"), 2000, 2005)).collect()} == {2000, None}
    assert {r["y"] for r in df.where(search.year_between_strict(F.col("y"), 2000, 2005)).collect()} == {2000}
    assert df.where(search.year_between_strict(F.col("y"), 2000, None)).count() == 3


def test_labels_any_and_all(spark):
    df = spark.createDataFrame([([],), (["A"],), (["A", "B"],)], "l array<string>")
    assert df.where(search.any_of(F.col("l"), ["A", "B"])).count() == 2
    assert df.where(search.all_of(F.col("l"), ["A", "B"])).count() == 1


def test_footnotes_match_but_do_not_score(spark):
    df = spark.createDataFrame([("body", "a note on Sanjuán"), ("sanjuan body", "")], "body string, note string")
    got = {r["body"]: r["score"] for r in search.search(df, "sanjuan", notes="note").collect()}
    assert got["body"] == search.FLOOR and got["sanjuan body"] > search.FLOOR


def test_empty_corpus(spark):
    df = spark.createDataFrame([], "body string")
    assert search.search(df, "a b").collect() == [] and corpus.paragraphs(spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "doc_id int, text string")).collect() == []


def test_occurrences_do_not_overlap(spark):
    assert one(spark, text.occurrences(F.lit("aaaa"), "aa")) == 2


@pytest.mark.parametrize("ids,want", [
    (["4.4", "4.2", "4.3"], ["4.1", "4.2", "4.3"]), (["3.7", "3.6", "3.9"], ["3.7", "3.8", "3.9"]), (["5.1", "5.2", "8.3", "5.4"], ["5.1", "5.2", "5.3", "5.4"]),
    (["2.20", "2.11", "2.12"], ["2.10", "2.11", "2.12"]), (["3.7", "3.12", "3.9"], ["3.7", "3.12", "3.9"]), (["1.1", "4.4.", "4.2.", "4.3."], ["1.1", "4.1.", "4.2.", "4.3."]),
    ([], []), ([None, "x"], [None, "x"]), (["1.1", "1.2"], ["1.1", "1.2"]),
])
def test_repaired_ids(ids, want):
    assert sequences.repair_ids(ids) == want


def test_repairs_stay_within_a_section():
    assert sequences.repair_ids(["4.4", "4.2", "4.3"], ["facts", "law", "law"]) == ["4.4", "4.2", "4.3"]
    assert sequences.repair_ids(["4.4", "4.2", "4.3"], ["law", "law", "law"]) == ["4.1", "4.2", "4.3"]


def test_repairs_of_documents_are_those_of_lists(spark):
    """Runs of misread parents, three rounds, sections, other shapes and digits: by windows as by repair_ids, without a call of Python for each document."""
    docs = [
        ["5.2", "8.3", "5.4", "8.5", "5.6", "8.7", "5.8"], ["4.4", "4.2", "4.3"], ["1.1", "4.4.", "4.2.", "4.3."], ["9.9", "3.8", "3.7", "3.3", "3.4"], ["5.1", "5.2", "8.3", "5.4", "5.9", "5.6"],
        ["05.01", "8.2..", "5.03"], ["5.1", None, "5.3"], ["5.1", "8.²", "5.3"], ["5.1", "8.2\n", "5.3"], ["٥.١", "٨.٢", "٥.٣"], ["2.1", "x", "", ".", "2.", "2.3.4"], ["0.1", "8.2", "0.3"], ["5.1"],
    ]
    docs += [[f"{5 if (d >> i) % 3 else 8}.{(d * 7 + i * i) % 9 if (d >> i) % 4 == 1 else i + 1}" for i in range(9)] for d in range(300)]
    parts = [[("a", "a", "b", "", None)[(d + i) % 5 if d % 3 else 0] for i in range(len(ids))] for d, ids in enumerate(docs)]
    rows = spark.createDataFrame([(d, i, x, s) for d, ids in enumerate(docs) for i, (x, s) in enumerate(zip(ids, parts[d], strict=True))], "doc int, place int, number string, part string").repartition(5)
    for section in (None, "part"):
        fixed = sequences.repaired(rows, "doc", "place", "number", section)
        got = {(r["doc"], r["place"]): r["fixed"] for r in fixed.collect()}
        assert got == {(d, i): x for d, ids in enumerate(docs) for i, x in enumerate(sequences.repair_ids(ids, parts[d] if section else None))}
        assert "Pandas" not in fixed._jdf.queryExecution().toString()


@pytest.mark.parametrize("raw,want", [("Việt Nam", "viet nam"), ("Timișoara", "timisoara"), ("cafe\u0301", "cafe"), ("Ελλάδα", "ελλαδα"), ("Ångström ŁÓDŹ", "angstrom łodz"), ("plain", "plain")])
def test_folding(spark, raw, want):
    assert one(spark, text.fold(F.lit(raw))) == want == text.fold_literal(raw)


def test_highlights_beside_tags_and_with_any_accent(spark):
    page = '<a href="the">The</a> Thé cafe\u0301s <b title=the>x</b>'
    assert one(spark, text.highlight(F.lit(page), ["the", "café"])) == '<a href="the"><mark>The</mark></a> <mark>Thé</mark> <mark>cafe\u0301</mark>s <b title=the>x</b>'
    assert one(spark, text.first_place(F.lit("e\u0301te\u0301 worth"), "worth")) == 7


@pytest.mark.parametrize("title,body,want", [
    ("No violation of article 14", "", "no_violation"), ("VIOLATION of article 7", "", "violation"), ("Inadmissible communication", "", "inadmissible"),
    ("x", "The facts before it do not disclose a violation of article 7", "no_violation"), ("x", "y " * 300 + "The case is discontinued. Individual opinion of a member: a violation", "discontinued"),
    ("x", "Individual opinion on top. " + "y " * 300 + "There was a violation.", "violation"), (None, None, "unknown"),
])
def test_outcomes(spark, title, body, want):
    assert one(spark, rules.outcome(F.lit(title).cast("string"), F.lit(body).cast("string"))) == want


def test_operators_are_whole_words():
    from quire.plans import textql

    assert textql.parse("AT&T") == textql.Node("word", "at&t") and textql.parse("a|b c") == textql.Node("and", parts=(textql.Node("word", "a|b"), textql.Node("word", "c")))
    assert textql.parse("a & b") == textql.parse("a AND b") and textql.parse('x"y') == textql.Node("word", 'x"y')


def test_tables_kept_by_key(spark, tmp_path):
    path = str(tmp_path / "kept")
    first = writers.cached(spark.range(3), path, "one")
    assert first.count() == 3 and writers.cached(spark.range(9), path, "one").count() == 3
    assert writers.cached(spark.range(9), path, "two").count() == 9
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "k int, s string")
    writers.write_shards(df, str(tmp_path / "shards"), ["s"])
    assert readers.shards(spark, str(tmp_path / "shards"), "s", ["b"]).count() == 2 and readers.shards(spark, str(tmp_path / "shards"), "s").count() == 3


def test_titles(spark):
    assert one(spark, text.mandate_label(F.lit("Special Rapporteur on the situation of human rights in a place"))) == "situation & human rights…"
    assert one(spark, text.mandate_label(F.lit("Independent Expert on older persons"))) == "Independent Expert on…"
    assert one(spark, text.public_title([F.lit(" N/A "), F.lit("x")], F.lit("S"), F.lit("C"))) == "x" and one(spark, text.public_title([F.lit("")], F.lit("S"), F.lit(""))) == "S"


def test_holders(spark):
    holders = spark.createDataFrame([(1, 2020, "A"), (1, 2023, "B"), (1, 9999, "C")], "m int, u int, h string")
    rows = spark.createDataFrame([(1, 2020), (1, 2021), (1, 2024), (2, 2020)], "m int, y int")
    got = {(r["m"], r["y"]): r["h"] for r in joins.as_of(rows, holders, ["m"], "y", "u", "h").collect()}
    assert got == {(1, 2020): "A", (1, 2021): "B", (1, 2024): "C", (2, 2020): None}


def test_upsert(spark):
    old = spark.createDataFrame([(1, 10, 100), (2, 10, 100), (3, 10, 100)], "k int, s int, w int")
    new = spark.createDataFrame([(1, 20, 0), (2, 19, 0), (4, 1, 1), (3, 0, 1100)], "k int, s int, w int")
    assert {r["k"]: r["action"] for r in joins.upsert(old, new, "k", "s", "w").collect()} == {1: "replace", 2: "skip", 3: "replace", 4: "insert"}


def test_cluster(spark):
    df = spark.createDataFrame([(1, p) for p in (0, 500, 550, 600)], "k int, p int")
    assert tuple(sequences.densest(df, ["k"], "p").first()) == (1, 500, 3)


def test_unique_keys(spark):
    a, b = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (3, "w")], "k int, a string"), spark.createDataFrame([(1, 1), (2, 2), (3, 3), (3, 4)], "k int, b int")
    assert [tuple(r) for r in joins.unique_key_join(a, b, "k").collect()] == [(2, "z", 2)]


def test_sections(spark):
    df = spark.createDataFrame(list(enumerate("AABA")), "i int, s string").withColumn("d", F.lit(1))
    assert sequences.outline(df, ["d"], "i", "s").count() == 3


def test_suffix_join_prefers_the_same_name(spark):
    files = spark.createDataFrame([("b.json",), ("c.json",), ("z.json",)], "file string")
    meta = spark.createDataFrame([("a_b.json", 1), ("b.json", 2), ("x_y_c.json", 3)], "name string, v int")
    got = {r["file"]: r["v"] for r in joins.suffix_join(files, meta, "file", "name").collect()}
    assert got == {"b.json": 2, "c.json": 3, "z.json": None}


def test_document_ids(spark):
    rows = [("A/1", "file one"), ("A/2", "file two"), ("A/2", "file three"), (None, "É x"), ("a 1", "other")]
    got = {r["stem"]: r["docId"] for r in corpus.document_ids(spark.createDataFrame(rows, "sig string, stem string"), "sig", "stem").collect()}
    assert got["file two"] == "file-two" and got["É x"] == "e-x" and len(set(got.values())) == 5


def test_self_excluding_sums(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "p string, q string")
    got = {(r["facet"], r["value"]): r["n"] for r in facets.self_excluding(df, {"p": (F.col("p"), F.col("p") == "a"), "q": (F.col("q"), F.col("q") == "x")}, F.lit(True)).collect()}
    assert got == {("p", "a"): 1, ("p", "b"): 1, ("q", "x"): 1, ("q", "y"): 1}


@pytest.mark.parametrize("raw,want", [("exam-\nple and\nmore  x", "example and more x"), ("A-\nB", "A- B"), ("", "")])
def test_dehyphenate(spark, raw, want):
    assert one(spark, text.dehyphenate(F.lit(raw))) == want


def test_small_scalars(spark):
    assert one(spark, text.drop_note_digits(F.lit('It ended.12 The next "one"3 Then'))) == 'It ended. The next "one" Then'
    assert one(spark, text.escape_tex(F.lit("a&b\\c^~"))) == r"a\&b\textbackslash{}c\textasciicircum{}\textasciitilde{}"
    assert one(spark, text.escape_csv(F.lit('a"b,c'))) == '"a""b,c"' and one(spark, text.escape_csv(F.lit("plain"))) == "plain"
    assert one(spark, text.doc_id_of(F.lit("a-b-0012"))) == "a-b" and one(spark, text.doc_id_of(F.lit("a-b"))) is None
    assert one(spark, text.drop_running_lines(F.lit("Page 1\nx\nPage 2"), "^Page [0-9]+$")) == "x"
    assert [one(spark, text.ordinal(F.lit(n))) for n in (1, 2, 3, 4, 11, 12, 13, 21, 112)] == ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "112th"]
    assert one(spark, text.slugify(F.lit("  Éa -- B/c "))) == "ea-b-c"
    assert one(spark, text.highlight(F.lit("Tion tions"), ["tion", "tions"])) == "<mark>Tion</mark> <mark>tions</mark>"
    assert one(spark, text.year_of(F.lit("A/99/2007x"))) == 2007 and one(spark, text.leading_int(F.lit("12. x"))) == 12
    assert one(spark, text.sentence_snippet(F.lit("First. " + "x" * 2000), F.lit(3))).startswith("First. x")
    assert one(spark, sequences.common_depth(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("a"), F.lit("c")))) == 1


def test_outcome_reads_title_then_tail(spark):
    title = F.lit("decision")
    assert one(spark, rules.outcome(F.lit("declared inadmissible"), F.lit("violation of x"))) == "inadmissible"
    assert one(spark, rules.outcome(title, F.concat(F.lit("violation of x "), F.repeat(F.lit("y"), 30_000)))) == "unknown"
    assert one(spark, rules.outcome(title, F.concat(F.repeat(F.lit("y"), 30_000), F.lit(" discloses a violation")))) == "violation"


def test_ocr(spark):
    df = spark.createDataFrame([(1, "a", 80.0), (1, "b", 80.0), (2, "c", 1.0)], "p int, n string, s double")
    assert {r["p"]: r["n"] for r in ocr.best_candidate(df, ["p"], "s", "n").collect()} == {1: "a", 2: "c"}
    assert one(spark, ocr.warnings(F.lit(10.0), F.lit(10), F.lit(1))) == ["low confidence", "little text", "numbers out of order"]


def test_last_wins(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, v int, x string")
    assert {r["k"]: r["x"] for r in sets.last_wins(df, ["k"], [F.col("v")], ["x"]).collect()} == {1: "b", 2: "c"}


def test_json_scan_keeps_bad_files_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"ID": "1", "Text": "x", "Labels": ["L"]}, {"ID": 2, "Text": "y"}]')
    (tmp_path / "b.json").write_text('{"not": "a list"')
    good, bad = readers.json_paragraphs(spark, str(tmp_path))
    assert [(r["file"], r["pos"], r["ID"], r["Labels"]) for r in good.orderBy("pos").collect()] == [("a.json", 0, "1", ["L"]), ("a.json", 1, "2", None)]
    assert [r["file"] for r in bad.collect()] == ["b.json"]


def test_lines_csv_tsv(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1}\n\n{"k": 2}\n')
    (tmp_path / "a.csv").write_text(' K ,V\n1,"a ""q"", b"\n')
    (tmp_path / "a.tsv").write_text('k\tv\n1\ta "b\n')
    assert sorted(r["k"] for r in readers.json_lines(spark, str(tmp_path / "a.jsonl"), "k int").where("k is not null").collect()) == [1, 2]
    assert tuple(readers.csv_table(spark, str(tmp_path / "a.csv")).first()) == ("1", 'a "q", b')
    assert tuple(readers.csv_table(spark, str(tmp_path / "a.tsv"), tabs=True).first()) == ("1", 'a "b')
    assert readers.preferred_path(spark, [str(tmp_path / "no"), str(tmp_path)]) == str(tmp_path)
    assert readers.decoded("é".encode("cp1252")) == "é"


def test_spreadsheet_rows(spark):
    df = spark.createDataFrame([("1.0", "x"), ("a", "y"), (None, "z"), ("2", None)], "ID string, Text string")
    assert [(r["ID"], r["Text"]) for r in readers.paragraph_rows(df).collect()] == [("1", "x"), ("a", "y")]


def test_html_paragraphs(spark):
    page = "<html><head><title>t</title></head><body><h1>Head &amp; x</h1><script>no()</script><p>One<br>two</p><nav>skip</nav><div>three <b>bold</b></div></body>"
    got = readers.html_paragraphs(spark.createDataFrame([(1, page), (2, None), (3, "<p>open")], "page_id int, html string")).orderBy("page_id", "idx").collect()
    assert [(r["page_id"], r["text"], r["is_heading"]) for r in got] == [(1, "Head & x", True), (1, "One two", False), (1, "three bold", False), (3, "open", False)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x,y"), (2, "b", None)], "k int, g string, t string")
    writers.write_shards(df, str(tmp_path / "s"), ["g"])
    writers.write_shards(df.where("g = 'a'"), str(tmp_path / "s"), ["g"])
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1
    writers.write_back(df, str(tmp_path / "w"), "g")
    writers.write_back(df.where("g = 'a'").withColumn("k", F.lit(9)), str(tmp_path / "w"), "g")
    assert {(r["k"], r["g"]) for r in spark.read.parquet(str(tmp_path / "w")).collect()} == {(9, "a"), (2, "b")}
    writers.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    writers.write_csv(df, str(tmp_path / "c"), df.columns)
    assert readers.csv_table(spark, str(tmp_path / "c")).where("t = 'x,y'").count() == 1
    df.write.parquet(str(tmp_path / "a"))
    assert writers.append_checked(spark.createDataFrame([(2, "b", "n"), (3, "c", "n")], df.schema), str(tmp_path / "a"), "k") == 1
    with pytest.raises(ValueError):
        writers.append_checked(spark.createDataFrame([(5, "b", "n"), (5, "c", "n")], df.schema), str(tmp_path / "a"), "k")


def test_streams_equal_batches(spark):
    sf = "/root/testdata/sf0.001"
    batch = events.tumbling(readers.tables(spark, sf, "events"), "1 day").collect()
    assert sorted(map(tuple, batch)) == sorted(map(tuple, events.streamed_tumbling(spark, sf).collect()))


def test_deduplicated_stream(spark):
    name = "dedup_test"
    s = events.deduplicated(events.stream(spark, "/root/testdata/sf0.001/events.parquet*", "40 days"), ["user_id", "event_type"])
    q = s.select("user_id", "event_type").writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.table(name).collect()
    assert len(got) == len(set(got)) == readers.tables(spark, "/root/testdata/sf0.001", "events").select("user_id", "event_type").distinct().count()


def test_recent_queries(spark):
    typed = [(0.0, "w"), (0.5, "wo"), (1.0, "worth"), (5.0, "worth it"), (9.0, "other"), (13.0, "x")]
    assert events.collapse_recent(typed) == ["other", "worth it"]
    df = spark.createDataFrame(pd.DataFrame([(1, *q) for q in typed], columns=["u", "at", "q"]))
    assert [r["query"] for r in events.recent(df, "u", "at", "q").orderBy("place").collect()] == ["other", "worth it"]


def archive(body, notes=""):
    import io
    import zipfile

    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body>{body}</w:body></w:document>")
        if notes:
            z.writestr("word/footnotes.xml", f"<w:footnotes {w}>{notes}</w:footnotes>")
    return out.getvalue()


def test_docx(spark, tmp_path):
    body = (
        "<w:p><w:r><w:t>Before</w:t></w:r></w:p><w:p><w:pPr><w:pStyle w:val='Heading1'/></w:pPr><w:r><w:t>Facts</w:t></w:r></w:p>"
        "<w:p><w:r><w:t>One</w:t><w:footnoteReference w:id='2'/><w:t> two</w:t><w:footnoteReference w:id='2'/><w:footnoteReference w:id='9'/></w:r></w:p><w:p/>"
    )
    notes = "<w:footnote w:id='-1'><w:t>x</w:t></w:footnote><w:footnote w:id='2'><w:p><w:r><w:t> A  note </w:t></w:r></w:p></w:footnote>"
    (tmp_path / "a.docx").write_bytes(archive(body, notes))
    (tmp_path / "b.docx").write_bytes(b"no archive")
    got = docx.docx_paragraphs(spark, str(tmp_path)).orderBy("file", "idx").collect()
    assert [tuple(r)[1:6] for r in got[:2]] == [(1, None, "Before", [], []), (2, "Facts", "One[[fn:2]] two[[fn:2]]", [2], ["A note"])]
    assert got[2]["file"] == "b.docx" and got[2]["error"]


def test_article_numbers(spark):
    raw = "Articles 2, 3 (1) (a) and 14; art. 7, or 9. Article 3 again, articles 120 to 121; the art 5th"
    assert one(spark, text.article_numbers(F.lit(raw))) == ["2", "3", "14", "7", "9", "3", "120", "121", "5"]
    assert one(spark, text.plausible_articles(text.article_numbers(F.lit(raw)), cap=4)) == ["2", "3", "14", "7"]


def test_line_rules(spark):
    assert one(spark, text.drop_table_leaks(F.lit("a b\n5 1 1 1 1 1 10 20 30 40 95.5 word\nc"))) == "a b\nc"
    assert one(spark, text.trailing_heading(F.lit("It ended.\nThe merits"))) == "The merits" and one(spark, text.trailing_heading(F.lit("It ended."))) is None
    assert [one(spark, blocks.is_heading(F.lit(x))) for x in ("IV. Facts", "THE FACTS", "A. Claims", "The facts are.", "Plain words")] == [True, True, True, False, False]
    assert [one(spark, blocks.is_signature(F.lit(x))) for x in ("(Signed) A", "____", "design")] == [True, True, False]
    assert one(spark, text.clean_list(F.lit("a; b., a,\n ;c "))) == ["a", "b", "c"] and one(spark, text.symbol_key(F.lit(" a/ 1. "))) == "A/1"


def test_url_state():
    state = {"q": "a b|c", "labels": ["x", "y"], "from": 2000, "scope": "all"}
    assert urlstate.decode(urlstate.encode(state)) == urlstate.DEFAULTS | state
    assert urlstate.encode({}) == "" and urlstate.decode("?from=x&zz=1") == urlstate.DEFAULTS


def test_workspace_kinds(spark):
    df = spark.createDataFrame([(2, "B_", "t2", None), (1, "A", "t1", "n&")], "id int, title string, text string, note string")
    assert writers.workspace(df, "md").first()["text"] == "- **A** t1\n  > n&\n- **B_** t2"
    assert writers.workspace(df, "tex").first()["text"] == "\\item A: t1 \\emph{n\\&}\n\\item B\\_: t2"
    assert writers.workspace(df, "json").first()["text"].splitlines()[0] == '{"id":1,"title":"A","text":"t1","note":"n&"}'


def test_numbered_lines(spark):
    rows = [(1, 1, "Header"), (1, 2, "1. First"), (1, 3, "goes on"), (1, 4, "2.1 Second")]
    got = blocks.numbered(spark.createDataFrame(rows, "d int, i int, t string"), ["d"], "i", "t").orderBy("n").collect()
    assert [(r["n"], r["text"]) for r in got] == [("1", "First goes on"), ("2.1", "Second")]
