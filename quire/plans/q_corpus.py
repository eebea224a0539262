"""Titles, annotators, projections, envelopes, gates and audits over the grading tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import rules, text as tx
from quire.operators import corpus, facets, joins, ocr, search, sequences, sets
from quire.plans.base import folded_paras, paras, query
from quire.sources.readers import tables
from quire.sources.writers import csv_file, json_file

SCRIPTS = " Việt Nam, Timișoara, Ελλάδα ΆΈ, café, Ångström, naïve Čeština й"


@query(f"SELECT doc_id, strip_accents(lower(source || '{SCRIPTS} ' || lang)) AS folded FROM documents")
def fold_scripts(spark, sf_dir):
    """Letters of several scripts, composed and decomposed."""
    return tables(spark, sf_dir, "documents").select("doc_id", tx.fold(F.concat("source", F.lit(SCRIPTS + " "), "lang")).alias("folded"))


@query(r"""SELECT doc_id, idx, '<a href="the" title="tion">' || regexp_replace(body, '(t[iíìîï][oóòôöõ][nñ]|th[eéèêë])', '<mark>\1</mark>', 'gi') || '</a>' AS html FROM folded WHERE contains(folded, 'tion')""", paras=True)
def highlight_tags(spark, sf_dir):
    """Terms inside a tag are left alone; accents don't matter."""
    rows = folded_paras(spark, sf_dir).where(F.contains("folded", F.lit("tion")))
    page = F.concat(F.lit('<a href="the" title="tion">'), F.col("body"), F.lit("</a>"))
    return rows.select("doc_id", "idx", tx.highlight(page, ["the", "tion"]).alias("html"))


KEYWORDS = {"connective": ["and", "und", "et", "y"], "article": ["the", "der", "la", "el"], "place": ["new york"]}
KEYWORD_SQL = "list_filter([" + ", ".join("CASE WHEN " + " OR ".join(f"contains(' ' || lower(body) || ' ', ' {w} ')" for w in ws) + f" THEN '{n}' END" for n, ws in sorted(KEYWORDS.items())) + "], lambda x: x IS NOT NULL)"


@query(f"SELECT doc_id, idx, array_to_string({KEYWORD_SQL}, ',') AS labels FROM paras", paras=True)
def keyword_labels(spark, sf_dir):
    return paras(spark, sf_dir).select("doc_id", "idx", F.array_join(rules.keyword_labels(F.col("body"), KEYWORDS), ",").alias("labels"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN c_name WHEN c_custkey % 5 = 1 THEN c_mktsegment ELSE c_name || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' · ' || n_name END END AS title FROM customer JOIN nation ON c_nationkey = n_nationkey")
def public_titles(spark, sf_dir):
    """A title, else a second one, else the symbol and country; placeholders don't count."""
    c = tables(spark, sf_dir, "customer").join(tables(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
    k = F.col("c_custkey") % 5
    first = F.when(k == 0, F.col("c_name")).when(k == 1, " Untitled ").when(k == 2, "").when(k == 3, "N/A")
    second = F.when(k == 1, F.col("c_mktsegment")).when(k == 2, "unknown")
    return c.select("c_custkey", tx.public_title([first, second], F.col("c_name"), F.when(F.col("c_custkey") % 3 > 0, F.col("n_name"))).alias("title"))


HEADLINES = """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_brand || ' · ' || p_name
  WHEN 1 THEN p_brand || ' · ' || p_type || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ' · ' || p_size || ' — ' || p_name END
  WHEN 2 THEN CASE p_partkey % 3 WHEN 0 THEN 'freedom & opinion' WHEN 1 THEN 'right & water and…' ELSE 'Working Group on…' END || ' · ' || p_name
  ELSE p_name END AS headline FROM part"""


@query(HEADLINES)
def headlines(spark, sf_dir):
    """By type: body and title; treaty, symbol, country and title; mandate and title; title."""
    c, k = F.col, F.col("p_partkey")
    kind = F.element_at(F.array(*map(F.lit, ["gc", "jur", "sp", "other"])), (k % 4 + 1).cast("int"))
    third = k % 3 == 0
    mandate = F.when(third, "Special Rapporteur on the freedom of opinion").when(k % 3 == 1, "Special Rapporteur on the right of water and sanitation for all").otherwise("Working Group on Arbitrary Detention")
    title = F.when((kind == "jur") & third, c("p_type")).otherwise(c("p_name"))
    country = F.when(~third, c("p_size").cast("string"))
    return tables(spark, sf_dir, "part").select("p_partkey", tx.headline(kind, title, c("p_brand"), c("p_type"), country, mandate).alias("headline"))


@query("SELECT p_partkey FROM part WHERE contains(lower(concat_ws(' ', p_name, p_type)), 'widget') AND contains(lower(concat_ws(' ', p_name, p_type)), 'econ')")
def field_search(spark, sf_dir):
    """All terms in the chosen fields, in any of them each."""
    return tables(spark, sf_dir, "part").where(search.in_fields([F.col("p_name"), F.col("p_type")], "Widget econ")).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE (contains(lower(concat_ws(' ', p_name, p_brand, p_type)), 'cold') OR contains(lower(concat_ws(' ', p_name, p_brand, p_type)), 'standard')) AND contains(lower(p_brand), '#1')")
def topic_filter(spark, sf_dir):
    """Any topic over three fields, and a substring of a fourth."""
    fields = [F.col("p_name"), F.col("p_brand"), F.col("p_type")]
    return tables(spark, sf_dir, "part").where(search.on_topic(fields, ["cold", "STANDARD"]) & F.contains(F.lower("p_brand"), F.lit("#1"))).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE (starts_with(upper(replace(p_brand, ' ', '')), 'BRAND#1') OR starts_with(upper(p_brand), 'BRAND#5')) AND p_brand NOT IN ('Brand#13', 'Brand#51')")
def symbol_guard(spark, sf_dir):
    rows = tables(spark, sf_dir, "part")
    return rows.where(search.symbol_guard(F.concat(F.lower("p_brand"), F.lit(" .")), ["Brand#1", "BRAND#5"], ["BRAND#13", "BRAND#51"])).select("p_partkey")


@query("SELECT value, n FROM (SELECT p_type AS value, count(*) AS n FROM part GROUP BY 1) WHERE contains(lower(value), 'on')")
def facet_values(spark, sf_dir):
    return facets.matching(facets.counts(tables(spark, sf_dir, "part"), {"type": F.col("p_type")}), " ON ").select("value", "n")


@query("SELECT n_nationkey, field, reason FROM (SELECT n_nationkey, 'n_name' AS field, CASE n_nationkey % 5 WHEN 0 THEN 'not approved' WHEN 1 THEN 'no value' WHEN 2 THEN 'unchanged' END AS reason FROM nation UNION ALL SELECT n_nationkey, 'colour', 'unknown field' FROM nation UNION ALL SELECT n_nationkey + 1000, 'n_name', 'unknown key' FROM nation) WHERE reason IS NOT NULL")
def skipped_fixes(spark, sf_dir):
    n = tables(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("n_nationkey") % 5
    value = F.when(k == 1, " ").when(k == 2, F.col("n_name")).otherwise("fixed")
    one = n.select("n_nationkey", F.lit("n_name").alias("field"), value.alias("value"), F.when(k == 0, "no").otherwise(" Approved ").alias("approved"))
    two = n.select("n_nationkey", F.lit("colour").alias("field"), F.lit("red").alias("value"), F.lit("1").alias("approved"))
    three = n.select((F.col("n_nationkey") + 1000).alias("n_nationkey"), F.lit("n_name").alias("field"), F.lit("x").alias("value"), F.lit("Y").alias("approved"))
    return joins.skipped_fixes(n, one.unionByName(two).unionByName(three), "n_nationkey", ["n_name"])


@query("SELECT o_orderkey, CASE WHEN o_custkey % 4 = 3 THEN NULL WHEN o_custkey % 4 = 0 THEN 'Covenant' WHEN o_custkey % 4 = 1 THEN 'Protocol A' ELSE 'Covenant' END AS treaty FROM orders")
def main_treaty(spark, sf_dir):
    """A main treaty before protocols, then by name; none without a code."""
    k = F.col("o_custkey") % 4
    codes = F.when(k == 0, F.array(F.lit("p1"), F.lit("c"))).when(k == 1, F.array(F.lit("p2"), F.lit("p1"))).when(k == 2, F.array(F.lit("c"), F.lit("zz"))).otherwise(F.array().cast("array<string>"))
    dimension = spark.createDataFrame([("c", True, "Covenant"), ("p1", False, "Protocol A"), ("p2", False, "Protocol B")], "code string, main boolean, name string")
    return joins.main_first(tables(spark, sf_dir, "orders").select("o_orderkey", codes.alias("codes")), "codes", dimension, "code", "main", "name")


@query("SELECT l_suppkey, count(*) AS n, min({'a': l_orderkey * 10 + l_linenumber, 't': l_shipdate::DATE::VARCHAR}).t AS title FROM lineitem GROUP BY 1")
def cited_documents(spark, sf_dir):
    li = tables(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").cast("string").alias("title"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return facets.cited(li, "l_suppkey", "title", "at")


@query("SELECT source, count(*) AS hits, count(DISTINCT doc_id) AS documents FROM folded WHERE contains(folded, 'tion') GROUP BY ROLLUP (source)", paras=True)
def legacy_totals(spark, sf_dir):
    return facets.totals(folded_paras(spark, sf_dir).where(F.contains("folded", F.lit("tion"))), "source", "doc_id")


@query("SELECT year, sum(n)::BIGINT AS n, min(year) OVER () AS first, max(year) OVER () AS last FROM (SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT year(l_shipdate)::INTEGER, count(*) FROM lineitem GROUP BY 1) GROUP BY year")
def year_merge(spark, sf_dir):
    one = tables(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    two = tables(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return facets.year_merge(one, two)


@query("SELECT grain, facet, value, n, row_number() OVER (PARTITION BY facet ORDER BY n DESC, value)::INTEGER AS place FROM (SELECT 'document' AS grain, 'source' AS facet, source AS value, count(*) * 2 AS n FROM documents GROUP BY 3)")
def facet_sorted(spark, sf_dir):
    one = facets.counts(tables(spark, sf_dir, "documents"), {"source": F.col("source")}).withColumn("grain", F.lit("document"))
    return facets.sorted_merge(one, one).select("grain", "facet", "value", "n", "place")


@query("SELECT lang, count(*) AS paragraphs, sum((k > 0)::INT)::BIGINT AS with_notes, sum(k)::BIGINT AS notes FROM (SELECT lang, len(regexp_extract_all(body, '[0-9]+')) AS k FROM paras) GROUP BY 1", paras=True)
def footnote_stats(spark, sf_dir):
    return corpus.footnote_stats(paras(spark, sf_dir), ["lang"], F.regexp_extract_all("body", F.lit("[0-9]+"), F.lit(0)))


@query("SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'note 2 of ' || role || '|note 1 of ' || role WHEN 1 THEN 'note 1 of ' || role ELSE '' END AS notes FROM conversations")
def note_lookup(spark, sf_dir):
    """Marks name their notes by number; a mark without a note, and a second mark of one, give nothing."""
    marks = F.element_at(F.array(*map(F.lit, ["a[[fn:2]] b[[fn:1]] c[[fn:2]]", "a[[fn:1]] [[fn:9]]", "none"])), (F.col("turn") % 3 + 1).cast("int"))
    note = lambda n: F.struct(F.lit(n).alias("n"), F.concat(F.lit(f"note {n} of "), F.col("role")).alias("text"))
    twice = F.struct(F.lit(2).alias("n"), F.lit("a later one").alias("text"))
    return tables(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(tx.notes_of(marks, F.array(note(1), note(2), twice)), "|").alias("notes"))


@query("SELECT status, count(*) AS n, round(avg(conf), 2) AS conf FROM (SELECT l_discount * 1000 AS conf, CASE WHEN l_discount * 1000 >= 60 THEN 'pass' WHEN l_discount * 1000 >= 30 THEN 'review' ELSE 'fail' END AS status FROM lineitem) GROUP BY 1")
def ocr_audit(spark, sf_dir):
    conf = F.col("l_discount") * 1000
    return ocr.audit(tables(spark, sf_dir, "lineitem").withColumn("status", ocr.status(conf, 60, 30)), "status", conf)


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount * 1000 >= 30 AND l_discount * 1000 < 60")
def ocr_review_list(spark, sf_dir):
    conf = F.col("l_discount") * 1000
    return ocr.review_list(tables(spark, sf_dir, "lineitem").withColumn("status", ocr.status(conf, 60, 30)), "status", ["l_orderkey", "l_linenumber"])


@query("SELECT chr(65279) || 'n_nationkey,n_name,n_regionkey' || chr(13) || chr(10) || string_agg(n_nationkey || ',' || CASE WHEN n_nationkey % 2 = 0 THEN '\"' || n_name || ', \"\"the\"\"\"' ELSE n_name END || ',' || n_regionkey, chr(13) || chr(10) ORDER BY n_nationkey) || chr(13) || chr(10) AS text FROM nation")
def csv_whole(spark, sf_dir):
    """A whole export: mark, header, quotes, CRLF."""
    name = F.when(F.col("n_nationkey") % 2 == 0, F.concat("n_name", F.lit(', "the"'))).otherwise(F.col("n_name"))
    return csv_file(tables(spark, sf_dir, "nation").select("n_nationkey", name.alias("n_name"), "n_regionkey"), ["n_nationkey"])


@query("SELECT '{\"query\":\"all\",\"scope\":\"regions\",\"total\":' || count(*) || ',\"rows\":[' || string_agg('{\"r_regionkey\":' || r_regionkey || ',\"r_name\":\"' || r_name || '\"}', ',' ORDER BY r_regionkey) || ']}' AS json FROM region")
def json_whole(spark, sf_dir):
    return json_file(tables(spark, sf_dir, "region").select("r_regionkey", "r_name"), ["r_regionkey"], query="all", scope="regions")


#: The columns of an export, in their order: fixed values.
EXPORT = ["rank", "type", "doc_id", "doc_name", "doc_short_name", "signature", "committee", "committees", "country", "outcome", "section", "year", "adoption_date", "communication_date", "mandate_holder", "paragraph_id", "paragraph_n", "paragraph_text", "labels", "case_name", "case_name_source", "submitted_by", "representation", "alleged_victims", "state_party", "subject_matter", "substantive_issues", "procedural_issues", "articles_invoked", "articles_invoked_raw", "metadata_confidence", "link"]
#: Those that only cases have; other types leave them empty, so that the header is the same for all.
CASE_ONLY = {"communication_date", *EXPORT[EXPORT.index("case_name") : EXPORT.index("link")]}


def export_projection(hits, kind, values):
    """hits with the columns of an export as text: those in values, empty where there is none, and where a row's type has none."""
    def one(name):
        v = values.get(name)
        if v is None:
            return F.lit("").alias(name)
        v = F.coalesce(v.cast("string"), F.lit(""))
        return (F.when(kind == "jur", v).otherwise("") if name in CASE_ONLY else v).alias(name)

    return hits.select(*(one(n) for n in EXPORT))


EXPORT_SQL = {
    "rank": "rank::VARCHAR", "type": "kind", "doc_id": "o_custkey::VARCHAR", "doc_name": "c_name", "signature": "c_mktsegment", "country": "n_name", "year": "year(o_orderdate)::VARCHAR", "adoption_date": "o_orderdate::DATE::VARCHAR",
    "communication_date": "CASE WHEN kind = 'jur' THEN o_orderdate::DATE::VARCHAR ELSE '' END", "paragraph_id": "o_orderkey::VARCHAR", "paragraph_text": "o_orderpriority", "labels": "o_orderstatus || '; x'", "case_name": "CASE WHEN kind = 'jur' THEN c_name ELSE '' END",
    "state_party": "CASE WHEN kind = 'jur' THEN n_name ELSE '' END", "articles_invoked": "CASE WHEN kind = 'jur' THEN '2; 14(1)' ELSE '' END",
}


@query("SELECT " + ", ".join(f"{EXPORT_SQL.get(c, chr(39) * 2)} AS {c}" for c in EXPORT) + " FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank, CASE o_orderkey % 3 WHEN 0 THEN 'jur' WHEN 1 THEN 'gc' ELSE 'sp' END AS kind FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 500)")
def export_columns(spark, sf_dir):
    """All columns of an export of the first 500 hits."""
    c = F.col
    o = tables(spark, sf_dir, "orders").join(tables(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey")).join(tables(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
    top = search.page(o, 1, 500, [F.desc("o_totalprice"), F.asc("o_orderkey")])
    kind = F.element_at(F.array(*map(F.lit, ["jur", "gc", "sp"])), (c("o_orderkey") % 3 + 1).cast("int"))
    day = F.to_date("o_orderdate")
    return export_projection(top, kind, {
        "rank": c("rank"), "type": kind, "doc_id": c("o_custkey"), "doc_name": c("c_name"), "signature": c("c_mktsegment"), "country": c("n_name"), "year": F.year(day), "adoption_date": day, "communication_date": day,
        "paragraph_id": c("o_orderkey"), "paragraph_text": c("o_orderpriority"), "labels": F.concat_ws("; ", "o_orderstatus", F.lit("x")), "case_name": c("c_name"), "state_party": c("n_name"), "articles_invoked": F.concat_ws("; ", F.lit("2"), F.lit("14(1)")),
    })


ENVELOPE = """SELECT 'worth' AS query, 'all' AS scope, count(*) AS total, 1::INTEGER AS page, 5::INTEGER AS page_size, '{"en":' || sum((lang = 'en')::INT) || ',"fr":' || sum((lang = 'fr')::INT) || '}' AS breakdown,
  (SELECT coalesce('[' || string_agg('{"rank":' || rank || ',"doc_id":' || doc_id || ',"idx":' || idx || '}', ',' ORDER BY rank) || ']', '[]') FROM (SELECT doc_id, idx, row_number() OVER (ORDER BY doc_id, idx) AS rank FROM folded WHERE contains(folded, 'worth') ORDER BY doc_id, idx LIMIT 5)) AS hits, '' AS also_try
FROM folded WHERE contains(folded, 'worth')"""


@query(ENVELOPE, paras=True)
def search_envelope(spark, sf_dir):
    """A server's answer in one row."""
    hits = search.search(paras(spark, sf_dir), "worth")
    return search.envelope(hits, "worth", "all", 1, 5, "lang", ["en", "fr"], [F.col("doc_id"), F.col("idx")], ["doc_id", "idx"], ["that"])


@query("SELECT 'zzzqqq' AS query, 'all' AS scope, 0::BIGINT AS total, 1::INTEGER AS page, 5::INTEGER AS page_size, '{\"en\":0,\"fr\":0}' AS breakdown, '[]' AS hits, 'worth,that' AS also_try")
def search_envelope_empty(spark, sf_dir):
    """Without a hit, what else to try."""
    hits = search.search(paras(spark, sf_dir), "zzzqqq")
    return search.envelope(hits, "zzzqqq", "all", 1, 5, "lang", ["en", "fr"], [F.col("doc_id"), F.col("idx")], ["doc_id", "idx"], ["worth", "that"])


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey)::INTEGER AS rank FROM orders ORDER BY 2 LIMIT 50")
def sort_forced(spark, sf_dir):
    """An empty query is in date order, whatever was asked for."""
    order = search.order_for("  ", "relevance", F.col("o_totalprice"), F.col("o_orderdate"), F.col("o_orderkey"))
    return search.page(tables(spark, sf_dir, "orders"), 1, 50, order).select("o_orderkey", "rank")


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_quantity DESC, l_shipdate DESC, l_orderkey, l_linenumber, l_partkey)::INTEGER AS rank FROM lineitem ORDER BY 3 LIMIT 50")
def sort_relevance(spark, sf_dir):
    """Score, then date, then the ties."""
    order = search.order_for("x", "relevance", F.col("l_quantity"), F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"))
    return search.page(tables(spark, sf_dir, "lineitem"), 1, 50, order).select("l_orderkey", "l_linenumber", "rank")


@query("SELECT doc_id, idx FROM paras WHERE contains(lower(body), 'wor')", paras=True)
def in_document(spark, sf_dir):
    return paras(spark, sf_dir).where(search.in_document(F.col("body"), " Wor ")).select("doc_id", "idx")


@query("SELECT doc_id, count(*) AS n FROM paras GROUP BY 1", paras=True)
def in_document_short(spark, sf_dir):
    """Under three characters nothing is hidden."""
    return paras(spark, sf_dir).where(search.in_document(F.col("body"), "wo")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, idx FROM paras WHERE idx > 1", paras=True)
def preambles_hidden(spark, sf_dir):
    return corpus.hide_preambles(paras(spark, sf_dir), True).select("doc_id", "idx")


STOP, STOP_PAIRS = ["the", "of", "and"], ["que en", "thion the"]


@query(", t AS (SELECT list_filter(regexp_extract_all(folded, '[a-z]+'), lambda x: x NOT IN ('the', 'of', 'and')) AS l FROM folded) SELECT bigram, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(l)), lambda i: l[i] || ' ' || l[i + 1])) AS bigram FROM t WHERE len(l) > 1) WHERE bigram NOT IN ('que en', 'thion the') GROUP BY 1 ORDER BY n DESC, bigram LIMIT 20", paras=True)
def bigrams_stopped(spark, sf_dir):
    """Of each record, without the pairs on a list."""
    words = F.filter(tx.tokens(F.col("folded")), lambda w: ~w.isin(STOP))
    rows = folded_paras(spark, sf_dir).select(F.explode(tx.bigrams(words)).alias("bigram"))
    return rows.where(~F.col("bigram").isin(STOP_PAIRS)).groupBy("bigram").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "bigram").limit(20)


@query("SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(folded, '[a-z]+')) AS word FROM folded) WHERE word NOT IN ('the', 'of', 'and', 'que') GROUP BY 1 ORDER BY n DESC, word LIMIT 20", paras=True)
def stop_word_union(spark, sf_dir):
    """Words that are on none of two stop lists."""
    words = folded_paras(spark, sf_dir).select(F.explode(tx.tokens(F.col("folded"))).alias("word"))
    return words.join(sets.stop_words(spark, ["The", "of "], ["and", "que", "of"]), "word", "left_anti").groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(20)


@query("SELECT o_orderkey, 'a) x;<br>(b) y; z;<br>(iv) ' || o_orderkey AS html, CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 90 + 1)::INTEGER END AS session, (1990 + o_orderkey % 30)::INTEGER AS year, CASE WHEN o_orderkey % 3 = 0 THEN 'A/HRC/' || o_orderkey END AS symbol FROM orders")
def text_scalars(spark, sf_dir):
    """List breaks, sessions, the year of the first text that has one, the symbol in a url."""
    k = F.col("o_orderkey")
    word = k.cast("string")
    session = F.when(k % 2 == 0, F.concat(F.lit("Report of the "), tx.ordinal(k % 90 + 1), F.lit(" Session"))).otherwise("No number, session")
    url = F.when(k % 3 == 0, F.concat(F.lit("https://x.org/d?Lang=en&symbolno=a%2Fhrc%2F"), word, F.lit("&x=1"))).otherwise("https://x.org/d?lang=en")
    year = tx.year_from(F.lit("no year"), F.concat((k % 30 + 1990).cast("string"), F.lit("-05")), F.lit("1980"))
    return tables(spark, sf_dir, "orders").select("o_orderkey", tx.list_breaks(F.concat(F.lit("a) x; (b) y; z;(iv) "), word)).alias("html"), tx.session_of(session).alias("session"), year.alias("year"), tx.symbol_of_url(url).alias("symbol"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN before IS NULL THEN 'none' WHEN l_linenumber = before + 1 THEN 'next' WHEN l_linenumber = before THEN 'repeat' ELSE 'jump' END AS action, l_shipdate::DATE >= DATE '1990-01-01' AS is_date FROM (SELECT *, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS before FROM lineitem)")
def marker_actions(spark, sf_dir):
    """What each line's dotted number does to the sequence of its order, and whether a text is a date."""
    li = tables(spark, sf_dir, "lineitem")
    numbered = li.withColumn("key", tx.dotted_key(F.concat(F.lit("3."), F.col("l_linenumber").cast("string"), F.lit("."))))
    before = F.lag("key").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    rows = numbered.withColumn("before", before)
    return rows.select("l_orderkey", "l_linenumber", tx.marker_action(F.col("before"), F.col("key")).alias("action"), tx.is_date_marker(F.date_format("l_shipdate", "dd.MM.yyyy")).alias("is_date"))


@query("SELECT p_partkey, p_brand, row_number() OVER (ORDER BY coalesce(regexp_extract(p_brand, '#([0-9]+)', 1)::INT, -1) DESC, p_partkey)::INTEGER AS place FROM part ORDER BY 3 LIMIT 100")
def number_sort(spark, sf_dir):
    """By the number in a name, the highest first; names without one come last."""
    n = F.coalesce(F.regexp_extract("p_brand", "#([0-9]+)", 1).try_cast("int"), F.lit(-1))
    return search.page(tables(spark, sf_dir, "part"), 1, 100, [n.desc(), F.col("p_partkey")]).select("p_partkey", "p_brand", F.col("rank").alias("place"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d-%H%M') AS slug FROM events")
def time_slugs(spark, sf_dir):
    return tables(spark, sf_dir, "events").select("event_id", tx.time_slug(F.col("ts")).alias("slug"))


@query("SELECT doc_id, idx, list_sort(list_distinct(list_filter(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), lambda x: x IN ('of the', 'in the')))) AS pairs FROM (SELECT doc_id, idx, regexp_extract_all(folded, '[a-z]+') AS w FROM folded) WHERE len(w) > 1", paras=True)
def why_pairs(spark, sf_dir):
    """The query's word pairs that a paragraph has."""
    words = tx.tokens(F.col("folded"))
    rows = folded_paras(spark, sf_dir).where(F.size(words) > 1)
    return rows.select("doc_id", "idx", F.array_sort(F.array_intersect(tx.bigrams(words), F.array(F.lit("of the"), F.lit("in the")))).alias("pairs"))


@query("SELECT c_custkey, '{\"key\":' || c_custkey || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ',\"name\":\"' || c_name || '\"' END || CASE WHEN c_custkey % 2 = 0 THEN '' ELSE ',\"labels\":[\"' || c_mktsegment || '\"]' END || '}' AS json FROM customer")
def compact_documents(spark, sf_dir):
    """Documents as JSON without their empty fields and lists."""
    c = F.col
    rows = tables(spark, sf_dir, "customer").select("c_custkey", c("c_custkey").alias("key"), F.when(c("c_custkey") % 3 > 0, c("c_name")).otherwise("").alias("name"), F.when(c("c_custkey") % 2 > 0, F.array("c_mktsegment")).otherwise(F.array().cast("array<string>")).alias("labels"))
    return corpus.compact(rows).select("c_custkey", F.to_json(F.struct("key", "name", "labels")).alias("json"))


@query("SELECT l_orderkey, l_linenumber, number, CASE WHEN n >= 3 AND l_linenumber = 2 AND l_orderkey % 2 = 0 THEN '5.2' ELSE number END AS fixed FROM (SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) AS n, CASE WHEN l_linenumber = 2 AND l_orderkey % 2 = 0 THEN '8.2' ELSE '5.' || l_linenumber END AS number FROM (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS l_linenumber FROM lineitem))")
def repaired_parents(spark, sf_dir):
    """Each second order's second line has a misread parent, which its neighbours mend if there are three lines."""
    li = tables(spark, sf_dir, "lineitem")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")).cast("long")
    rows = li.select("l_orderkey", place.alias("l_linenumber"))
    number = F.when((F.col("l_linenumber") == 2) & (F.col("l_orderkey") % 2 == 0), "8.2").otherwise(F.concat(F.lit("5."), F.col("l_linenumber").cast("string")))
    return sequences.repaired(rows.withColumn("number", number), "l_orderkey", "l_linenumber", "number")
