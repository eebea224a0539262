"""Boolean search, ranking, filters, paging, facets and groups over paragraphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.text import first_place, fold, highlight, occurrences, sentence_snippet
from quire.operators import corpus, facets, joins, search
from quire.plans import textql
from quire.plans.base import folded_paras, paras, query
from quire.sources.readers import spread, tables

FLAGSHIP = '"of the" AND tion NOT worth*'


def hits(spark, sf_dir, text, where=None, scope="all"):
    rows = paras(spark, sf_dir).where(search.in_scope("lang", scope))
    return search.search(rows, text, where=where)


def matched(spark, sf_dir, text):
    tree = textql.parse(text)
    return folded_paras(spark, sf_dir).where(textql.test(tree, F.col("folded"))).select("doc_id", "idx")


def flagship(spark, sf_dir):
    found = hits(spark, sf_dir, FLAGSHIP)
    order = [F.col("score").desc(), F.col("doc_id"), F.col("idx")]
    return search.page(found, 1, 20, order).select("rank", "doc_id", "idx", F.round("score", 6).alias("score"))


#: Scores of the flagship's two scoring terms, over all paragraphs.
SCORED = """, stats AS (SELECT count(*)::DOUBLE AS n, avg(length(body)) AS mean, sum(contains(folded, 'of the')::INT)::DOUBLE AS d1, sum(contains(folded, 'tion')::INT)::DOUBLE AS d2 FROM folded),
occ AS (SELECT f.*, n, mean, d1, d2, floor((length(folded) - length(replace(folded, 'of the', ''))) / 6)::DOUBLE AS o1, floor((length(folded) - length(replace(folded, 'tion', ''))) / 4)::DOUBLE AS o2, 1.5 * (1 - 0.75 + 0.75 * length(body) / mean) AS norm FROM folded f, stats
  WHERE contains(folded, 'of the') AND contains(folded, 'tion') AND NOT regexp_matches(folded, '\\bworth\\w*')),
scored AS (SELECT *, ln(1 + (n - d1 + 0.5) / (d1 + 0.5)) * o1 * 2.5 / (o1 + norm) + ln(1 + (n - d2 + 0.5) / (d2 + 0.5)) * o2 * 2.5 / (o2 + norm) AS s FROM occ)
"""


@query(SCORED + "SELECT row_number() OVER (ORDER BY s DESC, doc_id, idx)::INTEGER AS rank, doc_id, idx, round(s, 6) AS score FROM scored ORDER BY s DESC, doc_id, idx LIMIT 20", paras=True)
def bm25_topk(spark, sf_dir):
    return flagship(spark, sf_dir)


@query(SCORED + "SELECT doc_id, idx, round(s, 6) AS score FROM scored", paras=True)
def bm25_all(spark, sf_dir):
    return hits(spark, sf_dir, FLAGSHIP).select("doc_id", "idx", F.round("score", 6).alias("score"))


@query(", t(term) AS (VALUES ('of the'), ('tion'), ('que'), ('zzzz')) SELECT term, df, n, round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf FROM (SELECT term, sum(contains(folded, term)::INT)::BIGINT AS df, count(*) AS n FROM folded, t GROUP BY term)", paras=True)
def bm25_idf(spark, sf_dir):
    rows, names = folded_paras(spark, sf_dir), ["of the", "tion", "que", "zzzz"]
    agg = rows.agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.contains("folded", F.lit(t)).cast("long")).alias(f"d{i}") for i, t in enumerate(names)))
    rows = agg.select("n", F.explode(F.array(*(F.struct(F.lit(t).alias("term"), F.col(f"d{i}").alias("df")) for i, t in enumerate(names)))).alias("x"))
    return rows.select("x.term", "x.df", "n", F.round(F.log(1 + (F.col("n") - F.col("x.df") + 0.5) / (F.col("x.df") + 0.5)), 6).alias("idf"))


for _name, _text, _sql in [
    ("search_and", "tion AND the", "contains(folded, 'tion') AND contains(folded, 'the')"),
    ("search_juxtaposed", "tion the", "contains(folded, 'tion') AND contains(folded, 'the')"),
    ("search_or", "worth OR desti | ß", "contains(folded, 'worth') OR contains(folded, 'desti') OR contains(folded, 'ß')"),
    ("search_not", "que NOT tion", "contains(folded, 'que') AND NOT contains(folded, 'tion')"),
    ("search_minus", "que -tion !des", "contains(folded, 'que') AND NOT contains(folded, 'tion') AND NOT contains(folded, 'des')"),
    ("search_phrase", '"of the"', "contains(folded, 'of the')"),
    ("search_prefix", "ener*", r"regexp_matches(folded, '\bener\w*')"),
    ("search_nested", "(que OR tion) AND (the OR NOT der) -und", "(contains(folded, 'que') OR contains(folded, 'tion')) AND (contains(folded, 'the') OR NOT contains(folded, 'der')) AND NOT contains(folded, 'und')"),
    ("search_accents", "ÉLÈ", "contains(folded, 'ele')"),
    ("search_open_or", "tion OR", "true"),
    ("search_bare_not", "NOT", "false"),
    ("search_double_not", "NOT NOT tion", "false"),
    ("search_stray_bracket", "tion ) que", "contains(folded, 'tion')"),
    ("search_open_phrase", '"in the', "contains(folded, 'in the')"),
    ("search_precedence", "the AND tion OR que", "contains(folded, 'the') AND contains(folded, 'tion') OR contains(folded, 'que')"),
]:

    def _run(spark, sf_dir, text=_text):
        return matched(spark, sf_dir, text)

    _run.__name__ = _name
    query(f"SELECT doc_id, idx FROM folded WHERE {_sql}", paras=True)(_run)


@query("SELECT doc_id, idx FROM folded WHERE (contains(folded, 'of the') OR contains(folded, 'in the')) AND contains(folded, 'tion')", paras=True)
def search_legacy(spark, sf_dir):
    return folded_paras(spark, sf_dir).where(textql.legacy_test('"of the or in the" tion', F.col("folded"))).select("doc_id", "idx")


@query("SELECT doc_id, idx, score FROM (SELECT doc_id, idx, 0.0::DOUBLE AS score FROM paras WHERE lang = 'fr')", paras=True)
def search_empty_query(spark, sf_dir):
    return hits(spark, sf_dir, "  ", scope="fr").select("doc_id", "idx", "score")


@query(", x AS (SELECT doc_id, idx, lower(body) AS b, lower(coalesce(l.note, '')) AS note FROM paras LEFT JOIN (SELECT doc_id, 'note on quality ' || quality AS note FROM labels) l USING (doc_id)) SELECT doc_id, idx, NOT contains(b, 'quality') AS in_note FROM x WHERE contains(b || ' ' || note, 'quality')", paras=True)
def footnote_match(spark, sf_dir):
    notes = tables(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("note on quality "), F.col("quality").cast("string")).alias("note"))
    rows = paras(spark, sf_dir).join(notes, "doc_id", "left").withColumn("note", F.coalesce("note", F.lit("")))
    tree = textql.parse("quality")
    found = search.search(rows, "quality", notes="note")
    return found.select("doc_id", "idx", search.footnote_only(tree, F.col("body"), F.col("note")).alias("in_note"))


@query(SCORED + "SELECT * EXCLUDE (rank) FROM (SELECT doc_id, idx, round(s, 6) AS score, row_number() OVER (ORDER BY s DESC, doc_id, idx) AS rank FROM scored) WHERE rank BETWEEN 21 AND 40", paras=True)
def page_2(spark, sf_dir):
    order = [F.col("score").desc(), F.col("doc_id"), F.col("idx")]
    return search.page(hits(spark, sf_dir, FLAGSHIP), 2, 20, order).select("doc_id", "idx", F.round("score", 6).alias("score"))


@query("SELECT o_orderkey, o_orderdate::DATE AS day, row_number() OVER (ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey)::INTEGER AS rank FROM orders ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey LIMIT 50")
def sort_date(spark, sf_dir):
    rows = tables(spark, sf_dir, "orders")
    order = [F.col("o_orderdate").desc(), F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return search.page(rows, 1, 50, order).select("o_orderkey", F.to_date("o_orderdate").alias("day"), "rank")


@query("SELECT coalesce(try_strptime(s, '%d %B %Y')::DATE, make_date(y, 1, 1), DATE '1970-01-01') AS day, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%d %B %Y') WHEN o_orderkey % 3 = 1 THEN 'undated' END AS s, CASE WHEN o_orderkey % 5 > 0 THEN year(o_orderdate)::INT END AS y FROM orders) GROUP BY 1")
def date_key(spark, sf_dir):
    o = tables(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "dd MMMM yyyy")).when(F.col("o_orderkey") % 3 == 1, "undated")
    year = F.when(F.col("o_orderkey") % 5 > 0, F.year("o_orderdate"))
    return o.groupBy(corpus.date_key(text, year).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN year(o_orderdate) END AS y FROM orders) WHERE y IS NULL OR y BETWEEN 1995 AND 1996")
def filter_years(spark, sf_dir):
    o = tables(spark, sf_dir, "orders").withColumn("y", F.when(F.col("o_orderkey") % 7 > 0, F.year("o_orderdate")))
    return o.where(search.year_between(F.col("y"), 1995, 1996)).select("o_orderkey")


@query("SELECT o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN year(o_orderdate) END AS y FROM orders) WHERE coalesce(y, 0) BETWEEN 1995 AND 1996")
def filter_years_strict(spark, sf_dir):
    o = tables(spark, sf_dir, "orders").withColumn("y", F.when(F.col("o_orderkey") % 7 > 0, F.year("o_orderdate")))
    return o.where(search.year_between_strict(F.col("y"), 1995, 1996)).select("o_orderkey")


def labelled(spark, sf_dir):
    names = [(F.col("quality") == 1, "good"), (F.col("toxic") == 1, "toxic"), (F.col("doc_id") % 2 == 0, "even")]
    return tables(spark, sf_dir, "labels").withColumn("labels", F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in names))))


@query("SELECT doc_id FROM labels WHERE toxic = 1 OR doc_id % 2 = 0")
def filter_labels_any(spark, sf_dir):
    return labelled(spark, sf_dir).where(search.any_of(F.col("labels"), ["toxic", "even"])).select("doc_id")


@query("SELECT doc_id FROM labels WHERE quality = 1 AND doc_id % 2 = 0")
def filter_labels_all(spark, sf_dir):
    return labelled(spark, sf_dir).where(search.all_of(F.col("labels"), ["good", "even"])).select("doc_id")


@query("SELECT doc_id FROM documents WHERE lang IN ('fr', 'src3') OR source IN ('fr', 'src3')")
def filter_body_union(spark, sf_dir):
    return tables(spark, sf_dir, "documents").where(search.one_of(["lang", "source"], ["fr", "src3"])).select("doc_id")


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE coalesce(CASE WHEN toxic = 1 THEN 'superseded' END, 'final') <> 'superseded'")
def filter_superseded(spark, sf_dir):
    status = tables(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "superseded").alias("status"))
    docs = tables(spark, sf_dir, "documents").select("doc_id").join(status, "doc_id", "left")
    return docs.where(F.coalesce("status", F.lit("final")) != "superseded").select("doc_id")


@query("SELECT doc_id FROM documents WHERE lang <> 'en' OR source IN ('src1', 'src2')")
def filter_report_type(spark, sf_dir):
    return tables(spark, sf_dir, "documents").where((F.col("lang") != "en") | F.col("source").isin("src1", "src2")).select("doc_id")


@query("SELECT p_partkey FROM part WHERE contains(lower(concat_ws(' ', p_name, p_brand, p_type, p_size)), 'widget brand#1')")
def filter_rail(spark, sf_dir):
    p = tables(spark, sf_dir, "part")
    return p.where(F.contains(F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type", F.col("p_size").cast("string"))), F.lit("widget brand#1"))).select("p_partkey")


@query("SELECT p.doc_id, p.idx FROM paras p WHERE contains(lower(body), 'worth') AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)", paras=True)
def exclude_shown(spark, sf_dir):
    shown = tables(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    return paras(spark, sf_dir).where(F.contains(F.lower("body"), F.lit("worth"))).join(shown, "doc_id", "left_anti").select("doc_id", "idx")


@query("SELECT doc_id, idx FROM paras WHERE NOT regexp_matches(trim(body), '^(Page [0-9]+|[0-9]+|[A-Za-z]+ [0-9]{4})$') AND length(body) >= 40", paras=True)
def noise_filter(spark, sf_dir):
    return paras(spark, sf_dir).where(~corpus.is_noise(F.col("body"))).select("doc_id", "idx")


@query("SELECT p.doc_id, p.idx FROM paras p JOIN paras f ON f.doc_id = p.doc_id AND f.idx = 1 WHERE p.idx = 1 OR p.body <> f.body", paras=True)
def duplicate_preamble(spark, sf_dir):
    docs = spread(tables(spark, sf_dir, "documents").select("doc_id", "text"))
    return corpus.without_repeated_preamble(corpus.paragraphs(docs, preamble=True)).select("doc_id", "idx")


@query("SELECT facet, value, count(*) AS n FROM (SELECT unnest([{'facet': 'lang', 'value': lang}, {'facet': 'source', 'value': source}, {'facet': 'first', 'value': (idx = 1)::VARCHAR}], recursive := true) FROM paras) GROUP BY ALL", paras=True)
def facet_counts(spark, sf_dir):
    return facets.counts(paras(spark, sf_dir), {"lang": F.col("lang"), "source": F.col("source"), "first": F.col("idx") == 1})


@query("SELECT source AS value, count(*) AS n FROM paras GROUP BY 1", paras=True)
def facet_source(spark, sf_dir):
    return facets.counts(paras(spark, sf_dir), {"source": F.col("source")}).select("value", "n")


@query("SELECT lang AS value, count(*) AS n FROM documents GROUP BY 1")
def facet_lang(spark, sf_dir):
    return facets.counts(tables(spark, sf_dir, "documents"), {"lang": F.col("lang")}).select("value", "n")


@query("SELECT label AS value, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN quality = 1 THEN 'good' END, CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN doc_id % 2 = 0 THEN 'even' END], lambda x: x IS NOT NULL)) AS label FROM labels) GROUP BY 1")
def facet_labels(spark, sf_dir):
    return facets.counts(labelled(spark, sf_dir), {"label": F.col("labels")}).select("value", "n")


@query("SELECT n_regionkey::VARCHAR AS value, sum(coalesce(nullif(w, 0), 1))::BIGINT AS n FROM (SELECT n_nationkey, n_regionkey, count(s_suppkey) AS w FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL) GROUP BY 1")
def facet_weighted(spark, sf_dir):
    n = tables(spark, sf_dir, "nation").join(tables(spark, sf_dir, "supplier"), F.expr("s_nationkey = n_nationkey"), "left").groupBy("n_nationkey", "n_regionkey").agg(F.count("s_suppkey").alias("w"))
    return facets.counts(n, {"region": F.col("n_regionkey")}, F.coalesce(F.nullif(F.col("w"), F.lit(0)), F.lit(1))).select("value", "n")


SELF = """SELECT facet, value, count(*) AS n FROM (
  SELECT 'lang' AS facet, lang AS value FROM folded WHERE contains(folded, 'tion') AND source IN ('src1', 'src2') AND idx <= 3
  UNION ALL SELECT 'source', source FROM folded WHERE contains(folded, 'tion') AND lang = 'en' AND idx <= 3
  UNION ALL SELECT 'idx', idx::VARCHAR FROM folded WHERE contains(folded, 'tion') AND lang = 'en' AND source IN ('src1', 'src2')) GROUP BY ALL"""


@query(SELF, paras=True)
def facet_self_excluding(spark, sf_dir):
    rows = folded_paras(spark, sf_dir)
    filters = {"lang": (F.col("lang"), F.col("lang") == "en"), "source": (F.col("source"), F.col("source").isin("src1", "src2")), "idx": (F.col("idx"), F.col("idx") <= 3)}
    return facets.self_excluding(rows, filters, textql.test(textql.parse("tion"), F.col("folded")))


@query("SELECT grain, 'lang' AS facet, lang AS value, count(*) AS n FROM (SELECT 'paragraph' AS grain, lang FROM paras UNION ALL SELECT 'document', lang FROM documents) GROUP BY ALL", paras=True)
def facet_merge(spark, sf_dir):
    docs = facets.counts(tables(spark, sf_dir, "documents"), {"lang": F.col("lang")}).withColumn("grain", F.lit("document"))
    return facets.merge(facets.counts(paras(spark, sf_dir), {"lang": F.col("lang")}).withColumn("grain", F.lit("paragraph")), docs).select("grain", "facet", "value", "n")


@query("SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n, min(year(o_orderdate)::INTEGER) OVER () AS first, max(year(o_orderdate)::INTEGER) OVER () AS last FROM orders GROUP BY year(o_orderdate)")
def year_histogram(spark, sf_dir):
    o = tables(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    ends = o.agg(F.min("year").alias("first"), F.max("year").alias("last"))
    return o.groupBy("year").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(ends))


@query("SELECT count(*) AS total, sum((lang = 'en')::INT)::BIGINT AS en, sum((lang = 'fr')::INT)::BIGINT AS fr, sum((lang = 'de')::INT)::BIGINT AS de, sum((lang = 'es')::INT)::BIGINT AS es FROM folded WHERE contains(folded, 'tion')", paras=True)
def type_breakdown(spark, sf_dir):
    rows = folded_paras(spark, sf_dir).where(F.contains("folded", F.lit("tion")))
    return facets.breakdown(rows, "lang", ["en", "fr", "de", "es"])


@query("SELECT count(DISTINCT doc_id) AS documents, count(*) AS paragraphs FROM folded WHERE contains(folded, 'que')", paras=True)
def distinct_documents(spark, sf_dir):
    return matched(spark, sf_dir, "que").agg(F.countDistinct("doc_id").alias("documents"), F.count(F.lit(1)).alias("paragraphs"))


@query(SCORED + "SELECT doc_id, count(*) AS hits, round(max(s), 6) AS best FROM scored GROUP BY 1", paras=True)
def group_by_document(spark, sf_dir):
    return facets.by_document(hits(spark, sf_dir, FLAGSHIP)).select("doc_id", "hits", F.round("best", 6).alias("best"))


@query("SELECT source, doc_id, (CASE WHEN grouping(source) = 1 THEN 3 WHEN grouping(doc_id) = 1 THEN 1 ELSE 0 END)::INTEGER AS level, count(*) AS hits FROM folded WHERE contains(folded, 'worth') GROUP BY ROLLUP (source, doc_id)", paras=True)
def group_body_rollup(spark, sf_dir):
    rows = folded_paras(spark, sf_dir).where(F.contains("folded", F.lit("worth")))
    return facets.body_rollup(rows, "source", "doc_id")


@query("SELECT CASE WHEN lang = 'en' THEN source ELSE lang END AS body, doc_id, count(*) AS hits FROM folded WHERE contains(folded, 'tion') GROUP BY ALL", paras=True)
def group_by_body(spark, sf_dir):
    rows = folded_paras(spark, sf_dir).where(F.contains("folded", F.lit("tion")))
    return rows.groupBy(F.when(F.col("lang") == "en", F.col("source")).otherwise(F.col("lang")).alias("body"), "doc_id").agg(F.count(F.lit(1)).alias("hits"))


@query("SELECT doc_id, idx, floor((length(folded) - length(replace(folded, 'the', ''))) / 3)::INTEGER AS n FROM folded", paras=True)
def term_occurrences(spark, sf_dir):
    return folded_paras(spark, sf_dir).select("doc_id", "idx", occurrences(F.col("folded"), "the").alias("n"))


@query(r"SELECT doc_id, idx, regexp_replace(body, '(tions|tion|the)', '<mark>\1</mark>', 'gi') AS html FROM paras WHERE contains(lower(body), 'worth')", paras=True)
def highlighted(spark, sf_dir):
    rows = paras(spark, sf_dir).where(F.contains(F.lower("body"), F.lit("worth")))
    return rows.select("doc_id", "idx", highlight(F.col("body"), ["the", "tion", "tions"]).alias("html"))


SNIPPET = r"""SELECT doc_id, idx, CASE WHEN length(body) <= 900 THEN body ELSE CASE WHEN a > 1 THEN '… ' ELSE '' END || trim(substr(body, a::BIGINT, (b - a + 1)::BIGINT)) || CASE WHEN b < length(body) THEN ' …' ELSE '' END END AS snippet, p >= 500 AS deep FROM (
  SELECT *, s - CASE WHEN back <= 200 THEN back ELSE 0 END AS a, e + CASE WHEN ahead <= 200 THEN ahead ELSE 0 END AS b FROM (
    SELECT *, length(regexp_extract(substr(body, 1, s - 1), '[^.!?]*$')) AS back, length(regexp_extract(substr(body, e + 1), '^[^.!?]*[.!?]?')) AS ahead FROM (
      SELECT *, greatest(1, p - 200) AS s, least(length(body), p + 360) AS e FROM (SELECT doc_id, idx, body, instr(folded, 'worth') AS p FROM folded WHERE contains(folded, 'worth')))))"""


@query(SNIPPET, paras=True)
def kwic_snippet(spark, sf_dir):
    rows = folded_paras(spark, sf_dir).where(F.contains("folded", F.lit("worth"))).withColumn("p", first_place(F.col("body"), "worth"))
    return rows.select("doc_id", "idx", sentence_snippet(F.col("body"), F.col("p")).alias("snippet"), (F.col("p") >= 500).alias("deep"))


@query("SELECT p_partkey, (CASE WHEN instr(lower(p_name), 'a') > 0 THEN 100 - (instr(lower(p_name), 'a') - 1) ELSE 50 END)::INTEGER AS score FROM part WHERE contains(lower(p_name || ' ' || p_type), 'a') ORDER BY score DESC, p_partkey LIMIT 60")
def command_palette(spark, sf_dir):
    at = F.instr(F.lower("p_name"), "a")
    p = tables(spark, sf_dir, "part").where(F.contains(F.lower(F.concat_ws(" ", "p_name", "p_type")), F.lit("a")))
    return p.select("p_partkey", F.when(at > 0, 100 - (at - 1)).otherwise(50).alias("score")).orderBy(F.desc("score"), "p_partkey").limit(60)


@query("SELECT value, n, selected FROM (SELECT p_brand AS value, count(*) AS n, p_brand IN ('Brand#11', 'Brand#55') AS selected FROM part GROUP BY 1) ORDER BY selected DESC, n DESC, value LIMIT 12")
def chip_list(spark, sf_dir):
    chips = tables(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return chips.withColumn("selected", F.col("value").isin("Brand#11", "Brand#55")).orderBy(F.desc("selected"), F.desc("n"), "value").limit(12)


@query("SELECT source, n_docs, doc_id FROM (SELECT source, doc_id, count(*) OVER (PARTITION BY source) AS n_docs, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r <= 3")
def rail_order(spark, sf_dir):
    d = tables(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    sizes = d.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    return joins.first_per_key(d, ["source"], [F.desc("n_chars"), F.asc("doc_id")], 3).join(sizes, "source").select("source", "n_docs", "doc_id")


@query("SELECT vec_id, round(dot / (norm * qnorm), 6) AS cosine FROM (SELECT e.vec_id, list_dot_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS dot, sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[])) AS norm, sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) AS qnorm FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q WHERE e.vec_id <> 0 AND e.label <> 3) ORDER BY dot / (norm * qnorm) DESC, vec_id LIMIT 20")
def cosine_topk(spark, sf_dir):
    e = tables(spark, sf_dir, "embeddings")
    probe = [float(x) for x in e.where("vec_id = 0").first()["embedding"]]
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    v, q = F.col("embedding"), F.array(*map(F.lit, probe))
    scored = e.where("vec_id <> 0 and label <> 3").select("vec_id", (dot(v, q) / (F.sqrt(dot(v, v)) * F.sqrt(dot(q, q)))).alias("c"))
    return scored.orderBy(F.desc("c"), "vec_id").limit(20).select("vec_id", F.round("c", 6).alias("cosine"))


@query("SELECT doc_id, n FROM (SELECT doc_id, count(*) AS n FROM folded WHERE contains(folded, 'zzzqqq') GROUP BY 1) UNION ALL SELECT doc_id, count(*) FROM folded WHERE contains(folded, 'worth') AND NOT EXISTS (SELECT 1 FROM folded WHERE contains(folded, 'zzzqqq')) GROUP BY 1", paras=True)
def also_try(spark, sf_dir):
    """Without any hit, the hits of the synonym that a table names."""
    rows = folded_paras(spark, sf_dir)
    direct = rows.where(F.contains("folded", F.lit("zzzqqq"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    synonym = rows.where(F.contains("folded", F.lit("worth"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    none = direct.limit(1).agg(F.count(F.lit(1)).alias("c")).where("c = 0")
    return direct.unionByName(synonym.join(F.broadcast(none)).drop("c"))


@query("SELECT doc_id, idx, list_sort(list_distinct(list_filter(string_split_regex(folded, '[^a-z]+'), lambda x: x IN ('worth', 'that', 'desti')))) AS why, length(folded) > 500 AS long FROM folded WHERE contains(folded, 'worth')", paras=True)
def why_matched(spark, sf_dir):
    """The query's meaningful words that a paragraph has as words."""
    rows = folded_paras(spark, sf_dir).where(F.contains("folded", F.lit("worth")))
    words = F.split("folded", "[^a-z]+")
    return rows.select("doc_id", "idx", F.array_sort(F.array_intersect(words, F.array(F.lit("worth"), F.lit("that"), F.lit("desti")))).alias("why"), (F.length("folded") > 500).alias("long"))


@query("SELECT lang, count(*) AS n FROM folded WHERE contains(folded, strip_accents(lower('ÈRE'))) GROUP BY 1", paras=True)
def fold_diacritics(spark, sf_dir):
    return paras(spark, sf_dir).where(F.contains(fold(F.col("body")), F.lit("ere"))).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
