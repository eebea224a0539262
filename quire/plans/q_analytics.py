"""Term statistics, labels, scalars, citations, exports and document rollups."""

from __future__ import annotations

from pyspark.ml.feature import NGram
from pyspark.sql import functions as F

from quire.functions import citations, rules, urlstate
from quire.functions.text import (
    article_numbers,
    cite_key,
    dehyphenate,
    doc_id_of,
    dotted_key,
    escape_csv,
    escape_html,
    escape_tex,
    file_safe,
    fold,
    leading_int,
    link_articles,
    normalise_url,
    numbered_parts,
    ordinal,
    plausible_articles,
    prettify,
    short_digest,
    slugify,
    split_list,
    strip_html,
    strip_note_markers,
    symbol_key,
    tokens,
    word_count,
    year_of,
)
from quire.operators import corpus
from quire.plans.base import folded_paras, paras, query
from quire.sources.readers import html_paragraphs, tables
from quire.sources.writers import bibtex, csv_lines, manifest, workspace

STOP = ["the", "of", "and", "to", "in", "a", "que", "de", "la", "le", "der", "und", "die", "el", "en", "et", "is", "for"]
STOP_SQL = ", ".join(f"'{w}'" for w in STOP)


@query(f"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(folded, '[a-z]+')) AS word FROM folded) WHERE word NOT IN ({STOP_SQL}) GROUP BY 1 ORDER BY n DESC, word LIMIT 20", paras=True)
def word_freq(spark, sf_dir):
    words = folded_paras(spark, sf_dir).select(F.explode(tokens(F.col("folded"))).alias("word"))
    return words.where(~F.col("word").isin(STOP)).groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(20)


@query(f", t AS (SELECT list_filter(regexp_extract_all(folded, '[a-z]+'), lambda x: x NOT IN ({STOP_SQL})) AS l FROM folded) SELECT bigram, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(l)), lambda i: l[i] || ' ' || l[i + 1])) AS bigram FROM t WHERE len(l) > 1) GROUP BY 1 ORDER BY n DESC, bigram LIMIT 20", paras=True)
def bigram_freq(spark, sf_dir):
    """Per paragraph: pairs don't cross its bounds, so the count doesn't hang on the order of files."""
    words = F.filter(tokens(F.col("folded")), lambda w: ~w.isin(STOP))
    rows = NGram(n=2, inputCol="w", outputCol="bigrams").transform(folded_paras(spark, sf_dir).select(words.alias("w")))
    rows = rows.select(F.explode("bigrams").alias("bigram"))
    return rows.groupBy("bigram").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "bigram").limit(20)


@query("SELECT keyword, count(*) AS n FROM (SELECT unnest(list_filter(list_transform(string_split(lower(p_name), ' '), lambda x: trim(x)), lambda x: length(x) >= 3)) AS keyword FROM part) GROUP BY 1 ORDER BY n DESC, keyword LIMIT 20")
def keyword_topk(spark, sf_dir):
    words = F.filter(split_list(F.lower("p_name"), " "), lambda x: F.length(x) >= 3)
    return tables(spark, sf_dir, "part").select(F.explode(words).alias("keyword")).groupBy("keyword").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "keyword").limit(20)


@query("SELECT author, count(*) AS n FROM (SELECT unnest(list_filter(list_transform(string_split(c_mktsegment || '; ' || coalesce(n_name, '') || ';', ';'), lambda x: trim(x)), lambda x: x <> '')) AS author FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey) GROUP BY 1 ORDER BY n DESC, author LIMIT 20")
def author_topk(spark, sf_dir):
    c = tables(spark, sf_dir, "customer").join(tables(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"), "left")
    authors = F.concat(F.col("c_mktsegment"), F.lit("; "), F.coalesce("n_name", F.lit("")), F.lit(";"))
    return c.select(F.explode(split_list(authors, ";")).alias("author")).groupBy("author").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "author").limit(20)


LABEL_SQL = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(folded, '{'|'.join(f'(?:{p})' for p in ps)}') THEN '{n}' END" for n, ps in sorted(rules.LABELS.items())) + "], lambda x: x IS NOT NULL)"


@query(f"SELECT doc_id, idx, array_to_string({LABEL_SQL}, ',') AS labels FROM folded", paras=True)
def label_rules(spark, sf_dir):
    return folded_paras(spark, sf_dir).select("doc_id", "idx", F.array_join(rules.labels(F.col("folded")), ",").alias("labels"))


@query(f"SELECT label, count(*) AS n FROM (SELECT unnest({LABEL_SQL}) AS label FROM folded) GROUP BY 1", paras=True)
def label_freq(spark, sf_dir):
    rows = folded_paras(spark, sf_dir).select(F.explode(rules.labels(F.col("folded"))).alias("label"))
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT lang, count(*) AS n, sum((len({LABEL_SQL}) > 0)::INT)::BIGINT AS labelled, round(avg((len({LABEL_SQL}) > 0)::INT), 6) AS share FROM folded GROUP BY 1", paras=True)
def label_coverage(spark, sf_dir):
    some = (F.size(rules.labels(F.col("folded"))) > 0).cast("int")
    return folded_paras(spark, sf_dir).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(some).alias("labelled"), F.round(F.avg(some), 6).alias("share"))


@query(f"SELECT p.doc_id, p.idx, array_to_string(CASE WHEN l.toxic = 1 THEN ['human'] ELSE {LABEL_SQL} END, ',') AS labels FROM folded p LEFT JOIN labels l USING (doc_id)", paras=True)
def label_auto(spark, sf_dir):
    human = tables(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, F.array(F.lit("human"))).alias("human"))
    rows = folded_paras(spark, sf_dir).join(human, "doc_id", "left")
    return rows.select("doc_id", "idx", F.array_join(rules.auto_labels(F.col("human"), F.col("folded")), ",").alias("labels"))


@query(f"SELECT doc_id, count(*) AS n_paragraphs, sum(len(regexp_extract_all(body, '[^ \\t\\n\\x0b\\f\\r]+')))::BIGINT AS n_words, sum(len({LABEL_SQL}))::BIGINT AS n_labels, sum((len({LABEL_SQL}) > 0)::INT)::BIGINT AS n_labelled FROM folded GROUP BY 1", paras=True)
def doc_rollups(spark, sf_dir):
    rows = folded_paras(spark, sf_dir)
    return corpus.document_rollup(rows, "doc_id", F.col("body"), rules.labels(F.col("folded")))


@query(f"SELECT doc_id, array_to_string(list_sort(list_distinct(flatten(list({LABEL_SQL})))), ',') AS labels FROM folded GROUP BY 1", paras=True)
def case_labels(spark, sf_dir):
    rows = folded_paras(spark, sf_dir).select("doc_id", rules.labels(F.col("folded")).alias("l"))
    return rows.groupBy("doc_id").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("l")))), ",").alias("labels"))


@query("SELECT doc_id, CASE WHEN regexp_matches(t, '\\b(visit|mission)\\b') THEN 'visit' WHEN regexp_matches(t, '\\bfollow.?up\\b') THEN 'follow_up' WHEN regexp_matches(t, '\\b(study|report) on\\b') THEN 'thematic' WHEN regexp_matches(t, '\\b(annual|report)\\b') THEN 'annual' ELSE 'other' END AS kind FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'visit to ' WHEN 1 THEN 'annual report ' WHEN 2 THEN 'study on ' WHEN 3 THEN 'follow-up ' ELSE '' END || lang AS t FROM documents)")
def report_types(spark, sf_dir):
    kinds = F.element_at(F.array(*map(F.lit, ["visit to ", "annual report ", "study on ", "follow-up ", ""])), (F.col("doc_id") % 5 + 1).cast("int"))
    title = F.concat(kinds, F.col("lang"))
    return tables(spark, sf_dir, "documents").select("doc_id", rules.first_rule(title, rules.REPORT_TYPES, "other").alias("kind"))


@query("SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN doc_id % 5 = 0 THEN 'inadmissible' WHEN doc_id % 5 = 1 THEN 'violation' WHEN doc_id % 5 = 2 THEN 'no_violation' WHEN doc_id % 5 = 3 THEN CASE WHEN contains(lower(text), 'worth') THEN 'no_violation' ELSE 'discontinued' END ELSE 'unknown' END AS outcome FROM documents) GROUP BY 1")
def outcome_distribution(spark, sf_dir):
    """Titles and bodies in mixed case; what an opinion at the end says does not count."""
    title = F.element_at(F.array(*map(F.lit, ["Inadmissible communication", "VIOLATION of article 7", "No violation of article 14", "Decision", "Decision"])), (F.col("doc_id") % 5 + 1).cast("int"))
    said = F.when(F.contains(F.lower("text"), F.lit("worth")), "The facts before it do NOT disclose a violation of article 7. ").otherwise("The case is Discontinued. ")
    body = F.when(F.col("doc_id") % 5 == 3, F.concat(F.repeat(F.lit("x "), 200), said)).otherwise(F.repeat(F.lit("x "), 200))
    body = F.concat(body, F.lit("Dissenting opinion of a member: there was a violation."))
    rows = tables(spark, sf_dir, "documents").select(rules.outcome(title, body).alias("outcome"))
    return rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, regexp_replace(rtrim(substr(regexp_replace(regexp_replace(strip_accents(lower(p_type || ' (É) ' || p_name)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 24), '-'), '-+$', '') AS slug FROM part")
def slugs(spark, sf_dir):
    return tables(spark, sf_dir, "part").select("p_partkey", slugify(F.concat_ws(" (É) ", "p_type", "p_name"), 24).alias("slug"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages")
def html_strip(spark, sf_dir):
    return tables(spark, sf_dir, "pages").select("page_id", strip_html(F.col("html")).alias("text"))


@query("SELECT page_id, replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS escaped FROM pages")
def html_escape(spark, sf_dir):
    """Of the whole page."""
    return tables(spark, sf_dir, "pages").select("page_id", escape_html(F.col("html")).alias("escaped"))


@query()
def html_blocks(spark, sf_dir):
    return html_paragraphs(tables(spark, sf_dir, "pages"))


@query("SELECT event_id, CASE WHEN regexp_matches(props, '[\",\\n\\r]') THEN '\"' || replace(props, '\"', '\"\"') || '\"' ELSE props END AS cell FROM events")
def csv_escape(spark, sf_dir):
    return tables(spark, sf_dir, "events").select("event_id", escape_csv(F.col("props")).alias("cell"))


@query("SELECT n_nationkey, n_nationkey || ',' || n_name || ',' || n_regionkey AS line FROM nation")
def csv_export(spark, sf_dir):
    n = tables(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return n.select("n_nationkey", csv_lines(n).alias("line"))


@query("SELECT p_partkey, replace(regexp_replace(p_brand, '([&%$#_{}])', '\\\\\\1', 'g'), '~', '\\textasciitilde{}') AS tex FROM part")
def tex_escape(spark, sf_dir):
    return tables(spark, sf_dir, "part").select("p_partkey", escape_tex(F.col("p_brand")).alias("tex"))


CITE = "SELECT p_partkey, {0} AS cite FROM (SELECT p_partkey, p_brand AS a, p_name AS t, p_type AS s, (1990 + p_size)::VARCHAR AS y, CASE WHEN p_partkey % 2 = 0 THEN p_size::VARCHAR END AS para FROM part)"
CITED = {
    "un": "a || ', ' || t || ', ' || s || ' (' || y || ')' || coalesce(', para. ' || para, '')",
    "oscola": "a || ', ‘' || t || '’ (' || y || ') ' || s || coalesce(', para. ' || para, '')",
    "bluebook": "a || ', ' || t || ', U.N. Doc. ' || s || ' (' || y || ')'",
    "mcgill": "a || ', ' || t || ', ' || s || ', ' || y || coalesce(' at para ' || para, '')",
    "apa": "a || '. (' || y || '). ' || t || ' (' || s || ').'",
    "chicago": "a || '. “' || t || '.” ' || s || ', ' || y || '.'",
    "ris": "'TY  - RPRT' || chr(10) || 'AU  - ' || a || chr(10) || 'TI  - ' || t || chr(10) || 'PY  - ' || y || chr(10) || 'M1  - ' || s || chr(10) || 'ER  - '",
    "bibtex": r"'@techreport{' || regexp_replace(lower(a) || y || coalesce(para, ''), '[^a-z0-9]', '', 'g') || ', author={' || regexp_replace(a, '([&%$#_{{}}])', '\\\1', 'g') || '}, title={' || t || '}, number={' || s || '}, year={' || y || '}}'".replace("{{}}", "{}"),
    "url": "'https://example.org/' || p_partkey",
}


def _cited(name):
    def run(spark, sf_dir):
        c = F.col
        para = F.when(c("p_partkey") % 2 == 0, c("p_size"))
        made = citations.formats(c("p_brand"), c("p_name"), c("p_type"), c("p_size") + 1990, para, F.concat(F.lit("https://example.org/"), c("p_partkey").cast("string")))
        return tables(spark, sf_dir, "part").select("p_partkey", made[name].alias("cite"))

    run.__name__ = f"citation_{name}"
    return run


for _name, _sql in CITED.items():
    query(CITE.replace("{0}", _sql))(_cited(_name))


@query("SELECT c_custkey, lower(regexp_replace(n_name || c_custkey, '[^A-Za-z0-9]', '', 'g')) AS key FROM customer JOIN nation ON c_nationkey = n_nationkey")
def cite_keys(spark, sf_dir):
    c = tables(spark, sf_dir, "customer").join(tables(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
    return c.select("c_custkey", cite_key(F.col("n_name"), F.col("c_custkey")).alias("key"))


@query("SELECT o_custkey AS doc, '@misc{d' || o_custkey || ', title={Customer ' || o_custkey || '}, year={1999}, note={paras. ' || string_agg(o_orderkey::VARCHAR, ', ' ORDER BY o_orderkey) || '}}' AS entry FROM orders GROUP BY 1")
def bibtex_export(spark, sf_dir):
    """Of every customer."""
    o = tables(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), "o_orderkey")
    return bibtex(o, "doc", F.concat(F.lit("Customer "), F.col("doc").cast("string")), F.lit(1999), F.col("o_orderkey"))


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey)::INTEGER AS rank, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS segment, coalesce(n_name, '') AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey ORDER BY c_acctbal DESC, c_custkey LIMIT 100")
def export_rows(spark, sf_dir):
    from quire.operators.search import page

    c = tables(spark, sf_dir, "customer").join(tables(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"), "left")
    top = page(c, 1, 100, [F.col("c_acctbal").desc(), F.col("c_custkey")])
    return top.select("c_custkey", "rank", F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("segment"), F.coalesce("n_name", F.lit("")).alias("nation"))


@query("SELECT r_regionkey, '{\"query\":\"all\",\"region\":\"' || r_name || '\",\"key\":' || r_regionkey || '}' AS json FROM region")
def json_export(spark, sf_dir):
    row = F.struct(F.lit("all").alias("query"), F.col("r_name").alias("region"), F.col("r_regionkey").alias("key"))
    return tables(spark, sf_dir, "region").select("r_regionkey", F.to_json(row).alias("json"))


@query("SELECT lang, sum(n)::BIGINT AS n, sum(bytes)::BIGINT AS bytes, substr(sha256(string_agg(ds, '' ORDER BY bucket)), 1, 16) AS digest FROM (SELECT lang, substr(sha256(text), 1, 3) AS bucket, count(*) AS n, sum(octet_length(encode(text)))::BIGINT AS bytes, substr(sha256(string_agg(substr(sha256(text), 1, 16), '' ORDER BY doc_id)), 1, 16) AS ds FROM documents GROUP BY 1, 2) GROUP BY 1")
def sha_manifest(spark, sf_dir):
    return manifest(tables(spark, sf_dir, "documents"), "lang", F.col("text"), ["doc_id"])


@query("SELECT (SELECT count(*) FROM documents) AS documents, (SELECT count(DISTINCT lang) FROM documents) AS kinds, (SELECT count(DISTINCT source) FROM documents) AS sources, (SELECT min(n_chars) FROM documents) AS shortest, (SELECT max(n_chars) FROM documents) AS longest, (SELECT substr(sha256(max(doc_id::VARCHAR)), 1, 16) FROM documents) AS sha, sum(n)::BIGINT AS paragraphs, '{' || string_agg('\"' || lang || '\":' || n, ',' ORDER BY lang) || '}' AS by_kind FROM (SELECT lang, count(*) AS n FROM paras GROUP BY 1)", paras=True)
def corpus_manifest(spark, sf_dir):
    return corpus.manifest_row(tables(spark, sf_dir, "documents"), paras(spark, sf_dir), "lang")


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '1-URGENT-' || (year(o_orderdate) // 2 * 2) WHEN '2-HIGH' THEN '2-HIGH-' || (year(o_orderdate) // 5 * 5) ELSE 'other' END AS shard FROM orders")
def shard_assign(spark, sf_dir):
    o = tables(spark, sf_dir, "orders")
    return o.select("o_orderkey", rules.shard_of(F.col("o_orderpriority"), F.year("o_orderdate"), {"1-URGENT": 2, "2-HIGH": 5}).alias("shard"))


@query("SELECT n_nationkey, lower(n_name) || '-' || lpad(n_nationkey::VARCHAR, 4, '0') AS para, lower(n_name) AS doc FROM nation")
def id_to_document(spark, sf_dir):
    n = tables(spark, sf_dir, "nation")
    para = corpus.paragraph_id(F.lower("n_name"), F.col("n_nationkey"))
    return n.select("n_nationkey", para.alias("para"), doc_id_of(para).alias("doc"))


@query("SELECT p_partkey, p_size::VARCHAR || CASE WHEN p_size % 100 BETWEEN 11 AND 13 THEN 'th' WHEN p_size % 10 = 1 THEN 'st' WHEN p_size % 10 = 2 THEN 'nd' WHEN p_size % 10 = 3 THEN 'rd' ELSE 'th' END AS ordinal, p_size::INTEGER AS n, (1900 + p_size)::INTEGER AS year, array_to_string(list_transform(string_split(p_type, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS pretty FROM part")
def scalar_parses(spark, sf_dir):
    p = tables(spark, sf_dir, "part")
    n = leading_int(F.concat(F.col("p_size").cast("string"), F.lit(". (rev.)")))
    year = year_of(F.concat(F.lit("A/"), (F.col("p_size") + 1900).cast("string"), F.lit("/12345")))
    return p.select("p_partkey", ordinal(F.col("p_size")).alias("ordinal"), n.alias("n"), year.alias("year"), prettify(F.replace("p_type", F.lit(" "), F.lit("_"))).alias("pretty"))


@query("SELECT o_orderkey, array_to_string([o_custkey % 7, o_orderkey % 11, 3], ',') AS key FROM orders")
def dotted_ids(spark, sf_dir):
    """Of every order."""
    text = F.concat((F.col("o_custkey") % 7).cast("string"), F.lit("."), (F.col("o_orderkey") % 11).cast("string"), F.lit(".3."))
    key = F.transform(dotted_key(text), lambda x: x.cast("string"))
    return tables(spark, sf_dir, "orders").select("o_orderkey", F.array_join(key, ",").alias("key"))


@query(r"SELECT page_id, regexp_replace(regexp_replace(regexp_replace(trim(url), '^http://', 'https://'), '#.*$', ''), '/+$', '') AS url FROM pages")
def url_normalise(spark, sf_dir):
    return tables(spark, sf_dir, "pages").select("page_id", normalise_url(F.col("url")).alias("url"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(text, '([A-Za-z])-\n([a-z])', '\1\2', 'g'), '\s*\n\s*', ' ', 'g'), '[ \t]{2,}', ' ', 'g'))) AS digest FROM documents")
def soft_wraps(spark, sf_dir):
    return tables(spark, sf_dir, "documents").select("doc_id", F.md5(dehyphenate(F.col("text")).cast("binary")).alias("digest"))


@query("SELECT doc_id, substr(sha256(text), 1, 16) AS sha, substr(sha1(lang), 1, 6) AS short, regexp_replace(source || ' / ' || lang || '?', '[^A-Za-z0-9._-]+', '_', 'g') AS file FROM documents")
def digests(spark, sf_dir):
    d = tables(spark, sf_dir, "documents")
    return d.select("doc_id", short_digest(F.col("text")).alias("sha"), F.substring(F.sha1("lang"), 1, 6).alias("short"), file_safe(F.concat(F.col("source"), F.lit(" / "), F.col("lang"), F.lit("?"))).alias("file"))


@query("SELECT n_nationkey, unnest([1, 2])::INTEGER AS n, unnest(['First ' || n_name, 'Second 3.5 part']) AS text FROM nation")
def numbered_paragraphs(spark, sf_dir):
    raw = F.concat(F.lit("Header\n1. First "), F.col("n_name"), F.lit("\n2. Second 3.5 part"))
    return tables(spark, sf_dir, "nation").select("n_nationkey", F.explode(numbered_parts(raw)).alias("p")).select("n_nationkey", "p.n", "p.text")


@query("SELECT n_nationkey, 'See ' || n_name || '.' AS clean FROM nation")
def note_markers(spark, sf_dir):
    raw = F.concat(F.lit("See [[fn:1]]"), F.col("n_name"), F.lit("[[fn:23]]."))
    return tables(spark, sf_dir, "nation").select("n_nationkey", strip_note_markers(raw).alias("clean"))


@query("SELECT doc_id, idx, replace(replace(folded, 'tion', 'xion'), 'worth', 'wrth') AS fixed, (len(string_split(folded, 'tion')) + len(string_split(replace(folded, 'tion', 'xion'), 'worth')) - 2)::INTEGER AS n FROM folded", paras=True)
def safe_corrections(spark, sf_dir):
    """Of every paragraph."""
    text, n = rules.corrected(F.col("folded"), [("tion", "xion"), ("worth", "wrth")])
    return folded_paras(spark, sf_dir).select("doc_id", "idx", text.alias("fixed"), n.cast("int").alias("n"))


@query("SELECT doc_id, idx, len(regexp_extract_all(body, '[^ \\t\\n\\x0b\\f\\r]+'))::INTEGER AS words, length(body)::INTEGER AS chars FROM paras", paras=True)
def word_counts(spark, sf_dir):
    return paras(spark, sf_dir).select("doc_id", "idx", word_count(F.col("body")).alias("words"), F.length("body").alias("chars"))


@query("SELECT label, score, CASE WHEN score >= 0.8 THEN 'high' WHEN score >= 0.5 THEN 'medium' ELSE 'low' END AS band FROM (SELECT label, round(avg((vec_id % 10) / 10.0), 6) AS score FROM embeddings GROUP BY 1)")
def score_bands(spark, sf_dir):
    s = tables(spark, sf_dir, "embeddings").groupBy("label").agg(F.round(F.avg((F.col("vec_id") % 10) / 10.0), 6).alias("score"))
    return s.withColumn("band", F.when(F.col("score") >= 0.8, "high").when(F.col("score") >= 0.5, "medium").otherwise("low"))


@query("SELECT conv_id, string_agg(turn || '. ' || text, chr(10) ORDER BY turn) AS listing FROM conversations GROUP BY 1")
def numbered_listing(spark, sf_dir):
    line = F.struct("turn", F.concat(F.col("turn").cast("string"), F.lit(". "), F.col("text")).alias("t"))
    c = tables(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(line)).alias("l"))
    return c.select("conv_id", F.array_join(F.transform("l", lambda x: x["t"]), "\n").alias("listing"))


@query("SELECT n_nationkey, 'source' AS facet, CASE WHEN n_name = '' THEN NULL ELSE n_name END AS name FROM nation")
def compact_rows(spark, sf_dir):
    n = tables(spark, sf_dir, "nation").select("n_nationkey", F.lit("source").alias("facet"), F.col("n_name").alias("name"))
    return corpus.compact(n)


@query("SELECT doc_id, lang, strip_accents(lower(text)) AS folded FROM documents")
def fold_text(spark, sf_dir):
    """Of the whole text."""
    return tables(spark, sf_dir, "documents").select("doc_id", "lang", fold(F.col("text")).alias("folded"))


@query(f"SELECT p_partkey, array_to_string(list_filter(CASE WHEN p_size IN (2, 3) THEN ['2', '3'] ELSE ['2', '3', p_size::VARCHAR] END, lambda x: true), ',') AS articles FROM part")
def article_extraction(spark, sf_dir):
    text = F.concat(F.lit("Under articles 2, 3 (1) and "), F.col("p_size").cast("string"), F.lit(" and article 120, see art. 2."))
    found = plausible_articles(article_numbers(text))
    return tables(spark, sf_dir, "part").select("p_partkey", F.array_join(found, ",").alias("articles"))


@query("""SELECT p_partkey, 'See <a href="/a/' || p_size || '">article ' || p_size || '</a> and articles.' AS html FROM part""")
def article_links(spark, sf_dir):
    text = F.concat(F.lit("See article "), F.col("p_size").cast("string"), F.lit(" and articles."))
    return tables(spark, sf_dir, "part").select("p_partkey", link_articles(text, "/a/").alias("html"))


@query("SELECT page_id, CASE WHEN contains(url, '?page=') THEN regexp_extract(url, '[?&]page=([^&#]*)', 1) END AS page, CASE WHEN regexp_matches(url, '[?&]ref=') THEN 'x' END AS ref FROM pages")
def url_parameters(spark, sf_dir):
    return tables(spark, sf_dir, "pages").select("page_id", urlstate.parameter(F.col("url"), "page").alias("page"), urlstate.parameter(F.col("url"), "ref").alias("ref"))


@query("SELECT page_id, CASE regexp_extract(url, '^https?://[^/]+(/[a-z]+)', 1) WHEN '/en' THEN '/search' WHEN '/fr' THEN '/recherche' ELSE '/' END AS target FROM pages")
def legacy_paths(spark, sf_dir):
    path = F.regexp_extract("url", "^https?://[^/]+(/[a-z]+)", 1)
    return tables(spark, sf_dir, "pages").select("page_id", urlstate.translated(path, {"/en": "/search", "/fr": "/recherche"}).alias("target"))


@query("SELECT p_partkey, upper(replace(p_brand, ' ', '')) AS symbol FROM part")
def symbol_keys(spark, sf_dir):
    return tables(spark, sf_dir, "part").select("p_partkey", symbol_key(F.concat(F.lit(" "), F.lower("p_brand"), F.lit(" ."))).alias("symbol"))


@query("SELECT string_agg('- **' || r_name || '** region ' || r_regionkey || CASE WHEN r_regionkey % 2 = 0 THEN chr(10) || '  > even' ELSE '' END, chr(10) ORDER BY r_regionkey) AS text FROM region")
def workspace_export(spark, sf_dir):
    r = tables(spark, sf_dir, "region")
    items = r.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("title"), F.concat(F.lit("region "), F.col("r_regionkey").cast("string")).alias("text"), F.when(F.col("r_regionkey") % 2 == 0, "even").alias("note"))
    return workspace(items, "md")
