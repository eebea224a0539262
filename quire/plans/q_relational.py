"""Joins, windows, set operations, quality aggregates and event streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import blocks, corpus, joins, ocr, sequences, sets
from quire.plans.base import folded_paras, paras, query
from quire.sources.readers import tables
from quire.streaming import events as streams

t = tables


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphans_left(spark, sf_dir):
    return joins.orphans(t(spark, sf_dir, "documents"), t(spark, sf_dir, "labels"), "doc_id")[0]


@query("SELECT doc_id FROM (SELECT doc_id + 500 AS doc_id FROM labels) WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def orphans_right(spark, sf_dir):
    shifted = t(spark, sf_dir, "labels").select((F.col("doc_id") + 500).alias("doc_id"))
    return joins.orphans(t(spark, sf_dir, "documents"), shifted, "doc_id")[1]


@query("SELECT p.doc_id, p.idx, l.quality FROM paras p LEFT JOIN labels l USING (doc_id)", paras=True)
def paragraph_document_join(spark, sf_dir):
    return paras(spark, sf_dir).join(t(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left").select("doc_id", "idx", "quality")


UNIQUE = "SELECT k, c_custkey, s_suppkey FROM (SELECT c_custkey - (c_custkey % 4 = 1)::INT AS k, c_custkey, count(*) OVER (PARTITION BY c_custkey - (c_custkey % 4 = 1)::INT) AS n FROM customer) a JOIN (SELECT s_suppkey AS k, s_suppkey FROM supplier) b USING (k) WHERE a.n = 1"


@query(UNIQUE)
def unique_key_join(spark, sf_dir):
    """Of four keys in a row, the first comes twice on the left: it is skipped."""
    c = t(spark, sf_dir, "customer").select((F.col("c_custkey") - (F.col("c_custkey") % 4 == 1).cast("int")).alias("k"), "c_custkey")
    return joins.unique_key_join(c, t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), "s_suppkey"), "k")


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN c_mktsegment END, 'x') IN ('', 'x') AS was_empty, CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE n_name END AS name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def fill_if_missing(spark, sf_dir):
    c = t(spark, sf_dir, "customer").join(t(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"), "left")
    rows = c.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, F.col("c_mktsegment")).alias("name"), "n_name")
    return joins.fill_if_missing(rows, {"name": "n_name"}).select("c_custkey", F.array_contains("filled", "name").alias("was_empty"), "name")


HOLDERS = "(VALUES (1993, 'A'), (1995, 'B'), (1997, 'C'))"


@query(f"SELECT o_orderkey, coalesce((SELECT arg_min(v, u) FROM {HOLDERS} h(u, v) WHERE u >= year(o_orderdate)), 'C') AS holder FROM orders")
def asof_holder(spark, sf_dir):
    holders = spark.createDataFrame([(1, 1993, "A"), (1, 1995, "B"), (1, 1997, "C")], "m int, until int, holder string")
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.lit(1).alias("m"))
    return joins.as_of(o, holders, ["m"], "y", "until", "holder").select("o_orderkey", "holder")


@query("SELECT file, max_by(key, exact * 1000000 + key) AS key FROM (SELECT f.file, m.key, (m.name = f.file)::INT AS exact FROM (SELECT DISTINCT p_type || '_' || p_size % 30 AS file FROM part) f LEFT JOIN (SELECT n_nationkey AS key, CASE WHEN n_nationkey % 2 = 0 THEN 'x_' ELSE '' END || 'PROMO_' || n_nationkey AS name FROM nation) m ON m.name = f.file OR ends_with(m.name, '_' || f.file)) GROUP BY 1")
def suffix_join(spark, sf_dir):
    files = t(spark, sf_dir, "part").select(F.concat_ws("_", "p_type", (F.col("p_size") % 30).cast("string")).alias("file")).distinct()
    meta = t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.concat(F.when(F.col("n_nationkey") % 2 == 0, "x_").otherwise(""), F.lit("PROMO_"), F.col("n_nationkey").cast("string")).alias("name"))
    return joins.suffix_join(files, meta, "file", "name").select("file", "key")


@query("SELECT l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_shipdate, l_linenumber) = 1")
def top1_per_key(spark, sf_dir):
    return joins.top_per_key(t(spark, sf_dir, "lineitem"), ["l_orderkey"], [F.desc("l_quantity"), F.asc("l_shipdate"), F.asc("l_linenumber")], ["l_linenumber"])


@query("SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN 'insert' WHEN n.k IS NULL THEN 'keep' WHEN n.s >= greatest(o.s + 10, floor(o.s * 1.35)) OR n.w >= greatest(o.w + 1000, floor(o.w * 1.35)) THEN 'replace' ELSE 'skip' END AS action FROM (SELECT p_partkey AS k, p_size AS s, p_size * 40 AS w FROM part WHERE p_partkey % 3 <> 0) o FULL JOIN (SELECT p_partkey AS k, p_size + p_partkey % 20 AS s, p_size * 40 + p_partkey AS w FROM part WHERE p_partkey % 4 <> 0) n USING (k)")
def staged_upsert(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    old = p.where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("s"), (F.col("p_size") * 40).alias("w"))
    new = p.where("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("k"), (F.col("p_size") + F.col("p_partkey") % 20).alias("s"), (F.col("p_size") * 40 + F.col("p_partkey")).alias("w"))
    return joins.upsert(old, new, "k", "s", "w")


@query("SELECT page_id, length(url) % 3 > 0 AS ok FROM pages")
def url_fan_out(spark, sf_dir):
    pages = t(spark, sf_dir, "pages").select("page_id", "url")
    checked = pages.select("url").distinct().withColumn("ok", F.length("url") % 3 > 0)
    return joins.fan_out(pages, checked, "url").select("page_id", "ok")


@query("SELECT a.k, a.g, a.s FROM (SELECT min(p_partkey) AS k, p_brand AS g, p_name AS s FROM part GROUP BY p_brand, p_name) a WHERE EXISTS (SELECT 1 FROM part b WHERE b.p_brand = a.g AND contains(b.p_name, a.s) AND length(b.p_name) > length(a.s))")
def near_siblings(spark, sf_dir):
    names = t(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("g"), F.col("p_name").alias("s")).agg(F.min("p_partkey").alias("k"))
    return joins.contained_siblings(names, "k", "g", "s")


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN 'fixed ' || n_nationkey ELSE n_name END AS n_name FROM nation")
def reviewed_fixes(spark, sf_dir):
    n = t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    fixes = n.where("n_nationkey % 4 = 0").select("n_nationkey", F.lit("n_name").alias("field"), F.concat(F.lit("fixed "), F.col("n_nationkey").cast("string")).alias("value"))
    approved = fixes.withColumn("approved", F.lit(" Yes ")).where(F.lower(F.trim("approved")).isin("1", "true", "yes", "y", "approved", "apply"))
    return joins.reviewed_fixes(n, approved, "n_nationkey", ["n_name"])


@query("SELECT o.o_orderkey, o.o_custkey, o.nth, c.s_suppkey FROM (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::INTEGER AS nth FROM orders) o LEFT JOIN (SELECT s_suppkey, s_nationkey AS k, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey)::INTEGER AS nth FROM supplier) c ON c.k = o.o_custkey AND c.nth = o.nth")
def nth_occurrence(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    s = t(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("long").alias("o_custkey"))
    return joins.nth_occurrence(o, s, ["o_custkey"], "o_orderkey", "s_suppkey").select("o_orderkey", "o_custkey", "nth", "s_suppkey")


@query("SELECT doc_id FROM documents WHERE doc_id % 10 < 3 AND doc_id NOT IN (SELECT doc_id FROM labels)")
def incremental_append(spark, sf_dir):
    fresh = t(spark, sf_dir, "documents").where("doc_id % 10 < 3").select("doc_id")
    return sets.new_rows(fresh, t(spark, sf_dir, "labels").select("doc_id"), "doc_id")


@query("SELECT source, count(*) AS catalogue, count(l.doc_id) AS matched, count(*) - count(l.doc_id) AS missing, round(100.0 * count(l.doc_id) / count(*), 1) AS percent FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def coverage(spark, sf_dir):
    have = t(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("m"))
    d = t(spark, sf_dir, "documents").join(have, "doc_id", "left").groupBy("source").agg(F.count(F.lit(1)).alias("catalogue"), F.count("m").alias("matched"))
    return d.select("source", "catalogue", "matched", (F.col("catalogue") - F.col("matched")).alias("missing"), F.round(100.0 * F.col("matched") / F.col("catalogue"), 1).alias("percent"))


@query("SELECT conv_id, turn, array_to_string(list(role) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), ',') AS context FROM conversations")
def context_window(spark, sf_dir):
    c = sequences.context(t(spark, sf_dir, "conversations"), ["conv_id"], "turn", "role")
    return c.select("conv_id", "turn", F.array_join("context", ",").alias("context"))


RUNS = "SELECT *, sum(c) OVER (PARTITION BY conv_id ORDER BY turn)::INTEGER AS run FROM (SELECT conv_id, turn, role, (role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn))::INT AS c FROM conversations)"


@query(f"SELECT conv_id, run, role, min(turn) AS first, max(turn) AS last, count(*) AS n FROM ({RUNS}) GROUP BY ALL")
def section_runs(spark, sf_dir):
    return sequences.outline(t(spark, sf_dir, "conversations"), ["conv_id"], "turn", "role")


@query(f"SELECT conv_id, turn, array_to_string(list(role) OVER (PARTITION BY conv_id, run ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), ',') AS context FROM ({RUNS})")
def context_in_section(spark, sf_dir):
    r = sequences.runs(t(spark, sf_dir, "conversations"), ["conv_id"], "turn", F.col("role"))
    return sequences.context(r, ["conv_id", "run"], "turn", "role").select("conv_id", "turn", F.array_join("context", ",").alias("context"))


@query("SELECT conv_id, sum(CASE WHEN n < p THEN 1 ELSE 0 END)::BIGINT AS violations FROM (SELECT conv_id, length(text) AS n, lag(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) GROUP BY 1")
def seq_violations(spark, sf_dir):
    c = t(spark, sf_dir, "conversations").withColumn("n", F.length("text"))
    return sequences.violations(c, ["conv_id"], "turn", "n")


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS said FROM conversations")
def carried_forward(spark, sf_dir):
    c = sequences.carried(t(spark, sf_dir, "conversations"), ["conv_id"], "turn", F.when(F.col("role") == "user", F.col("text")), "said")
    return c.select("conv_id", "turn", "said")


@query("SELECT doc_id, idx, start, hits FROM (SELECT doc_id, idx, p AS start, n AS hits, row_number() OVER (PARTITION BY doc_id, idx ORDER BY n DESC, p) AS r FROM (SELECT doc_id, idx, p, count(*) OVER (PARTITION BY doc_id, idx ORDER BY p RANGE BETWEEN CURRENT ROW AND 200 FOLLOWING) AS n FROM (SELECT doc_id, idx, unnest(list_filter(range(1, length(folded) + 1), lambda i: substr(folded, i, 4) = 'tion'))::INTEGER AS p FROM folded))) WHERE r = 1", paras=True)
def dense_cluster(spark, sf_dir):
    """Of every paragraph."""
    return _densest(folded_paras(spark, sf_dir))


def _densest(rows):
    pieces = F.split("folded", "tion", -1)
    at = F.aggregate(F.slice(pieces, 1, F.size(pieces) - 1), F.struct(F.lit(1).alias("p"), F.array().cast("array<int>").alias("l")), lambda a, x: F.struct((a["p"] + F.length(x) + 4).alias("p"), F.array_append(a["l"], a["p"] + F.length(x)).alias("l")), lambda a: a["l"])
    return sequences.densest(rows.select("doc_id", "idx", F.explode(at).alias("p")), ["doc_id", "idx"], "p")


@query()
def repaired_ids(spark, sf_dir):
    """Not SQL: each repair counts for the next row. Tests hold it against fixtures."""
    c = t(spark, sf_dir, "conversations")
    number = F.concat((F.col("conv_id") % 9 + 1).cast("string"), F.lit("."), F.when((F.col("turn") + F.col("conv_id")) % 3 == 0, F.col("turn") + 5).otherwise(F.col("turn") + 1).cast("string"))
    return sequences.repaired(c.select("conv_id", "turn", number.alias("number")), "conv_id", "turn", "number")


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1 UNION ALL SELECT c_custkey, -c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def dedup_upsert(spark, sf_dir):
    base = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), (-F.col("c_custkey")).alias("o_orderkey"), F.lit(0).alias("v"))
    new = t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.lit(1).alias("v"))
    return sets.last_wins(base.unionByName(new), ["o_custkey"], [F.col("v"), -F.col("o_orderkey")], ["o_orderkey"])


@query("SELECT n_nationkey AS k FROM nation INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 0")
def set_intersect(spark, sf_dir):
    return t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k")).intersect(t(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_nationkey"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def set_except(spark, sf_dir):
    return t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).join(t(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("k")), "k", "left_anti")


@query("SELECT doc_id, bool_or(k = 'b') AS bookmarked, bool_or(k = 'n') AS noted FROM (SELECT doc_id, 'b' AS k FROM labels WHERE quality = 0 UNION ALL SELECT doc_id, 'n' FROM labels WHERE toxic = 1) GROUP BY 1")
def workspace_ids(spark, sf_dir):
    lab = t(spark, sf_dir, "labels")
    both = sets.id_union(lab.where("quality = 0").select("doc_id", F.lit("b").alias("k")), lab.where("toxic = 1").select("doc_id", F.lit("n").alias("k")))
    return both.groupBy("doc_id").agg(F.max(F.col("k") == "b").alias("bookmarked"), F.max(F.col("k") == "n").alias("noted"))


@query("SELECT DISTINCT trim(unnest(string_split(p_type, ' '))) AS word FROM part")
def vocabulary(spark, sf_dir):
    return sets.vocabulary(t(spark, sf_dir, "part"), F.col("p_type"), " ", "word")


@query("SELECT lang, count(*) AS n FROM (SELECT lang FROM documents UNION ALL SELECT lang FROM documents WHERE doc_id % 2 = 0) GROUP BY 1")
def bag_union(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("lang", "doc_id")
    return d.unionByName(d.where("doc_id % 2 = 0")).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 2")
def pins_last_two(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    return joins.first_per_key(e, ["user_id"], [F.desc("ts"), F.desc("event_id")], 2).select("user_id", "event_id", "value")


@query("SELECT l_suppkey, round(sum(l_discount * greatest(l_quantity, 1)) / sum(greatest(l_quantity, 1)), 6) AS conf, round(sum((l_discount < 0.05)::INT * greatest(l_quantity, 1)) / sum(greatest(l_quantity, 1)), 6) AS low FROM lineitem GROUP BY 1")
def weighted_quality(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    return ocr.weighted_quality(li, ["l_suppkey"], F.col("l_discount"), (F.col("l_discount") < 0.05), F.col("l_quantity")).select("l_suppkey", F.round("conf", 6).alias("conf"), F.round("low", 6).alias("low"))


@query("SELECT l_orderkey, l_linenumber, round(s, 6) AS score, CASE WHEN s >= 60 THEN 'pass' WHEN s >= 30 THEN 'review' ELSE 'fail' END AS status FROM (SELECT l_orderkey, l_linenumber, l_discount * 1000 - 20 * l_tax + least(ln(1 + l_extendedprice), 9) - 15 * (l_linenumber % 2) AS s FROM lineitem) QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY s DESC, l_linenumber) = 1")
def best_candidate(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    s = ocr.candidate_score(F.col("l_discount") * 1000, F.col("l_tax"), F.col("l_extendedprice"), F.col("l_linenumber") % 2)
    best = ocr.best_candidate(li.withColumn("s", s), ["l_orderkey"], "s", "l_linenumber")
    return best.select("l_orderkey", "l_linenumber", F.round("s", 6).alias("score"), ocr.status(F.col("s"), 60, 30).alias("status"))


@query("SELECT l_orderkey, string_agg(l_linenumber::VARCHAR || ':' || l_partkey, ' ' ORDER BY l_linenumber, l_linenumber::VARCHAR || ':' || l_partkey) AS line FROM lineitem GROUP BY 1")
def line_assembly(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    return ocr.assemble(li, ["l_orderkey"], "l_linenumber", F.concat_ws(":", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string")), "line")


@query("SELECT l_shipdate::DATE AS day, count(*) AS checked, sum((l_quantity BETWEEN 20 AND 29)::INT)::BIGINT AS ok, sum((l_quantity NOT BETWEEN 20 AND 29)::INT)::BIGINT AS broken FROM lineitem GROUP BY 1")
def status_bands(spark, sf_dir):
    ok = F.col("l_quantity").between(20, 29)
    return t(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("checked"), F.sum(ok.cast("long")).alias("ok"), F.sum((~ok).cast("long")).alias("broken"))


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_quantity, l_orderkey, l_linenumber)::INTEGER AS place FROM lineitem WHERE l_quantity <= 2 AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') ORDER BY l_quantity, l_orderkey, l_linenumber LIMIT 200")
def work_queue(spark, sf_dir):
    from quire.operators.search import page

    done = t(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    todo = t(spark, sf_dir, "lineitem").where("l_quantity <= 2").join(done, "l_orderkey", "left_anti")
    top = page(todo, 1, 200, [F.col("l_quantity"), F.col("l_orderkey"), F.col("l_linenumber")])
    return top.select("l_orderkey", "l_linenumber", F.col("rank").alias("place"))


@query("SELECT docId, p_partkey FROM (SELECT p_partkey, CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY stem) > 1 THEN slug || '-' || substr(sha1(stem), 1, 6) ELSE slug END AS docId FROM (SELECT p_partkey, stem, replace(replace(lower(CASE WHEN count(*) OVER (PARTITION BY sig) = 1 THEN sig ELSE stem END), '#', '-'), ' ', '-') AS slug FROM (SELECT p_partkey, p_brand || ' ' || p_size AS sig, p_name || CASE WHEN p_partkey % 2 = 1 THEN '-' ELSE ' ' END || p_partkey // 2 AS stem FROM part)))")
def document_ids(spark, sf_dir):
    """Of every part. Stems are distinct in a table of any size; two keys in a row with one name have the same slug."""
    number = F.floor(F.col("p_partkey") / 2).cast("string")
    p = t(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_brand", F.col("p_size").cast("string")).alias("sig"), F.concat("p_name", F.when(F.col("p_partkey") % 2 == 1, "-").otherwise(" "), number).alias("stem"))
    return corpus.document_ids(p, "sig", "stem").select("docId", "p_partkey")


@query("SELECT event_id FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS p FROM events) WHERE p IS NULL OR ts > p + INTERVAL 90 MINUTE")
def events_dedupe(spark, sf_dir):
    return streams.quiet(t(spark, sf_dir, "events"), ["user_id", "event_type"], 90 * 60).select("event_id")


@query("SELECT user_id, min(ts) AS start, max(ts) AS last, count(*) AS n FROM (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, (coalesce(ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOUR, true))::INT AS c FROM events)) GROUP BY user_id, s")
def events_session(spark, sf_dir):
    return streams.sessions(t(spark, sf_dir, "events"), "user_id", "6 hours")


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def events_tumbling(spark, sf_dir):
    return streams.tumbling(t(spark, sf_dir, "events"), "1 day")


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def events_stream(spark, sf_dir):
    """The tumbling windows, by Structured Streaming over the files with a watermark; tests hold it against the batch."""
    return streams.streamed_tumbling(spark, sf_dir)


@query("SELECT l_orderkey AS doc, l_linenumber AS page, l_partkey FROM lineitem JOIN (SELECT l_orderkey, min(x) AS usual FROM (SELECT l_orderkey, x, n, max(n) OVER (PARTITION BY l_orderkey) AS best FROM (SELECT l_orderkey, l_suppkey % 3 AS x, count(*) AS n FROM lineitem WHERE l_quantity BETWEEN 5 AND 45 GROUP BY ALL)) WHERE n = best GROUP BY 1) u USING (l_orderkey) WHERE l_quantity BETWEEN 5 AND 45 AND abs(l_suppkey % 3 - usual) <= 1")
def page_bands(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page"), (F.col("l_suppkey") % 3).alias("x"), F.col("l_quantity").alias("y"), "l_partkey")
    return blocks.body_blocks(rows, 5, 45, 1).select("doc", "page", "l_partkey")


@query(r"SELECT conv_id, n, string_agg(body, ' ' ORDER BY turn) AS text FROM (SELECT conv_id, turn, CASE WHEN marker IS NULL THEN trim(line) ELSE trim(regexp_replace(line, '^\s*\d{1,3}(\.\d{1,3})?[.)]?\s+', '')) END AS body, last_value(marker IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS n FROM (SELECT *, nullif(regexp_extract(line, '^\s*(\d{1,3}(?:\.\d{1,3})?)[.)]?\s+\S', 1), '') AS marker FROM (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN (turn // 3 + 1) || '. ' || trim(text) ELSE trim(text) END AS line FROM conversations))) WHERE n IS NOT NULL GROUP BY ALL")
def numbered_lines(spark, sf_dir):
    c = t(spark, sf_dir, "conversations")
    line = F.when(F.col("turn") % 3 == 0, F.concat(F.floor(F.col("turn") / 3 + 1).cast("string"), F.lit(". "), F.trim("text"))).otherwise(F.trim("text"))
    return blocks.numbered(c.select("conv_id", "turn", line.alias("text")), ["conv_id"], "turn", "text")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'native' WHEN doc_id % 3 = 1 THEN 'plain' ELSE 'sidecar' END AS method, length(text) AS chars FROM documents")
def fallback_chain(spark, sf_dir):
    d = t(spark, sf_dir, "documents")
    text, method = blocks.first_result({"native": F.when(F.col("doc_id") % 3 == 0, F.col("text")), "plain": F.when(F.col("doc_id") % 3 == 1, F.col("text")).otherwise(" "), "sidecar": F.col("text")})
    return d.select("doc_id", method.alias("method"), F.length(text).cast("long").alias("chars"))
