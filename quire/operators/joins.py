"""Joins of the corpus model. No side is broadcast by hint: Spark does so by its own size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def orphans(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(keys of left without right, keys of right without left)."""
    return left.join(right, key, "left_anti").select(key), right.join(left, key, "left_anti").select(key)


def unique_key_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on keys that occur once on either side; others are skipped. Counts, not windows: a key that fills a side costs one row a task."""
    once = lambda df: df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select(key)
    return left.join(once(left), key, "left_semi").join(right.join(once(right), key, "left_semi"), key)


def fill_if_missing(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Each local column from its authority where it is null or empty, and a map of what came from there."""
    sources = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, pairs)), F.array(*((F.nullif(F.col(a), F.lit("")).isNull() & F.col(b).isNotNull()) for a, b in pairs.items()))), lambda _, v: v)
    df = df.withColumn("filled", F.map_keys(sources))
    for a, b in pairs.items():
        df = df.withColumn(a, F.coalesce(F.nullif(F.col(a), F.lit("")), F.col(b)))
    return df


def as_of(rows: DataFrame, holders: DataFrame, on: list[str], at: str, until: str, value: str) -> DataFrame:
    """rows with the value of the first holder whose `until` is not before `at`, else the last holder.

    Holders of a key become one sorted array (as many as the dimension has), so the join is an equi-join
    and no row meets more than one.
    """
    spans = holders.groupBy(*on).agg(F.array_sort(F.collect_list(F.struct(F.col(until).alias("u"), F.col(value).alias("v")))).alias("_h"))
    joined = rows.join(spans, on, "left")
    first = F.filter("_h", lambda h: h["u"] >= F.col(at))
    return joined.withColumn(value, F.coalesce(F.get(first, 0)["v"], F.element_at(F.col("_h"), -1)["v"])).drop("_h")


def suffix_join(files: DataFrame, meta: DataFrame, name: str, other: str) -> DataFrame:
    """files with the meta row of the same name, or of a name that ends with _ and the file's name.

    Names are split at each underscore into their suffixes, which makes the suffix match an equi-join.
    """
    parts = F.split(F.col(other), "_")
    tails = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "_"))
    spread = meta.withColumn("_tail", F.explode(tails)).withColumn("_exact", (F.col("_tail") == F.col(other)).cast("int"))
    best = spread.groupBy("_tail").agg(F.max(F.struct("_exact", F.struct(*meta.columns).alias("m"))).alias("b")).select("_tail", "b.m.*")
    return files.join(best, files[name] == best["_tail"], "left").drop("_tail")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key; Spark cuts each task's rows to n a key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], value: list[str]) -> DataFrame:
    return first_per_key(df, keys, order, 1).select(*keys, *value)


def upsert(old: DataFrame, new: DataFrame, key: str, size: str, words: str) -> DataFrame:
    """key and action: insert, replace if the new one is clearly larger by either measure, else skip or keep."""
    o, n = old.select(key, F.col(size).alias("os"), F.col(words).alias("ow")), new.select(key, F.col(size).alias("ns"), F.col(words).alias("nw"))
    more = (F.col("ns") >= F.greatest(F.col("os") + 10, F.floor(F.col("os") * 1.35))) | (F.col("nw") >= F.greatest(F.col("ow") + 1000, F.floor(F.col("ow") * 1.35)))
    action = F.when(F.col("os").isNull(), "insert").when(F.col("ns").isNull(), "keep").when(more, "replace").otherwise("skip")
    return o.join(n, key, "full_outer").select(key, action.alias("action"))


def fan_out(records: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """One check a distinct key, its result to all records that share it."""
    return records.join(results.dropDuplicates([key]), key, "left")


def contained_siblings(names: DataFrame, key: str, group: str, stem: str) -> DataFrame:
    """Rows whose stem is inside a longer stem of their group. Pairs meet only within a group of siblings, by equality."""
    other = names.select(F.col(group).alias("_g"), F.col(stem).alias("_s"))
    hit = (F.col(group) == F.col("_g")) & F.contains(F.col("_s"), F.col(stem)) & (F.length("_s") > F.length(stem))
    return names.join(other, hit, "left_semi").select(key, group, stem)


def reviewed_fixes(rows: DataFrame, fixes: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """rows with the approved fixes (key, field, value) of their fields; the last value of a field wins."""
    wide = fixes.groupBy(key).pivot("field", fields).agg(F.max("value"))
    wide = wide.select(key, *(F.col(f).alias(f"_{f}") for f in fields))
    out = rows.join(wide, key, "left")
    for f in fields:
        out = out.withColumn(f, F.coalesce(f"_{f}", f))
    return out.drop(*(f"_{f}" for f in fields))


def nth_occurrence(left: DataFrame, right: DataFrame, keys: list[str], order_left: str, order_right: str) -> DataFrame:
    """The n-th row of a key on the left meets the n-th on the right."""
    number = lambda df, o: df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(o)))
    return number(left, order_left).join(number(right, order_right), [*keys, "_n"], "left").withColumnRenamed("_n", "nth")


APPROVED = ("1", "true", "yes", "y", "approved", "apply")


def approved(value: Column) -> Column:
    return F.coalesce(F.lower(F.trim(value)).isin(*APPROVED), F.lit(False))


def skipped_fixes(rows: DataFrame, fixes: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, field and reason of fixes(key, field, value, approved) that reviewed_fixes() must not apply: the first of
    not approved, no value, unknown field, unknown key, unchanged."""
    now = rows.select(key, F.create_map(*(x for f in fields for x in (F.lit(f), F.col(f).cast("string")))).alias("_now"))
    f = fixes.join(now, key, "left")
    reason = F.when(~approved(F.col("approved")), "not approved").when(F.coalesce(F.trim("value"), F.lit("")) == "", "no value").when(~F.col("field").isin(*fields), "unknown field").when(F.col("_now").isNull(), "unknown key").when(F.try_element_at("_now", F.col("field")).eqNullSafe(F.col("value")), "unchanged")
    return f.withColumn("reason", reason).where("reason is not null").select(key, "field", "reason")


def main_first(rows: DataFrame, codes: str, dimension: DataFrame, code: str, main: str, name: str) -> DataFrame:
    """rows with the treaty of one of their codes: a main one before protocols, then by name."""
    keyed = rows.withColumn("_id", F.monotonically_increasing_id()).select("_id", *rows.columns, F.explode_outer(codes).alias("_code"))
    met = keyed.join(dimension.select(F.col(code).alias("_code"), F.col(main).alias("_main"), F.col(name).alias("_name")), "_code", "left")
    best = F.min(F.when(F.col("_name").isNotNull(), F.struct((~F.col("_main")).alias("p"), F.col("_name").alias("name"))))
    return met.groupBy("_id", *(c for c in rows.columns if c != codes)).agg(best.alias("b")).select(*(c for c in rows.columns if c != codes), F.col("b.name").alias("treaty"))
