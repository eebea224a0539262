"""Ordered rows: runs, context windows, gaps, repairs and clusters."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def runs(df: DataFrame, keys: list[str], order: str, value: Column, out: str = "run") -> DataFrame:
    """Numbers, from 1, of stretches of rows with the same value (null equals null)."""
    w = Window.partitionBy(*keys).orderBy(order)
    changed = (~value.eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)).cast("int")
    return df.withColumn("_c", changed).withColumn(out, F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_c")


def outline(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """One row a run: its value, first and last number, and length."""
    r = runs(df, keys, order, F.col(value))
    return r.groupBy(*keys, "run", value).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"))


def context(df: DataFrame, keys: list[str], order: str, text: str, around: int = 2) -> DataFrame:
    """Each row with the texts up to `around` before and after it, within its keys."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-around, around)
    return df.withColumn("context", F.collect_list(text).over(w))


def carried(df: DataFrame, keys: list[str], order: str, value: Column, out: str) -> DataFrame:
    """The last value that wasn't null so far."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def violations(df: DataFrame, keys: list[str], order: str, number: str) -> DataFrame:
    """How often a number is below the one before it."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_p", F.lag(number).over(w)).groupBy(*keys).agg(F.sum(F.when(F.col(number) < F.col("_p"), 1).otherwise(0)).cast("long").alias("violations"))


def common_depth(path: Column, before: Column) -> Column:
    """Leading parts that two section paths share."""
    same = F.zip_with(path, F.coalesce(before, F.array().cast("array<string>")), lambda a, b: a.eqNullSafe(b) & a.isNotNull())
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")


def densest(hits: DataFrame, keys: list[str], position: str, span: int = 200) -> DataFrame:
    """keys, start and hits of the earliest window of `span` with most hits."""
    w = Window.partitionBy(*keys).orderBy(position).rangeBetween(0, span)
    best = hits.withColumn("_n", F.count(F.lit(1)).over(w)).groupBy(*keys).agg(F.max(F.struct("_n", (-F.col(position)).alias("p"))).alias("b"))
    return best.select(*keys, (-F.col("b.p")).alias("start"), F.col("b._n").alias("hits"))


#: Parent and number of a dotted id, without zeros before them.
ID = r"^0*([0-9]+)\.0*([0-9]{1,18})\.*\z"
#: Digits of all scripts, and what they stand for.
_DIGITS = [x for x in map(chr, range(0x80, 0x20000)) if x.isdecimal()]
DECIMALS = "".join(_DIGITS), "".join(str(unicodedata.decimal(x)) for x in _DIGITS)


def repair_ids(ids: list[str | None], sections: list[str | None] | None = None, rounds: int = 3) -> list[str | None]:
    """Dotted ids a.b with those mended that their neighbours in the same section make plain.

    Of three in a row: the first is too high for the other two, which follow each other (4.4, 4.2, 4.3); the
    second is below the first, and they leave one place (3.7, 3.6, 3.9); the second has another parent than
    the others and just their missing place (5.2, 8.3, 5.4). Rows are read in order, changes count at once,
    up to three times over. Ids of other shapes, and any that none of this fits, stay.
    """
    def pair(x: str | None) -> tuple[int, int] | None:
        parts = (x or "").rstrip(".").split(".")
        return (int(parts[0]), int(parts[1])) if len(parts) == 2 and all(p.isdecimal() for p in parts) else None

    ids, sections = list(ids), sections or [None] * len(ids)

    def put(i: int, parent: int, number: int) -> bool:
        ids[i] = f"{parent}.{number}" + ("." if ids[i].endswith(".") else "")
        return True

    for _ in range(rounds):
        changed = False
        for i in range(1, len(ids) - 1):
            first, now, last = pair(ids[i - 1]), pair(ids[i]), pair(ids[i + 1])
            if None in (first, now, last) or len({s or "" for s in sections[i - 1 : i + 2]}) > 1:
                continue
            family = first[0] == last[0]
            if family and now[0] == first[0] and first[1] > now[1] > 1 and last[1] == now[1] + 1:
                changed = put(i - 1, now[0], now[1] - 1)
            elif family and last[1] == first[1] + 2 and (now[1] < first[1] if now[0] == first[0] else now[1] == first[1] + 1):
                changed = put(i, first[0], first[1] + 1)
        if not changed:
            break
    return ids


def repaired(df: DataFrame, key: str, order: str, number: str, section: str | None = None, rounds: int = 3) -> DataFrame:
    """key, order, number and fixed: what repair_ids makes of each document, by windows, so no row leaves the JVM and no document has to fit in memory.

    Within a round only a mended middle row is read again, and at the row after it, which follows it then, nothing fits. So
    the ids before a round tell all its changes: of middle rows next to each other, each second one stays. Numbers of over 18 digits after the dot stay.
    """
    c, w = F.col, Window.partitionBy(key).orderBy(F.col(order).asc_nulls_last())
    digits = F.when(F.octet_length(number) == F.length(number), c(number)).otherwise(F.translate(number, *DECIMALS))
    parent, place = F.regexp_extract(digits, ID, 1), F.regexp_extract(digits, ID, 2).try_cast("long")
    part = F.coalesce(c(section).cast("string"), F.lit("")) if section else F.lit("")
    rows = df.select(key, order, c(number).cast("string").alias(number), parent.alias("_p"), place.alias("_n"), part.alias("_s"), F.lit(False).alias("_changed"))
    rows = rows.withColumn("_i", F.row_number().over(w))
    read = ["_p", "_n", "_s"] if section else ["_p", "_n"]

    def alike(*at: str) -> Column:
        """Whether three rows in a row are of one section."""
        return (c(f"_s{at[0]}") == c(f"_s{at[1]}")) & (c(f"_s{at[1]}") == c(f"_s{at[2]}")) if section else F.lit(True)

    for _ in range(rounds):
        near = {f"{x}{n}": y.over(w) for x in read for n, y in ((1, F.lag(x)), (2, F.lead(x)), (3, F.lead(x, 2)))}
        middle = alike("1", "", "2") & (c("_p1") == c("_p2")) & (c("_n2") == c("_n1") + 2) & F.when(c("_p") == c("_p1"), c("_n") < c("_n1")).otherwise(c("_n") == c("_n1") + 1)
        first = alike("", "2", "3") & (c("_p") == c("_p2")) & (c("_p") == c("_p3")) & (c("_n") > c("_n2")) & (c("_n2") > 1) & (c("_n3") == c("_n2") + 1)
        rows = rows.withColumns(near).withColumns({"_middle": F.coalesce(middle, F.lit(False)), "_first": F.coalesce(first, F.lit(False))})
        before = F.max(F.when(~c("_middle"), c("_i"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
        rows = rows.withColumn("_middle", (c("_i") - before) % 2 == 1)
        changes = {"_p": F.when(c("_middle"), c("_p1")).when(c("_first"), c("_p2")).otherwise(c("_p")), "_n": F.when(c("_middle"), c("_n1") + 1).when(c("_first"), c("_n2") - 1).otherwise(c("_n")), "_changed": c("_changed") | c("_middle") | c("_first")}
        rows = rows.withColumns(changes).select(key, order, number, "_p", "_n", "_s", "_changed", "_i")
    fixed = F.when(c("_changed"), F.concat("_p", F.lit("."), c("_n").cast("string"), F.when(F.endswith(number, F.lit(".")), ".").otherwise(""))).otherwise(c(number))
    return rows.select(key, order, number, fixed.alias("fixed"))
