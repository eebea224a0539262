"""Rule tables as data, and the expressions that apply them. The first matching rule decides, or all that match."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels by pattern over folded text; a demonstration table, to be replaced by one's own.
LABELS = {
    "license": [r"\blicen[cs]e", r"\bcopyright\b"],
    "contact": [r"[a-z0-9._]@[a-z0-9.]", r"\b\d{3}[- ]\d{4}\b"],
    "secret": [r"\bpassword\b", r"\bapi[_ ]?key\b", r"\btoken\b"],
    "function_words": [r"\bthe\b", r"\bque\b", r"\bder\b", r"\bles\b"],
    "numbers": [r"\d{2,}"],
}
#: Report types by the first pattern that a title has.
REPORT_TYPES = [("visit", r"\b(visit|mission)\b"), ("follow_up", r"\bfollow.?up\b"), ("thematic", r"\b(study|report) on\b"), ("annual", r"\b(annual|report)\b")]
#: Outcomes by the first pattern that a title or else a text's end has, in lower case. Negations come first: they hold the words of what they deny.
OUTCOMES = [
    ("no_violation", r"\bno (?:[a-z]+ )?violations?\b|\b(?:do|does|did) not (?:disclose|reveal|show|constitute|amount to) (?:a |any )?(?:[a-z]+ )?violations?\b|\bnon.violation\b"),
    ("inadmissible", r"\binadmissib|\bnot admissible\b"),
    ("discontinued", r"\bdiscontinu|\bstruck off\b"),
    ("violation", r"\bviolations?\b"),
    ("admissible", r"\badmissib"),
]
#: How opinions of single members begin, after a decision; of use only in a text's later part.
OPINIONS = r"(?:individual|separate|dissenting|concurring|joint) opinions? "
OPINIONS_FROM = 0.6
OUTCOME_TAIL = 22_000


def labels(folded: Column, table: dict[str, list[str]] = LABELS) -> Column:
    """Sorted labels of which any pattern matches."""
    hits = [F.when(folded.rlike("|".join(f"(?:{p})" for p in patterns)), F.lit(name)) for name, patterns in sorted(table.items())]
    return F.array_compact(F.array(*hits))


def first_rule(text: Column, table: list[tuple[str, str]], otherwise: str | None = None) -> Column:
    return reduce(lambda rest, rule: F.when(text.rlike(rule[1]), rule[0]).otherwise(rest), reversed(table), F.lit(otherwise).cast("string"))


def auto_labels(human: Column, folded: Column, table: dict[str, list[str]] = LABELS) -> Column:
    """Human labels where there are any; rules label the rest."""
    return F.when(F.coalesce(F.size(human), F.lit(0)) > 0, human).otherwise(labels(folded, table))


def without_opinions(text: Column) -> Column:
    """Text up to the first opinion that begins after OPINIONS_FROM of it."""
    start = F.floor(F.length(text) * OPINIONS_FROM).cast("int")
    at = F.regexp_instr(F.substr(text, start + 1), F.lit(f"(?i){OPINIONS}"))
    return F.when(at > 0, F.substr(text, F.lit(1), start + at - 1)).otherwise(text)


def outcome(title: Column, body: Column, table: list[tuple[str, str]] = OUTCOMES) -> Column:
    """By the title; if that says nothing, by the last OUTCOME_TAIL characters of the body without trailing opinions."""
    body = without_opinions(body)
    tail = F.substr(body, F.greatest(F.lit(1), F.length(body) - OUTCOME_TAIL + 1))
    return F.coalesce(first_rule(F.lower(title), table), first_rule(F.lower(tail), table), F.lit("unknown"))


def keyword_labels(text: Column, table: dict[str, list[str]]) -> Column:
    """Sorted labels of which any keyword stands in the lower-cased text, padded with spaces: the older annotator, without patterns."""
    padded = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    hits = [F.when(reduce(lambda a, b: a | b, [F.contains(padded, F.lit(f" {w} ")) for w in words]), F.lit(name)) for name, words in sorted(table.items())]
    return F.array_compact(F.array(*hits))


def corrected(text: Column, table: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(text with all corrections, their number): each rule counts on what the rules before it left."""
    count = F.lit(0)
    for pattern, replacement in table:
        count = count + F.regexp_count(text, F.lit(pattern))
        text = F.regexp_replace(text, pattern, replacement)
    return text, count


def shard_of(body: Column, year: Column, spans: dict[str, int], pooled: str = "other") -> Column:
    """Bodies with a span get shards of so many years; all others share one."""
    return reduce(lambda rest, kv: F.when(body == kv[0], F.concat_ws("-", body, (F.floor(year / kv[1]) * kv[1]).cast("int").cast("string"))).otherwise(rest), spans.items(), F.lit(pooled))
