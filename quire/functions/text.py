"""Text scalars as Column expressions: all of them stay in the JVM."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MARKS = "".join(map(chr, range(0x300, 0x370)))


def _base_letters() -> dict[str, str]:
    """Lower-case characters whose canonical decomposition is one character and marks of U+0300 to U+036F, and that character."""
    out = {}
    for c in map(chr, range(0x80, 0x10000)):
        parts = unicodedata.normalize("NFD", c)
        if len(parts) > 1 and c == c.lower() and all(m in MARKS for m in parts[1:]):
            out[c] = parts[0]
    return out


#: By rule from Unicode, not a list: all letters of the scripts that have accents.
BASE = _base_letters()
#: What folding translates: letters with accents to their base, marks of their own to nothing.
ACCENTED, PLAIN = "".join(BASE) + MARKS, "".join(BASE.values())


def fold(text: Column) -> Column:
    """Lower case without diacritics, composed or not, so that word boundaries and substring tests ignore both. ASCII texts skip the translation."""
    low = F.lower(text)
    return F.when(F.octet_length(text) == F.length(text), low).otherwise(F.translate(low, ACCENTED, PLAIN))


def fold_literal(text: str) -> str:
    return text.lower().translate(BASE_TABLE)


BASE_TABLE = str.maketrans(BASE) | {ord(m): None for m in MARKS}


def accent_pattern(term: str) -> str:
    """A regex (for use without regard to case) of a term with or without accents, composed or not, in unfolded text."""
    plain, out = fold_literal(term), []
    for c in plain:
        accented = "".join(k for k, v in BASE.items() if v == c)
        out.append((f"[{c}{accented}]" if accented else re.escape(c)) + ("[\u0300-\u036f]*" if c.isalpha() else ""))
    return "".join(out)


def slugify(text: Column, width: int = 64) -> Column:
    """Folded, everything but a-z and 0-9 as single hyphens, trimmed, cut to width."""
    dashed = F.regexp_replace(F.regexp_replace(fold(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.regexp_replace(F.substring(dashed, 1, width), "-+$", "")


def occurrences(text: Column, term: str) -> Column:
    """Non-overlapping occurrences of a non-empty literal."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(term), F.lit("")))) / len(term)).cast("int")


def word_count(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.regexp_count(text, F.lit(r"[^\s]+")).cast("int")


def tokens(folded: Column) -> Column:
    """Runs of letters a-z of folded text."""
    return F.regexp_extract_all(folded, F.lit("[a-z]+"), F.lit(0))


def split_list(text: Column, separator: str = ",") -> Column:
    """Parts of a delimited text, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(text, re.escape(separator)), lambda x: F.trim(x)), lambda x: x != "")


def leading_int(text: Column) -> Column:
    return F.regexp_extract(F.trim(text), r"^(\d{1,9})", 1).try_cast("int")


def year_of(text: Column) -> Column:
    """The first four digits in a row, as a year."""
    return F.regexp_extract(text, r"(\d{4})", 1).try_cast("int")


def strip_html(text: Column) -> Column:
    """Tags as spaces, white space as one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, "<[^>]*>", " "), r"\s+", " "))


def escape_html(text: Column) -> Column:
    steps = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")]
    return reduce(lambda t, s: F.replace(t, F.lit(s[0]), F.lit(s[1])), steps, text)


def escape_csv(text: Column) -> Column:
    """RFC 4180: quoted if it holds a quote, comma or line end, with quotes doubled."""
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[",\\n\\r]'), quoted).otherwise(text)


def escape_tex(text: Column) -> Column:
    """The ten special characters; the backslash first, by way of a character that texts don't have."""
    t = F.replace(text, F.lit("\\"), F.lit("\x01"))
    t = F.regexp_replace(t, r"([&%$#_{}])", r"\\$1")
    t = F.replace(F.replace(t, F.lit("~"), F.lit(r"\textasciitilde{}")), F.lit("^"), F.lit(r"\textasciicircum{}"))
    return F.replace(t, F.lit("\x01"), F.lit(r"\textbackslash{}"))


def cite_key(*parts: Column) -> Column:
    return F.regexp_replace(F.concat_ws("", *(fold(p.cast("string")) for p in parts)), "[^a-z0-9]", "")


def highlight(text: Column, terms: list[str], mark: str = "mark") -> Column:
    """Terms wrapped in a tag, case and accents kept, the longest first where one begins another. Tags and their attributes are left alone."""
    if not terms:
        return text
    pattern = "|".join(accent_pattern(t) for t in sorted(set(terms), key=lambda t: (-len(t), t)))
    return F.regexp_replace(text, f"(?iu)({pattern})(?![^<>]*>)", f"<{mark}>$1</{mark}>")


def first_place(text: Column, term: str) -> Column:
    """Where a term first stands in unfolded text, from 1, whatever the accents; 0 if nowhere."""
    return F.regexp_instr(text, F.lit(f"(?iu){accent_pattern(term)}"))


def dehyphenate(text: Column) -> Column:
    """Words joined across line ends, soft wraps as spaces, runs of blanks as one."""
    joined = F.regexp_replace(text, r"([A-Za-z])-\n([a-z])", "$1$2")
    return F.trim(F.regexp_replace(F.regexp_replace(joined, r"\s*\n\s*", " "), "[ \t]{2,}", " "))


def drop_note_digits(text: Column) -> Column:
    """Footnote digits between a sentence's end and the next capital."""
    return F.regexp_replace(text, r"(?<=[.;:!?”\"])\d{1,3}(?=\s+[A-Z])", "")


def strip_note_markers(text: Column) -> Column:
    return F.regexp_replace(text, r"\[\[fn:\d+\]\]", "")


def numbered_parts(text: Column) -> Column:
    """Paragraphs that begin with a number and a dot at a line's start: array of (n, text)."""
    found = F.regexp_extract_all(text, F.lit(r"(?s)(?:^|\n)\d{1,4}\.\s.*?(?=\n\d{1,4}\.\s|\z)"), F.lit(0))
    trimmed = F.transform(found, lambda x: F.regexp_replace(x, r"^\n", ""))
    return F.transform(trimmed, lambda x: F.struct(F.regexp_extract(x, r"^(\d+)\.", 1).cast("int").alias("n"), F.trim(F.regexp_replace(x, r"^\d+\.\s+", "")).alias("text")))


def drop_running_lines(text: Column, pattern: str) -> Column:
    """Text without the lines that match a running header's or footer's pattern."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(pattern)), "\n")


def prettify(code: Column) -> Column:
    """some_outcome -> Some Outcome."""
    return F.initcap(F.replace(code, F.lit("_"), F.lit(" ")))


def doc_id_of(para_id: Column) -> Column:
    """The document of a paragraph id; null if it has no number part."""
    return F.nullif(F.regexp_extract(para_id, r"^(.+)-\d{4,}$", 1), F.lit(""))


def ordinal(n: Column) -> Column:
    last, tens = n % 10, n % 100
    suffix = F.when(tens.between(11, 13), "th").when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), suffix)


def dotted_key(text: Column) -> Column:
    """A dotted id as an array of numbers, which orders as the id should."""
    return F.transform(F.split(F.regexp_replace(text, r"\.+$", ""), r"\."), lambda x: x.try_cast("int"))


def file_safe(text: Column) -> Column:
    return F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_")


def short_digest(text: Column, digits: int = 16) -> Column:
    return F.substring(F.sha2(text, 256), 1, digits)


def sentence_snippet(text: Column, at: Column, before: int = 200, after: int = 360, limit: int = 900) -> Column:
    """Texts up to `limit` whole; else a window around `at` (from 1), widened to sentence bounds, with dots where cut."""
    start = F.greatest(F.lit(1), at - before)
    head = F.substr(text, F.lit(1), start - 1)
    back = F.length(F.regexp_extract(head, r"[^.!?]*$", 0))
    start = start - F.when(back <= before, back).otherwise(0)
    stop = F.least(F.length(text), at + after)
    tail = F.substr(text, stop + 1)
    ahead = F.length(F.regexp_extract(tail, r"^[^.!?]*[.!?]?", 0))
    stop = stop + F.when(ahead <= before, ahead).otherwise(0)
    cut = F.trim(F.substr(text, start, stop - start + 1))
    snippet = F.concat(F.when(start > 1, "… ").otherwise(""), cut, F.when(stop < F.length(text), " …").otherwise(""))
    return F.when(F.length(text) <= limit, text).otherwise(snippet)


def normalise_url(url: Column) -> Column:
    """http as https, without white space, fragment and final slash."""
    u = F.regexp_replace(F.trim(url), r"^http://", "https://")
    return F.regexp_replace(F.regexp_replace(u, "#.*$", ""), "/+$", "")


def article_numbers(text: Column) -> Column:
    """Numbers of articles in order of appearance, as strings: `article 7`, `arts. 2, 3 and 14 (1)`; paragraphs in brackets are dropped."""
    lists = F.regexp_extract_all(text, F.lit(r"(?i)\bart(?:icle)?s?\.?\s+(\d+(?:\s*\([^)]{1,5}\))*(?:(?:,\s*(?:and\s+|or\s+)?|\s+and\s+|\s+or\s+|\s+to\s+)\d+(?:\s*\([^)]{1,5}\))*)*)"), F.lit(1))
    bare = F.transform(lists, lambda x: F.regexp_replace(x, r"\([^)]*\)", " "))
    return F.flatten(F.transform(bare, lambda x: F.regexp_extract_all(x, F.lit(r"(\d+)"), F.lit(1))))


def plausible_articles(numbers: Column, highest: int = 99, cap: int = 12) -> Column:
    """The first `cap` different numbers up to `highest`."""
    return F.slice(F.array_distinct(F.filter(numbers, lambda n: F.coalesce(n.try_cast("int") <= highest, F.lit(True)))), 1, cap)


def link_articles(text: Column, prefix: str) -> Column:
    """Each `article N` as a link to prefix + N."""
    return F.regexp_replace(text, r"(?i)\b(article\s+(\d{1,2}))\b", f'<a href="{prefix}$2">$1</a>')


def drop_table_leaks(text: Column) -> Column:
    """Text without rows of a word table: a level, nine whole numbers, a confidence and a word."""
    return F.regexp_replace(text, r"(?m)(^|(?<=\s))[1-5](?:\s+-?\d+){9}\s+-?\d+(?:\.\d+)?\s+\S+[ \t]*(?:\n|$)", "")


def trailing_heading(text: Column) -> Column:
    """A short capitalised line after the last sentence of a paragraph; null if there is none."""
    line = F.regexp_extract(text, r"[.;:!?][\"”]?\s*\n\s*([A-Z][^\n.;:!?]{2,80})\s*$", 1)
    return F.nullif(line, F.lit(""))


def clean_list(text: Column, separators: str = r"[;,\n]") -> Column:
    """Parts of a free-form list: trimmed, without empty ones, final stops and repetitions."""
    parts = F.transform(F.split(text, separators), lambda x: F.regexp_replace(F.trim(x), r"[.\s]+$", ""))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def symbol_key(text: Column) -> Column:
    """A document symbol for comparison: upper case, without spaces and final stops."""
    return F.regexp_replace(F.upper(F.regexp_replace(text, r"\s+", "")), r"\.+$", "")


def note_map(notes: Column) -> Column:
    """Footnotes array<struct<n, text>> as a map by number; of a number that comes twice, the first."""
    first = F.filter(notes, lambda x, i: F.array_position(F.transform(notes, lambda y: y["n"]), x["n"]) == i + 1)
    return F.map_from_entries(first)


def notes_of(text: Column, notes: Column) -> Column:
    """The texts of the footnotes that a text's [[fn:N]] marks name, in order of first appearance; numbers without a note are left out."""
    numbers = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"\[\[fn:(\d{1,6})\]\]"), F.lit(1)), lambda x: x.cast("int")))
    known = note_map(notes)
    return F.array_compact(F.transform(numbers, lambda n: F.try_element_at(known, n)))


#: Titles that say nothing; lower case.
PLACEHOLDERS = ("", "untitled", "n/a", "na", "none", "null", "unknown", "-", "tbd")


def public_title(titles: list[Column], symbol: Column, country: Column) -> Column:
    """The first title that isn't empty or a placeholder, else the symbol and the country."""
    real = [F.when(~F.lower(F.trim(t)).isin(*PLACEHOLDERS), t) for t in titles]
    return F.coalesce(*real, F.concat_ws(" · ", F.nullif(symbol, F.lit("")), F.nullif(country, F.lit(""))))


def _first_words(text: Column, most: int) -> Column:
    words = F.split(F.trim(text), r"\s+")
    return F.when(F.size(words) > most, F.concat(F.array_join(F.slice(words, 1, most), " "), F.lit("…"))).otherwise(F.trim(text))


def mandate_label(mandate: Column) -> Column:
    """What a rapporteur reports on, in four words; of other mandates, the first three words."""
    on = F.regexp_extract(mandate, r"(?i)Rapporteur on (?:the )?(.+)$", 1)
    # only the first `of` or `and` becomes a sign
    topic = F.trim(F.regexp_replace(on, r"(?is)^(.*?)\s+(?:of|and)\s+(.*)$", r"$1 & $2"))
    return F.when(on != "", _first_words(topic, 4)).otherwise(_first_words(mandate, 3))


def headline(kind: Column, title: Column, body: Column, symbol: Column, country: Column, mandate: Column) -> Column:
    """A document's line by its type: body and title; treaty, symbol, country and title; mandate and title."""
    some = lambda c: F.nullif(c, F.lit(""))
    case = F.concat_ws(" · ", some(body), some(symbol), some(country))
    return F.when(kind == "gc", F.concat_ws(" · ", some(body), title)).when(kind == "jur", F.when(F.coalesce(title, F.lit("")).isin("", symbol), case).otherwise(F.concat(case, F.lit(" — "), title))).when(kind == "sp", F.concat_ws(" · ", some(mandate_label(F.coalesce(mandate, F.lit("")))), title)).otherwise(title)


def list_breaks(text: Column) -> Column:
    """A line break before each lettered item that follows a semicolon."""
    return F.regexp_replace(text, r";\s*(?=\([a-z]{1,3}\))", ";<br>")


def session_of(text: Column) -> Column:
    """The number of a session: `sixty` words aside, digits with an ordinal before `session`."""
    return F.regexp_extract(text, r"(?i)\b(\d{1,3})(?:st|nd|rd|th)?\s+session\b", 1).try_cast("int")


def symbol_of_url(url: Column) -> Column:
    """The document symbol in a url's query, decoded; null if there is none."""
    return F.nullif(F.upper(F.trim(F.try_url_decode(F.regexp_extract(url, r"(?i)[?&](?:symbolno|symbol|ds)=([^&#]+)", 1)))), F.lit(""))


def year_from(*texts: Column) -> Column:
    """The year of the first of several texts that has one."""
    return F.coalesce(*(year_of(t) for t in texts))


def is_date_marker(text: Column) -> Column:
    """A dotted number that is a date (`12.03.1998`), not a paragraph's id."""
    return F.trim(text).rlike(r"^(?:0?[1-9]|[12]\d|3[01])\.(?:0?[1-9]|1[0-2])\.(?:19|20)\d{2}\.?$")


def marker_action(before: Column, now: Column) -> Column:
    """What an id does to the sequence, of two dotted_key() arrays: next, child, sibling_up, jump or none."""
    same = F.slice(before, 1, F.size(now)) == now
    last = lambda k: F.element_at(k, -1)
    parents = (F.size(before) == F.size(now)) & (F.slice(before, 1, F.greatest(F.size(before) - 1, F.lit(0))) == F.slice(now, 1, F.greatest(F.size(now) - 1, F.lit(0))))
    child = (F.size(now) == F.size(before) + 1) & (F.slice(now, 1, F.size(before)) == before) & (last(now) == 1)
    up = (F.size(now) < F.size(before)) & (last(now) == F.element_at(before, F.greatest(F.size(now), F.lit(1))) + 1)
    return F.when(before.isNull() | now.isNull(), "none").when(parents & (last(now) == last(before) + 1), "next").when(child, "child").when(up, "sibling_up").when(same, "repeat").otherwise("jump")


def bigrams(words: Column) -> Column:
    """Neighbouring words of an array, joined by a space."""
    return F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))


def time_slug(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd-HHmm")
