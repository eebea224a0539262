"""A search as URL parameters: lists with bars, defaults left out; and old paths to new ones."""

from __future__ import annotations

from urllib.parse import parse_qs, urlencode

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULTS: dict[str, object] = {"q": "", "scope": "all", "from": 0, "to": 0, "labels": [], "bodies": [], "sort": "relevance", "page": 1}


def encode(state: dict) -> str:
    given = {k: state[k] for k in DEFAULTS if k in state and state[k] != DEFAULTS[k]}
    return urlencode({k: "|".join(v) if isinstance(v, list) else str(v) for k, v in given.items()})


def decode(query: str) -> dict:
    """Unknown parameters and values of another kind are left out."""
    out = {k: list(v) if isinstance(v, list) else v for k, v in DEFAULTS.items()}
    for k, values in parse_qs(query.lstrip("?")).items():
        if isinstance(out.get(k), list):
            out[k] = [x for x in values[0].split("|") if x]
        elif isinstance(out.get(k), int):
            out[k] = int(values[0]) if values[0].isdigit() else out[k]
        elif k in out:
            out[k] = values[0]
    return out


def parameter(url: Column, name: str) -> Column:
    """A parameter of a url, decoded; null if there is none."""
    raw = F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)
    return F.when(url.rlike(rf"[?&]{name}="), F.try_url_decode(raw))


def translated(path: Column, table: dict[str, str], otherwise: str = "/") -> Column:
    """The new path of an old one."""
    pairs = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.coalesce(pairs[F.regexp_replace(path, "(?<=.)/+$", "")], F.lit(otherwise))
