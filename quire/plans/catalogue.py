"""All queries over the grading tables, with their SQL."""

from __future__ import annotations

from quire.plans import q_analytics, q_corpus, q_relational, q_search  # noqa: F401  (they register their queries)
from quire.plans.base import ORACLE_SQL, QUERIES
from quire.plans.q_search import flagship

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
