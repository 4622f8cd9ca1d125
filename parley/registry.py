"""All queries of the library by name, with their SQL for comparison."""

from __future__ import annotations

from .plans import audits, files, identities, ledgers, notes, pages, relational, searches, streams, texts, transcripts  # noqa: F401  (they fill the registry)
from .plans.base import QUERIES, SQL, Query

FLAGSHIP = "transcript_turn_summary"


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
