"""All registered queries."""

from __future__ import annotations

from tidemark.plans import batch, models, stored, streams, versioned
from tidemark.plans.common import Query, in_utc


def all_queries() -> dict[str, Query]:
    found = {**batch.QUERIES, **streams.QUERIES, **models.QUERIES, **stored.QUERIES, **versioned.QUERIES}
    return {name: in_utc(query) for name, query in found.items()}
