"""All queries of the core and their SQL twins."""

from __future__ import annotations

from tidemark.plans import pipeline, problems

FLAGSHIP = "enrich_full"
QUERIES = {**pipeline.QUERIES, **problems.QUERIES}
ORACLE = {**pipeline.ORACLE, **problems.ORACLE}
