"""All registered queries and SQL twins by name."""

from __future__ import annotations

from locusdeck.plans import operator_queries, oracle

QUERIES = {**operator_queries.NAMED, **operator_queries.QUERIES}
ORACLE = {**oracle.CATALOGUE, **oracle.OPERATORS}
