"""All registered queries and the SQL they are checked against."""

from __future__ import annotations

from tidemark.plans import features, flows, ranking, retrieval, sampling, storage, temporal

TOPICS = [temporal, sampling, retrieval, features, flows, storage, ranking]


def all_queries() -> dict:
    return {name: query for topic in TOPICS for name, query in topic.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for topic in TOPICS for name, sql in topic.ORACLE.items()}
