"""Registered queries, the views they read and the SQL they are checked against."""

from agora.catalog import item_queries, job_queries, score_queries  # noqa: F401
from agora.catalog.registry import ORACLES, QUERIES  # noqa: F401
