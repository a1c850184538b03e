"""Importing this module registers every query."""

from checks import queries_jobs, queries_models, queries_tables  # noqa: F401
from checks.registry import QUERIES  # noqa: F401
