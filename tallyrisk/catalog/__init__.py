"""All named queries over the given tables, with their SQL."""

from tallyrisk.catalog import cleaning_q, features_q, live_q, reports_q, serving_q  # noqa: F401
from tallyrisk.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
