"""All registered queries."""

from gridlens.plans import catalog_feeds, catalog_models, catalog_ops, catalog_series  # noqa: F401
from gridlens.plans.registry import REGISTRY, oracle_sql, queries

__all__ = ["REGISTRY", "oracle_sql", "queries"]
