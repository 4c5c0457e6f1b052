"""The full query catalogue (imports every catalogue module for registration)."""

from casebook.plans import catalog_classify, catalog_core, catalog_fields, catalog_merge, catalog_stream, catalog_tables, catalog_tagging  # noqa: F401
from casebook.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
