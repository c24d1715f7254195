"""Every operator as a query over the whole test tables, next to its SQL twin."""

from tidemark.acceptance.registry import ORACLES, QUERIES

from tidemark.acceptance import changes, layouts, merges, pipelines, reports, scans  # noqa: E402,F401

__all__ = ["ORACLES", "QUERIES"]
