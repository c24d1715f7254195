"""Operators that take DataFrames and return DataFrames."""

from tidemark.operators.change import (
    apply_changes,
    apply_corrections,
    change_summary,
    compare_versions,
    effective_changes,
    initial_replica,
    raw_diff,
    snapshot_diff,
    version_history,
)
from tidemark.operators.dedup import duplicate_keys, latest_per_key, priority_per_key
from tidemark.operators.merge import (
    delete,
    delete_matching,
    insert,
    insert_if_absent,
    merge_into,
    update,
    update_where,
    upsert,
)

__all__ = [
    "apply_changes",
    "apply_corrections",
    "change_summary",
    "compare_versions",
    "delete",
    "delete_matching",
    "duplicate_keys",
    "effective_changes",
    "initial_replica",
    "insert",
    "insert_if_absent",
    "latest_per_key",
    "merge_into",
    "priority_per_key",
    "raw_diff",
    "snapshot_diff",
    "update",
    "update_where",
    "upsert",
    "version_history",
]
