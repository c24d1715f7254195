"""Tables with versions, pipeline state, and the pipelines that use them."""

from tidemark.plans.pipelines import replicate, sync_in, sync_out, two_way_sync
from tidemark.plans.state import ControlLog, Watermarks
from tidemark.plans.table import VersionedTable

__all__ = [
    "ControlLog",
    "VersionedTable",
    "Watermarks",
    "replicate",
    "sync_in",
    "sync_out",
    "two_way_sync",
]
