"""Where rows come from and where they go."""

from tidemark.sources.delimited import read_csv, read_rows, write_rows
from tidemark.sources.literal import literal_rows
from tidemark.sources.replica import JdbcReplica, TableReplica
from tidemark.sources.samples import sample_inventory, sample_orders, sample_warehouses

__all__ = [
    "JdbcReplica",
    "TableReplica",
    "literal_rows",
    "read_csv",
    "read_rows",
    "sample_inventory",
    "sample_orders",
    "sample_warehouses",
    "write_rows",
]
