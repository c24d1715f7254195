"""Stock rules of the inventory tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds, labels and the size of one adjustment.
LOW_STOCK_BELOW = 20
OUT_OF_STOCK, LOW_STOCK, IN_STOCK = "OUT_OF_STOCK", "LOW_STOCK", "IN_STOCK"
ADJUSTED_MOVEMENT = "STOCK_ADJUSTED"
ADJUSTED_ORIGIN = "WAREHOUSE_APP"
ADJUSTED_BY = 20


def stock_status(available: Column) -> Column:
    return (
        F.when(available <= 0, OUT_OF_STOCK)
        .when(available < LOW_STOCK_BELOW, LOW_STOCK)
        .otherwise(IN_STOCK)
    )


def adjusted_stock(
    updated_at: Column, origin: str = ADJUSTED_ORIGIN, first_version: int | None = 1
) -> dict[str, Column]:
    """New values of the columns that move ``ADJUSTED_BY`` items to damaged stock.

    A missing quantity floors at 0, as ``greatest`` skips NULL. A missing version
    counts as ``first_version``; with None it stays missing.
    """
    available = F.greatest(F.col("available_quantity") - ADJUSTED_BY, F.lit(0))
    version = F.col("sync_version")
    if first_version is not None:
        version = F.coalesce(version, F.lit(first_version))
    return {
        "movement_type": F.lit(ADJUSTED_MOVEMENT),
        "available_quantity": available,
        "damaged_quantity": F.col("damaged_quantity") + ADJUSTED_BY,
        "inventory_status": stock_status(available),
        "source_system": F.lit(origin),
        "sync_version": version + 1,
        "updated_at": updated_at,
    }
