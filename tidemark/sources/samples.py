"""Made-up orders and inventory, computed from row ids.

Every value is a hash of the id, the seed and the column name, so a row is the same
wherever and however often it is computed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import stock_status

# The domains the sample rows are drawn from.
ORDER_CITIES = ["Kolkata", "Mumbai", "Bangalore", "Delhi", "Hyderabad", "Pune", "Chennai"]
ORDER_CATEGORIES = ["Electronics", "Fashion", "Grocery", "Home", "Beauty", "Sports"]
ORDER_STATUSES = ["PLACED", "SHIPPED", "DELIVERED"]
PAYMENT_STATUSES = ["PAID", "PENDING"]
STOCK_REGIONS = {
    "Kolkata": "East",
    "Mumbai": "West",
    "Bangalore": "South",
    "Delhi": "North",
    "Hyderabad": "South",
    "Pune": "West",
    "Chennai": "South",
    "Jaipur": "North",
    "Lucknow": "North",
}
WAREHOUSE_TYPES = ["FULFILLMENT_CENTER", "DARK_STORE", "REGIONAL_HUB"]
STOCK_CATEGORIES = ["Electronics", "Fashion", "Grocery", "Home", "Beauty", "Sports", "Automotive"]
MOVEMENT_TYPES = [
    "STOCK_RECEIVED",
    "STOCK_SOLD",
    "STOCK_RETURNED",
    "STOCK_TRANSFERRED",
    "STOCK_DAMAGED",
    "STOCK_ADJUSTED",
]
SOURCE_SYSTEMS = ["WAREHOUSE_APP", "ERP", "POS", "SUPPLIER_FEED"]
FIRST_DAY = "2026-01-01"
WAREHOUSES_PER_CITY = 3
ORDER_ID_BASE = 100000
INVENTORY_ID_BASE = 500000


def numbered(spark: SparkSession, rows: int) -> DataFrame:
    """Ids 1 to ``rows``."""
    return spark.range(1, rows + 1)


def draw(row: Column, seed: int, name: str, choices: int) -> Column:
    """A number in ``[0, choices)`` for a row and a column name."""
    digest = F.md5(F.concat_ws(":", row.cast("string"), F.lit(str(seed)), F.lit(name)).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % choices


def _pick(values: Sequence[str], place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (place + 1).cast("int"))


def _code(letter: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(letter), F.lpad(number.cast("string"), width, "0"))


def _text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def sample_orders(ids: DataFrame, row: str = "id", seed: int = 42) -> DataFrame:
    """One order per id: 300 customers, 61 days, amounts of 300 to 75,000, updated 1 to 48 h later."""
    number = F.col(row)

    def pick(name, values):
        return _pick(values, draw(number, seed, name, len(values)))

    day = F.date_add(F.lit(FIRST_DAY).cast("date"), draw(number, seed, "order_date", 61).cast("int"))
    hours = draw(number, seed, "updated_at", 48) + 1
    moment = day.cast("timestamp_ntz") + F.make_dt_interval(hours=hours.cast("int"))
    return ids.select(
        (number + ORDER_ID_BASE).alias("order_id"),
        _code("C", draw(number, seed, "customer_id", 300) + 1, 4).alias("customer_id"),
        day.cast("string").alias("order_date"),
        pick("product_category", ORDER_CATEGORIES).alias("product_category"),
        pick("city", ORDER_CITIES).alias("city"),
        ((draw(number, seed, "order_amount", 7470001) + 30000) / F.lit(100.0)).alias("order_amount"),
        pick("order_status", ORDER_STATUSES).alias("order_status"),
        pick("payment_status", PAYMENT_STATUSES).alias("payment_status"),
        _text(moment).alias("updated_at"),
    )


def sample_warehouses(spark: SparkSession, seed: int = 42) -> DataFrame:
    """Three warehouses in each of nine cities."""
    cities = list(STOCK_REGIONS)
    number = F.col("id")
    place = F.floor((number - 1) / WAREHOUSES_PER_CITY)
    return numbered(spark, len(cities) * WAREHOUSES_PER_CITY).select(
        _code("W", number, 4).alias("warehouse_id"),
        _pick(cities, place).alias("city"),
        _pick(list(STOCK_REGIONS.values()), place).alias("region"),
        _pick(WAREHOUSE_TYPES, draw(number, seed, "warehouse_type", 3)).alias("warehouse_type"),
    )


def sample_inventory(ids: DataFrame, row: str = "id", seed: int = 42) -> DataFrame:
    """One stock movement per id, in the warehouses of ``sample_warehouses``.

    Sold items lower the stock (not below 0), received ones raise it, damaged ones add
    to the damage.
    """
    number = F.col(row)
    cities = list(STOCK_REGIONS)

    def at_most(name, choices):
        return draw(number, seed, name, choices)

    drawn = ids.select(
        number.alias("__row"),
        (at_most("warehouse_id", len(cities) * WAREHOUSES_PER_CITY) + 1).alias("__warehouse"),
        _pick(MOVEMENT_TYPES, at_most("movement_type", len(MOVEMENT_TYPES))).alias("movement_type"),
        (at_most("quantity", 500) + 1).cast("int").alias("quantity"),
        at_most("available_quantity", 1001).cast("int").alias("__stock"),
        at_most("damaged_quantity", 51).cast("int").alias("__damaged"),
    )
    number = F.col("__row")
    kind, quantity, stock = F.col("movement_type"), F.col("quantity"), F.col("__stock")
    available = (
        F.when(kind == "STOCK_SOLD", F.greatest(stock - quantity, F.lit(0)))
        .when(kind == "STOCK_RECEIVED", stock + quantity)
        .otherwise(stock)
    )
    more_damage = (at_most("more_damage", 30) + 1).cast("int")
    damaged = F.col("__damaged") + F.when(kind == "STOCK_DAMAGED", more_damage).otherwise(0)
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), at_most("movement_date", 91).cast("int"))
    moment = day.cast("timestamp_ntz") + F.make_dt_interval(
        hours=(at_most("updated_hour", 72) + 1).cast("int"),
        mins=at_most("updated_minute", 60).cast("int"),
    )
    return drawn.select(
        (number + INVENTORY_ID_BASE).alias("inventory_id"),
        _code("P", at_most("product_id", 5000) + 1, 5).alias("product_id"),
        _code("W", F.col("__warehouse"), 4).alias("warehouse_id"),
        _pick(cities, F.floor((F.col("__warehouse") - 1) / WAREHOUSES_PER_CITY)).alias("city"),
        day.cast("string").alias("movement_date"),
        _pick(STOCK_CATEGORIES, at_most("product_category", len(STOCK_CATEGORIES))).alias(
            "product_category"
        ),
        "movement_type",
        "quantity",
        available.alias("available_quantity"),
        at_most("reserved_quantity", 201).cast("int").alias("reserved_quantity"),
        damaged.alias("damaged_quantity"),
        stock_status(available).alias("inventory_status"),
        _text(moment).alias("updated_at"),
        _pick(SOURCE_SYSTEMS, at_most("source_system", len(SOURCE_SYSTEMS))).alias("source_system"),
        F.lit(1).alias("sync_version"),
    )
