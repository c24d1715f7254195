"""Diffs between versions, and what is done with them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.acceptance.merges import money_as_double
from tidemark.acceptance.registry import query
from tidemark.acceptance.scans import BY_MONTH, versioned_orders
from tidemark.acceptance.views import (
    INVENTORY_TIES,
    RUN_AT,
    RUN_AT_SQL,
    VERSION_1_AT,
    corrections,
    stock_1,
    stock_2,
    table,
    v_inventory,
    v_orders,
    version_1,
    version_2,
    with_sql,
)
from tidemark.functions import ntz
from tidemark.operators import (
    apply_changes as apply_to,
    apply_corrections as correct,
    change_summary,
    compare_versions as compare,
    duplicate_keys as find_duplicates,
    effective_changes as only_effective,
    initial_replica as first_load,
    latest_per_key,
    priority_per_key,
    raw_diff,
    snapshot_diff,
    version_history as history,
)
from tidemark.plans.table import VersionedTable
from tidemark.session import work_folder

STOCK = ["city", "movement_date", "movement_type", "quantity", "updated_at"]
STOCK_TIES = ["movement_type", "quantity", "city", "movement_date"]
NULL_SAFE_STOCK = " or ".join(f"o.{c} is distinct from n.{c}" for c in STOCK)
# Strings compare with NULL as '', other types plainly.
NULL_EMPTY_STOCK = """coalesce(o.city, '') <> coalesce(n.city, '') or o.movement_date <> n.movement_date
    or coalesce(o.movement_type, '') <> coalesce(n.movement_type, '') or o.quantity <> n.quantity
    or o.updated_at <> n.updated_at"""
LATEST_STOCK = """
    select * exclude (rn) from (
        select *, row_number() over (partition by inventory_id order by updated_at desc,
            movement_type, quantity, city nulls first, movement_date nulls first) as rn from {0})
    where rn = 1"""
KIND_SQL = """case when o.inventory_id is null then 'INSERT' when n.inventory_id is null then 'DELETE'
    else 'UPDATE' end as change_type, coalesce(n.inventory_id, o.inventory_id) as inventory_id"""
NEW_STOCK = ", ".join(f"n.{c}" for c in STOCK)


@query(
    with_sql("v_inventory", "stock1", "stock2")
    + f"""
    select {KIND_SQL}, {NEW_STOCK}, count(*)::bigint as copies
    from stock1 o full join stock2 n on o.inventory_id = n.inventory_id
    where o.inventory_id is null or n.inventory_id is null or {NULL_EMPTY_STOCK}
    group by all"""
)
def diff_raw(spark, sf_dir):
    """Without dedup, every old row of a key meets every new one; the pairs are counted."""
    return raw_diff(stock_1(spark, sf_dir), stock_2(spark, sf_dir), "inventory_id")


def _diff_sql(condition: str) -> str:
    return (
        with_sql("v_inventory", "stock1", "stock2")
        + f""", o as ({LATEST_STOCK.format("stock1")}), n as ({LATEST_STOCK.format("stock2")})
        select {KIND_SQL}, {NEW_STOCK}
        from o full join n on o.inventory_id = n.inventory_id
        where o.inventory_id is null or n.inventory_id is null or {condition}"""
    )


def _stock_diff(spark, sf_dir, nulls):
    return snapshot_diff(
        stock_1(spark, sf_dir),
        stock_2(spark, sf_dir),
        "inventory_id",
        nulls=nulls,
        tie_break=STOCK_TIES,
    )


@query(_diff_sql(NULL_EMPTY_STOCK))
def diff_dedup_empty(spark, sf_dir):
    return _stock_diff(spark, sf_dir, "empty")


@query(_diff_sql(NULL_SAFE_STOCK))
def diff_dedup_nullsafe(spark, sf_dir):
    return _stock_diff(spark, sf_dir, "safe")


ORDER_COLUMNS = ["o_custkey", "order_date", "o_orderstatus", "o_totalprice", "p"]


def _order_diff_sql(nulls: str = "safe") -> str:
    changed = " or ".join(f"o.{c} is distinct from n.{c}" for c in ORDER_COLUMNS)
    new = ", ".join(f"n.{c}" for c in ORDER_COLUMNS)
    return f"""
        select case when o.o_orderkey is null then 'INSERT' when n.o_orderkey is null then 'DELETE'
                    else 'UPDATE' end as change_type,
               coalesce(n.o_orderkey, o.o_orderkey) as o_orderkey, {new}
        from s1 o full join s2 n on o.o_orderkey = n.o_orderkey
        where o.o_orderkey is null or n.o_orderkey is null or {changed}"""


def _order_diff(spark, sf_dir):
    # Order keys are unique, so there is nothing to dedup.
    return snapshot_diff(
        version_1(spark, sf_dir), version_2(spark, sf_dir), "o_orderkey", dedup_by=None
    )


@query(
    with_sql("s1", "s2")
    + f", d as ({_order_diff_sql()}) select change_type, count(*)::bigint as changes from d group by all"
)
def diff_summary(spark, sf_dir):
    return change_summary(_order_diff(spark, sf_dir), "changes")


# A target that has some of the changes already and lacks some keys.
TARGET_SQL = """
    t as (select * from s1 where o_orderkey % 5 <> 0 and o_orderkey % 6 <> 0
          union all select * from s2 where o_orderkey % 5 = 0)"""


def _target(spark, sf_dir):
    key = F.col("o_orderkey")
    old = version_1(spark, sf_dir).where((key % 5 != 0) & (key % 6 != 0))
    return old.union(version_2(spark, sf_dir).where(key % 5 == 0))


ALTERED = " or ".join(f"t.{c} is distinct from d.{c}" for c in ORDER_COLUMNS)
EFFECTIVE_SQL = f"""
    e as (select d.* from d left join t using (o_orderkey)
          where (change_type = 'DELETE' and t.o_orderkey is not null)
             or (change_type <> 'DELETE' and (t.o_orderkey is null or {ALTERED})))"""


@query(with_sql("s1", "s2") + f", d as ({_order_diff_sql()}), {TARGET_SQL}, {EFFECTIVE_SQL} select * from e")
def effective_changes(spark, sf_dir):
    """Changes that would alter a target which knows some of them already."""
    return only_effective(
        _order_diff(spark, sf_dir), _target(spark, sf_dir), "o_orderkey", ORDER_COLUMNS
    )


@query(
    with_sql("s1", "s2")
    + f""", d as ({_order_diff_sql()}), {TARGET_SQL}, {EFFECTIVE_SQL}
    select * from t where o_orderkey not in (select o_orderkey from e)
    union all select * exclude (change_type) from e where change_type <> 'DELETE'"""
)
def apply_changes(spark, sf_dir):
    target = _target(spark, sf_dir)
    found = only_effective(_order_diff(spark, sf_dir), target, "o_orderkey", ORDER_COLUMNS)
    return apply_to(target, found, "o_orderkey", source_unique=True)


@query(
    with_sql("s1", "s2")
    + """
    select s1.*, 1::bigint as version, false as is_active,
           o_orderkey not in (select o_orderkey from s2) as is_deleted from s1
    union all select s2.*, 2::bigint, true, false from s2"""
)
def version_history(spark, sf_dir):
    """Every version of every order, marked active or deleted."""
    versions = versioned_orders(spark, sf_dir).versions()
    return history(versions, "o_orderkey", latest=2)


@query(
    with_sql("s1", "s2")
    + """
    select s2.o_orderkey, s1.o_orderstatus as old_o_orderstatus, s2.o_orderstatus as current_o_orderstatus
    from s2 join s1 using (o_orderkey) where s1.o_orderstatus <> s2.o_orderstatus"""
)
def compare_versions(spark, sf_dir):
    old, current = version_1(spark, sf_dir), version_2(spark, sf_dir)
    found = compare(old, current, "o_orderkey", "o_orderstatus", dedup_by=None)
    return found.orderBy("o_orderkey")


@query(
    with_sql("v_orders")
    + f"""
    select order_id, city, order_amount::double as order_amount, order_status, updated_at
    from v_orders where not (city = 'NATION_3' and order_id % 9 = 0)"""
)
def recover_slice(spark, sf_dir):
    """A bad update of one city undone from the version before; deleted rows stay deleted."""
    orders = v_orders(spark, sf_dir).select(
        "order_id", "order_date", "city", "order_amount", "order_status", "updated_at"
    )
    held = VersionedTable.create(orders, work_folder(spark, "recover"), BY_MONTH, VERSION_1_AT)
    in_city = F.col("city") == "NATION_3"
    held.update_where(in_city, {"order_status": "CANCELLED", "updated_at": ntz(RUN_AT)})
    held.delete_matching(orders.where(in_city & (F.col("order_id") % 9 == 0)), ["order_id"])
    held.recover(1, in_city, ["order_id"])
    return money_as_double(held.as_of().drop("order_date"))


LATEST = ["inventory_id", "product_id", "warehouse_id", "city", "quantity", "damaged_quantity"]


@query(
    with_sql("v_inventory", "latest_inventory")
    + f"""
    select {", ".join(LATEST)}, updated_at as source_updated_timestamp, {RUN_AT_SQL} as updated_at
    from latest_inventory"""
)
def initial_replica(spark, sf_dir):
    loaded = first_load(
        v_inventory(spark, sf_dir), "inventory_id", RUN_AT, tie_break=INVENTORY_TIES
    )
    return loaded.select(*LATEST, "source_updated_timestamp", "updated_at")


@query(
    with_sql("v_inventory", "latest_inventory")
    + f"select {', '.join(LATEST)}, updated_at from latest_inventory"
)
def dedup_latest(spark, sf_dir):
    rows = latest_per_key(v_inventory(spark, sf_dir), ["inventory_id"], tie_break=INVENTORY_TIES)
    return rows.select(*LATEST, "updated_at")


PRIORITIES = ["finance_team", "ops_team"]
BEST_SQL = """
    select * exclude (rn) from (
        select *, row_number() over (partition by order_id order by
            case correction_source when 'finance_team' then 1 when 'ops_team' then 2 else 3 end,
            updated_at desc, order_amount) as rn
        from corr)
    where rn = 1"""


@query(
    with_sql("v_orders", "corr")
    + f""", best as ({BEST_SQL})
    select order_id, order_amount::double as order_amount, correction_source, updated_at from best"""
)
def dedup_priority(spark, sf_dir):
    best = priority_per_key(corrections(spark, sf_dir), ["order_id"], "correction_source", PRIORITIES)
    return money_as_double(best)


@query(
    """
    select l_orderkey, l_linenumber, count(*)::bigint as record_count
    from lineitem group by all having count(*) > 1"""
)
def duplicate_keys(spark, sf_dir):
    return find_duplicates(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "record_count"
    )


@query(
    with_sql("v_orders", "corr")
    + f""", best as ({BEST_SQL}),
    fraud as (select order_id from v_orders where order_id % 60 = 0)
    select o.order_id, o.city, coalesce(b.order_amount, o.order_amount)::double as order_amount,
           coalesce(b.updated_at, o.updated_at) as updated_at
    from v_orders o left join best b using (order_id)
    where o.order_id not in (select order_id from fraud)"""
)
def apply_corrections(spark, sf_dir):
    """Best correction per order merged in, then listed orders deleted."""
    orders = v_orders(spark, sf_dir)
    target = orders.select("order_id", "city", "order_amount", "updated_at")
    fraud = orders.where(F.col("order_id") % 60 == 0).select("order_id")
    corrected = correct(
        target, corrections(spark, sf_dir), fraud, "order_id", "correction_source", PRIORITIES
    )
    return money_as_double(corrected)
