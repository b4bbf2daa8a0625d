"""Daily revenue as a stored state that takes signed changes.

A run of batches concerns some orders. Before the fact tables change, what these orders count for
is written with a minus sign; afterwards, what they count for now with a plus sign. The sum of all
entries is the daily revenue of the fact tables, whether orders are new, return, move to another
day or cohort, or are processed twice. Only partitions of the fact tables in the buckets of these
orders are read.

A run's orders are noted first. A run that stopped between its two entries is closed by the next
one: its batches are part of that run, as the minus entry stands for the state before them.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlake.plans import marts
from marlake.session import stage
from marlake.sources.lake import BATCH, BUCKET, Lake, Part, bucket_of

STATE, ORDERS = "daily_revenue_entries", "daily_revenue_orders"
OLD, NEW, BASE = "old", "new", "base"
VALUES = ["order_count", "total_product_revenue", "total_freight_revenue", "total_revenue"]
MONEY = "decimal(38,2)"
# A run and its snapshot are folded once that many entries have come together.
MOST_ENTRIES = 200


@dataclass
class Run:
    """The runs (this one, and any it closes) whose orders are about to change."""

    names: list[str]


def entries(lake: Lake) -> set[str]:
    return {p.batch for p in lake.parts("gold", STATE)}


def counted(lake: Lake, order_ids: DataFrame) -> DataFrame:
    """Daily revenue of some orders, from the partitions that can hold them."""
    own = [r[0] for r in order_ids.select(bucket_of(["order_id"], lake.buckets).alias(BUCKET)).distinct().collect()]
    if not lake.parts("gold", "fct_orders") or not lake.parts("gold", "fct_order_items"):
        return lake.spark.createDataFrame([], f"date_day date, is_synthetic boolean, order_count long, {', '.join(f'{c} {MONEY}' for c in VALUES[1:])}")
    orders = lake.read("gold", "fct_orders", buckets=own).join(order_ids, "order_id", "left_semi")
    items = lake.read("gold", "fct_order_items", buckets=own).join(order_ids, "order_id", "left_semi")
    return marts.daily_revenue(orders, items)


def add_entry(lake: Lake, name: str, found: DataFrame, sign: int) -> None:
    """Write one entry; a day without a date marks the entry even where nothing is counted."""
    cast = {c: (sign * F.col(c)).cast("long" if c == "order_count" else MONEY) for c in VALUES}
    rows = found.withColumns(cast).select("date_day", "is_synthetic", *VALUES)
    mark = lake.spark.createDataFrame([(None, None, 0, 0, 0, 0)], "date_day date, is_synthetic boolean, order_count long, a int, b int, c int")
    mark = mark.select("date_day", "is_synthetic", "order_count", *[F.col(x).cast(MONEY).alias(c) for x, c in zip("abc", VALUES[1:])])
    lake.write_batches("gold", STATE, rows.unionByName(mark).withColumn(BATCH, F.lit(name)))


def begin(lake: Lake, order_ids: list[DataFrame]) -> Run:
    """Note the orders of a run and take what they count for out of the state."""
    if not lake.parts("gold", "fct_order_items") and len(order_ids) < 2:
        return Run([])  # without items nothing counts; the state starts with the first ones
    ensure(lake)
    there = entries(lake)
    open_runs = sorted(e[: -len(OLD) - 1] for e in there if e.endswith(f"-{OLD}") and f"{e[: -len(OLD) - 1]}-{NEW}" not in there)
    name = f"run-{time.time_ns():020d}"
    ids = reduce(DataFrame.union, order_ids).where("order_id is not null").distinct()
    if open_runs:  # their orders are already out
        ids = ids.join(lake.read("gold", ORDERS, open_runs), "order_id", "left_anti")
    lake.write_batches("gold", ORDERS, ids.withColumn(BATCH, F.lit(name)), settled=True)
    add_entry(lake, f"{name}-{OLD}", counted(lake, orders_of(lake, name)), -1)
    return Run([*open_runs, name])


def orders_of(lake: Lake, run: str) -> DataFrame:
    """The noted orders of a run, each once."""
    if not any(p.batch == run for p in lake.parts("gold", ORDERS)):
        return lake.spark.createDataFrame([], "order_id string")
    return lake.read("gold", ORDERS, [run]).select("order_id")


def finish(lake: Lake, run: Run) -> None:
    """Put what the run's orders count for now into the state."""
    for name in run.names:
        add_entry(lake, f"{name}-{NEW}", counted(lake, orders_of(lake, name)), 1)
    lake.remove_batches("gold", ORDERS, run.names)
    if len(entries(lake)) > MOST_ENTRIES:
        compact(lake)


def current(lake: Lake) -> DataFrame:
    """Daily revenue by purchase day and cohort, from the entries alone."""
    there = sorted(entries(lake))
    if not there:
        return counted(lake, lake.spark.createDataFrame([], "order_id string"))
    rows = lake.read("gold", STATE, there).where("date_day is not null")
    return marts.merge_daily_revenue(rows).where("order_count <> 0")


def compact(lake: Lake) -> None:
    """Fold the entries of closed runs into one; what it replaces leaves the log with the same entry."""
    ensure(lake)
    there = entries(lake)
    closed = {e for e in there if not e.endswith(f"-{OLD}") or f"{e[: -len(OLD) - 1]}-{NEW}" in there}
    if len(closed) < 2:
        return
    rows = lake.read("gold", STATE, sorted(closed)).where("date_day is not null")
    folded = stage(marts.merge_daily_revenue(rows).where("order_count <> 0"), "revenue-base")
    fold(lake, folded, closed)


def fold(lake: Lake, whole: DataFrame, replaced: set[str]) -> None:
    name = f"{BASE}-{time.time_ns():020d}"
    cast = {c: F.col(c).cast("long" if c == "order_count" else MONEY) for c in VALUES}
    mark = F.lit(name).alias(BATCH)
    rows = whole.withColumns(cast).select("date_day", "is_synthetic", *VALUES, mark)
    lake.write_batches("gold", STATE, rows, replace=[Part(e) for e in replaced])


def ensure(lake: Lake) -> None:
    """Start the state of a lake whose fact tables are older than it."""
    if not entries(lake) and lake.parts("gold", "fct_orders") and lake.parts("gold", "fct_order_items"):
        restart(lake)


def restart(lake: Lake) -> None:
    """Take the state from the fact tables, after a rebuild of all of them."""
    whole = marts.daily_revenue(lake.read("gold", "fct_orders"), lake.read("gold", "fct_order_items"))
    fold(lake, stage(whole, "revenue-base"), entries(lake))
    lake.remove_batches("gold", ORDERS, [p.batch for p in lake.parts("gold", ORDERS)])
