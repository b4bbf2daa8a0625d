"""Batch-wise maintenance of silver and gold with the functions of the full rebuild."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlake.operators.dedup import join_keys, merge_latest, repeated_keys
from marlake.plans import gold, silver
from marlake.session import stage, together
from marlake.sources.lake import BATCH, BUCKET, Lake, Part, bucket_of, in_batches, ordered_parts
from marlake.sources.schemas import TABLE_KEYS
from marlake.streaming import revenue
from marlake.streaming.windows import windows_between

SILVER_STEPS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": silver.customers,
    "orders": silver.orders,
    "order_items": silver.order_items,
    "order_payments": silver.payments,
    "order_reviews": silver.reviews,
}
FACT_STEPS = {
    "orders": "fct_orders",
    "order_items": "fct_order_items",
    "order_payments": "fct_payments",
    "order_reviews": "fct_reviews",
}
FACT_KEYS = {fact: TABLE_KEYS[table] for table, fact in FACT_STEPS.items()}
INGEST, TRANSFORM = "replay_cursor", "live_transform_cursor"
# Rows of a file, below which rows are brought together by partition before they are written.
FILE_LEAST = 10_000
# So many keys are sent to every task.
FEW_KEYS = 1_000_000


@dataclass
class Touched:
    """What a run did to a silver table: partitions it looked into, rewrote and emptied."""

    read: list[Part]
    rewritten: list[Part]
    emptied: list[Part]


def part_counts(lake: Lake, df: DataFrame, keys: list[str]) -> dict[Part, int]:
    """Partitions that the rows of a frame belong to, with their rows; at most batches times buckets of them are fetched."""
    found = df.groupBy(F.col(BATCH).cast("string").alias(BATCH), bucket_of(keys, lake.buckets).alias(BUCKET)).count()
    return {Part(batch, bucket): n for batch, bucket, n in found.collect()}


def parts_of(lake: Lake, df: DataFrame, keys: list[str]) -> set[Part]:
    """Partitions that the rows of a frame belong to."""
    return set(part_counts(lake, df, keys))


def holding(lake: Lake, layer: str, table: str, keys: list[str], incoming: DataFrame, inside: Iterable[Part]) -> set[Part]:
    """Which of these partitions hold a key of ``incoming``; only their key columns are read."""
    inside = list(inside)
    if not inside:
        return set()
    rows = lake.read(layer, table, parts=inside).select(*keys, BATCH)
    return parts_of(lake, rows.join(incoming.select(*keys).distinct(), keys, "left_semi"), keys)


def is_settled(lake: Lake, rows: int, parts: int) -> bool:
    """Whether tasks as they come out of a shuffle have rows enough for files of their own in every partition."""
    return rows >= FILE_LEAST * parts * int(lake.spark.conf.get("spark.sql.shuffle.partitions"))


def rank(batch: str | None) -> tuple[bool, str]:
    """Order of batch ids as versions of a key: as text, none at all first."""
    return batch is not None, batch or ""


def upsert_batches(lake: Lake, table: str, incoming: DataFrame, extend: bool = False) -> Touched:
    """Bring new batches into a silver table so that each key keeps its latest batch only.

    A key that arrives again can only be in its own bucket, so only the partitions of the incoming
    buckets are looked into, and only those that really hold such keys are rewritten, in the same
    dynamic overwrite as the new ones. A second run over the same batches changes nothing.

    extend -- the incoming rows may be a part of their batches; rows the table already has for
    these batches stay. Without it, incoming rows are the whole batches.
    """
    incoming = stage(incoming, f"incoming-{table}")
    return bring_in(lake, table, incoming, incoming, extend)


def upsert_arrived(lake: Lake, table: str, bronze: DataFrame) -> Touched:
    """Bring stored bronze batches into silver: like ``upsert_batches`` of their silver rows, without a copy of these.

    Only rows whose key is there more than once are compared with others. The keys are counted
    first; where most are single, the other rows go from bronze to silver without crossing the wire.
    """
    step, keys = SILVER_STEPS[table], TABLE_KEYS[table]
    repeated = stage(repeated_keys(bronze, keys), f"repeated-{table}")
    most = repeated.count()
    if not most:
        return bring_in(lake, table, step(bronze, deduplicated=True), bronze)
    if most > FEW_KEYS:
        return bring_in(lake, table, step(bronze), bronze, dealt=True)
    several, single = (join_keys(bronze, F.broadcast(repeated), keys, how) for how in ("left_semi", "left_anti"))
    return bring_in(lake, table, step(single, deduplicated=True).unionByName(step(several)), bronze)


def bring_in(lake: Lake, table: str, incoming: DataFrame, arrived: DataFrame, extend: bool = False, dealt: bool = False) -> Touched:
    """The silver rows of some batches into their table.

    arrived -- stored rows that ``incoming`` is made of, with the same keys and batches; only these columns are read
    dealt   -- incoming rows are dealt out by key; what the table has is dealt out alike, and both are merged where they lie
    """
    name, keys = f"silver_{table}", TABLE_KEYS[table]
    fresh = part_counts(lake, arrived, keys)
    if not fresh:
        return Touched([], [], [])
    there = set(lake.parts("silver", name))
    batches, buckets = {p.batch for p in fresh}, {p.bucket for p in fresh}
    looked = ordered_parts(p for p in there if p.bucket in buckets and (extend or p.batch not in batches))
    affected = holding(lake, "silver", name, keys, arrived, (p for p in looked if p not in fresh))
    affected |= set(fresh) & there if extend else set()
    settled = is_settled(lake, sum(fresh.values()), len(affected | set(fresh)))
    merged = incoming
    if affected:
        existing = lake.read("silver", name, parts=affected)
        if dealt:
            merged = merge_latest(existing.repartition(*keys) if settled else existing, incoming, keys)
        elif max(rank(p.batch) for p in affected) < min(map(rank, batches)):  # a later batch has the latest row of all its keys
            merged = join_keys(existing, arrived, keys, "left_anti").unionByName(incoming, allowMissingColumns=True)
        else:
            merged = merge_latest(existing, incoming, keys)
    old = affected if extend else affected | {p for p in there if p.batch in batches}
    # A partition whose rows were all replaced has nothing to overwrite it with.
    kept = lake.write_batches("silver", name, merged, keys, replace=old, settled=settled)
    return Touched(looked, kept, ordered_parts(old - set(kept)))


def silver_increment(bronze: DataFrame, table: str, batch_ids: list[str]) -> DataFrame:
    """The silver rows of some batches; the batch filter prunes the scan before the dedup."""
    return SILVER_STEPS[table](bronze.where(in_batches(batch_ids)))


def fact_increment(table: str, rows: DataFrame, customers: DataFrame) -> DataFrame:
    if table == "orders":
        return gold.fct_orders(rows, customers)
    return {
        "order_items": gold.fct_order_items,
        "order_payments": gold.fct_payments,
        "order_reviews": gold.fct_reviews,
    }[table](rows)


def refresh_facts(lake: Lake, table: str, batch_ids: list[str]) -> Touched:
    """Bring a fact table in line with silver for some batches.

    The fact table itself tells which older partitions still hold keys that have moved on, so the
    step does not depend on what an interrupted run did to silver before. Customers are looked up
    in the buckets of the orders' customers only.
    """
    name, fact, keys = f"silver_{table}", FACT_STEPS[table], TABLE_KEYS[table]
    there, ids = set(lake.parts("gold", fact)), set(batch_ids)
    clean = set(lake.parts("silver", name))
    wanted = {p for p in clean | there if p.batch in ids}
    fresh = lake.read("silver", name, parts=wanted)
    buckets = {p.bucket for p in wanted}
    looked = ordered_parts(p for p in there if p.bucket in buckets and p.batch not in ids)
    wanted |= holding(lake, "gold", fact, keys, fresh, looked)
    rows = lake.read("silver", name, parts=wanted)
    # Rows lie in silver as they will in the fact table, one file for one; only orders are dealt out for their join.
    customers, settled = None, True
    if table == "orders":
        settled = is_settled(lake, rows.count(), len(wanted))
        own = rows.select(bucket_of(["customer_id"], lake.buckets).alias(BUCKET)).distinct().collect()
        customers = lake.read("silver", "silver_customers", buckets=[r[0] for r in own])
    kept = lake.write_batches("gold", fact, fact_increment(table, rows, customers), keys, replace=wanted & there, settled=settled)
    return Touched(looked, kept, ordered_parts((wanted & there) - set(kept)))


def process_batches(lake: Lake, batch_ids: list[str]) -> dict[str, Touched]:
    """All silver and fact steps for some batches, and the daily revenue that follows from them.

    Every step looks at its own target and replaces exactly the partitions it owns, so after a
    crash the same call resumes by doing the steps again, with the same outcome. The revenue state
    notes which orders a run is about before it touches them, and an unfinished run is closed first.
    """
    loaded = [t for t in SILVER_STEPS if lake.exists("bronze", f"bronze_{t}")]
    bronze = {t: lake.read("bronze", f"bronze_{t}", batch_ids) for t in loaded}
    concerned = [bronze[t].select("order_id") for t in ("orders", "order_items") if t in loaded]
    # The tables do not depend on each other within a layer.
    run, *silver_done = together(
        lambda: revenue.begin(lake, concerned),
        *[lambda t=t: upsert_arrived(lake, t, bronze[t]) for t in loaded],
    )
    facts = [t for t in FACT_STEPS if t in loaded and lake.parts("silver", f"silver_{t}")]
    facts_done = together(*[lambda t=t: refresh_facts(lake, t, batch_ids) for t in facts]) if facts else []
    revenue.finish(lake, run)
    return dict(zip([*loaded, *[FACT_STEPS[t] for t in facts]], [*silver_done, *facts_done]))


def run_pending(lake: Lake, hours: int = 6) -> list[str]:
    """Process every complete window the ingest has written and the transform has not seen.

    The state row is appended last; a failure before it leaves the cursor where it was.
    """
    done = lake.get_state(TRANSFORM)
    bound = lake.get_state(INGEST)
    if done is None or bound is None:
        raise RuntimeError("both cursors need a first value, see bootstrap()")
    windows = windows_between(done, bound, hours)
    if windows:
        process_batches(lake, [batch for _, _, batch in windows])
        lake.set_state(TRANSFORM, windows[-1][1])
    return [batch for _, _, batch in windows]


def bootstrap(lake: Lake, at: datetime) -> None:
    """Set the transform cursor without processing anything."""
    lake.set_state(TRANSFORM, at)
