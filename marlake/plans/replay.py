"""Calendar resampling: historical days replayed on later dates, as joins.

All randomness is a hash of stable ids, so a run repeated on other machines gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlake.functions.expr import hash_int, hash_normal, hash_uniform
from marlake.operators.ordered import running
from marlake.sources.lake import synthetic_pool

TS = "order_purchase_timestamp"
# Defaults of the generator.
NOISE = 0.03
FLOOR_AMOUNT = 0.5
REPEAT_RATE = 0.0312
JITTER_MINUTES = 45
STABLE_START, STABLE_END = "2017-01-01", "2018-08-31"
DAYS_PER_YEAR = 365.25


def stable_orders(orders: DataFrame, start: str = STABLE_START, end: str = STABLE_END) -> DataFrame:
    """Orders bought inside the window of normal volume, with their purchase day."""
    day = F.to_date(TS)
    return orders.where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).withColumn(
        "purchase_date", day
    )


def of_orders(children: DataFrame, orders: DataFrame) -> DataFrame:
    """Child rows whose order is kept."""
    return children.join(orders.select("order_id"), "order_id", "left_semi")


def calendar_buckets(orders: DataFrame) -> DataFrame:
    """Distinct purchase days per (month, weekday); at most one entry per calendar day."""
    days = orders.select("purchase_date").distinct()
    return days.groupBy(
        F.month("purchase_date").alias("month"), F.weekday("purchase_date").alias("weekday")
    ).agg(F.array_sort(F.collect_list("purchase_date")).alias("dates"))


def template_dates(targets: DataFrame, buckets: DataFrame) -> DataFrame:
    """One historical day for each target day: same month and weekday, else same weekday."""
    fallback = buckets.groupBy("weekday").agg(
        F.array_sort(F.flatten(F.collect_list("dates"))).alias("any_dates")
    )
    keyed = targets.select(
        "target_date", F.month("target_date").alias("month"), F.weekday("target_date").alias("weekday")
    )
    dates = F.coalesce("dates", "any_dates")
    pick = F.element_at(dates, (1 + F.pmod(hash_int(F.lit("day"), "target_date"), F.size(dates))).cast("int"))
    return (
        keyed.join(buckets, ["month", "weekday"], "left")
        .join(fallback, "weekday")
        .select("target_date", pick.alias("template_date"))
    )


def growth_factor(target: Column, rate: float, start: str) -> Column:
    days = F.datediff(target, F.lit(start).cast("date"))
    return F.pow(F.lit(float(rate)), days / F.lit(DAYS_PER_YEAR))


def replayed_windows(orders: DataFrame, windows: DataFrame, templates: DataFrame) -> DataFrame:
    """Orders of the template day whose purchase hour lies in the window, for many windows at once.

    windows -- target_date, start_hour, end_hour, batch_id; one row per six-hour block.
    """
    days = F.broadcast(
        windows.join(templates, "target_date").withColumnsRenamed(
            {"template_date": "purchase_date", "batch_id": "window_batch"}
        )
    )
    hour = F.hour(TS)
    return (
        orders.join(days, "purchase_date")
        .where((hour >= F.col("start_hour")) & (hour < F.col("end_hour")))
        .drop("start_hour", "end_hour")
        .withColumnRenamed("purchase_date", "template_date")
    )


def replayed(orders: DataFrame, templates: DataFrame, hours: tuple[int, int] | None = None) -> DataFrame:
    """Orders of each target's template day, optionally of some purchase hours only."""
    if hours is not None:
        orders = orders.where(F.hour(TS).between(hours[0], hours[1] - 1))
    # One row per target day, so the broadcast side is bounded by the calendar.
    days = F.broadcast(templates.withColumnRenamed("template_date", "purchase_date"))
    return orders.join(days, "purchase_date").withColumnRenamed("purchase_date", "template_date")


def grown(replay: DataFrame, rate: float, start: str) -> DataFrame:
    """Thin out or repeat the orders of a target day to the volume its growth factor asks for.

    Orders get a hashed rank within their day; whole rounds are copies of all of them and the
    rest goes to the lowest ranks. A day of any size is ranked in chunks.
    """
    if rate == 1.0:
        return replay.withColumn("copy_no", F.lit(0))
    marked = replay.withColumn("_h", hash_int(F.lit("growth"), "order_id", "target_date"))
    ranked = running(
        marked, ["target_date"], ["_h", "order_id"], sums={"_rank": F.lit(1)}, totals={"_n": "_rank"}
    )
    wanted = F.greatest(F.lit(1), F.round(F.col("_n") * growth_factor(F.col("target_date"), rate, start)))
    copies = F.floor(wanted / F.col("_n")) + (F.col("_rank") < F.pmod(wanted, F.col("_n"))).cast("bigint")
    return (
        ranked.withColumn("_copies", copies.cast("int"))
        .where("_copies > 0")
        .withColumn("copy_no", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
        .drop("_h", "_rank", "_n", "_copies")
    )


def _new_id(kind: str, *parts) -> Column:
    return F.concat(F.lit("synth-"), F.substring(F.sha2(F.concat_ws("|", F.lit(kind), *parts), 256), 1, 32))


def day_batch() -> Column:
    return F.concat(F.lit("backfill-"), F.col("target_date").cast("string"))


def shifted_orders(replay: DataFrame, batch_id: Column | None = None) -> DataFrame:
    """New orders on the target day; all deltas between lifecycle times are kept.

    The base time is the target day with the historical time of day and up to 45 minutes of
    jitter. The historical id stays in ``template_order_id`` for the children.
    """
    if "copy_no" not in replay.columns:
        replay = replay.withColumn("copy_no", F.lit(0))
    batch = batch_id if batch_id is not None else day_batch()
    tagged = replay.withColumn("new_batch", batch)
    jitter = F.pmod(
        hash_int(F.lit("jitter"), "order_id", "new_batch", "copy_no"), F.lit(2 * JITTER_MINUTES)
    ) - F.lit(JITTER_MINUTES)
    seconds = F.unix_micros(F.col(TS)) - F.unix_micros(F.col("template_date").cast("timestamp"))
    moved = F.unix_micros(F.col("target_date").cast("timestamp")) + seconds + jitter * F.lit(60_000_000)
    based = tagged.withColumn("_shift", moved - F.unix_micros(F.col(TS)))

    def shift(name):
        return F.timestamp_micros(F.unix_micros(F.col(name)) + F.col("_shift")).alias(name)

    return based.select(
        _new_id("order", "order_id", "new_batch", F.col("copy_no").cast("string")).alias("order_id"),
        F.col("order_id").alias("template_order_id"),
        F.col("customer_id").alias("template_customer_id"),
        "order_status",
        *[
            shift(c)
            for c in (
                TS,
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            )
        ],
        F.col("_shift").alias("shift_micros"),
        "target_date",
        F.lit(True).alias("is_synthetic"),
        F.col("template_date").alias("source_template_date"),
        F.col("new_batch").alias("batch_id"),
    )


def noisy(amount: str, kind: str, *keys, std: float = NOISE) -> Column:
    """Amount with relative noise, at least 0.50, in cents; null stays null."""
    changed = F.col(amount).cast("double") * (1 + hash_normal(F.lit(kind), *keys) * std)
    return F.when(
        F.col(amount).isNotNull(), F.round(F.greatest(changed, F.lit(FLOOR_AMOUNT)), 2)
    ).cast("decimal(18,2)")


def _children(rows: DataFrame, new_orders: DataFrame) -> DataFrame:
    parents = new_orders.select(
        F.col("template_order_id").alias("order_id"),
        F.col("order_id").alias("new_order_id"),
        "shift_micros",
        F.col("batch_id").alias("new_batch"),
    )
    keep = [c for c in rows.columns if c not in ("is_synthetic", "batch_id", "source_template_date")]
    return rows.select(*keep).join(parents, "order_id")


def _moved(name: str) -> Column:
    return F.timestamp_micros(F.unix_micros(F.col(name)) + F.col("shift_micros")).alias(name)


def replayed_items(items: DataFrame, new_orders: DataFrame) -> DataFrame:
    keys = ("new_order_id", "order_item_id")
    return _children(items, new_orders).select(
        F.col("new_order_id").alias("order_id"),
        "order_item_id",
        "product_id",
        "seller_id",
        _moved("shipping_limit_date"),
        noisy("price", "price", *keys).alias("price"),
        noisy("freight_value", "freight", *keys).alias("freight_value"),
        F.lit(True).alias("is_synthetic"),
        F.col("new_batch").alias("batch_id"),
    )


def replayed_payments(payments: DataFrame, new_orders: DataFrame) -> DataFrame:
    return _children(payments, new_orders).select(
        F.col("new_order_id").alias("order_id"),
        "payment_sequential",
        "payment_type",
        "payment_installments",
        noisy("payment_value", "payment", "new_order_id", "payment_sequential").alias("payment_value"),
        F.lit(True).alias("is_synthetic"),
        F.col("new_batch").alias("batch_id"),
    )


def replayed_reviews(reviews: DataFrame, new_orders: DataFrame) -> DataFrame:
    """Reviews follow their order; comments are not copied."""
    return _children(reviews, new_orders).select(
        _new_id("review", "review_id", "new_order_id").alias("review_id"),
        F.col("new_order_id").alias("order_id"),
        "review_score",
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_message"),
        _moved("review_creation_date"),
        _moved("review_answer_timestamp"),
        F.lit(True).alias("is_synthetic"),
        F.col("new_batch").alias("batch_id"),
    )


def with_customers(new_orders: DataFrame, customers: DataFrame, rate: float = REPEAT_RATE) -> DataFrame:
    """Give each new order a customer: now and then one of the pool, else a new person.

    A new person has the geographic profile of the template order's customer. The pool holds all
    synthetic customers that exist before this run, numbered in the order of their ids.
    """
    pool = synthetic_pool(customers)
    drawn = new_orders.withColumns(
        {
            "_u": hash_uniform(F.lit("repeat"), "order_id"),
            "_h": hash_int(F.lit("pool"), "order_id"),
        }
    )
    slots = running(
        pool.select("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
        [],
        ["customer_id"],
        sums={"_slot": F.lit(1)},
    )
    size = slots.agg(F.count(F.lit(1)).alias("n")).scalar()
    reuse = (F.col("_pool") > 0) & (F.col("_u") < rate)
    slotted = drawn.withColumn("_pool", size).withColumn(
        "_slot", F.when(reuse, F.pmod(F.col("_h"), F.greatest(F.col("_pool"), F.lit(1))))
    )
    known = slots.toDF("p_id", "p_person", "p_zip", "p_city", "p_state", "_slot")
    profile = customers.select(
        F.col("customer_id").alias("template_customer_id"),
        F.col("customer_zip_code_prefix").alias("c_zip"),
        F.col("customer_city").alias("c_city"),
        F.col("customer_state").alias("c_state"),
        F.lit(True).alias("c_known"),
    )
    joined = slotted.join(known, "_slot", "left").join(profile, "template_customer_id", "left")
    repeat = F.col("_slot").isNotNull()

    def copied(pooled, own, unknown):
        return F.when(repeat, F.col(pooled)).when(F.col("c_known"), F.col(own)).otherwise(F.lit(unknown))

    return joined.select(
        *[c for c in new_orders.columns],
        F.when(repeat, F.col("p_id")).otherwise(_new_id("customer", "order_id", "batch_id")).alias("customer_id"),
        F.when(repeat, F.col("p_person"))
        .otherwise(_new_id("person", "order_id", "batch_id"))
        .alias("customer_unique_id"),
        copied("p_zip", "c_zip", "0").alias("customer_zip_code_prefix"),
        copied("p_city", "c_city", "unknown").alias("customer_city"),
        copied("p_state", "c_state", "NA").alias("customer_state"),
        (~repeat).alias("is_new_customer"),
    )
