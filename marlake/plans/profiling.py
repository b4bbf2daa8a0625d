"""Profiles of the raw tables: volumes, shares, distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlake.functions.expr import fractional_days, mean_of, ratio
from marlake.operators.quantiles import quantiles_of, ranked_values
from marlake.plans.features import shares
from marlake.session import stage

TS = "order_purchase_timestamp"
# Weekday labels Monday first, quantiles of the summary pack.
DOW_LABELS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
# Items a sketch keeps, and the error in rank that it stays within.
SKETCH_SIZE = 800
SKETCH_ERROR = 0.01
PACK = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
CLAIMED_ONE_TIME_SHARE = 0.9688
HISTOGRAM_BINS = 60


def _filled(counts: DataFrame, period: str, step: str) -> DataFrame:
    """Add the missing periods between first and last with a count of zero."""
    bounds = counts.agg(F.min(period).alias("a"), F.max(period).alias("b")).where("a is not null")
    spine = bounds.select(F.explode(F.expr(f"sequence(a, b, interval {step})")).alias(period))
    return spine.join(counts, period, "left").select(period, F.coalesce("orders", F.lit(0)).alias("orders"))


def daily_volume(orders: DataFrame) -> DataFrame:
    days = orders.where(F.col(TS).isNotNull()).groupBy(F.to_date(TS).alias("day"))
    return _filled(days.agg(F.count(F.lit(1)).alias("orders")), "day", "1 day")


def monthly_volume(orders: DataFrame) -> DataFrame:
    months = orders.where(F.col(TS).isNotNull()).groupBy(F.trunc(F.to_date(TS), "MM").alias("month"))
    return _filled(months.agg(F.count(F.lit(1)).alias("orders")), "month", "1 month")


def spike_months(monthly: DataFrame, threshold: float = 1.5) -> DataFrame:
    """Months at least ``threshold`` population deviations above the mean month."""
    stats = monthly.agg(
        F.struct(
            F.avg("orders").alias("mean"), F.stddev_pop("orders").alias("sd"), F.count(F.lit(1)).alias("n")
        ).alias("s")
    ).scalar()
    sd = F.when(F.col("s.sd") == 0, F.lit(1.0)).otherwise(F.col("s.sd"))
    z = (F.col("orders") - F.col("s.mean")) / sd
    return (
        monthly.withColumn("s", stats)
        .withColumn("z", z)
        .where((F.col("s.n") >= 2) & (F.col("z") >= threshold))
        .select("month", "orders", "z")
    )


def dow_distribution(orders: DataFrame) -> DataFrame:
    placed = orders.where(F.col(TS).isNotNull()).groupBy(F.weekday(TS).alias("weekday"))
    labels = F.array(*[F.lit(x) for x in DOW_LABELS])
    return shares(placed.agg(F.count(F.lit(1)).alias("orders")), "orders", 4).withColumn(
        "day", F.element_at(labels, F.col("weekday") + 1)
    )


def hour_distribution(orders: DataFrame) -> DataFrame:
    placed = orders.where(F.col(TS).isNotNull()).groupBy(F.hour(TS).alias("hour"))
    return shares(placed.agg(F.count(F.lit(1)).alias("orders")), "orders", 4)


def proportions(df: DataFrame, column: str) -> DataFrame:
    """Share of each value among the rows that have one."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return shares(counted, "n", 4)


def order_profile(orders: DataFrame) -> DataFrame:
    """Date range, number of orders, mean per calendar day, rows without a purchase time."""
    days = F.datediff(F.max(F.to_date(TS)), F.min(F.to_date(TS))) + 1
    return orders.agg(
        F.min(F.to_date(TS)).alias("start_day"),
        F.max(F.to_date(TS)).alias("end_day"),
        F.count(TS).alias("total_orders"),
        F.round(ratio(F.count(TS), days), 2).alias("avg_orders_per_day"),
        F.count_if(F.col(TS).isNull()).alias("missing_timestamps"),
    )


def summary_document(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One nested row for a JSON sink: order profile, monthly counts, spike months, price pack.

    The collected lists hold one entry per month of the date range, never per order.
    """
    profile = order_profile(orders).select(F.struct("*").alias("p")).scalar()
    monthly = monthly_volume(orders)
    spikes = spike_months(monthly).agg(F.array_sort(F.collect_list("month")).alias("m")).scalar()
    pack = quantile_pack(items, "price").select(F.struct("*").alias("q")).scalar()
    months = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("month").cast("string"), "orders"))))
    return (
        monthly.agg(months.alias("monthly_order_counts"))
        .withColumns({"orders": profile, "flagged_spike_months": spikes, "price": pack})
        .select("orders", "monthly_order_counts", "flagged_spike_months", "price")
    )


def quantile_pack(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Quartiles, p95, mean and sample deviation of a column, in one row.

    The table is read once; everything comes from the counts of its distinct values.
    """
    values = ranked_values(df, column)
    n, x = F.col("n"), F.col(column)
    mean = values.agg(ratio(F.sum(x * n), F.sum(n)).alias("mean")).scalar()
    spread = values.withColumn("mean", mean).agg(
        F.struct(
            F.max("mean").alias("mean"),
            F.sqrt(ratio(F.sum(n * F.pow(x.cast("double") - F.col("mean"), 2)), F.sum(n) - 1)).alias("std"),
        ).alias("s")
    )
    pack = quantiles_of(values, column, PACK).withColumn("s", spread.scalar())
    return pack.select(
        *[F.round(c, digits).alias(c) for c in PACK],
        F.round("s.mean", digits).alias("mean"),
        F.round("s.std", digits).alias("std"),
    )


def approx_quantile_pack(df: DataFrame, column: str, accuracy: int = 10_000) -> DataFrame:
    """Cheaper pack with a fixed-size sketch; for looks, not for reference values."""
    probs = list(PACK.values())
    quantiles = F.approx_percentile(F.col(column).cast("double"), probs, accuracy)
    return df.agg(quantiles.alias("q")).select(*[F.col("q")[i].alias(n) for i, n in enumerate(PACK)])


def sketches_by(df: DataFrame, key: str, column: str, k: int = SKETCH_SIZE) -> DataFrame:
    """One mergeable quantile sketch of ``column`` per key (a day, a batch), of bounded size, to be stored."""
    return df.where(F.col(column).isNotNull()).groupBy(key).agg(
        F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("n")
    )


def merged_quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Quantiles over all given sketches (``prob``, ``quantile``, ``n`` values, number of ``sketches``).

    With the default size a quantile's rank is off by ``SKETCH_ERROR`` of all values at most, but for a chance of about one in a hundred thousand.
    """
    whole = sketches.agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("sketches"))
    at = [F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile")) for p in probs]
    return whole.where("n > 0").select(F.explode(F.array(*at)).alias("q"), "n", "sketches").select("q.*", "n", "sketches")


def items_with_category(items: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    named = products.select("product_id", "product_category_name")
    return (
        items.join(named, "product_id", "left")
        .join(translation, "product_category_name", "left")
        .withColumn(
            "category", F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown"))
        )
    )


def category_prices(categorized: DataFrame) -> DataFrame:
    """Counts of the distinct prices per category, the base of both category reports."""
    return ranked_values(categorized.select("category", "price"), "price", ["category"])


def top_categories(prices: DataFrame, limit: int = 15) -> DataFrame:
    """The categories with most items; ties by name."""
    n = F.col("n")
    return (
        prices.groupBy("category")
        .agg(F.sum(n).alias("items"), ratio(F.sum(F.col("price") * n), F.sum(n)).alias("mean_price"))
        .orderBy(F.col("items").desc(), "category")
        .limit(limit)
    )


def category_profile(categorized: DataFrame, limit: int = 15, digits: int = 2) -> DataFrame:
    """Item count, median and mean price of the top categories."""
    prices = category_prices(categorized)
    medians = quantiles_of(prices, "price", {"median": 0.5}, ["category"])
    return top_categories(prices, limit).join(medians, "category").select(
        "category",
        "items",
        F.round("median", digits).alias("median_price"),
        F.round("mean_price", digits).alias("mean_price"),
    )


def category_boxstats(categorized: DataFrame, limit: int = 15) -> DataFrame:
    """Five-number summary of prices per top category, highest median first."""
    probs = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
    prices = category_prices(categorized)
    stats = quantiles_of(prices, "price", probs, ["category"])
    chosen = stats.join(top_categories(prices, limit).select("category"), "category", "left_semi")
    return chosen.orderBy(F.col("median").desc(), "category")


def clipped_histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal bins between the minimum and the 99th percentile; larger values fall in the last."""
    values = ranked_values(df, column)
    ends = quantiles_of(values, column, {"lo": 0.0, "hi": 0.99}).select(F.struct("lo", "hi")).scalar()
    rows = (
        values.withColumn("e", ends)
        .select("n", F.least(F.col(column).cast("double"), F.col("e.hi")).alias("v"), "e.lo", "e.hi")
    )
    spot = F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    bin_no = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(F.least(spot, F.lit(bins - 1)))
    return rows.groupBy(bin_no.cast("int").alias("bin")).agg(F.sum("n").alias("n"))


def score_by_delay(reviews: DataFrame, orders: DataFrame, parity: bool = True) -> DataFrame:
    """Mean review score of late and other orders.

    parity -- an order without delivery counts as on time; otherwise it is left out.
    """
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    flagged = orders.select("order_id", (F.coalesce(late, F.lit(False)) if parity else late).alias("late"))
    joined = reviews.select("order_id", "review_score").join(flagged.where(F.col("late").isNotNull()), "order_id")
    return joined.groupBy(F.when(F.col("late"), "delayed_orders").otherwise("on_time_orders").alias("delivery")).agg(
        F.round(mean_of("review_score"), 2).alias("avg_score"), F.count(F.lit(1)).alias("n")
    )


def delivery_profile(orders: DataFrame, digits: int = 2) -> DataFrame:
    """Delivered orders with all dates: number, quantiles of the delivery time, share late."""
    done = (
        orders.where(F.col("order_status") == "delivered")
        .dropna(subset=["order_delivered_customer_date", "order_estimated_delivery_date", TS])
        .select(
            fractional_days(TS, "order_delivered_customer_date").alias("delivery_days"),
            (F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")).alias("late"),
        )
    )
    done = stage(done, "delivered")
    counted = done.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.round(ratio(F.count_if("late"), F.count(F.lit(1))), 4).alias("late")
        ).alias("c")
    ).scalar()
    return (
        quantile_pack(done, "delivery_days", digits)
        .withColumn("c", counted)
        .select("*", F.col("c.n").alias("delivered_orders"), F.col("c.late").alias("late_share"))
        .drop("c")
    )


def repeat_check(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Persons with one and with several orders, against the claimed share of one-time buyers."""
    per_person = (
        orders.select("order_id", "customer_id")
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id", "left")
        .where(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id")
        .agg(F.count_distinct("order_id").alias("n"))
    )
    row = per_person.agg(
        F.count(F.lit(1)).alias("persons"),
        F.count_if(F.col("n") == 1).alias("one_time"),
        F.count_if(F.col("n") > 1).alias("repeat"),
    ).withColumn("one_time_share", F.round(ratio("one_time", "persons"), 4))
    return row.withColumn(
        "matches_claim", F.abs(F.col("one_time_share") - F.lit(CLAIMED_ONE_TIME_SHARE)) < 0.01
    )
