"""Order, seller and customer features for training (point in time) and scoring (current)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlake.functions.expr import (
    floor_at,
    fractional_days,
    haversine_km,
    ratio,
    shrink,
    zip_pad,
)
from marlake.operators.dedup import first_per_key
from marlake.operators.ewma import prior_ewma
from marlake.operators.priors import current_rate, overall_mean, prior_mean
from marlake.operators.quantiles import median
from marlake.session import stage, together

# Smoothing and shrinkage weights, holiday months, label limit.
EWMA_ALPHA = 0.3
ROUTE_WEIGHT = 15.0
SELLER_WEIGHT = 10.0
HOLIDAY_MONTHS = (11, 12)
NEGATIVE_SCORE = 2

# Inputs of the models, which must match by name.
DELIVERY_NUMERIC = [
    "price",
    "freight_value",
    "n_items",
    "payment_installments",
    "purchase_day_of_week",
    "purchase_month",
    "promised_delivery_days",
    "seller_customer_distance_km",
    "total_weight_g",
    "total_volume_cm3",
    "n_sellers",
    "is_holiday_season",
    "freight_ratio",
    "seller_ewma_delay_rate",
    "category_prior_delay_rate",
    "customer_state_prior_delay_rate",
    "promised_vs_category_typical",
    "distance_x_holiday_season",
    "seller_state_to_customer_state",
]
DELIVERY_CATEGORICAL = ["main_category", "payment_type", "seller_state"]
REVIEW_NUMERIC = [
    "price",
    "freight_value",
    "n_items",
    "delivery_days",
    "promised_delivery_days",
    "is_delayed_num",
    "delay_magnitude_days",
    "seller_ewma_delay_rate",
    "n_sellers",
    "total_weight_g",
    "total_volume_cm3",
    "is_delayed_x_price",
]
REVIEW_CATEGORICAL = ["main_category", "payment_type"]
VALUE_NUMERIC = [
    "first_order_price",
    "first_order_freight",
    "first_order_n_items",
    "first_order_n_sellers",
    "first_order_weight",
    "payment_installments",
]
VALUE_CATEGORICAL = ["first_order_main_category", "payment_type", "customer_state"]

SELLER_CLUSTERS = ["revenue_log", "n_orders_log", "delay_rate", "review_score"]

BY_TIME = ["order_purchase_timestamp", "order_id"]


# --- order grain ----------------------------------------------------------------------------
def of_orders(children: DataFrame, orders: DataFrame) -> DataFrame:
    """Child rows of the given orders; put below a grouping, so that only these rows are grouped."""
    return children.join(orders.select("order_id"), "order_id", "left_semi")


def item_group_sums(items: DataFrame, products: DataFrame, sellers: DataFrame | None = None) -> DataFrame:
    """Items summed per (order, seller, category)."""
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    sized = products.select(
        "product_id",
        F.col("product_category_name_english").alias("main_category"),
        "product_weight_g",
        volume.alias("volume"),
    )
    joined = items.select("order_id", "seller_id", "product_id", "price", "freight_value").join(sized, "product_id")
    if sellers is not None:
        # A seller outside the dimension drops its items, as the inner join of the model query does.
        joined = joined.join(sellers.select("seller_id"), "seller_id", "left_semi")
    return joined.groupBy("order_id", "seller_id", "main_category").agg(
        F.sum("price").alias("price"),
        F.sum("freight_value").alias("freight_value"),
        F.count(F.lit(1)).alias("n_items"),
        F.sum("product_weight_g").alias("total_weight_g"),
        F.sum("volume").alias("total_volume_cm3"),
        F.lit(1).cast("bigint").alias("n_sellers"),
    )


def dominant_item(items: DataFrame, products: DataFrame, sellers: DataFrame | None = None) -> DataFrame:
    """The (seller, category) group with the highest price sum of each order.

    Sums cover that group only, and ``n_sellers`` is 1 by construction; ``order_totals`` gives
    the sums over the whole order.
    """
    groups = item_group_sums(items, products, sellers)
    best = first_per_key(
        groups,
        ["order_id"],
        [F.col("price").desc(), F.col("seller_id"), F.col("main_category").asc_nulls_first()],
    )
    if sellers is None:
        return best
    return best.join(sellers.select("seller_id", "seller_state", "seller_zip_code_prefix"), "seller_id")


def order_totals(items: DataFrame, products: DataFrame) -> DataFrame:
    """True sums per order over all its sellers and categories."""
    per_seller = item_group_sums(items, products).groupBy("order_id", "seller_id").agg(
        *[F.sum(c).alias(c) for c in ("price", "freight_value", "n_items", "total_weight_g", "total_volume_cm3")]
    )
    return per_seller.groupBy("order_id").agg(
        *[F.sum(c).alias(c) for c in ("price", "freight_value", "n_items", "total_weight_g", "total_volume_cm3")],
        F.count(F.lit(1)).alias("n_sellers"),
    )


def top_payment(payments: DataFrame) -> DataFrame:
    """The largest payment row of each order."""
    return first_per_key(
        payments.select("order_id", "payment_type", "payment_installments", "payment_value", "payment_sequential"),
        ["order_id"],
        [F.col("payment_value").desc(), F.col("payment_sequential")],
    ).select("order_id", "payment_type", "payment_installments")


def with_distance(orders: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Distance between seller and customer by padded zip prefix; null if either is unknown."""
    points = geolocation.select(
        zip_pad("geolocation_zip_code_prefix").alias("zip"), "geolocation_lat", "geolocation_lng"
    )
    customer = points.toDF("customer_zip_code_prefix", "cust_lat", "cust_lng")
    seller = points.toDF("seller_zip_code_prefix", "sell_lat", "sell_lng")
    padded = orders.withColumns(
        {c: zip_pad(c) for c in ("customer_zip_code_prefix", "seller_zip_code_prefix")}
    )
    return (
        padded.join(customer, "customer_zip_code_prefix", "left")
        .join(seller, "seller_zip_code_prefix", "left")
        .withColumn(
            "seller_customer_distance_km", haversine_km("cust_lat", "cust_lng", "sell_lat", "sell_lng")
        )
        .drop("cust_lat", "cust_lng", "sell_lat", "sell_lng")
    )


def with_calendar(orders: DataFrame) -> DataFrame:
    month = F.month("order_purchase_timestamp")
    return orders.withColumns(
        {
            "purchase_day_of_week": F.weekday("order_purchase_timestamp"),
            "purchase_month": month,
            "is_holiday_season": month.isin(*HOLIDAY_MONTHS).cast("int"),
        }
    )


def with_ratios(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {
            "freight_ratio": ratio("freight_value", "price"),
            "promised_delivery_days": fractional_days("order_purchase_timestamp", "order_estimated_delivery_date"),
        }
    )


def delay_magnitude():
    """Days past the estimate, 0 for early, open or undated orders."""
    late = fractional_days("order_estimated_delivery_date", "order_delivered_customer_date")
    return F.coalesce(floor_at(late, 0.0), F.lit(0.0))


def negative_review():
    return (F.col("review_score") <= NEGATIVE_SCORE).cast("int")


def delivered_without_review(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    delivered = orders.where(F.col("order_status") == "delivered")
    return delivered.join(reviews.select("order_id").distinct(), "order_id", "left_anti")


def open_orders(orders: DataFrame) -> DataFrame:
    """Orders neither delivered nor canceled; an unknown status is not open."""
    return orders.where(~F.col("order_status").isin("delivered", "canceled"))


def impute(df: DataFrame, value: str, fill=None, source: DataFrame | None = None) -> DataFrame:
    """Fill nulls with a constant, or with the median of the column.

    source -- frame to take the median from, where a written one with the same values exists.
    """
    filler = F.lit(fill) if fill is not None else median(df if source is None else source, value).scalar()
    return df.withColumn(value, F.coalesce(F.col(value), filler))


# --- delivery features ----------------------------------------------------------------------
def delivery_base(
    orders: DataFrame,
    profiles: DataFrame,
    items: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    payments: DataFrame,
    geolocation: DataFrame,
) -> DataFrame:
    """Everything about an order that is known at purchase, without any history."""
    joined = (
        orders.select(
            "order_id",
            "customer_unique_id",
            "order_purchase_timestamp",
            "order_estimated_delivery_date",
            F.col("is_delayed").cast("int").cast("double").alias("is_delayed_num"),
        )
        .join(profiles.select("customer_unique_id", "customer_state", "customer_zip_code_prefix"), "customer_unique_id")
        .join(dominant_item(of_orders(items, orders), products, sellers), "order_id")
        .join(top_payment(of_orders(payments, orders)), "order_id")
    )
    featured = with_ratios(with_calendar(with_distance(joined, geolocation)))
    return featured.withColumns(
        {
            "price": F.col("price").cast("double"),
            "freight_value": F.col("freight_value").cast("double"),
            "distance_x_holiday_season": F.col("seller_customer_distance_km") * F.col("is_holiday_season"),
            "state_pair": F.concat("seller_state", F.lit("_"), "customer_state"),
        }
    )


def point_in_time_rates(base: DataFrame) -> DataFrame:
    """History features of each order from strictly earlier orders only.

    ``base`` is read several times and should be a written table. Each order stands once for every
    history it belongs to (all orders, its category, state and route), so that one running pass over
    (history, group) gives all prior means, and one grouping brings them back to the order.
    """
    y, promised = "is_delayed_num", "promised_delivery_days"
    overall = overall_mean(base, y)
    promised_mean = overall_mean(base, promised)
    histories = {"all": F.lit("all"), "category": F.col("main_category"), "state": F.col("customer_state"), "route": F.col("state_pair")}
    each = F.explode(F.array(*[F.struct(F.lit(h).alias("history"), g.cast("string").alias("group")) for h, g in histories.items()]))
    narrow = base.select(*BY_TIME, y, promised, each.alias("_in")).select(*BY_TIME, y, promised, "_in.*")
    seen, ewma = together(
        lambda: prior_mean(narrow, ["history", "group"], BY_TIME, {"rate": y, "promised": promised}, count="known"),
        lambda: prior_ewma(base.select(*BY_TIME, y, "seller_id"), ["seller_id"], BY_TIME, y, "ewma", EWMA_ALPHA),
    )

    def of(history: str, column: str, name: str) -> Column:
        return F.max(F.when(F.col("history") == history, F.col(column))).alias(name)

    rates = seen.groupBy("order_id").agg(
        of("all", "rate", "global_prior"),
        of("category", "rate", "category_rate"),
        of("category", "promised", "category_promised"),
        of("state", "rate", "state_rate"),
        of("route", "rate", "route_rate"),
        of("route", "known", "route_count"),
    )
    rates = rates.withColumn("global_prior", F.coalesce("global_prior", overall))

    def if_named(group, col):
        return F.when(F.col(group).isNotNull(), F.col(col))

    wide = base.join(rates, "order_id").join(ewma.select("order_id", "ewma"), "order_id")
    glob = F.col("global_prior")
    route_mean = F.coalesce(if_named("state_pair", "route_rate"), glob)
    route_count = F.coalesce(if_named("state_pair", "route_count"), F.lit(0))
    typical = F.coalesce(if_named("main_category", "category_promised"), promised_mean)
    return wide.select(
        *base.columns,
        F.coalesce("ewma", overall).alias("seller_ewma_delay_rate"),
        F.coalesce(if_named("main_category", "category_rate"), glob).alias("category_prior_delay_rate"),
        F.coalesce(if_named("customer_state", "state_rate"), glob).alias("customer_state_prior_delay_rate"),
        (F.col("promised_delivery_days") - typical).alias("promised_vs_category_typical"),
        shrink(route_mean, route_count, glob, ROUTE_WEIGHT).alias("seller_state_to_customer_state"),
    )


def current_rates(history: DataFrame) -> dict[str, DataFrame]:
    """Present rates by seller, category, state and route from all delivered orders."""
    y = "is_delayed_num"
    overall = overall_mean(history, y)
    ewma = prior_ewma(
        history.select("seller_id", *BY_TIME, y), ["seller_id"], BY_TIME, y, "ewma", EWMA_ALPHA
    )
    routes = current_rate(history, "state_pair", y, "mean", "n")
    return {
        "seller": current_ewma(ewma),
        "category": current_rate(history, "main_category", y, "category_rate"),
        "state": current_rate(history, "customer_state", y, "state_rate"),
        "promised": current_rate(history, "main_category", "promised_delivery_days", "category_promised"),
        "route": routes.select(
            "state_pair", shrink("mean", "n", overall, ROUTE_WEIGHT).alias("route_rate")
        ),
    }


def current_ewma(ewma: DataFrame, column: str = "ewma") -> DataFrame:
    """Last known value of the moving mean per seller.

    With the shifted mean the seller's latest order is left out; pass the column that
    ``prior_ewma`` writes for ``through`` to have it in.
    """
    position = F.when(F.col(column).isNotNull(), F.struct(*BY_TIME))
    return ewma.groupBy("seller_id").agg(F.max_by(column, position).alias("seller_rate"))


def with_current_rates(base: DataFrame, history: DataFrame) -> DataFrame:
    """History features for scoring: present rates, the overall rate where there is none."""
    overall = overall_mean(history, "is_delayed_num")
    promised_mean = overall_mean(base, "promised_delivery_days")
    # Written, so that Spark knows their size and broadcasts only what is small enough.
    found = current_rates(history)
    written = together(*[lambda rate=rate, name=name: stage(rate, f"rate-{name}") for name, rate in found.items()])
    rates = dict(zip(found, written))
    wide = (
        base.join(rates["seller"], "seller_id", "left")
        .join(rates["category"], "main_category", "left")
        .join(rates["promised"], "main_category", "left")
        .join(rates["state"], "customer_state", "left")
        .join(rates["route"], "state_pair", "left")
    )
    return wide.select(
        *base.columns,
        F.coalesce("seller_rate", overall).alias("seller_ewma_delay_rate"),
        F.coalesce("category_rate", overall).alias("category_prior_delay_rate"),
        F.coalesce("state_rate", overall).alias("customer_state_prior_delay_rate"),
        (F.col("promised_delivery_days") - F.coalesce("category_promised", promised_mean)).alias(
            "promised_vs_category_typical"
        ),
        F.coalesce("route_rate", overall).alias("seller_state_to_customer_state"),
    )


def delivery_features(market_frames: dict[str, DataFrame], training: bool) -> DataFrame:
    """Feature frame of the delivery model.

    training -- delivered historical orders with point-in-time rates; otherwise the open
    synthetic orders with present rates taken from all delivered orders.
    """
    orders = market_frames["orders"]
    others = {k: market_frames[k] for k in ("profiles", "items", "products", "sellers", "payments", "geolocation")}
    delivered = orders.where(F.col("order_status") == "delivered")
    if training:
        known = delivered.where(~F.col("is_synthetic") & F.col("is_delayed").isNotNull())
        return point_in_time_rates(stage(delivery_base(known, **others), "delivery"))
    history = stage(delivery_history(delivered, others), "history")
    waiting = open_orders(orders).where("is_synthetic")
    return with_current_rates(delivery_base(waiting, **others), history)


def delivery_history(delivered: DataFrame, others: dict[str, DataFrame]) -> DataFrame:
    """Delivered orders with the keys the present rates are taken by."""
    return (
        delivered.select(
            *BY_TIME,
            "customer_unique_id",
            F.col("is_delayed").cast("int").cast("double").alias("is_delayed_num"),
            fractional_days("order_purchase_timestamp", "order_estimated_delivery_date").alias(
                "promised_delivery_days"
            ),
        )
        .join(others["profiles"].select("customer_unique_id", "customer_state"), "customer_unique_id")
        .join(
            dominant_item(others["items"], others["products"], others["sellers"]).select(
                "order_id", "seller_id", "seller_state", "main_category"
            ),
            "order_id",
        )
        .withColumn("state_pair", F.concat("seller_state", F.lit("_"), "customer_state"))
    )


# --- review features ------------------------------------------------------------------------
def review_features(market_frames: dict[str, DataFrame], training: bool) -> DataFrame:
    """Feature frame of the negative-review model.

    training -- reviewed historical orders (one row per review); otherwise delivered synthetic
    orders that have no review yet.
    """
    orders, reviews = market_frames["orders"], market_frames["reviews"]
    items, products, payments = market_frames["items"], market_frames["products"], market_frames["payments"]

    def framed(selected: DataFrame) -> DataFrame:
        dominant = dominant_item(of_orders(items, selected), products)
        paid = top_payment(of_orders(payments, selected)).select("order_id", "payment_type")
        joined = selected.join(dominant, "order_id").join(paid, "order_id")
        late = F.col("is_delayed").cast("int").cast("double")
        return joined.withColumns(
            {
                "price": F.col("price").cast("double"),
                "freight_value": F.col("freight_value").cast("double"),
                "is_delayed_num": late,
                "promised_delivery_days": fractional_days(
                    "order_purchase_timestamp", "order_estimated_delivery_date"
                ),
                "delay_magnitude_days": delay_magnitude(),
                "is_delayed_x_price": late * F.col("price").cast("double"),
            }
        )

    if training:
        labelled = orders.where(~F.col("is_synthetic")).join(
            reviews.select("order_id", "review_id", "review_score").where(F.col("review_score").isNotNull()),
            "order_id",
        )
        base = stage(framed(labelled), "review").withColumn("negative_review", negative_review())
        order = ["order_purchase_timestamp", "order_id", "review_id"]
        ewma = prior_ewma(
            base.select("seller_id", *order, "is_delayed_num"), ["seller_id"], order, "is_delayed_num", "ewma", EWMA_ALPHA
        ).select("review_id", "ewma")
        history = base
        scored = base.join(ewma, "review_id")
    else:
        delivered = orders.where(F.col("order_status") == "delivered")
        history = stage(
            delivered.select(*BY_TIME, F.col("is_delayed").cast("int").cast("double").alias("is_delayed_num")).join(
                dominant_item(of_orders(items, delivered), products).select("order_id", "seller_id"), "order_id"
            ),
            "history",
        )
        current = current_ewma(
            prior_ewma(history, ["seller_id"], BY_TIME, "is_delayed_num", "ewma", EWMA_ALPHA)
        ).withColumnRenamed("seller_rate", "ewma")
        base = stage(framed(delivered_without_review(orders.where("is_synthetic"), reviews)), "pending")
        scored = base.join(current, "seller_id", "left")

    overall = overall_mean(history, "is_delayed_num")
    return impute(
        scored.withColumn("seller_ewma_delay_rate", F.coalesce("ewma", overall)).drop("ewma"),
        "delivery_days",
        source=base,
    )


# --- sellers --------------------------------------------------------------------------------
def seller_orders(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """(order, seller) grain: price sum, item count, delay, and review sums of the order."""
    sold = of_orders(items, orders).groupBy("order_id", "seller_id").agg(
        F.sum("price").cast("decimal(18,2)").alias("price"), F.count(F.lit(1)).alias("n_items")
    )
    scored = of_orders(reviews, orders).groupBy("order_id").agg(
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_n"),
        F.count(F.lit(1)).alias("review_rows"),
    )
    return (
        sold.join(orders.select("order_id", "order_purchase_timestamp", "is_delayed", "is_synthetic"), "order_id")
        .join(scored, "order_id", "left")
        .withColumn("late", F.col("is_delayed").cast("bigint"))
    )


def _weighted(parity: bool):
    """Rows that one (order, seller) stands for.

    Corrected grain: one. Parity: items x reviews, the fan-out of joining both to the order.
    """
    if not parity:
        return F.lit(1).cast("bigint"), F.lit(1).cast("bigint"), F.lit(1).cast("bigint")
    fan = F.greatest(F.coalesce("review_rows", F.lit(1)), F.lit(1))
    return fan, F.col("n_items") * fan, F.col("n_items")


def seller_lifetime_stats(sold: DataFrame, parity: bool = False, weight: float = SELLER_WEIGHT) -> DataFrame:
    """Orders, revenue, and delay and review means shrunk towards the order-weighted mean."""
    money, rows, reviews = _weighted(parity)
    late_rows = F.when(F.col("late").isNotNull(), rows)
    stats = sold.groupBy("seller_id").agg(
        F.count("order_id").alias("n_orders"),
        F.sum(F.col("price") * money).alias("revenue"),
        ratio(F.sum(F.col("late") * rows), F.sum(late_rows)).alias("delay_rate_raw"),
        ratio(F.sum(F.col("score_sum") * reviews), F.sum(F.col("score_n") * reviews)).alias("review_raw"),
    )
    n = F.col("n_orders")
    overall = stats.agg(
        F.struct(
            ratio(F.sum(F.col("delay_rate_raw") * n), F.sum(n)).alias("delay"),
            ratio(F.sum(F.col("review_raw") * n), F.sum(n)).alias("review"),
        ).alias("g")
    ).scalar()
    return (
        stats.withColumn("_g", overall)
        .withColumns(
            {
                "delay_rate": shrink("delay_rate_raw", "n_orders", F.col("_g.delay"), weight),
                "review_score": shrink("review_raw", "n_orders", F.col("_g.review"), weight),
                "revenue_log": F.log1p(F.col("revenue").cast("double")),
                "n_orders_log": F.log1p(F.col("n_orders").cast("double")),
            }
        )
        .drop("_g")
    )


def seller_window_metrics(sold: DataFrame, as_of: str, parity: bool = False) -> DataFrame:
    """Orders, revenue, delay and review means of the day ``as_of`` and the week up to it."""
    money, rows, reviews = _weighted(parity)
    day = F.to_date("order_purchase_timestamp")
    today = day == F.lit(as_of).cast("date")
    week = day >= F.date_sub(F.lit(as_of).cast("date"), 7)
    known = F.col("late").isNotNull()

    def block(when, suffix):
        return [
            F.coalesce(F.sum(F.when(when, rows)), F.lit(0)).alias(f"orders_{suffix}"),
            F.sum(F.when(when, F.col("price") * money).otherwise(F.lit(0))).alias(f"revenue_{suffix}"),
            ratio(F.sum(F.when(when, F.col("late") * rows)), F.sum(F.when(when & known, rows))).alias(
                f"delay_rate_{suffix}"
            ),
        ]

    return sold.groupBy("seller_id").agg(
        *block(today, "today"),
        *block(week, "this_week"),
        ratio(
            F.sum(F.when(week, F.col("score_sum") * reviews)), F.sum(F.when(week, F.col("score_n") * reviews))
        ).alias("review_score_this_week"),
    )


# --- customers ------------------------------------------------------------------------------
def first_orders(orders: DataFrame) -> DataFrame:
    """All orders placed at the first purchase time of their person."""
    first = orders.groupBy("customer_unique_id").agg(F.min("order_purchase_timestamp").alias("order_purchase_timestamp"))
    return orders.select("customer_unique_id", "order_purchase_timestamp", "order_id").join(
        first, ["customer_unique_id", "order_purchase_timestamp"], "left_semi"
    )


def first_order_features(
    orders: DataFrame, items: DataFrame, products: DataFrame, payments: DataFrame, per_order: bool = False
) -> DataFrame:
    """Items, products and payment of a person's first order; payments never multiply items.

    per_order -- one row per first order (training) instead of one per person (scoring).
    """
    first = first_orders(orders).select("customer_unique_id", "order_id")
    keys = ["customer_unique_id", "order_id"] if per_order else ["customer_unique_id"]
    sized = products.select("product_id", "product_category_name_english", "product_weight_g")
    bought = items.join(first, "order_id").join(sized, "product_id")
    best = F.struct(F.col("price"), F.col("order_id"), F.col("order_item_id"))
    per_seller = bought.groupBy(*keys, "seller_id").agg(
        F.sum("price").alias("p"),
        F.sum("freight_value").alias("f"),
        F.count(F.lit(1)).alias("n"),
        F.sum("product_weight_g").alias("w"),
        F.max(best).alias("best"),
        F.max_by("product_category_name_english", best).alias("category"),
    )
    goods = per_seller.groupBy(*keys).agg(
        F.sum("p").alias("first_order_price"),
        F.sum("f").alias("first_order_freight"),
        F.sum("n").alias("first_order_n_items"),
        F.count(F.lit(1)).alias("first_order_n_sellers"),
        F.sum("w").alias("first_order_weight"),
        F.max_by("category", "best").alias("first_order_main_category"),
    )
    pick = F.struct("order_id", "payment_sequential")
    paid = (
        payments.select("order_id", "payment_sequential", "payment_type", "payment_installments")
        .join(first, "order_id")
        .groupBy(*keys)
        .agg(
            F.min_by("payment_type", pick).alias("payment_type"),
            F.min_by("payment_installments", pick).alias("payment_installments"),
        )
    )
    return goods.join(paid, keys, "left")


def lifetime_values(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Price plus freight over all orders of a person."""
    spent = of_orders(items, orders).groupBy("order_id").agg(F.sum(F.col("price") + F.col("freight_value")).alias("v"))
    return (
        orders.select("customer_unique_id", "order_id")
        .join(spent, "order_id")
        .groupBy("customer_unique_id")
        .agg(F.sum("v").alias("total_clv"))
    )


def incremental_value(
    orders: DataFrame, profiles: DataFrame, items: DataFrame, products: DataFrame, payments: DataFrame
) -> DataFrame:
    """Training frame of the value model: spend beyond the first order."""
    first = first_order_features(orders, items, products, payments, per_order=True)
    gap = (F.col("total_clv") - F.col("first_order_price") - F.col("first_order_freight")).cast("double")
    frame = (
        first.join(lifetime_values(orders, items), "customer_unique_id")
        .join(profiles.select("customer_unique_id", "customer_state"), "customer_unique_id")
        .withColumn("incremental_clv", floor_at(gap, 0.0))
        .withColumn("log_incremental_clv", F.log1p("incremental_clv"))
        .withColumn("payment_installments", F.coalesce("payment_installments", F.lit(1)))
    )
    return frame


def customer_scoring_base(orders: DataFrame, profiles: DataFrame, items: DataFrame, as_of: str) -> DataFrame:
    """Recency and spend of each person as of a date, with their logs."""
    spent = of_orders(items, orders).groupBy("order_id").agg(F.sum(F.col("price") + F.col("freight_value")).alias("v"))
    return (
        orders.select("customer_unique_id", "order_id", "order_purchase_timestamp")
        .join(spent, "order_id")
        .groupBy("customer_unique_id")
        .agg(F.max("order_purchase_timestamp").alias("last"), F.sum("v").alias("monetary"))
        .join(profiles.select("customer_unique_id", "customer_state"), "customer_unique_id")
        .withColumn("recency_days", F.datediff(F.lit(as_of).cast("date"), F.to_date("last")))
        .select(
            "customer_unique_id",
            "customer_state",
            "recency_days",
            "monetary",
            F.log1p(F.greatest(F.col("recency_days"), F.lit(0)).cast("double")).alias("recency_log"),
            F.log1p(F.greatest(F.col("monetary").cast("double"), F.lit(0.0))).alias("monetary_log"),
        )
    )


def label_balance(df: DataFrame, label: str) -> DataFrame:
    counted = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return shares(counted, "n")


def shares(counted: DataFrame, n: str, digits: int | None = None) -> DataFrame:
    """Add each row's share of the total of ``n``."""
    total = counted.agg(F.sum(n).alias("t")).scalar()
    share = ratio(n, total)
    return counted.withColumn("share", F.round(share, digits) if digits is not None else share)


