"""Data checks on the gold tables."""

from marlake.operators import quality
from marlake.queries.registry import query
from marlake.sources.schemas import ORDER_STATUSES, REVIEW_SCORES

NOT_NULL = {
    "fct_orders": ["order_id", "customer_unique_id", "order_approved_at", "order_delivered_customer_date", "is_delayed"],
    "fct_order_items": ["order_id", "product_id"],
    "fct_payments": ["order_id"],
    "fct_reviews": ["review_id", "order_id"],
    "dim_products": ["product_id", "product_category_name"],
    "dim_sellers": ["seller_id"],
    "dim_geolocation": ["geolocation_zip_code_prefix"],
    "dim_customers": ["customer_unique_id"],
    "mart_daily_revenue": ["date_day"],
}
UNIQUE = {
    "fct_orders": "order_id",
    "fct_order_items": "order_id",
    "fct_reviews": "review_id",
    "dim_products": "product_id",
    "dim_sellers": "seller_id",
    "dim_geolocation": "geolocation_zip_code_prefix",
    "dim_customers": "customer_unique_id",
}
SOURCES = {
    "fct_orders": "g_orders",
    "fct_order_items": "v_items",
    "fct_payments": "v_payments",
    "fct_reviews": "g_reviews",
    "dim_products": "g_products",
    "dim_sellers": "g_sellers",
    "dim_geolocation": "g_geo",
    "dim_customers": "g_dim_customers",
    "mart_daily_revenue": "g_daily",
}


def frame(m, name):
    """A gold frame by name."""
    return {"fct_order_items": lambda: m.fct_items}.get(name, lambda: getattr(m, name))()


def _row(table, column, check, failures):
    return (
        f"select '{table}' table_name, '{column}' column_name, '{check}' check_name,"
        f" cast({failures} as bigint) failures, count(*) checked from {SOURCES[table]}"
    )


@query(
    "dq_not_null",
    "\nunion all ".join(
        _row(t, c, "not_null", f"count_if({c} is null)") for t, cols in NOT_NULL.items() for c in cols
    ),
)
def dq_not_null(m):
    m = m.written()
    return quality.report([quality.not_null(frame(m, t), t, cols) for t, cols in NOT_NULL.items()])


@query(
    "dq_unique",
    "\nunion all ".join(
        f"select '{t}' table_name, '{c}' column_name, 'unique' check_name, cast(count_if(n > 1) as bigint) failures,"
        f" cast(sum(n) as bigint) checked from (select {c}, count(*) n from {SOURCES[t]} where {c} is not null group by 1) x"
        for t, c in UNIQUE.items()
    ),
)
def dq_unique(m):
    m = m.written()
    return quality.report([quality.unique(frame(m, t), t, c) for t, c in UNIQUE.items()])


ACCEPTED = [
    ("fct_orders", "order_status", ORDER_STATUSES),
    ("fct_reviews", "review_score", REVIEW_SCORES),
    ("fct_payments", "payment_type", ["credit_card", "boleto", "debit_card"]),
]


@query(
    "dq_accepted_values",
    "\nunion all ".join(
        _row(t, c, "accepted_values", f"count_if({c} not in ({', '.join(repr(v) for v in values)}))")
        for t, c, values in ACCEPTED
    ),
)
def dq_accepted_values(m):
    m = m.written()
    return quality.report([quality.accepted_values(frame(m, t), t, c, v) for t, c, v in ACCEPTED])


RELATIONS = [
    ("fct_orders", "customer_unique_id", "dim_customers", "customer_unique_id"),
    ("fct_order_items", "order_id", "fct_orders", "order_id"),
    ("fct_order_items", "product_id", "dim_products", "product_id"),
    ("fct_payments", "order_id", "fct_orders", "order_id"),
    ("fct_reviews", "order_id", "fct_orders", "order_id"),
    # Fails for orders without a review, to show that failures are counted.
    ("fct_orders", "order_id", "fct_reviews", "order_id"),
]


@query(
    "dq_relationships",
    "\nunion all ".join(
        _row(
            t, c, "relationships",
            f"count_if({c} is not null and {c} not in (select {pc} from {SOURCES[p]} where {pc} is not null))",
        )
        for t, c, p, pc in RELATIONS
    ),
)
def dq_relationships(m):
    m = m.written()
    tables = {t for r in RELATIONS for t in (r[0], r[2])}
    return quality.all_relationships({t: frame(m, t) for t in sorted(tables)}, RELATIONS)
