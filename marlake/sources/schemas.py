"""Schemas and file names of the nine raw inputs."""

from __future__ import annotations

MONEY = "decimal(18,2)"

# The input columns that are used.
RAW_SCHEMAS = {
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string"
    ),
    "orders": (
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
        "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
        "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
    ),
    "order_items": (
        "order_id string, order_item_id bigint, product_id string, seller_id string, "
        f"shipping_limit_date timestamp, price {MONEY}, freight_value {MONEY}"
    ),
    "order_payments": (
        "order_id string, payment_sequential bigint, payment_type string, payment_installments bigint, "
        f"payment_value {MONEY}"
    ),
    "order_reviews": (
        "review_id string, order_id string, review_score bigint, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp"
    ),
    "products": (
        "product_id string, product_category_name string, product_weight_g double, product_length_cm double, "
        "product_height_cm double, product_width_cm double, product_photos_qty bigint"
    ),
    "sellers": (
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"
    ),
    "geolocation": (
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string"
    ),
    "category_translation": "product_category_name string, product_category_name_english string",
}

# Business keys of the deduplicated tables.
TABLE_KEYS = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
}

# Accepted domains.
ORDER_STATUSES = [
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
]
REVIEW_SCORES = [1, 2, 3, 4, 5]
