"""Forecasts of many daily series at once: one regression per key (category, state, seller).

The sums of a key's normal equations are one grouped aggregate over all days of all keys, so
a key with most of the rows is reduced inside the map tasks like any other. What is left per key are
(inputs + 2)^2 / 2 sums; a small solve turns them into coefficients. No series is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlake.plans import ml
from marlake.session import stage

RIDGE = 0.01
# The trend is never shrunk.
FREE = ("t",)
Z80 = 1.2815515655446004


def daily_by_category(orders: DataFrame, items: DataFrame, products: DataFrame, historical_end: str) -> DataFrame:
    """Daily item revenue per category (``key``, ``ds``, ``y``), cohorts as in the single forecast."""
    category = F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown"))
    named = items.select("order_id", "product_id", "price").join(products.select("product_id", category.alias("key")), "product_id")
    per_order = named.groupBy("order_id", "key").agg(F.sum("price").alias("y"))
    return ml.forecast_days(orders, historical_end).join(per_order, "order_id").groupBy("key", "ds").agg(F.sum("y").alias("y"))


def daily_by_state(orders: DataFrame, items: DataFrame, profiles: DataFrame, historical_end: str) -> DataFrame:
    """Daily item revenue per state of the customer."""
    per_order = items.groupBy("order_id").agg(F.sum("price").alias("y"))
    days = ml.forecast_days(orders.select("order_id", "is_synthetic", "order_purchase_timestamp", "customer_unique_id"), historical_end, "customer_unique_id")
    per_person = days.join(per_order, "order_id").groupBy("customer_unique_id", "ds").agg(F.sum("y").alias("y"))
    states = profiles.select("customer_unique_id", F.col("customer_state").alias("key"))
    return per_person.join(states, "customer_unique_id").groupBy("key", "ds").agg(F.sum("y").alias("y"))


def filled(daily: DataFrame) -> DataFrame:
    """Every day from a key's first day to the last day of all keys; days without a row count 0.

    Days given twice are summed, rows without a day are left out. A null key is a series of its own. ``first`` is the key's first day.
    """
    known = daily.where(F.col("ds").isNotNull()).select("key", "ds", F.coalesce(F.col("y").cast("double"), F.lit(0.0)).alias("y"))
    last = known.agg(F.max("ds").alias("b")).scalar()
    spine = known.groupBy("key").agg(F.min("ds").alias("a")).withColumn("b", last)
    zeros = spine.select("key", F.explode(F.sequence("a", "b")).alias("ds"), F.lit(0.0).alias("y"), F.col("a").alias("first"))
    rows = zeros.unionByName(known.withColumn("first", F.lit(None).cast("date")))
    return rows.groupBy("key", "ds").agg(F.sum("y").alias("y"), F.max("first").alias("first"))


def inputs_of(days: DataFrame, holidays: DataFrame | None, yearly: int, weekly: int, trend: bool) -> tuple[DataFrame, list[str]]:
    """The days with trend, seasons and holiday flags, and the names of these inputs in a fixed order."""
    out = ml.seasonal_features(days, holidays, F.col("first"), yearly, weekly)
    added = [c for c in out.columns if c not in days.columns]
    return out, sorted(c for c in added if trend or c != "t")


def normal_equations(rows: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Sums of all products of (1, inputs, y) per key, as one array of the upper triangle by rows."""
    values = F.array(F.lit(1.0), *[F.col(c) for c in inputs], F.col("y"))
    size = len(inputs) + 2

    def products(a: Column, i: Column) -> Column:
        return F.transform(F.slice("_v", i + 1, F.lit(size) - i), lambda b: a * b)

    triangle = F.flatten(F.transform("_v", products))
    sums = rows.select("key", values.alias("_v")).select("key", F.posexplode(triangle)).groupBy("key", "pos").agg(F.sum("col").alias("s"))
    return sums.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda e: e["s"]).alias("sums"))


def solve(sums: np.ndarray, n_inputs: int, penalty: np.ndarray) -> tuple[float, float, np.ndarray]:
    """Intercept, root mean squared error and coefficients from the triangle of sums.

    Inputs that never vary in a series get the coefficient 0 (least norm).
    """
    size = n_inputs + 2
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = sums
    n = full[0, 0]
    mean = full[0, 1:] / n
    upper = full[1:, 1:] / n
    spread = np.triu(upper) + np.triu(upper, 1).T - np.outer(mean, mean)
    inner, cross = spread[:-1, :-1], spread[:-1, -1]
    shrunk = inner + np.diag(penalty * np.diag(inner))
    found = np.linalg.pinv(shrunk, rcond=1e-10, hermitian=True) @ cross if n_inputs else np.zeros(0)
    error = max(0.0, spread[-1, -1] - 2 * found @ cross + found @ inner @ found)
    return float(mean[-1] - mean[:-1] @ found), float(np.sqrt(error)), found


def fit(rows: DataFrame, inputs: Sequence[str], ridge: float = RIDGE) -> DataFrame:
    """One row per key: ``key``, ``days``, ``intercept``, ``rmse``, ``coefficients`` (in the order of the inputs).

    Least squares with ``ridge`` times an input's variance added for every input but the trend; 0 gives plain least squares.
    """
    penalty = np.array([0.0 if c in FREE else ridge for c in inputs])

    def solved(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [solve(np.asarray(s, dtype=float), len(penalty), penalty) for s in frame["sums"]]
            yield pd.DataFrame(
                {
                    "key": frame["key"],
                    "days": [int(s[0]) for s in frame["sums"]],
                    "intercept": [f[0] for f in found],
                    "rmse": [f[1] for f in found],
                    "coefficients": [f[2].tolist() for f in found],
                }
            )

    kind = rows.schema["key"].dataType.simpleString()
    return normal_equations(rows, inputs).mapInPandas(solved, f"key {kind}, days long, intercept double, rmse double, coefficients array<double>")


def forecast_many(
    daily: DataFrame, holidays: DataFrame | None = None, horizon: int = 90, yearly: int = 10, weekly: int = 3,
    trend: bool = True, ridge: float = RIDGE, z: float = Z80,
) -> DataFrame:
    """The next days of every series: ``key``, ``ds``, ``yhat``, ``yhat_lower``, ``yhat_upper``, none below zero.

    ``daily`` has ``key``, ``ds``, ``y``; see ``filled`` for missing days, null days and null keys. An empty table gives no rows.
    """
    days = stage(filled(daily), "series")
    rows, inputs = inputs_of(days, holidays, yearly, weekly, trend)
    models = stage(fit(rows, inputs, ridge), "models")
    ends = days.groupBy("key").agg(F.min("first").alias("first"), F.max("ds").alias("b"))
    future = ends.select("key", "first", F.explode(F.sequence(F.date_add("b", 1), F.date_add("b", horizon))).alias("ds"))
    ahead, _ = inputs_of(future, holidays, yearly, weekly, trend)
    own = models.withColumnRenamed("key", "_key")
    joined = ahead.join(own, F.col("key").eqNullSafe(F.col("_key")))
    terms = [F.col(c) * F.col("coefficients")[i] for i, c in enumerate(inputs)]
    yhat = sum(terms, F.col("intercept"))
    return joined.select(
        "key",
        "ds",
        F.greatest(yhat, F.lit(0.0)).alias("yhat"),
        F.greatest(yhat - z * F.col("rmse"), F.lit(0.0)).alias("yhat_lower"),
        F.greatest(yhat + z * F.col("rmse"), F.lit(0.0)).alias("yhat_upper"),
    )
