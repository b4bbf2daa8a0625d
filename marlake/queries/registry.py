"""Registry of named queries and of the reference SQL they are checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlake.functions.expr import decimals_to_double
from marlake.queries.views import VIEWS
from marlake.session import configure
from marlake.sources.market import Market

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
REFERENCE_SQL: dict[str, str] = {}

DIGITS = 6


def query(name: str, sql: str | None = None):
    """Register a function ``Market -> DataFrame`` and, where SQL can say it, its reference."""

    def add(fn: Callable[[Market], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(fn(Market(configure(spark), folder)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            REFERENCE_SQL[name] = with_views(sql)
        return fn

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Plain output types: decimals as doubles, doubles rounded once, dates as ISO text."""
    df = decimals_to_double(df)
    changed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DoubleType):
            changed[field.name] = F.round(F.col(field.name), DIGITS)
        elif isinstance(field.dataType, T.DateType):
            changed[field.name] = F.col(field.name).cast("string")
    return df.withColumns(changed) if changed else df


def with_views(body: str) -> str:
    """Prepend the common table expressions that a statement names, in dependency order."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\b[vg]_\w+\b", text):
            if name in VIEWS and name not in ordered:
                need(VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    need(body)
    body = body.strip()
    ctes = ",\n".join(f"{n} as (\n{VIEWS[n].strip()}\n)" for n in ordered)
    if not ctes:
        return body
    if body[:5].lower() == "with ":
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
