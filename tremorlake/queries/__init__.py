"""Registered queries: one per operator, on the driver's tables, most with an oracle SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tremorlake.adapter import Tables, with_tables
from tremorlake.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _digits(doubles: str) -> dict[str, int]:
    pairs = (d.partition(":") for d in doubles.split())
    return {name: int(digits or 10) for name, _, digits in pairs}


def comparable(df: DataFrame, doubles: str) -> DataFrame:
    """Round the named doubles and show times as zone-free UTC, as the oracle does."""
    digits = _digits(doubles)
    out = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if field.name in digits:
            col = F.round(col, digits[field.name])
        elif isinstance(field.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        out.append(col.alias(field.name))
    return df.select(*out)


def query(name: str, tables: str = "", sql: str | None = None, doubles: str = ""):
    """Register ``fn(tables) -> DataFrame``; ``doubles`` are the columns rounded on both sides."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(fn(Tables(prepare(spark), folder)), doubles)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle_text(tables, sql, doubles)
        return fn

    return register


def oracle_text(tables: str, sql: str, doubles: str) -> str:
    if not doubles:
        return with_tables(tables, sql)
    rounded = ", ".join(f"round({c}, {d}) + 0e0 AS {c}" for c, d in _digits(doubles).items())
    return f"SELECT * REPLACE ({rounded}) FROM ({with_tables(tables, sql)}) AS answer"


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib

    for module in (
        "feature_queries",
        "aggregate_queries",
        "window_queries",
        "join_queries",
        "quality_queries",
        "scalar_queries",
        "order_queries",
        "source_queries",
        "detection_queries",
        "spatial_queries",
        "stream_queries",
        "model_queries",
    ):
        importlib.import_module(f"tremorlake.queries.{module}")
