"""Sorts, limits, pages and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def top_k(df: DataFrame, measure: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The k largest rows by ``measure``; every task keeps only its own k before the merge."""
    return df.orderBy(F.col(measure).desc(), *tie).limit(k)


def rank_top_n(df: DataFrame, measure: str, n: int, tie: Sequence[str], name: str = "rank") -> DataFrame:
    """``top_k`` with its rank; the window sees n rows only."""
    best = top_k(df, measure, n, tie)
    return best.withColumn(name, F.row_number().over(W.orderBy(F.col(measure).desc(), *tie)))


def recent_alerts(alerts: DataFrame, n: int = 200, tie: Sequence[str] = ()) -> DataFrame:
    """Newest first, alerts without a time last."""
    return alerts.orderBy(F.col("timestamp").desc_nulls_last(), *tie).limit(n)


def page_query(events: DataFrame, time: str, tie: Sequence[str], skip: int = 0, limit: int = 100) -> DataFrame:
    return events.orderBy(F.col(time).desc(), *tie).offset(skip).limit(limit)


def last_n_hours(features: DataFrame, n: int = 417, time: str = "timestamp") -> DataFrame:
    """The last n rows by time, in ascending order."""
    return features.orderBy(F.col(time).desc()).limit(n).orderBy(time)


def sort_output(df: DataFrame, *order: str | Column) -> DataFrame:
    return df.orderBy(*order)


def union_missing_columns(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column a frame lacks is NULL there."""
    made = frames[0]
    for frame in frames[1:]:
        made = made.unionByName(frame, allowMissingColumns=True)
    return made


def except_codes(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def intersect_codes(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


def shared_columns(source: DataFrame, target: Sequence[str]) -> list[str]:
    """Columns that both have, in the target's order."""
    return [c for c in target if c in source.columns]
