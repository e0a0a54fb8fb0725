"""Building blocks that stay exact when one group, or the whole table, is too big for one task.

Each function takes the plain Spark plan while every group is small and another, fully distributed
one for the groups that are not:

* ``exact_quantiles``  bracket the quantile with a sketch, then count exactly inside the bracket, in ranges if it is big
* ``number_rows``      range-partition by the order, number inside each range, add range offsets
* ``running_totals``   the same idea for cumulative sums
* ``fill_in_order``    the same idea for forward / backward fill
* ``bounded``          broadcast a side only after its row count has been seen
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tremorlake.session import durable

HOT_ROWS = 1_000_000  # more rows than this in one group: leave the one-task-per-group plan
SMALL_ROWS = 20_000  # most rows that are broadcast
SKETCH_ACCURACY = 20_000
RANGE_ROWS = 2_000_000  # rows that one range is made for
TASK_ROWS = 500_000  # rows of a task that sorts or keeps them


def bounded(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """``df`` as a broadcast local table if it has at most ``limit`` rows, else ``df`` unhinted.

    The rows are computed once. Beyond the limit the join is left to Spark (sort-merge, AQE skew), and
    ``df`` is computed again there: pass a ``durable`` table if it is dear.
    """
    rows = df.limit(limit + 1).toArrow()
    if rows.num_rows > limit:
        return df
    if rows.num_rows == 0:
        return F.broadcast(df.sparkSession.createDataFrame([], df.schema))
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hash by ``keys`` over all shuffle partitions, in front of work that is heavy per row.

    Adaptive execution would merge small partitions by their bytes; here a few megabytes can be
    seconds of work (sliding medians, solvers), so a fixed number of partitions is asked for.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *[F.col(k) for k in keys])


def dealt(df: DataFrame, keys: Sequence[str], rows: int, task_rows: int | None = None) -> DataFrame:
    """Hash by ``keys``, or evenly without any, over a number of tasks that grows with ``rows``, the rows there are.

    The session's number of shuffle partitions does not grow with the data, so neither would the tasks of a sort or a
    window. Where its partitions hold no more than ``task_rows`` rows each, ``df`` is left as it is.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = range_count(rows, least, task_rows or TASK_ROWS)
    return df if parts == least and keys else df.repartition(parts, *[F.col(k) for k in keys])


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame | None:
    """Keys of the groups with more than ``hot_rows`` rows, broadcast; None if there are none.

    There can be at most rows/hot_rows of them, so the list is small by construction.
    """
    return _hot_groups(df, keys, hot_rows)[0]


def _hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int | None) -> tuple[DataFrame | None, int]:
    """``hot_groups`` and the number of rows that these groups have together."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > (hot_rows or HOT_ROWS))
    found = counts.toArrow()
    if found.num_rows == 0:
        return None, 0
    names = found.drop_columns(["_n"])
    return F.broadcast(df.sparkSession.createDataFrame(names, df.select(*keys).schema)), sum(found["_n"].to_pylist())


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    probs: Mapping[str, float],
    hot_rows: int | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles per group: ``probs`` maps output column to probability.

    NULL values are ignored and keys must not be NULL; a group without values gives no row.
    """
    keys = list(keys)
    names = list(probs)
    value = F.col(value) if isinstance(value, str) else value
    data = df.select(*keys, value.cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    hot, _ = _hot_or_none(data, keys, hot_rows)
    if hot is None:
        return _plain_quantiles(data, keys, probs)

    hot_data = data.join(hot, keys, "left_semi") if keys else data
    margin = 2.0 / SKETCH_ACCURACY + 2.0 / (hot_rows or HOT_ROWS)  # sketch error, and neighbours of the position
    marks = []
    for name in names:
        p = probs[name]
        pair = F.array(F.lit(max(0.0, p - margin)), F.lit(min(1.0, p + margin)))
        marks.append(F.percentile_approx("_v", pair, F.lit(SKETCH_ACCURACY)).alias(f"_b_{name}"))
    sketch = durable(hot_data.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *marks))
    wanted = sketch.select(
        *keys,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("_name"),
                        (F.lit(probs[name]) * (F.col("_n") - 1)).alias("_pos"),
                        F.col(f"_b_{name}")[0].alias("_lo"),
                        F.col(f"_b_{name}")[1].alias("_hi"),
                    )
                    for name in names
                ]
            )
        ),
    )
    if keys:
        joined = hot_data.join(bounded(wanted), keys)
    else:  # a handful of numbers: literals beside each row
        marks = [F.struct(*[F.lit(v).alias(c) for c, v in row.asDict().items()]) for row in wanted.collect()]
        joined = hot_data.select("*", F.inline(F.array(*marks)))
    # one row per distinct value in the bracket, plus one row (not _in, value NULL) that counts what is below it
    inside = (
        joined.filter(F.col("_v") <= F.col("_hi"))
        .withColumn("_in", F.col("_v") >= F.col("_lo"))
        .withColumn("_v", F.when(F.col("_in"), F.col("_v")))
        .groupBy(*keys, "_name", "_pos", "_in", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    inside = durable(inside)  # of a large group the bracket itself may be too big for one task: totals go by ranges
    counted = running_totals(inside, [F.col("_in"), F.col("_v")], {"_upto": "_c"}, hot_rows, keys=[*keys, "_name"])
    low, high = F.floor("_pos"), F.ceil("_pos")
    picked = (
        counted.groupBy(*keys, "_name", "_pos")
        .agg(
            F.max(F.when(~F.col("_in"), F.col("_c"))).alias("_below"),
            F.min(F.when(F.col("_upto") > low, F.struct("_in", F.col("_v").alias("v")))).alias("_x0"),
            F.min(F.when(F.col("_upto") > high, F.struct("_in", F.col("_v").alias("v")))).alias("_x1"),
        )
    )
    x0, x1 = F.col("_x0.v"), F.col("_x1.v")
    missed = F.col("_x1").isNull() | F.col("_x0").isNull() | ~F.col("_x0._in")
    exact = F.when(missed, F.raise_error(F.lit("quantile outside its sketch bracket")).cast("double")).otherwise(
        F.when(x0 == x1, x0)
        .when(F.abs(x0) == F.lit(float("inf")), (F.ceil("_pos") - F.col("_pos")) * x0 + (F.col("_pos") - F.floor("_pos")) * x1)
        .otherwise(x0 + (x1 - x0) * (F.col("_pos") - F.floor("_pos")))
    )
    hot_result = (
        picked.withColumn("_q", exact)
        .groupBy(*keys)
        .agg(*[F.max(F.when(F.col("_name") == name, F.col("_q"))).alias(name) for name in names])
    )
    if not keys:
        return hot_result
    return _plain_quantiles(data.join(hot, keys, "left_anti"), keys, probs).unionByName(hot_result)


def _hot_or_none(data: DataFrame, keys: list[str], hot_rows: int | None) -> tuple[DataFrame | None, int]:
    if keys:
        return _hot_groups(data, keys, hot_rows)
    rows = data.count()
    return (data, rows) if rows > (hot_rows or HOT_ROWS) else (None, 0)


def _plain_quantiles(data: DataFrame, keys: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    names = list(probs)
    marks = F.percentile("_v", F.array(*[F.lit(float(probs[n])) for n in names])).alias("_q")
    grouped = data.groupBy(*keys).agg(marks)
    return grouped.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def range_count(rows: int, least: int, range_rows: int | None = None) -> int:
    """How many ranges ``rows`` rows go into: they grow with the rows, and there are at least ``least``."""
    return max(least, -(-rows // (range_rows or RANGE_ROWS)))


def _ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int, parts: int | None) -> DataFrame:
    """Range-partition by (keys, order) and write down which range each row fell into.

    The split points are Spark's sample of the order. There are ``parts`` ranges or, if that is None, one for each
    ``RANGE_ROWS`` rows.
    """
    parts = parts or range_count(rows, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = df.repartitionByRange(parts, *[F.col(k) for k in keys], *order)
    return durable(spread.withColumn("_range", F.spark_partition_id()))


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    hot_rows: int | None = None,
    parts: int | None = None,
) -> DataFrame:
    """``row_number`` from 1 per group; ``order`` must be a total order and keys not NULL."""
    keys, order = list(keys), list(order)
    hot, rows = _hot_or_none(df.select(*keys) if keys else df, keys, hot_rows)
    if hot is None:
        df = dealt(df, keys, df.count()) if keys else df
        return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long"))
    hot_rows_df = df.join(hot, keys, "left_semi") if keys else df
    ranged = _ranges(hot_rows_df, keys, order, rows, parts)
    sizes = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    offsets = bounded(sizes.select(*keys, "_range", F.coalesce(before, F.lit(0)).alias("_before")))
    inner = F.row_number().over(W.partitionBy(*keys, "_range").orderBy(*order))
    numbered = ranged.withColumn(name, inner).join(offsets, [*keys, "_range"])
    numbered = numbered.withColumn(name, (F.col(name) + F.col("_before")).cast("long"))
    numbered = numbered.select(*df.columns, name)
    if not keys:
        return numbered
    cold = df.join(hot, keys, "left_anti")
    cold = dealt(cold, keys, df.count() - rows)
    return cold.withColumn(
        name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long")
    ).unionByName(numbered)


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    sums: Mapping[str, str],
    hot_rows: int | None = None,
    parts: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Cumulative sums per group, or over the whole table, in ``order``: ``sums`` maps output to input column.

    Keys must not be NULL.
    """
    order, keys = list(order), list(keys)
    rows = df.count()
    if rows <= (hot_rows or HOT_ROWS):
        frame = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        return df.select("*", *[F.sum(col).over(frame).alias(out) for out, col in sums.items()])
    ranged = _ranges(df, keys, order, rows, parts)
    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(col).alias(f"_t_{out}") for out, col in sums.items()])
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(f"_t_{out}").over(earlier), F.lit(0)).alias(f"_o_{out}") for out in sums]
    offsets = bounded(totals.select(*keys, "_range", *before))
    frame = W.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    inner = ranged.select("*", *[F.sum(col).over(frame).alias(out) for out, col in sums.items()])
    joined = inner.join(offsets, [*keys, "_range"])
    return joined.select(*df.columns, *[(F.col(out) + F.col(f"_o_{out}")).alias(out) for out in sums])


def fill_in_order(
    df: DataFrame,
    order: Sequence[str],
    cols: Sequence[str],
    both_ways: bool = True,
    hot_rows: int | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Forward fill, then (``both_ways``) backward fill, over the whole table in ``order``."""
    sort, back = [F.col(c).asc() for c in order], [F.col(c).desc() for c in order]
    rows = df.count()
    if rows <= (hot_rows or HOT_ROWS):
        # backwards is forwards on the reversed order: a frame that shrinks row by row is quadratic in Spark
        ahead = W.orderBy(*sort).rowsBetween(W.unboundedPreceding, 0)
        behind = W.orderBy(*back).rowsBetween(W.unboundedPreceding, 0)
        filled = {c: F.last(c, ignorenulls=True).over(ahead) for c in cols}
        if both_ways:
            filled = {c: F.coalesce(e, F.last(c, ignorenulls=True).over(behind)) for c, e in filled.items()}
        return df.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])
    ranged = _ranges(df, [], sort, rows, parts)
    spot = F.struct(*[F.col(c) for c in order])
    ends = ranged.groupBy("_range").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), spot)).alias(f"_l_{c}") for c in cols],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), spot)).alias(f"_f_{c}") for c in cols],
    )
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    later = W.orderBy("_range").rowsBetween(1, W.unboundedFollowing)
    carried = bounded(
        ends.select(
            "_range",
            *[F.last(f"_l_{c}", ignorenulls=True).over(earlier).alias(f"_p_{c}") for c in cols],
            *[F.first(f"_f_{c}", ignorenulls=True).over(later).alias(f"_s_{c}") for c in cols],
        )
    )
    ahead = W.partitionBy("_range").orderBy(*sort).rowsBetween(W.unboundedPreceding, 0)
    behind = W.partitionBy("_range").orderBy(*back).rowsBetween(W.unboundedPreceding, 0)
    inner = ranged.select(
        "*",
        *[F.last(c, ignorenulls=True).over(ahead).alias(f"_a_{c}") for c in cols],
        *[F.last(c, ignorenulls=True).over(behind).alias(f"_b_{c}") for c in cols],
    ).join(carried, "_range")
    filled = {}
    for c in cols:
        steps = [F.col(f"_a_{c}"), F.col(f"_p_{c}")]
        filled[c] = F.coalesce(*steps, *([F.col(f"_b_{c}"), F.col(f"_s_{c}")] if both_ways else []))
    return inner.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])
