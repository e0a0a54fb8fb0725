"""Exact k nearest neighbours by an adaptive quadtree, as joins and aggregations of whole levels.

Cells of a quadtree are split while they hold more than ``LEAF`` points, so a crowded place gets small cells and an
empty region none. Every cell has the tight box of its points. The queries have a tree of their own, and what is searched
is pairs of a query leaf and a point cell: they start at the root and go down a level, 16 cells, a step. Of each query leaf's
cells those with the nearest far corners that together hold enough points bound its k-th distance; cells that start beyond
that bound leave. So a far point, alone in its leaf, keeps the few cells that can matter, and never meets a whole cluster. The number of
pairs is a constant times the number of queries, whatever the distances.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tremorlake.session import durable, release

LEAF = 32  # points of a leaf, at least; more if more neighbours are asked for
HALVINGS = 26  # of each side, in one word of a cell's path
WORD = HALVINGS // 2  # digits of a word: one digit is two halvings of each side, 16 cells
DEPTH = 2 * WORD  # digits of a path, so that a crowd of a 2**52nd of the extent is still split
WIDE = 48  # cells of a leaf of queries, above which they go on one by one
FEW_CELLS = 100_000  # cells of a level that may be broadcast, some 10 MB
TWIN_PARTS = 64  # parts of a place with many coincident points, cut before its first keys are ranked
SLACK = 1 + 1e-14  # of the bound, for rounding


def _spread(x: Column) -> Column:
    """The low 26 bits of a number, a zero bit between each two."""
    steps = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))
    listed = F.array(*[F.struct(F.lit(shift).alias("shift"), F.lit(mask).alias("mask")) for shift, mask in steps])
    return F.aggregate(listed, x, lambda v, s: v.bitwiseOR(F.call_function("shiftleft", v, s["shift"])).bitwiseAND(s["mask"]))


def _path(x: str, y: str, low: tuple[float, float], extent: float) -> Column:
    """The cells of a point from the root down, a digit each: every prefix names a cell, the empty one the root."""
    most = F.lit(2**HALVINGS - 1).cast("long")
    words = []
    scaled = [(F.col(c) - F.lit(start)) / F.lit(extent) * float(2**HALVINGS) for c, start in ((x, low[0]), (y, low[1]))]
    for _ in range(DEPTH // WORD):
        at = [F.least(F.greatest(F.floor(v).cast("long"), F.lit(0).cast("long")), most) for v in scaled]
        words.append(F.lpad(F.hex(_spread(at[0]).bitwiseOR(F.shiftleft(_spread(at[1]), 1))), WORD, "0"))
        scaled = [(v - i) * float(2**HALVINGS) for v, i in zip(scaled, at)]
    return F.concat(*words)


def _cell_at(level: Column) -> Column:
    return F.substring("_path", F.lit(1), level)


def _boxes(dims: Sequence[str], n: Column) -> list[Column]:
    return [n.alias("n"), *[f(c).alias(f"{name}_{i}") for i, c in enumerate(dims) for name, f in (("lo", F.min), ("hi", F.max))]]


def with_leaf(points: DataFrame, leaf: int) -> DataFrame:
    """``points`` (with ``_path``, cheap to read twice) with the cell that is their leaf, ``_leaf``."""
    out, at = points, F.lit(0)
    for top in range(0, DEPTH, WORD):  # the second word only for points that the first one leaves crowded
        levels = F.explode(F.array(*[F.lit(level) for level in range(top, top + WORD)]))
        within = points if top == 0 else points.join(send(last), _cell_at(F.lit(top)) == F.col(f"_c{top - 1}_next"), "left_semi")
        cells = within.select("_path", levels.alias("_level")).select("_level", _cell_at(F.col("_level")).alias("_cell"))
        crowded = durable(cells.groupBy("_level", "_cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > leaf).select("_level", "_cell"))
        sizes = {r["_level"]: r["count"] for r in crowded.groupBy("_level").count().collect()}
        for level in sorted(sizes):  # a level's crowded cells lie in those of the level above
            own = crowded.filter(F.col("_level") == level).select(F.col("_cell").alias(f"_c{level}"))
            own = F.broadcast(own) if sizes[level] <= FEW_CELLS else own
            out = out.join(own, _cell_at(F.lit(level)) == F.col(f"_c{level}"), "left")
            at = F.when(F.col(f"_c{level}").isNotNull(), F.lit(level + 1)).otherwise(at)
        ends = top + WORD
        if ends - 1 not in sizes or ends == DEPTH:
            break
        deeper = crowded.filter(F.col("_level") == ends - 1).select(F.col("_cell").alias("_above"))
        inner = points.join(F.broadcast(deeper) if sizes[ends - 1] <= FEW_CELLS else deeper, _cell_at(F.lit(ends - 1)) == F.col("_above"), "left_semi")
        last = durable(inner.select(_cell_at(F.lit(ends)).alias(f"_c{ends - 1}_next")).groupBy(f"_c{ends - 1}_next").count().filter(F.col("count") > leaf).select(f"_c{ends - 1}_next"))
        send = F.broadcast if last.count() <= FEW_CELLS else lambda df: df
    return out.withColumn("_leaf", _cell_at(at)).select(*points.columns, "_leaf")


def _apart(dims: int) -> tuple[Column, Column]:
    """Squared distance of two boxes (q.. and lo/hi ..): the least, and the greatest, of any two of their points."""
    near, far = F.lit(0.0), F.lit(0.0)
    for i in range(dims):
        a, b, c, d = (F.col(f"{name}_{i}") for name in ("qlo", "qhi", "lo", "hi"))
        gap, span = F.greatest(c - b, a - d, F.lit(0.0)), F.greatest(d - a, b - c)
        near, far = near + gap * gap, far + span * span
    return near, far


def _tree(leaves: DataFrame, dims: int) -> DataFrame:
    """All cells from the root to the leaves: (cell, up, level, n, is_leaf, boxes)."""
    paths = leaves.withColumn("level", F.explode(F.sequence(F.lit(0), F.length("_leaf"))))
    ends = [f(f"{name}_{i}").alias(f"{name}_{i}") for i in range(dims) for name, f in (("lo", F.min), ("hi", F.max))]
    cells = paths.groupBy("level", F.substring("_leaf", F.lit(1), F.col("level")).alias("cell"))
    made = cells.agg(F.sum("n").alias("n"), F.max(F.length("_leaf") == F.col("level")).alias("is_leaf"), *ends)
    return made.withColumn("up", F.substring("cell", F.lit(1), F.col("level") - 1))


def _pruned(front: DataFrame, dims: int, need: int) -> DataFrame:
    """The pairs that can matter, with the ``bound`` of their query part."""
    near, far = _apart(dims)
    part = W.partitionBy("q")
    timed = front.withColumns({"near": near, "far": far}).withColumn("upto", F.sum("n").over(part.orderBy("far").rangeBetween(W.unboundedPreceding, W.currentRow)))
    bound = F.min(F.when(F.col("upto") >= need, F.col("far"))).over(part)
    return timed.withColumn("bound", bound).filter(F.col("bound").isNull() | (F.col("near") <= F.col("bound") * SLACK)).drop("near", "far", "upto")


def leaf_pairs(asked: DataFrame, homes: DataFrame, dims: Sequence[str], need: int) -> DataFrame:
    """(q, row, cell, bound): the point leaves that may hold one of the ``need`` nearest points of a query.

    ``q`` is a leaf of queries, or, with its ``row``, a single query: the queries of a leaf that has very many pairs go on
    by themselves, because a wide leaf far from a small crowd cannot tell its points apart. ``bound`` is
    at least the squared distance of the ``need``-th nearest point of each query there, NULL if there are fewer points.
    """
    tree = durable(_tree(homes.groupBy("_leaf").agg(*_boxes([f"_p_{c}" for c in dims], F.count(F.lit(1)))), len(dims)))
    ends = [f"{name}_{i}" for i in range(len(dims)) for name in ("lo", "hi")]
    cells = ["cell", "n", "is_leaf", *ends]
    levels = {r["level"]: r for r in tree.groupBy("level").agg(F.count(F.lit(1)).alias("cells"), F.first(F.struct(*cells)).alias("one")).collect()}
    root = levels[0]["one"]
    leaves = asked.groupBy("_leaf").agg(*_boxes(dims, F.count(F.lit(1))))
    start = leaves.select(F.col("_leaf").alias("q"), F.lit(None).cast("long").alias("row"), *[F.col(c).alias(f"q{c}") for c in ends])
    front = start.withColumns({c: F.lit(root[c]) for c in cells})
    level, old = 0, []
    while True:
        kept = durable(_pruned(front, len(dims), need))
        release(*old)
        old = [kept]
        wide = kept.filter("row IS NULL").groupBy(F.col("q").alias("_wide")).count().filter(F.col("count") > WIDE).select("_wide")
        if wide.limit(1).count():
            wide = durable(wide)
            one = asked.select(F.col("_leaf").alias("_of"), "_row", *[F.col(c).alias(f"q{name}_{i}") for i, c in enumerate(dims) for name in ("lo", "hi")])
            alone = kept.filter("row IS NULL").join(wide, F.col("q") == F.col("_wide"), "left_semi").select("q", *cells)
            alone = alone.join(one, F.col("q") == F.col("_of")).withColumns({"q": F.concat_ws(":", "q", "_row"), "row": F.col("_row")}).select(*front.columns)
            rest = kept.join(wide, F.col("q") == F.col("_wide"), "left_anti")
            kept = durable(rest.unionByName(_pruned(alone, len(dims), need)))
            old.append(kept)
            release(wide)
        level += 1
        if level not in levels:
            release(tree, *old[:-1])
            return kept.select("q", "row", "cell", "bound")
        below = tree.filter(F.col("level") == level).select("up", *cells)
        below = F.broadcast(below) if levels[level]["cells"] <= FEW_CELLS else below
        own = kept.filter("not is_leaf").select("q", "row", *[f"q{c}" for c in ends], F.col("cell").alias("above"))
        children = own.join(below, F.col("above") == F.col("up")).drop("above", "up")
        front = kept.filter("is_leaf").drop("bound").unionByName(children)


def _first_of_place(homes: DataFrame, dims: Sequence[str], keep: int) -> DataFrame:
    """Of coincident points the ``keep`` smallest keys; a place with very many is cut into parts first."""
    place = [F.col(f"_p_{c}") for c in dims]
    part = F.pmod(F.xxhash64("_point"), F.lit(TWIN_PARTS))
    for by in ([*place, part], place):
        homes = homes.withColumn("_twin", F.row_number().over(W.partitionBy(*by).orderBy("_point"))).filter(F.col("_twin") <= keep).drop("_twin")
    return homes


def candidate_pairs(
    queries: DataFrame, points: DataFrame, k: int, query_key: str, point_key: str, dims: Sequence[str], keep: Sequence[str] = (), skip_same: bool = False
) -> DataFrame:
    """(_query, _point, d2, keep ...): pairs that hold every query's ``k`` nearest points, ties included."""
    x, y = dims[:2]
    whole = lambda df: df.filter(" AND ".join(f"`{c}` IS NOT NULL AND NOT isnan(`{c}`) AND abs(`{c}`) < double('Infinity')" for c in dims))
    doubles = [F.col(c).cast("double").alias(c) for c in dims]
    points = durable(whole(points.select(F.col(point_key).alias("_point"), *doubles, *[F.col(c).alias(f"_k_{c}") for c in keep])))
    asked = durable(whole(queries.select(F.col(query_key).alias("_query"), *doubles)).withColumn("_row", F.monotonically_increasing_id()))
    here = points.select(*dims[:2], F.lit(True).alias("_p")).unionByName(asked.select(*dims[:2], F.lit(False).alias("_p")))
    box = here.agg(F.min(x), F.max(x), F.min(y), F.max(y), F.max("_p")).first()
    if not box[4]:
        raise ValueError("no points")
    low, extent = (box[0], box[2]), max(box[1] - box[0], box[3] - box[2], 1e-9) * (1 + 1e-9)
    need = k + (1 if skip_same else 0)
    leaf = max(LEAF, 4 * need)
    homes = _first_of_place(points.withColumnsRenamed({c: f"_p_{c}" for c in dims}), dims, need)
    homes = durable(with_leaf(durable(homes.withColumn("_path", _path(f"_p_{x}", f"_p_{y}", low, extent))), leaf).drop("_path"))
    asked = durable(with_leaf(asked.withColumn("_path", _path(x, y, low, extent)), leaf).drop("_path"))
    met = leaf_pairs(asked, homes, list(dims), need)
    d2 = sum(((F.col(f"_p_{c}") - F.col(c)) * (F.col(f"_p_{c}") - F.col(c)) for c in dims[1:]), (F.col(f"_p_{x}") - F.col(x)) * (F.col(f"_p_{x}") - F.col(x)))
    by_leaf = asked.join(met.filter("row IS NULL"), F.col("_leaf") == F.col("q"))
    alone = asked.join(met.filter("row IS NOT NULL"), F.col("_row") == F.col("row"))
    pairs = by_leaf.unionByName(alone).drop("_leaf").join(homes, F.col("cell") == F.col("_leaf")).withColumn("d2", d2)
    pairs = pairs.filter(F.col("bound").isNull() | (F.col("d2") <= F.col("bound") * SLACK))
    if skip_same:
        pairs = pairs.filter(F.col("_query") != F.col("_point"))
    return pairs.select("_query", "_point", "d2", *[F.col(f"_k_{c}").alias(c) for c in keep])


def nearest(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    query_key: str,
    point_key: str,
    coords: tuple[str, str] = ("x", "y"),
    more: Sequence[str] = (),
    keep: Sequence[str] = (),
    skip_same: bool = False,
) -> DataFrame:
    """Exact k nearest points of each query point, ties by point key: (query, point, d2, rank, keep ...).

    ``more`` names further dimensions: cells are cut by ``coords`` alone, boxes and distances have all.
    Rows with a NULL, NaN or infinite coordinate are neither queries nor points. Of coincident points the first
    keys are kept, which is exact. With fewer than ``k`` points each query has all of them.
    """
    pairs = candidate_pairs(queries, points, k, query_key, point_key, [*coords, *more], keep, skip_same)
    order = W.partitionBy("_query").orderBy("d2", "_point")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("_query").alias(query_key), F.col("_point").alias(f"{point_key}_2" if skip_same else point_key), "d2", "rank", *keep)
