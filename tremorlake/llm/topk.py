"""Exact top-k search with a pivot table.

Pivots are chosen from a bounded sample by farthest-first traversal. Every vector's distances to them
put it into the cell of its nearest pivot; cells are cut into blocks of bounded size. For an inner
product, |q - c|**2 = |q|**2 + |c|**2 - 2 q.c, and |q - c| is at least |d(q, p) - d(c, p)| for every
pivot p: the largest of these lower bounds is an upper bound of the score. Blocks of queries read the
blocks of candidates in the order of that bound, skip queries and candidates whose bound is below the
k-th score so far, and stop at the first block that can no longer matter to any query of the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tremorlake.llm.common import drop, keep

PIVOTS = 32
SAMPLE = 4096  # vectors that the pivots are chosen from
BLOCK = 512  # vectors of a block of candidates, about
QUERIES = 512  # queries of a block, about
SLICE = 16  # blocks of candidates that one task reads for a block of queries
LIMIT = 2**28  # components beyond this count as this, so that scores fit in 64 bits


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): floor(64 x) of the components, of vectors without missing or non-finite ones.

    Shorter vectors count as padded with zeros; of rows that repeat a vec_id the smallest counts.
    """
    x = F.col("embedding")
    fine = x.isNotNull() & F.col("vec_id").isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(F.lit(64.0) * c.cast("double")))).cast("int"))
    found = vectors.select("vec_id", "embedding").filter(fine).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    return found.groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for line, row in zip(out, rows):
        line[: len(row)] = row
    return out


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each pivot is the vector farthest from those before it."""
    picked = [0]
    far = np.linalg.norm(sample - sample[0], axis=1)
    while len(picked) < min(count, len(sample)):
        picked.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(sample - sample[picked[-1]], axis=1))
    return sample[picked]


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (vectors**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(square, 0.0))


class _Best:
    """The k best candidates so far of each query of a block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, table: np.ndarray, k: int):
        self.ids, self.vectors, self.table, self.k = ids, vectors, table, k
        self.norms = (vectors**2).sum(1)
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def bound(self, low: np.ndarray, high: np.ndarray, norm: float) -> np.ndarray:
        """An upper bound, per query, of the scores with candidates whose pivot distances lie between."""
        gap = np.maximum(low[None] - self.table, self.table - high[None]).max(1)
        return (self.norms + norm - np.maximum(gap - 1e-6, 0.0) ** 2) / 2 + 1e-3

    def read(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray) -> None:
        table, norms = distances(vectors, pivots), (vectors**2).sum(1)
        active = np.flatnonzero(self.bound(table.min(0), table.max(0), norms.max()) >= self.scores[:, -1])
        if not len(active):
            return
        own = self.table[active]
        gap = np.maximum(own.min(0)[None] - table, table - own.max(0)[None]).max(1)
        most = (self.norms[active].max() + norms - np.maximum(gap - 1e-6, 0.0) ** 2) / 2 + 1e-3
        near = np.flatnonzero(most >= self.scores[active, -1].min())
        if not len(near):
            return
        exact = np.abs(vectors).max() * np.abs(self.vectors).max() * vectors.shape[1] < 2**53
        left, right = self.vectors[active], vectors[near].T
        score = left @ right if exact else (left.astype(np.int64) @ right.astype(np.int64)).astype(np.float64)
        score[self.ids[active][:, None] == ids[near][None]] = -np.inf
        names = np.broadcast_to(ids[near], score.shape)
        score, names = np.hstack([self.scores[active], score]), np.hstack([self.found[active], names])
        if score.shape[1] > 4 * self.k:  # all that reach the k-th best score, ties included
            cut = np.partition(score, -self.k, axis=1)[:, -self.k][:, None]
            width = int((score >= cut).sum(1).max())
            kept = np.argsort(score < cut, axis=1, kind="stable")[:, :width]
            score, names = np.take_along_axis(score, kept, 1), np.take_along_axis(names, kept, 1)
        order = np.lexsort((names, -score), axis=1)[:, : self.k]
        self.scores[active] = np.take_along_axis(score, order, 1)
        self.found[active] = np.take_along_axis(names, order, 1)

    def rows(self) -> pa.RecordBatch:
        there = self.scores > -np.inf
        asked = np.broadcast_to(self.ids[:, None], there.shape)[there]
        columns = [pa.array(asked), pa.array(self.found[there]), pa.array(self.scores[there].astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])


def search(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The k best inner products of each query, a row whose vec_id is divisible by ``every``, with all other rows.

    ``vectors``: vec_id, embedding. Returns query_id, rank, vec_id, score; ties go to the smaller
    vec_id. Vectors that are NULL or hold a NULL or non-finite component, and rows without vec_id, take
    no part. Fewer than k others give fewer rows. An empty table gives an empty one. Other columns are
    not read.
    """
    spark = vectors.sparkSession
    whole = keep(integers(vectors))
    width = whole.agg(F.max(F.size("v"))).first()[0] or 1
    sample = [r["v"] for r in whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()]
    out = "query_id long, vec_id long, score long"
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = choose_pivots(matrix(sample, width), PIVOTS)

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = distances(matrix(batch.column(1).to_pylist(), width), pivots)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(table.argmin(1))], names=["vec_id", "v", "cell"])

    cells = keep(whole.mapInArrow(celled, "vec_id long, v array<int>, cell long"))
    asks = F.pmod("vec_id", F.lit(every)) == 0
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(asks, 1)).alias("q")).collect()
    queries = sum(r["q"] for r in sizes)
    groups = min(len(pivots), -(-queries // QUERIES))  # cells with few queries share a block of queries
    group = {r["cell"]: r["cell"] * groups // len(pivots) for r in sizes}
    load = {g: sum(r["q"] for r in sizes if group[r["cell"]] == g) for g in group.values()}
    rows = [(c := r["cell"], -(-r["n"] // BLOCK), group[c], -(-load[group[c]] // QUERIES)) for r in sizes]
    counts = spark.createDataFrame(rows, "cell long, blocks long, ask_group long, asked long")
    dealt = cells.join(F.broadcast(counts), "cell")  # at most one row per pivot

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id")
        block = matrix(frame["v"].tolist(), width)
        table = distances(block, pivots)
        return pd.DataFrame({
            "cell": [frame["cell"].iloc[0]], "part": [frame["part"].iloc[0]], "ids": [frame["vec_id"].to_numpy(np.int64).tobytes()],
            "data": [block.astype(np.int32).tobytes()], "low": [table.min(0).tolist()], "high": [table.max(0).tolist()],
            "norm": [float((block**2).sum(1).max())],
        })

    shape = "cell long, part long, ids binary, data binary, low array<double>, high array<double>, norm double"
    split = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col(n)).alias("part")
    blocks = keep(dealt.select("vec_id", "v", "cell", split("blocks")).groupBy("cell", "part").applyInPandas(packed, shape))
    asked = keep(dealt.filter(asks).select("vec_id", "v", F.col("ask_group").alias("cell"), split("asked")).groupBy("cell", "part").applyInPandas(packed, shape))
    number = F.dense_rank().over(W.orderBy("cell", "part")) - 1  # over the blocks' keys only: a 1/BLOCK of the rows
    names = keep(asked.select("cell", "part").withColumn("ask", number))
    asked = keep(asked.join(names, ["cell", "part"]))
    total, slices = asked.count(), -(-blocks.count() // SLICE)
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pairs = blocks.withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(total - 1)))).withColumn("slice", F.pmod(F.xxhash64("cell", "part", F.lit(9)), F.lit(slices)))
    ranges = asked.select("ask", F.col("low").alias("qlow"), F.col("high").alias("qhigh"), F.col("norm").alias("qnorm"))
    pairs = pairs.join(ranges, "ask")
    gaps = F.zip_with(F.zip_with("low", "qhigh", lambda a, b: a - b), F.zip_with("qlow", "high", lambda a, b: a - b), lambda a, b: F.greatest(a, b))
    gap = F.greatest(F.array_max(gaps) - 1e-6, F.lit(0.0))
    pairs = pairs.select("ask", "slice", ((F.col("norm") + F.col("qnorm") - gap * gap) / 2 + 1e-3).alias("bound"), "ids", "data", F.lit(False).alias("asks"))
    heads = asked.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<bigint>")))
    heads = heads.select("ask", "slice", F.lit(float("inf")).alias("bound"), "ids", "data", F.lit(True).alias("asks"))
    stream = heads.unionByName(pairs).repartition("ask", "slice").sortWithinPartitions("ask", "slice", F.desc("bound"))

    def evaluated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            for bound, ids, data, asks in zip(*(batch.column(c) for c in ("bound", "ids", "data", "asks"))):
                if not asks.as_py() and bound.as_py() < best.scores[:, -1].min():
                    continue  # this and all later blocks of the group
                ids = np.frombuffer(ids.as_py(), np.int64)
                block = np.frombuffer(data.as_py(), np.int32).reshape(len(ids), width).astype(np.float64)
                if asks.as_py():
                    if best is not None:
                        yield best.rows()
                    best = _Best(ids, block, distances(block, pivots), k)
                else:
                    best.read(ids, block, pivots)
        if best is not None:
            yield best.rows()

    found = keep(stream.mapInArrow(evaluated, out))
    drop(whole, cells, blocks, names, asked)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM fine q, fine c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs
)
SELECT * FROM ranked WHERE rank <= 20
"""
