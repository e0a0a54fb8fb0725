"""Greedy anchor chains in parallel: the first time, then the first one more than ``window`` later, ...

The chain is sequential by definition, so the time axis is cut into blocks of two sizes and solved as
a scan. Going up, each block tells for every time at which a chain could enter it which anchor would
be its last there. Going down, the true entry of each block is known, and its anchors are listed.
Only times within one window of a block's start can be entries, so what goes up is a small share
(window / block) of the times. Tasks see distinct times of one block, so a hot key is split by time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tremorlake.scale import hot_groups
from tremorlake.session import durable

BLOCK_WINDOWS = 360  # windows per block, and blocks per big block
NEVER = -(2**62)


def _fold(blocks: np.ndarray, entries: np.ndarray, lasts: np.ndarray, window: int, bound: int) -> list[tuple[int, int]]:
    """(block, bound on entry) for blocks in order, then (-1, bound on exit); rows sorted by block, entry.

    ``bound`` is what the next anchor must exceed.
    """
    out = []
    starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
    ends = np.r_[starts[1:], len(blocks)]
    for a, b in zip(starts, ends):
        out.append((int(blocks[a]), bound))
        at = a + np.searchsorted(entries[a:b], bound, side="right")
        if at < b:
            bound = int(lasts[at]) + window
    out.append((-1, bound))
    return out


def greedy_anchors(
    times: DataFrame, keys: Sequence[str], time: str, window: int, block_windows: int = BLOCK_WINDOWS, hot_rows: int | None = None
) -> DataFrame:
    """Anchors of each key: (keys, anchor). ``time`` and ``window`` are whole numbers (microseconds).

    Keys with few distinct times are one small group each; the scan is for the others.
    """
    keys = list(keys)
    window = int(window)
    small = max(1, window) * block_windows
    big = small * block_windows
    fields = [times.schema[k] for k in keys]
    distinct = durable(
        times.select(*keys, F.col(time).cast("long").alias("t")).distinct().withColumns(
            {"block": F.expr(f"t div {small} - if(t < 0 and t % {small} <> 0, 1, 0)"), "super": F.expr(f"t div {big} - if(t < 0 and t % {big} <> 0, 1, 0)")}
        )
    )
    long = T.LongType()
    map_schema = T.StructType([*fields, *[T.StructField(c, long) for c in ("super", "block", "entry", "last")]])
    bound_schema = T.StructType([*fields, *[T.StructField(c, long) for c in ("super", "block", "bound")]])
    anchor_schema = T.StructType([*fields, T.StructField("anchor", long)])

    def labels(pdf: pd.DataFrame, n: int) -> dict:
        return {k: np.array([pdf[k].iloc[0]] * n, dtype=object) for k in keys}  # typed, also when empty

    def block_map(pdf: pd.DataFrame) -> pd.DataFrame:
        t = np.sort(pdf["t"].to_numpy())
        after = np.searchsorted(t, t + window, side="right")
        last = t.copy()
        for i in range(len(t) - 1, -1, -1):
            if after[i] < len(t):
                last[i] = last[after[i]]
        start = int(pdf["block"].iloc[0]) * small
        can_enter = np.r_[True, t[:-1] < start + window]
        entry, last = t[can_enter], last[can_enter]
        n = len(entry)
        return pd.DataFrame(
            {**labels(pdf, n), "super": [pdf["super"].iloc[0]] * n, "block": [pdf["block"].iloc[0]] * n, "entry": entry, "last": last}
        )

    def super_map(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["block", "entry"])
        blocks, entries, lasts = (pdf[c].to_numpy() for c in ("block", "entry", "last"))
        first = blocks == blocks[0]
        candidates = list(entries[first]) + list(entries[~first][:1])
        ends = [_fold(blocks, entries, lasts, window, int(e) - 1)[-1][1] - window for e in candidates]
        n = len(candidates)
        return pd.DataFrame({**labels(pdf, n), "super": [pdf["super"].iloc[0]] * n, "block": [0] * n, "entry": candidates, "last": ends})

    def top_bounds(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["super", "entry"])
        found = _fold(pdf["super"].to_numpy(), pdf["entry"].to_numpy(), pdf["last"].to_numpy(), window, NEVER)[:-1]
        n = len(found)
        return pd.DataFrame({**labels(pdf, n), "super": [f[0] for f in found], "block": [0] * n, "bound": [f[1] for f in found]})

    def block_bounds(maps: pd.DataFrame, bounds: pd.DataFrame) -> pd.DataFrame:
        maps = maps.sort_values(["block", "entry"])
        columns = (maps[c].to_numpy() for c in ("block", "entry", "last"))
        found = _fold(*columns, window, int(bounds["bound"].iloc[0]))[:-1]
        n = len(found)
        return pd.DataFrame(
            {**labels(maps, n), "super": [maps["super"].iloc[0]] * n, "block": [f[0] for f in found], "bound": [f[1] for f in found]}
        )

    def expand(pdf: pd.DataFrame, bounds: pd.DataFrame) -> pd.DataFrame:
        t = np.sort(pdf["t"].to_numpy())
        anchors = []
        at = int(np.searchsorted(t, int(bounds["bound"].iloc[0]), side="right"))
        while at < len(t):
            anchors.append(int(t[at]))
            at = int(np.searchsorted(t, t[at] + window, side="right"))
        return pd.DataFrame({**labels(pdf, len(anchors)), "anchor": np.array(anchors, dtype="int64")})

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        return expand(pdf, pd.DataFrame({"bound": [NEVER]}))

    hot = hot_groups(distinct, keys, hot_rows)
    if hot is None:
        return distinct.groupBy(*keys).applyInPandas(whole, anchor_schema)
    cold = distinct.join(hot, keys, "left_anti").groupBy(*keys).applyInPandas(whole, anchor_schema)
    distinct = distinct.join(hot, keys, "left_semi")
    maps = durable(distinct.groupBy(*keys, "super", "block").applyInPandas(block_map, map_schema))
    tops = maps.groupBy(*keys, "super").applyInPandas(super_map, map_schema)
    top = tops.groupBy(*keys).applyInPandas(top_bounds, bound_schema)
    bounds = (
        maps.groupBy(*keys, "super").cogroup(top.groupBy(*keys, "super")).applyInPandas(block_bounds, bound_schema)
    )
    grouped = distinct.groupBy(*keys, "super", "block").cogroup(bounds.groupBy(*keys, "super", "block"))
    return cold.unionByName(grouped.applyInPandas(expand, anchor_schema))
