"""Streams in event-time order: a reorder buffer released by the watermark, and what needs that order after it.

Rows wait in Spark's own aggregation by group and millisecond, which hands a millisecond's rows on once the watermark has
passed them. So the waiting rows of a busy group are dealt over many keys, are at most what the watermark
span holds, and see no Python. What then must be sequential, the cooldown of an area or the open
cluster of a network, gets only released rows, and keeps one number or one row a station. A network's rows come in
pieces that are in order inside; it keeps them in its state until it gets to them, one after the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MEMBER = ["us", "station_code", "pick_id"]
SLOT, PIECE = 3_600_000_000, 4000  # microseconds of a network's triggers that are put in order at once; rows of a piece of them


def is_watermarked(df: DataFrame, time: str) -> bool:
    """Whether a frame has a watermark on the column ``time``."""
    return df.isStreaming and "spark.watermarkDelayMs" in (df.schema[time].metadata or {})


def with_state_lists(spark: SparkSession) -> None:
    """List state and timers need the RocksDB store; streams that have started keep the store they have."""
    spark.conf.set(PROVIDER, ROCKSDB)


def _timer(us: int, mark_ms: int) -> int:
    """The first millisecond of the watermark that has passed a time, not before the next one."""
    return max(us // 1000 + 1, mark_ms + 1)


def released(df: DataFrame, time: str, group: str, payload: Sequence[str]) -> DataFrame:
    """Rows (``group``, released, ``payload``) of a watermarked stream, each when the watermark has passed it.

    The buffer is an aggregation by windows of one millisecond, the unit of the watermark, so a window closes exactly when
    the watermark is past its rows. Over all batches the rows of a group come in event-time order; within a batch
    their order is the reader's to restore.
    """
    with_state_lists(df.sparkSession)
    waiting = df.groupBy(group, F.window(time, "1 millisecond").alias("released")).agg(F.collect_list(F.struct(*payload)).alias("_rows"))
    return waiting.select(group, "released", F.inline("_rows"))


class Cooldown(StatefulProcessor):
    """Of an area's alerts in order, those at least ``wait`` microseconds after the last one that went out. Errors always go."""

    def __init__(self, wait: int):
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "us LONG")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = ["alert_id", "us", "is_error"]
        parts = [[pdf[c].to_numpy() for c in names] for pdf in rows]  # the area's name, a text a row, is not kept
        alert, us, error = (np.concatenate(column) for column in zip(*parts))
        order = np.lexsort((alert, us))
        alert, us, error = alert[order], us[order], error[order].astype(bool)
        keep, calls = error.copy(), np.flatnonzero(~error)
        times, at = us[calls], 0
        if self.last.exists():
            at = int(np.searchsorted(times, self.last.get()[0] + self.wait))
        while at < len(times):  # from one alert that goes out to the next
            keep[calls[at]] = True
            last = int(times[at])
            at = max(at + 1, int(np.searchsorted(times, last + self.wait)))
            if at >= len(times):
                self.last.update((last,))
        yield pd.DataFrame({"area": key[0], "alert_id": alert[keep], "us": us[keep], "is_error": error[keep]})

    def close(self) -> None:
        pass


def cooldown_in_order(rows: DataFrame, time: str, minutes: float) -> DataFrame:
    """Alerts (area, alert_id, us, is_error) of a stream with a watermark on ``time`` that go out, whatever the order they come in."""
    ordered = released(rows, time, "area", ["alert_id", "us", "is_error"])
    return ordered.groupBy("area").transformWithStateInPandas(
        Cooldown(round(minutes * 60e6)), "area STRING, alert_id LONG, us LONG, is_error BOOLEAN", "Append", "EventTime"
    )


class Clusters(StatefulProcessor):
    """One network's triggers in order: a cluster opens with the first one, and closes once its window is past.

    The pieces of a batch come in any order, so they wait in the state and are read again by their places; one is in memory at a time.
    """

    def __init__(self, window: int, min_stations: int):
        self.window, self.min_stations = window, min_stations

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "us LONG, station_code STRING, pick_id LONG")
        self.waiting = handle.getMapState("waiting", "slot LONG, number INT", "piece BINARY")

    def _closed(self, network, rows: pd.DataFrame, mark: int | None) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Clusters closed by later ones of the ordered ``rows`` or by the watermark, and the open one, one row a station."""
        us = rows["us"].to_numpy("int64")
        at, found, anchors, opened = 0, [], [], rows.iloc[:0]
        while at < len(us):
            end = int(us.searchsorted(us[at] + self.window, side="right"))
            members = rows.iloc[at:end].drop_duplicates("station_code")
            if end == len(us) and (mark is None or mark <= us[at] + self.window):
                opened = members
                break
            if len(members) >= self.min_stations:
                found.append(members)
                anchors += [us[at]] * len(members)
            at = end
        found = pd.concat(found) if found else rows.iloc[:0]
        return pd.DataFrame({"network": network, "anchor_us": np.array(anchors, "int64"), **{c: found[c].to_numpy() for c in ("station_code", "pick_id", "us")}}), opened

    def _advance(self, network, places: list[tuple[int, int]], mark: int) -> Iterator[pd.DataFrame]:
        """What the pieces at ``places`` and the watermark close; the open cluster goes back to the state."""
        opened = pd.DataFrame([tuple(r) for r in self.open.get()] if self.open.exists() else [], columns=MEMBER)
        done = []
        for place in sorted(places):
            fresh = pa.ipc.open_stream(self.waiting.getValue(place)[0]).read_pandas()
            self.waiting.removeKey(place)
            found, opened = self._closed(network, pd.concat([opened, fresh], ignore_index=True) if len(opened) else fresh, None)
            done.append(found)
            if sum(map(len, done)) >= PIECE:
                yield pd.concat(done, ignore_index=True)
                done = []
        found, opened = self._closed(network, opened, mark)
        if len(opened):
            self.open.put(list(opened.itertuples(index=False, name=None)))
            self.handle.registerTimer(_timer(int(opened["us"].iloc[0]) + self.window, mark // 1000))
        else:
            self.open.clear()
        yield pd.concat([*done, found], ignore_index=True)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        places = []
        for pdf in rows:
            for slot, number, piece in zip(pdf["slot"], pdf["number"], pdf["piece"]):
                self.waiting.updateValue((int(slot), int(number)), (bytes(piece),))
                places.append((int(slot), int(number)))
        yield from self._advance(key[0], places, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key[0], [], timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass


def _pieces(most: int) -> Callable[[pa.Table], pa.Table]:
    """How the rows of a network's slot are put in order, ``most`` of them a row of the result."""

    def cut(rows: pa.Table) -> pa.Table:
        ordered = rows.select(MEMBER).sort_by([("us", "ascending"), ("pick_id", "ascending")])
        pieces = []
        for low in range(0, ordered.num_rows, most):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, ordered.schema) as writer:
                writer.write_table(ordered.slice(low, most).combine_chunks())
            pieces.append(sink.getvalue().to_pybytes())
        network, slot = rows["network"][0].as_py(), rows["slot"][0].as_py()
        columns = [[network] * len(pieces), [slot] * len(pieces), range(len(pieces)), pieces]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.binary()))], ["network", "slot", "number", "piece"])

    return cut


def clusters_in_order(rows: DataFrame, time: str, window: int, min_stations: int, slot: int = SLOT, piece: int = PIECE) -> DataFrame:
    """Members (network, anchor_us, station_code, pick_id, us) of the clusters of a stream of triggers with a watermark on ``time``.

    Of a station's triggers at one time only the first counts for a cluster, so no more than it waits. What the watermark releases at once can
    be the whole history of a network, which is one task's: it gets it in pieces that are in order inside, made by network and slot of time.
    """
    with_state_lists(rows.sparkSession)
    waiting = rows.groupBy("network", "station_code", "us", F.window(time, "1 millisecond").alias("released")).agg(F.min("pick_id").alias("pick_id"))
    slotted = waiting.select("network", F.floor(F.col("us") / slot).alias("slot"), *MEMBER)
    pieces = slotted.groupBy("network", "slot").applyInArrow(_pieces(piece), "network STRING, slot LONG, number INT, piece BINARY")
    return pieces.groupBy("network").transformWithStateInPandas(
        Clusters(window, min_stations), "network STRING, anchor_us LONG, station_code STRING, pick_id LONG, us LONG", "Append", "EventTime"
    )
