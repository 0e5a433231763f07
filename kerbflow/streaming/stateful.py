"""The detector as a keyed stateful operator of Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kerbflow.functions.status import EMPTY, FULL, NORMAL, OUT_OF_SERVICE
from kerbflow.schemas import STATION_STATE, STATUS_EVENT

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of a station that are held at a time; beyond that the rows of a batch wait on disk, by slices of time.
HELD = 200_000
SLICE_US = 3_600_000_000
ROW = np.dtype([("at", "<i8"), ("code", "i1"), ("bikes", "<i4"), ("docks", "<i4")])
STATUSES = np.array([NORMAL, EMPTY, FULL, OUT_OF_SERVICE], dtype=object)


def _compact(pdf: pd.DataFrame) -> np.ndarray:
    """Time, status code, bikes and docks of some rows, 17 bytes each; of one instant the first to arrive."""
    out = np.empty(len(pdf), ROW)
    out["bikes"], out["docks"] = pdf["bikes_available"].to_numpy("int32"), pdf["docks_available"].to_numpy("int32")
    running = (pdf["service_status"] == 1).fillna(False).to_numpy(bool)
    out["code"] = np.select([~running, out["bikes"] == 0, out["docks"] == 0], [3, 1, 2], 0)
    out["at"] = pdf["source_updated_at"].to_numpy("datetime64[us]").astype("int64")
    return out[np.unique(out["at"], return_index=True)[1]]


def changes(rows: np.ndarray, state: tuple[str, int, int] | None) -> tuple[pd.DataFrame | None, tuple[str, int, int] | None]:
    """Events of some rows of one station that are newer than its state, and the state after them."""
    rows = rows[np.unique(rows["at"], return_index=True)[1]]
    before = -1
    if state is not None:
        before = int(np.flatnonzero(STATUSES == state[0])[0])
        rows = rows[rows["at"] > state[2]]
    if not len(rows):
        return None, state
    at, code = rows["at"], rows["code"]
    change = np.flatnonzero(code != np.concatenate(([before], code[:-1])))
    if not len(change):
        return None, (state[0], state[1], int(at[-1]))
    previous = np.concatenate(([before], code[change][:-1]))
    began = np.concatenate(([state[1] if state else 0], at[change][:-1]))
    emit = (previous >= 0) | (code[change] != 0)
    picked = rows[change[emit]]
    found = pd.DataFrame({
        "status": STATUSES[picked["code"]],
        "previous_status": [STATUSES[p] if p >= 0 else None for p in previous[emit]],
        "changed_at": picked["at"].astype("datetime64[us]"),
        "previous_duration_seconds": pd.array(
            [int(d) if p >= 0 else None for d, p in zip((at[change] - began)[emit] // 1_000_000, previous[emit])], dtype="Int64"),
        "bikes_available": picked["bikes"],
        "docks_available": picked["docks"],
    })
    return found if len(found) else None, (str(STATUSES[code[change[-1]]]), int(at[change[-1]]), int(at[-1]))


class Detector(StatefulProcessor):
    """Changes of one station after another, in order of event time.

    What lasts of a station is three values. While a batch of more than HELD rows of one station comes in, the rows go to
    the state store, under the slice of time that they belong to, and are then worked off slice by slice: a task holds the
    rows of one slice, however many the station has.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.station = handle.getValueState("station", STATION_STATE)
        self.waiting = handle.getMapState("waiting", "slice bigint, part int", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        parts: dict[int, int] = {}
        for pdf in rows:
            held.append(_compact(pdf))
            if sum(map(len, held)) > HELD:
                self._put_off(held, parts)
                held = []
        if parts:
            self._put_off(held, parts)
        state = tuple(self.station.get()) if self.station.exists() else None
        for some in self._slices(parts) if parts else [np.concatenate(held)]:
            found, state = changes(some, state)
            if found is not None:
                found.insert(0, "station_uid", key[0])
                yield found
        if state is not None:
            self.station.update(state)

    def _put_off(self, held: list[np.ndarray], parts: dict[int, int]) -> None:
        rows = np.concatenate([*held, np.empty(0, ROW)])
        rows = rows[np.argsort(rows["at"], kind="stable")]
        slices = rows["at"] // SLICE_US
        for some in np.split(rows, np.flatnonzero(np.diff(slices)) + 1) if len(rows) else ():
            number = int(some["at"][0]) // SLICE_US
            self.waiting.updateValue((number, parts.get(number, 0)), (some.tobytes(),))
            parts[number] = parts.get(number, 0) + 1

    def _slices(self, parts: dict[int, int]) -> Iterator[np.ndarray]:
        for number in sorted(parts):
            some = [np.frombuffer(self.waiting.getValue((number, part))[0], ROW) for part in range(parts[number])]
            yield np.concatenate(some)
            for part in range(parts[number]):
                self.waiting.removeKey((number, part))

    def close(self) -> None:
        pass


def status_events(observations: DataFrame) -> DataFrame:
    """Status changes of a stream; the state of a station outlives batches and restarts.

    The state lives in RocksDB, on the executors' disks; the session's provider is set to it.
    """
    observations.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return observations.groupBy("station_uid").transformWithStateInPandas(Detector(), STATUS_EVENT, "Append", "None")
