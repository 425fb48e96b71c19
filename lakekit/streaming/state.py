"""Per-key state kept by hand where windows and watermarks do not say what is wanted."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def running_totals(stream: DataFrame, key: str, value: str) -> DataFrame:
    """Number of rows and sum so far per key, one update row for each that a batch touches.

    Rows are added up per key and Arrow batch before they are shuffled, so a busy key brings one row per ten thousand of its
    rows to its state; the rows of a key arrive as a sequence of frames and are never held as a whole.
    """

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(key).aggregate([([], "count_all"), (value, "sum")])
            yield from pa.table({key: found[key], "n": found["count_all"], "total": found[f"{value}_sum"].fill_null(0)}).to_batches()

    def advance(k, frames: Iterator[pd.DataFrame], state: GroupState):
        n, total = state.get if state.exists else (0, 0)
        for frame in frames:
            n += int(frame["n"].sum())
            total += int(frame["total"].sum())
        state.update((n, total))
        yield pd.DataFrame({key: [k[0]], "n": [n], "total": [total]})

    rows = stream.select(key, value).mapInArrow(combine, f"{key} BIGINT, n BIGINT, total BIGINT")
    return rows.groupBy(key).applyInPandasWithState(
        advance, f"{key} BIGINT, n BIGINT, total BIGINT", "n BIGINT, total BIGINT", "update", GroupStateTimeout.NoTimeout)


class _Visits:
    """Visits of the keys of a bucket: values seen since a key was last idle for ``gap`` milliseconds of event time.

    Map state holds the open visit of each key, with the count of each kind in it. Value state holds the time of the bucket's one
    event-time timer, at or before the first end of an open visit. When it fires, the visits whose end the watermark has passed
    leave the state, so idle keys take no room, and the timer moves to the next end.
    """

    def __init__(self, key: str, key_type: str, kind: str, time: str, gap: int):
        self.key, self.key_type, self.kind, self.time, self.gap = key, key_type, kind, time, gap

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", f"key {self.key_type}", "n BIGINT, first BIGINT, last BIGINT, kinds MAP<STRING, BIGINT>")
        self.timer = handle.getValueState("timer", "at BIGINT")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        held, size = [], 0
        for frame in rows:
            at = frame[self.time].astype("datetime64[ms]").astype("int64")
            held.append(pd.DataFrame({"key": frame[self.key], "kind": frame[self.kind], "first": at, "last": at, "n": 1}))
            size += len(frame)
            if size > 100_000:
                held = [self._joined(pd.concat(held))]
                size = len(held[0])
        found = self._joined(pd.concat(held))
        ended, first_end = [], None
        visit, names, kinds, counts = (found[c].tolist() for c in ("visit", "key", "kind", "n"))
        firsts, lasts = found["first"].tolist(), found["last"].tolist()
        start = 0
        while start < len(visit):
            stop = start
            while stop < len(visit) and visit[stop] == visit[start]:
                stop += 1
            name, first, last = (None if pd.isna(names[start]) else names[start],), firsts[start], lasts[start]
            old = self.open.getValue(name)
            if old is not None and first > old[2] + self.gap:
                ended.append((name[0], old))
                old = None
            n, old_first, old_last, seen = old if old is not None else (0, first, last, {})
            seen = dict(seen)
            for kind, count in zip(kinds[start:stop], counts[start:stop], strict=True):
                if not pd.isna(kind):
                    seen[kind] = seen.get(kind, 0) + count
            last = max(last, old_last)
            self.open.updateValue(name, (n + sum(counts[start:stop]), min(first, old_first), last, seen))
            first_end = last + self.gap if first_end is None else min(first_end, last + self.gap)
            start = stop
        # a visit that goes on leaves the timer early, which only costs a look at the open visits
        timer = self.timer.get()
        if timer is None or first_end < timer[0]:
            if timer is not None:
                self.handle.deleteTimer(timer[0])
            self.handle.registerTimer(first_end)
            self.timer.update((first_end,))
        yield from self._rows(ended)

    def _joined(self, parts: pd.DataFrame) -> pd.DataFrame:
        """Parts of visits (key, kind, first, last, n), in any order, joined to visits: a row per visit and kind with a number of the
        visit, by key and time."""
        code = pd.factorize(parts["key"], use_na_sentinel=False)[0]
        parts = parts.assign(code=code).sort_values(["code", "first"], kind="stable", ignore_index=True)
        until = parts.groupby("code")["last"].cummax()
        fresh = (parts["code"] != parts["code"].shift()) | (parts["first"] > until.shift() + self.gap)
        parts["visit"] = fresh.cumsum()
        whole = parts.groupby("visit").agg(key=("key", "first"), first=("first", "min"), last=("last", "max"))
        counts = parts.groupby(["visit", "kind"], dropna=False, as_index=False)["n"].sum()
        return counts.join(whole, on="visit")

    def _rows(self, ended: list) -> Iterator[pd.DataFrame]:
        for at in range(0, len(ended), 10_000):
            part = ended[at:at + 10_000]
            tops = [min(v[3].items(), key=lambda x: (-x[1], x[0]))[0] if v[3] else None for _, v in part]
            yield pd.DataFrame({self.key: pd.Series([k for k, _ in part], dtype=object), **{
                c: [v[i] for _, v in part] for i, c in enumerate(("n", "first", "last"))}, "kinds": [len(v[3]) for _, v in part],
                "top": pd.Series(tops, dtype=object)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        watermark, ended, first_end = timerValues.getCurrentWatermarkInMs(), [], None
        for name, visit in self.open.iterator():
            end = visit[2] + self.gap
            if end < watermark:
                ended.append((name[0], visit))
            else:
                first_end = end if first_end is None else min(first_end, end)
        for name, _ in ended:
            self.open.removeKey((name,))
        if first_end is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(first_end)
            self.timer.update((first_end,))
        yield from self._rows(ended)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        raise NotImplementedError

    def close(self) -> None:
        pass


def visits(stream: DataFrame, key: str, kind: str, time: str, gap_ms: int, buckets: int = 256) -> DataFrame:
    """One row per finished visit: key, rows, first and last time (milliseconds), different kinds, the most frequent kind.

    The stream needs a watermark on ``time``. Runs on the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    A visit ends when a row comes more than ``gap_ms`` after its last one, or the watermark has passed that by ``gap_ms``; the last ones stay
    open until later rows move the watermark. Rows of one batch may come in any order; rows that come a batch late by more than the gap,
    but within the watermark, join the open visit. Keys are dealt to ``buckets`` by a hash: the rows of a batch are joined to
    visits a bucket at a time, and only then is the state asked, once per visit.
    """
    from pyspark.sql.streaming import StatefulProcessor

    number = dict(stream.dtypes)[key]
    carried = number if number == "binary" else "string"
    processor = type("Visits", (_Visits, StatefulProcessor), {})(key, carried, kind, time, gap_ms)
    # keys travel as strings: a null would turn the whole numbers of its Arrow batch into floats in pandas
    rows = stream.select(F.col(key).cast(carried), kind, time, F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"))
    ended = rows.groupBy("bucket").transformWithStateInPandas(
        processor, f"{key} {carried}, n BIGINT, first BIGINT, last BIGINT, kinds BIGINT, top STRING", "append", "EventTime")
    return ended.withColumn(key, F.col(key).cast(number))
