"""Running batches as streams: stop rules, sessions that hand in items, and state transitions, each in event-time order.

Rows of a key wait in state until the watermark has passed them and are then taken in order of time and a tie-breaking
number, so that the result depends on the rows alone, not on how they arrive; rows behind the watermark are dropped and
counted by Spark (``late_rows``). State is on RocksDB, spread over tasks by key.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

_PLAIN = {"long": int, "boolean": bool, "string": str}
#: The ways of a unit of work: what may follow a status.
_LEGAL = {"pending": ("running",), "running": ("done", "failed", "pending"), "failed": ("pending", "running"), "done": ()}


class InOrder(StatefulProcessor):
    """Rows (time, nr, more columns) of a key, handed to ``step`` in order once the watermark has passed them.

    ``deadline`` gives the time in milliseconds at which ``step`` must run even without rows, or None.
    """

    #: Types of the columns after time and nr.
    columns: dict[str, str] = {}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", ", ".join(["at long", "nr long", *[f"{k} {t}" for k, t in self.columns.items()]]))
        self.due = handle.getValueState("due", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            times = (pdf["time"].astype("datetime64[us]").astype("int64") // 1000).tolist()
            # A column with nulls in it reaches pandas as floats.
            more = [[None if pd.isna(v) else _PLAIN[t](v) for v in pdf[c]] for c, t in {"nr": "long", **self.columns}.items()]
            new = list(zip(times, *more, strict=True))
            if new:
                self.waiting.appendList(new)
                self._wake(min(t for t, *_ in new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs()
        held = sorted(self.waiting.get(), key=lambda r: (r[0], r[1] is None, r[1] or 0)) if self.waiting.exists() else []
        ready, rest = [r for r in held if r[0] <= upto], [r for r in held if r[0] > upto]
        self.waiting.clear()
        if rest:
            self.waiting.put(rest)
        self.due.clear()
        out = list(self.step(ready, upto))
        due = [t for t in (rest[0][0] if rest else None, self.deadline()) if t is not None]
        if due:
            self._wake(min(due))
        if out:
            yield pd.DataFrame([(*key, *r) for r in out], columns=self.names)

    def _wake(self, at: int) -> None:
        had = self.due.get()[0] if self.due.exists() else None
        if had is None or at < had:
            if had is not None:
                self.handle.deleteTimer(had)
            self.handle.registerTimer(at)
            self.due.update((at,))

    def step(self, rows: list[tuple], upto: int) -> Iterator[tuple]:
        raise NotImplementedError

    def deadline(self) -> int | None:
        return None

    def close(self) -> None:
        pass


def _time(ms: int | None):
    return None if ms is None else datetime.fromtimestamp(ms / 1000, timezone.utc)


class StopRules(InOrder):
    """The first breach of a cap stops a run: its cost, its clock from the first row on, or ``window`` failures in a row.

    A row is a finished piece of work: time, nr, started, cost, failed. Work that started before the stop still ends and
    counts; work that started after it is refused and counts for nothing. The stop itself is a row of its own.
    """

    columns = {"started": "long", "cost": "long", "failed": "boolean"}

    def __init__(self, names: list[str], budget: int, seconds: int, window: int) -> None:
        self.names, self.budget, self.millis, self.window = names, budget, seconds * 1000, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.run = handle.getValueState("run", "first long, cost long, stopped long, reason string")
        self.recent = handle.getListState("recent", "failed boolean")

    def deadline(self) -> int | None:
        first, _, stopped, _ = self.run.get() if self.run.exists() else (None, 0, None, None)
        return None if first is None or stopped is not None else first + self.millis

    def step(self, rows: list[tuple], upto: int) -> Iterator[tuple]:
        first, cost, stopped, reason = self.run.get() if self.run.exists() else (None, 0, None, None)
        recent = [r[0] for r in self.recent.get()] if self.recent.exists() else []
        for at, nr, started, price, failed in rows:
            first = at if first is None else first
            if stopped is None and at >= first + self.millis:
                stopped, reason = first + self.millis, "stop_wallclock"
                yield None, "stop", reason, cost, _time(stopped)
            if stopped is not None and (at if started is None else started) > stopped:
                yield nr, "refused", reason, cost, _time(at)
                continue
            cost += price or 0
            recent = [*recent, bool(failed)][-self.window :]
            yield nr, "run" if stopped is None else "in flight", reason, cost, _time(at)
            if stopped is None and (cost >= self.budget or len(recent) == self.window and all(recent)):
                stopped, reason = at, "stop_budget" if cost >= self.budget else "stop_failures"
                yield None, "stop", reason, cost, _time(at)
        if stopped is None and first is not None and first + self.millis <= upto:
            stopped, reason = first + self.millis, "stop_wallclock"
            yield None, "stop", reason, cost, _time(stopped)
        self.run.update((first, cost, stopped, reason))
        self.recent.put([(f,) for f in recent])


def stop_rules(stream: DataFrame, key: str, budget: int, seconds: int, window: int) -> DataFrame:
    """key, nr, verdict (run, in flight, refused, or stop with a null nr), reason, cost so far, at. ``stream`` has key, time (watermarked), nr, started (timestamp), cost, failed."""
    kind = stream.schema[key].dataType.simpleString()
    names = [key, "nr", "verdict", "reason", "cost", "at"]
    rows = stream.selectExpr(f"`{key}`", "time", "nr", "unix_millis(started) AS started", "cost", "failed")
    return _grouped(rows, key, StopRules(names, budget, seconds, window), f"`{key}` {kind}, nr long, verdict string, reason string, cost long, at timestamp")


class Sessions(InOrder):
    """Items handed in one by one, and an end.

    The document comes out with the first valid finalize event, or with the unfinished status once ``gap`` seconds went
    by without a row. Rows after the end do not count; they come out as late, one row each time the key is looked at.
    """

    columns = {"event": "string", "valid": "boolean", "status": "string"}

    def __init__(self, names: list[str], gap: int, unfinished: str) -> None:
        self.names, self.millis, self.unfinished = names, gap * 1000, unfinished

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.session = handle.getValueState("session", "items long, last long, ended boolean")

    def deadline(self) -> int | None:
        _, last, ended = self.session.get() if self.session.exists() else (0, None, False)
        return None if last is None or ended else last + self.millis

    def step(self, rows: list[tuple], upto: int) -> Iterator[tuple]:
        items, last, ended = self.session.get() if self.session.exists() else (0, None, False)
        late = 0
        for at, _, event, valid, status in rows:
            if not ended and last is not None and at >= last + self.millis:
                ended = True
                yield "document", items, self.unfinished
            if ended:
                late += 1
                continue
            last = at
            if valid and event == "finalize":
                ended = True
                yield "document", items, status
            elif valid and event == "item":
                items += 1
        if not ended and last is not None and last + self.millis <= upto:
            ended = True
            yield "document", items, self.unfinished
        if late:
            yield "late", late, None
        self.session.update((items, last, ended))


def sessions(stream: DataFrame, key: str, gap: int, unfinished: str = "failed") -> DataFrame:
    """key, kind (document or late), n (items, or rows after the end), status. ``stream`` has key, time (watermarked), nr, event (item or finalize), valid, status."""
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(key, "time", "nr", "event", "valid", "status")
    return _grouped(rows, key, Sessions([key, "kind", "n", "status"], gap, unfinished), f"`{key}` {kind}, kind string, n long, status string")


class Transitions(InOrder):
    """Status changes along legal ways; an illegal one changes nothing and comes out marked. State may start from a recovered table."""

    columns = {"status": "string"}

    def __init__(self, names: list[str], legal: dict[str, tuple[str, ...]], start: str) -> None:
        self.names, self.legal, self.start = names, legal, start

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.now = handle.getValueState("now", "status string")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for status in initialState["status"]:
            self.now.update((status,))

    def step(self, rows: list[tuple], upto: int) -> Iterator[tuple]:
        now = self.now.get()[0] if self.now.exists() else self.start
        for at, nr, status in rows:
            legal = status == now or status in self.legal.get(now, ())
            yield nr, now, status, legal, _time(at)
            now = status if legal else now
        self.now.update((now,))


def transitions(stream: DataFrame, key: str, recovered: DataFrame | None = None, legal: dict[str, tuple[str, ...]] | None = None, start: str = "pending") -> DataFrame:
    """key, nr, before, status, legal, at: all changes in order; those that are not legal are the side output. ``recovered`` has key and status, as ``journal.recover`` leaves them."""
    kind = stream.schema[key].dataType.simpleString()
    processor = Transitions([key, "nr", "before", "status", "legal", "at"], legal or _LEGAL, start)
    initial = None if recovered is None else recovered.select(key, "status").groupBy(key)
    return _grouped(stream.select(key, "time", "nr", "status"), key, processor, f"`{key}` {kind}, nr long, before string, status string, legal boolean, at timestamp", initial)


def _grouped(rows: DataFrame, key: str, processor: InOrder, schema: str, initial=None) -> DataFrame:
    return rows.groupBy(key).transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime", initialState=initial)


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query has dropped as late, from its progress."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
