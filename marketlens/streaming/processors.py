"""Per-key state rules for streams, as stateful processors.

State per key is one small value (or one entry per distinct value seen), so it stays small however many
rows a key has. Rows of a micro-batch count in the order of their time. Most rules go through them once and hold
no more than one row per day; those that must sort them (:class:`DedupLatest`, :class:`RunningProfile`, and
:class:`FixIsNew` for a device not seen before) hold the rows of one key and micro-batch, whose number the
trigger limits of the source bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

DAY_MS = 86_400_000


def _date(ms: int, zone: str) -> str:
    return datetime.fromtimestamp(ms // 1000, ZoneInfo(zone)).strftime("%Y-%m-%d")


def _day_start(date: str, zone: str) -> int:
    return int(datetime.strptime(date, "%Y-%m-%d").replace(tzinfo=ZoneInfo(zone)).timestamp() * 1000)


def _rank(row, order: list[str]) -> tuple:
    """Place of a row in the order; nulls first."""
    return tuple((row[c] is not None, row[c]) for c in order)


def _in_order(rows: Iterator[Row], order: list[str]) -> list[Row]:
    return sorted(rows, key=lambda r: _rank(r, order))


def _negated(amount: str | None) -> str | None:
    """An amount with its sign turned and four decimals, as in batches; null where it is no number."""
    try:
        return None if amount is None else f"{-Decimal(amount).quantize(Decimal('0.0001'), ROUND_HALF_UP) + 0:f}"
    except InvalidOperation:
        return None


class Expiring(StatefulProcessor):
    """Base: state of a key is cleared once the watermark is ``keep_ms`` past the time it was last renewed for.

    Timers are in event time, so a replay expires the same state. Without ``keep_ms`` the state stays.
    """

    keep_ms: int | None = None

    def renew(self, ms: int) -> None:
        """Put off the expiry to ``keep_ms`` after the given event time."""
        if self.keep_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(ms + self.keep_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Forget the key."""
        self.forget()
        return iter(())

    def close(self) -> None:
        """Nothing to release."""


class OneValue(Expiring):
    """Base: one value state of one field."""

    kind = "v STRING"

    def __init__(self, order: list[str], keep_ms: int | None = None, zone: str = "UTC"):
        self.order, self.keep_ms, self.zone = order, keep_ms, zone

    def init(self, handle: StatefulProcessorHandle) -> None:
        """Open the state."""
        self.handle = handle
        self.state = handle.getValueState("last", self.kind)

    def forget(self) -> None:
        """Clear the state."""
        self.state.clear()

    def last(self):
        """The stored value or None."""
        return self.state.get()[0] if self.state.exists() else None


def _first_per_day(rows: Iterator[Row], order: list[str], zone: str) -> Iterator[tuple[str, Row, bool]]:
    """Day, row, and whether it is the first of its day; firsts come last, in the order of days.

    Only the best row of each day is held back.
    """
    rank = lambda r: _rank(r, order)
    best: dict[str, Row] = {}
    for r in rows:
        day = _date(r["ts_ms"], zone)
        if day not in best:
            best[day] = r
        elif rank(r) < rank(best[day]):
            yield day, best[day], False
            best[day] = r
        else:
            yield day, r, False
    for day in sorted(best):
        yield day, best[day], True


class FirstOfDay(OneValue):
    """Adds ``is_first`` = 1 to the first row per key and day; with ``only`` just those rows are emitted.

    The state serves its day alone and goes ``keep_ms`` after the day's end.
    """

    def __init__(self, order: list[str], only: bool = False, keep_ms: int | None = 0, zone: str = "UTC"):
        super().__init__(order, keep_ms, zone)
        self.only = only

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        """Compare the first row of each day with the stored day."""
        last = before = self.last()
        for day, r, candidate in _first_per_day(rows, self.order, self.zone):
            first = candidate and day != last
            if candidate:
                last = day
            if first or not self.only:
                yield Row(**r.asDict(), is_first=int(first))
        if last != before:
            self.state.update((last,))
            self.renew(_day_start(last, self.zone) + DAY_MS)


class FixIsNew(OneValue):
    """Corrects ``is_new`` against the stored first day of the device."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        """Store the first day once, then compare."""
        first = self.last()
        if first is None:
            rows = _in_order(rows, self.order)
            first = _date(rows[0]["ts_ms"] - (0 if rows[0]["is_new"] == "1" else DAY_MS), self.zone)
            self.state.update((first,))
        latest = 0
        for r in rows:
            values, latest = r.asDict(), max(latest, r["ts_ms"])
            if r["is_new"] == "1" and first != _date(r["ts_ms"], self.zone):
                values["is_new"] = "0"
            yield Row(**values)
        self.renew(latest)


class LoginBack(OneValue):
    """Emits the first login per user and day with ``uu_ct`` and ``back_ct``."""

    def __init__(self, order: list[str], back_days: int = 8, keep_ms: int | None = None, zone: str = "UTC"):
        super().__init__(order, keep_ms, zone)
        self.back_days = back_days

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        """Compare the first login of each day with the last login day."""
        last = before = self.last()
        for day, r, candidate in _first_per_day(rows, self.order, self.zone):
            if candidate and day != last:
                gap = 0 if last is None else (r["ts_ms"] - _day_start(last, self.zone)) // DAY_MS
                yield Row(**r.asDict(), uu_ct=1, back_ct=int(gap >= self.back_days))
                last = day
        if last != before:
            self.state.update((last,))
            self.renew(_day_start(last, self.zone) + DAY_MS)


class DedupLatest(OneValue):
    """Lets a row pass when its ``ts_ms`` is newer than that of all rows of its key before it."""

    kind = "v BIGINT"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        """Compare each time with the highest one so far."""
        top = before = self.last()
        for r in _in_order(rows, self.order):
            if top is None or r["ts_ms"] > top:
                top = r["ts_ms"]
                yield r
        if top != before:
            self.state.update((top,))
            self.renew(top)


class RetractPrevious(Expiring):
    """Emits each version of a row, and the negative of every version that a newer one replaces."""

    def __init__(self, schema: StructType, order: list[str], amount: str, keep_ms: int | None = None):
        self.schema, self.order, self.amount, self.keep_ms = schema, order, amount, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        """Open the state."""
        self.handle = handle
        self.state = handle.getValueState("last", self.schema)

    def forget(self) -> None:
        """Clear the state."""
        self.state.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        """Take back the stored version and every new one but the newest; only that one is held."""
        names = self.schema.fieldNames()
        rank = lambda r: _rank(r, self.order)
        if self.state.exists():
            yield self._negative(dict(zip(names, self.state.get())))
        newest = None
        for r in rows:
            yield r
            if newest is None or rank(r) >= rank(newest):
                old, newest = newest, r
            else:
                old = r
            if old is not None:
                yield self._negative(old.asDict())
        self.state.update(tuple(newest[n] for n in names))
        self.renew(newest["ts_ms"])

    def _negative(self, values: dict) -> Row:
        return Row(**{**values, self.amount: _negated(values[self.amount])})


class DebounceLast(StatefulProcessor):
    """Holds the newest version of a row and emits it once, ``delay_ms`` after its first one came."""

    def __init__(self, schema: StructType, order: list[str], delay_ms: int = 5000, processing_time: bool = False):
        self.schema, self.order, self.delay_ms, self.processing_time = schema, order, delay_ms, processing_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        """Open the state."""
        self.handle = handle
        self.state = handle.getValueState("last", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        """Keep the newest version and start the timer with the first."""
        names = self.schema.fieldNames()
        last = dict(zip(names, self.state.get())) if self.state.exists() else None
        if last is None:
            now = (timerValues.getCurrentProcessingTimeInMs() if self.processing_time
                   else timerValues.getCurrentWatermarkInMs())
            self.handle.registerTimer(now + self.delay_ms)
        rank = lambda d: _rank(d, self.order)
        for r in rows:
            if last is None or rank(r) >= rank(last):
                last = r.asDict()
        self.state.update(tuple(last[n] for n in names))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Emit what is held and forget it."""
        if self.state.exists():
            yield Row(**dict(zip(self.schema.fieldNames(), self.state.get())))
            self.state.clear()

    def close(self) -> None:
        """Nothing to release."""


class RunningProfile(Expiring):
    """Emits per row the page views and distinct values of the user so far."""

    def __init__(self, order: list[str], sets: list[str], keep_ms: int | None = None):
        self.order, self.sets, self.keep_ms = order, sets, keep_ms

    def forget(self) -> None:
        """Clear the states."""
        self.views.clear()
        self.seen.clear()

    def init(self, handle: StatefulProcessorHandle) -> None:
        """Open the states."""
        self.handle = handle
        self.views = handle.getValueState("views", "v BIGINT")
        self.seen = handle.getMapState("seen", "f STRING, v STRING", "n INT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        """Count on from the stored number and add new values to the sets."""
        views = self.views.get()[0] if self.views.exists() else 0
        values: dict[str, set[str]] = {s: set() for s in self.sets}
        for f, v in self.seen.keys():
            values[f].add(v)
        latest = 0
        for r in _in_order(rows, self.order):
            views += 1
            latest = max(latest, r["ts_ms"])
            for s in self.sets:
                if r[s] is not None and r[s] not in values[s]:
                    values[s].add(r[s])
                    self.seen.updateValue((s, r[s]), (1,))
            lists = {s: ",".join(sorted(values[s])) for s in self.sets}
            yield Row(uid=r["uid"], ts_ms=r["ts_ms"], row_id=r["row_id"], pv=views, **lists)
        self.views.update((views,))
        self.renew(latest)


def keyed_rule(df: DataFrame, key: str, rule: StatefulProcessor, schema: StructType | str,
               event_time: str | None = None, time_mode: str | None = None) -> DataFrame:
    """Apply a processor per key; with ``event_time`` the result can go on into windows.

    Rules whose state expires need a watermark on ``df``.
    """
    timed = event_time or getattr(rule, "keep_ms", None) is not None
    mode = time_mode or ("EventTime" if timed else "None")
    return df.groupBy(key).transformWithState(
        statefulProcessor=rule, outputStructType=schema, outputMode="Append", timeMode=mode,
        eventTimeColumnName=event_time or "")
