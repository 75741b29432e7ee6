"""Keyed state by time, in parts that can be read without the rest.

Both kinds keep their rows in a map state. What waits lies under the second that releases it, so a timer
reads its own rows and no others; what is on record lies under its hour, so a lookup reads the hour it asks
for. Timers of a key come in the order of time.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql.streaming import StatefulProcessorHandle

SECOND_US = 1_000_000
HOUR_US = 3_600 * SECOND_US
DAY_HOURS = 24


def _rows(fields: str) -> str:
    inside = ", ".join(": ".join(f.split(" ")) for f in fields.split(", "))
    return f"rows array<struct<{inside}>>"


class SecondQueue:
    """Rows (``at_us`` first) that wait until the watermark has passed them."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, fields: str):
        self.handle = handle
        self.rows = handle.getMapState(name, "second bigint", _rows(fields))

    def add(self, rows: list[tuple]) -> None:
        """A row that is itself behind the watermark is released at once, ahead of what is younger."""
        parts: dict[int, list[tuple]] = {}
        for row in rows:
            parts.setdefault(row[0] // SECOND_US + 1, []).append(row)
        for second, own in parts.items():
            held = self.rows.getValue((second,))
            if held is None:
                self.handle.registerTimer(second * 1_000)
            else:
                own = [*map(tuple, held[0]), *own]
            self.rows.updateValue((second,), (own,))

    def release(self, expiry_ms: int) -> list[tuple]:
        """The rows whose timer this is; they leave the state."""
        second = (expiry_ms // 1_000,)
        held = self.rows.getValue(second)
        if held is None:
            return []
        self.rows.removeKey(second)
        return [tuple(r) for r in held[0]]


class TimedRecord:
    """Entries (``at_us`` first) of a key by hour, the greatest of each instant.

    An index has one number per day with entries: the day and a bit for each of its hours. With
    ``keep_seconds`` an hour is forgotten so long after its end, by the watermark.
    """

    def __init__(self, handle: StatefulProcessorHandle, name: str, fields: str, keep_seconds: int | None = None):
        self.handle, self.keep_seconds = handle, keep_seconds
        self.hours = handle.getMapState(name, "hour bigint", _rows(fields))
        self.index = handle.getValueState(f"{name}_days", "days array<bigint>")

    def _days(self) -> dict[int, int]:
        return {d >> DAY_HOURS: d & (1 << DAY_HOURS) - 1 for d in (self.index.get()[0] if self.index.exists() else ())}

    def _store(self, days: dict[int, int]) -> None:
        if days:
            self.index.update(([day << DAY_HOURS | bits for day, bits in sorted(days.items())],))
        else:
            self.index.clear()

    def _read(self, hour: int) -> list[tuple]:
        held = self.hours.getValue((hour,))
        return [] if held is None else [tuple(r) for r in held[0]]

    @staticmethod
    def _order(entry: tuple) -> tuple:
        return tuple((x is not None, x) if x is not None else (False, 0) for x in entry)

    def add(self, entries: list[tuple]) -> None:
        parts: dict[int, list[tuple]] = {}
        for entry in entries:
            parts.setdefault(entry[0] // HOUR_US, []).append(entry)
        days = self._days()
        grown = False
        for hour, own in parts.items():
            bit = 1 << hour % DAY_HOURS
            if days.get(hour // DAY_HOURS, 0) & bit:
                own = [*self._read(hour), *own]
            else:
                days[hour // DAY_HOURS] = days.get(hour // DAY_HOURS, 0) | bit
                grown = True
                if self.keep_seconds is not None:
                    self.handle.registerTimer((hour + 1) * HOUR_US // 1_000 + self.keep_seconds * 1_000)
            last = {e[0]: e for e in sorted(own, key=self._order)}
            self.hours.updateValue((hour,), ([last[at] for at in sorted(last)],))
        if grown:
            self._store(days)

    def as_of(self, times: list[int]) -> list[tuple | None]:
        """For each time the newest entry not younger than it; reads the hours that takes, each once."""
        days = self._days()
        hours = [d * DAY_HOURS + h for d in sorted(days) for h in range(DAY_HOURS) if days[d] >> h & 1] if days else []
        read: dict[int, list[tuple]] = {}
        found: list[tuple | None] = []
        for at in times:
            place, entry = bisect_right(hours, at // HOUR_US), None
            while place and entry is None:  # at most two hours: all of an earlier one is old enough
                place -= 1
                if hours[place] not in read:
                    read[hours[place]] = self._read(hours[place])
                own = read[hours[place]]
                upto = bisect_right(own, at, key=lambda e: e[0])
                entry = own[upto - 1] if upto else None
            found.append(entry)
        return found

    def expire(self, watermark_ms: int) -> None:
        """Forget the hours whose time is up."""
        if self.keep_seconds is None:
            return
        days = self._days()
        gone = [
            d * DAY_HOURS + h
            for d in days
            for h in range(DAY_HOURS)
            if days[d] >> h & 1 and (d * DAY_HOURS + h + 1) * HOUR_US // 1_000 + self.keep_seconds * 1_000 <= watermark_ms
        ]
        for hour in gone:
            self.hours.removeKey((hour,))
            days[hour // DAY_HOURS] &= ~(1 << hour % DAY_HOURS)
        if gone:
            self._store({d: bits for d, bits in days.items() if bits})
