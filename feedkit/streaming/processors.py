"""Keyed state for feeds that never end.

Each processor keeps keys, numbers and bitmaps, never payload. Rows of a micro-batch are put in
arrival order first. Every key has one event-time timer; when it fires, what is unfinished comes out
as `expired` and the state is gone.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Executors get the classes with the query, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A file's bitmap has one bit per piece. A file that claims more pieces comes out as `refused`; the
# batch operators, which count instead, take it.
MAX_PIECES = 1 << 27


def _millis(moment) -> int:
    return int(moment.timestamp() * 1000)


def _bit(bitmap: bytearray, i: int) -> bool:
    """Set bit i; true where it was set before."""
    byte, mask = divmod(i, 8)
    was = bool(bitmap[byte] & (1 << mask))
    bitmap[byte] |= 1 << mask
    return was


class Expiring(StatefulProcessor):
    """A processor whose keys end when the watermark is `ttl_ms` past the last row that they saw."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def prolong(self, old: int | None, latest_ms: int) -> int:
        """Move the key's timer; returns the new deadline."""
        deadline = max(latest_ms + self.ttl_ms, old or 0)
        if old is not None and old != deadline:
            self.handle.deleteTimer(old)
        if old != deadline:
            self.handle.registerTimer(deadline)
        return deadline

    def close(self) -> None:
        pass


class FragmentTracker(Expiring):
    """Per output path: the current attempt and which of its pieces arrived."""

    OUTPUT = "path string, filename string, identifier string, event string, seen bigint, cnt bigint"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "attempt", "identifier string, cnt bigint, seen bigint, bitmap binary, deadline bigint"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        ident, cnt, seen, bitmap, deadline = self.state.get() or (None, 0, 0, b"", None)
        bitmap, latest = bytearray(bitmap), 0
        for row in sorted(rows, key=lambda r: r["arrival"]):
            latest = max(latest, _millis(row["arrived_at"]))
            if row["cnt"] <= 1 or not 1 <= row["idx"] <= row["cnt"]:
                continue
            if row["identifier"] != ident:
                ident, cnt, seen = row["identifier"], row["cnt"], 0
                bitmap = bytearray((cnt + 7) // 8 if cnt <= MAX_PIECES else 0)
                if cnt > MAX_PIECES:
                    yield Row(path=key[0], filename=key[1], identifier=ident, event="refused", seen=0, cnt=cnt)
            if cnt > MAX_PIECES:
                continue
            if row["idx"] > cnt or seen == cnt or _bit(bitmap, row["idx"] - 1):
                continue
            seen += 1
            if seen == cnt:
                yield Row(path=key[0], filename=key[1], identifier=ident, event="completed", seen=seen, cnt=cnt)
        if ident is not None:
            self.state.update((ident, cnt, seen, bytes(bitmap), self.prolong(deadline, latest)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.state.exists():
            return
        ident, cnt, seen, _, _ = self.state.get()
        self.state.clear()
        if seen < cnt <= MAX_PIECES:
            yield Row(path=key[0], filename=key[1], identifier=ident, event="expired", seen=seen, cnt=cnt)


class FrameTracker(Expiring):
    """Per port (or per file): the file in flight and which of its slots are filled."""

    OUTPUT = "port int, uuid string, event string, total bigint, seen bigint"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "flight", "port int, uuid string, total bigint, seen bigint, bitmap binary, deadline bigint"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        port, uuid, total, seen, bitmap, deadline = self.state.get() or (None, None, 0, 0, b"", None)
        bitmap, latest = bytearray(bitmap), 0
        for row in sorted(rows, key=lambda r: r["arrival"]):
            latest = max(latest, _millis(row["arrived_at"]))
            if row["uuid"] != uuid:
                if uuid is not None and seen < total <= MAX_PIECES:
                    yield Row(port=port, uuid=uuid, event="abandoned", total=total, seen=seen)
                port, uuid, total, seen = row["port"], row["uuid"], row["total"], 0
                bitmap = bytearray((total + 7) // 8 if total <= MAX_PIECES else 0)
                if total > MAX_PIECES:
                    yield Row(port=port, uuid=uuid, event="refused", total=total, seen=0)
            if total > MAX_PIECES:
                continue
            if not row["carries"] or seen == total or row["slot"] >= total or _bit(bitmap, row["slot"]):
                continue
            seen += 1
            if seen == total:
                yield Row(port=row["port"], uuid=uuid, event="completed", total=total, seen=seen)
        self.state.update((port, uuid, total, seen, bytes(bitmap), self.prolong(deadline, latest)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.state.exists():
            return
        port, uuid, total, seen, _, _ = self.state.get()
        self.state.clear()
        if seen < total <= MAX_PIECES:
            yield Row(port=port, uuid=uuid, event="expired", total=total, seen=seen)


class SequenceTracker(Expiring):
    """Per session: the next number to release, and the packets that wait behind it."""

    OUTPUT = "socket_id string, n bigint, event string, used string, waiting bigint"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("session", "next bigint, closed boolean, deadline bigint")
        self.waiting = handle.getMapState("waiting", "n bigint", "used string, eof boolean")

    def _take(self, early: dict, n: int):
        """The waiting copy of packet n, if there is one, newest first."""
        if n in early:
            found = early.pop(n)
            self.waiting.removeKey((n,))
            return found
        if self.waiting.containsKey((n,)):
            found = tuple(self.waiting.getValue((n,)))
            self.waiting.removeKey((n,))
            return found
        return None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        nxt, closed, deadline = self.state.get() or (1, False, None)
        early: dict[int, tuple[str, bool]] = {}
        latest = 0
        for row in sorted(rows, key=lambda r: r["arrival"]):
            latest = max(latest, _millis(row["arrived_at"]))
            copy = (row["used"], row["op"] == "EOF")
            if closed or row["n"] < nxt:
                continue
            if row["n"] > nxt:
                early[row["n"]] = copy
                continue
            while copy is not None:
                yield Row(socket_id=key[0], n=nxt, event="released", used=copy[0], waiting=0)
                nxt += 1
                closed = copy[1]
                copy = None if closed else self._take(early, nxt)
        if closed:
            self.waiting.clear()
        else:
            for n, copy in early.items():
                self.waiting.updateValue((n,), copy)
        self.state.update((nxt, closed, self.prolong(deadline, latest)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.state.exists():
            return
        nxt, closed, _ = self.state.get()
        left = 0 if closed else sum(1 for _ in self.waiting.keys())
        self.state.clear()
        self.waiting.clear()
        if not closed:
            yield Row(socket_id=key[0], n=nxt, event="expired", used=None, waiting=left)


class FirstSeenTracker(Expiring):
    """Per content key: the path that had the content first."""

    OUTPUT = "seq bigint, filepath string, first_path string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("first", "filepath string, deadline bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first, deadline = self.state.get() or (None, None)
        latest = 0
        # Order matters only until a first path is known; after that rows pass straight through.
        for row in rows if first is not None else sorted(rows, key=lambda r: r["seq"]):
            latest = max(latest, _millis(row["arrived_at"]))
            yield Row(seq=row["seq"], filepath=row["filepath"], first_path=first)
            first = first if first is not None else row["filepath"]
        self.state.update((first, self.prolong(deadline, latest)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        yield from ()
