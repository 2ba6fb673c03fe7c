"""Streams with state of their own, bounded by event time: dedup that forgets, items gathered page by page."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import DEFAULTS, send_by_value

send_by_value(__name__)

# Lists and timers of a key are column families, which of Spark's state stores RocksDB alone has.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
GATHER_SETTINGS = {_PROVIDER: DEFAULTS[_PROVIDER]}
# No batch without rows after the last one, so that a stream started again for every batch keeps and forgets what one run would.
ROWS_ONLY = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}


def dedup_bounded(stream: DataFrame, keys: Sequence[str], event_time: str, horizon: str) -> DataFrame:
    """The first row per key; a key is forgotten once the watermark is ``horizon`` past its row, and may then return.

    The watermark follows the largest ``event_time`` of the batches before, less ``horizon``; rows older than it are late
    and left out. So the state holds the keys of some two horizons and not those of the whole stream. A key with very
    many copies is cut down to one row in every map task before the shuffle.
    """
    return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(list(keys))


class PageGatherer(StatefulProcessor):
    """Rows of a key in page order, handed out when ``cap`` are there, the last page was read, or nothing came for ``idle_ms``.

    State of a key: its rows so far (at most ``cap``), the last page read, whether it was handed out, and the time it is due. It is
    dropped when that time comes.
    """

    def __init__(self, schema: T.StructType, keys: list[str], page: str, order: list[str], event_time: str, cap: int, max_pages: int, idle_ms: int) -> None:
        self.schema, self.keys, self.page, self.order, self.event_time = schema, keys, page, order, event_time
        self.cap, self.max_pages, self.idle_ms = cap, max_pages, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.schema)
        self.progress = handle.getValueState("progress", "page int, held int, closed boolean, due long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        came = [row for row in rows if row[self.page] <= self.max_pages]
        if not came:
            return
        page, held, closed, due = self.progress.get() or (0, 0, False, -1)
        if not closed:
            fresh = sorted(came, key=self._place)[: self.cap - held]
            if fresh:
                self.rows.appendList([tuple(row[name] for name in self.schema.names) for row in fresh])
            held, page = held + len(fresh), max(page, *(row[self.page] for row in came))
        later = int(max(row[self.event_time] for row in came).timestamp() * 1000) + self.idle_ms
        if later > due:
            if due >= 0:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(later)
            due = later
        if not closed and (held >= self.cap or page >= self.max_pages):
            closed = True
            yield from self._handed_out()
            self.rows.clear()
        self.progress.update((page, held, closed, due))

    def _place(self, row: Row) -> list[tuple]:
        """Page order, then ``order``; NaN after numbers, NULL last."""
        return [(row[c] is None, row[c] != row[c], row[c]) for c in (self.page, *self.order)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        state = self.progress.get()
        if state is None or state[3] > expiredTimerInfo.getExpiryTimeInMs():
            return
        if not state[2]:
            yield from self._handed_out()
        self.rows.clear()
        self.progress.clear()

    def _handed_out(self) -> list[Row]:
        named = Row(*self.schema.names)
        return [named(*values) for values in self.rows.get()]

    def close(self) -> None:
        pass


def gather_pages(
    stream: DataFrame, keys: Sequence[str], page: str, order_by: Sequence[str], event_time: str, idle_hours: float,
    cap: int = 15, max_pages: int = 3, delay: str = "0 seconds",
) -> DataFrame:
    """As ``relate.accumulate_pages``, for a stream in which the pages of a key come one after the other.

    A key's rows are held until it is complete and then handed out together: at ``cap`` rows, after page ``max_pages``, or
    once the watermark is ``idle_hours`` past its last row. What comes for a complete key is left out until it is
    forgotten, at that same time. Rows of one page come in one batch. Start it with ``GATHER_SETTINGS``.
    """
    # rows of later pages keep the watermark going and nothing else: the condition names the event time, so that it is
    # applied above the watermark, and they never reach the state
    timed, schema = stream.withWatermark(event_time, delay), stream.schema
    timed = timed.where(F.when(F.col(page) <= max_pages, F.col(event_time).isNotNull()).otherwise(F.lit(False)))
    gatherer = PageGatherer(schema, list(keys), page, list(order_by), event_time, cap, max_pages, int(idle_hours * 3_600_000))
    return timed.groupBy(*keys).transformWithState(
        statefulProcessor=gatherer, outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )
