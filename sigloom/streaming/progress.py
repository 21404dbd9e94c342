"""Progress of streams and batches, by Spark's own listeners."""

from __future__ import annotations

import math
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


class Progress(StreamingQueryListener):
    """Rows processed of a known or unknown total, told to ``report(done, percent)``; percent is None without a total."""

    def __init__(self, report: Callable[[int, float | None], None], total: int | None = None):
        self.report, self.total, self.done = report, total, 0
        self._lock = threading.Lock()

    def add(self, rows: int) -> None:
        with self._lock:
            self.done += rows
            percent = None if self.total is None else 100.0 if not self.total else min(100.0, math.floor(self.done * 10000 / self.total) / 100)
            self.report(self.done, percent)

    def discovered(self, rows: int) -> None:
        with self._lock:
            self.total = (self.total or 0) + rows

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.add(event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` with a count that is known once an action has run: no second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
