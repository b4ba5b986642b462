"""Rows of a stream's micro-batches, as observed while they were written."""

from __future__ import annotations

import uuid
from threading import Condition

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class BatchRows(StreamingQueryListener):
    """Adds up the metric ``rows`` observed under ``name`` over all micro-batches.

    A query itself keeps only its last hundred progress reports. A listener is told all,
    in order, and that the query has ended after them.
    """

    #: Seconds that the last reports may take after the query has ended.
    PATIENCE = 120

    def __init__(self, spark: SparkSession):
        self._spark, self.name = spark, f"rows-{uuid.uuid4().hex}"
        self._rows: dict[tuple[str, int], int] = {}
        self._ended: set[str] = set()
        self._news = Condition()

    def __enter__(self) -> BatchRows:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *failure) -> None:
        self._spark.streams.removeListener(self)

    def of(self, query: StreamingQuery) -> int:
        run = str(query.runId)
        with self._news:
            if not self._news.wait_for(lambda: run in self._ended, self.PATIENCE):
                raise TimeoutError("the stream has written its rows, but Spark has not reported how many")
            return sum(rows for (of, _), rows in self._rows.items() if of == run)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(self.name)
        if found is not None and found.rows is not None:
            with self._news:
                # An idle report repeats the batch before it.
                self._rows[str(progress.runId), progress.batchId] = found.rows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()
