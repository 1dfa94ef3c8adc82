"""Load each new raw file once, with a file stream and its checkpoint."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from lendwatch.sources.raw_text import parse_rows, with_provenance
from lendwatch.sources.sinks import PARTITIONS


class _LineCount(StreamingQueryListener):
    """Lines of all batches; the query itself remembers only the last hundred."""

    def __init__(self) -> None:
        self.lines: dict[str, int] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.lines[run] = self.lines.get(run, 0) + event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def of(self, run: str) -> int:
        """Events arrive in order, the end last."""
        with self.changed:
            if not self.changed.wait_for(lambda: run in self.ended, timeout=300):
                raise TimeoutError(f"the end of stream {run} was not reported")
        return self.lines.get(run, 0)


def load_incremental(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    strict_iso: bool = True,
    max_files: int = 1000,
) -> int:
    """Append the rows of files not seen before; returns the number of lines read.

    Good and rejected rows go to one file sink, so each batch is parsed once and
    committed exactly once. A run that dies leaves its files unseen and the next
    run takes them again.
    """
    lines = with_provenance(
        spark.readStream.option("maxFilesPerTrigger", max_files).text(src)
    )
    count = _LineCount()
    spark.streams.addListener(count)
    try:
        query = (
            parse_rows(lines, strict_iso)
            .writeStream.format("parquet")
            .partitionBy(*PARTITIONS)
            .option("path", dst)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return count.of(str(query.runId))
    finally:
        spark.streams.removeListener(count)
