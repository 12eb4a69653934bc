"""Progress of streams as a table: one row per progress event, late rows that were dropped among it."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# Fixed value: the columns of a progress row.
PROGRESS = "query_id string, run_id string, batch_id long, at timestamp, input_rows long, watermark string, late_rows_dropped long"


class ProgressTable(StreamingQueryListener):
    """Writes each progress event as a file of its own, named by run and batch: a repeated event writes the same file.

    The file is written with the file system alone, so that the listener's
    thread starts no job beside the stream. An event has a few hundred bytes;
    ``progress`` reads them all.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {
            "query_id": str(p.id), "run_id": str(p.runId), "batch_id": p.batchId, "at": p.timestamp, "input_rows": p.numInputRows,
            "watermark": dict(p.eventTime or {}).get("watermark"),
            "late_rows_dropped": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
        }
        file = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p.runId}-{p.batchId:012d}.json")
        stream = file.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(file, True)
        stream.write(bytearray(json.dumps(row).encode()))
        stream.close()

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all events of a query that has ended are written; they come in order, its end last."""
        with self.changed:
            if not self.changed.wait_for(lambda: str(query.runId) in self.ended, seconds):
                raise TimeoutError(f"no end of run {query.runId}")


def progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).json(path)


def late_drops(spark: SparkSession, path: str) -> DataFrame:
    """Rows per query that arrived after the watermark had passed their time, and all rows that arrived."""
    return progress(spark, path).groupBy("query_id").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("late_rows_dropped").alias("late_rows_dropped")
    )
