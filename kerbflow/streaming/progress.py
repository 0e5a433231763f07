"""Progress of streaming queries: reports are kept as text in a shared folder and read as metric samples."""

from __future__ import annotations

import json
import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

REPORT = (T.StructType().add("name", "string").add("timestamp", "timestamp").add("batchId", "long").add("numInputRows", "long")
          .add("batchDuration", "long").add("eventTime", T.StructType().add("max", "timestamp").add("watermark", "timestamp"))
          .add("stateOperators", T.ArrayType(T.StructType().add("numRowsDroppedByWatermark", "long"))).add("idle", "boolean")
          .add("sources", T.ArrayType(T.StructType().add("metrics", T.MapType(T.StringType(), T.StringType())))))
#: Set by sources that know how far behind they are.
BEHIND = "maxOffsetsBehindLatest"


class ProgressLog(StreamingQueryListener):
    """Writes each report as it comes, one small file per micro-batch; nothing is held in memory."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        super().__init__()
        self._context, self._folder = spark.sparkContext, folder.rstrip("/")
        self._written: dict[str, int] = {}
        self._names: dict[str, str | None] = {}
        self._more = threading.Condition()

    def _write(self, report: str) -> None:
        path = self._context._jvm.org.apache.hadoop.fs.Path(f"{self._folder}/{uuid.uuid4().hex}.json")
        out = path.getFileSystem(self._context._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(report.replace("\n", " "), "utf-8"))
        out.close()

    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        report = event.progress
        self._write(report.json)
        with self._more:
            self._written[str(report.runId)] = max(report.batchId, self._written.get(str(report.runId), -1))
            self._more.notify_all()

    def onQueryIdle(self, event) -> None:
        """A query that waits for data is alive: its report says when, and nothing else."""
        self._write(json.dumps({"name": self._names.get(str(event.runId)), "timestamp": event.timestamp, "idle": True}))

    def onQueryTerminated(self, event) -> None:
        pass

    def wait_for(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the last report of a query is written; listeners are called a little after the batch."""
        last, until = query.lastProgress, time.monotonic() + seconds
        with self._more:
            while last is not None and self._written.get(str(query.runId), -1) < last.batchId:
                if not self._more.wait(until - time.monotonic()):
                    raise TimeoutError(f"no report of batch {last.batchId} of {query.name} within {seconds} s")


def read_samples(spark: SparkSession, folder: str) -> DataFrame:
    """(metric, series, ts, value) of all reports in a folder: one row per report and number that it holds."""
    reports = spark.read.schema(REPORT).option("multiLine", True).json(folder)
    seconds = lambda c: F.unix_micros(c) / F.lit(1e6)
    numbers = {
        "input_rows": F.col("numInputRows").cast("double"),
        "batch_duration_seconds": F.col("batchDuration") / F.lit(1000.0),
        "last_progress_timestamp": seconds(F.col("timestamp")),
        "max_event_timestamp": seconds(F.col("eventTime.max")),
        "watermark_timestamp": seconds(F.col("eventTime.watermark")),
        "idle": F.when(F.col("idle"), F.lit(1.0)),
        # Counted by the operators that drop them, before or after rows are summed up; the deduplication counts single rows.
        "late_rows": F.aggregate("stateOperators", F.lit(0.0), lambda n, o: n + F.coalesce(o.numRowsDroppedByWatermark.cast("double"), F.lit(0.0))),
        "offsets_behind": F.array_max(F.transform("sources", lambda s: s.metrics[BEHIND].cast("double"))),
    }
    rows = F.explode(F.array(*(F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in numbers.items())))
    return reports.select(F.col("name").alias("series"), F.col("timestamp").alias("ts"), rows.alias("n")).where("n.value is not null").select(
        "n.metric", "series", "ts", "n.value")
