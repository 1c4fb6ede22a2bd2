"""What a stream has done, batch by batch; stopping it drained; taking back its last commit.

Counts come from ``observe``: they are summed inside the batch's own job and arrive with its progress
event, so watching a stream reads nothing twice and writes nothing.
"""

from __future__ import annotations

import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

OBSERVED = "messages"
#: Batches of which the single counts are kept; totals are kept of all.
RECENT = 1000


def observed(df: DataFrame, status: str = "status") -> DataFrame:
    """``df`` with its scored and quarantined messages counted as the batch runs."""
    of = lambda name: F.count_if(F.col(status) == name).alias(name)
    return df.observe(OBSERVED, F.count(F.lit(1)).alias("output"), of("scored"), of("quarantine"))


class BatchCounts(StreamingQueryListener):
    """Gathers the counts of one query's batches; ``spark.streams.addListener`` it before the start."""

    def __init__(self, name: str):
        self.name, self.ids, self.ended = name, set(), threading.Event()
        self.batches: deque[tuple] = deque(maxlen=RECENT)
        self.totals = {"batches": 0, "input": 0, "output": 0, "scored": 0, "quarantine": 0}

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.ids.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if str(p.runId) not in self.ids:
            return
        seen = p.observedMetrics.get(OBSERVED)
        counts = {"input": p.numInputRows, **({k: seen[k] for k in ("output", "scored", "quarantine")} if seen else {})}
        if seen or p.numInputRows:
            self.batches.append((p.batchId, *(counts.get(k, 0) for k in ("input", "output", "scored", "quarantine"))))
            for k, v in {"batches": 1, **counts}.items():
                self.totals[k] += v

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.ids:
            self.ended.set()

    def frame(self, spark: SparkSession) -> DataFrame:
        """``batch_id, input, output, scored, quarantine`` of the last batches."""
        return spark.createDataFrame(list(self.batches), "batch_id long, input long, output long, scored long, quarantine long")

    def totals_frame(self, spark: SparkSession) -> DataFrame:
        """``kind, messages``: the sums over all batches."""
        return spark.createDataFrame([(k, v) for k, v in self.totals.items() if k != "batches"], "kind string, messages long")


def stop_drained(query: StreamingQuery, counts: BatchCounts | None = None, timeout_s: float = 60) -> None:
    """Let the query work off what its source has now, then stop it; with ``counts``, wait until its last event has come."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    if counts and not counts.ended.wait(timeout_s):
        raise TimeoutError("the query's last event hasn't come")


def forget_last_commit(spark: SparkSession, checkpoint: str) -> int:
    """Remove the checkpoint's last commit, as if the driver had died before it; the next start runs that batch again. Returns its number."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/commits")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    last = max(int(f.getPath().getName()) for f in files.listStatus(folder) if f.getPath().getName().isdigit())
    files.delete(jvm.org.apache.hadoop.fs.Path(folder, str(last)), False)
    files.delete(jvm.org.apache.hadoop.fs.Path(folder, f".{last}.crc"), False)
    return last
