"""Event files as a stream: source, closing heartbeat, and a sink that replaces a batch.

* ``event_stream`` reads the ``events`` files of a folder as they land, and heartbeats from a
  folder of their own.  A heartbeat only moves the watermark; its row is dropped behind it.
* ``Job`` runs a stream over what is there now (availableNow), batch by batch.  The sink writes
  every micro-batch to a folder named by its id and overwrites it when the batch is
  replayed after a failure, so nothing is doubled.  State lies in RocksDB on the executors'
  disks, with its checkpoints in the shared folder.
* ``Job.close`` sends a heartbeat beyond every event: open windows and buffered rows come
  out, and anything that arrives later is late.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import checkpoint_dir

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
#: Time of a heartbeat, and the end of all events' time.
BEAT = "9000-01-01 00:00:00"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_stream(spark: SparkSession, folder: str, beats: str, watermark: str, files_per_trigger: int = 16,
                 file_glob: str = "events*.parquet") -> DataFrame:
    """Events with ``ets``, their time as a timestamp with a watermark."""
    def files(path):
        return (spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
                .option("recursiveFileLookup", "true").parquet(path))
    both = files(f"{folder.rstrip('/')}/{file_glob}").unionByName(files(beats))
    marked = both.withColumn("ets", F.col("ts").cast("timestamp")).withWatermark("ets", watermark)
    # the condition reads ``ets``, so it stays behind the watermark, which thus sees the heartbeats
    return marked.where(F.col("ets").isNull() | (F.col("ets") < F.lit(BEAT).cast("timestamp")))


class Job:
    """One stream with its folders: ``build(beats)`` gives the streaming frame to write."""

    def __init__(self, spark: SparkSession, build: Callable[[str], DataFrame], base: str | None = None,
                 partition_by: tuple[str, ...] = ()):
        self.spark, self._build, self._partition_by = spark, build, partition_by
        self.base = base or f"{checkpoint_dir(spark).rstrip('/')}/kestrel-stream/{uuid.uuid4().hex}"
        self.out, self._beats, self._state = f"{self.base}/out", f"{self.base}/beats", f"{self.base}/state"
        self._beat([])

    def _beat(self, rows: list) -> None:
        self.spark.createDataFrame(rows, EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(self._beats)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(*self._partition_by).parquet(f"{self.out}/batch_id={batch_id}")

    def run(self) -> Job:
        """Process every file present now; a job that failed goes on from its checkpoint."""
        conf, key = self.spark.conf, "spark.sql.streaming.stateStore.providerClass"
        before = conf.get(key, None)
        conf.set(key, ROCKS_DB)
        try:
            query = (self._build(self._beats).writeStream.outputMode("append").foreachBatch(self.write)
                     .option("checkpointLocation", self._state).trigger(availableNow=True).start())
        finally:
            if before is None:
                conf.unset(key)
            else:
                conf.set(key, before)
        query.awaitTermination()
        return self

    def close(self) -> Job:
        import datetime as dt

        self._beat([(None, dt.datetime.fromisoformat(BEAT), None, None, None, None)])
        return self.run()

    def read(self, schema: str) -> DataFrame:
        """All rows written so far; ``schema`` names the columns, partition columns too."""
        return self.spark.read.schema(schema).option("basePath", self.out).parquet(f"{self.out}/batch_id=*")
