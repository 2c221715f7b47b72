"""The stored log of batch runs: claims that only one run can win, finished steps, outcomes.

Every attempt at a batch has a folder of its own, in which it alone appends its events. Nothing is ever
overwritten, so all attempts stay visible. Who may begin an attempt is decided by the file system: the claim is
a file that must not exist yet. (HDFS and local disks create files exclusively; an object store must
be reached through a connector that does.)
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cairnlake.operators.merge import stored

IN_PROGRESS, COMPLETED, FAILED = "in-progress", "completed", "failed"
EVENTS = (
    T.StructType().add("step", "string").add("status", "string").add("at", "timestamp").add("error_message", "string")
    .add("counts", T.MapType(T.StringType(), T.LongType())).add("batch_id", "string").add("attempt", "integer")
)


class NotInProgress(Exception):
    """An attempt that has ended, or never began, cannot change."""


@dataclass(frozen=True)
class BatchLog:
    """The log in folder ``path``, which all drivers that may run batches share."""

    spark: SparkSession
    path: str

    def _file(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _create(self, path: str) -> bool:
        """Whether this call, and no other, has created the file."""
        files, place = self._file(path)
        if files.getUri().getScheme() == "file":
            # Spark's client for local disks looks first and creates then; the system call does both at once.
            local = place.toUri().getPath()
            os.makedirs(os.path.dirname(local), exist_ok=True)
            try:
                os.close(os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            except FileExistsError:
                return False
            return True
        try:
            files.create(place, False).close()
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in str(error):
                return False
            raise
        return True

    def events(self) -> DataFrame:
        """All events in the order of their time within an attempt."""
        found = stored(self.spark, f"{self.path}/events", EVENTS)
        return self.spark.createDataFrame([], EVENTS) if found is None else found

    def attempts(self) -> DataFrame:
        """One row per attempt: ``batch_id``, ``attempt``, ``status``, when claimed and last changed, the error."""
        ended = F.col("step").isNull() & (F.col("status") != IN_PROGRESS)
        return self.events().groupBy("batch_id", "attempt").agg(
            F.coalesce(F.max(F.when(ended, F.col("status"))), F.lit(IN_PROGRESS)).alias("status"),
            F.min("at").alias("created_timestamp"),
            F.max("at").alias("updated_timestamp"),
            F.max("error_message").alias("error_message"),
        )

    def states(self) -> DataFrame:
        """The last attempt of each batch."""
        last = self.attempts().groupBy("batch_id").agg(F.max(F.struct("attempt", "status", "created_timestamp", "updated_timestamp", "error_message")).alias("last"))
        return last.select("batch_id", "last.*")

    def claim(self, batch_id: str, again: bool = False) -> int | None:
        """Begin the next attempt and return its number, or None if the batch is taken, done, or another run was faster.

        ``again``: a completed batch may be run once more, as its files were delivered again.
        """
        last = self.states().filter(F.col("batch_id") == batch_id).first()
        if last is not None and last["status"] != FAILED and not (again and last["status"] == COMPLETED):
            return None
        attempt = 1 if last is None else last["attempt"] + 1
        if not self._create(f"{self.path}/claims/{batch_id}-{attempt}"):
            return None
        self._append(batch_id, attempt, None, IN_PROGRESS)
        return attempt

    def finish_step(self, batch_id: str, attempt: int, step: str, counts: dict[str, int] | None = None) -> None:
        self._require(batch_id, attempt)
        self._append(batch_id, attempt, step, COMPLETED, counts=counts)

    def complete(self, batch_id: str, attempt: int) -> None:
        self._require(batch_id, attempt)
        self._append(batch_id, attempt, None, COMPLETED)

    def fail(self, batch_id: str, attempt: int, error: str) -> None:
        self._require(batch_id, attempt)
        self._append(batch_id, attempt, None, FAILED, error)

    def finished_steps(self, batch_id: str) -> set[str]:
        """Steps that attempts since the last completed one have finished: a new attempt goes on behind them."""
        events = self.events().filter(F.col("batch_id") == batch_id).collect()
        done = max((e["attempt"] for e in events if e["step"] is None and e["status"] == COMPLETED), default=0)
        return {e["step"] for e in events if e["step"] is not None and e["attempt"] > done}

    def _require(self, batch_id: str, attempt: int) -> None:
        mine = self.attempts().filter((F.col("batch_id") == batch_id) & (F.col("attempt") == attempt)).first()
        if mine is None or mine["status"] != IN_PROGRESS:
            raise NotInProgress(f"attempt {attempt} of batch {batch_id} is not in progress")

    def _append(self, batch_id: str, attempt: int, step: str | None, status: str, error: str | None = None, counts: dict[str, int] | None = None) -> None:
        row = self.spark.range(1).select(
            F.lit(step).cast("string").alias("step"), F.lit(status).alias("status"), F.current_timestamp().alias("at"),
            F.lit(error).cast("string").alias("error_message"),
            (F.create_map(*[F.lit(x) for kv in counts.items() for x in kv]) if counts else F.lit(None)).cast("map<string,bigint>").alias("counts"),
        )
        # Partition folders, each written by the one run that holds the claim.
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/events/batch_id={batch_id}/attempt={attempt}")


def landed_batches(spark: SparkSession, landing: str) -> DataFrame:
    """``batch_id`` of every delivered folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(landing)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return spark.createDataFrame([(f.getPath().getName(),) for f in found if f.isDirectory()], "batch_id string")
