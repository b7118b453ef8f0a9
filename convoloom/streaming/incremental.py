"""Batches that arrive over time, each taken up exactly once: a keyed table fed by a stream, and what of a table is still to do."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..sources.files import delete_path, ensure_directory, last_wins


class KeyedTable:
    """One row a key, in a folder of immutable parts and a log that names them.

    A batch's rows are cut down to the last of each key and written as a new part; the part counts once its name stands under the
    batch's number in the log. A batch whose number is there already has been taken up and is passed over, so a batch that is
    run again, after a failure at any point, changes nothing. Parts without a log entry are leavings of failed attempts.
    Of a key the row with the greatest ``order`` columns counts, whatever batch it came in; of equal ones that of the later batch. A null
    key is a key. A batch costs as much as its own rows; a reader merges the parts, and ``compact`` makes them one.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, order: list[str]):
        self.spark, self.folder, self.key, self.order = spark, folder, key, order
        ensure_directory(spark, f"{folder}/log")

    def _path(self, name: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return at, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def entries(self) -> list[tuple[int, str, str]]:
        """(number, kind, part) of what the log has, a merged part standing for all numbers up to its own."""
        at, fs = self._path("log")
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        found = [(int(n), kind, part) for n, kind, part in (x.split("~") for x in names if not x.startswith((".", "_")))]
        base = max((n for n, kind, _ in found if kind == "all"), default=None)
        return sorted((n, kind, part) for n, kind, part in found if base is None or (n == base and kind == "all") or (n > base and kind == "one"))

    def _log(self, number: int, kind: str, part: str) -> None:
        """The entry is the name of an empty file, so that it is there at once or not at all."""
        at, fs = self._path(f"log/{number}~{kind}~{part}")
        fs.create(at, True).close()

    def _newest(self, rows: DataFrame) -> DataFrame:
        order = F.struct(*[F.col(f"`{c}`") for c in [*self.order, "__batch"]])
        return last_wins(rows.withColumn("__at", order), self.key, "__at").drop("__at")

    def taken(self, number: int) -> bool:
        """Whether the batch with that number is in the table."""
        return any(n == number or (kind == "all" and number <= n) for n, kind, _ in self.entries())

    def take(self, batch: DataFrame, number: int) -> None:
        """Takes up a batch; does nothing if it was taken up before."""
        if self.taken(number):
            return
        part = uuid4().hex
        self._newest(batch.withColumn("__batch", F.lit(number).cast("long"))).write.parquet(f"{self.folder}/parts/{part}")
        self._log(number, "one", part)

    def rows(self) -> DataFrame | None:
        """The table, with the number of each row's batch as ``__batch``; None before the first batch."""
        parts = [f"{self.folder}/parts/{part}" for _, _, part in self.entries()]
        if not parts:
            return None
        rows = self.spark.read.parquet(*parts)
        return rows if len(parts) == 1 else self._newest(rows)

    def compact(self) -> None:
        """Makes all parts one; parts that no longer count are removed after the log says so."""
        entries = self.entries()
        if len(entries) < 2:
            return
        part = uuid4().hex
        self.rows().write.parquet(f"{self.folder}/parts/{part}")
        self._log(entries[-1][0], "all", part)
        for n, kind, old in entries:
            delete_path(self.spark, f"{self.folder}/log/{n}~{kind}~{old}")
            delete_path(self.spark, f"{self.folder}/parts/{old}")

    def pending(self, tasks: DataFrame, task_key: str) -> DataFrame:
        """Rows of ``tasks`` whose key the table does not have yet; null keys are always pending."""
        rows = self.rows()
        return tasks if rows is None else tasks.join(rows.select(F.col(self.key).alias(task_key)), task_key, "left_anti")


def feed(source: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Runs a stream to the end of what there is now and takes its batches up into the table. ``checkpoint`` remembers which
    files have been read, so the next run begins with the files that have come since; it belongs to one table."""
    query = source.writeStream.foreachBatch(lambda batch, number: table.take(batch, number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
