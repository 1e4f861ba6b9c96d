"""Sorted-out results of micro-batches in a logarithmic number of runs.

Batch ``b`` is reduced to a run ``[b, b + 1)``; whenever two neighbouring runs
are equally long they are reduced to one, as a binary counter carries.  After
``n`` batches the live runs are the binary digits of ``n``, so a reader takes
at most log2(n) + 1 folders, and a row is written log2(n) times at most.  A
marker that is renamed into place says how many batches are in.

A batch that runs again after a failure overwrites its own run and makes the
same merges, so replay changes nothing; what readers of the marker before use
stays until the next batch is in.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def live(n: int) -> list[tuple[int, int]]:
    """The runs that hold ``n`` batches, oldest first."""
    out, start = [], 0
    for bit in reversed(range(n.bit_length())):
        if n >> bit & 1:
            out.append((start, start + (1 << bit)))
            start += 1 << bit
    return out


class Runs:
    """Runs under ``path``; ``reduce`` takes rows to fewer rows of the same
    columns, and reducing the reduced rows of two parts gives that of the whole."""

    def __init__(self, spark: SparkSession, path: str, reduce: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.reduce = spark, path, reduce
        hadoop = spark._jvm.org.apache.hadoop.fs
        self.at, self.fs = hadoop.Path, hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _folder(self, run: tuple[int, int]) -> str:
        return f"{self.path}/runs/{run[0]}-{run[1]}"

    def batches(self) -> int:
        """How many batches are in."""
        folder = self.at(f"{self.path}/markers")
        names = [f.getPath().getName() for f in self.fs.listStatus(folder)] if self.fs.exists(folder) else []
        return max((int(n) for n in names if n.isdigit()), default=0)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Take in a micro-batch (again, if it was cut short)."""
        spark, n, size = batch.sparkSession, batch_id + 1, 1
        self.reduce(batch).write.mode("overwrite").parquet(self._folder((batch_id, n)))
        while n % (2 * size) == 0:
            parts = [self._folder(r) for r in ((n - 2 * size, n - size), (n - size, n)) if self.fs.exists(self.at(self._folder(r)))]
            self.reduce(spark.read.parquet(*parts)).write.mode("overwrite").parquet(self._folder((n - 2 * size, n)))
            size *= 2
        aside, name = self.at(f"{self.path}/markers/.{uuid.uuid4().hex}"), self.at(f"{self.path}/markers/{n}")
        self.fs.create(aside, False).close()
        if not self.fs.exists(name):
            self.fs.rename(aside, name)
        used = {f"{a}-{b}" for m in (n, n - 1) for a, b in live(m)}
        for f in self.fs.listStatus(self.at(f"{self.path}/runs")):
            if f.getPath().getName() not in used:
                self.fs.delete(f.getPath(), True)

    def read(self) -> DataFrame | None:
        """The rows of all live runs, None before the first batch."""
        folders = [self._folder(r) for r in live(self.batches()) if self.fs.exists(self.at(self._folder(r)))]
        return self.spark.read.parquet(*folders) if folders else None
