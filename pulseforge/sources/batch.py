"""What a write is known by: the writer's run and the batch's number in it.

A batch that is repeated after a failure has the same run and number and replaces
what it wrote. Another run never replaces it, whatever its numbers: a stream with a
new progress folder, and every batch job, is a run of its own.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Batch:
    run: str
    number: int = 0
    repeatable: bool = True

    @staticmethod
    def new() -> Batch:
        """The only batch of a run of its own: no one can repeat it."""
        return Batch(uuid.uuid4().hex, repeatable=False)

    @property
    def folder(self) -> str:
        return f"run={self.run}/batch_id={self.number}"


def run_of(spark: SparkSession, progress: str) -> str:
    """The run of the stream with this progress folder. It is kept inside the
    folder, so it lives and goes with the progress it stands for."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{progress.rstrip('/')}/run")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path):
        return files.listStatus(path)[0].getPath().getName()
    run = uuid.uuid4().hex
    files.create(jvm.org.apache.hadoop.fs.Path(path, run)).close()
    return run
