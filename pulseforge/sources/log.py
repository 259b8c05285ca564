"""A table's commits: numbered JSON files, each created once.

Commit N is the file ``log/N.json``. Whoever creates it first has it, the others see
that and take the next number, so commits have one order, and none is lost or seen
half written. The file system must be able to link (local folders) or to rename
without replacing (HDFS and most stores).
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none where it does not exist."""
    path, system = _at(spark, folder)
    return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []


def sizes(spark: SparkSession, folder: str) -> dict[str, int]:
    """Bytes of the data files in a folder."""
    path, system = _at(spark, folder)
    found = system.listStatus(path) if system.exists(path) else []
    return {s.getPath().getName(): s.getLen() for s in found if s.getPath().getName()[:1] not in "._"}


def stamp(spark: SparkSession, path: str) -> tuple:
    """What tells that a file, or a folder's files, have changed."""
    path, system = _at(spark, path)
    status = system.getFileStatus(path)
    return tuple(sorted((s.getPath().getName(), s.getModificationTime(), s.getLen()) for s in (system.listStatus(path) if status.isDirectory() else [status])))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder another name; there is none of that name yet."""
    (old, system), (new, _) = _at(spark, source), _at(spark, target)
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    path, system = _at(spark, path)
    system.delete(path, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None if there is none."""
    path, system = _at(spark, path)
    try:
        stream = system.open(path)
    except Py4JJavaError:
        if system.exists(path):
            raise
        return None
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this content; False if there is one already."""
    target, system = _at(spark, path)
    draft, _ = _at(spark, f"{target.getParent()}/.{target.getName()}-{uuid.uuid4().hex}")
    stream = system.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if system.getUri().getScheme() != "file":
            return system.rename(draft, target)
        try:  # a local rename would replace
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        except FileExistsError:
            return False
        return True
    finally:
        system.delete(draft, False)


@dataclass(frozen=True)
class Log:
    folder: str

    def numbers(self, spark: SparkSession) -> list[int]:
        """Commits that are there, oldest first."""
        return sorted(int(n[:12]) for n in names(spark, self.folder) if n.endswith(".json") and n[:12].isdigit())

    def _file(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def read(self, spark: SparkSession, number: int) -> dict | None:
        """None if the commit is not there (any more)."""
        text = read_text(spark, self._file(number))
        return None if text is None else json.loads(text)

    def append(self, spark: SparkSession, number: int, entry: dict) -> bool:
        """Whether this entry has become commit ``number``."""
        return create(spark, self._file(number), json.dumps(entry))

    def forget(self, spark: SparkSession, number: int) -> None:
        remove(spark, self._file(number))
