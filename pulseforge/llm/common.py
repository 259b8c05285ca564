"""Helpers shared by the operators: shared folders, written tables, bounded
batches, words and their hashes on bytes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these bytes (blank, tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes of text that are worked on at once inside a task.
BLOCK_BYTES = 4 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_PIECE = 1 << 20


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors
    share. Only a local session that names none (tests) gets a local folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = base.get() if base.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="run-llm-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_written: list[str] = []


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: computed once, and
    readable again after executors are lost."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_written(spark: SparkSession) -> None:
    """Remove all tables that ``written`` has made in this process. Results that have
    not been computed yet still read them: call it after the last."""
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further columns cannot clash."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def crc_fold(column: Column, folds: int = 5) -> Column:
    """crc32 of the value as text, modulo ``folds``; null stays null."""
    return F.crc32(column.cast("string").cast("binary")) % folds


def unit_hash(*columns: Column | str) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5; nulls count as ''."""
    text = F.concat_ws(":", *[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Batches cut so that their texts hold about ``limit`` bytes (a longer text
    stands alone), each with its texts as large strings, null as ''."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()).fill_null("")
        ends = offsets(column)
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at), column.slice(at, to - at)
            at = to


def offsets(column: pa.Array) -> np.ndarray:
    """Byte offsets of a large string array."""
    if not len(column):
        return np.zeros(1, dtype=np.int64)
    return np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts one after another, and where each text starts."""
    ends = offsets(column)
    data = column.buffers()[2] if len(column) else None
    data = np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return data, ends - ends[0]


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_tables: dict[str, np.ndarray] = {}


def _table(name: str) -> np.ndarray:
    if not _tables:
        values = np.random.default_rng(20240229).integers(1, 1 << 63, 512, dtype=np.uint64)
        _tables["byte"] = values[:256] | np.uint64(1)
        _tables["power"] = _powers(_PIECE, _MULTIPLIER)
        _tables["inverse"] = _powers(_PIECE, pow(_MULTIPLIER, -1, 1 << 64))
    return _tables[name]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Words:
    """The words of a block of texts: ``start`` and ``end`` (bytes in ``data``),
    ``doc`` (where each text's words begin), ``hash`` (64 bits a word)."""

    def __init__(self, column: pa.Array, outside: np.ndarray = _SPACE, fold: np.ndarray | None = None):
        """``outside`` tells of each byte whether it ends words; ``fold`` has the
        byte that stands for each."""
        self.data, self.text_start = text_bytes(column)
        if fold is not None:
            self.data = fold[self.data]
        inside = ~outside[self.data]
        edge = np.zeros(len(self.data) + 1, dtype=bool)
        edge[self.text_start] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:-1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.doc = np.searchsorted(self.start, self.text_start)
        self._hash: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.start)

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.doc)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = np.zeros(len(self), dtype=np.uint64)
            at = 0
            while at < len(self):
                base = self.start[at]
                to = max(at + 1, int(np.searchsorted(self.end, base + _PIECE, side="right")))
                self._hash[at:to] = self._piece(at, to, int(base))
                at = to
        return self._hash

    def _piece(self, at: int, to: int, base: int) -> np.ndarray:
        n = int(self.end[to - 1]) - base
        power, inverse = _table("power"), _table("inverse")
        if n > len(power):  # one word longer than a piece
            power = _powers(n, _MULTIPLIER)
            inverse = power[:1]
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_table("byte")[self.data[base:base + n]] * power[:n], out=sums[1:])
        start, end = self.start[at:to] - base, self.end[at:to] - base
        h = (sums[end] - sums[start]) * inverse[start]
        return mix(h + (end - start).astype(np.uint64))

    def grams(self, n: int, seed: int = 0) -> np.ndarray:
        """A hash of the ``n`` words from each word on; entries whose words run
        past their text's end mean nothing (see ``whole``)."""
        h = mix(self.hash + np.uint64(seed)) if seed else self.hash
        out = np.zeros(max(0, len(h) - n + 1), dtype=np.uint64)
        for i in range(n):
            out *= np.uint64(_MULTIPLIER)
            out += h[i:i + len(out)]
        return mix(out)

    def whole(self, n: int) -> np.ndarray:
        """Whether the ``n`` words from each word on lie in one text."""
        size = max(0, len(self) - n + 1)
        ends = np.repeat(self.doc[1:], self.count)[:size]
        return np.arange(size) + n <= ends

    def text_of(self) -> np.ndarray:
        """The number of the text each word belongs to."""
        return np.repeat(np.arange(len(self.count)), self.count)


def binary_rows(data: np.ndarray, width: int) -> pa.Array:
    """Rows of equal width as binary values."""
    n = len(data)
    raw = np.ascontiguousarray(data).tobytes()
    ends = (np.arange(n + 1, dtype=np.int64) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw)])
