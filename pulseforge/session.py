"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

REQUIRED = {
    # All event times are UTC; text without an offset is read as UTC.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key is not an error: the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


TUNING = {
    # HotSpot does not compile methods above 8000 bytes of bytecode. Decoding
    # one message fuses into a larger one, so past this size let Spark use
    # split per-operator projections, which do get compiled (twice as fast).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Tables' files come by name from their commits. Up to this many are looked up
    # on the driver, which takes less time than a job with a task for each.
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in {**REQUIRED, **TUNING}.items():
        spark.conf.set(name, value)
    return spark


def require_configured(spark: SparkSession) -> None:
    for name, value in REQUIRED.items():
        if (spark.conf.get(name) or "").lower() != value.lower():
            raise RuntimeError(f"{name} must be {value}: call pulseforge.configure(spark) first")


def build(app_name: str = "pulseforge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the required settings, adaptive execution and, for
    streaming state, RocksDB. ``conf`` keys use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **REQUIRED,
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


ADAPTIVE = "spark.sql.adaptive.enabled"


@contextmanager
def adaptive(spark: SparkSession, as_in: SparkSession) -> Iterator[None]:
    """Inside, a micro-batch's session plans adaptively if session ``as_in`` does.

    Spark plans a stateful stream without adaptive execution, so that the number of
    its partitions stays, and its session keeps it off for what a batch does with its
    rows, too: there ``rebalance`` would be ignored, and every shuffle would keep all
    partitions. The stream's own part has been planned when the batch is called."""
    was = spark.conf.get(ADAPTIVE)
    spark.conf.set(ADAPTIVE, as_in.conf.get(ADAPTIVE))
    try:
        yield
    finally:
        spark.conf.set(ADAPTIVE, was)


#: A stream's state on the executors' disks, with native memory that does not grow
#: with it. A batch writes its changes only, and rows are not looked up to be counted.
ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{ROCKSDB}.changelogCheckpointing.enabled": "true",
    f"{ROCKSDB}.boundedMemoryUsage": "true",
    f"{ROCKSDB}.trackTotalNumberOfRows": "false",
}


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """A stream started inside keeps its state in RocksDB, whatever the session's
    store; Spark's default one holds all state on the executors' heap, and copies its
    map in every batch. A stream takes its session's settings when it starts, and one
    with progress goes on with the store that it began with."""
    was = {name: spark.conf.get(name, None) for name in ON_DISK}
    for name, value in ON_DISK.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in was.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def at_once(spark: SparkSession, jobs: Sequence[Callable[[], None]]) -> None:
    """Run independent writes side by side; all end before an error is raised."""
    if jobs:
        with ThreadPoolExecutor(len(jobs)) as pool:
            ends = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        for end in ends:
            end.result()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory under the cluster's shared checkpoint folder. Only a local
    session that names none (tests) gets a local temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return tempfile.mkdtemp(prefix=f"run-{purpose}-")
