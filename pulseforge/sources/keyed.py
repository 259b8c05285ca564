"""Keyed tables as a log of runs: a batch writes only what it changes.

Each batch adds one run, a folder with the batch's rows; of several rows of a key
the newest run's counts. A run is cut into buckets by the key's hash, about
``BUCKET_ROWS`` rows each, so that whoever needs few keys reads only the buckets
they lie in; small runs have one bucket. Older runs of like size are merged as they come, so the number of runs
grows with the logarithm of the table, and a row is rewritten that often.

What counts is said by the newest commit (see ``log``), which lists the runs. A run
without a commit is never read. Writers that commit at the same time take turns, and
none loses a row. A repeated batch takes the place of its first attempt; therefore a
writer's newest run is not merged, unless the batch can't be repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseforge.sources import log
from pulseforge.sources.batch import Batch

#: Rows of a bucket, buckets of a run at most (a power of two).
BUCKET_ROWS = 250_000
MOST_BUCKETS = 4_096
#: A run is merged with newer ones that have at least this share of its rows.
SHARE = 0.5
#: Commits that are kept, with their runs, for readers that still use them.
KEPT = 10


def _log(path: str) -> log.Log:
    return log.Log(f"{path}/log")


def _newest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The number of the newest commit (-1 for none), and what it says."""
    while numbers := _log(path).numbers(spark):
        state = _log(path).read(spark, numbers[-1])
        if state is not None:  # else it has been superseded meanwhile
            return numbers[-1], state
    return -1, {"key": [], "runs": []}


def _own(run: dict, batch: Batch | None) -> bool:
    return batch is not None and (run["writer"], run["number"]) == (batch.run, batch.number)


def _before(runs: list[dict], batch: Batch | None) -> list[dict]:
    """The runs that were there before ``batch``."""
    for at, run in enumerate(runs):
        if _own(run, batch):
            return runs[:at]
    return runs


def _hash(key: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in key])


def _load(spark: SparkSession, path: str, schema: T.StructType, runs: list[dict], touched: set[int] | None = None) -> DataFrame:
    """Rows of all runs, with their run's place as ``_order``."""
    stored = T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])
    frame = None
    for order, run in enumerate(runs):
        rows = spark.read.schema(stored).parquet(f"{path}/data/{run['id']}")
        if touched is not None:
            rows = rows.where(F.col("_bucket").isin(sorted({t % run["buckets"] for t in touched})))
        rows = rows.drop("_bucket").withColumn("_order", F.lit(order))
        frame = rows if frame is None else frame.unionByName(rows)
    return frame


def _latest(rows: DataFrame, schema: T.StructType, key: Sequence[str], runs: list[dict]) -> DataFrame:
    if len(runs) == 1:
        return rows.select(*schema.names)
    others = [n for n in schema.names if n not in key]
    newest = rows.groupBy(*key).agg(F.max_by(F.struct("_order", *others), "_order").alias("_row"))
    return newest.select(*[F.col(n) if n in key else F.col(f"_row.{n}").alias(n) for n in schema.names])


def read(spark: SparkSession, path: str, schema: T.StructType, before: Batch | None = None, keys: DataFrame | None = None) -> DataFrame:
    """The table, or the one that batch ``before`` builds on. With ``keys`` only
    their rows, from the buckets they lie in; the numbers of those buckets, at most
    ``MOST_BUCKETS``, are brought to the driver."""
    _, state = _newest(spark, path)
    runs, key = _before(state["runs"], before), state["key"]
    if not runs:
        return spark.createDataFrame([], schema)
    if keys is None:
        return _latest(_load(spark, path, schema, runs), schema, key, runs)
    keys = keys.select(*key).distinct()
    most = max(run["buckets"] for run in runs)
    touched = {row[0] for row in keys.select(F.pmod(_hash(key), F.lit(most))).distinct().collect()}
    rows = _load(spark, path, schema, runs, touched).join(keys, key, "left_semi")
    return _latest(rows, schema, key, runs)


def _write(rows: DataFrame, path: str, key: Sequence[str], batch: Batch, buckets: int | None = None) -> dict:
    """Write a run. Without ``buckets`` the rows are written as they come, which
    also counts them, and cut into buckets only if they are many."""
    run, seen = uuid.uuid4().hex, Observation()
    bucket = F.pmod(_hash(key), F.lit(buckets or 1)).cast("int")
    dealt = rows.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("_bucket", bucket)
    if buckets:
        dealt = dealt.repartition("_bucket").sortWithinPartitions("_bucket", *key)
    dealt.write.partitionBy("_bucket").parquet(f"{path}/data/{run}")
    entry = {"id": run, "rows": seen.get["rows"], "buckets": buckets or 1, "writer": batch.run, "number": batch.number, "repeatable": batch.repeatable}
    if buckets or _buckets(entry["rows"]) == 1:
        return entry
    spark = rows.sparkSession
    cut = _write(_load(spark, path, rows.schema, [entry]).drop("_order"), path, key, batch, _buckets(entry["rows"]))
    log.remove(spark, f"{path}/data/{run}")
    return cut


def _buckets(rows: int) -> int:
    """A power of two, so that a bucket of many is part of one bucket of fewer."""
    buckets = 1
    while buckets < MOST_BUCKETS and buckets * BUCKET_ROWS < rows:
        buckets *= 2
    return buckets


def mergeable(runs: list[dict]) -> tuple[int, int]:
    """The newest stretch of runs that should be one: [low, high)."""
    later: set[str] = set()
    fixed = [False] * len(runs)
    for at in range(len(runs) - 1, -1, -1):
        fixed[at] = runs[at]["repeatable"] and runs[at]["writer"] not in later
        later.add(runs[at]["writer"])
    high = len(runs)
    while high and fixed[high - 1]:
        high -= 1
    low, rows = high, 0
    while low and not fixed[low - 1] and (low == high or rows >= SHARE * runs[low - 1]["rows"]):
        low -= 1
        rows += runs[low]["rows"]
    return low, high


def _merged(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str], runs: list[dict]) -> tuple[list[str], dict] | None:
    """The ids of the runs that are merged, and the run that takes their place."""
    low, high = mergeable(runs)
    if high - low < 2:
        return None
    part = runs[low:high]
    rows = _latest(_load(spark, path, schema, part), schema, key, part)
    last = part[-1]
    run = _write(rows, path, key, Batch(last["writer"], last["number"], repeatable=False), _buckets(sum(r["rows"] for r in part)))
    return [r["id"] for r in part], run


def _replace(runs: list[dict], merged: tuple[list[str], dict] | None) -> list[dict]:
    if merged is None:
        return runs
    ids = [r["id"] for r in runs]
    old, new = merged
    if old[0] not in ids or ids[ids.index(old[0]):ids.index(old[0]) + len(old)] != old:
        return runs  # another writer has merged them
    at = ids.index(old[0])
    return [*runs[:at], new, *runs[at + len(old):]]


def upsert(spark: SparkSession, path: str, schema: T.StructType, updates: DataFrame, key: Sequence[str], batch: Batch) -> None:
    """Insert ``updates`` (unique on ``key``) or, unconditionally, put them in place
    of the old rows. Costs what the batch holds, and now and then a merge."""
    _, state = _newest(spark, path)
    new = _write(updates.select(*schema.names), path, key, batch)
    repeated = any(_own(run, batch) for run in state["runs"])
    merged = None if repeated or not new["rows"] else _merged(spark, path, schema, key, [*state["runs"], new])
    while True:
        number, state = _newest(spark, path)
        runs = state["runs"]
        own = next((at for at, run in enumerate(runs) if _own(run, batch)), None)
        added = [new] if new["rows"] else []
        runs = [*runs, *added] if own is None else [*runs[:own], *added, *runs[own + 1:]]
        if _log(path).append(spark, number + 1, {"key": list(key), "runs": _replace(runs, merged)}):
            break
    _clean(spark, path)


def _clean(spark: SparkSession, path: str) -> None:
    """Forget old commits, and remove the runs that only they list."""
    numbers = _log(path).numbers(spark)
    old, kept = numbers[:-KEPT], numbers[-KEPT:]
    if not old:
        return
    ids = lambda some: {run["id"] for n in some for run in (_log(path).read(spark, n) or {"runs": []})["runs"]}
    gone = ids(old) - ids(kept)
    for number in old:
        _log(path).forget(spark, number)
    for run in gone:
        log.remove(spark, f"{path}/data/{run}")
