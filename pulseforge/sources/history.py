"""Keys of all stored events, partitioned the way a join with them needs it.

The index is a bucketed Parquet table of keys, bucketed and sorted by the key. An
anti-join with it moves only the new rows to where their keys would be: the history
itself is never shuffled. The index follows the events table's commits. What has been
committed since it last caught up is read from the events' own files, so whatever the
table holds counts at once, and a batch killed in between leaves nothing behind. Parts
of like size are merged as they come, as in ``keyed``.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulseforge.schema import EVENT_KEY
from pulseforge.sources import log
from pulseforge.sources.batch import Batch
from pulseforge.sources.committed import Committed
from pulseforge.sources.keyed import mergeable

COLUMNS = ("customer_id", "event_id", "event_date", "run", "batch_id")
_TYPES = "customer_id STRING, event_id STRING, event_date DATE, run STRING, batch_id BIGINT"
#: The index catches up after so many commits, or so many bytes of events.
RECENT_COMMITS = 20
RECENT_BYTES = 256 << 20
#: Tables of earlier states that a session keeps, for frames made of them.
KEPT_TABLES = 8

_named: dict[str, list[str]] = {}


@dataclass(frozen=True)
class History:
    """The index at ``path`` of the keys of ``events``."""

    path: str
    events: Committed

    @property
    def log(self) -> log.Log:
        return log.Log(f"{self.path}/log")

    def _state(self, spark: SparkSession) -> tuple[int, dict]:
        """The newest commit's number, and what it says: the events' commit that the
        index has come to, its buckets, its parts, and whose rows of which parts
        have been replaced since."""
        numbers = self.log.numbers(spark)
        if not numbers:
            return -1, {"through": -1, "buckets": int(spark.conf.get("spark.sql.shuffle.partitions")), "parts": [], "replaced": []}
        return numbers[-1], self.log.read(spark, numbers[-1])

    def _since(self, spark: SparkSession, state: dict) -> tuple[dict, int, list[dict]]:
        """The state with replaced batches up to now, the events' newest commit, and
        the files added since. If a vacuum has taken commits away, the index begins
        anew with all files."""
        events = self.events.state(spark)
        entries = [self.events.log.read(spark, n) for n in range(state["through"] + 1, events.number + 1)]
        if any(e is None for e in entries):
            return state | {"parts": [], "replaced": []}, events.number, [{"file": f, "bytes": v[0], "of": v[1:3]} for f, v in events.files.items()]
        own = [e for e in entries if e["writer"] is not None]  # compactions change no keys
        removed = {f for e in own for f in e["removed"]}
        parts = [p["id"] for p in state["parts"]]
        replaced = state["replaced"] + [[e["writer"], e["number"], parts] for e in own if e["removed"] and parts]
        added = [a | {"of": [e["writer"], e["number"]]} for e in own for a in e["added"] if a["file"] not in removed]
        return state | {"replaced": replaced}, events.number, added

    def _write(self, rows: DataFrame, buckets: int) -> dict:
        """A part: bucketed files in a folder of their own."""
        spark, part, seen = rows.sparkSession, uuid.uuid4().hex, Observation()
        name = f"pulseforge_part_{part}"
        dealt = rows.select(*COLUMNS).observe(seen, F.count(F.lit(1)).alias("rows")).repartition(buckets, *EVENT_KEY)
        writer = dealt.write.format("parquet").bucketBy(buckets, *EVENT_KEY).sortBy(*EVENT_KEY)
        writer.option("path", f"{self.path}/data/{part}").saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # the files stay
        return {"id": part, "rows": seen.get["rows"], "writer": "", "number": 0, "repeatable": False}

    def _table(self, spark: SparkSession, state: dict) -> DataFrame:
        """The parts of a state as one bucketed table of this session."""
        parts = sorted(p["id"] for p in state["parts"])
        name = f"pulseforge_keys_{hashlib.md5(f'{self.path} {parts}'.encode()).hexdigest()}"
        if not spark.catalog.tableExists(name):
            key = ", ".join(EVENT_KEY)
            spark.sql(
                f"CREATE TABLE {name} ({_TYPES}, part STRING) USING parquet PARTITIONED BY (part)"
                f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {state['buckets']} BUCKETS LOCATION '{self.path}/tables/{name}'"
            )
            for part in parts:
                spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (part = '{part}') LOCATION '{self.path}/data/{part}'")
            names = _named.setdefault(self.path, [])
            names.append(name)
            while len(names) > KEPT_TABLES:
                spark.sql(f"DROP TABLE IF EXISTS {names.pop(0)}")
        rows = spark.table(name)
        for run, number, old in state["replaced"]:
            rows = rows.where(~((F.col("run") == run) & (F.col("batch_id") == number) & F.col("part").isin(old)))
        return rows.select(*COLUMNS)

    def catch_up(self, spark: SparkSession, commits: int = 1, size: int = 0) -> bool:
        """Add the keys of what the events table has beyond the index, if that is so
        many commits and bytes. Whether it did."""
        while True:
            number, old = self._state(spark)
            state, newest, added = self._since(spark, old)
            if newest == old["through"] or (newest - old["through"] < commits and sum(a["bytes"] for a in added) < size):
                return False
            parts = list(state["parts"])
            if added:
                parts.append(self._write(self.events.load(spark, [a["file"] for a in added]), state["buckets"]))
            state |= {"through": newest, "parts": parts}
            low, high = mergeable(parts)
            if high - low > 1:
                one = self._write(self._table(spark, state | {"parts": parts[low:high]}), state["buckets"])
                state |= {"parts": [*parts[:low], one, *parts[high:]]}
                state |= {"replaced": [[r, n, kept] for r, n, ids in state["replaced"] if (kept := [i for i in ids if i in {p["id"] for p in state["parts"]}])]}
            if self.log.append(spark, number + 1, state):
                return True

    def keep_up(self, spark: SparkSession) -> bool:
        """``catch_up`` once enough has been committed."""
        return self.catch_up(spark, RECENT_COMMITS, RECENT_BYTES)

    def read(self, spark: SparkSession, without: Batch | None = None) -> tuple[DataFrame, DataFrame]:
        """Keys and dates of all stored events, or of those not of batch ``without``:
        those in the index, bucketed by the key, and those committed since."""
        state, _, added = self._since(spark, self._state(spark)[1])
        own = [without.run, without.number] if without else None
        recent = self.events.load(spark, [a["file"] for a in added if a["of"] != own]).select(*COLUMNS)
        if not state["parts"]:
            return spark.createDataFrame([], _TYPES), recent
        rows = self._table(spark, state)
        if without:
            rows = rows.where((F.col("run") != without.run) | (F.col("batch_id") != without.number))
        return rows, recent
