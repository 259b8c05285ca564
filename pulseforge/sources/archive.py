"""Raw messages kept in files of known offset ranges.

The archive is a table of committed files (``committed``) with the source partition
outermost. Inside a partition each file holds a stretch of offsets, which its commit
names. A replay or a trace takes from the commits the files whose stretches it needs
and reads no others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseforge.operators import lookup
from pulseforge.schema import RAW_MESSAGE
from pulseforge.sources.batch import Batch
from pulseforge.sources.committed import Committed, entry


@dataclass(frozen=True)
class Archive:
    path: str

    @property
    def table(self) -> Committed:
        return Committed(self.path, RAW_MESSAGE, "partition")

    def keep(self, messages: DataFrame, batch: Batch) -> None:
        """Add a batch of messages, in place of an earlier attempt's."""
        spark = messages.sparkSession
        rows = messages.select(*RAW_MESSAGE.names).repartitionByRange("topic", "partition", "offset")
        added = self.table.put(rows.sortWithinPartitions("topic", "partition", "offset"))
        if added:
            # One row for each file and topic in it.
            read = self.table.load(spark, [a["file"] for a in added]).withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1))
            spans = read.groupBy("_file", "partition", "topic").agg(F.min("offset").alias("low"), F.max("offset").alias("high")).collect()
            by_file: dict[tuple[str, int], list] = {}
            for s in spans:
                by_file.setdefault((s["_file"], s["partition"]), []).append([s["topic"], s["low"], s["high"]])
            for a in added:
                folder, _, name = a["file"].rpartition("/")
                a["spans"] = by_file[name, int(folder.split("/")[0].partition("=")[2])]
        self.table.commit(spark, lambda state: entry(batch, added, state.of(batch)))

    def spans(self, spark: SparkSession) -> list[tuple[str, str, int, int, int]]:
        """(file, topic, partition, lowest, highest offset) of all files."""
        out = []
        for name, (_, _, _, _, more) in self.table.state(spark).files.items():
            partition = int(name.split("/")[0].partition("=")[2])
            out += [(name, topic, partition, low, high) for topic, low, high in more["spans"]]
        return out

    def partitions(self, spark: SparkSession) -> dict[str, list[int]]:
        """The source partitions of each topic that the archive has messages of."""
        found: dict[str, set[int]] = {}
        for _, topic, partition, _, _ in self.spans(spark):
            found.setdefault(topic, set()).add(partition)
        return {topic: sorted(p) for topic, p in found.items()}

    def read(self, spark: SparkSession) -> DataFrame:
        return self.table.read(spark)

    def replay(self, spark: SparkSession, checkpoint: DataFrame, group: str) -> DataFrame:
        """Messages past the group's stored offsets; all of a partition without one.
        The marks, one short row for each source partition, go to the driver."""
        marks = {(r.topic, r.partition): r.last_offset for r in checkpoint.where(F.col("consumer_group") == group).collect()}
        files = {f for f, topic, partition, _, high in self.spans(spark) if high > marks.get((topic, partition), -1)}
        return lookup.replay_after(self.table.load(spark, files), checkpoint, group)

    def trace(self, stored: DataFrame) -> DataFrame:
        """Stored events next to the raw message each one came from.

        Which files are needed is found by a join of the events' positions with the
        files' stretches, on cells of offsets as wide as the widest stretch: a
        stretch lies in two cells at most, a position in one."""
        spark = stored.sparkSession
        spans = self.spans(spark)
        if not spans:
            return lookup.trace_to_source(stored, self.table.load(spark, []))
        width = max(high - low + 1 for _, _, _, low, high in spans)
        rows = spark.createDataFrame(spans, "file STRING, source_topic STRING, source_partition INT, low BIGINT, high BIGINT")
        cells = rows.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor(F.col("high") / width))))
        at = stored.select("source_topic", "source_partition", "source_offset").withColumn("_cell", F.floor(F.col("source_offset") / width))
        inside = F.col("source_offset").between(F.col("low"), F.col("high"))
        needed = at.join(cells, ["source_topic", "source_partition", "_cell"]).where(inside).select("file").distinct()
        return lookup.trace_to_source(stored, self.table.load(spark, [r.file for r in needed.collect()]))
