"""Keyed, first-arrival-wins insertion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseforge.schema import EVENT_KEY

STORED_ARRIVAL = ("source_topic", "source_partition", "source_offset")


def first_arrivals(
    events: DataFrame,
    key: Sequence[str] = EVENT_KEY,
    arrival: Sequence[str] = STORED_ARRIVAL,
) -> DataFrame:
    """One row per key: the first to arrive.

    Spark limits each task to one row per key before the shuffle
    (``WindowGroupLimit``), so a key with very many copies ships one row per
    input task rather than all of them.
    """
    window = Window.partitionBy(*key).orderBy(*arrival)
    return events.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def absent_from(
    candidates: DataFrame,
    existing: DataFrame,
    key: Sequence[str] = EVENT_KEY,
    same_event_date: bool = False,
    reduce_history: bool = False,
) -> DataFrame:
    """Candidates whose key ``existing`` does not hold.

    ``reduce_history`` first narrows the history to the keys among the
    candidates. When those are few enough for Spark to broadcast, the history
    is scanned without being shuffled; it reads the candidates twice, so it
    suits persisted micro-batches.

    Set ``same_event_date`` only where a repeated key is known to carry the
    same event time: the history is then joined on ``event_date`` too, and its
    other dates are pruned.
    """
    on = [*key, "event_date"] if same_event_date else list(key)
    seen = existing.select(*on)
    if reduce_history:
        seen = seen.join(candidates.select(*on), on, "left_semi")
    return candidates.join(seen, on, "left_anti")


def insert_if_absent(events: DataFrame, existing: DataFrame, **options: bool) -> DataFrame:
    """Rows of ``events`` that a first-wins insert into ``existing`` would add."""
    return absent_from(first_arrivals(events), existing, **options)
