"""Small literal inputs in the raw message layout."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pulseforge.config import TOPIC_RAW
from pulseforge.schema import RAW_MESSAGE

TESTDATA = "/root/testdata"
WHEN = datetime(2025, 11, 3, 16, 41, 27, tzinfo=timezone.utc)


def uid(n: int) -> str:
    return f"00000000-0000-4000-8000-{n:012d}"


def doc(n: int, customer: str = "cust_00001", rate=70, time: str = "2025-11-03T16:41:27.318450Z", **more) -> str:
    return json.dumps({"event_id": uid(n), "customer_id": customer, "timestamp": time, "heart_rate": rate, **more})


def messages(spark, values, partition: int = 0, start: int = 0):
    """One message per value, in arrival order."""
    rows = [("k", v, TOPIC_RAW, partition, start + i, WHEN) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, RAW_MESSAGE)


def rows_of(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())
