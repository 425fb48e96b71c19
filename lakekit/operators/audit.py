"""Append-only log of task attempts."""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lakekit.session import small_rows

_ENTRY = "task STRING, attempt BIGINT, status STRING, message STRING, rows BIGINT, started_at STRING, ended_at STRING"


class AuditLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, task: str, attempt: int, status: str, message: str = "", rows: int = 0, started_at: str = "") -> None:
        now = datetime.datetime.now(datetime.UTC).isoformat()
        row = {"task": task, "attempt": attempt, "status": status, "message": message, "rows": rows,
               "started_at": started_at or now, "ended_at": now}
        small_rows(self.spark, [row], _ENTRY).write.mode("append").json(self.path)

    @contextmanager
    def attempt(self, task: str, attempt: int, swallow: bool = False) -> Iterator[dict]:
        """Log success or failure of the block; ``rows`` may be set in the yielded dict."""
        started, entry = datetime.datetime.now(datetime.UTC).isoformat(), {"rows": 0}
        try:
            yield entry
        except Exception as e:
            self.add(task, attempt, "FAILED", str(e), entry["rows"], started)
            if not swallow:
                raise
        else:
            self.add(task, attempt, "SUCCEEDED", "", entry["rows"], started)

    def read(self) -> DataFrame:
        return self.spark.read.schema(_ENTRY).json(self.path)
