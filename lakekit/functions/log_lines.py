"""Parsing of application log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: layout of a line is "timestamp LEVEL event ... ms=number"
LINE = r"^(\S+(?: \d\S*)?) (DEBUG|INFO|WARN|ERROR) (\S+)"
MILLIS = r"ms=(\d+)"


def parse_log_lines(df: DataFrame, column: str = "value") -> DataFrame:
    """Timestamp, level, event and milliseconds of each line; parts that are missing become NULL."""
    def group(pattern: str, i: int):
        return F.nullif(F.regexp_extract(column, pattern, i), F.lit(""))

    return df.withColumns(
        {
            "ts": F.try_to_timestamp(group(LINE, 1)),
            "level": group(LINE, 2),
            "event": group(LINE, 3),
            "ms": group(MILLIS, 1).try_cast("bigint"),
        }
    )
