"""Partition and file layout: reports, compaction and clustering."""

from __future__ import annotations

import math
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.operators.snapshots import SnapshotTable
from lakekit.sources.files import list_files

MB = 1024 * 1024


def partition_rows(df: DataFrame) -> DataFrame:
    """Rows per non-empty partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def skew_report(counts: DataFrame, rows: str = "rows", factor: float = 1.5) -> DataFrame:
    """Spread of the ``rows`` per partition, task or key: skewed when the largest exceeds ``factor`` times the 75th percentile.

    The factor of 1.5 is a fixed value of the report."""
    out = counts.agg(
        F.count(F.lit(1)).alias("groups"),
        F.min(rows).alias("least"),
        F.expr(f"percentile({rows}, 0.25)").alias("p25"),
        F.expr(f"percentile({rows}, 0.5)").alias("median"),
        F.expr(f"percentile({rows}, 0.75)").alias("p75"),
        F.max(rows).alias("most"),
        (F.max(rows) / F.sum(rows)).alias("largest_share"),
    )
    return out.withColumn("skewed", F.col("most") > factor * F.col("p75"))


def layout_summary(spark: SparkSession, path: str | list[str], tiny: int = 16 * MB) -> DataFrame:
    """Number of data files, their bytes and average size, and whether they are too small, from the listing alone."""
    files = list_files(spark, path, "*.parquet")
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.avg("length").alias("average_bytes")
    ).withColumn("tiny_files", (F.col("files") > 1) & (F.col("average_bytes") < tiny))


def write_partitioned(df: DataFrame, path: str, columns: list[str], mode: str = "errorifexists", fmt: str = "parquet") -> None:
    """One folder per value, a few files each: rows are first brought together by value, where AQE splits values that are
    too big for one task and joins small ones. Without that every task would write a file into every folder."""
    df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).format(fmt).save(path)


def file_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """Zones: rows, and smallest and largest value and NULLs of some columns, in every file of a file-based frame."""
    ranges = [f(c).alias(f"{c}_{n}") for c in columns for f, n in ((F.min, "min"), (F.max, "max"), (lambda c: F.count_if(F.col(c).isNull()), "nulls"))]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ranges)


def _within(column: str, low, high) -> Column:
    """Whether a zone may hold a value from ``low`` to ``high``. A bound of None is open; a zone of NULLs alone holds none."""
    low, high = (x if x is None or isinstance(x, Column) else F.lit(x) for x in (low, high))
    hit = F.lit(True) if low is None else F.col(f"{column}_max") >= low
    return F.coalesce(hit & (F.lit(True) if high is None else F.col(f"{column}_min") <= high) & F.col(f"{column}_min").isNotNull(), F.lit(False))


def files_needed(ranges: DataFrame, column: str, low, high) -> DataFrame:
    """How many files a range filter has to read, and the share it can skip."""
    return ranges.agg(F.count(F.lit(1)).alias("files"), F.count_if(_within(column, low, high)).alias("needed")).withColumn(
        "skipped_share", 1 - F.col("needed") / F.col("files")
    )


class ZoneMap:
    """A stored table of zones that picks the files a scan opens, before any of them is touched.

    Parquet readers skip row groups by the same figures, but have to open every file for its footer. Here one small table, a
    row per file, is filtered by Spark, and only the names of the files that may match reach the driver, as in any file scan.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def build(self, data: DataFrame, columns: list[str]) -> None:
        """Zones of the files of ``data`` (read from files) over some columns; replaces what was stored."""
        file_ranges(data, columns).coalesce(1).write.mode("overwrite").parquet(self.path)

    def add(self, data: DataFrame, columns: list[str]) -> None:
        """Zones of files that were added since."""
        file_ranges(data, columns).coalesce(1).write.mode("append").parquet(self.path)

    def zones(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def files(self, **ranges: tuple) -> list[str]:
        """Paths of the files that may hold a row within all ranges: ``column=(low, high)``, None for an open end."""
        picked = self.zones()
        for column, (low, high) in ranges.items():
            picked = picked.where(_within(column, low, high))
        return sorted(unquote(r["file"]) for r in picked.select("file").collect())  # the address escapes the path

    def read(self, schema: StructType, **ranges: tuple) -> DataFrame:
        """The rows within all ranges; other files are neither listed nor opened."""
        files = self.files(**ranges)
        rows = self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)
        for column, (low, high) in ranges.items():
            if low is not None:
                rows = rows.where(F.col(column) >= low)
            if high is not None:
                rows = rows.where(F.col(column) <= high)
        return rows


#: Bits of a value's position inside its quantile range, and the most bits for the range itself.
INSIDE_BITS, RANGE_BITS = 4, 8


def with_z_value(df: DataFrame, columns: list[str], bounds: dict[str, list[float]], name: str, inside: int = INSIDE_BITS) -> DataFrame:
    """Add the position on a Z-order curve: for each column the number of the value's quantile range and its place inside, bits interleaved.

    ``bounds`` are rising edges of a column, its least and greatest value included. The range is found by a balanced tree of
    comparisons, the place inside by the distance from the range's lower edge; both become columns first, so that each is
    computed once a row, and not once for each of its bits.
    """

    def rank(value: Column, edges: list[float], low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(float(edges[middle + 1])), rank(value, edges, low, middle)).otherwise(rank(value, edges, middle + 1, high))

    def spread(number: Column, bits: int, first: int, j: int) -> Column:
        parts = [F.shiftleft(F.shiftright(number, i).bitwiseAND(F.lit(1)).cast("bigint"), (first + i) * len(columns) + j) for i in range(bits)]
        return reduce(Column.__add__, parts, F.lit(0).cast("bigint"))

    own, ranges = df.columns, {c: max(1, len(bounds[c]) - 1) for c in columns}
    values = [F.col(c).cast("double") for c in columns]
    out = df.select("*", *[
        (rank(v, bounds[c], 0, ranges[c] - 1) if len(bounds[c]) > 1 else F.lit(0)).alias(f"_at{j}") for j, (c, v) in enumerate(zip(columns, values, strict=True))])
    places = []
    for j, (c, v) in enumerate(zip(columns, values, strict=True)):
        edges = bounds[c]
        lower = F.get(F.array(*[F.lit(float(e)) for e in edges[:ranges[c]]]), F.col(f"_at{j}"))
        width = F.get(F.array(*[F.lit(float(b - a)) for a, b in zip(edges, edges[1:], strict=False)] or [F.lit(1.0)]), F.col(f"_at{j}"))
        places.append(F.greatest(F.lit(0), F.least(F.lit(2**inside - 1), F.floor((v - lower) / width * 2**inside))).cast("int").alias(f"_in{j}"))
    out, z = out.select("*", *places), F.lit(0).cast("bigint")
    for j, (c, v) in enumerate(zip(columns, values, strict=True)):
        part = spread(F.col(f"_at{j}"), max(1, (ranges[c] - 1).bit_length()), inside, j) + spread(F.col(f"_in{j}"), inside, 0, j)
        z = z + F.when(v.isNull(), F.lit(0).cast("bigint")).otherwise(part)
    return out.select(*[F.col(f"`{c}`") for c in own], z.alias(name))


def cluster_by(df: DataFrame, columns: list[str], files: int) -> DataFrame:
    """Rows laid out so that each of ``files`` output files covers a narrow range of every column.

    One column is range-partitioned. Several are put on a Z-order curve over quantile ranges (numbers, dates as
    numbers), as many ranges as the number of files asks for; the quantiles are approximate sketches of fixed size, the only
    thing that reaches the driver. A hot value is spread over neighbouring files, since ties are broken by a row hash.
    """
    tie = F.xxhash64(*df.columns)
    if len(columns) == 1:
        out = df.withColumn("_tie", tie).repartitionByRange(files, columns[0], "_tie")
        return out.sortWithinPartitions(*columns).drop("_tie")
    bits = min(RANGE_BITS, max(1, math.ceil(math.log2(max(2, files)) / len(columns)) + 1))
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    edges = numbers.approxQuantile(columns, [i / 2**bits for i in range(2**bits + 1)], 1 / 2 ** (bits + 2))
    bounds = {c: sorted(set(e)) or [0.0] for c, e in zip(columns, edges, strict=True)}
    out = with_z_value(df.withColumn("_tie", tie), columns, bounds, "_z")
    return out.repartitionByRange(files, "_z", "_tie").sortWithinPartitions("_z", *columns).drop("_z", "_tie")


def _file_count(bytes_: int, target: int) -> int:
    return max(1, math.ceil(bytes_ / target))


#: Begin of the names of data folders that are clustered.
CLUSTERED = "clustered-"


def _is_clustered(path: str) -> bool:
    return f"/data/{CLUSTERED}" in path


def compact(table: SnapshotTable, target_bytes: int = 128 * MB) -> dict:
    """Rewrite the small files of the current version into files near the target size; big files stay as they are.

    A second run finds at most one small file and changes nothing. Clustered folders stay whole, or their order would be
    lost. Only file names and sizes reach the driver.
    """
    entry = table._entry()
    clustered = [p for p in entry["paths"] if _is_clustered(p)]
    loose = [p for p in entry["paths"] if not _is_clustered(p)]
    idle = {"rewritten": 0, "written": 0, "version": entry["version"]}
    if not loose:
        return idle
    files = list_files(table.spark, loose, "*.parquet").where("length > 0")
    small = files.where(F.col("length") < target_bytes // 2)
    n, total = small.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    wanted = _file_count(total, target_bytes)
    if n <= wanted:
        return idle
    schema = table.schema()
    keep = [r["path"] for r in files.where(F.col("length") >= target_bytes // 2).select("path").collect()]
    merge = [r["path"] for r in small.select("path").collect()]
    # coalesce joins neighbouring splits without a shuffle
    rows = table.spark.read.schema(schema).parquet(*merge).coalesce(wanted)
    new = table._write(rows)
    version = table._record("compact", schema, [*clustered, *keep, *new], {"rewritten": n, "written": wanted}, None, entry)
    return {"rewritten": n, "written": wanted, "version": version}


def cluster_new(table: SnapshotTable, columns: list[str], target_bytes: int = 128 * MB) -> dict:
    """Cluster only the folders that earlier calls have not clustered; those written before stay untouched.

    A folder's name says whether it is clustered, so that neither the log's length nor a compaction in between matters."""
    entry = table._entry()
    fresh = [p for p in entry["paths"] if not _is_clustered(p)]
    if not fresh:
        return {"rewritten_folders": 0, "version": entry["version"]}
    size = list_files(table.spark, fresh, "*.parquet").agg(F.sum("length")).first()[0] or 0
    schema = table.schema()
    rows = table.spark.read.schema(schema).parquet(*fresh)
    new = table._write(cluster_by(rows, columns, _file_count(size, target_bytes)), CLUSTERED)
    paths = [p for p in entry["paths"] if _is_clustered(p)] + new
    version = table._record("cluster", schema, paths, {"clustered_folders": len(fresh)}, None, entry)
    return {"rewritten_folders": len(fresh), "version": version}


def hashed_timing(df: DataFrame) -> DataFrame:
    """Evaluate every column of every row and return one small row: for timing without a sink."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.max(F.xxhash64(*df.columns)).alias("hash"))
