"""Stored aggregates, metric definitions and alerts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.operators.partitions import PartitionedTable
from lakekit.operators.snapshots import SnapshotTable


class MaterialisedAggregate:
    """A stored query result that is stale until refreshed.

    ``query`` maps the source to the result, whose rows are identified by ``keys``; ``group_keys`` computes the same key
    columns on source rows. With that, ``refresh_touched`` recomputes only the groups that changed rows fall into, and in a
    ``PartitionedTable``, whose label is a function of the keys, rewrites only their partitions.
    """

    def __init__(self, table: SnapshotTable, query: Callable[[DataFrame], DataFrame], keys: Mapping[str, Column | str]):
        self.table, self.query = table, query
        self.keys = {k: F.expr(v) if isinstance(v, str) else v for k, v in keys.items()}

    def read(self) -> DataFrame:
        return self.table.read()

    def refresh(self, source: DataFrame) -> None:
        self.table.publish(self.query(source), "refresh")

    def refresh_touched(self, source: DataFrame, changed: DataFrame) -> None:
        """``changed`` holds new, old and deleted rows since the last refresh (both images of an update)."""
        names = list(self.keys)
        touched = changed.select(*[c.alias(k) for k, c in self.keys.items()]).distinct()
        tagged = source.select("*", *[c.alias(f"_g_{k}") for k, c in self.keys.items()])
        cond, hit = None, None
        for k in names:
            same = F.col(f"_g_{k}").eqNullSafe(F.col(f"_h_{k}"))
            cond = same if cond is None else cond & same
            old = F.col(k).eqNullSafe(F.col(f"_h_{k}"))
            hit = old if hit is None else hit & old
        renamed = touched.select(*[F.col(k).alias(f"_h_{k}") for k in names])
        again = self.query(tagged.join(renamed, cond, "left_semi").drop(*[f"_g_{k}" for k in names]))
        if isinstance(self.table, PartitionedTable):
            self.table.change(touched, lambda kept: kept.join(renamed, hit, "left_anti").unionByName(again), "incremental refresh")
        else:
            self.table.publish(self.read().join(renamed, hit, "left_anti").unionByName(again), "incremental refresh")


class MetricView:
    """Dimensions and measures defined once and evaluated from the source at whatever grain a query asks for.

    Measures are never re-aggregated from a finer result, so ratios and distinct counts stay right.
    """

    def __init__(self, source: DataFrame, dimensions: Mapping[str, str], measures: Mapping[str, str], where: str | None = None):
        self.source = source.where(where) if where else source
        self.dimensions, self.measures = dict(dimensions), dict(measures)

    def query(self, by: list[str], measures: list[str] | None = None, where: str | None = None) -> DataFrame:
        wanted = measures or list(self.measures)
        unknown = [n for n in (*by, *wanted) if n not in self.dimensions and n not in self.measures]
        if unknown:
            raise ValueError(f"not defined in this view: {unknown}")
        rows = self.source.withColumns({n: F.expr(e) for n, e in self.dimensions.items()})
        if where:
            rows = rows.where(where)
        return rows.groupBy(*by).agg(*[F.expr(self.measures[m]).alias(m) for m in wanted])


class StoredCube:
    """A stored aggregate whose sums and distinct counts can be re-aggregated to any coarser grain, and grow batch by batch.

    Cells hold sums per combination of the dimensions, and for each distinct count a mergeable sketch of fixed size. Beside them
    the distinct (dimensions, value) pairs are kept for exact counts: a count at a coarser grain counts the pairs made distinct again,
    map-side combined, and never adds counts up. The source is read once, when a batch is added.
    """

    def __init__(self, spark: SparkSession, path: str, dimensions: list[str], sums: Mapping[str, str], distinct: Mapping[str, str]):
        self.spark, self.path, self.dimensions = spark, path, list(dimensions)
        self.sums, self.distinct = dict(sums), dict(distinct)

    def add(self, rows: DataFrame) -> None:
        """Add a batch; adding the same batch twice counts its sums twice, as with any append."""
        sketches = [F.hll_sketch_agg(F.expr(e).cast("string")).alias(n) for n, e in self.distinct.items()]
        cells = rows.groupBy(*self.dimensions).agg(*[F.sum(F.expr(e)).alias(n) for n, e in self.sums.items()], *sketches)
        cells.write.mode("append").parquet(f"{self.path}/cells")
        for n, e in self.distinct.items():
            pairs = rows.select(*self.dimensions, F.expr(e).alias("_value")).where("_value IS NOT NULL").distinct()
            pairs.write.mode("append").parquet(f"{self.path}/pairs-{n}")

    def query(self, by: list[str], exact: bool = True) -> DataFrame:
        """Sums and distinct counts by some of the dimensions, from what is stored; not exact ones come from the sketches."""
        unknown = [c for c in by if c not in self.dimensions]
        if unknown:
            raise ValueError(f"no dimension of this cube: {unknown}")
        cells = self.spark.read.parquet(f"{self.path}/cells")
        near = [] if exact else [F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in self.distinct]
        out = cells.groupBy(*by).agg(*[F.sum(n).alias(n) for n in self.sums], *near)
        for n in self.distinct if exact else ():
            pairs = self.spark.read.parquet(f"{self.path}/pairs-{n}").select(*by, "_value").distinct()
            counts = pairs.groupBy(*[F.col(c).alias(f"_r_{c}") for c in by]).agg(F.count(F.lit(1)).alias(n))
            same = F.lit(True)
            for c in by:
                same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
            out = out.join(counts, same, "left") if by else out.join(F.broadcast(counts))  # one row without a grouping
            out = out.drop(*[f"_r_{c}" for c in by]).withColumn(n, F.coalesce(n, F.lit(0)))
        return out


def alert(value: DataFrame, operator: str, threshold: float) -> DataFrame:
    """One-row value against a threshold: ``OK`` or ``TRIGGERED``; a NULL value is ``UNKNOWN``."""
    v = F.col(value.columns[0])
    tests = {">": v > threshold, ">=": v >= threshold, "<": v < threshold, "<=": v <= threshold, "=": v == threshold, "<>": v != threshold}
    if operator not in tests:
        raise ValueError(f"unknown operator {operator}")
    state = F.when(v.isNull(), "UNKNOWN").when(tests[operator], "TRIGGERED").otherwise("OK")
    return value.select(v.alias("value"), F.lit(operator).alias("operator"), F.lit(float(threshold)).alias("threshold"), state.alias("status"))


def publish_kpis(table: SnapshotTable, kpis: DataFrame, published_at: str, keep_history: bool, enabled: bool = True) -> None:
    """Store one-row totals with their publish time, either replacing the last ones or adding to them. Switched off, nothing is computed."""
    if not enabled:
        return
    row = kpis.withColumn("published_at", F.lit(published_at))
    if keep_history:
        table.append(row)
    else:
        table.publish(row, "kpi snapshot")
