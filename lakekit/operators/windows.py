"""Window results that do not put a whole group into one task.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. The functions here cut each group
into ordered slices with a caller-given ``bucket`` expression that never decreases along the sort order (a month of
the date, a price band). Each slice is windowed by itself, the slices are summarised to one row each, a second,
small window over those summaries supplies what came before, and both are added up. Results equal the plain
window's exactly. Without a ``bucket`` the plain window is used: right for groups known to be small.

Order columns are names; a leading ``-`` means descending. The bucket follows the row order, for NULLs as well: it
is a function of the leading order column, or a struct over the first few. For ranks, ties are counted instead of being gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.session import stored

_B = "_slice"


def order_columns(order: list[str]) -> list[Column]:
    return [F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc() for o in order]


def _names(order: list[str]) -> list[str]:
    return [o.lstrip("-") for o in order]


def _slice_order(order: list[str]) -> Column:
    # Spark sorts NULLs first when ascending and last when descending; slices must follow the rows
    return F.col(_B).asc_nulls_last() if order[0].startswith("-") else F.col(_B).asc_nulls_first()


def _null_safe(names: list[str], left: str, right: str) -> Column:
    cond = None
    for n in names:
        same = F.col(f"{left}{n}").eqNullSafe(F.col(f"{right}{n}"))
        cond = same if cond is None else cond & same
    return cond


def even_slices(df: DataFrame, column: str, n: int) -> Column:
    """Bucket that cuts the range of a non-negative whole-number column into ``n`` equal widths."""
    top = df.agg(F.max(column)).scalar()
    return F.floor(F.col(column) * F.lit(n) / (top + 1))


#: As a ``bucket``: slices of about ``SLICE_ROWS`` rows with edges from a sample of the rows.
SAMPLED = "sampled"
SLICE_ROWS = 1 << 20


def slices_of(df: DataFrame, rows: int | None = None) -> int:
    """How many slices of ``SLICE_ROWS`` (or ``rows``) rows a frame has; with one, the plain window holds no more than that."""
    return max(1, -(-df.count() // (rows or SLICE_ROWS)))


def range_slices(df: DataFrame, keys: list[str], order: list[str], name: str = _B, rows: int | None = None, within: list[Column] = ()) -> DataFrame:
    """The rows with the number of their slice; several slices are stored, so that every use sees the same ones.

    Slices are ranges of (keys, order) with about ``rows`` rows each; the edges come from a sample, the number of slices from a
    count. A hot key gets as many slices as its share of the rows asks for, wherever its values lie; small keys share
    a slice. Rows with equal keys and order are in one slice, unless ``within`` has columns that follow the order in effect.
    """
    n = slices_of(df, rows)
    if n == 1:
        return df.withColumn(name, F.lit(0))
    edges = [*(F.col(k) for k in keys), *order_columns(order), *within]
    return stored(df.repartitionByRange(n, *edges).withColumn(name, F.spark_partition_id()), "slices")


def _only_cut(slices: DataFrame, keys: list[str]) -> DataFrame:
    """Slices of groups that have several; the others have nothing to carry, so what is joined back is small."""
    return slices.withColumn("_parts", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where("_parts > 1").drop("_parts")


def _join_slices(rows: DataFrame, slices: DataFrame, keys: list[str], not_null: bool) -> DataFrame:
    cols = [*keys, _B]
    if not_null:
        return rows.join(slices, cols, "left")
    renamed = slices.select(
        *[F.col(c).alias(f"_r_{c}") for c in cols], *[c for c in slices.columns if c not in cols]
    )
    return rows.join(renamed, _null_safe(cols, "", "_r_"), "left").drop(*[f"_r_{c}" for c in cols])


def with_ranks(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    bucket: Column | str | None = None,
    *,
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    percent_rank: str | None = None,
    ntile: tuple[int, str] | None = None,
    total: str | None = None,
    not_null: bool = False,
) -> DataFrame:
    """Add rank-like columns under the given names; ``not_null`` promises non-NULL keys and bucket."""
    if isinstance(bucket, str) and slices_of(df) == 1:
        bucket = None
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order_columns(order))
        named = {
            row_number: F.row_number(),
            rank: F.rank(),
            dense_rank: F.dense_rank(),
            percent_rank: F.percent_rank(),
            **({ntile[1]: F.ntile(ntile[0])} if ntile else {}),
        }
        new = {n: fn.over(w) for n, fn in named.items() if n}
        if total:
            new[total] = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        return df.withColumns(new)
    out = df
    if rank or dense_rank or percent_rank:
        out = _rank_values(out, keys, order, bucket, rank, dense_rank, percent_rank)
    if isinstance(bucket, str) and (row_number or ntile or total):
        out, bucket = range_slices(out, keys, order), F.col(_B)
    if row_number or ntile or total:
        out = _number_rows(out, keys, order, bucket, row_number, ntile, total, not_null)
    return out


def _rank_values(df, keys, order, bucket, rank, dense_rank, percent_rank) -> DataFrame:
    """Ranks depend on the order values only: they are found on the distinct values, whose counts are combined
    map-side, and joined back. However many rows tie, no task has to hold them."""
    names = list(dict.fromkeys(_names(order)))
    values = df.groupBy(*keys, *[n for n in names if n not in keys]).agg(F.count(F.lit(1)).alias("_n"))
    values = values.withColumn("_one", F.lit(1))
    sums = {"_upto": "_n", "_upto_distinct": "_one"}
    values = with_running_sum(values, keys, order, sums, bucket)
    if percent_rank:
        values = with_group_total(values, keys, {"_total": F.sum("_n")})
    rk = F.col("_upto") - F.col("_n") + 1
    new = {}
    if rank:
        new[rank] = rk
    if dense_rank:
        new[dense_rank] = F.col("_upto_distinct")
    if percent_rank:
        new[percent_rank] = F.when(F.col("_total") > 1, (rk - 1) / (F.col("_total") - 1)).otherwise(F.lit(0.0))
    on = [*keys, *[n for n in names if n not in keys]]
    ranks = values.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c.alias(n) for n, c in new.items()])
    return df.join(ranks, _null_safe(on, "", "_r_"), "left").drop(*[f"_r_{c}" for c in on])


def _number_rows(df, keys, order, bucket, row_number, ntile, total, not_null) -> DataFrame:
    b = df.withColumn(_B, bucket)
    inside = Window.partitionBy(*keys, _B).orderBy(*order_columns(order))
    rows = b.withColumn("_rn", F.row_number().over(inside))
    slices = b.groupBy(*keys, _B).agg(F.count(F.lit(1)).alias("_n"))
    before = (
        Window.partitionBy(*keys).orderBy(_slice_order(order)).rowsBetween(Window.unboundedPreceding, -1)
    )
    slices = slices.select(
        *keys,
        _B,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
    )
    out = _join_slices(rows, slices, keys, not_null)
    rn, n = F.col("_before") + F.col("_rn"), F.col("_total")
    new = {}
    if row_number:
        new[row_number] = rn
    if ntile:
        parts, name = ntile
        base, extra = F.floor(n / parts), n % parts
        head = extra * (base + 1)
        new[name] = F.when(rn <= head, F.floor((rn - 1) / (base + 1)) + 1).otherwise(
            extra + F.floor((rn - 1 - head) / F.nullif(base, F.lit(0))) + 1
        )
    if total:
        new[total] = n
    return out.withColumns(new).drop(_B, "_rn", "_before", "_total")


def with_running_sum(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, str],
    bucket: Column | str | None = None,
    not_null: bool = False,
) -> DataFrame:
    """Running totals (rows up to and including the current one); ``sums`` maps new name to column."""
    if isinstance(bucket, str) and slices_of(df) == 1:
        bucket = None
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order_columns(order))
        w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({n: F.sum(c).over(w) for n, c in sums.items()})
    if isinstance(bucket, str):
        df, bucket = range_slices(df, keys, order), F.col(_B)
    b = df.withColumn(_B, bucket)
    inside = (
        Window.partitionBy(*keys, _B)
        .orderBy(*order_columns(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = b.withColumns({f"_in_{n}": F.sum(c).over(inside) for n, c in sums.items()})
    slices = b.groupBy(*keys, _B).agg(*[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()])
    before = (
        Window.partitionBy(*keys).orderBy(_slice_order(order)).rowsBetween(Window.unboundedPreceding, -1)
    )
    slices = _only_cut(slices, keys).select(*keys, _B, *[F.sum(f"_s_{n}").over(before).alias(f"_pre_{n}") for n in sums])
    out = _join_slices(rows, slices, keys, not_null)
    for n in sums:
        mine, pre = F.col(f"_in_{n}"), F.col(f"_pre_{n}")
        out = out.withColumn(n, F.coalesce(mine + pre, mine, pre))
    return out.drop(_B, *[f"_in_{n}" for n in sums], *[f"_pre_{n}" for n in sums])


def with_neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    bucket: Column | str | None = None,
    not_null: bool = False,
) -> DataFrame:
    """``lag`` / ``lead`` by one row: each mapping goes from new column name to source column."""
    previous, following = previous or {}, following or {}
    if isinstance(bucket, str) and slices_of(df) == 1:
        bucket = None
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order_columns(order))
        return df.withColumns(
            {
                **{n: F.lag(c).over(w) for n, c in previous.items()},
                **{n: F.lead(c).over(w) for n, c in following.items()},
            }
        )
    if isinstance(bucket, str):
        df, bucket = range_slices(df, keys, order), F.col(_B)
    w = Window.partitionBy(*keys, _B).orderBy(*order_columns(order))
    rows = df.withColumn(_B, bucket).withColumns(
        {
            "_rn": F.row_number().over(w),
            "_n": F.count(F.lit(1)).over(Window.partitionBy(*keys, _B)),
            **{f"_in_{n}": F.lag(c).over(w) for n, c in previous.items()},
            **{f"_in_{n}": F.lead(c).over(w) for n, c in following.items()},
        }
    )
    ends = rows.where((F.col("_rn") == 1) | (F.col("_rn") == F.col("_n")))
    # one row per slice: its first and its last row's values
    slices = ends.groupBy(*keys, _B).agg(
        *[F.max_by(F.struct(c), "_rn").alias(f"_e_{n}") for n, c in previous.items()],
        *[F.min_by(F.struct(c), "_rn").alias(f"_e_{n}") for n, c in following.items()],
    )
    across = Window.partitionBy(*keys).orderBy(_slice_order(order))
    slices = _only_cut(slices, keys).select(
        *keys,
        _B,
        *[F.lag(f"_e_{n}").over(across).getField(c).alias(f"_x_{n}") for n, c in previous.items()],
        *[F.lead(f"_e_{n}").over(across).getField(c).alias(f"_x_{n}") for n, c in following.items()],
    )
    out = _join_slices(rows, slices, keys, not_null)
    first, last = F.col("_rn") == 1, F.col("_rn") == F.col("_n")
    out = out.withColumns(
        {
            **{n: F.when(first, F.col(f"_x_{n}")).otherwise(F.col(f"_in_{n}")) for n in previous},
            **{n: F.when(last, F.col(f"_x_{n}")).otherwise(F.col(f"_in_{n}")) for n in following},
        }
    )
    made = [*previous, *following]
    return out.drop(_B, "_rn", "_n", *[f"_in_{n}" for n in made], *[f"_x_{n}" for n in made])


def with_group_total(df: DataFrame, keys: list[str], totals: dict[str, Column]) -> DataFrame:
    """Attach whole-group aggregates: pre-aggregate, then join, so a hot group is never gathered."""
    summary = df.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()])
    renamed = summary.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *totals)
    return df.join(renamed, _null_safe(keys, "", "_r_"), "left").drop(*[f"_r_{k}" for k in keys])


def qualify(df: DataFrame, value: Column, predicate: str, name: str = "_q", keep: bool = False) -> DataFrame:
    """Filter on a window value. ``row_number/rank <= k`` predicates become per-group limits that Spark also
    applies before the shuffle, so hot groups shrink to k rows per task."""
    out = df.withColumn(name, value).where(predicate)
    return out if keep else out.drop(name)


def top_k(df: DataFrame, keys: list[str], order: list[str], k: int, ties: str | None = None) -> DataFrame:
    """First ``k`` rows per group; ``ties`` may be ``rank`` or ``dense_rank`` to keep equal rows."""
    w = Window.partitionBy(*keys).orderBy(*order_columns(order))
    fn = {None: F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[ties]
    return qualify(df, fn().over(w), f"_q <= {int(k)}")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` values per key; map-side combined, so hot keys stay small.

    Of rows with equal order values the one with the greatest content is taken, whatever order they come in.
    """
    best = F.max_by(F.struct(*df.columns), F.struct(F.struct(*order), F.struct(*df.columns))).alias("_best")
    return df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(best).select("_best.*")


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], bucket: Column | str | None = SAMPLED,
    counts: str | None = None,
) -> DataFrame:
    """Exact interpolated quantiles per group through ranks, so that no group is held in one task.

    ``probs`` maps output names to probabilities. NULL values are ignored, as ``percentile`` does. Equal values are counted
    first, so a group's size is its number of different values, and groups with many are sliced. ``bucket`` of None takes
    the plain window, where these come from a limited range (seconds, cents). ``counts`` is a column with the number of rows
    that a row stands for.
    """
    known = df.where(F.col(value).isNotNull())
    counts = known.groupBy(*keys, value).agg((F.sum(counts) if counts else F.count(F.lit(1))).alias("_n"))
    if bucket is None:
        group = Window.partitionBy(*keys)
        ordered = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = counts.withColumns({"_upto": F.sum("_n").over(ordered), "_cnt": F.sum("_n").over(group)})
    else:
        upto = with_running_sum(counts, keys, [value], {"_upto": "_n"}, bucket)
        placed = with_group_total(upto, keys, {"_cnt": F.sum("_n")})

    def covers(position: Column) -> Column:
        return ((position > F.col("_upto") - F.col("_n")) & (position <= F.col("_upto"))).cast("double")

    aggs = []
    for name, p in probs.items():
        at = (F.col("_cnt") - 1) * F.lit(float(p)) + 1
        low, weight = F.floor(at), at - F.floor(at)
        share = covers(low) * (1 - weight) + covers(low + 1) * weight
        aggs.append(F.sum(F.col(value).cast("double") * share).alias(name))
    return placed.groupBy(*keys).agg(*aggs)
