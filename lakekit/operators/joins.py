"""Join helpers that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.operators.windows import SAMPLED, range_slices


def _salt(n: int, by: list[str] | None, df: DataFrame) -> Column:
    # a stored hash of the row, not rand(): a retried task must put its rows into the same salt
    return F.pmod(F.xxhash64(*(by or df.columns)), F.lit(n)).cast("int")


def salted_join(
    big: DataFrame, small: DataFrame, keys: list[str], n: int = 16, how: str = "inner", salt_by: list[str] | None = None
) -> DataFrame:
    """Equi-join with ``big`` spread over ``n`` salts and ``small`` repeated once per salt.

    ``how`` may be inner, left, left_semi or left_anti: the kinds in which each big row needs only the small rows
    of its own salt. Pass unique columns as ``salt_by`` when big rows repeat.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("salting keeps its meaning for inner, left, left_semi and left_anti joins only")
    spread = big.withColumn("_salt", _salt(n, salt_by, big))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return spread.join(copies, [*keys, "_salt"], how).drop("_salt")


def hot_keys(df: DataFrame, keys: list[str], share: float, min_rows: int = 0) -> DataFrame:
    """Keys holding at least ``share`` of all rows (and ``min_rows``): never more than ``1 / share`` of them."""
    counts = df.groupBy(*keys).count()
    total = df.agg(F.count(F.lit(1)).alias("n"))
    hot = (F.col("count") >= F.lit(share) * total.scalar()) & (F.col("count") >= min_rows)
    return counts.where(hot).select(*keys)


def isolated_join(
    big: DataFrame, small: DataFrame, keys: list[str], share: float = 0.05, n: int = 16,
    salt_by: list[str] | None = None,
) -> DataFrame:
    """Inner join with the hot keys of ``big`` treated apart: salted there, plain elsewhere, then united."""
    # at most 1/share rows, so this broadcast cannot grow with the data
    hot = F.broadcast(hot_keys(big, keys, share))
    hot_part = salted_join(
        big.join(hot, keys, "left_semi"), small.join(hot, keys, "left_semi"), keys, n, salt_by=salt_by
    )
    cold_part = big.join(hot, keys, "left_anti").join(small, keys)
    return hot_part.unionByName(cold_part)


def lookup(
    facts: DataFrame, dim: DataFrame, keys: list[str], values: dict[str, object], flag: str | None = None
) -> DataFrame:
    """Left join keeping unknown members: missing ``values`` get their default, ``flag`` tells known from unknown."""
    cols = dim.select(*keys, *values, F.lit(True).alias("_hit"))
    out = facts.join(cols, keys, "left")
    known = F.coalesce(F.col("_hit"), F.lit(False))
    for name, default in values.items():
        out = out.withColumn(name, F.when(known, F.col(name)).otherwise(F.lit(default)))
    if flag:
        out = out.withColumn(flag, known)
    return out.drop("_hit")


def unique_on(dim: DataFrame, keys: list[str]) -> DataFrame:
    """``dim`` unchanged, failing the query when a key occurs twice (facts would fan out)."""
    counts = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    renamed = counts.where("_copies > 1").select(*[F.col(k).alias(f"_r_{k}") for k in keys], "_copies")
    cond = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = same if cond is None else cond & same
    checked = dim.join(renamed, cond, "left").drop(*[f"_r_{k}" for k in keys])
    message = F.concat(F.lit(f"duplicate dimension key {keys}: "), F.to_json(F.struct(*keys)))
    # the check sits in a filter so that column pruning cannot remove it
    ok = F.when(F.col("_copies").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return checked.where(ok).drop("_copies")


def self_pair_count(df: DataFrame, keys: list[str], differing: str) -> DataFrame:
    """Per key, how many ordered pairs ``a.key = b.key AND a.x <> b.x`` a self join has, without making them."""
    per_value = df.where(F.col(differing).isNotNull()).groupBy(*keys, differing).agg(F.count(F.lit(1)).alias("n"))
    for k in keys:
        per_value = per_value.where(F.col(k).isNotNull())
    n = F.col("n").cast("decimal(20,0)")
    pairs = F.sum(n) * F.sum(n) - F.sum(n * n)
    return per_value.groupBy(*keys).agg(pairs.cast("decimal(38,0)").alias("pairs")).where("pairs > 0")


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: list[str],
    ts: str,
    valid_from: str,
    valid_to: str,
    take: list[str],
    bucket: str | None = None,
) -> DataFrame:
    """Left point-in-time join to non-overlapping versions: ``valid_from <= ts AND (valid_to IS NULL OR ts < valid_to)``.

    Without ``bucket`` it is an equi-join with a range filter, which Spark may broadcast by size; each fact meets all
    versions of its key, so use it when keys have few versions. With ``bucket`` (an SQL expression over ``_ts``
    that never decreases with it, such as ``date_trunc('MONTH', _ts)``, or ``windows.SAMPLED``) facts and versions are laid into
    ordered time slices, the last version is carried forward inside a slice, and one summary row per slice carries it
    to the next: no key's rows are gathered and nothing is compared pairwise.
    """
    if bucket is None:
        v = versions.select(
            *[F.col(k).alias(f"_v_{k}") for k in keys],
            F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"), *take,
        )
        cond = (F.col("_from") <= F.col(ts)) & (F.col("_to").isNull() | (F.col(ts) < F.col("_to")))
        for k in keys:
            cond = cond & (F.col(k) == F.col(f"_v_{k}"))
        return facts.join(v, cond, "left").drop("_from", "_to", *[f"_v_{k}" for k in keys])

    fact_row = F.struct(*facts.columns)
    version = F.struct(F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"), *take)
    left = facts.select(*keys, F.col(ts).alias("_ts"), F.lit(1).alias("_kind"), fact_row.alias("_fact"))
    right = versions.select(
        *keys, F.col(valid_from).alias("_ts"), F.lit(0).alias("_kind"), version.alias("_version")
    )
    # an empty history [x, x) never matches but would hide the version before it
    right = right.where("_version._to IS NULL OR _version._to > _version._from")
    both = left.unionByName(right, allowMissingColumns=True)
    if bucket == SAMPLED:
        # facts of one time need no order among them, so that a hot time can be cut as well
        both = range_slices(both, keys, ["_ts", "_kind"], "_slice", within=[F.xxhash64("_fact")])
    else:
        both = both.withColumn("_slice", F.expr(bucket))
    inside = (
        Window.partitionBy(*keys, "_slice").orderBy("_ts", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = both.withColumn("_seen", F.last("_version", ignorenulls=True).over(inside))
    # one row per slice: its last version, if it has one
    slices = both.groupBy(*keys, "_slice").agg(
        F.max_by("_version", F.when(F.col("_kind") == 0, F.col("_ts"))).alias("_last")
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(*keys, "_slice", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    hit = F.coalesce("_seen", "_carried")
    out = rows.where("_kind = 1").join(slices, [*keys, "_slice"], "left").withColumn("_hit", hit)
    valid = F.col("_hit._to").isNull() | (F.col("_fact").getField(ts) < F.col("_hit._to"))
    return out.select(
        "_fact.*", *[F.when(valid, F.col("_hit").getField(c)).alias(c) for c in take]
    )
