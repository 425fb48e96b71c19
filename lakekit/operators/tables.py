"""Row-level changes to a table, as functions from frames to the table's next content."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.operators.quality import holds


def update(df: DataFrame, predicate: str | Column, values: dict[str, str | Column]) -> DataFrame:
    """Set columns where the predicate is true; all right-hand sides see the old row."""
    hit = holds(predicate)
    new = {c: F.expr(v) if isinstance(v, str) else v for c, v in values.items()}
    types = dict(df.dtypes)
    return df.select(
        *[F.when(hit, new[c]).otherwise(F.col(c)).cast(types[c]).alias(c) if c in new else F.col(c) for c in df.columns]
    )


def update_where_in(
    df: DataFrame, keys: list[str], subquery: DataFrame, values: dict[str, str | Column]
) -> DataFrame:
    """Update the rows whose key occurs in ``subquery``."""
    marked = df.join(subquery.select(*keys).distinct().withColumn("_hit", F.lit(True)), keys, "left")
    return update(marked, "_hit", values).select(*df.columns)


def delete(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Remove rows for which the predicate is true; rows where it is NULL stay."""
    return df.where(~holds(predicate))


def replace_where(target: DataFrame, new: DataFrame, predicate: str) -> DataFrame:
    """Replace exactly the rows meeting the predicate; a new row outside it fails the query."""
    message = F.concat(F.lit(f"row outside {predicate}: "), F.to_json(F.struct(*new.columns)))
    inside = F.when(holds(predicate), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return delete(target, predicate).unionByName(new.where(inside).select(*target.columns))


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-only upsert: append one row for every key the target does not have; safe to repeat.

    A source row with a NULL in its key matches nothing, so it would be added by every run; such rows are left out.
    """
    fresh = source.dropna(subset=keys).dropDuplicates(keys).join(_hits(target, source, keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


# ---- merge --------------------------------------------------------------------------------------------------


class MergeError(ValueError):
    pass


@dataclass(frozen=True)
class When:
    """One merge clause. Conditions and values are SQL text over ``t`` (target row) and ``s`` (source row);
    ``values`` of ``"*"`` takes every target column from the source column of the same name."""

    match: str  # matched, not_matched, not_matched_by_source
    action: str  # update, delete, insert
    condition: str | None = None
    values: dict[str, str] | str | None = None


def matched_update(values: dict[str, str] | str = "*", condition: str | None = None) -> When:
    return When("matched", "update", condition, values)


def matched_delete(condition: str | None = None) -> When:
    return When("matched", "delete", condition)


def not_matched_insert(values: dict[str, str] | str = "*", condition: str | None = None) -> When:
    return When("not_matched", "insert", condition, values)


def missing_update(values: dict[str, str], condition: str | None = None) -> When:
    """For target rows absent from the source."""
    return When("not_matched_by_source", "update", condition, values)


def missing_delete(condition: str | None = None) -> When:
    """For target rows absent from the source."""
    return When("not_matched_by_source", "delete", condition)


def _hits(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    # a small source makes this a broadcast semi join: the target is then only scanned, on its key columns
    return target.select(*keys).join(source.select(*keys).distinct(), keys, "left_semi").distinct()


def _same(names: list[str], left: str, right: str) -> Column:
    cond = None
    for n in names:
        same = F.col(f"{left}{n}") == F.col(f"{right}{n}")
        cond = same if cond is None else cond & same
    return cond


def merge_actions(
    target: DataFrame, source: DataFrame, on: list[str], clauses: list[When], evolve: bool = False
) -> DataFrame:
    """All resulting rows with their ``_action``: kept, updated, deleted (old content) or inserted.

    The first clause whose condition holds decides. Keys compare with ``=``, so NULL keys never match. More than one
    source row for a target row fails the query when there are clauses for matched rows: make the source unique
    first. The target is joined once, from its own side, so Spark can broadcast a source that its size check
    finds small and leave the target unshuffled; inserts only need the target's key columns.
    """
    if evolve:
        for field in source.schema.fields:
            if field.name not in target.columns:
                target = target.withColumn(field.name, F.lit(None).cast(field.dataType))
    columns, types = target.columns, dict(target.dtypes)

    def row(values: dict[str, str] | str, old: bool) -> Column:
        if values == "*":
            absent = [c for c in columns if c not in source.columns]
            if absent and not (evolve and old):
                raise MergeError(f"the source has no column {absent} to take for '*'")
            values = {c: f"s.`{c}`" for c in columns if c in source.columns}
        unknown = [c for c in values if c not in columns]
        if unknown:
            raise MergeError(f"the target has no column {unknown}")
        rest = (lambda c: F.col(f"t.{c}")) if old else (lambda c: F.lit(None))
        return F.struct(
            *[(F.expr(values[c]) if c in values else rest(c)).cast(types[c]).alias(c) for c in columns]
        )

    def chain(kind: str):
        return [c for c in clauses if c.match == kind]

    on_match, on_insert, on_missing = chain("matched"), chain("not_matched"), chain("not_matched_by_source")
    t = target.select(F.struct(*columns).alias("t"), *[F.col(k).alias(f"_t_{k}") for k in on])
    kept = F.col("t")
    if on_match or on_missing:
        s = source.select(F.struct(*source.columns).alias("s"), *[F.col(k).alias(f"_s_{k}") for k in on])
        copies = (
            source.groupBy(*[F.col(k).alias(f"_c_{k}") for k in on])
            .agg(F.count(F.lit(1)).alias("_copies"))
            .where("_copies > 1")
        )
        s = s.join(copies, _same(on, "_s_", "_c_"), "left").drop(*[f"_c_{k}" for k in on])
        joined = t.join(s.withColumn("_hit", F.lit(True)), _same(on, "_t_", "_s_"), "left")
        hit = F.col("_hit").isNotNull()
        action, content = F.lit("kept"), kept
        for c in reversed([*on_match, *on_missing]):
            fires = (hit if c.match == "matched" else ~hit) & (holds(c.condition) if c.condition else F.lit(True))
            if c.action == "update":
                action = F.when(fires, "updated").otherwise(action)
                content = F.when(fires, row(c.values, True)).otherwise(content)
            else:
                action = F.when(fires, "deleted").otherwise(action)
                content = F.when(fires, kept).otherwise(content)
        if on_match:
            message = F.concat(F.lit("several source rows match one target row, key "), F.to_json(
                F.struct(*[F.col(f"_t_{k}").alias(k) for k in on])
            ))
            fine = F.when(F.col("_copies").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
            joined = joined.where(fine)
        out = joined.select(action.alias("_action"), content.alias("r"))
    else:
        out = t.select(F.lit("kept").alias("_action"), kept.alias("r"))
    if on_insert:
        fresh = source.join(_hits(target, source, on), on, "left_anti").select(F.struct(*source.columns).alias("s"))
        content, fires_any = F.lit(None).cast(target.schema), F.lit(False)
        for c in reversed(on_insert):
            fires = holds(c.condition) if c.condition else F.lit(True)
            content = F.when(fires, row(c.values, False)).otherwise(content)
            fires_any = fires | fires_any
        out = out.unionByName(fresh.where(fires_any).select(F.lit("inserted").alias("_action"), content.alias("r")))
    return out.select("_action", "r.*")


def merge(
    target: DataFrame, source: DataFrame, on: list[str], clauses: list[When], evolve: bool = False
) -> DataFrame:
    """The target's content after the merge."""
    return merge_actions(target, source, on, clauses, evolve).where("_action <> 'deleted'").drop("_action")


def merge_metrics(actions: DataFrame) -> DataFrame:
    """One row of operation metrics."""
    a = F.col("_action")
    return actions.agg(
        F.count_if(a == "updated").alias("updated"), F.count_if(a == "inserted").alias("inserted"),
        F.count_if(a == "deleted").alias("deleted"), F.count_if(a == "kept").alias("kept"),
    )


def upsert_newer(target: DataFrame, source: DataFrame, on: list[str], newer: str) -> DataFrame:
    """Update matched rows only when the source's ``newer`` column is greater, insert the rest; safe to repeat."""
    return merge(target, source, on, [matched_update("*", f"s.`{newer}` > t.`{newer}`"), not_matched_insert("*")])


def upsert_adding(target: DataFrame, source: DataFrame, on: list[str], amounts: list[str]) -> DataFrame:
    """Add the source's amounts to matched rows, insert new keys."""
    plus = {c: f"t.`{c}` + s.`{c}`" for c in amounts}
    return merge(target, source, on, [matched_update(plus), not_matched_insert("*")])


# ---- schema -------------------------------------------------------------------------------------------------


class SchemaMismatch(ValueError):
    pass


def enforce_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Frame with exactly the table's columns: extra columns and other types are refused, missing nullable ones are
    filled with NULL."""
    wanted = {f.name: f for f in schema.fields}
    extra = [c for c in df.columns if c not in wanted]
    if extra:
        raise SchemaMismatch(f"unknown columns {extra}")
    have = dict(zip(df.columns, df.schema.fields, strict=True))
    out = []
    for name, field in wanted.items():
        if name not in have:
            if not field.nullable:
                raise SchemaMismatch(f"column {name} is required")
            out.append(F.lit(None).cast(field.dataType).alias(name))
        elif have[name].dataType != field.dataType:
            raise SchemaMismatch(f"column {name} is {have[name].dataType.simpleString()}, not {field.dataType.simpleString()}")
        else:
            out.append(F.col(name))
    return df.select(*out)


def evolve_schema(current: StructType, incoming: StructType) -> StructType:
    """Current schema plus new nullable columns; a changed type is refused."""
    merged = StructType(list(current.fields))
    known = {f.name: f for f in current.fields}
    for f in incoming.fields:
        if f.name not in known:
            merged = merged.add(f.name, f.dataType, True)
        elif known[f.name].dataType != f.dataType:
            raise SchemaMismatch(f"column {f.name} changes from {known[f.name].dataType.simpleString()} to {f.dataType.simpleString()}")
    return merged


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Order columns as in ``schema`` and add the missing ones as NULL."""
    return df.select(
        *[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


# ---- change feed --------------------------------------------------------------------------------------------


def change_feed(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Changes that lead from one version to the next, with ``_change_type`` insert, delete, update_preimage or
    update_postimage. Keys are unique and not NULL in both versions. A column that only one version has is NULL in the other."""
    kinds = {f.name: f.dataType for f in (*before.schema.fields, *after.schema.fields)}
    columns = [*after.columns, *(c for c in before.columns if c not in after.columns)]
    before, after = (v.withColumns({c: F.lit(None).cast(kinds[c]) for c in columns if c not in v.columns}) if set(columns) - set(v.columns) else v
                     for v in (before, after))
    old = before.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.struct(*columns).alias("b"))
    new = after.select(*[F.col(k).alias(f"_a_{k}") for k in keys], F.struct(*columns).alias("a"))
    both = old.join(new, _same(keys, "_b_", "_a_"), "full")

    def change(kind: str, side: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(side).alias("r"))

    changes = (
        F.when(F.col("b").isNull(), F.array(change("insert", "a")))
        .when(F.col("a").isNull(), F.array(change("delete", "b")))
        .when(~F.col("a").eqNullSafe(F.col("b")), F.array(change("update_preimage", "b"), change("update_postimage", "a")))
    )
    return both.select(F.explode(changes).alias("c")).select("c._change_type", "c.r.*")


def apply_feed(before: DataFrame, feed: DataFrame, keys: list[str]) -> DataFrame:
    """Version that results from applying a change feed to the version it starts from."""
    gone = feed.where("_change_type IN ('update_preimage', 'delete')").select(*keys)
    added = feed.where("_change_type IN ('update_postimage', 'insert')").drop("_change_type")
    return before.join(gone, keys, "left_anti").unionByName(added)
