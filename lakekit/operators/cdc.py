"""Applying change events whose arrival order means nothing: the sequence column alone decides.

Both targets are derived from the deduplicated events, so late, repeated or re-batched events give the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.operators.quality import holds
from lakekit.operators.tables import change_feed
from lakekit.operators.windows import range_slices, slices_of, with_neighbours

START, END = "__START_AT", "__END_AT"


def _payload(events: DataFrame, keys: list[str], sequence_by: str, columns: list[str] | None, leave_out: list[str]) -> list[str]:
    wanted = columns or [c for c in events.columns if c not in leave_out]
    return [c for c in wanted if c not in keys and c != sequence_by]


def apply_changes_scd1(
    events: DataFrame,
    keys: list[str],
    sequence_by: str,
    *,
    deletes: str | None = None,
    truncates: str | None = None,
    ignore_null_updates: bool = False,
    columns: list[str] | None = None,
    leave_out: list[str] = (),
    tombstones: bool = False,
) -> DataFrame:
    """Current row per key. Everything is one map-side combined aggregation per key, so a busy key is no burden.

    With ``ignore_null_updates`` a NULL keeps the value of the last event before it, but nothing from before the
    key's last delete. With ``tombstones`` deleted keys stay as rows with ``_deleted`` set, and ``_sequence`` is kept:
    such a result can be fed back with newer events by ``continue_scd1``.
    """
    payload = _payload(events, keys, sequence_by, columns, list(leave_out))
    gone = holds(deletes) if deletes else F.lit(False)
    rows = events.select(*keys, *payload, F.col(sequence_by).alias("_sequence"), gone.alias("_deleted"), *(
        [holds(truncates).alias("_truncate")] if truncates else []
    ))
    if truncates:
        last = rows.where("_truncate").agg(F.max("_sequence").alias("s")).scalar()
        rows = rows.where(~F.col("_truncate") & (last.isNull() | (F.col("_sequence") > last))).drop("_truncate")
    return _latest(rows, keys, payload, ignore_null_updates, tombstones)


def _latest(rows: DataFrame, keys: list[str], payload: list[str], ignore_null: bool, tombstones: bool) -> DataFrame:
    if not ignore_null:
        # of equal sequence values a delete wins, then the greatest content: never the order of the rows
        best = F.max(F.struct("_sequence", "_deleted", *payload)).alias("b")
        out = rows.groupBy(*keys).agg(best).select(*keys, *(F.col("b")[c].alias(c) for c in (*payload, "_sequence", "_deleted")))
    else:
        ends = rows.where("_deleted").groupBy(*[F.col(k).alias(f"_e_{k}") for k in keys]).agg(
            F.max("_sequence").alias("_end")
        )
        cond = None
        for k in keys:
            same = F.col(k) == F.col(f"_e_{k}")
            cond = same if cond is None else cond & same
        alive = rows.join(ends, cond, "left").where(F.col("_end").isNull() | (F.col("_sequence") >= F.col("_end")))
        out = alive.groupBy(*keys).agg(
            *[F.max(F.when(~F.col("_deleted") & F.col(c).isNotNull(), F.struct("_sequence", F.col(c).alias("v"))))["v"].alias(c) for c in payload],
            F.max(F.struct("_sequence", "_deleted")).alias("_last"),
        )
        out = out.select(*keys, *payload, "_last._sequence", "_last._deleted")
    return out if tombstones else out.where(~F.col("_deleted")).drop("_sequence", "_deleted")


def continue_scd1(
    state: DataFrame, events: DataFrame, keys: list[str], sequence_by: str, *, deletes: str | None = None,
    leave_out: list[str] = (),
) -> DataFrame:
    """Next state (with tombstones) from the last one and newer, late or repeated events.

    Only keys that have events are touched; the others pass by a join that Spark broadcasts when the batch is small.
    """
    payload = [c for c in state.columns if c not in (*keys, "_sequence", "_deleted")]
    fresh = events.select(
        *keys, *payload, F.col(sequence_by).alias("_sequence"), (holds(deletes) if deletes else F.lit(False)).alias("_deleted")
    )
    touched = events.select(*keys).distinct()
    old = state.join(touched, keys, "left_semi")
    new = _latest(old.unionByName(fresh), keys, payload, False, True)
    return state.join(touched, keys, "left_anti").unionByName(new.select(*state.columns))


def apply_changes_scd2(
    events: DataFrame,
    keys: list[str],
    sequence_by: str,
    *,
    deletes: str | None = None,
    columns: list[str] | None = None,
    leave_out: list[str] = (),
    track: list[str] | None = None,
    bucket: Column | str | None = None,
) -> DataFrame:
    """Version history per key with half-open ``__START_AT`` / ``__END_AT`` (NULL for the current version).

    Only changes of the ``track`` columns (default: all) open a version; other columns are updated in place, so a version
    shows their last value. A delete closes the current version. ``bucket``, a non-decreasing function of the
    sequence column or ``windows.SAMPLED``, lets histories of very busy keys be worked on in slices.
    """
    payload = _payload(events, keys, sequence_by, columns, list(leave_out))
    tracked = track or payload
    gone = holds(deletes) if deletes else F.lit(False)
    # the sequence decides; of several events with one sequence the greatest content is taken
    once = events.select(*keys, F.col(sequence_by).alias("_seq"), F.struct(gone.alias("gone"), *payload).alias("p"))
    once = once.groupBy(*keys, "_seq").agg(F.max("p").alias("p"))
    rows = once.select(
        *keys, "_seq", "p", F.struct("p.gone", *[F.col("p").getField(c).alias(c) for c in tracked]).alias("_mark")
    )
    slice_ = None
    if isinstance(bucket, str):
        if slices_of(rows) > 1:
            rows, slice_ = range_slices(rows, keys, ["_seq"], "_slice_key"), F.col("_slice_key")
    elif bucket is not None:
        rows = rows.withColumn(sequence_by, F.col("_seq")).withColumn("_slice_key", bucket).drop(sequence_by)
        slice_ = F.col("_slice_key")
    rows = with_neighbours(rows, keys, ["_seq"], {"_before": "_mark"}, {"_after": "_mark", "_next": "_seq"}, slice_)
    # runs of equal tracked content: where one starts and where it ends
    rows = rows.withColumns(
        {
            "_first": F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.col("_mark")),
            "_last": F.col("_after").isNull() | ~F.col("_after").eqNullSafe(F.col("_mark")),
        }
    ).where((F.col("_first") | F.col("_last")) & ~F.col("p.gone"))
    rows = rows.withColumn("_tail", F.struct("p", F.col("_next").alias("end")))
    rows = with_neighbours(rows, keys, ["_seq"], None, {"_run_tail": "_tail"}, slice_)
    tail = F.when(F.col("_last"), F.col("_tail")).otherwise(F.col("_run_tail"))
    return rows.where("_first").select(
        *keys, *[tail.getField("p").getField(c).alias(c) for c in payload],
        F.col("_seq").alias(START), tail.getField("end").alias(END),
    )


def refresh_scd2(history: DataFrame, log: DataFrame, batch: DataFrame, keys: list[str], sequence_by: str, **options) -> DataFrame:
    """History after a batch of events that is already part of the event ``log``: only its keys are derived again."""
    touched = batch.select(*keys).distinct()
    again = apply_changes_scd2(log.join(touched, keys, "left_semi"), keys, sequence_by, **options)
    return history.join(touched, keys, "left_anti").unionByName(again.select(*history.columns))


def as_of(history: DataFrame, at, start: str = START, end: str = END) -> DataFrame:
    """Versions valid at a sequence value or time."""
    x = at if isinstance(at, Column) else F.lit(at)
    return history.where((F.col(start) <= x) & (F.col(end).isNull() | (F.col(end) > x)))


def changes_from_snapshots(before: DataFrame, after: DataFrame, keys: list[str], sequence) -> DataFrame:
    """Change events (``operation``, ``sequence_num`` and the row) that explain two full snapshots."""
    feed = change_feed(before, after, keys).where("_change_type <> 'update_preimage'")
    names = {"insert": "INSERT", "delete": "DELETE", "update_postimage": "UPDATE"}
    operation = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("_change_type")]
    return feed.select(*after.columns, operation.alias("operation"), F.lit(sequence).alias("sequence_num"))
