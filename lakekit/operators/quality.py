"""Row rules, quarantine, expectations, constraints and report checks.

A rule is a condition that good rows meet, given as SQL text or a column. A rule that evaluates to NULL counts as
violated everywhere in this module, so a row is either valid or quarantined and never lost between the two.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rule = str | Column
Rules = Mapping[str, Rule]


def holds(rule: Rule) -> Column:
    """The rule with NULL read as false."""
    return F.coalesce(F.expr(rule) if isinstance(rule, str) else rule, F.lit(False))


def tag_errors(df: DataFrame, rules: Rules, name: str = "dq_errors") -> DataFrame:
    """Add an array with the names of all violated rules; empty for good rows."""
    marks = [F.when(~holds(r), F.lit(n)) for n, r in rules.items()]
    return df.withColumn(name, F.array_compact(F.array(*marks)))


def first_error(df: DataFrame, rules: Rules, name: str = "dq_reason") -> DataFrame:
    """Add the name of the first violated rule in the order given; NULL for good rows."""
    return df.withColumn(name, F.coalesce(*[F.when(~holds(r), F.lit(n)) for n, r in rules.items()]))


def split(df: DataFrame, rules: Rules, name: str = "dq_errors") -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows (these with their errors); together they are the input."""
    tagged = tag_errors(df, rules, name)
    return tagged.where(F.size(name) == 0).drop(name), tagged.where(F.size(name) > 0)


def rule_report(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule with passed and failed rows, rules without failures included; one pass over the data."""
    names = list(rules)
    failed = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(~holds(rules[n])).alias(f"_{i}") for i, n in enumerate(names)]
    )
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"_{i}").alias("failed")) for i, n in enumerate(names)]))
    out = failed.select("_rows", each.alias("r"))
    return out.select("r.rule", (F.col("_rows") - F.col("r.failed")).alias("passed"), "r.failed")


@dataclass(frozen=True)
class Expectation:
    """``action``: warn keeps failing rows, drop removes them, fail stops the query."""

    name: str
    rule: Rule
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ("warn", "drop", "fail"):
            raise ValueError(f"unknown action {self.action}")


def expect_all(rules: Rules, action: str = "warn") -> list[Expectation]:
    return [Expectation(n, r, action) for n, r in rules.items()]


def apply_expectations(
    df: DataFrame, expectations: Iterable[Expectation], observation: Observation | None = None
) -> DataFrame:
    """Rows that survive. With an ``observation`` the failure counts come out of the same job."""
    expectations = list(expectations)
    if observation is not None:
        metrics = [F.count(F.lit(1)).alias("rows")]
        metrics += [F.count_if(~holds(e.rule)).alias(e.name) for e in expectations]
        df = df.observe(observation, *metrics)
    for e in expectations:
        if e.action == "fail":
            message = F.concat(F.lit(f"expectation {e.name} violated by "), F.to_json(F.struct(*df.columns)))
            df = df.where(F.when(holds(e.rule), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    for e in expectations:
        if e.action == "drop":
            df = df.where(holds(e.rule))
    return df


def expectation_metrics(df: DataFrame, expectations: Iterable[Expectation], dataset: str) -> DataFrame:
    """Passed and failed rows per expectation."""
    expectations = list(expectations)
    actions = {e.name: e.action for e in expectations}
    report = rule_report(df, {e.name: e.rule for e in expectations})
    action = F.create_map(*[F.lit(x) for pair in actions.items() for x in pair])
    return report.select(F.lit(dataset).alias("dataset"), "rule", action[F.col("rule")].alias("action"), "passed", "failed")


class ConstraintViolation(ValueError):
    pass


def assert_constraints(df: DataFrame, checks: Rules, not_null: Iterable[str] = ()) -> DataFrame:
    """Before a write: raise and write nothing when any row breaks a check or a required column is NULL."""
    rules = {**{f"{c} is not null": F.col(c).isNotNull() for c in not_null}, **checks}
    bad = rule_report(df, rules).where("failed > 0").collect()  # at most one row per rule
    if bad:
        raise ConstraintViolation("; ".join(f"{r['rule']}: {r['failed']} rows" for r in bad))
    return df


def checked(df: DataFrame, checks: Rules) -> DataFrame:
    """Same as constraints, but evaluated while the rows are written: the write fails as a whole."""
    return apply_expectations(df, expect_all(checks, "fail"))


# ---- rule families ------------------------------------------------------------------------------------------


def complete(*columns: str) -> dict[str, Column]:
    return {f"{c}_present": F.col(c).isNotNull() for c in columns}


def one_of(column: str, values: Iterable) -> dict[str, Column]:
    return {f"{column}_allowed": F.col(column).isin(list(values))}


def between(column: str, low, high) -> dict[str, Column]:
    return {f"{column}_in_range": F.col(column).between(low, high)}


def consistent(name: str, rule: Rule) -> dict[str, Rule]:
    return {name: rule}


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(df: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose (non-NULL) reference has no parent; ``on`` maps child to parent columns."""
    p = parent.select(*[F.col(b).alias(f"_p_{b}") for b in on.values()]).distinct()
    cond = None
    for a, b in on.items():
        same = F.col(a) == F.col(f"_p_{b}")
        cond = same if cond is None else cond & same
    present = df
    for a in on:
        present = present.where(F.col(a).isNotNull())
    return present.join(p, cond, "left_anti")


def freshness(df: DataFrame, ts: str, as_of: Column, max_age_seconds: int) -> DataFrame:
    """One row: newest time, its age against ``as_of`` and whether that is fresh enough."""
    newest = F.max(F.col(ts).cast("timestamp"))
    age = F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp(newest)
    return df.agg(newest.alias("newest"), age.alias("age_seconds")).withColumn(
        "fresh", F.coalesce(F.col("age_seconds") <= max_age_seconds, F.lit(False))
    )


def checklist(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Number of offending rows per check as one result, zero rows meaning OK."""
    out = None
    for name, bad in checks.items():
        part = bad.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("bad_rows"))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("status", F.when(F.col("bad_rows") == 0, "OK").otherwise("FAILED"))


def gate(problems: DataFrame, batches: DataFrame, batch: str, limit: int) -> DataFrame:
    """Decision per batch: ``held`` when it has more than ``limit`` problem rows, else ``released``."""
    bad = problems.groupBy(batch).agg(F.count(F.lit(1)).alias("bad_rows"))
    known = batches.select(batch).distinct().join(bad, batch, "left")
    n = F.coalesce("bad_rows", F.lit(0))
    return known.select(batch, n.alias("bad_rows"), F.when(n > limit, "held").otherwise("released").alias("decision"))


def released(df: DataFrame, decisions: DataFrame, batch: str) -> DataFrame:
    """Rows of all batches that are not held back."""
    return df.join(decisions.where("decision = 'held'").select(batch), batch, "left_anti")
