"""Row filters and column masks for an explicit principal: a user name and the groups the user is in."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Principal:
    user: str
    groups: frozenset[str] = field(default_factory=frozenset)

    def within(self, groups: Iterable[str]) -> bool:
        return bool(self.groups & set(groups))


def row_filter(
    df: DataFrame, principal: Principal, mapping: DataFrame, column: str, user: str = "user", value: str = "value",
    admins: Iterable[str] = ("admins",),
) -> DataFrame:
    """Rows the principal may see: all for admins, else those whose ``column`` the mapping grants to the user."""
    if principal.within(admins):
        return df
    granted = mapping.where(F.col(user) == principal.user).select(F.col(value).alias("_granted")).distinct()
    return df.join(granted, F.col(column) == F.col("_granted"), "left_semi")


# ---- masks: functions from a column to what others see


def mask_email(c: Column) -> Column:
    """First letter and domain; a text without @ shows its first letter only."""
    domain = F.when(F.contains(c, F.lit("@")), F.concat(F.lit("@"), F.substring_index(c, "@", -1))).when(c.isNotNull(), "")
    return F.concat(F.substring(c, 1, 1), F.lit("***"), domain)


def mask_last4(c: Column) -> Column:
    """Only the last four characters."""
    return F.concat(F.lit("****-"), F.right(c, F.lit(4)))


def mask_null(c: Column) -> Column:
    return F.nullif(c, c)


def mask_redacted(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit("REDACTED"))


Mask = Callable[[Column], Column]


def mask_columns(df: DataFrame, principal: Principal, masks: Mapping[str, Mask], exempt: Iterable[str] = ("admins",)) -> DataFrame:
    """Masked columns for everyone outside the exempt groups."""
    if principal.within(exempt):
        return df
    return df.withColumns({c: m(F.col(c)) for c, m in masks.items() if c in df.columns})


def mask_unless_granted(
    df: DataFrame, principal: Principal, column: str, mask: Mask, by: str, grants: DataFrame, user: str = "user",
    value: str = "value", exempt: Iterable[str] = ("admins",),
) -> DataFrame:
    """Mask that depends on another column: the clear value shows where the user is granted the row's ``by`` value."""
    if principal.within(exempt):
        return df
    mine = grants.where(F.col(user) == principal.user).select(F.col(value).alias("_granted"), F.lit(True).alias("_ok")).distinct()
    joined = df.join(mine, F.col(by) == F.col("_granted"), "left")
    shown = F.when(F.col("_ok"), F.col(column)).otherwise(mask(F.col(column)))
    return joined.withColumn(column, shown).select(*df.columns)


@dataclass(frozen=True)
class Policy:
    """Mask every column, or filter by every column, that carries a tag; ``exempt`` groups see everything."""

    tag: str
    mask: Mask | None = None
    keep: Callable[[Column, Principal], Column] | None = None
    exempt: frozenset[str] = field(default_factory=frozenset)


def apply_policies(df: DataFrame, tags: Mapping[str, Iterable[str]], policies: Iterable[Policy], principal: Principal) -> DataFrame:
    """``tags`` maps columns to their tags. Works for any table, also one made after the policies were. Filters see the
    unmasked values; a column with several masks is refused, as their order would matter."""
    policies = [p for p in policies if not principal.within(p.exempt)]
    tagged = {p: [c for c in df.columns if p.tag in set(tags.get(c, ()))] for p in policies}
    masks: dict[str, Column] = {}
    out = df
    for p, columns in tagged.items():
        for c in columns:
            if p.keep:
                out = out.where(F.coalesce(p.keep(F.col(c), principal), F.lit(False)))
            if p.mask:
                if c in masks:
                    raise ValueError(f"column {c} has more than one mask")
                masks[c] = p.mask(F.col(c))
    return out.withColumns(masks) if masks else out
