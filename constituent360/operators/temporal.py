"""History, incremental loads, change audit, retention and restricted views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from constituent360.functions.dates import day
from constituent360.sources.writers import KeyedTable

OPEN_END = dt.date(9999, 12, 31)


def scd2_start(snapshot: DataFrame, as_of) -> DataFrame:
    """First history: every row current from the given date."""
    return snapshot.withColumns(
        {
            "effective_date": day(as_of), "end_date": F.lit(OPEN_END), "is_current": F.lit(True),
            "change_reason": F.lit("initial"),
        }
    )


def scd2_merge(history: DataFrame, snapshot: DataFrame, keys: Sequence[str], attrs: Sequence[str], as_of) -> DataFrame:
    """Bring a type-2 history up to a snapshot. A changed row closes its current version and opens a new
    one, a vanished key closes, a new key opens; older versions pass through. One full outer join on
    the key, unique on both sides."""
    keys, attrs = list(keys), list(attrs)
    columns = [*keys, *attrs, "effective_date", "end_date", "is_current", "change_reason"]
    current = history.where("is_current").select(
        *keys, F.struct(*attrs).alias("_old"), F.col("effective_date").alias("_since"), F.col("change_reason").alias("_why"), F.lit(True).alias("_was"),
    )
    latest = snapshot.select(*keys, F.struct(*attrs).alias("_new"), F.lit(True).alias("_is"))
    both = current.join(latest, keys, "full")
    was, now = F.coalesce("_was", F.lit(False)), F.coalesce("_is", F.lit(False))
    same = was & now & F.col("_old").eqNullSafe(F.col("_new"))

    def version(values, since, end, is_current, why):
        return F.struct(values.alias("v"), since.alias("s"), end.alias("e"), is_current.alias("c"), why.alias("r"))

    open_end = F.lit(OPEN_END)
    kept = version(F.col("_old"), F.col("_since"), open_end, F.lit(True), F.col("_why"))
    closed = version(F.col("_old"), F.col("_since"), day(as_of), F.lit(False), F.col("_why"))
    opened = version(F.col("_new"), day(as_of), open_end, F.lit(True), F.when(was, "changed").otherwise("new"))
    versions = (
        F.when(same, F.array(kept)).when(was & now, F.array(closed, opened)).when(was, F.array(closed)).otherwise(F.array(opened))
    )
    moved = both.select(*keys, F.explode(versions).alias("x")).select(
        *keys, *[F.col(f"x.v.{a}").alias(a) for a in attrs], F.col("x.s").alias("effective_date"),
        F.col("x.e").alias("end_date"), F.col("x.c").alias("is_current"), F.col("x.r").alias("change_reason"),
    )
    return history.where("NOT is_current").select(*columns).unionByName(moved)


def as_of(history: DataFrame, when) -> DataFrame:
    """The versions in force on a date."""
    return history.where((F.col("effective_date") <= day(when)) & (day(when) < F.col("end_date")))


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, by an aggregate that combines on the map side."""
    others = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_r")).select(*keys, "_r.*").select(*rows.columns)


def changed_since(source: DataFrame, modified: str, low, high) -> DataFrame:
    """Rows modified after the last watermark, up to the new one."""
    rows = source.where(F.col(modified) <= F.lit(high))
    return rows if low is None else rows.where(F.col(modified) > F.lit(low))


def incremental_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], modified: str, low, high, tie: Sequence[str] = ()
) -> DataFrame:
    """The target after applying the rows of one watermark interval; running it again changes nothing."""
    fresh = latest_per_key(changed_since(source, modified, low, high), list(keys), [modified, *tie])
    kept = target.join(fresh.select(*keys), list(keys), "left_anti")
    return kept.select(*fresh.columns).unionByName(fresh)


def upsert_into(table: KeyedTable, source: DataFrame, modified: str, low, high, tie: Sequence[str] = ()) -> None:
    """The same for a stored table: only the folders that the changed rows fall into are read and replaced."""
    fresh = latest_per_key(changed_since(source, modified, low, high), table.keys, [modified, *tie])
    table.upsert(fresh, lambda old, new: old.join(new.select(*table.keys), table.keys, "left_anti").select(new.columns).unionByName(new))


def change_log(
    before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str], *, who: str, why: str, where: str, when
) -> DataFrame:
    """One row per changed field: who, what (old and new value), when, why and where."""
    keys = list(keys)
    old = before.select(*keys, F.struct(*columns).alias("_old"))
    new = after.select(*keys, F.struct(*columns).alias("_new"))
    fields = F.array(
        *[
            F.struct(
                F.lit(c).alias("field"), F.col(f"_old.{c}").cast("string").alias("old_value"), F.col(f"_new.{c}").cast("string").alias("new_value")
            )
            for c in columns
        ]
    )
    changed = F.filter(fields, lambda f: ~f["old_value"].eqNullSafe(f["new_value"]))
    return old.join(new, keys, "full").select(*keys, F.explode(changed).alias("f")).select(
        *keys, "f.*", F.lit(who).alias("changed_by"), F.lit(when).alias("changed_at"), F.lit(why).alias("reason"), F.lit(where).alias("process")
    )


@dataclass(frozen=True)
class Retention:
    """How long rows of a category are kept and what happens then: delete, anonymise or aggregate."""

    years: int
    action: str
    personal: tuple[str, ...] = ()
    group: tuple[str, ...] = ()
    measures: dict[str, str] = field(default_factory=dict)


# The retention schedule.
SCHEDULE = {
    "donations": Retention(7, "delete"),
    "contacts": Retention(3, "anonymise", ("canonical_email", "canonical_first_name", "canonical_last_name")),
    "email_engagement": Retention(3, "aggregate", group=("email_type",)),
    "events": Retention(5, "delete"),
    "logs": Retention(1, "delete"),
}


def apply_retention(df: DataFrame, date: str, policy: Retention, as_of) -> DataFrame:
    """Rows still kept; with ``anonymise`` the expired rows stay without personal values."""
    limit = F.add_months(day(as_of), -12 * policy.years)
    expired = F.col(date) < limit
    if policy.action == "delete" or policy.action == "aggregate":
        return df.where(~F.coalesce(expired, F.lit(False)))
    if policy.action == "anonymise":
        blank = lambda c: F.when(F.coalesce(expired, F.lit(False)), F.lit(None)).otherwise(F.col(c))
        return df.withColumns({c: blank(c) for c in policy.personal})
    raise ValueError(f"unknown retention action: {policy.action}")


def expired_totals(df: DataFrame, date: str, policy: Retention, as_of) -> DataFrame:
    """What is kept of aggregated rows: counts per month and group."""
    limit = F.add_months(day(as_of), -12 * policy.years)
    return df.where(F.col(date) < limit).groupBy(F.trunc(date, "month").alias("month"), *policy.group).agg(F.count("*").alias("rows"))


@dataclass(frozen=True)
class Access:
    """What a role sees: hidden columns, hashed columns and a row filter (SQL condition)."""

    hidden: tuple[str, ...] = ()
    hashed: tuple[str, ...] = ()
    rows: str | None = None


def restrict_view(df: DataFrame, access: Access) -> DataFrame:
    out = df.where(access.rows) if access.rows else df
    out = out.withColumns({c: F.sha2(F.col(c).cast("string"), 256) for c in access.hashed if c in df.columns})
    return out.drop(*access.hidden)


def row_hash(columns: Sequence[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*columns)), 256)
