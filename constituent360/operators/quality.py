"""Data-quality checks. All row-wise checks of a data set share one scan and one aggregation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from constituent360.functions.numbers import count_if
from constituent360.functions.text import strip

# Named formats.
PATTERNS = {
    "email": r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$",
    "phone": r"^\d{10,11}$",
    "zip": r"^\d{5}(-\d{4})?$",
}
# Accepted lifecycle stages.
LIFECYCLE_STAGES = ("prospect", "one_time_donor", "sustainer", "major_donor", "lapsed")


@dataclass(frozen=True)
class Check:
    """One rule. ``kind``: completeness, validity, uniqueness, consistency or timeliness."""

    name: str
    kind: str
    severity: str = "error"
    field: str | None = None
    pattern: str | None = None
    allowed: Sequence | None = None
    low: float | None = None
    high: float | None = None
    threshold: float = 0.0
    rule: str | None = None
    as_of: dt.datetime | None = None
    max_age_hours: float | None = None


def constituent_checks() -> list[Check]:
    return [
        Check("constituent_id_not_null", "completeness", "error", "constituent_id"),
        Check("constituent_id_unique", "uniqueness", "error", "constituent_id"),
        Check("email_format", "validity", "warning", "canonical_email", pattern="email", threshold=0.05),
        Check("lifecycle_valid", "validity", "error", "lifecycle_stage", allowed=LIFECYCLE_STAGES),
        Check("churn_score_range", "validity", "warning", "churn_risk_score", low=0, high=1),
    ]


def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _failing(df: DataFrame, check: Check) -> tuple[Column, Column]:
    """(rows the rule looks at, rows it rejects)."""
    everything, nothing = F.lit(True), F.lit(False)
    if check.kind == "completeness":
        gone = _missing(df, check.field)
        return everything, gone | (strip(F.col(check.field).cast("string")) == "")
    if check.kind == "validity":
        present = ~_missing(df, check.field)
        c = F.col(check.field)
        if check.pattern is not None:
            pattern = PATTERNS.get(check.pattern, check.pattern)
            return present, present & ~c.cast("string").rlike(f"^(?:{pattern})")
        if check.allowed is not None:
            return present, present & ~c.isin(*check.allowed)
        bad = nothing
        if check.low is not None:
            bad = bad | (c < check.low)
        if check.high is not None:
            bad = bad | (c > check.high)
        return present, present & bad
    if check.kind == "consistency" and check.rule:
        return everything, ~F.coalesce(F.expr(check.rule), F.lit(True))
    return everything, nothing


def _problem(df: DataFrame, check: Check) -> str | None:
    """Why a check cannot run on this schema."""
    if check.field is None:
        return None
    if check.field not in df.columns:
        return f"Field '{check.field}' not found"
    bounded = check.low is not None or check.high is not None
    if check.kind == "validity" and check.pattern is None and check.allowed is None and bounded:
        if not isinstance(df.schema[check.field].dataType, NumericType):
            return f"Field '{check.field}' is not numeric"
    return None


def _result(position: int, check: Check, checked: Column, failed: Column, details: str | None = None, passed=None):
    rate = F.when(checked > 0, failed / checked).otherwise(0.0)
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(check.name).alias("check_name"),
        (rate <= check.threshold if passed is None else passed).alias("passed"),
        F.lit(check.severity).alias("severity"),
        checked.cast("bigint").alias("records_checked"),
        failed.cast("bigint").alias("records_failed"),
        F.round(rate.cast("double"), 4).alias("failure_rate"),
        F.lit(details).cast("string").alias("details"),
    )


def validate(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check, in the order given. All row-wise checks share one aggregation; the first
    uniqueness check rides on it too, as a grouping step in between, so the data is read once."""
    sums, tops, results, unique = {"rows": F.count("*")}, {}, [], []
    for i, check in enumerate(checks):
        problem = _problem(df, check)
        if problem:
            size = F.col("rows") if check.field not in df.columns else F.lit(0)
            results.append(_result(i, check, size, size, problem, F.lit(False)))
        elif check.kind == "uniqueness":
            unique.append((i, check))
        elif check.kind == "timeliness" and check.max_age_hours is not None:
            tops[f"newest{i}"] = F.max(check.field)
            age = F.timestamp_diff("SECOND", F.col(f"newest{i}").cast("timestamp_ntz"), F.lit(check.as_of).cast("timestamp_ntz"))
            late = F.coalesce(age > check.max_age_hours * 3600, F.lit(False))
            results.append(_result(i, check, F.col("rows"), F.when(late, F.col("rows")).otherwise(0)))
        else:
            seen, bad = _failing(df, check)
            sums[f"seen{i}"], sums[f"bad{i}"] = count_if(seen), count_if(bad)
            results.append(_result(i, check, F.col(f"seen{i}"), F.col(f"bad{i}")))
    measures = [c.alias(n) for n, c in {**sums, **tops}.items()]
    if unique:
        i, check = unique[0]
        again = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in sums] + [F.max(n).alias(n) for n in tops]
        repeated = F.coalesce(F.sum(F.when(F.col("rows") > 1, F.col("rows"))), F.lit(0)).alias("repeated")
        totals = df.groupBy(check.field).agg(*measures).agg(*again, repeated)
        results.append(_unique_result(i, check, F.col("rows"), F.col("repeated")))
    else:
        totals = df.agg(*measures)
    out = totals.select(F.inline(F.array(*results))) if results else None
    for i, check in unique[1:]:
        counts = df.groupBy(check.field).agg(F.count("*").alias("rows"))
        repeated = F.coalesce(F.sum(F.when(F.col("rows") > 1, F.col("rows"))), F.lit(0))
        one = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"), repeated.alias("r"))
        out = out.unionByName(one.select(F.inline(F.array(_unique_result(i, check, F.col("n"), F.col("r"))))))
    return out.orderBy("position")


def _unique_result(position: int, check: Check, checked: Column, repeated: Column) -> Column:
    """Every member of a repeated value fails; missing values count as equal to each other."""
    return _result(position, check, checked, repeated, passed=repeated == 0)


def report(results: DataFrame, dataset: str) -> DataFrame:
    """One-row summary: the data set passes unless an error-severity check failed."""
    return results.agg(
        F.lit(dataset).alias("dataset_name"),
        F.count("*").alias("checks_run"),
        count_if(F.col("passed")).alias("checks_passed"),
        count_if(~F.col("passed")).alias("checks_failed"),
        (count_if(~F.col("passed") & (F.col("severity") == "error")) == 0).alias("overall_pass"),
    )


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows a check rejects, for quarantine."""
    if check.kind != "uniqueness":
        return df.where(_failing(df, check)[1])
    repeated = df.groupBy(F.col(check.field).alias("_repeated")).count().where("count > 1").select("_repeated")
    return df.join(repeated, F.col(check.field).eqNullSafe(F.col("_repeated")), "left_semi")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Uniqueness of a compound key, as one row."""
    counts = df.groupBy(*keys).count()
    return counts.agg(
        F.sum("count").alias("records_checked"),
        F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias("records_failed"),
        F.count("*").alias("distinct_keys"),
        F.max("count").alias("largest_group"),
    )


def profile(df: DataFrame, columns: Sequence[str] | None = None, exact_distinct: bool = False) -> DataFrame:
    """One row per column: missing and distinct counts, least and greatest value, mean and deviation of numbers."""
    columns = list(columns or df.columns)
    aggregates, structs = [F.count("*").alias("rows")], []
    for i, name in enumerate(columns):
        numeric = isinstance(df.schema[name].dataType, NumericType)
        c = F.col(name)
        as_number = c.cast("double") if numeric else F.lit(None).cast("double")
        aggregates += [
            count_if(_missing(df, name)).alias(f"n{i}"),
            F.min(c).cast("string" if not numeric else "double").cast("string").alias(f"a{i}"),
            F.max(c).cast("string" if not numeric else "double").cast("string").alias(f"z{i}"),
            F.avg(as_number).alias(f"m{i}"),
            F.stddev_samp(as_number).alias(f"s{i}"),
        ]
        if not exact_distinct:
            aggregates.append(F.approx_count_distinct(c).alias(f"d{i}"))
        structs.append(
            F.struct(
                F.lit(name).alias("column"), F.col("rows"), F.col(f"n{i}").alias("missing"),
                (F.lit(None).cast("bigint") if exact_distinct else F.col(f"d{i}")).alias("distinct_values"),
                F.col(f"a{i}").alias("least"), F.col(f"z{i}").alias("greatest"),
                F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
            )
        )
    out = df.agg(*aggregates).select(F.inline(F.array(*structs)))
    if not exact_distinct:
        return out
    long = df.select(*[F.col(c).cast("string") for c in columns]).unpivot([], columns, "column", "v")
    distinct = long.where("v IS NOT NULL").distinct().groupBy("column").agg(F.count("*").alias("_d"))
    return out.join(distinct, "column", "left").withColumn("distinct_values", F.coalesce("_d", F.lit(0))).drop("_d")


def profile_parts(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(by, column, rows, missing, least, greatest, n, mean, m2, values, ranks): profiles that can be stored and merged, one row per
    part and column, in one pass. ``values`` is a sketch of the distinct values, ``ranks`` one of the order of
    numbers; other columns have no ``ranks``. A null in ``by`` is a part of its own."""
    columns, aggregates, boxes = list(columns), [F.count("*").alias("rows")], []
    for i, name in enumerate(columns):
        numeric = isinstance(df.schema[name].dataType, NumericType)
        c, missing = F.col(name), _missing(df, name)
        there = F.when(~missing, c)
        number = there.cast("double") if numeric else F.lit(None).cast("double")
        shown = (lambda v: v.cast("double").cast("string")) if numeric else (lambda v: v.cast("string"))
        made = {
            "missing": count_if(missing), "least": shown(F.min(there)), "greatest": shown(F.max(there)), "n": F.count(number),
            "mean": F.avg(number), "m2": F.var_pop(number) * F.count(number), "values": F.hll_sketch_agg(F.concat(F.lit("="), there.cast("string")), 14),  # a sketch leaves empty strings out
            "ranks": F.kll_sketch_agg_double(number, 400) if numeric else F.lit(None).cast("binary"),
        }
        aggregates += [v.alias(f"{k}{i}") for k, v in made.items()]
        boxes.append(F.struct(F.lit(name).alias("column"), F.lit(numeric).alias("numeric"), F.col("rows"), *[F.col(f"{k}{i}").alias(k) for k in made]))
    return df.groupBy(*by).agg(*aggregates).select(*by, F.inline(F.array(*boxes)))


def merged_profile(parts: DataFrame, by: Sequence[str] = (), ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One profile per column (and value of ``by``) from stored parts, without the rows behind them: rows, missing, distinct_values
    (within about 2 %), least, greatest, mean, stddev and one q<i> per rank (a value whose own rank is within about
    1 % of it). Mean and deviation are exact up to rounding."""
    keys = [*by, "column", "numeric"]
    centre = (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_centre")
    same = [parts[k].eqNullSafe(F.col(f"_{k}")) for k in keys]
    centres = parts.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(centre)
    placed = parts.join(centres, reduce(lambda a, b: a & b, same))
    low, high = (F.when(F.col("numeric"), f(F.expr("try_cast(least AS double)") if f is F.min else F.expr("try_cast(greatest AS double)"))) for f in (F.min, F.max))
    spread = F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("_centre"), 2))
    merged = placed.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("missing").alias("missing"), F.hll_sketch_estimate(F.hll_union_agg("values")).alias("distinct_values"),
        F.coalesce(low.cast("string"), F.min("least")).alias("least"), F.coalesce(high.cast("string"), F.max("greatest")).alias("greatest"),
        F.max("_centre").alias("mean"), F.when(F.sum("n") > 1, F.sqrt(spread / (F.sum("n") - 1))).alias("stddev"),
        F.sum("n").alias("_n"), F.kll_merge_agg_double("ranks").alias("_ranks"),
    )
    at = [F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_double("_ranks", F.lit(float(r)))).alias(f"q{i}") for i, r in enumerate(ranks)]
    return merged.select(*[k for k in keys if k != "numeric"], "rows", "missing", "distinct_values", "least", "greatest", "mean", "stddev", *at)


@dataclass(frozen=True)
class Constraint:
    """kind: primary_key, unique, not_null, check (``rule``) or foreign_key (``parent``, ``parent_columns``)."""

    name: str
    table: str
    kind: str
    columns: tuple[str, ...] = ()
    rule: str | None = None
    parent: str | None = None
    parent_columns: tuple[str, ...] = ()


def check_constraints(tables: dict[str, DataFrame], constraints: Sequence[Constraint]) -> DataFrame:
    """Violations per declared constraint. All that one row can violate by itself is counted in one scan per table; keys
    are grouped, and orphans are counted per key value."""
    row = lambda c, violations: F.struct(
        F.lit(c.name).alias("constraint_name"), F.lit(c.table).alias("table"), F.lit(c.kind).alias("kind"),
        F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"),
    )
    alone: dict[str, list[Constraint]] = {}
    parts = []
    for c in constraints:
        df = tables[c.table]
        if c.kind in ("not_null", "check"):
            alone.setdefault(c.table, []).append(c)
        elif c.kind in ("primary_key", "unique"):
            groups = df.groupBy(*c.columns).agg(F.count("*").alias("n"))
            absent = F.lit(False)
            for name in c.columns:
                absent = absent | F.col(name).isNull()
            bad = F.when(absent, F.col("n") if c.kind == "primary_key" else 0).when(F.col("n") > 1, F.col("n")).otherwise(0)
            parts.append(groups.agg(F.sum(bad).alias("v")).select(row(c, F.col("v")).alias("r")).select("r.*"))
        elif c.kind == "foreign_key":
            # a hot key is one row on either side of the join
            keys = df.dropna(subset=list(c.columns)).groupBy(*c.columns).agg(F.count("*").alias("n"))
            parent = tables[c.parent].select(*[F.col(p).alias(k) for p, k in zip(c.parent_columns, c.columns)])
            orphans = keys.join(parent, list(c.columns), "left_anti").agg(F.sum("n").alias("v"))
            parts.append(orphans.select(row(c, F.col("v")).alias("r")).select("r.*"))
        else:
            raise ValueError(f"unknown constraint kind: {c.kind}")
    for name, own in alone.items():
        broken = [
            F.expr(" OR ".join(f"`{n}` IS NULL" for n in c.columns)) if c.kind == "not_null" else ~F.expr(c.rule) for c in own
        ]
        counted = tables[name].agg(*[count_if(b).alias(f"v{i}") for i, b in enumerate(broken)])
        parts.append(counted.select(F.inline(F.array(*[row(c, F.col(f"v{i}")) for i, c in enumerate(own)]))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("passed", F.col("violations") == 0)


def required_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Names that the DataFrame lacks."""
    return [n for n in names if n not in df.columns]


def quality_flags(df: DataFrame, email: str, phone: str, address: str) -> DataFrame:
    """has_valid_* flags and their mean as a score from 0 to 1."""
    flags = {
        "has_valid_email": F.coalesce(F.col(email).rlike(PATTERNS["email"]), F.lit(False)),
        "has_valid_phone": F.coalesce(F.col(phone).rlike(PATTERNS["phone"]), F.lit(False)),
        "has_valid_address": F.coalesce(strip(F.col(address)) != "", F.lit(False)),
    }
    score = sum((f.cast("int") for f in flags.values()), F.lit(0)) / len(flags)
    return df.withColumns({**flags, "data_quality_score": F.round(score, 2)})


def agreement(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Share of rows present on both sides whose values agree, per column."""
    left = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in columns])
    right = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in columns])
    counted = left.join(right, list(keys)).agg(
        F.count("*").alias("compared"),
        *[count_if(F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))).alias(c) for c in columns],
    )
    rate = lambda c: F.when(F.col("compared") > 0, F.col(c) * 100.0 / F.col("compared"))
    return counted.select(
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col("compared"), F.col(c).alias("agreeing"), rate(c).cast("double").alias("match_rate"))
            for c in columns
        ]))
    )


# Targets per quality dimension, in percent.
TARGETS = {"completeness": 95.0, "accuracy": 99.0, "consistency": 98.0, "validity": 99.0, "uniqueness": 99.9}


def health_score(scores: DataFrame) -> DataFrame:
    """(dimension, score) in percent against its target, plus the overall mean as one more row."""
    target = F.create_map(*[F.lit(v) for pair in TARGETS.items() for v in pair])
    rows = scores.select("dimension", "score", target[F.col("dimension")].alias("target"))
    rows = rows.withColumn("met", F.col("score") >= F.col("target"))
    overall = scores.agg(
        F.lit("overall").alias("dimension"), F.avg("score").alias("score"),
        F.lit(None).cast("double").alias("target"), F.lit(None).cast("boolean").alias("met"),
    )
    return rows.unionByName(overall)


def dimension_scores(results: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Mean pass rate in percent per check kind."""
    kinds = F.create_map(*[F.lit(v) for c in checks for v in (c.name, c.kind)])
    rate = F.when(F.col("records_checked") > 0, 1 - F.col("records_failed") / F.col("records_checked")).otherwise(1.0)
    return results.groupBy(kinds[F.col("check_name")].alias("dimension")).agg((F.avg(rate) * 100).alias("score"))
