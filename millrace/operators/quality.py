"""Data-quality checks. Each returns clean rows, rejected rows or a report.

A report is a DataFrame with one row per check, computed by as few passes as
the check allows; nothing is collected.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions import columns as C
from millrace.functions import values as V
from millrace.operators import joins, ranking
from millrace.session import materialize


@dataclass(frozen=True)
class Rule:
    """A row passes when ``condition`` is true; NULL counts as not passing."""

    name: str
    condition: Column
    error_type: str = "ValueError"


def user_event_rules(as_of: Column, countries: Sequence[str] = V.COUNTRIES) -> list[Rule]:
    """Default rules of a user event."""
    return [
        Rule("email_format", F.col("email").rlike(V.EMAIL_PATTERN)),
        Rule("age_range", F.col("age").between(*V.AGE_RANGE)),
        Rule("country_allowed", F.col("country").isin(*countries)),
        Rule("revenue_not_negative", F.col("revenue") >= 0),
        Rule("signup_not_future", F.col("signup_date") <= as_of),
    ]


def failed_rule_names(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row breaks, in rule order."""
    marks = [F.when(~F.coalesce(rule.condition, F.lit(False)), F.lit(rule.name)) for rule in rules]
    return F.filter(F.array(*marks), lambda name: name.isNotNull())


def validate_record_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows with ``failed_rules``, their error type and ``is_valid``."""
    error_type = F.coalesce(
        *[F.when(~F.coalesce(rule.condition, F.lit(False)), F.lit(rule.error_type)) for rule in rules]
    )
    return df.withColumn("failed_rules", failed_rule_names(rules)).withColumns(
        {"error_type": error_type, "is_valid": F.size("failed_rules") == 0}
    )


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Valid rows as they came, and rejected rows with their reasons."""
    checked = validate_record_rules(df, rules)
    valid = checked.filter("is_valid").drop("failed_rules", "error_type", "is_valid")
    return valid, checked.filter("not is_valid").drop("is_valid")


def schema_check(df: DataFrame, expected: StructType) -> DataFrame:
    """One row per column with its NULL count and status.

    Status is ``ok``, ``missing``, ``extra``, ``type_mismatch`` or
    ``unexpected_nulls``. Names and types are compared as metadata, but
    nullability by looking at the rows: file sources declare every column
    nullable whatever it holds.
    """
    wanted = {field.name: field for field in expected.fields}
    found = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    rows = []
    for name in [*wanted, *[extra for extra in found if extra not in wanted]]:
        actual = found.get(name)
        nulls = F.count_if(F.col(name).isNull()) if name in found else F.lit(None).cast("bigint")
        kind = wanted[name].dataType.simpleString() if name in wanted else None
        if actual is None:
            status = F.lit("missing")
        elif kind is None:
            status = F.lit("extra")
        elif kind != actual:
            status = F.lit("type_mismatch")
        elif wanted[name].nullable:
            status = F.lit("ok")
        else:
            status = F.when(nulls > 0, "unexpected_nulls").otherwise("ok")
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(kind).cast("string").alias("expected"),
                F.lit(actual).cast("string").alias("actual"),
                nulls.alias("null_count"),
                status.alias("status"),
            )
        )
    return df.agg(F.array(*rows).alias("rows")).selectExpr("inline(rows)")


def _null_entries(columns: Sequence[str], threshold_pct: float) -> list[Column]:
    entries = []
    for name in columns:
        nulls = F.count_if(F.col(name).isNull())
        pct = C.percent(nulls, F.count("*"))
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                nulls.alias("null_count"),
                F.round(pct, 2).alias("null_percentage"),
                F.when(pct.isNull(), "EMPTY").when(pct <= threshold_pct, "PASS").otherwise("FAIL").alias("status"),
            )
        )
    return entries


def null_report(df: DataFrame, columns: Sequence[str], threshold_pct: float = V.NULL_THRESHOLD_PCT) -> DataFrame:
    """NULL count and percent of every column, in one pass."""
    return df.agg(F.array(*_null_entries(columns, threshold_pct)).alias("rows")).selectExpr("inline(rows)")


def out_of_range(name: str, bounds: tuple[float, float]) -> Column:
    return (F.col(name) < bounds[0]) | (F.col(name) > bounds[1])


def _range_entries(rules: Mapping[str, tuple[float, float]], stacked: bool, counted: Column) -> list[Column]:
    entries, inside = [], counted
    for name, (low, high) in rules.items():
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(float(low)).alias("min_allowed"),
                F.lit(float(high)).alias("max_allowed"),
                F.count_if(inside & out_of_range(name, (low, high))).alias("out_of_range"),
                F.count_if(inside & F.col(name).isNull()).alias("null_count"),
            )
        )
        if stacked:
            inside = inside & F.coalesce(F.col(name).between(low, high), F.lit(False))
    return entries


def range_report(df: DataFrame, rules: Mapping[str, tuple[float, float]], stacked: bool = False) -> DataFrame:
    """Out-of-range and NULL counts per column, in one pass.

    ``stacked`` counts each column only over rows inside every earlier range,
    as a chain of filters would.
    """
    return df.agg(F.array(*_range_entries(rules, stacked, F.lit(True))).alias("rows")).selectExpr("inline(rows)")


def range_split(df: DataFrame, rules: Mapping[str, tuple[float, float]]) -> tuple[DataFrame, DataFrame]:
    """Rows inside every range, and the rest with the columns they break.

    A NULL is inside no range, so it is rejected as ``<column>:null`` and not
    lost between the two.
    """
    marks = []
    for name, bounds in rules.items():
        marks.append(F.when(F.col(name).isNull(), F.lit(f"{name}:null")).when(out_of_range(name, bounds), F.lit(name)))
    tagged = df.withColumn("range_errors", F.filter(F.array(*marks), lambda mark: mark.isNotNull()))
    clean = tagged.filter(F.size("range_errors") == 0).drop("range_errors")
    return clean, tagged.filter(F.size("range_errors") > 0)


def uniqueness_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total, distinct and duplicate rows and the number of repeated keys."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
            F.count("*").alias("distinct_rows"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
            F.count_if(F.col("_n") > 1).alias("duplicate_groups"),
            F.max("_n").alias("largest_group"),
        )
    )


def referential_report(child: DataFrame, parent: DataFrame, foreign_key: str, primary_key: str) -> DataFrame:
    """Child rows in total, without a parent, and with a NULL key."""
    counted = child.groupBy(F.col(foreign_key).alias(primary_key)).agg(F.count("*").alias("_n"))
    known = parent.select(primary_key).distinct().withColumn("_known", F.lit(True))
    orphans = F.when(F.col("_known").isNull(), F.col("_n"))
    return counted.join(known, primary_key, "left").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("child_rows"),
        F.coalesce(F.sum(orphans), F.lit(0)).alias("orphan_rows"),
        F.coalesce(F.sum(F.when(F.col(primary_key).isNull(), F.col("_n"))), F.lit(0)).alias("null_key_rows"),
        F.count_if(F.col("_known").isNull()).alias("orphan_keys"),
    )


def freshness_check(df: DataFrame, column: str, as_of: Column, max_age_hours: float = V.MAX_AGE_HOURS) -> DataFrame:
    """Age of the latest row: ``PASS``, ``STALE``, or ``EMPTY`` without rows."""
    latest = F.max(column)
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(latest.cast("timestamp"))) / F.lit(3_600_000_000.0)
    return df.agg(
        latest.alias("latest"),
        F.round(age, 4).alias("age_hours"),
        F.when(latest.isNull(), "EMPTY").when(age > max_age_hours, "STALE").otherwise("PASS").alias("status"),
    )


def fresh_rows(df: DataFrame, column: str, as_of: Column, max_age_hours: float = V.MAX_AGE_HOURS) -> DataFrame:
    """Rows no older than ``max_age_hours`` at ``as_of``."""
    return df.filter(F.col(column) >= as_of - F.make_dt_interval(secs=F.lit(max_age_hours * 3600.0)))


def zscore_bounds(df: DataFrame, column: str, threshold: float) -> Column:
    """A one-row subquery holding the lower and upper bound; NULL without variance."""
    mean, deviation = F.avg(column), F.stddev(column)
    usable = F.when(deviation > 0, deviation)
    bounds = F.struct((mean - usable * threshold).alias("low"), (mean + usable * threshold).alias("high"))
    return df.agg(bounds.alias("bounds")).scalar()


def zscore_anomalies(
    df: DataFrame, column: str, threshold: float = V.STDDEV_THRESHOLD, side: str = "both"
) -> DataFrame:
    """Rows outside mean +/- ``threshold`` deviations (``side``: both or upper).

    The bounds are a scalar subquery: one extra aggregation, no join. Without
    variance they are NULL and no row is an anomaly.
    """
    bounds = zscore_bounds(df, column, threshold)
    above = F.col(column) > bounds["high"]
    return df.filter(above if side == "upper" else above | (F.col(column) < bounds["low"]))


def baseline_drift(
    df: DataFrame, baseline: DataFrame, columns: Sequence[str], alert_pct: float = V.DRIFT_ALERT_PCT
) -> DataFrame:
    """Current means against a baseline table ``(column, baseline_mean)``."""
    current = df.agg(
        F.array(*[F.struct(F.lit(name).alias("column"), F.avg(name).alias("current_mean")) for name in columns]).alias("r")
    ).selectExpr("inline(r)")
    deviation = C.percent(F.abs(F.col("current_mean") - F.col("baseline_mean")), F.abs("baseline_mean"))
    return current.join(baseline, "column").select(
        "column",
        F.round("current_mean", 6).alias("current_mean"),
        F.round("baseline_mean", 6).alias("baseline_mean"),
        F.round(deviation, 4).alias("deviation_pct"),
        (deviation > alert_pct).alias("drifted"),
    )


def completeness_report(df: DataFrame, date: Column, expected_count: int | None = None) -> DataFrame:
    """Row count against the expected one, and the number of missing days.

    Everything derives from one row per present day.
    """
    days = df.groupBy(date.cast("date").alias("day")).agg(F.count("*").alias("_n"))
    expected = F.lit(expected_count).cast("bigint")
    actual = F.coalesce(F.sum("_n"), F.lit(0))
    return days.agg(
        expected.alias("expected_count"),
        actual.alias("actual_count"),
        F.round(C.percent(F.greatest(expected - actual, F.lit(0)), expected), 1).alias("missing_pct"),
        F.min("day").alias("first_date"),
        F.max("day").alias("last_date"),
        (F.date_diff(F.max("day"), F.min("day")) + 1 - F.count("day")).cast("bigint").alias("missing_dates"),
    )


def quality_metrics(
    df: DataFrame,
    columns: Sequence[str],
    schema_version: str,
    measured_at: Column,
    alert_rate: float = V.DUPLICATE_RATE_ALERT,
) -> DataFrame:
    """One metrics row: rows, NULL rate per column, whole-row duplicate rate.

    Equal rows are grouped first, so NULL counts and duplicates come out of
    the same aggregation.
    """
    grouped = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    duplicates = F.try_divide((total - F.count("*")).cast("double"), total.cast("double"))
    rates = [
        F.round(
            F.try_divide(
                F.coalesce(F.sum(F.when(F.col(name).isNull(), F.col("_n"))), F.lit(0)).cast("double"),
                total.cast("double"),
            ),
            6,
        ).alias(f"{name}_null_rate")
        for name in columns
    ]
    return grouped.agg(
        total.alias("total_records"),
        *rates,
        F.round(duplicates, 6).alias("duplicate_rate"),
        (duplicates > alert_rate).alias("duplicate_alert"),
    ).withColumns({"schema_version": F.lit(schema_version), "measured_at": measured_at})


def format_rules(formats: Mapping[str, str]) -> list[Rule]:
    """Regular-expression rules, one per column."""
    return [Rule(f"{name}_format", F.col(name).rlike(pattern), "FormatError") for name, pattern in formats.items()]


def format_checks(df: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """Rows with the columns whose text does not have the expected format."""
    return validate_record_rules(df, format_rules(formats))


def business_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows checked against cross-field and conditional predicates."""
    return validate_record_rules(df, [Rule(name, cond, "BusinessRuleError") for name, cond in rules.items()])


def run_health(run_log: DataFrame, keys: Sequence[str], as_of: Column) -> DataFrame:
    """Error rate, throughput, latency and freshness from a run log.

    The log has ``started_at``, ``finished_at``, ``rows_out`` and ``failed``.
    """
    seconds = (
        F.unix_micros(F.col("finished_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))
    ) / F.lit(1_000_000.0)
    lag = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.max("finished_at").cast("timestamp"))
    return run_log.groupBy(*keys).agg(
        F.count("*").alias("runs"),
        F.round(C.percent(F.count_if("failed"), F.count("*")), 4).alias("error_rate_pct"),
        F.round(F.try_divide(F.sum("rows_out").cast("double"), F.sum(seconds)), 4).alias("rows_per_second"),
        F.round(F.avg(seconds), 4).alias("avg_latency_seconds"),
        F.round(F.max(seconds), 4).alias("max_latency_seconds"),
        F.round(lag / F.lit(3_600_000_000.0), 4).alias("hours_since_last"),
    )


def reconcile_tables(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], scale: int = C.SCALE
) -> DataFrame:
    """Keys that differ between two systems, with the kind of difference.

    Values are compared to ``scale`` decimals, as exact sums that do not depend
    on row order; only the sums shown are doubles. One grouped union of both
    sides: it combines map-side, so neither a full outer join nor a hot key's
    raw rows are needed, and adaptive execution sizes its single exchange.
    """
    def side(df: DataFrame, mine: str, other: str) -> DataFrame:
        own = [C.exact(name, scale).alias(f"{mine}_{name}") for name in values]
        empty = [F.lit(None).cast(f"decimal(38,{scale})").alias(f"{other}_{name}") for name in values]
        rows = [F.lit(int(name == mine)).cast("bigint").alias(f"{name}_rows") for name in ("left", "right")]
        return df.select(*keys, *rows, *own, *empty)

    merged = (
        side(left, "left", "right")
        .unionByName(side(right, "right", "left"))
        .groupBy(*keys)
        .agg(
            F.sum("left_rows").alias("left_rows"),
            F.sum("right_rows").alias("right_rows"),
            *[F.sum(f"{s}_{name}").alias(f"{s}_{name}") for name in values for s in ("left", "right")],
        )
    )
    shown = {f"{s}_{name}": F.col(f"{s}_{name}").cast("double") for name in values for s in ("left", "right")}
    same_values = C.all_of([F.col(f"left_{name}").eqNullSafe(F.col(f"right_{name}")) for name in values])
    status = (
        F.when(F.col("right_rows") == 0, "only_left")
        .when(F.col("left_rows") == 0, "only_right")
        .when(F.col("left_rows") != F.col("right_rows"), "count_differs")
        .when(~same_values, "value_differs")
    )
    return merged.withColumn("status", status).filter(F.col("status").isNotNull()).withColumns(shown)


def _ranked_values(values: DataFrame, ranks: Sequence[int]) -> DataFrame:
    """Values at the given zero-based ranks of a ``(value, copies)`` table of distinct values.

    The table is dealt into ranges of values. A running sum inside each range,
    plus one total per earlier range, is a value's last rank.
    """
    ranged = materialize(values.repartitionByRange("value").withColumn("_range", F.spark_partition_id()), "value-ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum("copies").alias("_copies"))
    starts = totals.select("_range", F.coalesce(F.sum("_copies").over(before), F.lit(0)).alias("_start"))
    within = F.sum("copies").over(Window.partitionBy("_range").orderBy("value"))
    upto = ranged.withColumn("_upto", within).join(F.broadcast(starts), "_range").withColumn("_upto", F.col("_upto") + F.col("_start"))
    held = F.filter(
        F.array(*[F.lit(rank).cast("bigint") for rank in ranks]),
        lambda rank: (rank < F.col("_upto")) & (rank >= F.col("_upto") - F.col("copies")),
    )
    return upto.select(F.explode(held).alias("rank"), "value")


def distribution_profile(df: DataFrame, column: str, quantiles: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one row each.

    Equal values are counted first, into a table in the session's shared folder;
    the counts are ranked range by range. Only one row per range is ordered as
    a whole, and the number of rows alone reaches the driver.
    """
    spark = df.sparkSession
    values = materialize(
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("value"))
        .agg(F.count("*").alias("copies")),
        "value-counts",
    )
    size = values.agg(F.sum("copies").alias("rows")).first()
    if not size["rows"]:
        return spark.createDataFrame([(float(q), None) for q in quantiles], "quantile double, value double")
    parts = []
    for quantile in quantiles:
        position = quantile * (size["rows"] - 1)
        low = math.floor(position)
        parts += [(float(quantile), low, 1 - (position - low)), (float(quantile), low + 1, position - low)]
    parts = [part for part in parts if part[2] > 0]
    at_rank = _ranked_values(values, sorted({part[1] for part in parts}))
    weights = spark.createDataFrame(parts, "quantile double, rank bigint, weight double")
    return (
        at_rank.join(F.broadcast(weights), "rank")
        .groupBy("quantile")
        .agg(F.sum(F.col("value") * F.col("weight")).alias("value"))
    )


def approximate_profile(df: DataFrame, column: str, quantiles: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """Quantiles from the bounded sketch, in one pass."""
    pairs = F.arrays_zip(
        F.array(*[F.lit(q) for q in quantiles]).alias("quantile"),
        F.percentile_approx(column, list(quantiles), accuracy).alias("value"),
    )
    return df.agg(pairs.alias("r")).selectExpr("inline(r)").toDF("quantile", "value")


def value_histogram(df: DataFrame, column: str, width: float) -> DataFrame:
    """Row counts per bucket of equal width."""
    bucket = F.floor(F.col(column) / F.lit(float(width)))
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(bucket.alias("bucket"))
        .agg(F.count("*").alias("row_count"))
        .withColumn("bucket_start", F.col("bucket") * F.lit(float(width)))
    )


def daily_trend(df: DataFrame, date: Column, column: str, scale: int = C.SCALE) -> DataFrame:
    """Rows and mean per day; the mean is of an exact sum to ``scale`` decimals."""
    mean = F.try_divide(F.sum(C.exact(column, scale)).cast("double"), F.count(column).cast("double"))
    return df.groupBy(date.cast("date").alias("date")).agg(F.count("*").alias("row_count"), mean.alias("mean"))


@dataclass(frozen=True)
class Expectation:
    """One data expectation: kind, column and its arguments."""

    kind: str
    column: str
    low: float | None = None
    high: float | None = None
    allowed: tuple[str, ...] = ()
    pattern: str = ""


def _unexpected(expectation: Expectation) -> Column:
    column = F.col(expectation.column)
    if expectation.kind == "not_null":
        return F.count_if(column.isNull())
    if expectation.kind == "between":
        return F.count_if((column < expectation.low) | (column > expectation.high))
    if expectation.kind == "in_set":
        return F.count_if(~column.isin(*expectation.allowed))
    if expectation.kind == "match_regex":
        return F.count_if(~column.rlike(expectation.pattern))
    if expectation.kind == "mean_between":
        inside = F.avg(column).between(expectation.low, expectation.high)
        return F.when(F.coalesce(inside, F.lit(False)), F.lit(0)).otherwise(F.lit(1)).cast("bigint")
    raise ValueError(f"unknown expectation kind: {expectation.kind}")


def expectations_suite(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Result per expectation. NULLs only break ``not_null``.

    All row-level expectations share one aggregation; each ``unique`` adds a
    grouped count over its own column.
    """
    row_level = [
        F.struct(F.lit(e.kind).alias("expectation"), F.lit(e.column).alias("column"), _unexpected(e).alias("unexpected_count"))
        for e in expectations
        if e.kind != "unique"
    ]
    results = [df.agg(F.array(*row_level).alias("r")).selectExpr("inline(r)")] if row_level else []
    for expectation in expectations:
        if expectation.kind == "unique":
            repeated = (
                df.filter(F.col(expectation.column).isNotNull())
                .groupBy(expectation.column)
                .agg(F.count("*").alias("_n"))
                .agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("unexpected_count"))
            )
            results.append(
                repeated.select(
                    F.lit("unique").alias("expectation"), F.lit(expectation.column).alias("column"), "unexpected_count"
                )
            )
    report = results[0]
    for other in results[1:]:
        report = report.unionByName(other)
    return report.withColumn("success", F.col("unexpected_count") == 0)


def suite_success(report: DataFrame) -> DataFrame:
    """One row: whether every expectation held."""
    return report.agg(F.bool_and("success").alias("success"), F.count_if(~F.col("success")).alias("failed"))


class QualityError(ValueError):
    """A check configured to raise did not pass."""


def _report_rows(source: DataFrame, step: int, check: str, item: Column, measured: Column, status: Column) -> DataFrame:
    return source.select(
        F.lit(step).alias("step"),
        F.lit(check).alias("check"),
        item.cast("string").alias("item"),
        measured.cast("double").alias("measured"),
        status.alias("status"),
    )


def _verdict(failing: Column) -> Column:
    return F.when(failing, "FAIL").otherwise("PASS")


def run_all_checks(
    df: DataFrame, config: Mapping[str, object], as_of: Column, keep_intermediate: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Run the configured checks in order; return ``(clean rows, report)``.

    Order: schema, NULLs, ranges, uniqueness, referential, freshness,
    anomalies, completeness. Ranges, uniqueness, referential integrity and
    freshness filter the rows the later checks see. ``on_fail`` is ``report``
    (default), ``filter`` to also drop rows with NULLs in critical columns, or
    ``raise`` to stop on a failed report.

    NULLs and ranges share one aggregation over the input. Deduplicated or
    joined rows are written once to the session's shared folder when later
    checks need them, unless ``keep_intermediate`` is off; otherwise every
    check repeats that shuffle.
    """
    on_fail = config.get("on_fail", "report")
    parts: list[DataFrame] = []
    step = 0

    if "schema" in config:
        step += 1
        report = schema_check(df, config["schema"])
        parts.append(_report_rows(report, step, "schema", F.col("column"), F.lit(None), _verdict(F.col("status") != "ok")))

    critical, rules = list(config.get("critical_columns", ())), dict(config.get("range_rules", {}))
    if critical or rules:
        counted = C.all_of([F.col(name).isNotNull() for name in critical]) if on_fail == "filter" else F.lit(True)
        nulls = _null_entries(critical, config.get("null_threshold_pct", V.NULL_THRESHOLD_PCT))
        ranges = _range_entries(rules, True, counted)
        totals = df.agg(*([F.array(*nulls).alias("nulls")] if nulls else []), *([F.array(*ranges).alias("ranges")] if ranges else []))
        if nulls:
            step += 1
            report = totals.selectExpr("inline(nulls)")
            parts.append(_report_rows(report, step, "nulls", F.col("column"), F.col("null_count"), F.col("status")))
            df = df.dropna(subset=critical) if on_fail == "filter" else df
        if ranges:
            step += 1
            report = totals.selectExpr("inline(ranges)")
            bad = F.col("out_of_range") + F.col("null_count")  # both leave the clean rows
            parts.append(_report_rows(report, step, "ranges", F.col("column"), bad, _verdict(bad > 0)))
            df = df.filter(C.all_of([F.col(name).between(low, high) for name, (low, high) in rules.items()]))

    shuffled = False
    if "unique_columns" in config:
        step += 1
        keys = list(config["unique_columns"])
        report, bad = uniqueness_report(df, keys), F.col("duplicate_rows")
        parts.append(_report_rows(report, step, "uniqueness", F.lit(",".join(keys)), bad, _verdict(bad > 0)))
        df = ranking.dedup_keep_first(df, keys, config.get("first_by", [config.get("timestamp_column", keys[0])]))
        shuffled = True
    if "referential" in config:
        step += 1
        parent, foreign_key, primary_key = config["referential"]
        report, bad = referential_report(df, parent, foreign_key, primary_key), F.col("orphan_rows")
        parts.append(_report_rows(report, step, "referential", F.lit(foreign_key), bad, _verdict(bad > 0)))
        df = joins.valid_child_rows(df, parent, foreign_key, primary_key)
        shuffled = True
    if shuffled and keep_intermediate and {"timestamp_column", "numeric_columns", "date_column"} & set(config):
        df = materialize(df, "checked-rows")

    if "timestamp_column" in config:
        step += 1
        name, hours = config["timestamp_column"], config.get("max_age_hours", V.MAX_AGE_HOURS)
        report = freshness_check(df, name, as_of, hours)
        parts.append(_report_rows(report, step, "freshness", F.lit(name), F.col("age_hours"), F.col("status")))
        df = fresh_rows(df, name, as_of, hours)
    for name in config.get("numeric_columns", ()):
        step += 1
        bounds = zscore_bounds(df, name, config.get("std_dev_threshold", V.STDDEV_THRESHOLD))
        outside = (F.col(name) < bounds["low"]) | (F.col(name) > bounds["high"])
        report, bad = df.agg(F.count_if(outside).alias("anomalies")), F.col("anomalies")
        parts.append(_report_rows(report, step, "anomalies", F.lit(name), bad, _verdict(bad > 0)))
        if config.get("drop_anomalies", False):
            df = df.filter(~F.coalesce(outside, F.lit(False)))
    if "date_column" in config:
        step += 1
        name = config["date_column"]
        report = completeness_report(df, F.col(name), config.get("expected_count"))
        short = (F.col("missing_dates") > 0) | (F.coalesce(F.col("missing_pct"), F.lit(0.0)) > 0)
        parts.append(_report_rows(report, step, "completeness", F.lit(name), F.col("missing_dates"), _verdict(short)))

    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    if on_fail == "raise":
        require_pass(report, ["check", "item"])
    return df, report


def require_pass(report: DataFrame, labels: Sequence[str] = ()) -> None:
    """Stop with a :class:`QualityError` when a report row is not ``PASS``."""
    failures = report.filter(~F.col("status").isin("PASS", "ok")).select(*labels, "status").collect()
    if failures:
        raise QualityError("; ".join(" ".join(str(value) for value in row) for row in failures))


def record_report(report: DataFrame, path: str, run_at: Column) -> None:
    """Append a report or a metrics row to its history."""
    report.withColumn("run_at", run_at).write.mode("append").parquet(path)
