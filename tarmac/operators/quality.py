"""Threshold checks over a flight table, one result row per check.

A check on single values is a set of aggregate expressions plus the result built from them, so any
number of checks share one pass over the table with partial aggregation. Checks that need a
grouping (uniqueness, frequent invalid values, reference lookups) reduce by that key first.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.functions import Column

from tarmac import schema
from tarmac.session import work_folder

#: Counters of each of the two hashes, and how many of the fullest ones give the first exact counts.
SLOTS = 2 ** 16
FULLEST = 64


@dataclass
class Check:
    """`aggregates` are evaluated over the rows; `outcome` reads them by alias."""

    aggregates: list
    outcome: Column


def _outcome(name, kind, column, checked, good, threshold, details, rate_if_empty=0.0):
    rate = F.coalesce(good / F.nullif(checked, F.lit(0)), F.lit(rate_if_empty))
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(kind).alias("check_type"),
        F.lit(column).alias("column_name"),
        checked.alias("rows_checked"),
        (checked - good).alias("rows_failed"),
        F.round(rate, 4).alias("pass_rate"),
        F.lit(float(threshold)).alias("threshold"),
        (rate >= threshold).alias("passed"),
        F.to_json(details, {"ignoreNullFields": "false"}).alias("details"),
    )


def evaluate(df, checks):
    """All checks in one aggregation; one row per check."""
    aggregates = [a for check in checks for a in check.aggregates]
    return df.agg(*aggregates).select(F.inline(F.array(*[c.outcome for c in checks])))


def not_null(column, threshold=0.99):
    key = f"not_null_{column}"
    total, good = F.col(f"{key}_n"), F.col(f"{key}_ok")
    return Check(
        [F.count("*").alias(f"{key}_n"), F.count(column).alias(f"{key}_ok")],
        _outcome(
            f"not_null::{column}", "completeness", column, total, good, threshold,
            F.struct(good.alias("not_null_count"), (total - good).alias("null_count")),
        ),
    )


def value_range(column, low, high, threshold=0.99):
    """Inclusive range of the values that are numbers."""
    key = f"range_{column}"
    value = F.col(column).try_cast("double")
    value = F.when(~F.isnan(value), value)
    n, good = F.col(f"{key}_n"), F.col(f"{key}_ok")
    return Check(
        [
            F.count(value).alias(f"{key}_n"),
            F.count_if(value.between(low, high)).alias(f"{key}_ok"),
            F.min(value).alias(f"{key}_min"),
            F.max(value).alias(f"{key}_max"),
        ],
        _outcome(
            f"value_range::{column}", "validity", column, n, good, threshold,
            F.struct(
                F.lit(float(low)).alias("min_val"),
                F.lit(float(high)).alias("max_val"),
                F.col(f"{key}_min").alias("actual_min"),
                F.col(f"{key}_max").alias("actual_max"),
                (n - good).alias("outlier_count"),
            ),
        ),
    )


def no_future_dates(column="flight_date", threshold=1.0, as_of=None):
    key = f"future_{column}"
    day = F.col(column).try_cast("date")
    today = F.lit(as_of).cast("date") if as_of else F.current_date()
    n, good = F.col(f"{key}_n"), F.col(f"{key}_ok")
    return Check(
        [
            F.count(day).alias(f"{key}_n"),
            F.count_if(day <= today).alias(f"{key}_ok"),
            F.min(day).alias(f"{key}_min"),
            F.max(day).alias(f"{key}_max"),
        ],
        _outcome(
            f"no_future_dates::{column}", "validity", column, n, good, threshold,
            F.struct(
                F.col(f"{key}_min").cast("string").alias("min_date"),
                F.col(f"{key}_max").cast("string").alias("max_date"),
            ),
        ),
    )


def delay_consistency(columns, threshold=0.95):
    """Delay components add up to the arrival delay within 5 minutes, where all are known.

    Passes when the table lacks the columns or has no row to compare.
    """
    parts = [c for c in schema.DELAY_COMPONENTS if c in columns]
    name, kind, about = "delay_consistency", "consistency", "delay_components"
    if len(parts) < 3 or "arrival_delay_min" not in columns:
        note = F.struct(F.lit("Insufficient columns for check").alias("note"))
        zero = F.lit(0).cast("bigint")
        return Check([F.count("*").alias("consistency_n")],
                     _outcome(name, kind, about, zero, zero, threshold, note, rate_if_empty=1.0))
    # A missing part makes the difference null, and null differences are left out everywhere.
    gap = F.abs(reduce(lambda a, b: a + b, [F.col(c) for c in parts]) - F.col("arrival_delay_min"))
    n, good = F.col("consistency_n"), F.col("consistency_ok")
    found = F.to_json(F.struct(
        F.round(F.col("consistency_sum") / F.nullif(n, F.lit(0)), 2).cast("double")
        .alias("mean_difference_min"),
        F.round("consistency_max", 2).cast("double").alias("max_difference_min"),
    ))
    nothing = F.to_json(F.struct(F.lit("No rows with complete delay breakdown").alias("note")))
    outcome = _outcome(name, kind, about, n, good, threshold, F.struct(n), rate_if_empty=1.0)
    return Check(
        [
            F.count(gap).alias("consistency_n"),
            F.count_if(gap <= 5).alias("consistency_ok"),
            F.sum(gap).alias("consistency_sum"),
            F.max(gap).alias("consistency_max"),
        ],
        outcome.withField("details", F.when(n > 0, found).otherwise(nothing)),
    )


def check_unique(df, columns, threshold=0.999):
    """Rows beyond the first of each key count as failed; null key parts equal each other."""
    name = "+".join(columns)
    n, good = F.col("n"), F.col("ok")
    return (
        df.groupBy(*columns).agg(F.count("*").alias("copies"))
        .agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n"), F.count("*").alias("ok"))
        .select(F.inline(F.array(_outcome(
            f"unique::{name}", "uniqueness", name, n, good, threshold,
            F.struct((n - good).alias("duplicate_count")),
        ))))
    )


def _allowed(value, allowed):
    known = [v for v in allowed if v is not None]
    inside = F.coalesce(value.isin(known), F.lit(False))
    return inside | value.isNull() if None in allowed else inside


def _values(df, column):
    """The column alone, stored without a shuffle: whatever is asked of it reads the rows once."""
    path = work_folder(df.sparkSession, "values")
    df.select(F.col(column).alias("value")).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _slots():
    return [F.pmod(F.xxhash64(F.lit(k), F.col("value")), F.lit(SLOTS)) for k in range(2)]


def possible_values(values, n=10):
    """The rows of `values` whose value may be among the n most frequent ones; the others cannot be.

    Rows are counted by two hashes into `SLOTS` counters each, and a counter is never less than the count of a
    value in it. The values of the fullest counters are counted exactly; the n-th of these counts bounds the
    true n-th one from below, so a value with a smaller counter is out. Nothing is estimated: where
    values hardly repeat the bound is 1 and every row stays.
    """
    path = work_folder(values.sparkSession, "counters")
    slots = [F.struct(F.lit(k).alias("hash"), slot.alias("slot")) for k, slot in enumerate(_slots())]
    values.select(F.inline(F.array(*slots))).groupBy("hash", "slot").agg(
        F.count("*").alias("at_most")).write.parquet(path)
    counters = values.sparkSession.read.parquet(path)

    fullest = counters.filter("hash = 0").orderBy(F.desc("at_most"), "slot").limit(FULLEST).select("slot")
    # One row: the n-th count, or 1 where fewer values were seen.
    bound = (
        values.join(F.broadcast(fullest), _slots()[0] == F.col("slot"), "left_semi")
        .groupBy("value").agg(F.count("*").alias("occurrences"))
        .orderBy(F.desc("occurrences")).limit(n)
        .agg(F.when(F.count("*") == n, F.min("occurrences")).otherwise(1).alias("bound"))
    ).first()["bound"]
    for k, slot in enumerate(_slots()):
        # At most SLOTS rows, of two numbers each.
        full = counters.filter((F.col("hash") == k) & (F.col("at_most") >= bound)).select("slot")
        values = values.join(F.broadcast(full), slot == F.col("slot"), "left_semi")
    return values


def _most_frequent(values, n):
    return (
        possible_values(values, n).groupBy("value")
        .agg(F.count("*").alias("occurrences"))
        .orderBy(F.desc("occurrences"), F.asc("value"))
        .limit(n)
    )


def invalid_values(df, column, allowed, n=10):
    """The most frequent values outside the set, with exact counts; ties in value order."""
    outside = F.col(column).isNotNull() & ~_allowed(F.col(column), allowed)
    return _most_frequent(_values(df.filter(outside), column), n)


def _counted(df, column):
    """How often each value occurs, stored: totals and samples come from it, the rows are read once."""
    path = work_folder(df.sparkSession, "values")
    df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def check_values_in_set(df, column, allowed, threshold=0.99, sample=10):
    """Values outside the set fail, and so does null unless the set holds it. The details show the
    `sample` most frequent ones."""
    values = _values(df, column)
    good = _allowed(F.col("value"), allowed)
    totals = values.agg(F.count("*").alias("n"), F.count_if(good).alias("ok"))
    frequent = (
        _most_frequent(values.filter(F.col("value").isNotNull() & ~good), sample)
        .agg(F.sort_array(F.collect_list(F.struct(
            (-F.col("occurrences")).alias("k"), "value", F.col("occurrences").alias("n"))))
             .alias("top"))
        .select(F.transform("top", lambda t: F.struct(t["value"].alias("value"), t["n"].alias("n")))
                .alias("top"))
    )
    return _totals_with_sample(
        totals, frequent, "top", f"values_in_set::{column}", "validity", column, threshold,
        "invalid_top10",
    )


def check_referential_integrity(df, column, reference, reference_column, threshold=0.99, sample=20):
    """Values must occur in the reference table. The lookup joins distinct values, not rows; the
    details show the first `sample` unknown ones."""
    counted = _counted(df, column)
    known = reference.select(F.col(reference_column).alias("value"), F.lit(True).alias("known"))
    looked_up = counted.join(known.dropna().distinct(), "value", "left")
    totals = looked_up.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("ok"),
    )
    unknown = (
        looked_up.filter(F.col("known").isNull() & F.col("value").isNotNull())
        .orderBy("value").limit(sample)
        .agg(F.sort_array(F.collect_list("value")).alias("sample"))
    )
    return _totals_with_sample(
        totals, unknown, "sample", f"referential_integrity::{column}", "consistency", column,
        threshold, "invalid_values_sample",
    )


def _totals_with_sample(totals, sample, sample_column, name, kind, column, threshold, label):
    """Merge two one-row results."""
    both = totals.unionByName(sample, allowMissingColumns=True).agg(
        F.max("n").alias("n"), F.max("ok").alias("ok"),
        F.first(sample_column, ignorenulls=True).alias("found"),
    )
    return both.select(F.inline(F.array(_outcome(
        name, kind, column, F.col("n"), F.col("ok"), threshold, F.struct(F.col("found").alias(label)),
    ))))


def run_all_checks(df, as_of=None):
    """The standard suite: up to 12 result rows, in two passes (one of them over the keys)."""
    checks = [
        not_null("flight_date", 1.0),
        not_null("carrier_code", 1.0),
        not_null("origin_airport", 1.0),
        not_null("dest_airport", 1.0),
        not_null("distance_miles", 0.99),
        not_null("arrival_delay_min", 0.80),
        value_range("distance_miles", 1, 6000, 0.99),
        value_range("departure_delay_min", -120, 1500, 0.99),
        value_range("arrival_delay_min", -120, 1500, 0.99),
        no_future_dates("flight_date", 1.0, as_of),
        delay_consistency(df.columns, 0.90),
    ]
    results = evaluate(df, checks)
    keys = [c for c in schema.FLIGHT_KEY if c in df.columns]
    if len(keys) >= 4:
        results = results.unionByName(check_unique(df, keys, 0.999))
    return results


def report_lines(results):
    """Readable PASS / FAIL line per check, and a last one with their number."""
    lines = results.select(
        "check_name",
        F.format_string(
            "[%s] %-45s %.1f%% (threshold: %.0f%%)",
            F.when(F.col("passed"), "PASS").otherwise("FAIL"),
            F.col("check_name"),
            F.col("pass_rate") * 100,
            F.col("threshold") * 100,
        ).alias("line"),
    )
    total = results.agg(
        F.lit("Result").alias("check_name"),
        F.format_string("Result: %d/%d checks passed", F.count_if("passed"), F.count("*"))
        .alias("line"),
    )
    return lines.unionByName(total)


class QualityGateError(RuntimeError):
    pass


def gate(results, fail=True):
    """Names of failed checks; raises when there are any, unless told not to. `results` holds one
    row per check, so reading it on the driver is safe."""
    failed = [r.check_name for r in results.filter(~F.col("passed")).select("check_name").collect()]
    if failed and fail:
        raise QualityGateError(f"data quality checks failed: {sorted(failed)}")
    return failed
