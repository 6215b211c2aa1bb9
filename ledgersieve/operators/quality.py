"""Quality checks, declarative rules and the publish gate."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersieve.functions import clock


def _failing(rows: DataFrame, key: str, row_tests: dict[str, Column], key_name: str, null_keys: bool) -> DataFrame:
    """One row: how many rows fail each row test, and, as ``key_name``, how many key values occur more than once.

    One pass: the row tests are counted per key and then added up, so the rows are computed once. Partial counts
    keep a hot key to one row per task. Repeated null keys count as one value if ``null_keys`` says so.
    """
    per_key = rows.groupBy(F.col(key).alias("__key")).agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(test).alias(name) for name, test in row_tests.items()]
    )
    repeated = F.col("__n") > 1
    if not null_keys:
        repeated &= F.col("__key").isNotNull()
    return per_key.agg(
        *[F.coalesce(F.sum(f"`{name}`"), F.lit(0)).alias(name) for name in row_tests], F.count_if(repeated).alias(key_name)
    )


def quality_checks(rows: DataFrame, as_of: datetime) -> DataFrame:
    """Three rows: check name, whether it passed, how many failures.

    All three come from one pass over the rows.
    """
    # The three check names.
    names = ["null_key_check", "future_timestamp_check", "duplicate_natural_key_check"]
    by_row = {
        names[0]: F.col("account_id").isNull() | F.col("currency").isNull(),
        names[1]: F.col("posted_at") > clock.acceptance_limit(as_of),
    }
    counts = _failing(rows, "natural_key", by_row, names[2], null_keys=True)
    pairs = [part for name in names for part in (F.lit(name), F.col(name))]
    return counts.select(F.stack(F.lit(len(names)), *pairs).alias("check_name", "failing_count")).select(
        "check_name", (F.col("failing_count") == 0).alias("passed"), "failing_count"
    )


#: Counts of one period that add up to the checks of all: no key occurs in two periods, as the posting time is part of it.
PERIOD_STATE = T.StructType(
    [
        T.StructField("posted_period", T.DateType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("null_keys", T.LongType()),
        T.StructField("repeated_keys", T.LongType()),
        T.StructField("newest", T.TimestampNTZType()),
    ]
)


def period_states(rows: DataFrame) -> DataFrame:
    """``PERIOD_STATE`` of rows that have their period: per key first, so a hot key or period is a row for each task."""
    missing = F.col("account_id").isNull() | F.col("currency").isNull()
    per_key = rows.groupBy("posted_period", "natural_key").agg(
        F.count(F.lit(1)).alias("times"), F.count_if(missing).alias("missing"), F.max("posted_at").alias("newest")
    )
    return per_key.groupBy("posted_period").agg(
        F.sum("times").alias("row_count"),
        F.sum("missing").alias("null_keys"),
        F.count_if(F.col("times") > 1).alias("repeated_keys"),
        F.max("newest").alias("newest"),
    )


def late_periods(states: DataFrame, as_of: datetime) -> DataFrame:
    """Periods whose newest posting is after the clock's limit, most often none: only their rows need a look."""
    return states.where(F.col("newest") > clock.acceptance_limit(as_of)).select("posted_period")


def checks_from_states(states: DataFrame, late_rows: DataFrame, as_of: datetime) -> DataFrame:
    """The rows of ``quality_checks`` over all periods, from their stored counts.

    How many postings are after the limit depends on the clock, so it can't be counted beforehand; ``late_rows`` are
    the rows of ``late_periods``.
    """
    # The three check names.
    names = ["null_key_check", "future_timestamp_check", "duplicate_natural_key_check"]
    late = late_rows.agg(F.count_if(F.col("posted_at") > clock.acceptance_limit(as_of)).alias("n"))
    counts = states.agg(
        F.coalesce(F.sum("null_keys"), F.lit(0)).alias(names[0]), F.coalesce(F.sum("repeated_keys"), F.lit(0)).alias(names[2])
    ).select("*", late.scalar().alias(names[1]))
    pairs = [part for name in names for part in (F.lit(name), F.col(name))]
    return counts.select(F.stack(F.lit(len(names)), *pairs).alias("check_name", "failing_count")).select(
        "check_name", (F.col("failing_count") == 0).alias("passed"), "failing_count"
    )


def freshness_lag(rows: DataFrame, as_of: datetime) -> DataFrame:
    """Whole minutes between the newest posting and the clock; null without rows."""
    return rows.agg(clock.lag_minutes(F.max("posted_at"), as_of).alias("freshness_lag_minutes"))


@dataclass(frozen=True)
class QualityResult:
    checks: list[tuple[str, bool, int]]

    @property
    def failures(self) -> list[str]:
        return [name for name, passed, _ in self.checks if not passed]

    @property
    def passed(self) -> bool:
        return not self.failures


def run_quality_checks(rows: DataFrame, as_of: datetime) -> QualityResult:
    """Evaluate the checks; three rows come to the driver."""
    return verdict_of(quality_checks(rows, as_of))


def verdict_of(checks: DataFrame) -> QualityResult:
    return QualityResult([(r.check_name, r.passed, r.failing_count) for r in checks.collect()])


def _rule_rows(model: str, rule: str, counts: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn one row of failing counts (one column per checked column) into one row per rule."""
    pairs = [part for name in columns for part in (F.lit(name), F.col(name))]
    return counts.select(
        F.lit(model).alias("model"),
        F.lit(rule).alias("rule"),
        F.stack(F.lit(len(pairs) // 2), *pairs).alias("column_name", "failing_count"),
    ).withColumn("passed", F.col("failing_count") == 0)


def rule_not_null(model: str, rows: DataFrame, columns: list[str]) -> DataFrame:
    counts = rows.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return _rule_rows(model, "not_null", counts, columns)


def rule_accepted_values(model: str, rows: DataFrame, accepted: dict[str, list[str]]) -> DataFrame:
    """Values outside the list fail; nulls are left to ``rule_not_null``."""
    counts = rows.agg(*[F.count_if(~F.col(name).isin(values)).alias(name) for name, values in accepted.items()])
    return _rule_rows(model, "accepted_values", counts, accepted)


def rule_unique(model: str, rows: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once fail; nulls are left to ``rule_not_null``."""
    counts = _failing(rows.where(F.col(column).isNotNull()), column, {}, column, null_keys=False)
    return _rule_rows(model, "unique", counts, [column])


def published_model_rules(staged: DataFrame, mart: DataFrame) -> DataFrame:
    """The rule set of the two published models (fixed values: models, columns, accepted currency).

    The six rules of the staged model come from one pass over it, those of the mart from one over that.
    """
    # Rule and column pairs of the staged model.
    rules = [
        ("not_null", "natural_key"),
        ("not_null", "account_id"),
        ("not_null", "currency"),
        ("not_null", "amount"),
        ("accepted_values", "currency"),
        ("unique", "natural_key"),
    ]
    tests = {
        f"{rule}:{column}": F.col(column).isNull() if rule == "not_null" else ~F.col(column).isin(["USD"])
        for rule, column in rules
        if rule != "unique"
    }
    counts = _failing(staged, "natural_key", tests, "unique:natural_key", null_keys=False)
    parts = [p for rule, column in rules for p in (F.lit(rule), F.lit(column), F.col(f"`{rule}:{column}`"))]
    of_staged = counts.select(
        F.lit("stg_silver_transactions").alias("model"),
        F.stack(F.lit(len(rules)), *parts).alias("rule", "column_name", "failing_count"),
    ).withColumn("passed", F.col("failing_count") == 0)
    of_mart = rule_not_null("fct_daily_account_summary", mart, ["run_date", "account_id", "total_amount"])
    return of_staged.unionByName(of_mart)
