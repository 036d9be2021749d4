"""Data-quality operators.

Each returns the violations (or one row per rule with a count) as a DataFrame; an
empty result means the rule holds. ``require_empty`` turns a violation into an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from demandloom import params as P


class DataQualityError(ValueError):
    """A rule is violated."""


def require_empty(violations: DataFrame, message: str) -> None:
    rows = violations.limit(5).collect()
    if rows:
        raise DataQualityError(f"{message}: {[r.asDict() for r in rows]}")


# --- schema rules (metadata only) ----------------------------------------------------

def required_columns(spark: SparkSession, checks: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """table_name, missing_column for every required column a table lacks."""
    missing = [
        (name, column) for name, (df, wanted) in checks.items()
        for column in sorted(set(wanted) - set(df.columns))
    ]
    return spark.createDataFrame(missing, "table_name string, missing_column string")


def day_column_problems(spark: SparkSession, wide: DataFrame) -> DataFrame:
    """A wide sales table has day columns, and ``d_1`` among them."""
    days = [name for name in wide.columns if name.startswith("d_")]
    problems = [] if days else [("no day columns",)]
    if days and "d_1" not in days:
        problems.append(("d_1 is missing",))
    return spark.createDataFrame(problems, "problem string")


# --- counts --------------------------------------------------------------------------

def row_count_mismatches(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Tables (one row each) whose count is not the expected one."""
    return (
        expected.join(counts, "table_name", "left")
        .filter(~F.col("row_count").eqNullSafe(F.col("expected_rows")))
        .select("table_name", "expected_rows", "row_count")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def duplicated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of duplicated keys."""
    return df.join(duplicate_keys(df, keys).select(*keys), list(keys), "left_semi")


def _per_rule(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule, violations: all rules in one pass."""
    totals = df.agg(*[F.count_if(condition).alias(name) for name, condition in rules.items()])
    return totals.unpivot([], list(rules), "rule", "violations")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _per_rule(df, {c: F.col(c).isNull() for c in columns})


def range_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule; a rule is the condition that must hold."""
    return _per_rule(df, {name: ~condition for name, condition in rules.items()})


# --- references and sets ---------------------------------------------------------------

def orphan_keys(fact: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct fact keys without a dimension row.

    Keys are made distinct first, so a hot key is joined once.
    """
    return fact.select(*keys).distinct().join(dimension.select(*keys), list(keys), "left_anti")


def foreign_key_violations(checks: Sequence[tuple[str, DataFrame, DataFrame, str]]) -> DataFrame:
    """relation, orphan_keys over (fact name, fact, dimension, key) checks."""
    result = None
    for name, fact, dimension, key in checks:
        part = orphan_keys(fact, dimension, [key]).agg(F.count(F.lit(1)).alias("orphan_keys")).select(
            F.lit(f"{name}.{key}").alias("relation"), "orphan_keys"
        )
        result = part if result is None else result.unionByName(part)
    return result


def unexpected_values(df: DataFrame, column: str, allowed: Sequence[str], complete: bool = True) -> DataFrame:
    """Values outside the allowed set and, if it must be complete, allowed ones that are absent."""
    found = df.select(F.col(column).cast("string").alias("value")).distinct()
    allowed_list = F.array(*[F.lit(v) for v in allowed])
    outside = found.filter(~F.array_contains(allowed_list, F.col("value"))).select(
        "value", F.lit("unexpected").alias("problem")
    )
    if not complete:
        return outside
    # The allowed set is small, so what was found of it fits one array.
    present = found.filter(F.array_contains(allowed_list, F.col("value"))).agg(
        F.collect_set("value").alias("present")
    )
    absent = present.select(F.explode(F.array_except(allowed_list, "present")).alias("value"))
    return outside.unionByName(absent.select("value", F.lit("absent").alias("problem")))


def join_cardinality(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For a many-to-one join: duplicated right keys and left keys without a match."""
    duplicates = duplicate_keys(right, keys).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("duplicate_right_keys").alias("rule"), "violations"
    )
    unmatched = orphan_keys(left, right, keys).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("unmatched_left_keys").alias("rule"), "violations"
    )
    return duplicates.unionByName(unmatched)


# --- series rules ------------------------------------------------------------------------

def incomplete_series(panel: DataFrame, expected_days: Column) -> DataFrame:
    """Series whose number of rows or distinct dates differs from the expected."""
    return (
        panel.groupBy(*P.SERIES)
        .agg(F.count(F.lit(1)).alias("days"), F.countDistinct("date").alias("distinct_dates"))
        .withColumn("expected_days", expected_days)
        .filter("days <> expected_days OR distinct_dates <> expected_days")
    )


def series_summary(panel: DataFrame) -> DataFrame:
    """One row: series, shortest and longest series, distinct dates."""
    per_series = panel.groupBy(*P.SERIES).agg(F.count(F.lit(1)).alias("days"))
    dates = panel.agg(F.countDistinct("date")).scalar()
    return per_series.agg(
        F.count(F.lit(1)).alias("number_of_series"),
        F.min("days").alias("fewest_days"),
        F.max("days").alias("most_days"),
    ).withColumn("distinct_dates", dates)


def day_set_problems(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Missing and extra days of every series against d_1 … d_N.

    The expected days are generated per series, then compared by anti join both ways.
    """
    last = calendar.agg(F.count(F.lit(1)).cast("int")).scalar()
    observed = sales.select(*P.SERIES, "day_id").distinct()
    expected = observed.select(*P.SERIES).distinct().select(
        *P.SERIES, F.explode(F.sequence(F.lit(1), last)).alias("n")
    ).select(*P.SERIES, F.concat(F.lit("d_"), F.col("n").cast("string")).alias("day_id"))
    keys = [*P.SERIES, "day_id"]
    missing = expected.join(observed, keys, "left_anti").withColumn("problem", F.lit("missing"))
    extra = observed.join(expected, keys, "left_anti").withColumn("problem", F.lit("extra"))
    return missing.unionByName(extra)


def chronology_problems(sales: DataFrame) -> DataFrame:
    """Rows that do not follow the previous calendar day of their series.

    Tables have no row order in Spark, so order means consecutive day numbers by date.
    """
    order = Window.partitionBy(*P.SERIES).orderBy("date")
    return (
        sales.select(*P.SERIES, "date", "day_number", F.lag("day_number").over(order).alias("previous"))
        .filter("previous IS NOT NULL AND previous + 1 <> day_number")
    )


def unmatched_actuals(totals: DataFrame, left: str, right: str) -> DataFrame:
    """Series whose two models disagree on actual demand, dates, or presence."""
    def side(model: str, prefix: str) -> DataFrame:
        return totals.filter(F.col("model") == model).select(
            *P.SERIES,
            F.col("actual_total_units").alias(f"{prefix}_units"),
            F.col("forecast_start").alias(f"{prefix}_start"),
            F.col("forecast_end").alias(f"{prefix}_end"),
        )
    both = side(left, "left").join(side(right, "right"), P.SERIES, "full")
    close = F.abs(F.col("left_units") - F.col("right_units")) <= 1e-8 + 1e-5 * F.abs(F.col("right_units"))
    same = close & (F.col("left_start") == F.col("right_start")) & (F.col("left_end") == F.col("right_end"))
    return both.filter(~F.coalesce(same, F.lit(False)))


def holdout_isolation(training: DataFrame, holdout_start: Column, features: Sequence[str]) -> DataFrame:
    """One row: training rows, last training day, rows in the holdout, null feature values."""
    nulls = sum((F.col(c).isNull().cast("long") for c in features), F.lit(0).cast("long"))
    return training.agg(
        F.count(F.lit(1)).alias("training_rows"),
        F.max("date").alias("last_training_date"),
        F.count_if(F.col("date") >= holdout_start).alias("rows_in_holdout"),
        F.sum(nulls).alias("missing_feature_values"),
    ).withColumn("holdout_start", holdout_start)


# --- decision-table rules ------------------------------------------------------------------

def inconsistent_limits(allocations: DataFrame) -> DataFrame:
    """(scenario, method, store) groups with more than one budget or capacity."""
    return (
        allocations.groupBy("scenario", "allocation_method", "store_id")
        .agg(
            (F.min("budget_limit") != F.max("budget_limit")).alias("budgets_differ"),
            (F.min("capacity_limit") != F.max("capacity_limit")).alias("capacities_differ"),
        )
        .filter("budgets_differ OR capacities_differ")
    )


def cost_identity_violations(allocations: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Rows whose operational cost is not holding plus shortage cost, or whose units do not add up."""
    cost_gap = F.col("operational_cost_units") - F.col("holding_cost_units") - F.col("shortage_cost_units")
    demand_gap = F.col("served_units") + F.col("shortage_units") - F.col("actual_demand_units")
    return allocations.filter((F.abs(cost_gap) > tolerance) | (F.abs(demand_gap) > tolerance))


def probability_violations(scenarios: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        scenarios.groupBy(*keys).agg(F.sum("probability").alias("total_probability"))
        .filter(F.abs(F.col("total_probability") - 1.0) > 1e-8)
    )


def resource_compliance(allocations: DataFrame) -> DataFrame:
    """Spend and units of each (scenario, method, store) against its limits."""
    spend, budget = F.col("spend"), F.col("budget_limit")
    return (
        allocations.groupBy("scenario", "allocation_method", "store_id")
        .agg(
            F.sum("purchase_spend").alias("spend"),
            F.sum("allocated_order_quantity").alias("units"),
            F.max("budget_limit").alias("budget_limit"),
            F.max("capacity_limit").alias("capacity_limit"),
        )
        .withColumn("within_budget", spend <= budget + 1e-5)
        .withColumn("within_capacity", F.col("units") <= F.col("capacity_limit"))
    )


def infeasible_minimums(targets: DataFrame, limits: DataFrame) -> DataFrame:
    """(scenario, store) groups whose guaranteed minimum already exceeds a limit."""
    minimum = F.floor(P.MINIMUM_COVERAGE * F.col("target_order_quantity"))
    need = targets.groupBy("store_id").agg(
        F.sum(minimum * F.col("unit_purchase_cost")).alias("minimum_spend"),
        F.sum(minimum).alias("minimum_units"),
    )
    return limits.join(need, "store_id").filter(
        "minimum_spend > budget_limit + 1e-8 OR minimum_units > capacity_limit"
    )
