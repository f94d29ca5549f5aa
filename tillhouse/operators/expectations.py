"""Declarative expectations, evaluated over a whole table or per group of it.

All row-level rules of a suite share one aggregate. Each uniqueness rule adds one keyed aggregate. Both
combine on the map side, so a value that fills a third of the table costs no more than a rare one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str | None = None
    allowed: tuple = ()
    low: float | None = None
    high: float | None = None
    pattern: str | None = None

    @property
    def parameters(self) -> str:
        if self.allowed:
            return "in " + ", ".join(map(str, self.allowed))
        if self.low is not None:
            if self.high is None:
                return f"{self.low:g}.."
            return f"{self.low:g}..{self.high:g}" if self.high < 1e6 else f"{self.low:g}..{int(self.high)}"
        return self.pattern or ""


def exists(column: str) -> Expectation:
    return Expectation("column_to_exist", column)


def not_null(column: str) -> Expectation:
    return Expectation("values_to_not_be_null", column)


def unique(column: str) -> Expectation:
    return Expectation("values_to_be_unique", column)


def in_set(column: str, *allowed: object) -> Expectation:
    return Expectation("values_to_be_in_set", column, allowed=allowed)


def between(column: str, low: float, high: float) -> Expectation:
    return Expectation("values_to_be_between", column, low=low, high=high)


def matches(column: str, pattern: str) -> Expectation:
    return Expectation("values_to_match_regex", column, pattern=pattern)


def row_count_between(low: int, high: int | None = None) -> Expectation:
    """Without ``high`` a table may grow as large as it likes."""
    return Expectation("table_row_count_to_be_between", low=low, high=high)


@dataclass(frozen=True)
class Suite:
    name: str
    checkpoint: str
    rules: tuple[Expectation, ...]


def violation(rule: Expectation) -> Column:
    """True for a row that breaks a row-level rule. Nulls only ever break ``not_null``."""
    c = F.col(rule.column)
    tests = {
        "values_to_not_be_null": lambda: c.isNull(),
        "values_to_be_in_set": lambda: ~c.isin(*rule.allowed),
        "values_to_be_between": lambda: ~c.between(rule.low, rule.high),
        "values_to_match_regex": lambda: ~c.rlike(rule.pattern),
    }
    return tests[rule.kind]()


def run_suite(df: DataFrame, suite: Suite, by: Sequence[str] = ()) -> DataFrame:
    """One row per rule (and per group when ``by`` is given).

    Columns: the ``by`` columns, suite_name, checkpoint_name, rule_no, expectation, column_name,
    parameters, table_rows, unexpected_count (null for a rule over a missing column), success.
    """
    by = list(by)
    rows = F.col("table_rows")
    pooled, keyed = [], []
    aggregates = [F.count("*").alias("table_rows")]
    for no, rule in enumerate(suite.rules, start=1):
        if rule.kind == "table_row_count_to_be_between":
            pooled.append(_result(no, rule, F.lit(0).cast("bigint"), (rows >= rule.low) if rule.high is None else rows.between(rule.low, rule.high)))
        elif rule.column not in df.columns:
            pooled.append(_result(no, rule, F.lit(None).cast("bigint"), F.lit(False)))
        elif rule.kind == "column_to_exist":
            pooled.append(_result(no, rule, F.lit(0).cast("bigint"), F.lit(True)))
        elif rule.kind == "values_to_be_unique":
            keyed.append((no, rule))
        else:
            aggregates.append(F.count_if(violation(rule)).alias(f"_r{no}"))
            pooled.append(_result(no, rule, F.col(f"_r{no}"), F.col(f"_r{no}") == 0))
    parts = []
    if pooled:
        totals = df.groupBy(*by).agg(*aggregates)
        parts.append(totals.select(*by, "table_rows", F.inline(F.array(*pooled))))
    for no, rule in keyed:
        copies = df.groupBy(*by, F.col(rule.column).alias("_value")).agg(F.count("*").alias("_n"))
        repeated = F.when(F.col("_value").isNotNull() & (F.col("_n") > 1), F.col("_n"))
        counts = copies.groupBy(*by).agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("table_rows"), F.coalesce(F.sum(repeated), F.lit(0)).alias("_bad")
        )
        parts.append(counts.select(*by, "table_rows", F.inline(F.array(_result(no, rule, F.col("_bad"), F.col("_bad") == 0)))))
    results = reduce(DataFrame.unionByName, parts)
    return results.select(
        *by,
        F.lit(suite.name).alias("suite_name"),
        F.lit(suite.checkpoint).alias("checkpoint_name"),
        "rule_no", "expectation", "column_name", "parameters", "table_rows", "unexpected_count", "success",
    )


def _result(no: int, rule: Expectation, unexpected: Column, success: Column) -> Column:
    return F.struct(
        F.lit(no).alias("rule_no"),
        F.lit(rule.kind).alias("expectation"),
        F.lit(rule.column or "").alias("column_name"),
        F.lit(rule.parameters).alias("parameters"),
        unexpected.cast("bigint").alias("unexpected_count"),
        success.alias("success"),
    )


def summarize(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Tally per checkpoint. An empty table evaluates nothing and fails every rule."""
    rules = F.count("*")
    empty = F.max("table_rows") == 0
    passed = F.when(empty, 0).otherwise(F.count_if("success")).cast("bigint")
    tally = results.groupBy(*by, "checkpoint_name", "suite_name").agg(
        F.when(empty, 0).otherwise(rules).cast("bigint").alias("evaluated_expectations"),
        passed.alias("successful_expectations"),
        (rules - passed).alias("unsuccessful_expectations"),
    )
    return tally.withColumn("success", F.col("unsuccessful_expectations") == 0)


def failing_examples(df: DataFrame, rule: Expectation, n: int = 20) -> DataFrame:
    """Up to ``n`` distinct values that break a row-level rule, for an operator to look at."""
    return df.where(violation(rule)).select(F.col(rule.column).cast("string").alias("value")).distinct().limit(n)


def result_detail(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One JSON array of rule results per checkpoint (a suite has a fixed, small number of rules)."""
    item = F.struct("rule_no", "expectation", "column_name", "parameters", "table_rows", "unexpected_count", "success")
    return results.groupBy(*by, "checkpoint_name").agg(F.to_json(F.sort_array(F.collect_list(item))).alias("result_detail"))
