"""Row rules: warn, drop, fail; table constraints; reports.

A row passes a rule only if the predicate is TRUE. ``null_passes=True`` lets NULL pass as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions.predicates import as_column, is_true
from sensorloom.sources.constraints import CHECK_PROPERTY, enforce, guard, set_properties

__all__ = ["ConstraintViolation", "Rule", "add_check", "apply_rules", "check", "enforce", "expect", "expect_or_drop",
           "expect_or_fail", "not_null", "report", "violations"]


class ConstraintViolation(ValueError):
    """Stored rows break a rule that is being added to their table."""


@dataclass(frozen=True)
class Rule:
    """A named predicate and what to do with a row that fails it: ``warn``, ``drop`` or ``fail``."""

    name: str
    predicate: str | Column
    action: str = "warn"
    null_passes: bool = False

    def __post_init__(self) -> None:
        if self.action not in ("warn", "drop", "fail"):
            raise ValueError(f"unknown action {self.action!r}")

    @property
    def passed(self) -> Column:
        return is_true(self.predicate, self.null_passes)

    @property
    def keeps(self) -> Column:
        """``passed`` for use in a filter, where NULL drops the row anyway and a bare predicate can
        reach the file scan."""
        predicate = as_column(self.predicate)
        return predicate | predicate.isNull() if self.null_passes else predicate


def apply_rules(
    df: DataFrame, rules: Sequence[Rule], observation: Observation | str | None = "rules"
) -> DataFrame:
    """Apply all rules in one pass over a batch or a stream.

    The counts ``<rule>_passed`` and ``<rule>_failed`` and ``total`` are gathered on the way: give an
    ``Observation`` and read it after an action, or a name and read it from the progress of the
    stream. The gathering also stops the engine from moving the filter below the JSON parser and
    parsing every text twice; ``observation=None`` leaves it out.
    """
    if observation is not None:
        counts = [F.count(F.lit(1)).alias("total")]
        for rule in rules:
            counts += [
                F.count_if(rule.passed).alias(f"{rule.name}_passed"),
                F.count_if(~rule.passed).alias(f"{rule.name}_failed"),
            ]
        df = df.observe(observation, *counts)
    for rule in sorted(rules, key=lambda r: r.action != "fail"):
        if rule.action == "fail":
            df = guard(df, rule.name, rule.predicate, rule.null_passes)
        elif rule.action == "drop":
            df = df.where(rule.keeps)
    return df


def expect(df, name, predicate, null_passes=False, observation=None) -> DataFrame:
    """Keep every row and count the failures."""
    return apply_rules(df, [Rule(name, predicate, "warn", null_passes)], observation or name)


def expect_or_drop(df, name, predicate, null_passes=False, observation=None) -> DataFrame:
    """Drop failing rows and count them."""
    return apply_rules(df, [Rule(name, predicate, "drop", null_passes)], observation or name)


def expect_or_fail(df, name, predicate, null_passes=False) -> DataFrame:
    """Stop the query at the first failing row."""
    return apply_rules(df, [Rule(name, predicate, "fail", null_passes)], None)


def report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: ``rule, passed, failed, total``, from one aggregation."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(rule.passed).alias(f"p{i}") for i, rule in enumerate(rules)],
    )
    rows = F.array(*[
        F.struct(F.lit(rule.name).alias("rule"), F.col(f"p{i}").alias("passed"),
                 (F.col("total") - F.col(f"p{i}")).alias("failed"), F.col("total").alias("total"))
        for i, rule in enumerate(rules)
    ])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def check(df: DataFrame, name: str, predicate: str | Column, null_passes: bool = False) -> DataFrame:
    """The rows, or an error if one breaks the constraint; batch and stream."""
    return expect_or_fail(df, name, predicate, null_passes)


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    for col in cols:
        df = check(df, f"{col} not null", F.col(col).isNotNull())
    return df


def violations(df: DataFrame, predicate: str | Column, null_passes: bool = False) -> DataFrame:
    """Number of rows that break the predicate, as a one-row frame."""
    return df.agg(F.count_if(~is_true(as_column(predicate), null_passes)).alias("violations"))


def add_check(spark: SparkSession, table: str, name: str, predicate: str) -> None:
    """Add a constraint to a table. Rows already stored have to pass it."""
    broken = violations(spark.read.table(table), predicate).first()[0]
    if broken:
        raise ConstraintViolation(f"{broken} rows of {table} break {name}: {predicate}")
    set_properties(spark, table, {f"{CHECK_PROPERTY}{name}": predicate})
