"""Row-level data-quality rules and the two ways of reporting them.

A ``Rule`` is a named boolean Column that is True when a row FAILS. A rule set
is an ordered tuple of rules. Two reporters exist, as in the reference:

* ``validate_message`` (SQL profile): one string column with the message of
  every failed rule concatenated in rule order, NULL when all pass;
* ``validate_flags`` (pandas profile): one boolean column per rule plus
  ``is_valid``.

Both are a single projection over the rows (plus one aggregate + join when a
rule needs duplicate detection), so they run inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import flag_duplicates

DUP = "_is_dup"


@dataclass(frozen=True)
class Rule:
    """``check()`` returns a Column that is True when the row fails."""

    name: str
    message: str
    check: Callable[[], Column]
    needs_duplicates: bool = False


def is_null(c: str) -> Callable[[], Column]:
    return lambda: F.col(c).isNull()


def negative(c: str) -> Callable[[], Column]:
    # NULL < 0 is NULL: a missing value does not fail this rule.
    return lambda: F.coalesce(F.col(c) < 0, F.lit(False))


def not_positive(c: str) -> Callable[[], Column]:
    # A missing value counts as 0, so it fails; NaN is a missing number.
    return lambda: (F.coalesce(F.col(c), F.lit(0)) <= 0) | F.isnan(
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)))


def duplicate() -> Callable[[], Column]:
    return lambda: F.col(DUP)


def _with_dups(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str],
               order_by: Sequence[str] | None, stable: bool) -> DataFrame:
    if any(r.needs_duplicates for r in rules):
        return flag_duplicates(df, keys, DUP, order_by, stable)
    return df


def validate_message(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str] = (),
                     column: str = "error_flags",
                     order_by: Sequence[str] | None = None,
                     stable: bool = False) -> DataFrame:
    """Add ``column``: failed-rule messages in rule order, NULL if none."""
    checked = _with_dups(df, rules, keys, order_by, stable)
    parts = [F.when(r.check(), F.lit(r.message)) for r in rules]
    msg = F.nullif(F.concat_ws("", *parts), F.lit(""))
    return checked.withColumn(column, msg).drop(DUP)


def validate_flags(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str] = (),
                   valid: str = "is_valid",
                   order_by: Sequence[str] | None = None,
                   stable: bool = False) -> DataFrame:
    """Add one boolean column per rule (named after it) and ``valid``."""
    checked = _with_dups(df, rules, keys, order_by, stable)
    flags = {r.name: F.coalesce(r.check(), F.lit(False)) for r in rules}
    any_failed = reduce(lambda a, b: a | b, [F.col(r.name) for r in rules])
    return (checked.withColumns(flags).withColumn(valid, ~any_failed).drop(DUP))


def rule_counts(flagged: DataFrame, rules: Sequence[Rule],
                valid: str = "is_valid", keep_zero: bool = False) -> DataFrame:
    """(rule, n_rows): rows failing each rule plus total/valid/rejected.

    One aggregate pass (``count_if`` per rule), then an unpivot of the single
    result row. Rules no row fails are left out unless ``keep_zero``.
    """
    aggs = [F.count(F.lit(1)).alias("total"),
            F.count_if(F.col(valid)).alias("valid"),
            F.count_if(~F.col(valid)).alias("rejected")]
    aggs += [F.count_if(F.col(r.name)).alias(r.name) for r in rules]
    names = ["total", "valid", "rejected"] + [r.name for r in rules]
    one = flagged.agg(*aggs)
    long = one.unpivot([], names, "rule", "n_rows")
    if not keep_zero:
        long = long.filter(F.col("rule").isin("total", "valid", "rejected")
                           | (F.col("n_rows") > 0))
    return long

