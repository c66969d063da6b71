"""Threshold rules such as ``<=10%`` and trend bands such as ``-15%<->15%`` as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Comparison operators in the order in which a rule is searched for them, and the text marks.
OPERATORS = ["<=", ">=", "<", ">", "=="]
BAND_MARK = "<->"
PERCENT_MARK = "%"
PASS, FAIL, ABORT = "Pass", "Fail", "Abort"

_COMPARE = {
    "<=": lambda value, limit: value <= limit,
    ">=": lambda value, limit: value >= limit,
    "<": lambda value, limit: value < limit,
    ">": lambda value, limit: value > limit,
    "==": lambda value, limit: value == limit,
}


def rule_operator(rule: Column) -> Column:
    """The first operator of the fixed order that the rule contains; NULL when it has none."""
    return F.coalesce(*[F.when(rule.contains(op), F.lit(op)) for op in OPERATORS])


def _before_percent(text: Column) -> Column:
    return F.substring_index(text, PERCENT_MARK, 1)


def rule_limit(rule: Column) -> Column:
    """The whole number after the operator and before the percent sign; NULL when it cannot be read."""
    return F.split_part(_before_percent(rule), rule_operator(rule), F.lit(2)).try_cast("int")


def band_low(band: Column) -> Column:
    return _before_percent(F.split_part(band, F.lit(BAND_MARK), F.lit(1))).try_cast("int")


def band_high(band: Column) -> Column:
    return _before_percent(F.split_part(band, F.lit(BAND_MARK), F.lit(2))).try_cast("int")


def pass_or_fail(holds: Column) -> Column:
    """NULL counts as not holding."""
    return F.when(holds, F.lit(PASS)).otherwise(F.lit(FAIL))


def rule_verdict(value: Column, rule: Column) -> Column:
    """Pass or Fail of a value under a rule; NULL when the rule has no operator."""
    operator, limit = rule_operator(rule), rule_limit(rule)
    branches = reduce(
        lambda chain, op: chain.when(operator == op, _COMPARE[op](value, limit)),
        OPERATORS[1:],
        F.when(operator == OPERATORS[0], _COMPARE[OPERATORS[0]](value, limit)),
    )
    return F.when(operator.isNotNull(), pass_or_fail(branches))


def band_verdict(value: Column, band: Column) -> Column:
    """Pass when the value lies in the band, both ends included; NULL when there is no band."""
    return F.when(band.isNotNull(), pass_or_fail(value.between(band_low(band), band_high(band))))
