"""Rule engine: first matching (value, operation, operand) rule rewrites a column.

Rules are validated on the driver before any job runs (unknown operation,
division by zero, empty list).  A short rule list compiles to one ``CASE``
expression; ``apply_rules_by_join`` handles rule sets too long for an
expression by a broadcast join on a rule table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPERATIONS = ("add", "sub", "mul", "div")


def validate_rules(rules: Sequence[tuple]) -> list[tuple]:
    if not rules:
        raise ValueError("rules must not be empty")
    out = []
    for rule in rules:
        if len(rule) != 3:
            raise ValueError(f"rule {rule!r} is not (value, operation, operand)")
        value, op, operand = rule
        if op not in OPERATIONS:
            raise ValueError(f"unknown operation {op!r}; expected one of {OPERATIONS}")
        if not isinstance(operand, (int, float)) or isinstance(operand, bool):
            raise TypeError(f"operand of {rule!r} must be a number")
        if op == "div" and operand == 0:
            raise ValueError(f"rule {rule!r} divides by zero")
        out.append((value, op, float(operand)))
    return out


def _apply(target: Column, op: str, operand: float) -> Column:
    lit = F.lit(operand)
    return {"add": target + lit, "sub": target - lit, "mul": target * lit, "div": target / lit}[op]


def rule_expr(condition, target, rules: Sequence[tuple]) -> Column:
    """``CASE WHEN cond = v1 THEN target op1 x1 WHEN ... ELSE target END`` (first match wins)."""
    rules = validate_rules(rules)
    cond = F.col(condition) if isinstance(condition, str) else condition
    tgt = F.col(target) if isinstance(target, str) else target
    expr = None
    for value, op, operand in rules:
        branch = _apply(tgt, op, operand)
        expr = F.when(cond == F.lit(value), branch) if expr is None else expr.when(cond == F.lit(value), branch)
    return expr.otherwise(tgt)


def apply_conditional_operations(df: DataFrame, condition_col: str, target_col: str, rules: Sequence[tuple],
                                 output_col: str = "adjusted_value") -> DataFrame:
    return df.withColumn(output_col, rule_expr(condition_col, target_col, rules))


def apply_rules_by_join(df: DataFrame, rules_df: DataFrame, condition_col: str, target_col: str,
                        output_col: str = "adjusted_value") -> DataFrame:
    """Rule table ``(value, op, operand, priority)`` form for large rule sets.

    The table is reduced to the first rule per value (lowest priority) with an
    aggregate, so duplicates never fan rows out, then joined on the value.
    """
    first = (rules_df.groupBy("value")
             .agg(F.min_by(F.struct("op", "operand"), F.col("priority")).alias("__r")))
    joined = df.join(first, df[condition_col] == first["value"], "left")
    tgt, op, x = F.col(target_col), F.col("__r.op"), F.col("__r.operand")
    val = (F.when(op == "add", tgt + x).when(op == "sub", tgt - x).when(op == "mul", tgt * x)
           .when(op == "div", F.try_divide(tgt, x)).otherwise(tgt))
    return joined.withColumn(output_col, val).drop("value", "__r")
