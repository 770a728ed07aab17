"""Named quality rules (E1–E3): drop failing rows, count failures.

A rule is a SQL boolean expression. A rule that evaluates to NULL counts as
failed — ``year > 1900`` must drop a NULL year.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F


def rule_passes(expr: str) -> Column:
    return F.coalesce(F.expr(expr), F.lit(False))


def all_rules_pass(rules: Mapping[str, str]) -> Column:
    cond = F.lit(True)
    for expr in rules.values():
        cond = cond & rule_passes(expr)
    return cond


def all_rules_pass_as_one(rules: Mapping[str, str]) -> Column:
    """All rules as ONE predicate, ``coalesce(r1 AND r2 AND ..., false)``.

    Same truth value as ``all_rules_pass``, but not split into conjuncts, so
    the optimizer moves it only as a whole (it cannot push a key-only part
    below a window and recompute it from raw columns).
    """
    return F.coalesce(F.expr(" AND ".join(f"({e})" for e in rules.values())), F.lit(False))


def expect_all_or_drop(df: DataFrame, rules: Mapping[str, str], split: bool = True) -> DataFrame:
    """Keep only rows that pass every rule (a narrow filter, no shuffle).

    ``split=False`` keeps the rules one predicate (see ``all_rules_pass_as_one``).
    """
    if not rules:
        return df
    return df.where(all_rules_pass(rules) if split else all_rules_pass_as_one(rules))


def expect_or_drop(df: DataFrame, name: str, expr: str) -> DataFrame:
    return expect_all_or_drop(df, {name: expr})


def expectation_metrics(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row: ``rows_in``, ``rows_out`` and ``failed_<rule>`` per rule.

    A single global aggregate: partial counts per task, one tiny final merge.
    """
    aggs = [F.count(F.lit(1)).alias("rows_in"),
            F.count_if(all_rules_pass(rules)).alias("rows_out")]
    aggs += [F.count_if(~rule_passes(e)).alias(f"failed_{n}") for n, e in rules.items()]
    return df.agg(*aggs)


def gate_metrics(rules: Mapping[str, str]) -> list[Column]:
    """Aggregates for an Observation: rows reaching the gate, rows passing,
    and failures per rule."""
    return ([F.count(F.lit(1)).alias("rows_in"), F.count_if(all_rules_pass(rules)).alias("rows_out")]
            + [F.count_if(~rule_passes(e)).alias(f"failed_{n}") for n, e in rules.items()])


def observe_expectations(df: DataFrame, rules: Mapping[str, str],
                         name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Gate inline and collect per-rule failure counts as a side metric.

    The counts arrive when the returned frame is executed (no extra pass).
    """
    obs = Observation(name)
    observed = df.observe(obs, *gate_metrics(rules))
    return expect_all_or_drop(observed, rules), obs
