"""Weighted rules to a capped score, a flag and a reason.

Weights are decimals, so a sum meets the threshold exactly or not at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.functions.scalars import score as as_score


@dataclass(frozen=True)
class Rule:
    """Adds ``weight`` where ``condition`` holds; a NULL condition adds nothing."""

    name: str
    condition: Column
    weight: Decimal

    def points(self) -> Column:
        return F.when(self.condition, F.lit(self.weight)).otherwise(F.lit(Decimal("0.00")))

    def hit(self) -> Column:
        return F.when(self.condition, F.lit(self.name))


def default_rules(normalize_case: bool = False) -> list[Rule]:
    category = F.col("merchant_category")
    if normalize_case:
        category = F.lower(category)
    first, last = S.NIGHT_HOURS
    return [
        Rule("high_value", F.col("amount") > S.HIGH_VALUE, S.VALUE_WEIGHT),
        Rule("night", F.hour("event_time").between(first, last), S.NIGHT_WEIGHT),
        Rule("risky_category", category.isin(*S.RISKY_CATEGORIES), S.CATEGORY_WEIGHT),
    ]


def velocity_rule(hit: Column | None = None, weight: Decimal = S.VELOCITY_WEIGHT) -> Rule:
    return Rule("velocity", F.col("velocity_hit") if hit is None else hit, weight)


def _capped(total: Column) -> Column:
    return as_score(F.least(total, F.lit(S.SCORE_CAP)))


def score(rows: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Add ``risk_score`` and the names of the rules that fired."""
    rules = default_rules() if rules is None else rules
    total = F.lit(S.BASE_WEIGHT)
    for rule in rules:
        total = total + rule.points()
    hits = F.array_compact(F.array(*[rule.hit() for rule in rules]))
    return rows.withColumns({"risk_score": _capped(total), "rule_hits": hits})


def flag(scored: DataFrame, reason: str = S.REASON_HIGH) -> DataFrame:
    """Add ``is_fraud_suspect`` and ``fraud_reason`` from the score."""
    suspect = F.col("risk_score") >= F.lit(S.SUSPECT_THRESHOLD)
    return scored.withColumns(
        {"is_fraud_suspect": suspect, "fraud_reason": F.when(suspect, F.lit(reason))}
    )


def add_velocity(
    flagged: DataFrame,
    hit: Column,
    weight: Decimal = S.VELOCITY_WEIGHT,
    reason: str = S.REASON_CRITICAL,
) -> DataFrame:
    """Raise the score where ``hit`` holds, and flag again.

    The earlier flag and reason stay where the raised score is below the threshold.
    """
    velocity = velocity_rule(hit, weight)
    raised = flagged.withColumns(
        {
            "risk_score": _capped(F.col("risk_score") + velocity.points()),
            "rule_hits": F.array_compact(
                F.concat(F.col("rule_hits"), F.array(velocity.hit()))
            ),
        }
    )
    suspect = F.col("risk_score") >= F.lit(S.SUSPECT_THRESHOLD)
    return raised.withColumns(
        {
            "is_fraud_suspect": suspect | F.col("is_fraud_suspect"),
            "fraud_reason": F.when(suspect, F.lit(reason)).otherwise(F.col("fraud_reason")),
        }
    )
