"""Business rules as Spark Column expressions (JVM-side, codegen-friendly).

Thresholds are parameters; the defaults are the fixed values below.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's rules for equal results).
#   at-risk:        days_since_last_purchase > 30 AND
#                   (satisfaction_level = 'Unsatisfied' OR average_rating < 3.8)
#   older at-risk:  days_since_last_purchase > 30 AND satisfaction_level = 'Unsatisfied'
#   high value:     total_spend >= 1000.0 -> 1, else 0
#   age group:      age < 35 -> 'Under 35'; 35 <= age <= 50 -> 'Between 35-50';
#                   otherwise (also null) -> 'Over 50'
#   satisfaction A: rating >= 4.3 AND days <= 28 -> 'Satisfied';
#                   rating < 3.7 OR days > 38 -> 'Unsatisfied'; else 'Neutral'
#   satisfaction B: rating > 4.0 -> 'Satisfied'; rating = 4.0 -> 'Neutral';
#                   else 'Unsatisfied'
#   tolerant boolean: trimmed, lower-cased text in {'1', 'true', 'yes', 'y'}
# ---------------------------------------------------------------------------
SATISFIED = "Satisfied"
NEUTRAL = "Neutral"
UNSATISFIED = "Unsatisfied"
UNDER_35 = "Under 35"
BETWEEN_35_50 = "Between 35-50"
OVER_50 = "Over 50"
TRUE_WORDS = ("1", "true", "yes", "y")


@dataclass(frozen=True)
class RiskRule:
    days_over: int = 30
    level: str = UNSATISFIED
    rating_below: float = 3.8


@dataclass(frozen=True)
class SatisfactionRuleA:
    satisfied_rating: float = 4.3
    satisfied_days: int = 28
    unsatisfied_rating: float = 3.7
    unsatisfied_days: int = 38


HIGH_VALUE_SPEND = 1000.0
AGE_YOUNG_BELOW = 35
AGE_MIDDLE_UPTO = 50


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def at_risk(days="days_since_last_purchase", level="satisfaction_level",
            rating="average_rating", rule: RiskRule = RiskRule()) -> Column:
    """Risk flag; an unknown (null) outcome counts as not at risk."""
    recency = _c(days) > F.lit(rule.days_over)
    unhappy = (_c(level) == F.lit(rule.level)) | (_c(rating) < F.lit(rule.rating_below))
    return F.coalesce(recency & unhappy, F.lit(False))


def at_risk_classic(days="days_since_last_purchase", level="satisfaction_level",
                    rule: RiskRule = RiskRule()) -> Column:
    """Older filter predicate: no rating clause; null rows do not pass."""
    return (_c(days) > F.lit(rule.days_over)) & (_c(level) == F.lit(rule.level))


def high_value(spend="total_spend", threshold: float = HIGH_VALUE_SPEND) -> Column:
    return F.when(_c(spend) >= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def age_group(age="age", unknown_label: str | None = None) -> Column:
    a = _c(age)
    expr = F.when(a < F.lit(AGE_YOUNG_BELOW), F.lit(UNDER_35)).when(
        (a >= F.lit(AGE_YOUNG_BELOW)) & (a <= F.lit(AGE_MIDDLE_UPTO)), F.lit(BETWEEN_35_50))
    if unknown_label is not None:
        expr = expr.when(a.isNull(), F.lit(unknown_label))
    return expr.otherwise(F.lit(OVER_50))


def satisfaction_a(rating="average_rating", days="days_since_last_purchase",
                   rule: SatisfactionRuleA = SatisfactionRuleA()) -> Column:
    r, d = _c(rating), _c(days)
    return (F.when((r >= F.lit(rule.satisfied_rating)) & (d <= F.lit(rule.satisfied_days)),
                   F.lit(SATISFIED))
            .when((r < F.lit(rule.unsatisfied_rating)) | (d > F.lit(rule.unsatisfied_days)),
                  F.lit(UNSATISFIED))
            .otherwise(F.lit(NEUTRAL)))


def satisfaction_b(rating="average_rating", pivot: float = 4.0) -> Column:
    r = _c(rating)
    return (F.when(r > F.lit(pivot), F.lit(SATISFIED))
            .when(r == F.lit(pivot), F.lit(NEUTRAL))
            .otherwise(F.lit(UNSATISFIED)))


def clamp(x, lo=None, hi=None) -> Column:
    """Bound a value; null stays null (``greatest``/``least`` would skip it)."""
    col = _c(x)
    out = col
    if hi is not None:
        out = F.least(F.lit(hi), out)
    if lo is not None:
        out = F.greatest(F.lit(lo), out)
    return F.when(col.isNull(), F.lit(None)).otherwise(out)


def parse_bool(x) -> Column:
    """Tolerant text boolean: never null, unknown words are false."""
    return F.coalesce(F.lower(F.trim(_c(x).cast("string"))).isin(*TRUE_WORDS), F.lit(False))
