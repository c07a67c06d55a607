"""Labels from a panel's next periods: three-valued rules over the entity's rows at m, m+1 and m+2."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minespark.functions.periods import month_add
from minespark.functions.predicates import three_valued


@dataclass(frozen=True)
class LabelRule:
    """A label as SQL over a.*, b.*, c.* (the periods m, m+1, m+2): null where `null_when` holds, else 1 where `one_when` holds, else 0.

    A condition that is unknown doesn't hold, so unknown eligibility falls through to 0 or 1.
    """

    name: str
    one_when: str
    null_when: str | None = None


def next_period_labels(panel: DataFrame, rules: Sequence[LabelRule], *, entity: str, period: str, at: str | Sequence[str], ahead: int = 2, spare: int = 0) -> DataFrame:
    """(period, entity, labels): the entities of period `at` with their labels, plus `spare` null ones. `at` may list the periods m, m+1, ... itself.

    Periods are pruned before the joins; the sides share the entity's partitioning, so each costs one shuffle.
    """
    periods = [month_add(at, i) for i in range(ahead + 1)] if isinstance(at, str) else list(at)
    sides = [panel.where(F.col(period) == p).alias(n) for p, n in zip(periods, "abc")]
    joined = sides[0]
    for n, side in zip("bc", sides[1:]):
        joined = joined.join(side, F.col(f"a.{entity}") == F.col(f"{n}.{entity}"), "left")
    return joined.select(F.col(f"a.{period}").alias("month_id"), F.col(f"a.{entity}").alias(entity), *_labels(rules, spare))


def _labels(rules: Sequence[LabelRule], spare: int) -> list[Column]:
    out = [three_valued(F.expr(r.null_when) if r.null_when else None, F.expr(r.one_when)).alias(r.name) for r in rules]
    return out + [F.lit(None).cast("int").alias(f"flag_{i}") for i in range(1, spare + 1)]


def presence_rules(entity: str, billed: str, in_use: str, churn: str | None = None) -> list[LabelRule]:
    """Left, not billed, bad status and churn, from SQL conditions on b for 'billed' and 'in use'; churn's own condition if given."""
    gone = f"b.{entity} is null"
    return [
        LabelRule("flag_lw", gone),
        LabelRule("flag_notacct", f"not ({billed})", gone),
        LabelRule("flag_badstatus", f"not ({in_use})", gone),
        LabelRule("flag_ls", f"{gone} or {churn or f'not ({billed})'} or not ({in_use})"),
    ]


def increase_rule(name: str, column: str, null_when: str | None = None) -> LabelRule:
    """1 if the next period has more of something; 0 too where it is absent, as an unknown comparison doesn't hold."""
    return LabelRule(name, f"b.{column} > a.{column}", null_when)


def newly_has_rule(name: str, column: str, eligible: str) -> LabelRule:
    """Among the eligible: 1 if the next period has any of something."""
    return LabelRule(name, f"b.{column} > 0", f"not ({eligible})")


def change_rule(name: str, *, entity: str, eligible: str, changed: str, direction: str, amount: str) -> LabelRule:
    """Among the eligible present in both next periods: 1 if `changed` and the amount at m+2 is > or < that at m."""
    return LabelRule(name, f"({changed}) and c.{amount} {direction} a.{amount}", f"not ({eligible}) or b.{entity} is null or c.{entity} is null")
