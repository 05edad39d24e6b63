"""Advertising metrics as column expressions.

Sums of money arrive as exact decimals. A rounded metric is worked out in whole numbers of
cents, halves away from zero, and turns into a double at the very end: no value passes
through a double before it is rounded.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double; null when the denominator is zero.

    Written with ``when``: ``nullif`` is planned as a projection of its own, which
    parts a limit from its sort and turns a top-k into a full sort."""
    below = _col(denominator).cast("double")
    return F.when(below != 0, _col(numerator).cast("double") / below)


def _whole(value: Column | str, cents: bool) -> Column:
    """A count, or an amount of money in cents, as a whole number."""
    return (_col(value) * 100 if cents else _col(value)).cast("decimal(38,0)")


def _hundredths(above: Column, below: Column, times: int) -> Column:
    """``times * above / below`` with two decimals; null where ``below`` is zero."""
    a, b = F.abs(above), F.abs(below)
    size = F.call_function("div", a * (200 * times) + b, b * 2)
    signed = F.when((above < 0) != (below < 0), -size).otherwise(size)
    return F.when(below != 0, signed.cast("double") / 100)


def ctr_pct(clicks: Column | str, impressions: Column | str) -> Column:
    return _hundredths(_whole(clicks, False), _whole(impressions, False), 100)


def ctr_fraction(clicks: Column | str, impressions: Column | str) -> Column:
    return F.coalesce(ratio(clicks, impressions), F.lit(0.0))


def cpm(cost: Column | str, impressions: Column | str) -> Column:
    return _hundredths(_whole(cost, True), _whole(impressions, False), 10)


def cpc(cost: Column | str, clicks: Column | str) -> Column:
    return _hundredths(_whole(cost, True), _whole(clicks, True), 1)


def roas(revenue: Column | str, cost: Column | str) -> Column:
    return _hundredths(_whole(revenue, True), _whole(cost, True), 1)


def budget_used_pct(spent: Column | str, budget: Column | str) -> Column:
    return _hundredths(_whole(spent, True), _whole(budget, True), 100)


def over_share(spent: Column | str, budget: Column | str, share: float) -> Column:
    """Whether more than ``share`` of the budget is spent; never of a zero budget."""
    return (_col(budget) != 0) & (_col(spent) > _col(budget) * F.lit(Decimal(str(share))))


def clicks_by_revenue(ad_revenue: Column | str = "ad_revenue") -> Column:
    """Aggregate: rows that earned something count as clicked."""
    return F.count(F.when(_col(ad_revenue) > 0, True))


def as_double(name: str) -> Column:
    return F.col(name).cast("double").alias(name)
