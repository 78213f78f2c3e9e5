"""The amount detector's fold, exact and shared by batch blocks and streams.

A user's amounts are compared with the average of the amounts not flagged so
far. Totals are whole micro-units (the amount with 6 decimals, times a million)
and the test is ``amount * count >= factor * total`` on integers, so neither
the order of additions nor the cut into blocks or micro-batches changes a
verdict.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

MICRO = 1_000_000


def micro_units(amount: Column | str = "amount") -> Column:
    """Amount in whole micro-units (half up on its shortest decimal form) where these fit a long, else null (see ``exact_units``)."""
    a = F.col(amount) if isinstance(amount, str) else amount
    return (a.try_cast("decimal(20,6)") * MICRO).try_cast("bigint")


def exact_units(units: int | None, amount: float | None) -> int | None:
    """The units of ``micro_units``, or by the same rule those of an amount too large for it; None for no amount (null, NaN, infinite).

    Batch blocks and streams both take an amount through these two, so it has the same units on every path, whatever its size.
    """
    if units is not None or amount is None or not math.isfinite(amount):
        return units
    return int((Decimal(repr(float(amount))) * MICRO).to_integral_value(ROUND_HALF_UP))


def ratio(factor: float) -> tuple[int, int]:
    f = Fraction(str(factor))
    return f.numerator, f.denominator


def fold(units: list[int | None], total: int, count: int, factor: tuple[int, int]) -> tuple[list[int], int, int]:
    """Scores of one user's amounts in order, from the state (total, count) of unflagged amounts; and the new state.

    With count 0 the first amount starts the state and scores 0. No amount: score 0, state unchanged.
    """
    num, den = factor
    scores = [0] * len(units)
    for i, a in enumerate(units):
        if a is None:
            continue
        if count and a * count * den >= num * total:
            scores[i] = 1
        else:
            total += a
            count += 1
    return scores, total, count


def fold_all(units: list[int | None], total: int, count: int, factor: tuple[int, int]) -> tuple[list[int], int, int]:
    """As ``fold``, but the state takes in every amount, flagged or not."""
    num, den = factor
    scores = [0] * len(units)
    for i, a in enumerate(units):
        if a is None:
            continue
        scores[i] = int(count > 0 and a * count * den >= num * total)
        total += a
        count += 1
    return scores, total, count


@dataclass
class Margin:
    """How far one block's decisions are from the line, so that another entry state can be seen to change none.

    ``slack = den * amount * count - num * total`` is >= 0 for a flagged amount and < 0 for a
    kept one. Kept are the least slack and the smallest and largest amount of the
    flagged, the largest slack and the same of the kept.
    """

    flagged: tuple[int, int, int] | None = None
    kept: tuple[int, int, int] | None = None

    def add(self, units: list[int | None], scores: list[int], total: int, count: int, factor: tuple[int, int]) -> None:
        num, den = factor
        for a, s in zip(units, scores):
            if a is None:
                continue
            if count:
                slack = den * a * count - num * total
                if s:
                    f = self.flagged or (slack, a, a)
                    self.flagged = (min(f[0], slack), min(f[1], a), max(f[2], a))
                else:
                    k = self.kept or (slack, a, a)
                    self.kept = (max(k[0], slack), min(k[1], a), max(k[2], a))
            if not s:
                total += a
                count += 1

    def holds(self, d_total: int, d_count: int, factor: tuple[int, int]) -> bool:
        """True if no decision changes when the entry state grows by (d_total, d_count)."""
        num, den = factor
        if self.flagged:
            slack, lo, hi = self.flagged
            if slack + den * (lo if d_count >= 0 else hi) * d_count - num * d_total < 0:
                return False
        if self.kept:
            slack, lo, hi = self.kept
            if slack + den * (hi if d_count >= 0 else lo) * d_count - num * d_total >= 0:
                return False
        return True
