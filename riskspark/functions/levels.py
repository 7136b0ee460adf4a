"""Risk levels. The three border rules differ on purpose and keep their own names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

HIGH, MEDIUM, LOW = "High", "Medium", "Low"
DEFAULT_HIGH, DEFAULT_LOW = 0.8, 0.2


def level_hml(score: Column, high, low) -> Column:
    """High from ``high`` on, Medium in [low, high), else Low."""
    return F.when(score >= high, HIGH).when(score >= low, MEDIUM).otherwise(LOW)


def level_tag(score: Column, high, low) -> Column:
    """High from ``high`` on, Low up to and including ``low``, else Medium."""
    return F.when(score >= high, HIGH).when(score <= low, LOW).otherwise(MEDIUM)


def level_int(score: Column, high, low) -> Column:
    """0 below ``low``, 2 above ``high``, else 1; null stays null."""
    return F.when(score.isNull(), F.lit(None).cast("int")).when(score < low, 0).when(score > high, 2).otherwise(1)


def rank_of(level: Column) -> Column:
    return F.when(level == HIGH, 3).when(level == MEDIUM, 2).when(level == LOW, 1)


def level_of(rank: Column) -> Column:
    return F.when(rank == 3, HIGH).when(rank == 2, MEDIUM).when(rank == 1, LOW)


def level_max(levels: Sequence[Column]) -> Column:
    return level_of(F.greatest(*[rank_of(x) for x in levels]))


def level_vote(levels: Sequence[Column]) -> Column:
    """Most frequent level; on a tie the highest present; High when none is given."""
    counts = [reduce(lambda a, b: a + b, [F.when(x == name, 1).otherwise(0) for x in levels]) for name in (HIGH, MEDIUM, LOW)]
    top = F.greatest(*counts)
    winners = reduce(lambda a, b: a + b, [F.when(c == top, 1).otherwise(0) for c in counts])
    single = F.when(counts[0] == top, HIGH).when(counts[1] == top, MEDIUM).otherwise(LOW)
    return F.when(top == 0, HIGH).when(winners == 1, single).otherwise(level_max(levels))
