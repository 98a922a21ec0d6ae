"""Probabilities as column expressions, evaluated by Spark."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abramowitz and Stegun 26.2.17, error below 7.5e-8.
NORMAL_P = 0.2316419
NORMAL_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
# Default of the tests' ``exact_up_to``: beyond it the exact p costs n^3 steps and the approximation is close.
EXACT_UP_TO = 50


def normal_upper_tail(z: Column) -> Column:
    """P(Z > z)."""
    t = 1 / (1 + F.lit(NORMAL_P) * F.abs(z))
    series = F.lit(0.0)
    for b in reversed(NORMAL_B):
        series = (series + F.lit(b)) * t
    tail = F.exp(-z * z / 2) / F.sqrt(2 * F.pi()) * series
    return F.when(z >= 0, tail).otherwise(1 - tail)


def signed_rank_exact_p(n: Column, w: Column) -> Column:
    """Two-sided p of the smaller signed-rank sum ``w`` of n untied, non-zero differences.

    Counts the sign patterns of ranks 1..n whose sum is at most w, adding one rank at a time.
    """
    zero = F.transform(F.sequence(F.lit(0), w), lambda s: F.when(s == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    ways = F.aggregate(
        F.sequence(F.lit(1), n), zero,
        lambda acc, k: F.transform(acc, lambda c, s: c + F.when(s >= k, F.get(acc, s - k)).otherwise(F.lit(0.0))))
    total = F.aggregate(ways, F.lit(0.0), lambda a, c: a + c)
    return F.least(F.lit(1.0), 2 * total / F.pow(F.lit(2.0), n))


def signed_rank_normal_p(n: Column, w: Column, tie_term: Column, correction: bool = False) -> Column:
    """Two-sided normal approximation; ``tie_term`` is the sum of t^3 - t over groups of tied ranks."""
    mean = n * (n + 1) / 4
    sd = F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - tie_term / 48)
    gap = F.abs(w - mean) - (F.lit(0.5) if correction else F.lit(0.0))
    return F.when(sd > 0, F.least(F.lit(1.0), 2 * normal_upper_tail(gap / sd))).otherwise(F.lit(1.0))


def signed_rank_permutation_p(doubled: Column, statistic: Column) -> Column:
    """Two-sided exact p of a signed-rank statistic whose ranks may be shared: ``doubled`` holds twice each mean rank.

    Doubled mean ranks are whole numbers, so the distribution of their signed sums over all 2^n signs is built
    rank by rank. Work grows with the cube of the ranks: meant for the runs of a comparison.
    """
    zero = F.lit(0).cast("long")
    total = F.aggregate(doubled, zero, lambda a, r: a + r)
    start = F.transform(F.sequence(zero, total), lambda i: F.when(i == 0, 1.0).otherwise(0.0))
    chances = F.aggregate(doubled, start, lambda c, r: F.transform(c, lambda x, i: (x + F.coalesce(F.get(c, (i - r).cast("int")), F.lit(0.0))) / 2))
    tail = F.aggregate(F.slice(chances, F.lit(1), (2 * statistic).cast("int") + 1), F.lit(0.0), lambda a, x: a + x)
    return F.least(F.lit(1.0), 2 * tail)
