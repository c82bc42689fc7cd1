"""Score normalization and binning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score range, bin width and number of bins of the null tables.
MIN_SCORE, MAX_SCORE = 0.0, 62.0
BIN_WIDTH = 7.14285e-4
BINS = 1401


def clamped(score: Column) -> Column:
    """Score limited to the calibrated range; NULL stays NULL (``least`` alone would not)."""
    return F.when(
        score.isNotNull(), F.least(F.greatest(score, F.lit(MIN_SCORE)), F.lit(MAX_SCORE))
    )


def score_norm(score: Column) -> Column:
    return (clamped(score) - MIN_SCORE) / (MAX_SCORE - MIN_SCORE)


def bin_index(norm: Column) -> Column:
    """0-based position in a null row: the number of breakpoints k*width <= norm, less one.

    The floor of the quotient can miss by one next to a breakpoint, so it is
    corrected against the breakpoints themselves.
    """
    guess = F.floor(norm / BIN_WIDTH)
    exact = (
        F.when((guess + 1) * F.lit(BIN_WIDTH) <= norm, guess + 1)
        .when(guess * F.lit(BIN_WIDTH) > norm, guess - 1)
        .otherwise(guess)
    )
    return F.when(norm.isNotNull(), F.least(exact, F.lit(BINS - 1)).cast("int"))


def score_bin(norm: Column) -> Column:
    """1-based column of a null table whose first column is the gene."""
    return bin_index(norm) + 2
