"""Column functions on sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = ("A", "C", "G", "T")


def reverse_complement(seq: Column | str) -> Column:
    """Complement of ACGT in either case, N and gaps kept, read backwards; other characters pass."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def ambiguous_fraction(seq: Column | str) -> Column:
    """Share of characters that are not A, C, G or T in either case; 1 for an empty sequence."""
    n = F.length(seq)
    bad = F.length(F.regexp_replace(F.upper(seq), "[ACGT]", ""))
    return F.when(n == 0, F.lit(1.0)).otherwise(bad / n)


def gc_percent(seq: Column | str) -> Column:
    n = F.length(seq)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.length(F.regexp_replace(seq, "[^GC]", "")) * 100.0 / n)


def longest_run(seq: Column | str) -> Column:
    """Length of the longest run of one base."""
    runs = F.regexp_extract_all(seq, F.lit("(A+|C+|G+|T+)"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(runs, lambda r: F.length(r))), F.lit(0))


def gc_clamp(seq: Column | str) -> Column:
    """G and C among the last two bases."""
    return F.length(F.regexp_replace(F.right(seq, F.lit(2)), "[^GC]", ""))


def clip01(x: Column) -> Column:
    """Clamp to [0, 1]; NaN stays (greatest and least take it for the largest number)."""
    return F.when(F.isnan(x), x).otherwise(F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)))


def linear_penalty(x: Column, good: float, bad: float) -> Column:
    """0 up to good, 1 from bad, linear between."""
    return clip01((x - good) / (bad - good))
