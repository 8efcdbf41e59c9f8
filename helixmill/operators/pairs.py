"""Candidate primer pairs by a binned band join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import thermo as T
from ..params import STRICT, Params
from .joins import spread
from .places import placed

PAIR_ORDER = [("is_preferred_amplicon_range", True), ("tm_diff", False), ("heterodimer_tm", False), ("gc_balance_abs_diff", False), ("f_ord", False), ("r_ord", False)]


def order_by(keys: list[tuple[str, bool]]) -> list:
    """Sort columns of (name, descending); NaN comes last either way in ascending keys."""
    return [F.desc(c) if down else F.asc(c) for c, down in keys]


def ranked(rows: DataFrame, keys: list[tuple[str, bool]], by: list[str] | None = None, out: str = "position") -> DataFrame:
    """Add the place of each row in the given order, from 1, within `by` (or overall); a stable sort is one whose last
    keys say the order of the input (f_ord and r_ord of pairs, ord of primers).

    Places are counted by ranges of the order (places.placed), so `rows` should be a stored table.
    """
    return placed(rows, by or [], order_by(keys), out).withColumn(out, (F.col(out) + 1).cast("int"))


def sorted_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs in order within each gene: preferred amplicons first, then the temperature difference, the heterodimer's
    temperature and the difference in GC."""
    return pairs.orderBy("gene", *order_by(PAIR_ORDER))


def orientation() -> Column:
    """forward or reverse, in lower case; another value fails the job that meets it."""
    own = F.lower("orientation")
    return F.when(own.isin("forward", "reverse"), own).otherwise(F.raise_error(F.concat(F.lit("orientation "), F.coalesce("orientation", F.lit("null")))).cast("string"))


def split_orientation(primers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The forward and the reverse primers."""
    rows = primers.withColumn("orientation", orientation())
    return rows.filter("orientation = 'forward'"), rows.filter("orientation = 'reverse'")


def candidate_pairs(primers: DataFrame, params: Params = STRICT) -> DataFrame:
    """Forward and reverse primers whose amplicon and temperatures fit, before the heterodimer screen.

    A reverse end lies in the bin of its forward start or in one of the next two, bins being as wide as the longest
    amplicon; so the join is on (gene, bin), and a gene's pairs spread over its bins.
    """
    p = params
    forward, reverse = split_orientation(primers)
    f = forward.select("gene", F.col("sequence").alias("forward_seq"), F.col("msa_start").alias("forward_start"), F.col("msa_end").alias("forward_end"), F.col("tm").alias("tm_forward"), F.col("gc_percent").alias("gc_forward"), F.col("ord").alias("f_ord"))
    r = reverse.select("gene", F.col("sequence").alias("reverse_seq"), F.col("msa_start").alias("reverse_start"), F.col("msa_end").alias("reverse_end"), F.col("tm").alias("tm_reverse"), F.col("gc_percent").alias("gc_reverse"), F.col("ord").alias("r_ord"))
    f = f.withColumn("bin", F.expr(f"forward_start div {p.max_amplicon}"))
    r = r.withColumn("bin", F.explode(F.expr(f"array(reverse_end div {p.max_amplicon}, reverse_end div {p.max_amplicon} - 1)")))
    length = F.col("reverse_end") - F.col("forward_start")
    j = f.join(r, ["gene", "bin"]).filter((F.col("forward_start") < F.col("reverse_start")) & length.between(p.min_amplicon, p.max_amplicon) & (F.abs(F.col("tm_forward") - F.col("tm_reverse")) <= p.max_tm_diff))
    return j.drop("bin").withColumns({
        "amplicon_length": length, "tm_diff": F.abs(F.col("tm_forward") - F.col("tm_reverse")), "gc_balance_abs_diff": F.abs(F.col("gc_forward") - F.col("gc_reverse")),
        "gc_balance_mean": (F.col("gc_forward") + F.col("gc_reverse")) / 2.0, "is_preferred_amplicon_range": length.between(p.preferred_min, p.preferred_max),
    })


def heterodimer_screen(pairs: DataFrame) -> DataFrame:
    """heterodimer_tm of distinct (forward_seq, reverse_seq)."""
    return spread(pairs.select("forward_seq", "reverse_seq"), "forward_seq", "reverse_seq").distinct().withColumn("heterodimer_tm", F.expr(T.duplex_tm("forward_seq", "reverse_seq")))


def primer_pairs(primers: DataFrame, params: Params = STRICT, structure_tm: DataFrame | None = None) -> DataFrame:
    """Candidate pairs that pass the heterodimer limit; NaN passes. structure_tm(forward_seq, reverse_seq,
    heterodimer_tm) overrides the screen."""
    found = candidate_pairs(primers, params)
    screen = heterodimer_screen(found)
    if structure_tm is not None:
        given = structure_tm.select("forward_seq", "reverse_seq", F.col("heterodimer_tm").alias("given"))
        screen = screen.join(given, ["forward_seq", "reverse_seq"], "left").select("forward_seq", "reverse_seq", F.coalesce("given", "heterodimer_tm").alias("heterodimer_tm"))
    out = found.join(screen, ["forward_seq", "reverse_seq"])
    return out.filter((F.col("heterodimer_tm") <= params.max_heterodimer_tm) | F.isnan("heterodimer_tm"))
