"""Primer metrics and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import thermo as T
from ..functions.sequences import gc_clamp, gc_percent, longest_run
from ..params import STRICT, Params
from .joins import spread


def sequence_metrics(primers: DataFrame) -> DataFrame:
    """Composition of each primer; empty and non-ACGT sequences are dropped."""
    p = primers.withColumn("sequence", F.upper("sequence")).filter(F.col("sequence").rlike("^[ACGT]+$"))
    clamp = gc_clamp("sequence")
    return p.withColumns({"length": F.length("sequence"), "gc_percent": gc_percent("sequence"), "max_homopolymer_run": longest_run("sequence"), "gc_clamp_last2_count": clamp, "has_gc_clamp": clamp.between(1, 2)})


def structure_screens(sequences: DataFrame) -> DataFrame:
    """tm, hairpin_tm, homodimer_tm and self_dimer_3p_tm of distinct sequences."""
    return sequences.withColumns({"tm": F.expr(T.oligo_tm("sequence")), "hairpin_tm": F.expr(T.hairpin_tm("sequence")), "homodimer_tm": F.expr(T.duplex_tm("sequence", "sequence")), "self_dimer_3p_tm": F.expr(T.end_duplex_tm("sequence"))})


def override(screens: DataFrame, structure_tm: DataFrame) -> DataFrame:
    """Replace screened values by those of a table structure_tm(sequence, hairpin_tm, homodimer_tm, self_dimer_3p_tm);
    a missing 3' value falls back to the homodimer's."""
    t = structure_tm.select("sequence", *(F.col(c).alias(f"_{c}") for c in ("hairpin_tm", "homodimer_tm", "self_dimer_3p_tm")))
    out = screens.join(t, "sequence", "left")
    own = F.coalesce(F.nanvl("_self_dimer_3p_tm", F.lit(None).cast("double")), F.col("_homodimer_tm"))
    for c, v in (("hairpin_tm", F.col("_hairpin_tm")), ("homodimer_tm", F.col("_homodimer_tm")), ("self_dimer_3p_tm", own)):
        out = out.withColumn(c, F.coalesce(v, F.col(c)))
    return out.select(screens.columns)


def primer_metrics(primers: DataFrame, params: Params = STRICT, structure_tm: DataFrame | None = None) -> DataFrame:
    """All metrics and passed_basic_filters. Screens run on distinct sequences. A NaN structure value passes."""
    rows = sequence_metrics(primers)
    screens = structure_screens(spread(rows.select("sequence"), "sequence").distinct())
    if structure_tm is not None:
        screens = override(screens, structure_tm)
    p = params
    over = lambda c, most: (F.col(c) > most) & ~F.isnan(c)
    ok = (
        F.col("length").between(p.min_len, p.max_len) & F.col("gc_percent").between(p.min_gc, p.max_gc) & F.col("tm").between(p.min_tm, p.max_tm) & ~F.isnan("tm")
        & (F.col("max_homopolymer_run") <= p.max_run) & F.col("gc_clamp_last2_count").between(p.min_clamp, p.max_clamp)
        & ~over("hairpin_tm", p.max_hairpin_tm) & ~over("homodimer_tm", p.max_homodimer_tm) & ~over("self_dimer_3p_tm", p.max_self_dimer_3p_tm)
    )
    return rows.join(screens, "sequence").withColumn("passed_basic_filters", ok)
