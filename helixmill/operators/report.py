"""Human-readable reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EMPTY = "No primer pairs passed final ranking."


def _n(c: str, digits: int):
    """Fixed decimals of the value rounded half to even of its shortest form; NaN stays a word."""
    return F.when(F.isnan(c), F.lit("nan")).otherwise(F.format_string(f"%.{digits}f", F.bround(F.col(c), digits)))


def report_lines(top: DataFrame) -> DataFrame:
    """gene, rank and text: the lines of each ranked pair."""
    s = F.lit
    text = F.concat_ws(
        "\n",
        F.concat(F.col("rank"), s(". score="), _n("final_score", 2), s(" | pair_cov="), _n("pair_coverage", 3), s(" | amplicon="), F.col("amplicon_length"), s(" bp")),
        *(
            F.concat(s(f"   {tag} "), F.col(f"{side}_sequence"), s(" ["), F.col(f"{side}_msa_start"), s(","), F.col(f"{side}_msa_end"), s(") Tm="), _n(f"tm_{side}", 2), s(" GC="), _n(f"gc_{side}", 2), s(" cov="), _n(f"{side}_coverage", 3))
            for tag, side in (("FWD", "forward"), ("REV", "reverse"))
        ),
        F.concat(s("   3' mismatches (F="), F.col("forward_3prime_mismatch_count"), s(", R="), F.col("reverse_3prime_mismatch_count"), s(")")),
        F.concat(s("   Hairpin(F/R)=("), _n("forward_hairpin_tm", 2), s("/"), _n("reverse_hairpin_tm", 2), s(") Homodimer(F/R)=("), _n("forward_homodimer_tm", 2), s("/"), _n("reverse_homodimer_tm", 2), s(") Heterodimer="), _n("heterodimer_tm", 2)),
        F.concat(s("   "), F.col("offtarget_summary")),
    )
    return top.select("gene", "rank", text.alias("text"))


def report(genes: DataFrame, top: DataFrame) -> DataFrame:
    """gene and text: the whole report of every gene, also of those without pairs (top_n bounds the list)."""
    lines = report_lines(top).groupBy("gene").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda r: r["text"]), "\n\n").alias("body"))
    text = F.when(F.col("n").isNull(), F.lit(EMPTY + "\n")).otherwise(F.concat(F.lit("Top primer pairs: "), F.col("n"), F.lit("\n\n"), F.col("body"), F.lit("\n")))
    return genes.select("gene").distinct().join(lines, "gene", "left").select("gene", text.alias("text"))
