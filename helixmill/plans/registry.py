"""The registered queries of the assay operators, each over the whole derived tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import thermo as T
from ..functions.sequences import ambiguous_fraction, reverse_complement
from ..operators import candidates, coverage, pairs, profile, pruning, records, regions, report, scoring, specificity, status, thermo
from ..params import STRICT, Params, Scoring
from ..sources import fasta, tables
from ..storage import folder, stored
from . import fixtures, oracle
from .design import Design


#: The derived alignments are random DNA, of which few primers are as good as the strict preset asks; the queries
#: keep its alignment limits and widen those of composition and temperature.
WIDE = STRICT.with_(min_gc=30.0, max_gc=70.0, min_tm=48.0, max_tm=70.0, max_run=5, min_clamp=0, max_tm_diff=3.5)


def _round(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison between engines."""
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


class Assay(Design):
    """The tables of a run over the derived alignments of a folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = WIDE, weights: Scoring = Scoring()):
        super().__init__(spark, fixtures.msa(spark, sf_dir), params, weights)
        self.sf_dir = sf_dir

    @cached_property
    def records(self) -> DataFrame:
        return fixtures.records(self.spark, self.sf_dir)


def _fasta_roundtrip(a: Assay) -> DataFrame:
    path = folder(a.spark, "fasta")
    fasta.write_fasta(records.non_empty(a.records), path)
    return fasta.read_fasta(a.spark, path).select("id", "description", F.length("seq").alias("n"), F.md5("seq").alias("seq_md5"))


def _alignment_roundtrip(a: Assay) -> DataFrame:
    path = folder(a.spark, "alignment")
    fasta.write_fasta(a.msa.select(F.concat("id", F.lit(" gene="), "gene").alias("description"), F.lower("aligned").alias("seq")), path)
    back = fasta.read_alignment(a.spark, path).withColumn("gene", F.substring_index("description", "gene=", -1))
    fasta.check_alignment(back)
    return back.select("gene", "id", F.md5("aligned").alias("aligned_md5"))


def _regions_roundtrip(a: Assay) -> DataFrame:
    path = folder(a.spark, "regions")
    tables.write_regions_json(a.regions, path)
    return tables.read_regions_lines(a.spark, path)


def _pairs_roundtrip(a: Assay) -> DataFrame:
    out = None
    for kind in ("csv", "tsv", "json"):
        path = folder(a.spark, kind)
        if kind == "json":
            tables.write_json(a.top, path)
            back = a.spark.read.schema(a.top.schema).json(path)
        else:
            tables.write_csv(a.top, path, "," if kind == "csv" else "\t")
            back = a.spark.read.option("header", True).option("sep", "," if kind == "csv" else "\t").schema(a.top.schema).csv(path)
        back = back.select(F.lit(kind).alias("kind"), "gene", "rank", "forward_sequence", "reverse_sequence", "amplicon_length", "offtarget_summary", "final_score")
        out = back if out is None else out.unionByName(back)
    return out


def _hit_scan(a: Assay) -> DataFrame:
    """Hits written as tabular lines, with a broken copy of each line of the first subject, and read back."""
    path = folder(a.spark, "hits")
    h = a.hits.withColumns({"evalue": F.lit(0.0), "bitscore": F.lit(0.0), "sstrand": F.upper("sstrand")})
    lines = F.concat_ws("\t", *(F.col(c).cast("string") for c in tables.HITS))
    good = h.select(lines.alias("value"))
    broken = h.select(F.concat_ws("\t", *(F.col(c).cast("string") for c in tables.HITS[:15])).alias("value"))
    good.unionByName(broken).write.text(path)
    return tables.read_hits(a.spark, path).groupBy("query_id", "sstrand").agg(F.count("*").alias("n"), F.sum("align_len").alias("letters"), F.max("qend").alias("qend"))


_SINGLE = ["gene", "sequence", "orientation", "msa_start", "msa_end", "ord", "matched_sequences_count", "total_mismatch_count", "prime3_mismatch_count", "gap_overlap_count", "weighted_mismatch_score_sum", "coverage_fraction"]
_HIT = ["query_id", "subject_id", "sstrand", "pident", "align_len", "mismatch", "qstart", "qend", "sstart", "send", "qlen", "qseq", "sseq"]


def _regions_array(a: Assay) -> DataFrame:
    """Regions as one JSON array for each gene, read back by the array scan."""
    path = folder(a.spark, "arrays")
    item = F.struct("gene", "region_index", "start_col", "end_col", "mean_score")
    a.regions.groupBy(F.col("gene").alias("part")).agg(F.to_json(F.sort_array(F.collect_list(item))).alias("value")).write.partitionBy("part").text(path)
    return tables.read_regions_json(a.spark, path)


def _report_sink(a: Assay) -> DataFrame:
    """The report of each gene written as one text file, and read back whole."""
    path = folder(a.spark, "report")
    tables.write_report(report.report(_all_genes(a), a.top), path)
    return tables.read_whole(a.spark, path)


def _table_sinks(a: Assay) -> DataFrame:
    """The CSV, TSV and JSON file of each gene, read back whole: their lines' first fields in order, or the length."""
    out = None
    for kind, sep in (("csv", ","), ("tsv", "\t")):
        path = folder(a.spark, kind)
        tables.write_delimited(_all_genes(a), a.top, path, sep)
        own = tables.read_whole(a.spark, path).select(F.lit(kind).alias("kind"), "gene", F.expr(f"array_join(transform(split(trim(TRAILING '\n' FROM text), '\n'), x -> substring_index(x, '{sep}', 2)), ';')").alias("fields"))
        out = own if out is None else out.unionByName(own)
    path = folder(a.spark, "json")
    tables.write_json_arrays(_all_genes(a), a.top, path)
    rows = F.from_json("text", "array<struct<forward_sequence:string,reverse_sequence:string>>")
    fields = F.array_join(F.transform(rows, lambda r: F.concat_ws(",", r["forward_sequence"], r["reverse_sequence"])), ";")
    return out.unionByName(tables.read_whole(a.spark, path).select(F.lit("json").alias("kind"), "gene", fields.alias("fields")))


def _all_genes(a: Assay) -> DataFrame:
    """The genes of the alignment, and one that has no rows."""
    return a.msa.select("gene").distinct().unionByName(a.spark.createDataFrame([("none at all",)], "gene string"))


def _solved(a: Assay) -> DataFrame:
    """Structure temperatures that stand in for solved ones: of primers that begin with A; some without a 3' value."""
    own = a.primers.select("sequence").distinct().filter("sequence LIKE 'A%'")
    return own.select("sequence", F.lit(10.0).alias("hairpin_tm"), (F.length("sequence") * 2.0).alias("homodimer_tm"), F.when(F.col("sequence").like("%C"), F.lit(50.0)).alias("self_dimer_3p_tm"))


def _orientations(a: Assay) -> DataFrame:
    """Primers of either side by their number, from orientations in upper and lower case."""
    forward, reverse = pairs.split_orientation(a.primers.withColumn("orientation", F.when(F.col("msa_start") % 2 == 0, F.upper("orientation")).otherwise(F.col("orientation"))))
    return forward.unionByName(reverse).groupBy("gene", "orientation").agg(F.count("*").alias("n"))


def _supplied(a: Assay) -> DataFrame:
    """3' conservation that stands in for a measured one, of sequences of at least half G and C."""
    return a.filtered.filter("gc_percent >= 50").select("gene", "sequence", (F.col("gc_percent") / 100.0).alias("conservation")).distinct()


def _screens(a: Assay, column: str, expr: str) -> DataFrame:
    return a.primers.select("sequence").distinct().withColumn(column, F.expr(expr))


_QUERIES: dict[str, Callable[[Assay], DataFrame]] = {
    "header_gene_filter": lambda a: records.gene_header(records.non_empty(a.records), "en").select("gene", "seq_idx", "id"),
    "own_gene_filter": lambda a: records.gene_header(records.non_empty(a.records)).select("gene", "seq_idx"),
    "ambiguous_fraction": lambda a: a.records.select("seq_idx", ambiguous_fraction("seq").alias("fraction")),
    "partial_records": lambda a: a.records.filter(records.is_partial()).select("gene", "seq_idx"),
    "robust_length_stats": lambda a: records.length_statistics(a.records),
    "auto_filter": lambda a: records.auto_filter(a.records).select("gene", "seq_idx"),
    "exact_dedupe": lambda a: records.exact_dedupe(a.records).select("gene", "seq_idx"),
    "column_profile": lambda a: a.profile,
    "consensus": lambda a: a.consensus,
    "generic_column_metrics": lambda a: profile.generic_column_metrics(a.msa),
    "aligned_consensus": lambda a: profile.aligned_consensus(a.msa),
    "sanitized_profile": lambda a: profile.column_profile(profile.sanitize(a.msa), a.params),
    "conservation_score": lambda a: a.scores,
    "window_mean": lambda a: regions.window_mean(a.scores, a.params),
    "conserved_regions": lambda a: a.regions,
    "region_violations": lambda a: regions.violations(a.regions.withColumn("start_col", F.col("start_col") - F.col("region_index") * 40), profile.aligned_consensus(a.msa)),
    "window_candidates": lambda a: a.windows,
    "single_primers": lambda a: a.primers,
    "reverse_complement": lambda a: a.msa.select("gene", "seq_idx", reverse_complement("aligned").alias("rc")),
    "sequence_metrics": lambda a: thermo.sequence_metrics(a.primers).drop("ord"),
    "nn_tm": lambda a: _screens(a, "tm", T.oligo_tm("sequence")),
    "homodimer_screen": lambda a: _screens(a, "homodimer_tm", T.duplex_tm("sequence", "sequence")),
    "self_dimer_3p": lambda a: _screens(a, "self_dimer_3p_tm", T.end_duplex_tm("sequence")),
    "hairpin_screen": lambda a: _screens(a, "hairpin_tm", T.hairpin_tm("sequence")),
    "primer_filters": lambda a: a.metrics.select("gene", "sequence", "orientation", "msa_start", "msa_end", "tm", "passed_basic_filters"),
    "single_coverage": lambda a: a.single("penalize").select(_SINGLE),
    "single_coverage_ignore": lambda a: a.single("ignore").select(_SINGLE),
    "single_coverage_hardfail": lambda a: a.single("hard_fail").select(_SINGLE),
    "primer_pairs": lambda a: a.pairs,
    "heterodimer_screen": lambda a: pairs.heterodimer_screen(pairs.candidate_pairs(a.filtered, a.params)),
    "pair_coverage": lambda a: a.coverage.select("gene", "forward_seq", "reverse_seq", "forward_start", "reverse_end", "f_ord", "r_ord", "fully_matched_sequences_count", "failed_forward_count", "failed_reverse_count", "failed_due_to_3prime_count", "total_sequences_count", "pair_coverage_fraction"),
    "seed_hits": lambda a: a.found.select(_HIT),
    "hit_evalues": lambda a: a.significant(a.subjects).select("query_id", "subject_id", "sstrand", "qstart", "sstart", "bitscore", "evalue"),
    "max_subjects": lambda a: a.near_hits.groupBy("query_id").agg(F.count("*").alias("hits"), F.countDistinct("subject_id").alias("subjects"), F.max("subject_id").alias("last_subject")),
    "tail_mismatch": lambda a: a.hits.select("query_id", "subject_id", "sstrand", "qstart", "sstart", "tail_mismatches", "tail_covered", "has_good_3prime_match", "is_off_target"),
    "target_subjects": lambda a: specificity.classify(a.found, a.params, ["subj7"], ["j1"]).groupBy("query_id").agg(F.count_if("is_off_target").alias("off_target"), F.count("*").alias("hits")),
    "single_specificity": lambda a: specificity.single_specificity(a.filtered.select("gene", "sequence", "orientation", "msa_start", "msa_end"), a.hits),
    "pair_specificity": lambda a: a.pair_risk,
    "pair_scores": lambda a: a.scored.select("gene", "forward_seq", "reverse_seq", "f_ord", "r_ord", "single_primer_3prime_conservation", "tm_balance_score", "gc_score", "hairpin_penalty", "homodimer_penalty", "heterodimer_penalty", "offtarget_penalty", "amplicon_size_penalty", "final_score"),
    "top_pairs": lambda a: a.top,
    "top_pairs_pruned": lambda a: pruning.pruned_top_pairs(a.filtered, a.primer_masks, a.msa, a.single(), a.params),
    "offtarget_summary": lambda a: scoring.top_pairs(scoring.score_pairs(a.coverage, a.filtered, a.pair_risk), a.single(), a.filtered, a.pair_risk, a.params).select("gene", "rank", "forward_sequence", "reverse_sequence", "offtarget_summary", "final_score"),
    "report_lines": lambda a: report.report_lines(a.top),
    "gene_reports": lambda a: report.report(a.msa, a.top).select("gene", F.size(F.split("text", "\n")).alias("lines")),
    "stage_funnel": lambda a: status.funnel(a.msa.select("gene").distinct().unionByName(a.spark.createDataFrame([("none",)], "gene string")), [("rows", a.msa), ("regions", a.regions), ("windows", a.windows), ("primers", a.primers), ("filtered", a.filtered), ("pairs", a.pairs)]),
    "gene_partitions": lambda a: a.records.select("gene", F.concat("gene", F.lit(" / "), "id").alias("name")).select("gene", status.partition_name("name").alias("folder")).distinct(),
    "fasta_roundtrip": _fasta_roundtrip,
    "alignment_roundtrip": _alignment_roundtrip,
    "regions_json_array_roundtrip": _regions_array,
    "report_files": _report_sink,
    "report_sink_roundtrip": lambda a: _report_sink(a).select("gene", F.explode(F.split("text", "\n")).alias("line")).filter("line != '' AND line NOT LIKE 'Top primer pairs:%' AND line NOT LIKE 'No primer pairs%'").groupBy("gene", F.md5("line").alias("line_md5")).agg(F.count("*").alias("n")),
    "table_files": _table_sinks,
    "pair_scores_weighted": lambda a: scoring.score_pairs(a.coverage, a.filtered, scoring=fixtures.WEIGHTED).select("gene", "forward_seq", "reverse_seq", "f_ord", "r_ord", "tm_balance_score", "gc_score", "hairpin_penalty", "amplicon_size_penalty", "final_score"),
    "gene_reasons": lambda a: status.with_reasons(status.funnel(a.msa.select("gene").distinct(), [("rows", a.msa), ("regions", regions.conserved_regions(a.scores, a.params.with_(min_region_len=22)))]), a.scores, a.params.with_(min_region_len=22)),
    "report_text": lambda a: report.report(a.msa, a.top),
    "min_region_len": lambda a: regions.conserved_regions(a.scores, a.params.with_(min_region_len=16)),
    "structure_override": lambda a: thermo.primer_metrics(a.primers, a.params, _solved(a)).select("gene", "sequence", "orientation", "msa_start", "msa_end", "hairpin_tm", "homodimer_tm", "self_dimer_3p_tm", "passed_basic_filters"),
    "primer_violations": lambda a: coverage.violations(a.primers.withColumn("msa_end", F.col("msa_end") + F.pmod("msa_start", F.lit(3))), a.msa).select("gene", "sequence", "orientation", "msa_start", "msa_end"),
    "gene_list": lambda a: status.genes_of(a.records.select(F.concat("gene", F.lit(" , "), "id").alias("genes"))),
    "orientation_split": _orientations,
    "pair_order": lambda a: pairs.ranked(_round(a.pairs, 9), pairs.PAIR_ORDER, ["gene"]).select("gene", "position", "f_ord", "r_ord"),
    "pair_violations": lambda a: coverage.pair_violations(a.pairs.withColumns({"forward_start": F.col("forward_start") - F.pmod("f_ord", F.lit(7)).cast("int") * 20, "reverse_end": F.col("reverse_end") + F.pmod("r_ord", F.lit(3)).cast("int") * 30}), a.msa).select("gene", "f_ord", "r_ord", "reason"),
    "single_risk_order": lambda a: pairs.ranked(stored(specificity.single_specificity(a.filtered.select("gene", "sequence", "orientation", "msa_start", "msa_end", "ord"), a.hits), "single_risk"), specificity.SINGLE_ORDER, ["gene"]).select("gene", "ord", "position", "off_target_risk_score"),
    "pair_risk_order": lambda a: pairs.ranked(a.pair_risk, specificity.PAIR_RISK_ORDER).select("forward_seq", "reverse_seq", "position"),
    "pair_scores_supplied": lambda a: scoring.score_pairs(a.coverage, a.filtered, conservation_3p=_supplied(a)).select("gene", "forward_seq", "reverse_seq", "f_ord", "r_ord", "single_primer_3prime_conservation", "final_score"),
    "regions_json_roundtrip": _regions_roundtrip,
    "pairs_csv_tsv_json_roundtrip": _pairs_roundtrip,
    "hit_table_scan": _hit_scan,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, q=q: _round(q(Assay(spark, sf_dir)))) for name, q in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return oracle.build()
