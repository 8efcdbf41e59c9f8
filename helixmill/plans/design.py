"""The run of an assay design: from alignment rows to ranked pairs, reports and the state of each gene."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import candidates, coverage, pairs, profile, regions, report, scoring, specificity, status, thermo
from ..params import STRICT, Params, Scoring
from ..sources import fasta, tables
from ..storage import stored


@dataclass(frozen=True)
class Given:
    """What a user may give in place of what would be measured: regions(gene, region_index, start_col, end_col,
    mean_score); structure_tm and heterodimer_tm, solved temperatures; subjects(subject_id, seq) to search, with the
    subjects that are targets by id or by a part of their id."""

    regions: DataFrame | None = None
    structure_tm: DataFrame | None = None
    heterodimer_tm: DataFrame | None = None
    subjects: DataFrame | None = None
    target_ids: tuple[str, ...] = ()
    target_substrings: tuple[str, ...] = ()


class Design:
    """The tables of one run, made from the alignment as they are asked for. What several others read is stored:
    asking for it writes it."""

    def __init__(self, spark: SparkSession, rows: DataFrame, params: Params = STRICT, weights: Scoring = Scoring(), given: Given = Given()):
        self.spark, self.rows, self.params, self.weights, self.given = spark, rows, params, weights, given

    @cached_property
    def msa(self) -> DataFrame:
        return stored(coverage.number_rows(self.rows), "msa")

    @cached_property
    def counts(self) -> DataFrame:
        return stored(profile.column_counts(self.msa), "counts")

    @cached_property
    def profile(self) -> DataFrame:
        return profile.from_counts(self.counts, self.params)

    @cached_property
    def consensus(self) -> DataFrame:
        return profile.consensus(self.profile)

    @cached_property
    def scores(self) -> DataFrame:
        return profile.conservation(profile.from_counts(profile.sanitized_counts(self.counts), self.params), self.params)

    @cached_property
    def regions(self) -> DataFrame:
        own = self.given.regions
        return stored(regions.conserved_regions(self.scores, self.params) if own is None else own, "regions")

    @cached_property
    def windows(self) -> DataFrame:
        return candidates.window_candidates(self.profile, self.regions, self.params)

    @cached_property
    def primers(self) -> DataFrame:
        return stored(candidates.single_primers(self.windows), "primers")

    @cached_property
    def metrics(self) -> DataFrame:
        return stored(thermo.primer_metrics(self.primers, self.params, self.given.structure_tm), "metrics")

    @cached_property
    def filtered(self) -> DataFrame:
        return self.metrics.filter("passed_basic_filters")

    @cached_property
    def pairs(self) -> DataFrame:
        return stored(pairs.primer_pairs(self.filtered, self.params, self.given.heterodimer_tm), "pairs")

    @cached_property
    def primer_masks(self) -> DataFrame:
        return stored(coverage.primer_masks(self.filtered, self.msa, self.params, self.masks), "masks")

    @cached_property
    def coverage(self) -> DataFrame:
        return stored(coverage.pair_coverage(self.pairs, self.primer_masks, self.msa, self.params), "coverage")

    @cached_property
    def masks(self) -> DataFrame:
        return stored(coverage.window_masks(self.filtered, self.msa), "windows")

    def single(self, mode: str | None = None) -> DataFrame:
        p = self.params.with_(gap_mode=mode) if mode else self.params
        return stored(self.filtered.select(*coverage.KEY, "ord").join(coverage.single_coverage(self.filtered, self.msa, p, self.masks), coverage.KEY), "single")

    @cached_property
    def subjects(self) -> DataFrame:
        """What is searched for off-target hits: what was given, or the rows of the alignment without gaps."""
        return self.given.subjects if self.given.subjects is not None else self.msa.select(F.col("id").alias("subject_id"), F.replace("aligned", F.lit("-"), F.lit("")).alias("seq"))

    @cached_property
    def found(self) -> DataFrame:
        return specificity.seed_hits(self.filtered.select("sequence"), self.subjects, self.params, letters=self.letters)

    @cached_property
    def letters(self) -> int:
        return specificity.searched_letters(self.subjects)

    def significant(self, subjects: DataFrame) -> DataFrame:
        """Hits up to the limit of the e-value, by the letters of all subjects, in all or some of them."""
        return specificity.seed_hits(self.filtered.select("sequence"), subjects, self.params, significant=True, letters=self.letters)

    @property
    def near_hits(self) -> DataFrame:
        """Hits in the best subjects of each query: all are searched for these, then they alone for the rows."""
        best = specificity.best_subjects(self.significant(self.subjects), self.params)
        some = self.subjects.join(best.select("subject_id").distinct(), "subject_id", "left_semi")
        return specificity.in_subjects(self.significant(some), best)

    @cached_property
    def hits(self) -> DataFrame:
        return stored(specificity.classify(self.near_hits, self.params, self.given.target_ids, self.given.target_substrings), "hits")

    @cached_property
    def pair_risk(self) -> DataFrame:
        return stored(specificity.pair_specificity(self.pairs, self.hits, self.params), "pair_risk")

    @cached_property
    def scored(self) -> DataFrame:
        return stored(scoring.score_pairs(self.coverage, self.filtered, scoring=self.weights), "scored")

    @cached_property
    def top(self) -> DataFrame:
        return stored(scoring.top_pairs(self.scored, self.single(), self.filtered, params=self.params), "top")

    @cached_property
    def ranked(self) -> DataFrame:
        """The best pairs, with off-target risks where subjects to search were given."""
        if self.given.subjects is None:
            return self.top
        scores = scoring.score_pairs(self.coverage, self.filtered, self.pair_risk, scoring=self.weights)
        return stored(scoring.top_pairs(stored(scores, "scored"), self.single(), self.filtered, self.pair_risk, self.params), "ranked")

    @cached_property
    def state(self) -> DataFrame:
        """gene, a count for each stage, status and, for a gene without pairs, the reason."""
        stages = [("rows", self.msa), ("regions", self.regions), ("windows", self.windows), ("primers", self.primers), ("filtered", self.filtered), ("pairs", self.pairs), ("covered", self.coverage), ("top", self.ranked)]
        return stored(status.with_reasons(status.funnel(self.msa.select("gene").distinct(), stages), self.scores, self.params), "state")


def alignment(spark: SparkSession, path: str) -> DataFrame:
    """gene, seq_idx, id and aligned of every FASTA file under `path`; a gene is a file, named by it."""
    rows = fasta.read_alignment(spark, path)
    return rows.withColumn("gene", F.regexp_extract("file", r"([^/]+?)(\.[^./]*)?$", 1)).select("gene", "seq_idx", "id", "aligned")


def design(spark: SparkSession, path: str, out: str, params: Params = STRICT, weights: Scoring = Scoring(), regions_path: str | None = None, subjects_path: str | None = None, target_ids: tuple[str, ...] = (), target_substrings: tuple[str, ...] = ()) -> DataFrame:
    """All genes of the alignments under `path`, one run: writes `out`/csv, tsv, json and report with a file for each
    gene, and `out`/status, replacing what is there; returns the state of each gene.

    regions_path: conserved regions to use in place of measured ones; subjects_path: FASTA files to search for
    off-target hits. A gene with an empty stage is skipped, its files say so; if all are, the run fails with reasons.
    """
    rows = stored(alignment(spark, path), "alignment")
    fasta.check_alignment(rows)
    given = Given(
        regions=tables.read_regions_json(spark, regions_path) if regions_path else None,
        subjects=stored(fasta.read_fasta(spark, subjects_path).select(F.col("id").alias("subject_id"), "seq"), "subjects") if subjects_path else None,
        target_ids=target_ids, target_substrings=target_substrings,
    )
    run = Design(spark, rows, params, weights, given)
    genes = stored(rows.select("gene").distinct(), "genes")
    for kind, sep in (("csv", ","), ("tsv", "\t")):
        tables.write_delimited(genes, run.ranked, f"{out}/{kind}", sep)
    tables.write_json_arrays(genes, run.ranked, f"{out}/json")
    tables.write_report(report.report(genes, run.ranked), f"{out}/report")
    run.state.write.mode("overwrite").parquet(f"{out}/status")
    status.require_any(run.state)
    return run.state
