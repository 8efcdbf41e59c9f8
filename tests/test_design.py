"""A whole run over user paths: files of each gene, reasons, weights, e-values."""

import csv
import glob
import io
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from helixmill.operators import report, scoring, specificity, status
from helixmill.params import STRICT, Scoring
from helixmill.plans import design
from helixmill.sources import tables

WIDE = STRICT.with_(min_gc=20.0, max_gc=80.0, min_tm=40.0, max_tm=75.0, max_run=6, min_clamp=0, max_tm_diff=6.0, gap_mode="penalize", max_mismatches=3, top_n=3, min_len=18, max_len=18, min_amplicon=90)


def whole(path, kind, gene):
    (file,) = glob.glob(f"{path}/{kind}/gene={gene}/part-*")
    with open(file) as f:
        return f.read()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(3)
    out = tmp_path_factory.mktemp("design")
    (out / "in").mkdir()
    base = "".join(rng.choice("ACGT") for _ in range(130))
    rows = ["".join(c if rng.random() < 0.995 else rng.choice("ACGT") for c in base) for _ in range(6)]
    (out / "in" / "long.fasta").write_text("".join(f">s{i} x\n{r}\n" for i, r in enumerate(rows)))
    (out / "in" / "tiny.fasta").write_text(">t1\nACGTAC\n>t2\nACGTAC\n")
    return out, rows


def test_run(spark, folder):
    path, rows = folder
    out = f"{path}/out"
    for kind in ("csv", "report"):  # what an earlier run has written is replaced
        (path / "out" / kind / "gene=old").mkdir(parents=True)
        (path / "out" / kind / "gene=old" / "part-0.txt").write_text("old\n")
    state = {r.gene: r for r in design.design(spark, f"{path}/in", out, WIDE).collect()}
    assert not glob.glob(f"{out}/*/gene=old")
    assert (state["long"].status, state["long"].reason, state["long"].rows, state["long"].top) == ("ok", None, 6, 3)
    assert (state["tiny"].status, state["tiny"].reason) == ("regions", "alignment of 6 columns, shorter than the window of 15")
    table = list(csv.DictReader(io.StringIO(whole(out, "csv", "long"))))
    assert len(table) == 3 and [float(r["final_score"]) for r in table] == sorted((float(r["final_score"]) for r in table), reverse=True)
    assert list(csv.DictReader(io.StringIO(whole(out, "tsv", "long")), delimiter="\t")) == table
    assert [r["forward_sequence"] for r in json.loads(whole(out, "json", "long"))] == [r["forward_sequence"] for r in table]
    text = whole(out, "report", "long")
    assert text.startswith("Top primer pairs: 3\n\n1. score=") and text.count("\n\n") == 3 and text.endswith("offtarget:not_checked\n")
    assert (whole(out, "csv", "tiny"), whole(out, "json", "tiny"), whole(out, "report", "tiny")) == ("\n", "[]\n", "No primer pairs passed final ranking.\n")
    assert {r.gene for r in spark.read.parquet(f"{out}/status").collect()} == {"long", "tiny"}


def test_run_where_every_gene_is_skipped(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "tiny.fasta").write_text(">t1\nACGTAC\n>t2\nACGTAC\n")
    with pytest.raises(ValueError, match="tiny: alignment of 6 columns, shorter than the window of 15"):
        design.design(spark, f"{tmp_path}/in", f"{tmp_path}/out", WIDE)
    (tmp_path / "in" / "odd.fasta").write_text(">t1\nACGTAC\n>t2\nACGT\n")
    with pytest.raises(ValueError, match="unequal"):
        design.design(spark, f"{tmp_path}/in", f"{tmp_path}/out", WIDE)


def test_run_with_subjects_and_regions(spark, folder):
    path, rows = folder
    (path / "regions.json").write_text('[{"gene": "long", "region_index": 0, "start_col": 0, "end_col": 30, "mean_score": 1.0}, {"gene": "long", "region_index": 1, "start_col": 100, "end_col": 130, "mean_score": 1.0}]')
    (path / "other.fasta").write_text(f">own\n{rows[0]}\n>strange\n{rows[0][:110]}\n")
    got = design.design(spark, f"{path}/in", f"{path}/out2", WIDE.with_(top_n=2), regions_path=f"{path}/regions.json", subjects_path=f"{path}/other.fasta", target_ids=("own",)).collect()
    assert {r.gene: (r.regions, r.status) for r in got} == {"long": (2, "ok"), "tiny": (0, "regions")}
    lines = [x for x in whole(f"{path}/out2", "report", "long").split("\n") if "offtarget" in x]
    assert len(lines) == 2 and all("offtarget_risk=" in x for x in lines)


def test_reasons(spark):
    scores = spark.createDataFrame([("a", c) for c in range(40)] + [("b", c) for c in range(9)], "gene string, col int")
    f = spark.createDataFrame([("a", 2, 0, "regions"), ("b", 2, 0, "regions"), ("c", 0, 0, "rows"), ("d", 1, 1, "ok")], "gene string, rows long, regions long, status string")
    got = {r.gene: r.reason for r in status.with_reasons(f, scores, STRICT.with_(min_region_len=30)).collect()}
    assert got == {"a": "no conserved region of at least 30 columns", "b": "alignment of 9 columns, shorter than the window of 15", "c": "no alignment rows", "d": None}
    assert status.with_reasons(f, scores, STRICT).filter("gene = 'a'").first().reason == "no conserved region left"


def test_scoring_parameters(spark):
    for bad in ({"coverage": 1.5}, {"tm_diff_bad": 0.0}, {"hairpin_good": 60.0}, {"preferred_min": 200}, {"allowed_max": 100}, {"gc": float("nan")}):
        with pytest.raises(ValueError):
            Scoring(**bad)
    c = spark.createDataFrame([("g", "AA", "CC", 150, 2.0, 45.0, 50.0, 60.0, 10, 1, 0.5)], "gene string, forward_seq string, reverse_seq string, amplicon_length int, tm_diff double, heterodimer_tm double, gc_forward double, gc_reverse double, total_sequences_count long, failed_due_to_3prime_count long, pair_coverage_fraction double")
    w = Scoring(coverage=0.5, prime3=0.2, specificity=0.1, thermo=0.1, amplicon=0.1, tm_balance=1.0, gc=0.0, hairpin=0.0, homodimer=0.0, heterodimer=0.0, tm_diff_bad=8.0, allowed_max=170)
    got = scoring.score_pairs(c, scoring=w).first()
    assert (got.tm_balance_score, got.amplicon_size_penalty, got.final_score) == (0.75, 0.6, round(100 * (0.25 + 0.18 + 0.1 + 0.075 + 0.04), 9))


def test_evalues(spark):
    q = spark.createDataFrame([("ACGTTGCAAGCTTGACCATG",)], "sequence string")
    s = spark.createDataFrame([("s1", "TT" + "ACGTTGCAAGCTTGACCATG" + "TT"), ("s2", "G" * 500 + "ACGTTGCA" + "T" * 500)], "subject_id string, seq string")
    hits = {(r.subject_id, r.align_len): r for r in specificity.seed_hits(q, s).collect()}
    best = hits["s1", 20]
    bits = (1.374 * 20 - math.log(0.711)) / math.log(2)
    assert abs(best.bitscore - bits) < 1e-9 and abs(best.evalue - 20 * 1032 * 2**-bits) < 1e-9
    kept = specificity.evalue_filter(specificity.seed_hits(q, s), STRICT.with_(max_evalue=0.01)).collect()
    assert {(r.subject_id, r.align_len) for r in kept} == {k for k, r in hits.items() if 20 * 1032 * 0.711 * math.exp(-1.374 * (r.align_len - 4 * r.mismatch)) <= 0.01} != set(hits)


def test_quoted_cells(spark):
    top = spark.createDataFrame([("g", 2, "x", 1.5), ("g", 1, 'a,"b"', float("nan"))], "gene string, rank int, name string, score double")
    genes = spark.createDataFrame([("g",), ("h",)], "gene string")
    text = {r.gene: r.text for r in tables.delimited(genes, top).collect()}
    assert list(csv.reader(io.StringIO(text["g"]))) == [["name", "score"], ['a,"b"', "NaN"], ["x", "1.5"]] and text["h"] == ""
    assert report.EMPTY + "\n" == report.report(genes, spark.createDataFrame([], "gene string, rank int, final_score double, pair_coverage double, amplicon_length int, forward_sequence string, forward_msa_start int, forward_msa_end int, reverse_sequence string, reverse_msa_start int, reverse_msa_end int, tm_forward double, tm_reverse double, gc_forward double, gc_reverse double, forward_coverage double, reverse_coverage double, forward_3prime_mismatch_count long, reverse_3prime_mismatch_count long, forward_hairpin_tm double, reverse_hairpin_tm double, forward_homodimer_tm double, reverse_homodimer_tm double, heterodimer_tm double, offtarget_summary string")).filter(F.col("gene") == "h").first().text
