"""Assay operators on hand-written rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixmill.functions import thermo as T
from helixmill.functions.sequences import ambiguous_fraction, clip01, gc_clamp, gc_percent, linear_penalty, longest_run, reverse_complement
from helixmill.operators import candidates, coverage, joins, pairs, profile, records, regions, report, scoring, specificity, status, thermo
from helixmill.params import RELAXED, STRICT, Params
from helixmill.plans import fixtures


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def msa(spark, seqs, gene="g"):
    return spark.createDataFrame([(gene, i, s) for i, s in enumerate(seqs)], "gene string, seq_idx long, aligned string")


def test_params():
    assert RELAXED.gap_mode == "penalize" and STRICT.gap_mode == "hard_fail"
    bad_values = ({"gap_mode": "x"}, {"top_n": 0}, {"min_len": 9, "max_len": 8}, {"window_size": 0}, {"min_gc": 70.0, "max_gc": 60.0}, {"top_quantile": 1.5}, {"max_mismatches": -1}, {"max_tm": float("nan")}, {"unsuitable_char": "NN"}, {"min_region_len": 0}, {"word_size": 7.5}, {"gap_penalty": -1.0})
    for bad in bad_values:
        with pytest.raises(ValueError):
            Params(**bad)


def test_sequence_functions(spark):
    df = spark.createDataFrame([("ACGTNacgtn-", "AAACCG", ""), ("GATTACA", "GGGG", "acgtNN")], "a string, b string, c string")
    assert [r[0] for r in df.select(reverse_complement("a")).collect()] == ["-nacgtNACGT", "TGTAATC"]
    assert [tuple(r) for r in df.select(gc_percent("b"), longest_run("b"), gc_clamp("b"), ambiguous_fraction("c")).collect()] == [(50.0, 3, 2, 1.0), (100.0, 4, 2, 2 / 6)]
    x = spark.createDataFrame([(-1.0,), (0.5,), (2.0,), (float("nan"),)], "x double")
    got = [tuple(r) for r in x.select(clip01(F.col("x")), linear_penalty(F.col("x") * 20 + 35, 35, 55)).collect()]
    assert got[:3] == [(0.0, 0.0), (0.5, 0.5), (1.0, 1.0)] and math.isnan(got[3][0])


def test_melting_temperature(spark):
    df = spark.createDataFrame([("GTAAAACGACGGCCAGT",)], "s string")
    assert round(df.select(F.expr(T.oligo_tm("s"))).first()[0], 4) == 54.6955
    runs = spark.createDataFrame([("AAAAAAAAAA",), ("GGGGCCCC",)], "s string").select(F.expr(T.duplex_tm("s", "s")), F.expr(T.end_duplex_tm("s")), F.expr(T.hairpin_tm("s"))).collect()
    assert tuple(runs[0]) == (0.0, 0.0, 0.0) and runs[1][0] == runs[1][1] != 0 and runs[1][2] == 0.0


def test_record_filters(spark):
    r = spark.createDataFrame(
        [("g", 1, "a", "x [gene=G]", "ACGTACGT"), ("g", 2, "b", "y [gene = g]", "ACGTACGT"), ("g", 3, "c", "z [gene=gg]", "ACGTNNNN"), ("g", 4, "d", "partial=True", "ACGTACGA"), ("g", 5, "e", "", "")],
        "gene string, seq_idx long, id string, description string, seq string",
    )
    assert rows(records.non_empty(r), "seq_idx") == [(1,), (2,), (3,), (4,)]
    assert rows(records.gene_header(r, "g"), "seq_idx") == rows(records.gene_header(r), "seq_idx") == [(1,), (2,)]
    assert records.gene_header(r, "").count() == 0
    assert rows(records.exact_dedupe(r), "seq_idx") == [(1,), (3,), (4,), (5,)]
    assert rows(records.auto_filter(records.non_empty(r)), "seq_idx") == [(1,)]
    assert records.auto_filter(r.limit(0)).count() == 0


def test_exact_percentile(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    values = {"a": rng.integers(0, 9, 41).tolist(), "b": [5], "c": rng.normal(size=30).tolist()}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs] + [("a", None)], "gene string, v double")
    for share in (0.0, 0.5, 0.9, 1.0):
        got = dict(rows(records.exact_percentile(df, "gene", "v", share, "p"), "gene", "p"))
        assert all(abs(got[g] - np.quantile(vs, share)) < 1e-12 for g, vs in values.items())


def test_profile_ties_gaps_and_symbols(spark):
    p = profile.column_profile(msa(spark, ["AN-.a", "CN-.t", "AA-RG", "CA-AC"])).orderBy("col").collect()
    assert [x.consensus_base for x in p] == ["A", "A", "N", "A", "A"]
    assert p[2].gap_fraction == 1.0 and not p[2].suitable and p[2].identity == 0.0 and p[3].non_gap_count == 1
    assert p[0].entropy == 1.0 and p[4].entropy == 2.0
    m = msa(spark, ["N-", "A-", "N-", "A."])
    assert rows(profile.aligned_consensus(m), "consensus_aligned") == [("N.",)]
    g = profile.generic_column_metrics(m).orderBy("col").collect()
    assert (g[0].consensus_base, g[0].identity, g[1].consensus_base, g[1].identity) == ("N", 0.5, None, 0.0)
    s = profile.conservation(profile.column_profile(profile.sanitize(msa(spark, ["a.", "A-"])))).orderBy("col").collect()
    assert (s[0].score, s[1].score, s[1].all_gap) == (1.0, 1.0, True)


def test_uniform_alignment_has_a_region(spark):
    s = profile.conservation(profile.column_profile(msa(spark, ["ACGTACGTACGTACGT"] * 3)))
    p = Params(window_size=4, top_quantile=0.9, min_region_len=4)
    assert rows(regions.conserved_regions(s, p), "start_col", "end_col", "mean_score") == [(0, 16, 1.0)]
    assert regions.conserved_regions(s, Params(window_size=17)).count() == 0


def test_region_violations(spark):
    r = spark.createDataFrame([("g", 0, -1, 2), ("g", 1, 2, 2), ("g", 2, 0, 9), ("g", 3, 2, 4), ("g", 4, 0, 2)], "gene string, region_index int, start_col int, end_col int")
    c = spark.createDataFrame([("g", "AC--")], "gene string, consensus_aligned string")
    assert rows(regions.violations(r, c), "region_index", "reason") == [(0, "negative start"), (1, "empty"), (2, "beyond the alignment"), (3, "all gaps")]


def test_candidates(spark):
    m = msa(spark, ["ACGTTGCAAC"] * 3)
    prof = profile.column_profile(m)
    reg = spark.createDataFrame([("g", 0, 0, 6), ("g", 1, 3, 9)], "gene string, region_index int, start_col int, end_col int")
    p = Params(min_len=5, max_len=6)
    w = candidates.window_candidates(prof, reg, p)
    assert w.count() == 12 and rows(w.filter("region_index = 0 AND length = 6"), "orientation", "primer_seq", "mean_conservativity") == [("forward", "ACGTTG", 1.0), ("reverse", "CAACGT", 1.0)]
    got = candidates.single_primers(w).orderBy("ord").collect()
    assert [x.sequence for x in got[:3]] == ["ACGTT", "AACGT", "CGTTG"] and len(got) == 12
    odd = msa(spark, ["ACGTNGCAAC", "ACGTNGCAAC"])
    assert candidates.window_candidates(profile.column_profile(odd), reg, p).filter("window_start < 5 AND window_end > 4").count() == 0


def test_nan_structure_passes_but_nan_tm_fails(spark):
    p = spark.createDataFrame([("g", "GTAAAACGACGGCCAGTACG", "forward", 0, 20, 1), ("g", "GTAANACGACGGCCAGTACG", "forward", 0, 20, 2), ("g", "", "forward", 0, 0, 3)], "gene string, sequence string, orientation string, msa_start int, msa_end int, ord long")
    t = spark.createDataFrame([("GTAAAACGACGGCCAGTACG", float("nan"), 99.0, None)], "sequence string, hairpin_tm double, homodimer_tm double, self_dimer_3p_tm double")
    wide = Params(min_tm=0, max_tm=100, max_homodimer_tm=99.0, max_self_dimer_3p_tm=99.0)
    got = thermo.primer_metrics(p, wide, t).collect()
    assert len(got) == 1 and got[0].passed_basic_filters and got[0].self_dimer_3p_tm == 99.0
    assert not thermo.primer_metrics(p, wide.with_(max_homodimer_tm=98.0), t).first().passed_basic_filters


@pytest.mark.parametrize(("mode", "matched", "total", "weighted"), [("hard_fail", 2, 3, 9.0), ("penalize", 4, 3, 9.0), ("ignore", 4, 1, 1.0)])
def test_gap_modes(spark, mode, matched, total, weighted):
    m = msa(spark, ["ACGTACGT", "-CGTACGT", "AC-TACGT", "CCGTACGT"])
    p = spark.createDataFrame([("g", "ACGTACGT", "forward", 0, 8, 1)], "gene string, sequence string, orientation string, msa_start int, msa_end int, ord long")
    got = coverage.single_coverage(p, m, Params(gap_mode=mode, max_mismatches=1, max_weighted_score=4.0)).first()
    assert (got.matched_sequences_count, got.n_rows, got.gap_overlap_count) == (matched, 4, 2)
    assert (got.total_mismatch_count, got.weighted_mismatch_score_sum) == (total, weighted)


def test_reverse_primer_reads_the_complement(spark):
    m = msa(spark, ["AACCGGTTAC", "AACCGGTTAN"])
    p = spark.createDataFrame([("g", "GTAACCGG", "reverse", 2, 10, 1)], "gene string, sequence string, orientation string, msa_start int, msa_end int, ord long")
    got = coverage.single_coverage(p, m).first()
    assert (got.matched_sequences_count, got.prime3_mismatch_count, got.total_mismatch_count) == (2, 0, 1)
    assert coverage.violations(p, m).count() == 0 and coverage.violations(p.withColumn("msa_end", F.lit(11)), m).count() == 1


def _primers(spark, items):
    return spark.createDataFrame([("g", *x) for x in items], "gene string, sequence string, orientation string, msa_start int, msa_end int, tm double, gc_percent double, ord long")


def test_pairs_and_their_coverage(spark):
    left, right = "ACGTACGTACGTACGTAC", "TTGACCATTGACCATTGA"
    gap = "A" * 32
    m = msa(spark, [left + gap + right] * 3 + [left + "-" * 32 + right, left[:-1] + "T" + gap + right])
    p = _primers(spark, [(left, "forward", 0, 18, 60.0, 50.0, 1), ("TCAATGGTCAATGGTCAA", "reverse", 50, 68, 60.5, 52.0, 2)])
    got = pairs.primer_pairs(p, STRICT.with_(max_heterodimer_tm=100.0))
    one = got.first()
    assert got.count() == 1 and one.amplicon_length == 68 and one.is_preferred_amplicon_range and one.gc_balance_mean == 51.0
    c = coverage.pair_coverage(got, coverage.primer_masks(p, m), m).first()
    assert (c.fully_matched_sequences_count, c.failed_forward_count, c.failed_reverse_count, c.failed_due_to_3prime_count, c.total_sequences_count) == (3, 1, 0, 1, 5)
    assert pairs.candidate_pairs(p, STRICT.with_(max_amplicon=60)).count() == 0 and pairs.candidate_pairs(p, STRICT.with_(max_tm_diff=0.1)).count() == 0


def test_amplicon_gaps_by_prefix_sums(spark):
    rows = ["A" * 18 + "-" * g + "C" * (32 - g) + "G" * 18 for g in (0, 8, 9, 17, 18, 32)] + ["A" * 60, "-" * 68]
    m = msa(spark, rows)
    pair = spark.createDataFrame([("g", 0, 68), ("g", 10, 60), ("g", 20, 44)], "gene string, forward_start int, reverse_end int")
    got = {(r.forward_start, i) for r in coverage.unfit_amplicons(pair, m).collect() for i in range(coverage.WORD) if r.unfit >> i & 1}
    want = {(a, i) for a, b in ((0, 68), (10, 60), (20, 44)) for i, s in enumerate(rows) if not s[a:b] or s[a:b].count("-") / len(s[a:b]) > STRICT.max_amplicon_gap_fraction}
    assert got == want


def test_rows_that_share_an_index(spark):
    """Numbered rows are told apart whatever their seq_idx, also beyond one mask word."""
    m = coverage.number_rows(spark.createDataFrame([("g", 1, "ACGTACGT")] * 130 + [("g", None, "TTTTTTTT")] * 3, "gene string, seq_idx long, aligned string").repartition(3))
    p = spark.createDataFrame([("g", "ACGTACGT", "forward", 0, 8, 1)], "gene string, sequence string, orientation string, msa_start int, msa_end int, ord long")
    got = coverage.single_coverage(p, m).first()
    assert (got.matched_sequences_count, got.n_rows) == (130, 133)
    ok = coverage.primer_masks(p, m).agg(F.sum(F.bit_count("ok"))).first()[0]
    assert ok == 130


def test_pair_coordinates(spark):
    m = msa(spark, ["A" * 80])
    rows = [(0, 4, 40, 44), (-1, 3, 40, 44), (4, 4, 40, 44), (0, 4, 77, 81), (0, 5, 40, 44), (0, 4, 40, 43)]
    pair = spark.createDataFrame([("g", "ACGT", "ACGT", *r, 1.0) for r in rows], "gene string, forward_seq string, reverse_seq string, forward_start int, forward_end int, reverse_start int, reverse_end int, tm_diff double")
    assert sorted(r.reason for r in coverage.pair_violations(pair, m).collect()) == ["empty forward primer", "forward length differs", "negative forward start", "reverse length differs", "reverse primer beyond the alignment"]
    p = _primers(spark, [("ACGT", "forward", 0, 4, 60.0, 50.0, 1), ("ACGT", "reverse", 40, 44, 60.0, 50.0, 2)])
    masks = coverage.primer_masks(p, m)
    assert coverage.pair_coverage(pair.limit(1), masks, m).count() == 1
    with pytest.raises(Exception, match="pair_coverage: "):
        coverage.pair_coverage(pair, masks, m).collect()


def test_orientations(spark):
    p = _primers(spark, [("ACGT", "Forward", 0, 4, 60.0, 50.0, 1), ("ACGT", "REVERSE", 50, 54, 60.0, 50.0, 2)])
    assert [x.count() for x in pairs.split_orientation(p)] == [1, 1] and pairs.candidate_pairs(p).count() == 1
    assert pairs.candidate_pairs(p.filter("ord = 1")).count() == 0
    with pytest.raises(Exception, match="orientation up"):
        pairs.candidate_pairs(p.withColumn("orientation", F.lit("up"))).collect()


def test_orders(spark):
    pair = spark.createDataFrame([("g", False, 0.1, 1.0, 0.0, 1, 1), ("g", True, 0.5, 1.0, 0.0, 1, 2), ("g", True, 0.1, float("nan"), 0.0, 1, 3), ("g", True, 0.1, 1.0, 2.0, 1, 5), ("g", True, 0.1, 1.0, 2.0, 1, 4)], "gene string, is_preferred_amplicon_range boolean, tm_diff double, heterodimer_tm double, gc_balance_abs_diff double, f_ord long, r_ord long")
    assert [r.r_ord for r in pairs.sorted_pairs(pair).collect()] == [4, 5, 3, 2, 1]
    assert [r.r_ord for r in pairs.ranked(pair, pairs.PAIR_ORDER, ["gene"]).orderBy("position").collect()] == [4, 5, 3, 2, 1]
    single = spark.createDataFrame([("g", 1, 0, 5.0, 1), ("g", 0, 9, 9.0, 2), ("g", 0, 3, 3.0, 4), ("g", 0, 3, 3.0, 3)], "gene string, good_3prime_off_target_hits_count long, off_target_hits_count long, off_target_risk_score double, ord long")
    assert [r.ord for r in specificity.sorted_single(single).collect()] == [3, 4, 2, 1]
    risk = spark.createDataFrame([("b", "x", 1, 9, 17.0), ("b", "a", 0, 2, 2.0), ("a", "x", 0, 2, 2.0), ("c", "x", 0, 1, 1.0)], "forward_seq string, reverse_seq string, good_3prime_off_target_amplicons_count long, potential_off_target_amplicons_count long, off_target_pair_risk_score double")
    assert [(r.forward_seq, r.reverse_seq) for r in specificity.sorted_pair_risk(risk).collect()] == [("c", "x"), ("a", "x"), ("b", "a"), ("b", "x")]


def test_salted_join_is_the_join(spark):
    big = spark.range(400).withColumn("k", F.when(F.col("id") < 300, 1).otherwise(F.col("id") % 7))
    small = spark.createDataFrame([(k, k * 10 + i) for k in range(6) for i in range(3)], "k long, v long")
    want = rows(big.join(small, "k"), "id", "v")
    for most in (0, 100):
        assert rows(joins.spread_join(big, small, ["k"], most=most, salts=5), "id", "v") == want


def test_sanitised_counts(spark):
    m = msa(spark, ["AN-.acR", "CCCCNNA"])
    cols = ["col", "count_a", "count_c", "gap_count", "n_rows"]
    assert rows(profile.sanitized_counts(profile.column_counts(m)), *cols) == rows(profile.column_counts(profile.sanitize(m)), *cols)


def test_binned_join_is_the_plain_join(spark):
    items = [("ACGT", o, s, s + 4, 60.0, 50.0, s) for s in range(0, 700, 7) for o in ("forward", "reverse")]
    p = _primers(spark, items)
    want = sum(1 for f in items for r in items if f[1] == "forward" and r[1] == "reverse" and f[2] < r[2] and 40 <= r[3] - f[2] <= 220)
    assert pairs.candidate_pairs(p).count() == want


def test_hits_and_risk(spark):
    q = spark.createDataFrame([("g", "ACGTTGCAAGCTTGACCATG", "forward", 0, 20)], "gene string, sequence string, orientation string, msa_start int, msa_end int")
    s = spark.createDataFrame([("s1", "TT" + "ACGTTGCAAGCTTGACCATG" + "TT"), ("s2", "CATGGTCAAGCTTGCAACGT"), ("s3", "T" * 30)], "subject_id string, seq string")
    h = specificity.classify(specificity.seed_hits(q, s))
    assert rows(h, "subject_id", "sstrand", "qstart", "qend", "sstart", "send", "has_good_3prime_match")[:2] == [("s1", "plus", 1, 20, 3, 22, True), ("s2", "minus", 1, 20, 20, 1, True)]
    other = spark.createDataFrame([("g", "TTTTTTTTTTTTTTTTTTTTT" + "C", "forward", 0, 22)], q.schema)
    got = specificity.single_specificity(q.unionByName(other), h).orderBy("off_target_risk_score").collect()
    assert [x.significant_hits_count for x in got] == [0, h.count()] and got[1].off_target_risk_score == 6.0 * h.count()
    assert specificity.classify(specificity.seed_hits(q, s), substrings=["s1"], ids=["s2"]).filter("is_off_target").count() == 0


@pytest.mark.parametrize("at_once,most", [(200_000, 4_000_000), (50, 20)])
def test_scanned_hits_are_those_of_a_join(spark, monkeypatch, at_once, most):
    rng = random.Random(5)
    base = "".join(rng.choices("ACGT", k=80))
    q = spark.createDataFrame([(base[i : i + 20],) for i in (0, 13, 31, 60)] + [("ACGTTGCAACGT",), ("AAAAAAAAAAAA",), ("acgtNacgtacgt",), ("ACG",), (None,)], "sequence string")
    near = lambda: "".join(c if rng.random() < 0.9 else rng.choice("ACGTN") for c in base)
    seqs = [near() + base[::-1].translate(str.maketrans("ACGT", "TGCA")) for _ in range(12)] + ["A" * 40, "é" + base.lower() + "Ä" + base[5:30], "", "ACG", None]
    s = spark.createDataFrame([(f"s{i}", x) for i, x in enumerate(seqs)] + [(None, base)], "subject_id string, seq string")
    scan, params = specificity._scan, STRICT.with_(max_subjects=3, max_evalue=0.1)
    monkeypatch.setattr(specificity, "_scan", lambda o, k, least=None: scan(o, k, least, at_once, most))
    found = specificity.seed_hits(q, s, params)
    few = specificity.seed_hits(q, s, params, significant=True)
    assert "MapInArrow" in found._jdf.queryExecution().toString()  # no join of words, so no shuffle of hits
    best = {(r.query_id, r.subject_id): max(x.align_len - x.mismatch for x in few.collect() if (x.query_id, x.subject_id) == (r.query_id, r.subject_id)) for r in few.collect()}
    got = specificity.max_subjects(few, params).collect()
    lead = {k for k in best if sum((-v, j[1]) < (-best[k], k[1]) for j, v in best.items() if j[0] == k[0]) < 3}
    assert {(r.query_id, r.subject_id) for r in got} == lead and len(got) == sum((r.query_id, r.subject_id) in lead for r in few.collect())
    found = sorted(map(tuple, found.collect()))
    assert sorted(map(tuple, few.collect())) == sorted(r for r in found if r[-1] <= 0.1) != found
    monkeypatch.setattr(specificity, "MOST", 3)
    assert sorted(map(tuple, specificity.seed_hits(q, s, params).collect())) == found


def test_derived_rows_follow_the_recipe(spark, tmp_path):
    ids = [*range(0, 3000, 7), -1, -250, -12345, 10**12 + 3, None]
    docs = spark.createDataFrame([(i, "t", (None, "en", "fr")[n % 3], "s", 1) for n, i in enumerate(ids)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    recipe = """concat_ws('', transform(sequence(0L, 239L), c -> CASE WHEN (doc_id*7919 + c*104729 + doc_id*c*31) % 997 % 211 = 1 THEN '-' WHEN (doc_id*7919 + c*104729 + doc_id*c*31) % 997 % 503 = 2 THEN 'N' ELSE
        substr('ACGT', cast(((instr('0123456789abcdef', substr(md5(concat(gene, ':', c)), 1, 1)) - 1) % 4 + CASE WHEN (c % 40 >= 30 AND (doc_id*7919 + c*104729 + doc_id*c*31) % 997 % 100 < 40)
        OR (doc_id*7919 + c*104729 + doc_id*c*31) % 997 % 100 < 3 THEN 1 + (doc_id*7919 + c*104729 + doc_id*c*31) % 997 % 3 ELSE 0 END) % 4 as int) + 1, 1) END))"""
    want = docs.selectExpr("coalesce(lang, 'none') AS gene", "doc_id").selectExpr("gene", "doc_id AS seq_idx", "'subj' || doc_id AS id", f"{recipe} AS aligned")
    got = fixtures.msa(spark, str(tmp_path))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "lambda" not in got._jdf.queryExecution().toString()  # not 240 interpreted steps a row
    big = fixtures._bases([10**18], np.zeros((1, 240), int))[0]
    assert big == fixtures._bases([10**18 % 997 + 997], np.zeros((1, 240), int))[0]


def test_gapped_tail(spark):
    cols = "query_id string, subject_id string, pident double, align_len int, qstart int, qend int, qlen int, qseq string, sseq string"
    h = spark.createDataFrame([("q", "s", 90.0, 13, 1, 12, 12, "ACGTACG-TACGT", "ACGTACGTTACGT"), ("q", "t", 90.0, 12, 1, 12, 12, "ACGTACGTACGT", "ACGTACGTA-NT")], cols)
    assert rows(specificity.tail_mismatches(h), "subject_id", "tail_mismatches", "tail_covered") == [("s", 0, 5), ("t", 2, 5)]


def test_scores_top_and_report(spark):
    c = spark.createDataFrame(
        [("g", "AA", "CC", 0, 2, 50, 52, 60.0, 60.0, 50.0, 50.0, 52, 0.0, 30.0, 0.0, True, 1, 2, 10, 0, 1.0), ("g", "AA", "CC", 1, 3, 51, 53, 60.0, 60.0, 50.0, 50.0, 52, 0.0, 30.0, 0.0, True, 3, 4, 10, 10, 0.5)],
        "gene string, forward_seq string, reverse_seq string, forward_start int, forward_end int, reverse_start int, reverse_end int, tm_forward double, tm_reverse double, gc_forward double, gc_reverse double, amplicon_length int, tm_diff double, heterodimer_tm double, gc_balance_abs_diff double, is_preferred_amplicon_range boolean, f_ord long, r_ord long, total_sequences_count long, failed_due_to_3prime_count long, pair_coverage_fraction double",
    )
    m = spark.createDataFrame([("g", "AA", 30.0, 45.0), ("g", "CC", 20.0, 30.0)], "gene string, sequence string, hairpin_tm double, homodimer_tm double")
    s = scoring.score_pairs(c, m)
    best = s.orderBy(F.desc("final_score")).first()
    assert best.homodimer_penalty == 0.5 and best.final_score == round(100 * (0.42 + 0.2 + 0.18 + 0.13 * (1 - 0.08) + 0.07), 9)
    single = spark.createDataFrame([("g", "AA", 0.9, 1, 5), ("g", "AA", 0.8, 2, 6)], "gene string, sequence string, coverage_fraction double, prime3_mismatch_count long, ord long")
    top = scoring.top_pairs(s, single, m).orderBy("rank").collect()
    # both rows of the repeated pair carry the later (worse) one's coordinates, and the later primer's coverage
    assert [(t.rank, t.forward_msa_start, t.forward_coverage, t.reverse_coverage, t.offtarget_summary) for t in top] == [(1, 1, 0.8, 0.0, "offtarget:not_checked"), (2, 1, 0.8, 0.0, "offtarget:not_checked")]
    assert scoring.top_pairs(s, single, m, dedupe=True).count() == 1
    genes = spark.createDataFrame([("g",), ("none",)], "gene string")
    text = dict(rows(report.report(genes, scoring.top_pairs(s, single, m)), "gene", "text"))
    assert text["none"] == "No primer pairs passed final ranking.\n" and text["g"].startswith("Top primer pairs: 2\n\n1. score=")


def test_status(spark):
    assert rows(status.gene_list(spark, "a, b"), "gene") == [("a",), ("b",)]
    with pytest.raises(ValueError):
        status.gene_list(spark, "a,,b")
    assert rows(status.genes_of(spark.createDataFrame([("a, b",), ("b , c",)], "genes string")), "gene") == [("a",), ("b",), ("c",)]
    with pytest.raises(Exception, match="empty gene"):
        status.genes_of(spark.createDataFrame([("a,,b",)], "genes string")).collect()
    g = spark.createDataFrame([("a",), ("b/c",)], "gene string")
    assert rows(g.select(status.partition_name().alias("p")), "p") == [("a",), ("b_c",)]
    f = status.funnel(g, [("one", g), ("two", g.filter("gene = 'a'"))])
    assert rows(f, "gene", "one", "two", "status") == [("a", 1, 1, "ok"), ("b/c", 1, 0, "two")]
    with pytest.raises(ValueError):
        status.require_any(status.funnel(g, [("none", g.limit(0))]))
