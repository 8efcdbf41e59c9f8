"""DuckDB SQL for the registered queries: one chain of tables, written apart from the Spark operators."""

from __future__ import annotations

import math

from ..functions.thermo import LOOP, NA, MG, DNTP, OLIGO, R, STACK, SYMMETRY, TERMINAL_AT, TERMINAL_GC
from ..operators.specificity import K, LAMBDA
from ..params import Scoring
from . import fixtures

_NA = (NA + 120.0 * (MG - DNTP) ** 0.5) / 1000.0


def _sum(x: str, which: int) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v[which]}" for k, v in STACK.items())
    return f"list_sum([CASE substr({x}, p, 2) {cases} ELSE 0 END FOR p IN range(1, length({x}))])"


def _end(x: str, which: int) -> str:
    one = lambda e: f"CASE WHEN {e} IN ('G', 'C') THEN {TERMINAL_GC[which]} ELSE {TERMINAL_AT[which]} END"
    return f"({one(f'left({x}, 1)')} + {one(f'right({x}, 1)')})"


def _tm(x: str, symmetric: str) -> str:
    h = f"CAST({_sum(x, 0)} + {_end(x, 0)} AS DOUBLE) / 10"
    s = f"(CAST({_sum(x, 1)} + {_end(x, 1)} + CASE WHEN {symmetric} THEN {SYMMETRY} ELSE 0 END AS DOUBLE) / 10 + CAST({0.368 * math.log(_NA)!r} AS DOUBLE) * (length({x}) - 1))"
    c = OLIGO * 1e-9
    return f"(1000 * {h} / ({s} + CASE WHEN {symmetric} THEN CAST({R * math.log(c)!r} AS DOUBLE) ELSE CAST({R * math.log(c / 4)!r} AS DOUBLE) END) - 273.15)"


def _rc(x: str) -> str:
    return f"reverse(translate({x}, 'ACGT', 'TGCA'))"


def _runs(table: str, cols: str, s: str, rc: str, pattern: str, group: int, high: str, each: str, out: str) -> str:
    """A query giving the best run of each row of a table by exploding offsets; 0 where there is none."""
    return f"""(SELECT {cols}, coalesce(max(e), 0) AS {out} FROM (
      SELECT {cols}, {each} AS e FROM (
        SELECT {cols}, unnest(regexp_extract_all(
          array_to_string([CASE WHEN substr(s, i + 1, 1) = substr(rc, i - o + 1, 1) THEN substr(s, i + 1, 1) ELSE '-' END
                           FOR i IN range(greatest(0, o), least(length(s), length(rc) + o)) IF i <= {high}], '') || CASE WHEN length(rc) + o >= length(s) THEN '3' ELSE '' END,
          '{pattern}', {group})) AS r
        FROM (SELECT {cols}, {s} AS s, {rc} AS rc, unnest(range(1 - length({rc}), length({s}))) AS o FROM {table})
      ) UNION ALL SELECT {cols}, NULL FROM {table}) GROUP BY ALL)"""


_HAIRPIN = f"(1000 * (CAST({_sum('r', 0)} AS DOUBLE) / 10) / (CAST({_sum('r', 1)} AS DOUBLE) / 10 + CAST({0.368 * math.log(_NA)!r} AS DOUBLE) * (length(r) - 1) - CAST({LOOP * 1000 / 310.15!r} AS DOUBLE)) - 273.15)"


def _profile(source: str) -> str:
    part = lambda c: f"CASE WHEN {c} > 0 THEN -({c}::DOUBLE / t) * log2({c}::DOUBLE / t) ELSE 0 END"
    return f"""(SELECT gene, col, a AS count_a, c AS count_c, g AS count_g, tt AS count_t, gaps AS gap_count, t AS non_gap_count, gaps::DOUBLE / n AS gap_fraction,
      CASE WHEN t > 0 THEN greatest(a, c, g, tt)::DOUBLE / t ELSE 0 END AS identity, {part('a')} + {part('c')} + {part('g')} + {part('tt')} AS entropy, t >= 1 AS suitable,
      CASE WHEN t < 1 THEN 'N' WHEN a = greatest(a, c, g, tt) THEN 'A' WHEN c = greatest(a, c, g, tt) THEN 'C' WHEN g = greatest(a, c, g, tt) THEN 'G' ELSE 'T' END AS consensus_base
      FROM (SELECT *, a + c + g + tt AS t FROM (SELECT gene, col, count(*) AS n, count(*) FILTER (base = 'A') AS a, count(*) FILTER (base = 'C') AS c, count(*) FILTER (base = 'G') AS g,
            count(*) FILTER (base = 'T') AS tt, count(*) FILTER (base = '-') AS gaps FROM {source} GROUP BY gene, col)))"""


def _single(mode: str) -> str:
    gap = "substr(o, i, 1) = '-'"
    bad = "substr(o, i, 1) != substr(sequence, i, 1)" + (f" AND NOT ({gap})" if mode == "ignore" else "")
    weight = f"CASE WHEN {gap} THEN 4.0 WHEN length(sequence) - i < 3 THEN 3.0 WHEN length(sequence) - i < 5 THEN 2.0 ELSE 1.0 END"
    return f"""(SELECT gene, sequence, orientation, msa_start, msa_end, ord, CAST(count(*) FILTER (mm <= 2 AND m3 <= 0 AND wt <= 6 {"AND NOT gap" if mode == "hard_fail" else ""}) AS BIGINT) AS matched_sequences_count,
      CAST(sum(mm) AS BIGINT) AS total_mismatch_count, CAST(sum(m3) AS BIGINT) AS prime3_mismatch_count, count(*) FILTER (gap) AS gap_overlap_count, sum(wt) AS weighted_mismatch_score_sum,
      matched_sequences_count::DOUBLE / count(*) AS coverage_fraction
      FROM (SELECT gene, sequence, orientation, msa_start, msa_end, ord, len(b) AS mm, len([i FOR i IN b IF length(sequence) - i < 3]) AS m3,
                   CAST(coalesce(list_sum([{weight} FOR i IN b]), 0) AS DOUBLE) AS wt, contains(o, '-') AS gap
            FROM (SELECT *, [i FOR i IN range(1, length(sequence) + 1) IF {bad}] AS b FROM seen)) GROUP BY ALL)"""


def _clip(x: str) -> str:
    return f"least(1, greatest(0, {x}))"


def _fixed(x: str, digits: int) -> str:
    return f"printf('%.{digits}f', round_even({x}, {digits}))"


_COV_ORDER = "pair_coverage_fraction DESC, is_preferred_amplicon_range DESC, tm_diff, heterodimer_tm, gc_balance_abs_diff, f_ord, r_ord"
_RANK = f"final_score DESC, pair_coverage_fraction DESC, single_primer_3prime_conservation DESC, offtarget_penalty, heterodimer_penalty, amplicon_size_penalty, {_COV_ORDER}"


def _score(source: str, risk: str, cons: str = "NULL", w: Scoring = Scoring()) -> str:
    pen = lambda x, kind: _clip(f"(({x}) - {getattr(w, f'{kind}_good')}) / {getattr(w, f'{kind}_bad') - getattr(w, f'{kind}_good')}")
    thermo = f"{w.tm_balance} * tm_balance_score + {w.gc} * gc_score + {w.hairpin} * (1 - hairpin_penalty) + {w.homodimer} * (1 - homodimer_penalty) + {w.heterodimer} * (1 - heterodimer_penalty)"
    size = f"CASE WHEN amplicon_length < {w.preferred_min} THEN ({w.preferred_min} - amplicon_length) / {float(max(1, w.preferred_min - w.allowed_min))} WHEN amplicon_length > {w.preferred_max} THEN (amplicon_length - {w.preferred_max}) / {float(max(1, w.allowed_max - w.preferred_max))} ELSE 0 END"
    return f"""(SELECT *, round(100 * {_clip(f"{w.coverage} * pair_coverage_fraction + {w.prime3} * single_primer_3prime_conservation + {w.specificity} * (1 - offtarget_penalty) + {w.thermo} * {_clip(thermo)} + {w.amplicon} * (1 - amplicon_size_penalty)")}, 9) AS final_score FROM (
      SELECT p.*, coalesce({cons}, 1 - {_clip("failed_due_to_3prime_count::DOUBLE / total_sequences_count")}) AS single_primer_3prime_conservation, 1 - {_clip(f"tm_diff / {w.tm_diff_bad}")} AS tm_balance_score,
        1 - 0.5 * {_clip(f"abs(gc_forward - gc_reverse) / {w.gc_diff_bad}")} - 0.5 * {_clip(f"abs((gc_forward + gc_reverse) / 2 - {w.gc_target}) / {w.gc_delta_bad}")} AS gc_score,
        {pen("greatest(f.hairpin_tm, r.hairpin_tm)", "hairpin")} AS hairpin_penalty, {pen("greatest(f.homodimer_tm, r.homodimer_tm)", "homodimer")} AS homodimer_penalty, {pen("heterodimer_tm", "heterodimer")} AS heterodimer_penalty,
        {_clip(f"{risk} / {w.risk_bad}")} AS offtarget_penalty, {_clip(size)} AS amplicon_size_penalty
      FROM {source} p JOIN screen f ON f.sequence = p.forward_seq JOIN screen r ON r.sequence = p.reverse_seq))"""


def _top(source: str, summary: str) -> str:
    return f"""(SELECT b.gene, b.rank, b.forward_seq AS forward_sequence, b.reverse_seq AS reverse_sequence, l.forward_start AS forward_msa_start, l.forward_end AS forward_msa_end, l.reverse_start AS reverse_msa_start,
      l.reverse_end AS reverse_msa_end, l.tm_forward, l.tm_reverse, l.gc_forward, l.gc_reverse, l.amplicon_length, fc.coverage_fraction AS forward_coverage, rc.coverage_fraction AS reverse_coverage, l.pair_coverage_fraction AS pair_coverage,
      fc.prime3_mismatch_count AS forward_3prime_mismatch_count, rc.prime3_mismatch_count AS reverse_3prime_mismatch_count, fs.hairpin_tm AS forward_hairpin_tm, rs.hairpin_tm AS reverse_hairpin_tm, fs.homodimer_tm AS forward_homodimer_tm,
      rs.homodimer_tm AS reverse_homodimer_tm, l.heterodimer_tm, {summary} AS offtarget_summary, b.final_score
      FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY {_RANK}) AS rank FROM {source} QUALIFY rank <= 20) b
      JOIN (SELECT *, row_number() OVER (PARTITION BY gene, forward_seq, reverse_seq ORDER BY {_COV_ORDER}) AS k, count(*) OVER (PARTITION BY gene, forward_seq, reverse_seq) AS n FROM {source} QUALIFY k = n) l USING (gene, forward_seq, reverse_seq)
      JOIN (SELECT * FROM single_hardfail QUALIFY ord = max(ord) OVER (PARTITION BY gene, sequence)) fc ON fc.gene = b.gene AND fc.sequence = b.forward_seq
      JOIN (SELECT * FROM single_hardfail QUALIFY ord = max(ord) OVER (PARTITION BY gene, sequence)) rc ON rc.gene = b.gene AND rc.sequence = b.reverse_seq
      JOIN screen fs ON fs.sequence = b.forward_seq JOIN screen rs ON rs.sequence = b.reverse_seq LEFT JOIN risk k ON k.forward_seq = b.forward_seq AND k.reverse_seq = b.reverse_seq)"""


def _lines() -> str:
    f = _fixed
    side = lambda tag, s: f"'   {tag} ' || {s}_sequence || ' [' || {s}_msa_start || ',' || {s}_msa_end || ') Tm=' || {f(f'tm_{s}', 2)} || ' GC=' || {f(f'gc_{s}', 2)} || ' cov=' || {f(f'{s}_coverage', 3)}"
    nl = " || chr(10) || "
    return nl.join([
        f"rank || '. score=' || {f('final_score', 2)} || ' | pair_cov=' || {f('pair_coverage', 3)} || ' | amplicon=' || amplicon_length || ' bp'", side("FWD", "forward"), side("REV", "reverse"),
        "'   3'' mismatches (F=' || forward_3prime_mismatch_count || ', R=' || reverse_3prime_mismatch_count || ')'",
        f"'   Hairpin(F/R)=(' || {f('forward_hairpin_tm', 2)} || '/' || {f('reverse_hairpin_tm', 2)} || ') Homodimer(F/R)=(' || {f('forward_homodimer_tm', 2)} || '/' || {f('reverse_homodimer_tm', 2)} || ') Heterodimer=' || {f('heterodimer_tm', 2)}",
        "'   ' || offtarget_summary",
    ])


def _tables() -> dict[str, str]:
    amb = "CASE WHEN length(seq) = 0 THEN 1.0 ELSE length(regexp_replace(seq, '[ACGT]', '', 'g'))::DOUBLE / length(seq) END"
    generic = lambda skip: f"SELECT gene, col, base, count(*) AS n, min(seq_idx) AS first FROM h WHERE base NOT IN ({skip}) GROUP BY ALL"
    return {
        "docs": "(SELECT doc_id, text, source, coalesce(lang, 'none') AS lang FROM documents)",
        "h": """(SELECT gene, seq_idx, col, CASE WHEN r % 211 = 1 THEN '-' WHEN r % 503 = 2 THEN 'N' ELSE substr('ACGT', ((b + CASE WHEN (col % 40 >= 30 AND r % 100 < 40) OR r % 100 < 3 THEN 1 + r % 3 ELSE 0 END) % 4)::INT + 1, 1) END AS base
          FROM (SELECT lang AS gene, doc_id AS seq_idx, c::INT AS col, (doc_id * 7919 + c * 104729 + doc_id * c * 31) % 997 AS r, (strpos('0123456789abcdef', substr(md5(lang || ':' || c::VARCHAR), 1, 1)) - 1) % 4 AS b FROM docs, range(240) t(c)))""",
        "m": "(SELECT gene, seq_idx, string_agg(base, '' ORDER BY col) AS aligned FROM h GROUP BY gene, seq_idx)",
        "rec": """(SELECT lang AS gene, doc_id AS seq_idx, 'doc' || doc_id AS id, 'doc' || doc_id || ' [gene=' || lang || '] ' || source || CASE WHEN doc_id % 17 = 0 THEN ' partial=True' ELSE '' END AS description,
          regexp_replace(upper(text), '[^ACGTN]', '', 'g') AS seq FROM docs)""",
        "st": f"""(SELECT r.gene, any_value(med) AS median_len, quantile_cont(abs(length(seq) - med), 0.5) AS mad, any_value(p90) AS amb_p90
          FROM rec r JOIN (SELECT gene, quantile_cont(length(seq), 0.5) AS med, quantile_cont({amb}, 0.9) AS p90 FROM rec GROUP BY gene) q ON q.gene = r.gene GROUP BY r.gene)""",
        "lim": "(SELECT *, greatest(1, trunc(median_len - 4 * (mad * 1.4826))::BIGINT) AS min_len, CASE WHEN mad > 0 THEN trunc(median_len + 4 * (mad * 1.4826))::BIGINT ELSE trunc(median_len)::BIGINT END AS max_len FROM st)",
        "prof": _profile("h"),
        "clean": _profile("(SELECT gene, seq_idx, col, CASE WHEN base IN ('A', 'C', 'G', 'T') THEN base ELSE '-' END AS base FROM h)"),
        "cons": "(SELECT gene, string_agg(consensus_base, '' ORDER BY col) AS consensus FROM prof GROUP BY gene)",
        "acons": f"""(SELECT gene, string_agg(b, '' ORDER BY col) AS consensus_aligned FROM (SELECT p.gene, p.col, coalesce(arg_max(g.base, n * 1000000000 - first), '-') AS b
          FROM (SELECT DISTINCT gene, col FROM h) p LEFT JOIN ({generic("'-'")}) g ON g.gene = p.gene AND g.col = p.col GROUP BY ALL) GROUP BY gene)""",
        "gen": f"""(SELECT p.gene, p.col, coalesce(max(n::DOUBLE / t), 0) AS identity, coalesce(sum(-(n::DOUBLE / t) * log2(n::DOUBLE / t)), 0) AS entropy, arg_max(g.base, n * 1000000000 - first) AS consensus_base
          FROM (SELECT DISTINCT gene, col FROM h) p LEFT JOIN (SELECT *, sum(n) OVER (PARTITION BY gene, col) AS t FROM ({generic("'-', '.'")})) g ON g.gene = p.gene AND g.col = p.col GROUP BY ALL)""",
        "sc": "(SELECT gene, col, CASE WHEN non_gap_count = 0 THEN 1.0 ELSE 1 - entropy / 2 END AS score, non_gap_count = 0 AS all_gap FROM clean)",
        "wm": "(SELECT gene, col, window_mean FROM (SELECT gene, col, round(avg(score) OVER w, 12) AS window_mean, count(*) OVER w AS n FROM sc WINDOW w AS (PARTITION BY gene ORDER BY col ROWS BETWEEN CURRENT ROW AND 14 FOLLOWING)) WHERE n = 15)",
        "reg": """(SELECT gene, CAST(row_number() OVER (PARTITION BY gene ORDER BY start_col) - 1 AS INT) AS region_index, start_col, end_col, mean_score FROM (
          SELECT gene, min(col) AS start_col, max(col) + 15 AS end_col, avg(window_mean) AS mean_score FROM (
            SELECT *, col - row_number() OVER (PARTITION BY gene ORDER BY col) AS island FROM wm JOIN (SELECT gene, round(quantile_cont(window_mean, 0.9), 12) AS th FROM wm GROUP BY gene) USING (gene) WHERE window_mean >= th)
          GROUP BY gene, island))""",
        "arr": "(SELECT gene, list(identity ORDER BY col) AS ids, list(gap_fraction ORDER BY col) AS gs FROM prof GROUP BY gene)",
        "win": """(SELECT gene, region_index, s AS window_start, s + n AS window_end, n AS length, template_seq, list_sum(i) / n AS mean_conservativity, list_min(i) AS min_conservativity, CAST(len([x FOR x IN i IF 1 - x > 0.1]) AS INT) AS n_variable_positions,
            CAST(len([x FOR x IN g IF x > 0.1]) AS INT) AS n_high_gap_positions, o AS orientation, round(CASE WHEN o = 'forward' THEN list_sum(i[-3:]) ELSE list_sum(i[:3]) END / 3, 12) AS tail3_identity,
            round(CASE WHEN o = 'forward' THEN list_sum(i[-5:]) ELSE list_sum(i[:5]) END / 5, 12) AS tail5_identity, CASE WHEN o = 'forward' THEN template_seq ELSE reverse(translate(template_seq, 'ACGT', 'TGCA')) END AS primer_seq,
            ((region_index::BIGINT * 1024 + n) * 2147483648 + s) * 2 + CASE WHEN o = 'reverse' THEN 1 ELSE 0 END AS ord
          FROM (SELECT *, substr(consensus, s + 1, n) AS template_seq, ids[s + 1 : s + n] AS i, gs[s + 1 : s + n] AS g, unnest(['forward', 'reverse']) AS o
                FROM (SELECT *, unnest(range(start_col, end_col - n + 1))::INT AS s FROM (SELECT reg.*, n::INT AS n FROM reg, range(18, 26) t(n)) WHERE end_col - start_col >= n) JOIN cons USING (gene) JOIN arr USING (gene))
          WHERE NOT contains(template_seq, 'N') AND n_variable_positions <= 6 AND n_high_gap_positions <= 0 AND tail3_identity >= 0.95 AND tail5_identity >= 0.90)""",
        "pr": "(SELECT gene, primer_seq AS sequence, orientation, window_start AS msa_start, window_end AS msa_end, ord FROM win)",
        "sq": """(SELECT gene, sequence, orientation, msa_start, msa_end, ord, CAST(length(sequence) AS INT) AS length, length(regexp_replace(sequence, '[^GC]', '', 'g')) * 100.0::DOUBLE / length(sequence) AS gc_percent,
          CAST(list_max([length(r) FOR r IN regexp_extract_all(sequence, 'A+|C+|G+|T+')]) AS INT) AS max_homopolymer_run, CAST(length(regexp_replace(right(sequence, 2), '[^GC]', '', 'g')) AS INT) AS gc_clamp_last2_count, gc_clamp_last2_count BETWEEN 1 AND 2 AS has_gc_clamp FROM pr)""",
        "solved": "(SELECT DISTINCT sequence, 10.0::DOUBLE AS hairpin_tm, length(sequence) * 2.0::DOUBLE AS homodimer_tm, CASE WHEN sequence LIKE '%C' THEN 50.0::DOUBLE END AS self_dimer_3p_tm FROM pr WHERE sequence LIKE 'A%')",
        "dist": "(SELECT DISTINCT sequence FROM pr)",
        "s_tm": f"(SELECT sequence, {_tm('sequence', f'sequence = {_rc("sequence")}')} AS tm FROM dist)",
        "s_ho": _runs("dist", "sequence", "sequence", _rc("sequence"), "[ACGT]{2,}", 0, "1000000", _tm("r", "false"), "homodimer_tm"),
        "s_3p": _runs("dist", "sequence", "sequence", _rc("sequence"), "([ACGT]{2,})3", 1, "1000000", _tm("r", "false"), "self_dimer_3p_tm"),
        "s_hp": _runs("dist", "sequence", "sequence", _rc("sequence"), "[ACGT]{3,}", 0, "floor((length(s) - 5 + o) / 2.0)", _HAIRPIN, "hairpin_tm"),
        "screen": "(SELECT * FROM s_tm JOIN s_ho USING (sequence) JOIN s_3p USING (sequence) JOIN s_hp USING (sequence))",
        "met": """(SELECT *, length BETWEEN 18 AND 25 AND gc_percent BETWEEN 30 AND 70 AND tm BETWEEN 48 AND 70 AND max_homopolymer_run <= 5 AND gc_clamp_last2_count BETWEEN 0 AND 2 AND hairpin_tm <= 47 AND homodimer_tm <= 47
          AND self_dimer_3p_tm <= 45 AS passed_basic_filters FROM sq JOIN screen USING (sequence))""",
        "fil": "(SELECT * FROM met WHERE passed_basic_filters)",
        "seen": "(SELECT f.gene, sequence, orientation, msa_start, msa_end, ord, CASE WHEN orientation = 'forward' THEN substr(aligned, msa_start + 1, msa_end - msa_start) ELSE reverse(translate(substr(aligned, msa_start + 1, msa_end - msa_start), 'ACGT', 'TGCA')) END AS o FROM fil f JOIN m USING (gene))",
        "single_penalize": _single("penalize"),
        "single_ignore": _single("ignore"),
        "single_hardfail": _single("hard_fail"),
        "cp": """(SELECT f.gene, f.sequence AS forward_seq, r.sequence AS reverse_seq, f.msa_start AS forward_start, f.msa_end AS forward_end, r.msa_start AS reverse_start, r.msa_end AS reverse_end, f.tm AS tm_forward, r.tm AS tm_reverse,
            f.gc_percent AS gc_forward, r.gc_percent AS gc_reverse, f.ord AS f_ord, r.ord AS r_ord, r.msa_end - f.msa_start AS amplicon_length, abs(f.tm - r.tm) AS tm_diff, abs(f.gc_percent - r.gc_percent) AS gc_balance_abs_diff,
            (f.gc_percent + r.gc_percent) / 2 AS gc_balance_mean, r.msa_end - f.msa_start BETWEEN 40 AND 120 AS is_preferred_amplicon_range
          FROM fil f JOIN fil r ON f.gene = r.gene AND f.msa_start < r.msa_start AND r.msa_end - f.msa_start BETWEEN 40 AND 220 AND abs(f.tm - r.tm) <= 3.5 WHERE f.orientation = 'forward' AND r.orientation = 'reverse')""",
        "cpd": "(SELECT DISTINCT forward_seq, reverse_seq FROM cp)",
        "het": _runs("cpd", "forward_seq, reverse_seq", "forward_seq", _rc("reverse_seq"), "[ACGT]{2,}", 0, "1000000", _tm("r", "false"), "heterodimer_tm"),
        "pairs": "(SELECT * FROM cp JOIN het USING (forward_seq, reverse_seq) WHERE heterodimer_tm <= 47)",
        "flag": """(SELECT DISTINCT gene, seq_idx, sequence, orientation, msa_start, msa_end, mm <= 2 AND m3 <= 0 AND NOT contains(o, '-') AS ok, m3 > 0 AS bad3 FROM (
          SELECT *, len([i FOR i IN range(1, length(sequence) + 1) IF substr(o, i, 1) != substr(sequence, i, 1)]) AS mm, len([i FOR i IN range(length(sequence) - 2, length(sequence) + 1) IF substr(o, i, 1) != substr(sequence, i, 1)]) AS m3
          FROM (SELECT DISTINCT f.gene, seq_idx, sequence, orientation, msa_start, msa_end, CASE WHEN orientation = 'forward' THEN substr(aligned, msa_start + 1, msa_end - msa_start) ELSE reverse(translate(substr(aligned, msa_start + 1, msa_end - msa_start), 'ACGT', 'TGCA')) END AS o FROM fil f JOIN m USING (gene))))""",
        "pc": """(SELECT p.*, fully_matched_sequences_count, failed_forward_count, failed_reverse_count, failed_due_to_3prime_count, total_sequences_count, fully_matched_sequences_count::DOUBLE / total_sequences_count AS pair_coverage_fraction
          FROM pairs p JOIN (SELECT p.gene, p.forward_seq, p.forward_start, p.forward_end, p.reverse_seq, p.reverse_start, p.reverse_end, count(*) AS total_sequences_count,
             count(*) FILTER (f.ok AND r.ok AND length(replace(substr(aligned, forward_start + 1, reverse_end - forward_start), '-', '')) >= 0.75 * (reverse_end - forward_start)) AS fully_matched_sequences_count,
             count(*) FILTER (NOT f.ok) AS failed_forward_count, count(*) FILTER (NOT r.ok) AS failed_reverse_count, count(*) FILTER (f.bad3 OR r.bad3) AS failed_due_to_3prime_count
            FROM (SELECT DISTINCT gene, forward_seq, forward_start, forward_end, reverse_seq, reverse_start, reverse_end FROM pairs WHERE forward_end <= reverse_start) p
            JOIN flag f ON f.gene = p.gene AND f.sequence = forward_seq AND f.msa_start = forward_start AND f.msa_end = forward_end AND f.orientation = 'forward'
            JOIN flag r ON r.gene = p.gene AND r.sequence = reverse_seq AND r.msa_start = reverse_start AND r.msa_end = reverse_end AND r.orientation = 'reverse' AND r.seq_idx = f.seq_idx
            JOIN m ON m.gene = p.gene AND m.seq_idx = f.seq_idx GROUP BY ALL) USING (gene, forward_seq, forward_start, forward_end, reverse_seq, reverse_start, reverse_end))""",
        "qs": f"(SELECT sequence AS query_id, 'plus' AS sstrand, sequence AS oriented FROM (SELECT DISTINCT sequence FROM fil) UNION ALL SELECT sequence, 'minus', {_rc('sequence')} FROM (SELECT DISTINCT sequence FROM fil))",
        "sub": "(SELECT 'subj' || seq_idx AS subject_id, replace(aligned, '-', '') AS seq FROM m)",
        "diag": """(SELECT query_id, sstrand, oriented, subject_id, sp - qp AS diag, min(qp) AS a, max(qp) + 6 AS b FROM (SELECT *, substr(oriented, qp, 7) AS w FROM (SELECT *, unnest(range(1, length(oriented) - 5)) AS qp FROM qs)) q
          JOIN (SELECT *, substr(seq, sp, 7) AS w FROM (SELECT *, unnest(range(1, length(seq) - 5)) AS sp FROM sub)) s USING (w) GROUP BY ALL)""",
        "hits0": f"""(SELECT query_id, subject_id, sstrand, (n - mm) * 100.0::DOUBLE / n AS pident, CAST(n AS INT) AS align_len, CAST(mm AS INT) AS mismatch, CAST(CASE WHEN sstrand = 'plus' THEN a ELSE length(oriented) - b + 1 END AS INT) AS qstart,
            CAST(CASE WHEN sstrand = 'plus' THEN b ELSE length(oriented) - a + 1 END AS INT) AS qend, CAST(CASE WHEN sstrand = 'plus' THEN a + diag ELSE b + diag END AS INT) AS sstart, CAST(CASE WHEN sstrand = 'plus' THEN b + diag ELSE a + diag END AS INT) AS send,
            CAST(length(oriented) AS INT) AS qlen, CASE WHEN sstrand = 'plus' THEN qo ELSE {_rc('qo')} END AS qseq, CASE WHEN sstrand = 'plus' THEN so ELSE {_rc('so')} END AS sseq
          FROM (SELECT *, len([i FOR i IN range(1, n + 1) IF substr(qo, i, 1) != substr(so, i, 1)]) AS mm FROM (SELECT d.*, b - a + 1 AS n, substr(oriented, a, b - a + 1) AS qo, substr(seq, a + diag, b - a + 1) AS so FROM diag d JOIN sub USING (subject_id))))""",
        "rated": f"(SELECT *, qlen * (SELECT sum(length(seq)) FROM sub)::DOUBLE * pow(2::DOUBLE, -bitscore) AS evalue FROM (SELECT *, ({LAMBDA}::DOUBLE * (align_len - 4 * mismatch) - {math.log(K)!r}::DOUBLE) / {math.log(2.0)!r}::DOUBLE AS bitscore FROM hits0))",
        "near": "(SELECT * EXCLUDE (bitscore, evalue) FROM rated WHERE evalue <= 1000)",
        "few": "(SELECT * FROM near SEMI JOIN (SELECT query_id, subject_id FROM (SELECT query_id, subject_id, max(align_len - mismatch) AS best FROM near GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY best DESC, subject_id) <= 500) USING (query_id, subject_id))",
        "hits": """(SELECT *, true AS is_off_target, qend = qlen AND tail_covered >= 5 AND tail_mismatches <= 1 AS has_good_3prime_match FROM (
          SELECT *, CAST(len([i FOR i IN range(1, length(qseq) + 1) IF qstart + i - 1 > qlen - 5]) AS INT) AS tail_covered,
            CAST(len([i FOR i IN range(1, length(qseq) + 1) IF qstart + i - 1 > qlen - 5 AND substr(qseq, i, 1) != substr(sseq, i, 1)]) AS INT) AS tail_mismatches FROM few WHERE pident >= 80 AND align_len >= 12))""",
        "risk": """(SELECT forward_seq, reverse_seq, coalesce(n, 0) AS potential_off_target_amplicons_count, coalesce(g, 0) AS good_3prime_off_target_amplicons_count, coalesce(n, 0) + 8.0::DOUBLE * coalesce(g, 0) AS off_target_pair_risk_score
          FROM (SELECT DISTINCT forward_seq, reverse_seq FROM pairs) p LEFT JOIN (SELECT forward_seq, reverse_seq, count(*) AS n, count(*) FILTER (f.has_good_3prime_match OR r.has_good_3prime_match) AS g FROM (SELECT DISTINCT forward_seq, reverse_seq FROM pairs)
            JOIN hits f ON f.query_id = forward_seq JOIN hits r ON r.query_id = reverse_seq AND r.subject_id = f.subject_id AND r.sstrand != f.sstrand AND greatest(f.sstart, f.send, r.sstart, r.send) - least(f.sstart, f.send, r.sstart, r.send) + 1 BETWEEN 60 AND 150 GROUP BY ALL) USING (forward_seq, reverse_seq))""",
        "scored": _score("pc", "0.0"),
        "scored_risk": _score("(SELECT * FROM pc JOIN (SELECT forward_seq, reverse_seq, off_target_pair_risk_score FROM risk) USING (forward_seq, reverse_seq))", "off_target_pair_risk_score"),
        "scored_supplied": _score("pc", "0.0", "(CASE WHEN gc_forward >= 50 AND gc_reverse >= 50 THEN (gc_forward / 100 + gc_reverse / 100) / 2 END)"),
        "scored_weighted": _score("pc", "0.0", w=fixtures.WEIGHTED),
        "top": _top("scored", "'offtarget:not_checked'"),
        "top_risk": _top("scored_risk", "'offtarget_amplicons=' || k.potential_off_target_amplicons_count || '; offtarget_amplicons_good3p=' || k.good_3prime_off_target_amplicons_count || '; offtarget_risk=' || printf('%.3f', k.off_target_pair_risk_score)"),
    }


_SINGLE_COLS = "gene, sequence, orientation, msa_start, msa_end, ord, matched_sequences_count, total_mismatch_count, prime3_mismatch_count, gap_overlap_count, weighted_mismatch_score_sum, coverage_fraction"


def _finals() -> dict[str, str]:
    amb = "CASE WHEN length(seq) = 0 THEN 1.0 ELSE length(regexp_replace(seq, '[ACGT]', '', 'g'))::DOUBLE / length(seq) END"
    kept = f"SELECT r.* FROM rec r JOIN lim USING (gene) WHERE NOT contains(description, 'partial=True') AND length(seq) BETWEEN min_len AND max_len AND {amb} <= amb_p90"
    first = lambda t: f"SELECT gene, min(seq_idx) AS seq_idx FROM ({t}) GROUP BY gene, seq"
    everyone = "(SELECT DISTINCT gene FROM m UNION ALL SELECT 'none at all')"
    files = " UNION ALL ".join(f"SELECT '{kind}' AS kind, g.gene, coalesce({head} || string_agg(forward_sequence || '{sep}' || reverse_sequence, ';' ORDER BY rank), '') AS fields FROM {everyone} g LEFT JOIN top USING (gene) GROUP BY g.gene" for kind, sep, head in (("csv", ",", "'forward_sequence,reverse_sequence;'"), ("tsv", "\t", "'forward_sequence\treverse_sequence;'"), ("json", ",", "''")))
    tops = ", ".join(f"SELECT '{k}' AS kind, gene, rank, forward_sequence, reverse_sequence, amplicon_length, offtarget_summary, final_score FROM top" for k in ("csv", "tsv", "json")).replace(", SELECT '", " UNION ALL SELECT '")
    return {
        "header_gene_filter": "SELECT gene, seq_idx, id FROM rec WHERE length(seq) > 0 AND regexp_matches(id || ' ' || description, '(?i)\\bgene\\s*=\\s*en\\b')",
        "own_gene_filter": "SELECT gene, seq_idx FROM rec WHERE length(seq) > 0 AND regexp_matches(description, '(?i)\\bgene\\s*=\\s*' || gene || '\\b')",
        "ambiguous_fraction": f"SELECT seq_idx, {amb} AS fraction FROM rec",
        "partial_records": "SELECT gene, seq_idx FROM rec WHERE contains(description, 'partial=True')",
        "robust_length_stats": "SELECT gene, median_len, mad, min_len, max_len, amb_p90 FROM lim",
        "auto_filter": first(kept),
        "exact_dedupe": first("SELECT * FROM rec"),
        "column_profile": "SELECT * FROM prof",
        "consensus": "SELECT * FROM cons",
        "generic_column_metrics": "SELECT * FROM gen",
        "aligned_consensus": "SELECT * FROM acons",
        "sanitized_profile": "SELECT * FROM clean",
        "conservation_score": "SELECT * FROM sc",
        "window_mean": "SELECT * FROM wm",
        "conserved_regions": "SELECT * FROM reg",
        "region_violations": """SELECT * FROM (SELECT gene, region_index, start_col, end_col, CASE WHEN start_col < 0 THEN 'negative start' WHEN end_col <= start_col THEN 'empty' WHEN length(consensus_aligned) < end_col THEN 'beyond the alignment'
            WHEN NOT regexp_matches(substr(consensus_aligned, start_col + 1, end_col - start_col), '[^-]') THEN 'all gaps' END AS reason FROM (SELECT gene, region_index, start_col - region_index * 40 AS start_col, end_col FROM reg) JOIN acons USING (gene)) WHERE reason IS NOT NULL""",
        "window_candidates": "SELECT * FROM win",
        "single_primers": "SELECT * FROM pr",
        "reverse_complement": "SELECT gene, seq_idx, reverse(translate(aligned, 'ACGT', 'TGCA')) AS rc FROM m",
        "sequence_metrics": "SELECT * EXCLUDE (ord) FROM sq",
        "nn_tm": "SELECT * FROM s_tm",
        "homodimer_screen": "SELECT * FROM s_ho",
        "self_dimer_3p": "SELECT * FROM s_3p",
        "hairpin_screen": "SELECT * FROM s_hp",
        "primer_filters": "SELECT gene, sequence, orientation, msa_start, msa_end, tm, passed_basic_filters FROM met",
        "single_coverage": f"SELECT {_SINGLE_COLS} FROM single_penalize",
        "single_coverage_ignore": f"SELECT {_SINGLE_COLS} FROM single_ignore",
        "single_coverage_hardfail": f"SELECT {_SINGLE_COLS} FROM single_hardfail",
        "primer_pairs": "SELECT * FROM pairs",
        "heterodimer_screen": "SELECT * FROM het",
        "pair_coverage": "SELECT gene, forward_seq, reverse_seq, forward_start, reverse_end, f_ord, r_ord, fully_matched_sequences_count, failed_forward_count, failed_reverse_count, failed_due_to_3prime_count, total_sequences_count, pair_coverage_fraction FROM pc",
        "seed_hits": "SELECT * FROM hits0",
        "hit_evalues": "SELECT query_id, subject_id, sstrand, qstart, sstart, bitscore, evalue FROM rated WHERE evalue <= 1000",
        "pair_scores_weighted": "SELECT gene, forward_seq, reverse_seq, f_ord, r_ord, tm_balance_score, gc_score, hairpin_penalty, amplicon_size_penalty, final_score FROM scored_weighted",
        "gene_reasons": """SELECT gene, rows, coalesce(n, 0) AS regions, CASE WHEN n IS NULL THEN 'regions' ELSE 'ok' END AS status, CASE WHEN n IS NULL THEN 'no conserved region of at least 22 columns' END AS reason
          FROM (SELECT gene, count(*) AS rows FROM m GROUP BY gene) LEFT JOIN (SELECT gene, count(*) AS n FROM reg WHERE end_col - start_col >= 22 GROUP BY gene) USING (gene)""",
        "table_files": f"SELECT * FROM ({files})",
        "max_subjects": "SELECT query_id, count(*) AS hits, count(DISTINCT subject_id) AS subjects, max(subject_id) AS last_subject FROM few GROUP BY query_id",
        "tail_mismatch": "SELECT query_id, subject_id, sstrand, qstart, sstart, tail_mismatches, tail_covered, has_good_3prime_match, is_off_target FROM hits",
        "target_subjects": "SELECT query_id, count(*) FILTER (subject_id != 'subj7' AND NOT contains(subject_id, 'j1')) AS off_target, count(*) AS hits FROM hits0 WHERE pident >= 80 AND align_len >= 12 GROUP BY query_id",
        "single_specificity": """SELECT f.gene, f.sequence, orientation, msa_start, msa_end, coalesce(n, 0) AS significant_hits_count, coalesce(n, 0) AS off_target_hits_count, coalesce(g, 0) AS good_3prime_off_target_hits_count,
            coalesce(n, 0) + 5.0::DOUBLE * coalesce(g, 0) AS off_target_risk_score FROM fil f LEFT JOIN (SELECT query_id, count(*) AS n, count(*) FILTER (has_good_3prime_match) AS g FROM hits GROUP BY query_id) ON query_id = f.sequence""",
        "pair_specificity": "SELECT * FROM risk",
        "pair_scores": "SELECT gene, forward_seq, reverse_seq, f_ord, r_ord, single_primer_3prime_conservation, tm_balance_score, gc_score, hairpin_penalty, homodimer_penalty, heterodimer_penalty, offtarget_penalty, amplicon_size_penalty, final_score FROM scored",
        "top_pairs": "SELECT * FROM top",
        "top_pairs_pruned": "SELECT * FROM top",
        "offtarget_summary": "SELECT gene, rank, forward_sequence, reverse_sequence, offtarget_summary, final_score FROM top_risk",
        "report_lines": f"SELECT gene, rank, {_lines()} AS text FROM top",
        "gene_reports": "SELECT g.gene, CASE WHEN n IS NULL THEN 2 ELSE 2 + n * 7 END AS lines FROM (SELECT DISTINCT gene FROM m) g LEFT JOIN (SELECT gene, count(*) AS n FROM top GROUP BY gene) USING (gene)",
        "stage_funnel": """SELECT *, CASE WHEN rows = 0 THEN 'rows' WHEN regions = 0 THEN 'regions' WHEN windows = 0 THEN 'windows' WHEN primers = 0 THEN 'primers' WHEN filtered = 0 THEN 'filtered' WHEN pairs = 0 THEN 'pairs' ELSE 'ok' END AS status
            FROM (SELECT g.gene, (SELECT count(*) FROM m WHERE gene = g.gene) AS rows, (SELECT count(*) FROM reg WHERE gene = g.gene) AS regions, (SELECT count(*) FROM win WHERE gene = g.gene) AS windows, (SELECT count(*) FROM pr WHERE gene = g.gene) AS primers,
              (SELECT count(*) FROM fil WHERE gene = g.gene) AS filtered, (SELECT count(*) FROM pairs WHERE gene = g.gene) AS pairs FROM (SELECT DISTINCT gene FROM m UNION ALL SELECT 'none') g)""",
        "gene_partitions": "SELECT DISTINCT gene, regexp_replace(gene || ' / ' || id, '[^\\p{L}\\p{N}\\-_.]', '_', 'g') AS folder FROM rec",
        "fasta_roundtrip": "SELECT id, description, length(seq) AS n, md5(seq) AS seq_md5 FROM rec WHERE length(seq) > 0",
        "regions_json_array_roundtrip": "SELECT gene, region_index, start_col, end_col, mean_score FROM reg",
        "report_sink_roundtrip": f"SELECT gene, md5(line) AS line_md5, count(*) AS n FROM (SELECT gene, unnest(string_split({_lines()}, chr(10))) AS line FROM top) GROUP BY ALL",
        "report_text": f"""SELECT g.gene, CASE WHEN n IS NULL THEN 'No primer pairs passed final ranking.' || chr(10) ELSE 'Top primer pairs: ' || n || chr(10) || chr(10) || body || chr(10) END AS text
            FROM (SELECT DISTINCT gene FROM m) g LEFT JOIN (SELECT gene, count(*) AS n, string_agg({_lines()}, chr(10) || chr(10) ORDER BY rank) AS body FROM top GROUP BY gene) USING (gene)""",
        "report_files": f"""SELECT g.gene, CASE WHEN n IS NULL THEN 'No primer pairs passed final ranking.' || chr(10) ELSE 'Top primer pairs: ' || n || chr(10) || chr(10) || body || chr(10) END AS text
            FROM {everyone} g LEFT JOIN (SELECT gene, count(*) AS n, string_agg({_lines()}, chr(10) || chr(10) ORDER BY rank) AS body FROM top GROUP BY gene) USING (gene)""",
        "min_region_len": "SELECT gene, CAST(row_number() OVER (PARTITION BY gene ORDER BY start_col) - 1 AS INT) AS region_index, start_col, end_col, mean_score FROM reg WHERE end_col - start_col >= 16",
        "structure_override": """SELECT gene, sequence, orientation, msa_start, msa_end, hairpin_tm, homodimer_tm, self_dimer_3p_tm, length BETWEEN 18 AND 25 AND gc_percent BETWEEN 30 AND 70 AND tm BETWEEN 48 AND 70 AND max_homopolymer_run <= 5
            AND gc_clamp_last2_count BETWEEN 0 AND 2 AND hairpin_tm <= 47 AND homodimer_tm <= 47 AND self_dimer_3p_tm <= 45 AS passed_basic_filters
            FROM (SELECT q.*, s.tm, coalesce(o.hairpin_tm, s.hairpin_tm) AS hairpin_tm, coalesce(o.homodimer_tm, s.homodimer_tm) AS homodimer_tm, coalesce(o.self_dimer_3p_tm, o.homodimer_tm, s.self_dimer_3p_tm) AS self_dimer_3p_tm
                  FROM sq q JOIN screen s USING (sequence) LEFT JOIN solved o USING (sequence))""",
        "primer_violations": "SELECT gene, sequence, orientation, msa_start, msa_end + msa_start % 3 AS msa_end FROM pr WHERE msa_start % 3 > 0",
        "gene_list": "SELECT DISTINCT trim(unnest(string_split(gene || ' , ' || id, ','))) AS gene FROM rec",
        "orientation_split": "SELECT gene, orientation, count(*) AS n FROM pr GROUP BY ALL",
        "pair_order": """SELECT gene, CAST(row_number() OVER (PARTITION BY gene ORDER BY is_preferred_amplicon_range DESC, round(tm_diff, 9), round(heterodimer_tm, 9), round(gc_balance_abs_diff, 9), f_ord, r_ord) AS INT) AS position, f_ord, r_ord FROM pairs""",
        "pair_violations": """SELECT * FROM (SELECT gene, f_ord, r_ord, CASE WHEN fs < 0 THEN 'negative forward start' WHEN forward_end <= fs THEN 'empty forward primer' WHEN forward_end > 240 THEN 'forward primer beyond the alignment' WHEN length(forward_seq) != forward_end - fs THEN 'forward length differs'
            WHEN reverse_start < 0 THEN 'negative reverse start' WHEN re <= reverse_start THEN 'empty reverse primer' WHEN re > 240 THEN 'reverse primer beyond the alignment' WHEN length(reverse_seq) != re - reverse_start THEN 'reverse length differs' END AS reason
            FROM (SELECT *, forward_start - (f_ord % 7) * 20 AS fs, reverse_end + (r_ord % 3) * 30 AS re FROM pairs)) WHERE reason IS NOT NULL""",
        "single_risk_order": """SELECT gene, ord, CAST(row_number() OVER (PARTITION BY gene ORDER BY g, n, n + 5 * g, ord) AS INT) AS position, n + 5.0::DOUBLE * g AS off_target_risk_score FROM (SELECT f.gene, f.ord, coalesce(n, 0) AS n, coalesce(g, 0) AS g
            FROM fil f LEFT JOIN (SELECT query_id, count(*) AS n, count(*) FILTER (has_good_3prime_match) AS g FROM hits GROUP BY query_id) ON query_id = f.sequence)""",
        "pair_risk_order": "SELECT forward_seq, reverse_seq, CAST(row_number() OVER (ORDER BY good_3prime_off_target_amplicons_count, potential_off_target_amplicons_count, off_target_pair_risk_score, forward_seq, reverse_seq) AS INT) AS position FROM risk",
        "pair_scores_supplied": "SELECT gene, forward_seq, reverse_seq, f_ord, r_ord, single_primer_3prime_conservation, final_score FROM scored_supplied",
        "alignment_roundtrip": "SELECT gene, 'subj' || seq_idx AS id, md5(aligned) AS aligned_md5 FROM m",
        "regions_json_roundtrip": "SELECT * FROM reg",
        "pairs_csv_tsv_json_roundtrip": tops,
        "hit_table_scan": "SELECT query_id, sstrand, count(*) AS n, sum(align_len) AS letters, max(qend) AS qend FROM hits GROUP BY ALL",
    }


_PROFILE = "gap_fraction identity entropy"
_COVER = "weighted_mismatch_score_sum coverage_fraction"
#: Columns of doubles, which both sides round to six decimals.
_TOP = "tm_forward tm_reverse gc_forward gc_reverse forward_coverage reverse_coverage pair_coverage forward_hairpin_tm reverse_hairpin_tm forward_homodimer_tm reverse_homodimer_tm heterodimer_tm final_score"
_DOUBLES = {
    "ambiguous_fraction": "fraction", "robust_length_stats": "median_len mad amb_p90", "column_profile": _PROFILE, "sanitized_profile": _PROFILE, "generic_column_metrics": "identity entropy",
    "conservation_score": "score", "window_mean": "window_mean", "conserved_regions": "mean_score", "regions_json_roundtrip": "mean_score", "regions_json_array_roundtrip": "mean_score", "min_region_len": "mean_score",
    "structure_override": "hairpin_tm homodimer_tm self_dimer_3p_tm", "single_risk_order": "off_target_risk_score", "pair_scores_supplied": "single_primer_3prime_conservation final_score",
    "window_candidates": "mean_conservativity min_conservativity tail3_identity tail5_identity", "sequence_metrics": "gc_percent", "nn_tm": "tm", "homodimer_screen": "homodimer_tm",
    "self_dimer_3p": "self_dimer_3p_tm", "hairpin_screen": "hairpin_tm", "primer_filters": "tm", "single_coverage": _COVER, "single_coverage_ignore": _COVER, "single_coverage_hardfail": _COVER,
    "primer_pairs": "tm_forward tm_reverse gc_forward gc_reverse tm_diff gc_balance_abs_diff gc_balance_mean heterodimer_tm", "heterodimer_screen": "heterodimer_tm", "pair_coverage": "pair_coverage_fraction",
    "seed_hits": "pident", "hit_evalues": "bitscore evalue", "pair_scores_weighted": "tm_balance_score gc_score hairpin_penalty amplicon_size_penalty final_score", "single_specificity": "off_target_risk_score", "pair_specificity": "off_target_pair_risk_score",
    "pair_scores": "single_primer_3prime_conservation tm_balance_score gc_score hairpin_penalty homodimer_penalty heterodimer_penalty offtarget_penalty amplicon_size_penalty final_score",
    "top_pairs": _TOP,
    "top_pairs_pruned": _TOP, "offtarget_summary": "final_score", "pairs_csv_tsv_json_roundtrip": "final_score",
}


def build() -> dict[str, str]:
    """SQL by query: the chain of tables it needs, then the query, with doubles rounded as the Spark side's are."""
    import re

    tables = _tables()
    uses = {k: [t for t in tables if re.search(rf"\b{t}\b", v) and t != k] for k, v in tables.items()}
    out = {}
    for name, final in _finals().items():
        need: set[str] = set()
        todo = [t for t in tables if re.search(rf"\b{t}\b", final)]
        while todo:
            t = todo.pop()
            if t not in need:
                need.add(t)
                todo += uses[t]
        chain = ",\n".join(f"{t} AS MATERIALIZED {tables[t]}" for t in tables if t in need)
        doubles = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in _DOUBLES.get(name, "").split())
        out[name] = f"WITH {chain}\nSELECT *{f' REPLACE ({doubles})' if doubles else ''} FROM ({final})"
    return out
