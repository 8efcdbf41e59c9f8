"""Off-target specificity: seed hits, hit quality, risk of primers and pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import reverse_complement
from ..params import STRICT, Params
from ..storage import stored
from .joins import MOST, spread_join
from .pairs import order_by


#: The published parameters of ungapped scores of 1 and -3 for random DNA.
LAMBDA, K = 1.374, 0.711
#: Longer words don't fit a number.
LONGEST_WORD = 31
_DIGIT = np.full(128, -1, np.int64)
_DIGIT[[ord(c) for c in "ACGT"]] = range(4)


def seed_hits(queries: DataFrame, subjects: DataFrame, params: Params = STRICT, significant: bool = False, letters: int | None = None) -> DataFrame:
    """Ungapped hits of queries(sequence) in subjects(subject_id, seq), on both strands.

    Words of word_size letters are joined on equality; the words of one query and subject on one diagonal make a
    hit from the first word to the last. Columns are those of a tabular hit; evalue and bitscore are those of an
    ungapped score (with_evalues), from the letters of all subjects, or `letters` where these are some of those searched.
    With `significant`, those of evalue_filter alone, most of which the scan leaves out before it makes their rows.

    There are few different words, so each is frequent: where a count says that the queries have few words, these go to
    every task and each subject is scanned whole, so nothing is shuffled; else words are joined, salted, and the rows of
    a diagonal combined before they are shuffled.
    """
    k = params.word_size
    letters = searched_letters(subjects) if letters is None else letters
    q = queries.select(F.upper("sequence").alias("query_id")).distinct().filter(F.col("query_id").rlike("^[ACGT]+$") & (F.length("query_id") >= k))
    strands = q.select("query_id", F.explode(F.array(F.struct(F.lit("plus").alias("sstrand"), F.col("query_id").alias("oriented")), F.struct(F.lit("minus").alias("sstrand"), reverse_complement("query_id").alias("oriented")))).alias("o")).select("query_id", "o.*")
    s = subjects.select("subject_id", F.upper("seq").alias("seq")).filter(F.col("subject_id").isNotNull() & (F.length("seq") >= k))
    # every strand has a word, so so many rows tell; they are read once, for an order that the scan's numbers keep
    few = strands.limit(MOST + 1).collect() if k <= LONGEST_WORD else None
    if few is not None and sum(len(r.oriented) - k + 1 for r in few) <= MOST:
        own = strands.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(few)], "strand int, query_id string, sstrand string, oriented string")
        least = least_scores([len(r.oriented) for r in few], letters, params.max_evalue) if significant else None
        h = s.mapInArrow(_scan([r.oriented for r in few], k, least), f"subject_id {dict(s.dtypes)['subject_id']}, strand int, diag int, a int, b int, mismatch int, so string").join(F.broadcast(own), "strand")
    else:
        h = _joined(strands, s, k)
    h = h.withColumns({"qo": F.expr("substring(oriented, a, b - a + 1)"), "n": F.expr("length(oriented)"), "align_len": F.expr("b - a + 1")})
    plus = F.col("sstrand") == "plus"
    out = with_evalues(h.select(
        "query_id", "subject_id", "sstrand", ((F.col("align_len") - F.col("mismatch")) * 100.0 / F.col("align_len")).alias("pident"), "align_len", "mismatch", F.lit(0).alias("gaps"),
        F.when(plus, F.col("a")).otherwise(F.expr("n - b + 1")).alias("qstart"), F.when(plus, F.col("b")).otherwise(F.expr("n - a + 1")).alias("qend"),
        F.when(plus, F.expr("a + diag")).otherwise(F.expr("b + diag")).alias("sstart"), F.when(plus, F.expr("b + diag")).otherwise(F.expr("a + diag")).alias("send"),
        F.col("n").alias("qlen"),
        F.when(plus, F.col("qo")).otherwise(reverse_complement("qo")).alias("qseq"), F.when(plus, F.col("so")).otherwise(reverse_complement("so")).alias("sseq"),
    ), letters)
    return evalue_filter(out, params) if significant else out


def searched_letters(subjects: DataFrame) -> int:
    return subjects.agg(F.sum(F.length("seq"))).first()[0] or 0


def _joined(strands: DataFrame, s: DataFrame, k: int) -> DataFrame:
    """The hits of many queries, by a join of words: strands' columns, subject_id, diag, a, b, mismatch and so."""
    words = lambda c: F.expr(f"transform(sequence(1, length({c}) - {k} + 1), i -> struct(i AS pos, substr({c}, i, {k}) AS word))")
    qw = strands.select("query_id", "sstrand", "oriented", F.explode(words("oriented")).alias("w")).select("query_id", "sstrand", "oriented", F.col("w.pos").alias("qpos"), "w.word")
    sw = s.select("subject_id", F.explode(words("seq")).alias("w")).select("subject_id", F.col("w.pos").alias("spos"), "w.word").filter(F.col("word").rlike("^[ACGT]+$"))
    d = spread_join(sw, qw, ["word"]).groupBy("query_id", "sstrand", "oriented", "subject_id", (F.col("spos") - F.col("qpos")).alias("diag")).agg(F.min("qpos").alias("a"), (F.max("qpos") + k - 1).alias("b"))
    h = d.join(s, "subject_id").withColumn("so", F.expr("substring(seq, a + diag, b - a + 1)")).drop("seq")
    return h.withColumn("mismatch", F.expr("size(filter(sequence(1, b - a + 1), i -> substr(oriented, a + i - 1, 1) != substr(so, i, 1)))"))


def _codes(letters: np.ndarray, k: int) -> np.ndarray:
    """One number for each word of k letters, -1 where it holds another letter than ACGT."""
    n = len(letters) - k + 1
    digit = _DIGIT[np.minimum(letters, 127)]
    out, bad = np.zeros(n, np.int64), np.zeros(n, bool)
    for i in range(k):
        out = out * 4 + digit[i : i + n]
        bad |= digit[i : i + n] < 0
    out[bad] = -1
    return out


def _letters(texts: list[str], gap: int) -> np.ndarray:
    """The code points of the texts, with `gap` letters that no word holds after each."""
    return np.frombuffer(("-" * gap).join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")


def _scan(oriented: list[str], k: int, least: np.ndarray | None = None, at_once: int = 200_000, most: int = 4_000_000):
    """Hits of the strands of all queries in subjects(subject_id, seq): the words of a strand in one diagonal of a
    subject, from the first to the last. Subjects are taken together up to `at_once` letters, strands in parts where
    there are more than `most` matches of words; with `least`, hits below that score of their strand are left out."""
    gap = max(map(len, oriented), default=0) + k
    letters = _letters(oriented, gap)
    begin = np.cumsum([0, *(len(o) + gap for o in oriented)])
    code = _codes(letters, k) if len(letters) >= k else np.zeros(0, np.int64)
    at = np.flatnonzero(code >= 0)
    at = at[np.argsort(code[at], kind="stable")]
    strand = np.searchsorted(begin, at, side="right") - 1
    table = (code[at], strand, at - begin[strand])

    def diagonals(code: np.ndarray, at: np.ndarray, table: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, ...]]:
        """strand, diagonal, first and last word of each hit, from the subjects' words `code` at places `at`."""
        own, strand, pos = table
        lo, hi = np.searchsorted(own, code), np.searchsorted(own, code, side="right")
        many = hi - lo
        kinds = np.unique(strand) if many.sum() > most else []
        if len(kinds) > 1:
            first = strand < kinds[len(kinds) // 2]
            for part in (first, ~first):
                yield from diagonals(code, at, tuple(c[part] for c in table))
            return
        i = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
        # subjects are further apart than a strand is long, so a diagonal is of one subject
        key = ((np.repeat(at, many) - pos[i] + gap) * len(oriented) + strand[i]) * gap + pos[i]
        key.sort()
        group = key // gap
        start = np.flatnonzero(np.diff(group, prepend=-1))
        end = np.append(start[1:], len(key))[: len(start)] - 1
        group = group[start]
        yield group % len(oriented), group // len(oriented) - gap, key[start] % gap, key[end] % gap

    def hits(ids: pa.Array, seqs: list[str]) -> Iterator[pa.RecordBatch]:
        text = _letters(seqs, gap)
        head = np.cumsum([0, *(len(s) + gap for s in seqs)])
        code = _codes(text, k)
        at = np.flatnonzero(code >= 0)
        for s, d, a, b in diagonals(code[at], at, table):
            size = b - a + k
            # letters of both sides of all hits, one after another
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            wrong = text[np.repeat(d + a, size) + step] != letters[np.repeat(begin[s] + a, size) + step]
            mismatch = np.add.reduceat(wrong, np.cumsum(size) - size, dtype=np.int64) if len(size) else size
            if least is not None:
                good = size - 4 * mismatch >= least[s]
                s, d, a, size, mismatch = (c[good] for c in (s, d, a, size, mismatch))
            of = np.searchsorted(head, d + a, side="right") - 1
            diag = d - head[of]
            so = [seqs[i][x : x + n] for i, x, n in zip(of.tolist(), (diag + a).tolist(), size.tolist())]
            columns = [ids.take(pa.array(of)), *(pa.array(c.astype(np.int32)) for c in (s, diag, a + 1, a + size, mismatch)), pa.array(so, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["subject_id", "strand", "diag", "a", "b", "mismatch", "so"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, seqs = batch.column("subject_id"), batch.column("seq").to_pylist()
            lo = size = 0
            for i, seq in enumerate(seqs):
                size += len(seq) + gap
                if size >= at_once or i == len(seqs) - 1:
                    if oriented:
                        yield from hits(ids[lo : i + 1], seqs[lo : i + 1])
                    lo, size = i + 1, 0

    return run


def with_evalues(hits: DataFrame, letters: int) -> DataFrame:
    """Add bitscore and evalue of ungapped hits: a match counts 1, a mismatch -3; `letters` is the size of what was
    searched."""
    score = F.col("align_len") - 4 * F.col("mismatch")
    bits = (LAMBDA * score - math.log(K)) / math.log(2.0)
    return hits.withColumns({"bitscore": bits, "evalue": F.col("qlen") * float(letters) * F.pow(F.lit(2.0), -bits)})


def least_scores(lengths: list[int], letters: int, max_evalue: float) -> np.ndarray:
    """The score below which a hit of a query of each length is above the limit, with room for rounding."""
    if not letters or max_evalue <= 0:
        return np.full(len(lengths), -np.inf)
    bits = np.log2(np.array(lengths, float) * letters / max_evalue)
    return (bits * math.log(2.0) + math.log(K)) / LAMBDA - 1e-6


def evalue_filter(hits: DataFrame, params: Params = STRICT) -> DataFrame:
    """Hits at or below the limit; hits without an e-value stay."""
    return hits.filter(F.col("evalue").isNull() | (F.col("evalue") <= params.max_evalue))


def quality_filter(hits: DataFrame, params: Params = STRICT) -> DataFrame:
    return hits.filter((F.col("pident") >= params.min_hit_identity) & (F.col("align_len") >= params.min_hit_len))


def max_subjects(hits: DataFrame, params: Params = STRICT) -> DataFrame:
    """Hits in the best subjects of each query: most matches in one hit, ties to the smaller subject id."""
    return in_subjects(hits, best_subjects(hits, params))


def best_subjects(hits: DataFrame, params: Params = STRICT) -> DataFrame:
    """query_id and subject_id of the best subjects of each query.

    Each task first leaves out what cannot be among them, so a query's shuffled rows follow the tasks, not its hits.
    """
    leading = hits.select("query_id", "subject_id", (F.col("align_len") - F.col("mismatch")).cast("long").alias("best"))
    leading = leading.mapInArrow(_leading(params.max_subjects), leading.schema)
    best = leading.groupBy("query_id", "subject_id").agg(F.max("best").alias("best"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("best"), "subject_id"))
    return stored(best.withColumn("rank", rank).filter(F.col("rank") <= params.max_subjects).select("query_id", "subject_id"), "best_subjects")


def in_subjects(hits: DataFrame, best: DataFrame) -> DataFrame:
    return hits.join(F.broadcast(best) if best.limit(MOST + 1).count() <= MOST else best, ["query_id", "subject_id"], "left_semi")


def _leading(most: int, held: int = 1_000_000):
    """The `most` best subjects of each query among a task's hits (query_id, subject_id, best): a subject that has so
    many others before it where its best hit lies has them before it overall. More than `held` rows are passed on."""

    def best(table: pa.Table) -> pa.Table:
        own = table.group_by(["query_id", "subject_id"]).aggregate([("best", "max")]).rename_columns(["query_id", "subject_id", "best"])
        own = own.sort_by([("query_id", "ascending"), ("best", "descending"), ("subject_id", "ascending")])
        query = pc.dictionary_encode(own["query_id"].combine_chunks()).indices.to_numpy()
        start = np.flatnonzero(np.diff(query, prepend=-1))
        place = np.arange(len(query)) - np.repeat(start, np.diff(np.append(start, len(query))))
        return own.filter(pa.array(place < most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[pa.Table] = []
        for batch in batches:
            rows.append(pa.Table.from_batches([batch]))
            if sum(map(len, rows)) >= held:
                rows = [best(pa.concat_tables(rows))]
                if 2 * len(rows[0]) > held:
                    yield from rows.pop().combine_chunks().to_batches()
        if rows:
            yield from best(pa.concat_tables(rows)).combine_chunks().to_batches()

    return run


def is_target(ids: list[str] | None = None, substrings: list[str] | None = None) -> Column:
    subject = F.col("subject_id")
    out = subject.isin(*ids) if ids else F.lit(False)
    for s in substrings or ():
        out = out | F.contains(subject, F.lit(s))
    return out


def tail_mismatches(hits: DataFrame, params: Params = STRICT) -> DataFrame:
    """Add tail_mismatches and tail_covered: query positions of the 3' tail in the gapped strings."""
    walk = f"""aggregate(sequence(1, least(length(qseq), length(sseq))), named_struct('q', qstart - 1, 'mm', 0, 'cov', 0), (s, i) ->
        CASE WHEN substr(qseq, i, 1) = '-' THEN s
             WHEN s.q + 1 BETWEEN greatest(1, qlen - {params.hit_tail_len} + 1) AND qlen THEN named_struct('q', s.q + 1,
                  'mm', s.mm + CASE WHEN NOT upper(substr(sseq, i, 1)) RLIKE '[ACGT]' OR upper(substr(qseq, i, 1)) != upper(substr(sseq, i, 1)) THEN 1 ELSE 0 END, 'cov', s.cov + 1)
             ELSE named_struct('q', s.q + 1, 'mm', s.mm, 'cov', s.cov) END)"""
    out = hits.withColumn("qstart", F.col("qstart").cast("int")).withColumn("_t", F.when((F.length("qseq") > 0) & (F.length("sseq") > 0), F.expr(walk)))
    return out.withColumns({"tail_mismatches": F.coalesce("_t.mm", F.lit(0)), "tail_covered": F.coalesce("_t.cov", F.lit(0))}).drop("_t")


def classify(hits: DataFrame, params: Params = STRICT, ids: list[str] | None = None, substrings: list[str] | None = None) -> DataFrame:
    """Quality hits with is_off_target and has_good_3prime_match."""
    h = tail_mismatches(quality_filter(hits, params), params)
    good = (F.col("qend") == F.col("qlen")) & (F.col("tail_covered") >= params.hit_tail_len) & (F.col("tail_mismatches") <= params.max_tail_mismatches)
    return h.withColumns({"is_off_target": ~is_target(ids, substrings), "has_good_3prime_match": good})


def single_specificity(primers: DataFrame, hits: DataFrame) -> DataFrame:
    """Hit counts and risk of every ACGT primer, with or without hits."""
    good = F.col("is_off_target") & F.col("has_good_3prime_match")
    by = hits.groupBy(F.col("query_id").alias("sequence")).agg(F.count("*").alias("significant_hits_count"), F.count_if("is_off_target").alias("off_target_hits_count"), F.count_if(good).alias("good_3prime_off_target_hits_count"))
    p = primers.withColumn("sequence", F.upper("sequence")).filter(F.col("sequence").rlike("^[ACGT]+$")).join(by, "sequence", "left")
    p = p.fillna(0, ["significant_hits_count", "off_target_hits_count", "good_3prime_off_target_hits_count"])
    return p.withColumn("off_target_risk_score", F.col("off_target_hits_count") + 5.0 * F.col("good_3prime_off_target_hits_count"))


SINGLE_ORDER = [("good_3prime_off_target_hits_count", False), ("off_target_hits_count", False), ("off_target_risk_score", False), ("ord", False)]


def sorted_single(single: DataFrame) -> DataFrame:
    """Primers by rising risk within each gene; equal ones in the order of `ord`."""
    return single.orderBy("gene", *order_by(SINGLE_ORDER))


def near_hits(hits: DataFrame, forward: DataFrame, reverse: DataFrame, params: Params = STRICT) -> DataFrame:
    """forward_seq, reverse_seq and good of the off-target hits on opposite strands that bound an amplicon.

    An interval join: hits lie in bins of a subject as wide as the longest amplicon, so two that bound one lie in the
    same bin or in neighbours. The work follows the hits and the amplicons found, not the squares of the hits in a
    subject, and a long subject is spread over its bins.
    """
    off = hits.filter("is_off_target").select(F.upper("query_id").alias("seq"), "subject_id", "sstrand", F.least("sstart", "send").alias("lo"), F.greatest("sstart", "send").alias("hi"), F.col("has_good_3prime_match").alias("good"))
    bin_ = F.expr(f"lo div {params.offtarget_max_amplicon}")
    side = lambda s, own: off.join(own.select(F.col(f"{s}_seq").alias("seq")).distinct(), "seq", "left_semi").select("subject_id", *(F.col(c).alias(f"{s}_{c}") for c in ("seq", "sstrand", "lo", "hi", "good")), bin_.alias("bin"))
    f = side("forward", forward)
    r = side("reverse", reverse).withColumn("bin", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)))
    span = F.greatest("forward_hi", "reverse_hi") - F.least("forward_lo", "reverse_lo") + 1
    met = f.join(r, ["subject_id", "bin"]).filter((F.col("forward_sstrand") != F.col("reverse_sstrand")) & span.between(params.offtarget_min_amplicon, params.offtarget_max_amplicon))
    return met.select("forward_seq", "reverse_seq", (F.col("forward_good") | F.col("reverse_good")).alias("good"))


def pair_specificity(pairs: DataFrame, hits: DataFrame, params: Params = STRICT) -> DataFrame:
    """forward_seq, reverse_seq, off-target amplicons and risk of every distinct pair of sequences."""
    keys = pairs.select(F.upper("forward_seq").alias("forward_seq"), F.upper("reverse_seq").alias("reverse_seq")).distinct()
    met = near_hits(hits, keys, keys, params)
    by = met.groupBy("forward_seq", "reverse_seq").agg(F.count("*").alias("potential_off_target_amplicons_count"), F.count_if("good").alias("good_3prime_off_target_amplicons_count"))
    out = keys.join(by, ["forward_seq", "reverse_seq"], "left").fillna(0)
    return out.withColumn("off_target_pair_risk_score", F.col("potential_off_target_amplicons_count") + 8.0 * F.col("good_3prime_off_target_amplicons_count"))


PAIR_RISK_ORDER = [("good_3prime_off_target_amplicons_count", False), ("potential_off_target_amplicons_count", False), ("off_target_pair_risk_score", False), ("forward_seq", False), ("reverse_seq", False)]


def sorted_pair_risk(risk: DataFrame) -> DataFrame:
    """Pairs by rising risk; equal ones by their sequences, since each pair of sequences is one row."""
    return risk.orderBy(*order_by(PAIR_RISK_ORDER))
