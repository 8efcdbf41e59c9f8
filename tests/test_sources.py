"""Sources and sinks, round trips and malformed input; streaming counts."""

import pytest

from helixmill.operators import profile
from helixmill.sources import fasta, tables
from helixmill.streaming import profile as streaming


def test_fasta(spark, tmp_path):
    (tmp_path / "x.fasta").write_text(">a first > one\r\nACG\r\nT\n>b\n\n>c\nGG\n")
    got = [(r.id, r.description, r.seq) for r in fasta.read_fasta(spark, str(tmp_path / "x.fasta")).orderBy("seq_idx").collect()]
    assert got == [("a", "a first > one", "ACGT"), ("b", "b", ""), ("c", "c", "GG")]
    fasta.write_fasta(fasta.read_fasta(spark, str(tmp_path / "x.fasta")), str(tmp_path / "out"))
    assert sorted(r.seq for r in fasta.read_fasta(spark, str(tmp_path / "out")).collect()) == ["", "ACGT", "GG"]


def test_alignment_check(spark):
    rows = lambda *s: spark.createDataFrame([("g", i, x) for i, x in enumerate(s)], "gene string, seq_idx long, aligned string")
    fasta.check_alignment(rows("AC", "A-"))
    for bad in (rows("AC", "A"), rows(""), rows("A").limit(0)):
        with pytest.raises(ValueError):
            fasta.check_alignment(bad)


def test_regions_json(spark, tmp_path):
    (tmp_path / "r.json").write_text('[{"start_col": 1, "end_col": 5, "mean_score": 0.5}]')
    assert [(r.start_col, r.end_col) for r in tables.read_regions_json(spark, str(tmp_path / "r.json")).collect()] == [(1, 5)]
    (tmp_path / "e.json").write_text("[]")
    with pytest.raises(ValueError):
        tables.read_regions_json(spark, str(tmp_path / "e.json"))
    (tmp_path / "bad.json").write_text('[{"start_col": "x"}]')
    with pytest.raises(Exception, match=r"(?i)malformed|region"):
        tables.read_regions_json(spark, str(tmp_path / "bad.json"))


def test_hits(spark, tmp_path):
    line = "q\ts\tPLUS\t99.5\t20\t0\t0\t1\t20\t5\t24\t0.1\t40.0\t20\tACGT\tACGT"
    (tmp_path / "h.tsv").write_text(f"{line}\n\n{line.rsplit(chr(9), 1)[0]}\n")
    got = tables.read_hits(spark, str(tmp_path / "h.tsv")).collect()
    assert len(got) == 1 and got[0].sstrand == "plus" and got[0].pident == 99.5
    (tmp_path / "bad.tsv").write_text(line.replace("99.5", "x"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.read_hits(spark, str(tmp_path / "bad.tsv")).collect()


def test_streaming_counts(spark, tmp_path):
    spark.createDataFrame([("g", 0, "AC-"), ("g", 1, "AG-")], "gene string, seq_idx long, aligned string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("gene string, seq_idx long, aligned string").parquet(str(tmp_path / "in"))
    q = streaming.start_counts(stream, "counts", str(tmp_path / "check"))
    q.processAllAvailable()
    q.stop()
    want = profile.column_profile(spark.read.parquet(str(tmp_path / "in")))
    assert streaming.profile_of(spark.table("counts")).exceptAll(want).count() == 0


def test_streaming_counts_in_files(spark, tmp_path):
    """Counts of rows that arrive in two batches, with a restart between."""
    schema, source, out = "gene string, seq_idx long, aligned string", str(tmp_path / "in"), str(tmp_path / "out")
    for i, rows in enumerate(([("g", 0, "AC-"), ("g", 1, "AG-")], [("g", 2, "TG"), ("h", 3, "A")])):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        q = streaming.start_counts_to(spark.readStream.schema(schema).parquet(source), out, str(tmp_path / "check"))
        q.processAllAvailable()
        q.stop()
    want = profile.column_counts(spark.read.parquet(source))
    got = streaming.counts_so_far(spark, out).select(want.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() == 4
