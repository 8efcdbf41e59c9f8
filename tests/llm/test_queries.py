"""The registered queries and the pipeline, over small tables of their own."""

import collections
import random

import pytest

import corpus_pipeline
from helixmill.llm import queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    out = str(tmp_path_factory.mktemp("tables"))
    alphabets = {"aa": "abcde", "bb": "vwxyz"}
    text = lambda k, n: " ".join("".join(rng.choice(alphabets[k]) for _ in range(rng.randint(1, 6))) for _ in range(n))
    rows = [(i, text(k, rng.randint(30, 90)), k, "s", 0) for i, k in enumerate(list(alphabets) * 60)]
    rows += [(200, rows[3][1], "bb", "s", 0), (201, rows[4][1] + " tail", "aa", "s", 0), (202, "12 34", "aa", "s", 0), (203, None, None, None, None), (204, rows[6][1] + " password=abcdefgh99", "aa", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    return out, rows


def test_every_operator_is_registered():
    names = queries.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert set(queries.oracle_sql()) <= set(names)


def test_pipeline(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        kept.append({r.doc_id for r in docs.collect()})
    every = {r[0] for r in rows}
    assert kept[0] == every - {202, 203}
    assert kept[1] == kept[0] - {200}
    assert kept[2] == kept[1] - {201, 204} and kept[3] == kept[2]
    packed = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in packed} == kept[3]
    used = collections.Counter()
    for r in packed:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and len(used) == -(-sum(used.values()) // 2048)


ODD = "doc_id long, text string, lang string, source string, n_chars long, node string, block int, `key` double, `a.b` string, kept boolean, rank long"


@pytest.fixture(scope="module")
def odd(spark):
    """Rows without ids, ids that texts share, repeats, empty and very long texts, and columns with clashing names."""
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    one, two, three, long = text(80), text(90), text(70), text(20000)
    texts = [(None, one), (None, two), (7, one), (7, three), (7, three), (None, one + " "), (8, None), (None, None), (9, ""), (10, " \t"), (11, long), (12, long + " tail"), (13, "x"), (14, text(60) + " token=abcdefgh12")]
    rows = [(d, t, "aa", "s", len(t or ""), "n", 3, 1.5, "c", True, 4) for d, t in texts]
    return spark.createDataFrame(rows, ODD)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_an_empty_table(spark, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd.limit(0), "")
    assert out.count() == 0 and (name == "packing" or out.columns == odd.columns)


def texts(rows):
    return collections.Counter((r.doc_id, r.text) for r in rows)


def test_stages_on_odd_rows(spark, odd):
    stage = dict(corpus_pipeline.STAGES)
    given = texts(odd.collect())
    lettered = {k: n for k, n in given.items() if k[1] and any(map(str.isalpha, k[1]))}
    kept = stage["language_id"](spark, odd, "")
    assert texts(kept.collect()) == lettered and kept.schema == odd.schema
    exact = stage["exact_dedup"](spark, odd, "")
    rows, bare = exact.collect(), lambda t: "".join((t or "").split())
    assert exact.columns == odd.columns and all((r.node, r.block, r["key"], r["a.b"], r.kept, r.rank) == ("n", 3, 1.5, "c", True, 4) for r in rows)
    assert sorted(bare(r.text) for r in rows) == sorted({bare(t) for _, t in given})
    one = next(t for d, t in given if d is None and t and t.endswith(" "))
    assert (None, one) in texts(rows) and next(r for r in rows if bare(r.text) == "").doc_id == 10  # the longest of its text stays
    near = stage["near_dedup"](spark, odd, "")
    rows = near.collect()
    left = texts(rows)
    assert near.columns == odd.columns and set(left) <= set(given) and max(left.values()) == 1
    assert sum(not (t or "").strip() for _, t in left) == 4 and {d for d, t in left if t and bare(t) == bare(one)} == {7}
    assert {d for d, t in left if t and len(t) > 10000} == {11} and len(left) == 4 + 6
    safe = stage["secret_redaction"](spark, odd, "")
    want = collections.Counter({(d, t if d != 14 else t.replace("token=abcdefgh12", "[assign]")): n for (d, t), n in given.items()})
    assert texts(safe.collect()) == want and safe.columns == odd.columns
    packed = stage["packing"](spark, odd, "").collect()
    assert collections.Counter(r.doc_id for r in packed if r.piece == 0) == collections.Counter(d for (d, _), n in given.items() for _ in range(n))
    used = collections.Counter()
    for r in packed:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048
