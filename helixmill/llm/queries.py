"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op1_wavelet, op2_bpe, op3_chains, op4_urls, op5_packing, op6_language, op7_exact, op8_secrets, op9_minhash, op10_topk, op11_merkle, op12_runs, op13_mixing
from .common import documents, shared_dir

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_wavelet_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "op1-shards")
    op1_wavelet.write_shards(documents(spark, sf_dir), out, tokenizer_path(), end_id=1)
    return op1_wavelet.read_documents(spark, out)


def op2_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_bpe.encode_decode(documents(spark, sf_dir), tokenizer_path())


def op3_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_chains.passages(documents(spark, sf_dir))


def op4_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([(r, v) for v, r in op4_urls.RULES], "rule string, verdict string")
    return op4_urls.judge(documents(spark, sf_dir, "pages"), rules)


def op5_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_packing.best_fit(documents(spark, sf_dir), tokenizer_path(), end_id=0, capacity=2048)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return op6_language.identify(docs, op6_language.fit(docs))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_exact.dedup(documents(spark, sf_dir), null_ids=True)


def op8_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_secrets.scan(documents(spark, sf_dir))


def op9_near_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_minhash.classes(documents(spark, sf_dir), plain=True, share=None)


def op10_top_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_topk.top_k(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_merkle.manifest(documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_runs.runs(documents(spark, sf_dir), plant=True)


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_mixing.mix(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_wavelet_ids, op2_bpe_roundtrip, op3_fuzzy_passages, op4_url_verdicts, op5_best_fit, op6_language_id, op7_exact_dedup, op8_secret_spans, op9_near_classes, op10_top_scores, op11_merkle_manifest, op12_periodic_runs, op13_source_mix)}


def oracle_sql() -> dict[str, str]:
    return {"op4_url_verdicts": op4_urls.SQL, "op7_exact_dedup": op7_exact.SQL, "op8_secret_spans": op8_secrets.SQL, "op10_top_scores": op10_topk.SQL, "op11_merkle_manifest": op11_merkle.SQL, "op13_source_mix": op13_mixing.SQL}
