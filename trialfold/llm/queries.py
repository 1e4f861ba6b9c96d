"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import trialfold
from trialfold.llm import dedup, lang, mix, pack, pii, prefix_trie, ring, secret_scan, simhash, toxicity, variants, warc, winnow
from trialfold.llm.common import table
from trialfold.llm.oracle import ORACLE  # noqa: F401
from trialfold.session import checkpoint_dir

SHARDS = 24


def prepare(spark: SparkSession) -> None:
    """Texts can be long: few rows go to a Python worker at once.  The
    package's functions travel with the tasks, wherever it is installed."""
    cloudpickle.register_pickle_by_value(trialfold)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(pack.RANKS)


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded loads with equal quotas: the law is ``rows``."""
    return (ring.shard(table(spark, sf_dir, "documents"), SHARDS)
            .withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.packed(table(spark, sf_dir, "documents"), tokenizer())


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang.identify(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4()}"
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.records(spark, path)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.compared(table(spark, sf_dir, "documents"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_mix, op2_pii, op3_shards, op4_simhash, op5_packing, op6_secrets, op7_exact_dedup,
                                   op8_language, op9_warc, op10_fingerprints, op11_variants, op12_prefix_trie, op13_toxicity)}
