"""Raw documents to token ids: the stages a training corpus goes through, each one operator of the library.

Every stage reads what the one before it has written, works on all of it, and returns the columns of
``documents``; the last returns the digests of the token ids.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from postlake.llm.bpe import TOKENIZER, encode_decode, tokenizer_path  # noqa: E402
from postlake.llm.common import crc_mod, table  # noqa: E402
from postlake.llm.decontaminate import decontaminate  # noqa: E402
from postlake.llm.line_dedup import dedup_lines  # noqa: E402
from postlake.llm.near_dup import keep_one  # noqa: E402
from postlake.llm.quality import fit_quality, score_quality  # noqa: E402
from postlake.packaging import ship  # noqa: E402
from postlake.plans.staging import stage  # noqa: E402


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half go."""
    ship(spark)
    forest = fit_quality(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    return score_quality(docs, forest).filter("predicted = 1").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in the first document that holds them; no document goes."""
    ship(spark)
    out = dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays; documents without words all stay."""
    ship(spark)
    return keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    ship(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).filter(~F.col("contaminated")).select(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the text decoded from them."""
    ship(spark)
    out = encode_decode(docs.select("doc_id", "text"), tokenizer_path(TOKENIZER), keep_ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: The classifier and the encoder have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None
