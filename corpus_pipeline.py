"""From raw documents to packed token sequences: five stages, each an operator of ``linkframe.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's ``docs``.
All but the last keep the columns of ``docs`` as they are, whatever their names. Nulls, empty texts, repeated rows and empty
tables are handled as the operators say: a null text counts as empty, and an empty text fails the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkframe.llm import decontamination, jaccard_join, labels, nbsvm, packing, robust_rules
from linkframe.llm.storage import materialize

TOKENIZER = "word_bpe_49k.json"


def _wrapped(docs: DataFrame, *names: str) -> DataFrame:
    """All of a row in ``doc_``, beside the columns that an operator reads, so that none it adds can clash."""
    return docs.select(F.struct(*(F.col(c).alias(c) for c in docs.columns)).alias("doc_"), *names)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside their language and source's robust estimate go."""
    rules = robust_rules.RobustRules()
    # Counted once: the estimates read the counts alone, the verdict the documents beside them.
    described = materialize(robust_rules.describe(_wrapped(docs, "text", "lang", "source")).drop("text"), "described")
    return rules.judge(described, rules.fit(described.drop("doc_"))).where("kept").select("doc_.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3 go. The model is learnt from the training fold of all labelled documents."""
    method = nbsvm.NbSvm()
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    model = method.fit(labels.training_sample(read("documents"), read("labels"), "quality", method.most_labelled))
    return _wrapped(docs, "text").where(nbsvm.score(spark, model, F.col("text")) >= 0.3).select("doc_.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a similarity of 0.8 or more the one with the smallest id stays."""
    return jaccard_join.one_of_each(docs, materialize(jaccard_join.ChosenPath().join(docs), "joined"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    flagged = decontamination.contaminated(_wrapped(docs, "text"), benchmark, decontamination.Tiling())
    return flagged.where(~F.col("contaminated")).select("doc_.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, with their token ids (little-endian, 32 bits), and their places in sequences of 4096 tokens."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path(TOKENIZER), keep_ids=True)).withColumnRenamed("row", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: The robust estimates, the trained model and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
