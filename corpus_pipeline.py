"""Documents to a training mix, in five stages; each works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import decontaminate, minhash, mixing, quality, secrets
from tablewright.llm.frames import table
from tablewright.session import configure, stage

#: No SQL: thresholds, forest and rates are learned.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs, table(configure(spark), sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 80 % of their runs of five words, the one with the smallest id stays."""
    configure(spark)
    return minhash.keep_first(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminate.keep_clean(docs, table(configure(spark), sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay."""
    configure(spark)
    return secrets.redacted(docs)


#: For pre-training: clean text; of toxic text as much as a model needs to know it when it meets it; of poor text a trace,
#: so that it is no surprise. What earlier stages have left of a domain may be less than that.
TARGETS = {"clean": 0.97, "poor": 0.01, "toxic": 0.02}


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents get a rate and a number of copies; those with none go."""
    return mixing.mixed(docs, table(configure(spark), sf_dir, "labels"), TARGETS)


STAGES = [
    ("quality rules", quality_rules),
    ("near copies", near_copies),
    ("decontamination", decontamination),
    ("secret scan", secret_scan),
    ("target mix", target_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
