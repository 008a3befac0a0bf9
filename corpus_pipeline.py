"""A training corpus in five stages: quality, near duplicates, decontamination, mixing, token files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake import session
from seawake.llm import decontaminate, jaccard_join, mixture, quality, token_files
from seawake.llm.common import prepare, table, written
from seawake.llm.registry import MIX, WORD_TOKENIZER, tokenizer

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    prepare(spark)
    return quality.kept(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group; of its rows, if it is repeated, the one with
    the smallest text that is not null. Rows without a doc_id belong to no group and stay."""
    prepare(spark)
    groups = jaccard_join.jaccard_groups(docs)
    first = groups.filter("doc_id = component_id").select("doc_id").distinct()
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    row = F.struct(F.col("text").isNull().alias("none"), "text", *rest)
    kept = docs.select(*COLUMNS).join(first, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(row).alias("row"))
    return kept.select("doc_id", *[f"row.{c}" for c in COLUMNS[1:]]).unionByName(docs.select(*COLUMNS).filter("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window. Each row counts by its own text, also where a doc_id is null or repeated."""
    prepare(spark)
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token prefixes of the seeded epochs, by the tree's weights; the last document of a leaf is cut."""
    prepare(spark)
    return mixture.mixed_documents(docs.select(*COLUMNS), MIX).select(*COLUMNS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, read back: a row for each document."""
    prepare(spark)
    folder = session.shared_dir(spark, "corpus_tokens")
    token_files.write_token_files(docs, folder, tokenizer(WORD_TOKENIZER))
    return token_files.read_token_files(spark, folder)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: Hash ratios, connected components and token ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
