"""From documents to packed training sequences, in five stages, each by one operator.

A stage reads what the one before has written. All but the last return the columns of
`documents`, for the rows that stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.llm.common import kept_rows, saved
from nightledger.llm.exact_dedup import exact_dedup, normal_text
from nightledger.llm.hyperminhash import near_duplicates
from nightledger.llm.kneser_ney import perplexity_filter
from nightledger.llm.mixing import TARGETS, label_domains, mix
from nightledger.llm.packing import best_fit_packing
from nightledger.llm.queries import table, tokenizer_path

#: The main domain's expected copies in the mix: a little over one, so that its typical documents all stay.
REPEAT = 1.05
#: Jaccard similarity from which on documents are near duplicates here: part of whole.
NEAR = 80, 100


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the language model finds too perplexing for their language."""
    return kept_rows(docs, perplexity_filter(docs, table(spark, sf_dir, "labels")).filter("kept"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    kept = exact_dedup(docs).filter("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha256"))
    marked = docs.withColumn("__digest", F.sha2(normal_text(), 256))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__sha256"))
    # Rows that repeat the doc_id and the text of the one that stays would all match.
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", "__digest"]).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; documents without an id are in none."""
    return kept_rows(docs, near_duplicates(docs, *NEAR).filter("kept or kept is null"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which the mix takes a copy, once each: there is nothing to gain from repeats here."""
    found = mix(docs, label_domains(table(spark, sf_dir, "labels")), TARGETS, REPEAT)
    return kept_rows(docs, found.filter("copies > 0"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, placed in sequences."""
    return best_fit_packing(docs, tokenizer_path())


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mixed), ("pack", packed)]

#: SQL cannot express a language model, a fitted mix or a tokenizer; stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
