"""One query per operator, over the whole of its table, and the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.llm import oracle
from nightledger.llm.conversations import repaired_after_damage
from nightledger.llm.exact_dedup import exact_dedup
from nightledger.llm.hyperminhash import near_duplicates
from nightledger.llm.kneser_ney import perplexity_filter
from nightledger.llm.line_runs import line_dedup
from nightledger.llm.mixing import TARGETS, label_domains, mix
from nightledger.llm.packing import best_fit_packing
from nightledger.llm.paragraphs import repeated_passages
from nightledger.llm.quality_rules import isolation_filter
from nightledger.llm.secret_scan import scan_secrets
from nightledger.llm.toxicity import toxicity_scores
from nightledger.llm.vector_codes import codebooks_digest, vector_codes, with_label_errors
from nightledger.llm.warc import pages_through_warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The byte-level BPE file of the installed tokenizer collection."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_warc_salvage(spark, sf_dir):
    return pages_through_warc(table(spark, sf_dir, "pages"))


def op2_isolation_forest(spark, sf_dir):
    found = isolation_filter(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *counts, "base_failed", "kept", "score")


def op3_soft_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), label_domains(table(spark, sf_dir, "labels")), TARGETS)


def op4_markov_secrets(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"))


def op5_block_max_knn(spark, sf_dir):
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_hyperminhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op7_paragraph_minhash(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents"))


def op8_kneser_ney(spark, sf_dir):
    return perplexity_filter(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_dedup(spark, sf_dir):
    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_best_fit_packing(spark, sf_dir):
    return best_fit_packing(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_drake_hamerly(spark, sf_dir):
    codes, books = vector_codes(table(spark, sf_dir, "embeddings"))
    found = with_label_errors(codes).withColumn("codebooks_sha256", F.lit(codebooks_digest(books)))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_edit_search(spark, sf_dir):
    return repaired_after_damage(table(spark, sf_dir, "conversations"))


def op13_line_runs(spark, sf_dir):
    found = line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_warc_salvage, op2_isolation_forest, op3_soft_mixing, op4_markov_secrets, op5_block_max_knn,
        op6_hyperminhash, op7_paragraph_minhash, op8_kneser_ney, op9_exact_dedup, op10_best_fit_packing,
        op11_drake_hamerly, op12_edit_search, op13_line_runs,
    )
}

ORACLE = {
    "op1_warc_salvage": oracle.WARC,
    "op6_hyperminhash": oracle.NEAR_DUPLICATES,
    "op9_exact_dedup": oracle.EXACT_DEDUP,
    "op11_drake_hamerly": oracle.VECTOR_CODES,
    "op12_edit_search": oracle.CONVERSATIONS,
    "op13_line_runs": oracle.LINE_DEDUP,
}
