"""Corpus pipeline: the stages from raw documents to tokens, each one operator of ``ledgerline.llm``.

Nulls and odd rows go through all stages: a null or empty text is scored like any other by the classifier, has no shingles (so
it is nobody's near copy), no windows, and no words, so the mix leaves it out.  Rows without id stay in
near-dedup; repeated rows of an id are one document there.  Texts of any length are
handled whole.  Only the columns of documents are read, whatever others there are.  An empty table
gives an empty result with the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import byte_bpe, common, fm_classifier, minhash_join, mixing, recompression

# Near copies: words a shingle, least similarity in percent.
SHINGLE, PERCENT = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, accepts (score >= 0.5)."""
    machine = fm_classifier.train(docs, common.read_table(spark, sf_dir, "labels"))
    scored = fm_classifier.score(docs, machine, common.DOCUMENT_COLUMNS)
    return scored.filter("score >= 0.5").select(*common.DOCUMENT_COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8), the one of the smallest id."""
    return minhash_join.one_of_each(docs, shingle=SHINGLE, percent=PERCENT)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-word windows that a smaller id has; text without any is left as it is."""
    cut = recompression.remove_repeats(docs, common.DOCUMENT_COLUMNS)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept")).otherwise(F.col("text"))
    n_chars = F.when(changed, F.char_length("kept").cast("long")).otherwise(F.col("n_chars"))
    return cut.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by target weights: a row for each copy taken."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids (little-endian unsigned 32-bit), and whether the ids decode to the text."""
    encoded = byte_bpe.encode(docs, *byte_bpe.public_vocabulary(), carry=common.DOCUMENT_COLUMNS, decoded=True)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return encoded.select(*common.DOCUMENT_COLUMNS, "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          same.alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources", mix),
    ("byte-level BPE", tokenize),
]
# The classifier is trained and the tokenizer's merges are iterative: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written as Parquet and read again by the next."""
    docs = common.read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.staged(docs, f"stage{k + 1}")
    return docs
