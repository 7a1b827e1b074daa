"""Corpus pipeline over ``documents``: language ID, line dedup, near-dedup, packing.

Every stage reads what the one before has written.  All but the last return the columns of ``documents``;
``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoframe.llm import bagminhash, langid, line_chunks, packing
from chronoframe.plans.catalog import table
from chronoframe.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that the classifier rejects go; a missing language is filled in.

    Null texts and texts without a letter (empty ones too) are rejected; null ids and repeated rows stay, each judged by its own
    text; an empty table stays empty; columns beside those of documents go."""
    model = langid.fit(docs)
    seen = langid.predict(docs, model, carry=("text", "lang", "source", "n_chars")).where(~F.col("rejected"))
    return seen.select("doc_id", "text", F.coalesce("lang", "lang_pred").alias("lang"), "source", "n_chars")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: repeated chunks of lines go; a document of which nothing is left goes with them.

    Null texts (``n_chars`` null) and empty ones stay; each row of null id is a document of its own; rows that repeat an id count as
    one document; an empty table stays empty; columns beside those of documents go."""
    cut = line_chunks.dedup(docs, carry=("lang", "source"))
    cut = cut.where((F.col("n_removed") == 0) | (F.col("text") != ""))
    return cut.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each group of near-duplicates the row of the least id stays.

    Rows are numbered in the order of their ids and compared by that number, so rows that repeat an id are documents of
    their own: different texts of one id stay, equal ones are a group like others, and so are those of null ids (which
    come first).  Texts without words, null ones too, stay; an empty table stays empty; columns beside those of documents go."""
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").withColumn("_m", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("doc_id", "_m").sortWithinPartitions("doc_id", "_m").drop("_m")
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "pipeline-rows")
    gone = bagminhash.near_duplicates(rows, id_col="_row").where(~F.col("kept")).select("_row")
    return rows.join(gone, "_row", "left_anti").select("doc_id", "text", "lang", "source", "n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: pieces of windows of 4096 tokens, with their ids.

    A null or empty text is one token (the end id); each row is a document of its own, whatever its id; an empty table gives no
    pieces; other columns are not read."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("pack", pack)]

#: Tokenizer and classifier have no SQL form; tests compare run() with the stages in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another; each stage's documents are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
