"""From raw documents to packed sequences: toxicity, language, repeated lines, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of ``docs``. A stage defines nulls, empty texts, ties and repeated rows as its operator does; an empty table stays
empty. SQL can express neither the classifiers nor the packing, so there is no SQL for the pipeline as a whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import jaccard, langid, linedup, packing, toxicity
from sluice.llm.common import discard, materialise, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 1
#: Bytes of the memo of chunks in a worker: executors still hold the memory of the stages before.
MEMO = 32 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits on the labelled rows and keeps the documents that score below one half."""
    return toxicity.keep(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that are near enough to a centroid of some language."""
    return langid.keep(docs, langid.fit(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of line runs; documents of which no line is left go. n_chars follows the text."""
    out = linedup.remove(docs).where((F.col("_n_removed") == 0) | (F.col("_n_removed") < F.col("_n_lines")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component of five-word Jaccard similarity 0.8 or more: that of least id, then text hash.

    Rows are told apart by id and text, so null and shared ids do no harm; rows that repeat both are one document.
    """
    return jaccard.keep_one(docs, n=5, percent=80)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document in the packed sequences."""
    return packing.pack(docs, TOKENIZER, END_ID, memo=MEMO)


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", drop_unknown_language),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
