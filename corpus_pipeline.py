"""The corpus pipeline: stages over the ``documents`` table, each calling one operator of
``snapfeed.llm``.  A stage takes (spark, docs, sf_dir) and returns a DataFrame; the next stage
works on all rows that it kept.

1. language: documents without a letter, or without a language more probable than the others together, go;
2. line_dedup: lines that repeat an earlier one go, and documents that lose all their lines;
3. near_dedup: of each group of near-duplicates the document with the smallest id stays;
4. decontaminate: documents with a passage of a benchmark item go;
5. tokenise: two segmentations of each text, sampled without replacement, each decoded again and compared.

The first four return the columns of ``documents``; rows may have null ids, texts or other columns, and
every stage says what it does with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfeed.llm import decontaminate as decontamination
from snapfeed.llm import langid, lattice, lines, simhash
from snapfeed.llm.common import fresh_path, prepare, table
from snapfeed.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects ``und`` (null texts and texts without a letter) and posterior probabilities of 0.5 or less.  The model is learnt
    from the stage's own rows that are not held out; without any labelled row every document with a letter is kept."""
    own = docs.select(*COLUMNS)
    model = langid.fit(own.where(~langid.held_out(F.col("doc_id"))), most_per_language=5000)
    return langid.keep(own, model, above=0.5)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines (Jaccard similarity 0.8) and the documents of which nothing is left; a document that had no line
    before is kept.  ``n_chars`` becomes the new text's length."""
    found = lines.dedup(docs.select(*COLUMNS), least=0.8, counts=("_lines", "_kept"))
    return (found.where((F.col("_kept") > 0) | (F.col("_lines") == 0)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates (4-word shingles, 4 bits): the document with the smallest id of each group stays, null ids last."""
    return simhash.keep_row(docs.select(*COLUMNS), k=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a passage of 0.8 weighted similarity (five-word shingles) to a benchmark item."""
    return decontamination.keep(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark", "item_id", "text"), least=0.8)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, sample, ids, log_p, value, log_inclusion, decoded, round_trip) of up to two segmentations of each text; each is decoded
    again, and ``round_trip`` says whether that is the text."""
    return lattice.encode(docs, tokenizer_path("piece_bpe_32k.model"), k=2, verify=True).withColumnRenamed("key", "doc_id")


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("tokenise", tokenise),
]

#: Naive Bayes fits, fuzzy line groups, fingerprint components and lattice samples have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet to the shared folder and
    read again as the next stage's input."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
