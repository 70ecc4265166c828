"""Corpus pipeline: quality, line dedup, near duplicates, decontamination, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a table that is written and
read again as the next one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from varloom.llm import decontaminate, jaccard, line_dedup, packing, quality
from varloom.llm.common import kept_rows, shown_id, table
from varloom.operators.materialize import stored

#: The public vocabulary that packing counts in; its folder is a parameter of the machine.
TOKENIZER = "word_bpe_49k.json"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the importance sample towards good text; labels come from the labels table."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds; a document that loses all its lines goes."""
    return line_dedup.rewritten(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every component of near duplicates; of repeated rows one."""
    firsts = jaccard.join(docs).filter("_id = component").select("_id").distinct()
    return kept_rows(docs, firsts, ["_id"], distinct=True)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans of benchmark items; a document that is covered by more than half goes whole."""
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in token sequences."""
    import public_tokenizers

    packed = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return packed.select(shown_id().alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality", good_quality),
    ("lines", without_repeated_lines),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed_sequences),
]

#: Hashed generative models and subset-sum packing have no SQL form; tests compare operators, and the decontamination stage, with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
