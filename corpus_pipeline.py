"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `documents`.
A stage works on all rows that its predecessor kept, and its decisions take effect on rows and texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from endpointlens.llm import quality
from endpointlens.llm.common import WORD, fold_of, forget, read, settled, written
from endpointlens.llm.line_dedup import dedup_lines
from endpointlens.llm.mixing import mix
from endpointlens.llm.packing import pack
from endpointlens.llm.queries import vocabulary
from endpointlens.llm.simhash import similar_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier doesn't reject (score of 0.3 or more)."""
    labels = read(spark, sf_dir, "labels").where(fold_of(F.col("doc_id"), 5) != 0)
    return quality.judge(docs, labels).where("score >= 0.3").select(COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document of smaller id holds; a text may become empty."""
    kept = dedup_lines(docs)
    return kept.withColumns({"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}).select(COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of texts that share 0.8 of their five-word shingles.

    Rows of null ids take part; of a group of them alone one stays. Equal texts are one group whatever their length.
    """
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    groups = similar_documents(rows, "_row")
    named = rows.select("_row", "doc_id").join(groups.withColumnRenamed("row", "_row"), "_row")
    first = named.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("m")).select("m._row")
    return rows.join(first, "_row", "left_semi").select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each pass in which the mix takes a document, in the order of the mix's slots.

    The last document of a source is cut behind the word at which its target ends; what is kept of a text keeps its
    line breaks. Rows are told apart by number, so repeated and null ids are documents of their own.
    """
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    _, pieces = mix(rows, row="_row")
    taken = pieces.groupBy("_row", "pass").agg(F.max("last").alias("_words"), F.max("size").alias("_size"), F.min("slot").alias("_slot"))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)), 1, F.col("_words").cast("int")), "")
    text = F.when(F.col("_words") < F.col("_size"), cut).otherwise(F.col("text"))
    # written before it is sorted, so that the shuffle files of the join are gone by then
    mixed = settled(rows.join(taken, "_row").withColumn("text", text), "mixed")
    forget(rows)
    return mixed.orderBy("_slot", "_row", "pass").withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences of 2048 tokens."""
    return pack(docs, vocabulary())


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", keep_one_of_near_copies),
    ("source mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The classifier, the fingerprints, the shuffle and the tokenizer have no SQL form; tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settled(docs, f"stage-{k}")
            if k:  # the first stage reads the given table
                forget(before)
    return docs
