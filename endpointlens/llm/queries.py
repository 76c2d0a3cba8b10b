"""The registered query of each operator: production parameters, whole tables, digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality, toxicity
from .common import fold_of, read
from .line_dedup import dedup_lines
from .mixing import mix
from .media import picture_copies
from .nearest import nearest
from .oracles import LINE_DEDUP, URL_FILTER, VECTOR_CODES
from .packing import pack
from .pictures import render
from .resampling import resample
from .sentence_pieces import decode, encode
from .simhash import near_duplicates
from .suffix_tree import score_texts
from .url_filter import filter_urls, url_host, url_path
from .vector_codes import compress, digest, with_label_errors

URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def judged(spark: SparkSession, sf_dir: str, judge, label: str, threshold: float) -> DataFrame:
    """Scores of all documents; only labels outside the held-out fifth are learned from, and only text is an input."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    known = read(spark, sf_dir, "labels").where(fold_of(F.col("doc_id"), 5) != 0)
    return judge(docs, known, label).select(
        "doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir, quality.judge, "quality", 0.3)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir, toxicity.judge, "toxic", 0.5)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), vocabulary()).drop("row")


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad): a page's path ends in the id of the document it shows; that document's quality label is its outcome."""
    number = F.regexp_extract(url_path(F.col("url")), r"/([0-9]{1,18})/?\z", 1)
    numbered = pages.select(url_host(F.col("url")).alias("host"), number.try_cast("long").alias("doc_id"))
    return numbered.join(labels.select("doc_id", "quality"), "doc_id").select("host", (1 - F.col("quality")).alias("bad"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = page_outcomes(pages, read(spark, sf_dir, "labels"))
    return filter_urls(pages, outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    decisions, _ = mix(read(spark, sf_dir, "documents"))
    return decisions.select("doc_id", "size", "source_size", "target", "taken")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_media_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return picture_copies(render(read(spark, sf_dir, "embeddings")))


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score_texts(docs, fold_of(F.col("doc_id"), 10) == 0)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary("piece_bpe_32k.model")
    coded = decode(encode(read(spark, sf_dir, "documents").select("doc_id", "text"), model).drop("text"), model)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(read(spark, sf_dir, "embeddings"))
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_line_dedup": op2_line_dedup,
    "op3_packing": op3_packing,
    "op4_url_filter": op4_url_filter,
    "op5_mixing": op5_mixing,
    "op6_nearest": op6_nearest,
    "op7_simhash": op7_simhash,
    "op8_toxicity": op8_toxicity,
    "op9_media_copies": op9_media_copies,
    "op10_language_model": op10_language_model,
    "op11_resampling": op11_resampling,
    "op12_sentence_pieces": op12_sentence_pieces,
    "op13_vector_codes": op13_vector_codes,
}

#: The others rest on hashes, models or a tokenizer that SQL has not; tests hold them against plain Python.
ORACLE_SQL: dict[str, str] = {"op2_line_dedup": LINE_DEDUP, "op4_url_filter": URL_FILTER, "op13_vector_codes": VECTOR_CODES}
