"""The registered queries of the subpackage and the SQL of their rows, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, collocations, conversations, decontamination, linededup, mixing, pieces, quality, records, simhash, sitetree, toxicity, warc
from .base import held_out, read, tokenizer_file

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _scored(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return _scored(toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels"))), 0.5)


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), words=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitetree.extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return _scored(quality.score(docs, quality.train(docs, read(spark, sf_dir, "labels"))), 0.3)


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query
def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"))


@query
def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.digests(records.write(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json")))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.read(warc.normalise(warc.write(read(spark, sf_dir, "pages"))), with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.line_report(read(spark, sf_dir, "documents"))
    return found.withColumn("dropped", F.concat_ws(",", F.col("dropped").cast("array<string>")))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


@query
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(read(spark, sf_dir, "conversations")))


@query
def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
