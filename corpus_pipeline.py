"""From raw documents to clean, tokenized ones.

Each stage of ``STAGES`` takes ``(spark, docs, sf_dir)`` and returns a table, which ``run`` writes as Parquet in the shared
folder and reads again as the next stage's ``docs``. The stages before the encoding keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkhoard.llm import decontamination, linededup, pieces, quality, shingles, simhash
from linkhoard.llm.base import read, tokenizer_file
from linkhoard.sources.tables import materialize

QUALITY = 0.3
SHINGLE_WORDS = 5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at least ``QUALITY``."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.filter_documents(docs, model, QUALITY)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that occurred before are taken out; documents without any other line go."""
    return linededup.deduplicate(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id.

    Fingerprints unite texts that are all but equal; of what they leave, documents that share 0.8 or more of their shingles count as copies, whatever
    the fingerprints say.
    """
    return shingles.drop_near_copies(simhash.drop_near_duplicates(docs, SHINGLE_WORDS), SHINGLE_WORDS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, their number, and the text as decoded from them."""
    encoded = pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"), decoded=True)
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_copies),
    ("benchmark decontamination", drop_benchmark),
    ("SentencePiece encoding and decoding", tokenize),
]

#: SQL cannot express the trained classifier; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
