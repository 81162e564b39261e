"""The corpus pipeline: raw documents to token ids, each stage one operator's decisions put into effect.

Every stage takes what its predecessor wrote and returns what is written next; all but the
last return the columns of documents. ``run`` writes each stage's rows as Parquet in the
folder that the cluster shares and rereads them, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh import scratch
from quillmesh.llm.bpe_chunks import encode
from quillmesh.llm.exact_dedup import without_duplicates
from quillmesh.llm.jaccard_join import Similarity, without_near_duplicates
from quillmesh.llm.mixing import mixed_documents
from quillmesh.llm.quality_rules import cleaned
from quillmesh.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and aren't depleted, without the lines above the limit of their host.

    Null and empty texts fail, repeated rows each get their verdict, equal texts stay equal, whole texts count however
    long; an empty table gives no rows. ``n_chars`` follows the text."""
    kept = cleaned(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id.

    A null text equals an empty one; of rows that repeat an id, one stays; an empty table gives no rows."""
    return without_duplicates(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates (five-word shingles, similarity 0.8 or more), the row with the smallest doc_id.

    Null and empty texts are near nothing and stay; shorter texts than a shingle are one shingle; of rows that repeat an
    id, one stays; whole texts count however long; an empty table gives no rows."""
    return without_near_duplicates(docs, Similarity())


def entropy_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: each document as often as it has copies.

    Null and empty texts have no copies; a null source is a source; repeated rows get equal copies; an empty table gives
    no rows."""
    return mixed_documents(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and the digest of the text that they decode to.

    Null and empty texts have no tokens; copies are each a row; whole texts are encoded however long; an empty table
    gives no rows."""
    encoded = encode(docs, tokenizer_path())
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", jaccard_join),
    ("entropy_mix", entropy_mix),
    ("bpe_encode", bpe_encode),
]

#: The dual of the mix, its hash cuts and the encoding are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, scratch.table(stage(spark, docs, sf_dir), f"stage-{name}")
        scratch.free(before)  # a written stage needs its predecessor no more
    return docs


QUERIES = {"pipeline": run}
