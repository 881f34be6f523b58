"""A corpus pipeline of five operators; counted as part of ``tideline.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet
to the shared folder and reads again for the next. All but the last return the columns
of documents: quality drops rejected documents, lines drops repeated lines (and documents of
nothing else), near keeps one document of each group, mix repeats or cuts documents to
the sources' budgets (a repeated document is a row for each time), pack gives the
packed pieces.

Every stage takes nulls in any column, empty and very long texts, repeated rows, empty tables and further columns of any
names. Null and empty texts are judged as good or not like any other, have no lines to drop, are near nothing, have no words for
the mix to take (so they end there), and would be packed as one end token. Rows alike in doc_id and text are judged alike,
are one document to the line stage, and are mixed and packed each for itself; near keeps rows of the doc_id that stays. A null
doc_id is near nothing. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import line_dedup, mixing, near_dup, packing, quality
from tideline.llm.common import materialise, release, written
from tideline.llm.queries import tokenizer

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule classifier predicts as good; null and empty texts are judged like any other."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))


def _recount(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Documents without lines that repeat, exactly or within two edits of a quarter of their length; of equal lines the first by doc_id stays."""
    return _recount(line_dedup.clean(docs))


def stage_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """One document of each group of near-duplicates, that of the smallest doc_id; those without words or doc_id stay."""
    return near_dup.keep_one(docs)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """The mix of sources: a row for each time that a document is taken; null is a source of its own, the last."""
    return _recount(mixing.apply_mix(docs))


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """The packed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", stage_quality),
    ("lines", stage_lines),
    ("near", stage_near),
    ("mix", stage_mix),
    ("pack", stage_pack),
]

#: SQL can't express the fitted classifier or the sketches; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir. What a stage has written is deleted once the next one's input is."""
    docs, earlier = spark.read.parquet(f"{sf_dir}/documents.parquet"), written()
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
        release(spark, docs, earlier)
    return STAGES[-1][1](spark, docs, sf_dir)
