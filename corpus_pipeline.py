"""From raw documents to shards of a training mix, in five stages.

Each stage gets what the one before kept, as a table with the columns of ``documents``, and its
decisions take effect: rejected documents are gone, one document of each near-duplicate group
stays, contaminated documents go, documents are repeated or left out by the mix, and the rows of
the mix are dealt into shards with gapless slots. Ids may be null or repeated, so the first stage
numbers the rows in the column ``ROW``, which the stages hand on; every decision is joined back on
it and holds for its own row only. Null and empty texts have no words, so the first stage drops them;
an empty table gives no rows; other columns are carried, whatever their names. ``ORACLE_SQL`` is None: a trained model, hashing
and rounding decide, which SQL does not express; tests hold the stages against plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abonara.llm import decontam, minhash, mixing, quality, shards
from abonara.llm.common import numbered, written
from abonara.llm.queries import table

ORACLE_SQL = None
#: No table of documents has a column of this name, so none is taken for a row number.
ROW = "_row_9f4c1e7ab2d84f60a3c5"


def _rows(docs: DataFrame) -> DataFrame:
    return docs if ROW in docs.columns else numbered(docs, ROW)


def _only(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose number is the doc_id of a row of ``rows``."""
    wanted = rows.select(F.col("doc_id").alias("wanted_row"))
    return docs.join(wanted, docs[ROW] == wanted["wanted_row"], "left_semi").select(docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that fail the fixed rules or the classifier."""
    docs = _rows(docs)
    return _only(docs, quality.quality(docs, table(spark, sf_dir, "labels"), row_col=ROW).where("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near-duplicates: of the smallest id (null last), then by a hash of the text."""
    docs = _rows(docs)
    group = minhash.near_duplicates(docs, id_col=ROW).select(F.col("doc_id").alias("member"), "component_id")
    ids = docs.select(ROW, "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", ROW)
    first = ids.join(group, F.col(ROW) == F.col("member")).groupBy("component_id").agg(F.min(place).alias("first"))
    return _only(docs, first.select(F.col(f"first.{ROW}").alias("doc_id")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents of which benchmark windows cover the threshold share."""
    docs = _rows(docs)
    return _only(docs, decontam.contamination(docs, table(spark, sf_dir, "benchmark"), id_col=ROW).where("not contaminated"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that each source's words meet its target."""
    return mixing.mixed(_rows(docs), row_col=ROW).drop(ROW)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal the rows of the mix into shards of near-equal bytes."""
    return shards.shards(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("benchmark decontamination", decontamination),
    ("source mix", source_mix),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = written(docs, f"pipeline_{place}")
    return docs
