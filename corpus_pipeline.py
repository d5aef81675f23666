"""A training corpus from raw documents: language, near duplicates, contamination, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes what a stage returns as Parquet in the shared
folder and reads it again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerframe.llm import decontaminate, language_id, mixing, sharding, simhash
from ledgerframe.llm.common import cut, fresh, table

#: Least calibrated probability of the predicted language for a document to stay.
LEAST_SCORE = 0.5
SHARDS = 16


def _whole(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with the whole row as one more column, which operators carry along whatever its columns are called, and that column's name."""
    row = fresh(docs, "row")
    return docs.withColumn(row, F.struct(*docs.columns)), row


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised; those without letters and those of doubtful language go.

    A null or empty text has no letters; very long texts are read whole; repeated rows are told alike; a missing id or lang is
    ordinary; an empty table stays empty.
    """
    whole, row = _whole(docs)
    told = language_id.predict(whole, language_id.learn(docs), keep=(row,))
    return told.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(f"{row}.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: that of the smallest id, and of several texts under it that of the smallest hash.

    Rows without an id come after all others; of equal rows one stays, any of them where only other columns differ; null and
    blank texts are one group; an empty table stays empty.
    """
    hashed, first_id, first_hash = fresh(docs, "hash"), fresh(docs, "first_id"), fresh(docs, "first_hash")
    keyed = docs.withColumn(hashed, F.xxhash64(F.coalesce("text", F.lit(""))))
    groups = simhash.simhash_groups(keyed, keep=(hashed,))
    first = groups.groupBy("class_fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias(first_id), F.col(hashed).alias(first_hash))).alias("f"))
    first = first.select(f"f.{first_id}", f"f.{first_hash}")
    once = keyed.dropDuplicates(["doc_id", hashed])
    return once.join(first, once["doc_id"].eqNullSafe(first[first_id]) & (once[hashed] == first[first_hash]), "left_semi").select(*docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents; null, blank, very long and repeated rows are judged as decontaminate says, an empty table stays empty."""
    whole, row = _whole(docs)
    judged = decontaminate.decontaminate(whole, table(spark, sf_dir, "benchmark"), keep=(row,))
    return judged.where(~F.col("contaminated")).select(f"{row}.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, to the nearest whole copy; those that it doesn't take go.

    Rows are told apart by a number of their own, so columns of any type and equal rows are ordinary; documents without words are
    never taken; very long texts are counted whole; a null id or source is ordinary; an empty table stays empty.
    """
    rid, own, copies_of, turn = (fresh(docs, x) for x in ("rid", "own", "copies", "turn"))
    numbered = cut(docs.withColumn(rid, F.monotonically_increasing_id()))
    mixed = mixing.mix_sources(numbered, mixing.quality_weights(table(spark, sf_dir, "labels")), keep=(rid,))
    copies = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    wanted = mixed.select(F.col(rid).alias(own), copies.alias(copies_of)).where(F.col(copies_of) > 0)
    both = numbered.join(wanted, F.col(rid) == F.col(own))
    return both.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(copies_of)))).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns with size, text_crc32, shard and slot, which take the place of columns of those names.

    Null ids and texts are ordinary, equal rows are interchangeable; an empty table stays empty.
    """
    whole, row = _whole(docs)
    out = sharding.shard_rows(whole, SHARDS, keep=(row,))
    own = [c for c in out.columns if c != row]
    return out.select(*own, *[F.col(row)[c].alias(c) for c in docs.columns if c not in own])


STAGES = [
    ("language_id", language),
    ("simhash_neardup", near_duplicates),
    ("decontamination", benchmark_free),
    ("mixing", mixture),
    ("sharding", shards),
]

#: SQL can't express the trained and hashed stages; tests judge each stage by brute force on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
