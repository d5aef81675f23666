"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Each document draws an exponential key scaled by its quality weight; keys order a source's documents. Whole epochs fill a
source's token budget first, the rest is the prefix of that order. Prefix sums go over key buckets first, so that
only the one bucket in which a source's budget ends is ever sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerframe.llm.common import WORD, cut, table

#: The weights that sources get in turn, in code point order.
WEIGHTS = (5, 2, 1)
#: Key buckets of a source; a bucket holds about 1/4096 of its rows.
BUCKETS = 4096


def quality_weights(labels: DataFrame, good: float = 2.0, bad: float = 0.5) -> DataFrame:
    """(doc_id, weight) of labelled documents: `good` for quality 1, `bad` for quality 0; the best of repeated labels counts."""
    best = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("q"))
    return best.select(F.col("doc_id").alias("label_id"), F.when(F.col("q") >= 1, good).otherwise(bad).alias("weight"))


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(skey, source_size, target) from sizes(skey, source, source_size): `share` of all sizes, dealt by weight.

    A source stops at `most` times its size; what is above is dealt again by weight until nothing is. In closed form:
    sources in order of capacity over weight fill up until the common level reaches none of the rest.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    df = sizes.withColumn("rank", rank).withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.expr(f"(rank - 1) % {len(weights)} + 1")).cast("double"))
    df = df.withColumn("cap", most * F.col("source_size"))
    by_fill = Window.orderBy(F.col("cap") / F.col("w"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_fill), F.lit(0.0))
    df = df.withColumn("level", left / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(by_fill), F.lit(0.0))))
    level = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "rank", "level"))).over(everything)["level"]
    return df.withColumn("level", level).select("skey", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"))


def unit_draw(id_col: Column, text: Column, seed: int) -> Column:
    """A number in (0, 1] that follows from the id, the text and the seed alone: rows without an id, or of one, draw apart."""
    own = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    digest = F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(f"#{seed}#"), own).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 1) / F.lit(float(1 << 52))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 10, share: float = 1.5, most: float = 2.0, buckets: int = BUCKETS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken, *keep): how many words of each document the mix takes.

    size counts the words of the whole text (null: 0). weights(label_id, weight) gives quality weights; documents without
    one have 1. A source's budget is its target rounded to words; complete epochs take every document whole, the rest goes
    to documents in key order, and the one in which the budget ends gives its first words only, so sums meet the target.
    A null source is a source like any other (last in order); rows without an id draw by their texts; equal rows are
    interchangeable; documents without words take 0; very long texts are counted whole; an empty table gives an empty result.
    Other columns are not read, whatever their names.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    source = F.col(source_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), source.alias("source"), size.alias("size"), F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source)).alias("skey"), unit_draw(F.col(id_col), F.col(text_col).cast("string"), seed).alias("u"), F.struct(*keep, F.lit(0).alias("__")).alias("kept"))
    if weights is None:
        rows = rows.withColumn("weight", F.lit(1.0))
    else:
        rows = rows.join(weights, rows.doc_id == weights.label_id, "left").drop("label_id").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    rows = rows.withColumn("key", -F.log("u") / F.col("weight")).drop("weight", "u")
    rows = cut(rows.withColumn("bucket", F.least(F.floor((1 - F.exp(-F.col("key"))) * buckets), F.lit(buckets - 1)).cast("int")))

    sums = rows.groupBy("skey", "bucket").agg(F.sum("size").alias("held"), F.first("source").alias("source"))
    sizes = sums.groupBy("skey").agg(F.first("source").alias("source"), F.sum("held").alias("source_size"))
    targets = source_targets(sizes, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("epochs", epochs).withColumn("budget", F.round("target").cast("long") - F.col("epochs") * F.col("source_size"))
    before = F.sum("held").over(Window.partitionBy("skey").orderBy("bucket")) - F.col("held")
    plan = sums.select("skey", "bucket", "held", before.alias("before")).join(targets, "skey")
    plan = plan.withColumn("ends", (F.col("before") < F.col("budget")) & (F.col("before") + F.col("held") > F.col("budget")))
    dealt = rows.join(plan, ["skey", "bucket"])
    part = lambda before: F.col("epochs") * F.col("size") + F.least("size", F.greatest(F.lit(0), F.col("budget") - before))
    whole = dealt.where(~F.col("ends")).withColumn("taken", F.when(F.col("before") < F.col("budget"), (F.col("epochs") + 1) * F.col("size")).otherwise(F.col("epochs") * F.col("size")))
    within = F.sum("size").over(Window.partitionBy("skey", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    ending = dealt.where("ends").withColumn("taken", part(F.col("before") + within))
    return whole.union(ending).select("doc_id", "size", "source", "source_size", "target", F.col("taken").cast("long"), *[F.col(f"kept.{c}").alias(c) for c in keep])


def op10(spark, sf_dir: str) -> DataFrame:
    """The contract's columns of mix_sources over all documents, with the labels' quality weights; odd rows as there."""
    return mix_sources(table(spark, sf_dir, "documents"), quality_weights(table(spark, sf_dir, "labels"))).drop("source")


OP10_SQL = r"""
WITH lab AS (SELECT doc_id, max(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
rows AS (
  SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '') || '#10#' || md5(coalesce(d.text, ''))), 1, 13))::BIGINT + 1) / 4503599627370496.0::DOUBLE)
      / (CASE WHEN q >= 1 THEN 2.0 WHEN q IS NOT NULL THEN 0.5 ELSE 1.0 END)::DOUBLE AS key
  FROM documents d LEFT JOIN lab USING (doc_id)),
src AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM rows GROUP BY source),
w AS (SELECT *, (CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM src),
lev AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER f, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER f, 0)) AS level
  FROM w WINDOW f AS (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tgt AS (SELECT source, source_size, least(cap, coalesce((SELECT level FROM lev WHERE level * w <= cap ORDER BY cap / w, rank LIMIT 1) * w, cap)) AS target FROM lev),
bud AS (SELECT *, CASE WHEN source_size > 0 THEN floor(round(target) / source_size) ELSE 0 END::BIGINT AS epochs FROM tgt),
ordered AS (SELECT r.doc_id, r.size, b.source_size, b.target, b.epochs, round(b.target)::BIGINT - b.epochs * b.source_size AS budget,
    sum(r.size) OVER (PARTITION BY r.source ORDER BY r.key, r.doc_id, r.size ROWS UNBOUNDED PRECEDING) - r.size AS before
  FROM rows r JOIN bud b ON r.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, (epochs * size + least(size, greatest(0, budget - before)))::BIGINT AS taken FROM ordered
"""
