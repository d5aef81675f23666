"""Joins that enrich entity rows, and the all-or-nothing rule of a cursor."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerframe.contracts import RECEIPT_FIELDS


def enrich_transactions(transactions: DataFrame, receipts: DataFrame) -> DataFrame:
    """transactions with receipt_* columns by hash, within a cursor where both sides have one; NULL where there is no receipt.

    Of several receipts of a hash the last in order of arrival counts: `arrival`, the place in the payload, or transaction_index
    where a table has no such column. A missing hash never matches. Receipts are joined by sorting, as blocks are in inject_block_context.
    """
    have = [c for c in RECEIPT_FIELDS if c in receipts.columns]
    order = "arrival" if "arrival" in receipts.columns else "transaction_index"
    by = ["cursor"] if "cursor" in transactions.columns and "cursor" in receipts.columns else []
    known = receipts.where("transaction_hash IS NOT NULL").withColumnRenamed("transaction_hash", "__hash")
    own = known.groupBy(*by, "__hash").agg(F.max_by(F.struct(*have), F.coalesce(order, F.lit(-1))).alias("__r"))
    rows = transactions.withColumn("__hash", F.col("hash"))
    joined = rows.join(own.hint("merge"), [*by, "__hash"], "left")
    return joined.select(*transactions.columns, *[F.col(f"__r.{c}").alias(f"receipt_{c}") for c in have])


def inject_block_context(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """rows whose block_hash and block_timestamp come from the block of their block_number; rows without such a block keep theirs.

    Of several blocks of one number that of the smallest hash counts, a null hash first. Blocks are joined by sorting whatever size
    Spark expects of them: of parsed JSON it expects far less than there is, and would send all blocks to the driver and every executor.
    """
    first = F.min(F.struct("hash", "timestamp"))
    own = blocks.where("number IS NOT NULL").groupBy(F.col("number").alias("__n")).agg(first.alias("__b")).select("__n", F.col("__b.hash").alias("__h"), F.col("__b.timestamp").alias("__t"))
    joined = rows.join(own.hint("merge"), rows["block_number"] == own["__n"], "left")
    keep = lambda c, kind: F.col(c) if c in rows.columns else F.lit(None).cast(kind)
    found = F.col("__n").isNotNull()
    return joined.withColumns({"block_hash": F.when(found, F.col("__h")).otherwise(keep("block_hash", "string")), "block_timestamp": F.when(found, F.col("__t")).otherwise(keep("block_timestamp", "bigint"))}).drop("__n", "__h", "__t")


def drop_failed_cursors(bundle: dict[str, DataFrame], errors: DataFrame | None) -> dict[str, DataFrame]:
    """The bundle without any row of a cursor that errors(cursor) lists; without errors nothing is joined."""
    if errors is None:
        return bundle
    failed = errors.select("cursor").distinct()
    return {k: df.join(failed, "cursor", "left_anti") for k, df in bundle.items()}
