"""Token transfers out of logs, in one pass over the log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerframe.functions.hexabi import abi_digits, hex_to_decimal_string, let, list_place, list_size, list_value, normalize_hex, topic_address, word_at

#: The event topics of the public token standards (the batch event by its first four bytes).
TRANSFER = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
SINGLE = "0xc3d58168c5ae7397731d063d5bbf3d657854427343f4c083240f7aacaa2d0f62"
BATCH = "0x4a39dc06"


def decode_token_transfers(logs: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Transfer rows of ERC-20, ERC-721 and ERC-1155 logs; other logs give none. A log without topics gives none.

    How many rows a log gives is counted first, the places of these rows are exploded, and each row takes its token and amount from the log's
    digits by its place, so no lists are made and all but wide numbers is generated code. A batch whose lists are empty or of different
    lengths gives none. transfer_index is the place in a batch, else NULL. Where columns are named and neither token_id nor amount is
    among them, these two are NULL and not converted; the rows are the same.
    """
    topics, digits, event, n = F.col("topics"), F.col("__digits"), F.col("__event"), F.size("topics")
    transfer, single, batch = (event == k for k in range(3))
    # Logs of other kinds have no rows to explode; a filter for them would compute all this again below it.
    first = F.col("__first")
    rows = logs.withColumn("__first", normalize_hex(F.get(topics, F.lit(0)))).withColumn("__event", F.when(first == TRANSFER, 0).when(first == SINGLE, 1).when(first.startswith(BATCH), 2))
    rows = rows.withColumn("__digits", F.when(event.isNotNull(), abi_digits(F.col("data"))))
    sized = lambda at: F.struct(*[at[k].alias(f"at{k}") for k in "01"], *[list_size(digits, at[k]).alias(f"n{k}") for k in "01"])
    # Only batches have lists; bound by a lambda, what looks for them stays out of the generated code that every log passes.
    rows = rows.withColumn("__lists", F.when(batch, let(F.struct(list_place(digits, 0).alias("0"), list_place(digits, 1).alias("1")), sized)))
    lists = F.col("__lists")
    rows = rows.withColumn("__count", F.when(event < 2, 1).when(lists["n0"] == lists["n1"], lists["n0"]))
    places = F.when(F.col("__count") > 0, F.sequence(F.lit(0), F.col("__count") - 1))
    value = lambda k: list_value(digits, lists[f"at{k}"], F.col("__place"))
    token = F.when(batch, value(0)).when(single, word_at(digits, 0)).when(n >= 4, F.get(topics, F.lit(3)))
    amount = F.when(batch, value(1)).when(single, word_at(digits, 1)).when(n == 3, word_at(digits, 0))
    kind = F.when(~transfer, "erc1155").when(n >= 4, "erc721").when(n == 3, "erc20").otherwise("unknown")
    shift = F.when(transfer, 1).otherwise(2)
    rows = rows.withColumn("__place", F.explode(places)).withColumns({"__kind": kind, "__token": token, "__amount": amount})
    valued = columns is None or bool({"token_id", "amount"} & set(columns))
    number = lambda c: hex_to_decimal_string(F.col(c)) if valued else F.lit(None).cast("string")
    one = F.when(F.col("__kind") == "erc721", "1").otherwise(number("__amount"))
    tx, index, place = F.col("transaction_hash"), F.col("log_index"), F.when(batch, F.col("__place").cast("long"))
    known = tx.isNotNull() & index.isNotNull()
    stamp = F.col("block_timestamp") if "block_timestamp" in logs.columns else F.lit(None).cast("long")
    return rows.select(
        *(["cursor"] if "cursor" in logs.columns else []), F.lit("token_transfer").alias("type"), F.col("__kind").alias("transfer_type"), F.when(known, F.concat_ws("_", F.lit("log"), tx, index)).alias("source_log_id"),
        F.col("address").alias("token_address"), topic_address(topics, shift).alias("from_address"), topic_address(topics, shift + 1).alias("to_address"), number("__token").alias("token_id"), one.alias("amount"), tx.alias("transaction_hash"),
        "transaction_index", "block_hash", "block_number", stamp.alias("block_timestamp"), index.alias("log_index"), place.alias("transfer_index"), F.when(known, F.concat_ws("_", F.lit("token_transfer"), tx, index, place)).alias("id"),
    )
