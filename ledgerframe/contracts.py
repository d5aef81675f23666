"""Sink and system contracts: ordered fields of scalar types, as StructTypes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

STRING, LONG, BOOLEAN = T.StringType(), T.LongType(), T.BooleanType()
STRINGS, LONGS = T.ArrayType(STRING), T.ArrayType(LONG)


def _contract(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


#: The fields of each contract, in order.
BLOCK = _contract(
    ("type", STRING),
    ("number", LONG),
    ("hash", STRING),
    ("parent_hash", STRING),
    ("nonce", LONG),
    ("sha3_uncles", STRING),
    ("logs_bloom", STRING),
    ("transactions_root", STRING),
    ("state_root", STRING),
    ("receipts_root", STRING),
    ("miner", STRING),
    ("difficulty", STRING),
    ("total_difficulty", STRING),
    ("size", LONG),
    ("extra_data", STRING),
    ("gas_limit", LONG),
    ("gas_used", LONG),
    ("timestamp", LONG),
    ("transaction_count", LONG),
    ("base_fee_per_gas", STRING),
    ("withdrawals_root", STRING),
    ("withdrawals", STRING),
    ("blob_gas_used", LONG),
    ("excess_blob_gas", LONG),
    ("id", STRING),
    ("ingest_timestamp", LONG),
)
TRANSACTION = _contract(
    ("type", STRING),
    ("hash", STRING),
    ("block_hash", STRING),
    ("transaction_index", LONG),
    ("from_address", STRING),
    ("to_address", STRING),
    ("nonce", LONG),
    ("block_number", LONG),
    ("block_timestamp", LONG),
    ("value", STRING),
    ("gas", LONG),
    ("gas_price", STRING),
    ("max_fee_per_gas", STRING),
    ("max_priority_fee_per_gas", STRING),
    ("max_fee_per_blob_gas", STRING),
    ("transaction_type", LONG),
    ("chain_id", LONG),
    ("v", LONG),
    ("r", STRING),
    ("s", STRING),
    ("input", STRING),
    ("blob_versioned_hashes", STRINGS),
    ("receipt_cumulative_gas_used", LONG),
    ("receipt_gas_used", LONG),
    ("receipt_contract_address", STRING),
    ("receipt_status", LONG),
    ("receipt_effective_gas_price", STRING),
    ("receipt_transaction_type", LONG),
    ("receipt_l1_fee", STRING),
    ("receipt_l1_gas_used", LONG),
    ("receipt_l1_gas_price", STRING),
    ("receipt_l1_fee_scalar", STRING),
    ("receipt_blob_gas_price", STRING),
    ("receipt_blob_gas_used", LONG),
    ("id", STRING),
    ("ingest_timestamp", LONG),
)
LOG = _contract(
    ("type", STRING),
    ("log_index", LONG),
    ("transaction_hash", STRING),
    ("transaction_index", LONG),
    ("block_hash", STRING),
    ("block_number", LONG),
    ("block_timestamp", LONG),
    ("address", STRING),
    ("data", STRING),
    ("topics", STRINGS),
    ("removed", BOOLEAN),
    ("id", STRING),
    ("ingest_timestamp", LONG),
)
TOKEN_TRANSFER = _contract(
    ("type", STRING),
    ("transfer_type", STRING),
    ("source_log_id", STRING),
    ("token_address", STRING),
    ("from_address", STRING),
    ("to_address", STRING),
    ("token_id", STRING),
    ("amount", STRING),
    ("transaction_hash", STRING),
    ("transaction_index", LONG),
    ("block_hash", STRING),
    ("block_number", LONG),
    ("block_timestamp", LONG),
    ("log_index", LONG),
    ("transfer_index", LONG),
    ("id", STRING),
    ("ingest_timestamp", LONG),
)
TRACE = _contract(
    ("type", STRING),
    ("block_number", LONG),
    ("block_hash", STRING),
    ("block_timestamp", LONG),
    ("transaction_hash", STRING),
    ("trace_id", STRING),
    ("parent_trace_id", STRING),
    ("trace_index", LONG),
    ("from_address", STRING),
    ("to_address", STRING),
    ("value", STRING),
    ("input", STRING),
    ("output", STRING),
    ("call_type", STRING),
    ("trace_type", STRING),
    ("status", STRING),
    ("error", STRING),
    ("gas", LONG),
    ("gas_used", LONG),
    ("depth", LONG),
    ("subtraces", LONG),
    ("reward_type", STRING),
    ("trace_address", LONGS),
    ("trace_source", STRING),
    ("trace_method", STRING),
    ("id", STRING),
    ("ingest_timestamp", LONG),
)
DEAD_LETTER = _contract(
    ("chain", STRING),
    ("network", STRING),
    ("pipeline", STRING),
    ("entity", STRING),
    ("cursor", LONG),
    ("stage", STRING),
    ("error_type", STRING),
    ("error_message", STRING),
    ("payload", STRING),
    ("context", STRING),
    ("retry_count", LONG),
    ("max_retry", LONG),
    ("status", STRING),
    ("first_seen_at", LONG),
    ("last_attempt_at", LONG),
    ("next_retry_at", LONG),
    ("id", STRING),
    ("ingest_timestamp", LONG),
)
CHECKPOINT = _contract(
    ("cursor", LONG),
    ("status", STRING),
    ("updated_at_ms", LONG),
    ("pipeline", STRING),
    ("chain_uid", STRING),
    ("chain_type", STRING),
    ("network", STRING),
    ("mode", STRING),
    ("primary_unit", STRING),
    ("entities", STRINGS),
    ("error", STRING),
    ("id", STRING),
    ("ingest_timestamp", LONG),
)
WATERMARK_STATE = CHECKPOINT
CONTRACTS = {"block": BLOCK, "transaction": TRANSACTION, "log": LOG, "token_transfer": TOKEN_TRANSFER, "trace": TRACE}
#: What a reader of the messages finds where nothing was set.
_UNSET = {T.StringType: "", T.LongType: 0, T.BooleanType: False}


def _cast(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.ArrayType):
        if isinstance(have, T.ArrayType):
            return F.transform(c, lambda x: x.try_cast(want.elementType))
        return F.when(c.isNotNull(), F.array(c.try_cast(want.elementType)))
    if isinstance(have, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    return c.try_cast(want)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """df cast to a contract, in its column order: scalars by value (NULL where they don't fit), a scalar for a repeated field
    as a one-element array, nested values for a string field as compact JSON, absent columns NULL."""
    have = {f.name: f.dataType for f in df.schema}
    return df.select(*[(_cast(F.col(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in contract])


def proto3_defaults(df: DataFrame) -> DataFrame:
    """df as a reader of the messages sees it: NULL scalars are '', 0 or false, NULL arrays are empty."""
    fill = lambda f: F.coalesce(f.name, F.array().cast(f.dataType) if isinstance(f.dataType, T.ArrayType) else F.lit(_UNSET[type(f.dataType)]))
    return df.select(*[fill(f).alias(f.name) for f in df.schema])


def from_proto3(df: DataFrame, nulls: tuple[str, ...] = ("error", "next_retry_at"), json: tuple[str, ...] = ()) -> DataFrame:
    """Undoes proto3_defaults where unset has a meaning: '' and 0 become NULL in `nulls`; text of `json` columns that is no JSON is wrapped as {"raw": text}."""
    types = dict(df.dtypes)
    out = df.withColumns({c: F.nullif(F.col(c), F.lit("" if types[c] == "string" else 0)) for c in nulls if c in types})
    wrap = lambda c: F.when((F.col(c) == "") | F.col(c).isNull(), "{}").when(F.try_parse_json(c).isNotNull(), F.col(c)).otherwise(F.to_json(F.struct(F.col(c).alias("raw"))))
    return out.withColumns({c: wrap(c) for c in json if c in types})


#: The receipt fields that a transaction gains, each as receipt_{name}.
RECEIPT_FIELDS = (
    "cumulative_gas_used", "gas_used", "contract_address", "status", "effective_gas_price", "transaction_type", "l1_fee", "l1_gas_used", "l1_gas_price", "l1_fee_scalar", "blob_gas_price", "blob_gas_used",
)
