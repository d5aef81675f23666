"""Deterministic ids, event times, envelopes and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _joined(*parts: Column | str) -> Column:
    """Parts joined by _, NULL where any is."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.concat(*[x for k, c in enumerate(cols) for x in ((F.lit("_"), c) if k else (c,))])


def event_id(df: DataFrame, entity: str) -> Column:
    """The id of a row of an entity; NULL where what it is made of is missing."""
    c = lambda name: F.col(name) if name in df.columns else F.lit(None).cast("string")
    return {
        "block": lambda: _joined("block", F.nullif(c("hash"), F.lit(""))),
        "transaction": lambda: F.coalesce(_joined("enriched_transaction", c("block_hash"), c("transaction_index")), _joined("transaction", F.nullif(c("hash"), F.lit("")))),
        "receipt": lambda: _joined("receipt", F.nullif(c("transaction_hash"), F.lit(""))),
        "log": lambda: _joined("log", c("transaction_hash"), c("log_index")),
        "token_transfer": lambda: F.coalesce(_joined("token_transfer", c("transaction_hash"), c("log_index"), c("transfer_index")), _joined("token_transfer", c("transaction_hash"), c("log_index"))),
        "trace": lambda: _joined("trace", F.nullif(c("trace_id"), F.lit(""))),
    }.get(entity, lambda: F.lit(None).cast("string"))()


def event_time(df: DataFrame, entity: str) -> tuple[Column, Column]:
    """(epoch milliseconds, RFC 3339 text in UTC) of a row: a block's timestamp, else its block_timestamp."""
    name = "timestamp" if entity == "block" else "block_timestamp"
    seconds = F.col(name).cast("bigint") if name in df.columns else F.lit(None).cast("bigint")
    days = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))
    rest = F.pmod(seconds, F.lit(86400))
    clock = F.concat_ws(":", *[F.lpad(x.cast("int").cast("string"), 2, "0") for x in (F.floor(rest / 3600), F.floor(rest / 60) % 60, rest % 60)])
    return seconds * 1000, F.when(seconds.isNotNull(), F.concat(days.cast("string"), F.lit("T"), clock, F.lit("Z")))


def with_envelope(df: DataFrame, entity: str, ingest_ms: int) -> DataFrame:
    """df with id (its own, else the event's, else dlq-{cursor}-{n}), ingest_timestamp, event_timestamp_ms, and the message key in `key`.

    The key is kafka_partition_key where there is one (that column goes), else the id.
    """
    cursor = F.coalesce(F.col("cursor").cast("string"), F.lit("unknown")) if "cursor" in df.columns else F.lit("unknown")
    given = [F.col("id")] if "id" in df.columns else []
    made = F.concat(F.lit("dlq-"), cursor, F.lit("-"), F.monotonically_increasing_id().cast("string"))
    out = df.withColumns({"id": F.coalesce(*given, event_id(df, entity), made), "ingest_timestamp": F.coalesce(F.col("ingest_timestamp"), F.lit(ingest_ms)).cast("bigint") if "ingest_timestamp" in df.columns else F.lit(ingest_ms).cast("bigint"), "event_timestamp_ms": event_time(df, entity)[0]})
    key = F.coalesce(F.col("kafka_partition_key"), F.col("id")) if "kafka_partition_key" in df.columns else F.col("id")
    return out.withColumn("key", key).drop("kafka_partition_key")


def normalize_name(c: Column) -> Column:
    """Lower-cased, runs of anything but letters and digits as one _, none at the ends; blank is `unknown`."""
    clean = F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(clean, "^_+|_+$", ""), F.lit("")), F.lit("unknown"))


def cursor_name(c: Column) -> Column:
    """A cursor for a pipeline's name: digits and chainhead or checkpoint as they are, latest as chainhead, blank as unknown."""
    text = F.lower(F.trim(c.cast("string")))
    return F.when(text.isNull() | (text == ""), "unknown").when(text == "latest", "chainhead").when(text.isin("chainhead", "checkpoint") | text.rlike("^[0-9]+$"), text).otherwise(normalize_name(text))


def pipeline_name(chain: Column, network: Column, mode: Column, start: Column, end: Column) -> Column:
    """{chain}_{network}_{mode}_{start}, and _{end} for a backfill."""
    base = F.concat_ws("_", normalize_name(chain), normalize_name(network), normalize_name(mode), cursor_name(start))
    return F.when(normalize_name(mode) == "backfill", F.concat_ws("_", base, cursor_name(end))).otherwise(base)


def identity_key(pipeline: Column, chain: Column, chain_type: Column, network: Column, mode: Column, entities: Column, cursor: Column | None = None) -> Column:
    """pipeline=…|chain=…|network=…|mode=…|unit=…|entities=…, and |cursor=… for one cursor; the unit is checkpoint for sui, else block."""
    unit = F.when(chain_type == "sui", "checkpoint").otherwise("block")
    parts = [("pipeline", pipeline), ("chain", chain), ("network", network), ("mode", mode), ("unit", unit), ("entities", F.array_join(F.array_sort(entities), ","))]
    parts += [("cursor", cursor)] if cursor is not None else []
    return F.concat_ws("|", *[F.concat(F.lit(f"{k}="), c.cast("string")) for k, c in parts])
