"""Response envelopes, RPC error classes, and failures captured as dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerframe.operators.parse import block_payloads, receipt_payloads

_DETAILS = "struct<networkId:string,projectId:string,upstreams:bigint,durationMs:bigint,retries:bigint,attempts:bigint,hedges:bigint,blockNumber:bigint,latestBlock:bigint,finalizedBlock:bigint>"
_CAUSE = f"struct<code:string,details:{_DETAILS},cause:struct<code:string,details:{_DETAILS}>>"
_ERROR = f"struct<code:bigint,message:string,data:struct<code:string,details:{_DETAILS},cause:array<{_CAUSE}>>>"
#: How a provider says that it has no such block yet, in its message or in a cause's code.
NOT_READY, UNAVAILABLE = "upstream does not have the requested block yet", "ErrUpstreamBlockUnavailable"
DEFAULT_MESSAGE = "json-rpc request failed"
#: Details that are told under another name.
_RENAMED = {"networkId": "network_id", "projectId": "project_id", "upstreams": "upstreams_total", "durationMs": "duration_ms", "retries": "retries", "attempts": "attempts", "hedges": "hedges"}


def split_response(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(results, errors) of raw(cursor, method, response): JSON-RPC envelopes apart.

    An error may be an object or a scalar, whose text is then the message; data is {} and the message a default one where
    they are missing.
    """
    rows = raw.withColumn("e", F.from_json("response", "struct<result:string,error:string>"))
    error = F.col("e.error")
    body = F.when(error.startswith("{"), F.from_json(error, "struct<code:bigint,message:string,data:string>"))
    ok = rows.where(error.isNull() | (error == "null")).select("cursor", "method", F.col("e.result").alias("result"))
    bad = rows.where(error.isNotNull() & (error != "null")).withColumn("b", body)
    message = F.coalesce(F.col("b.message"), F.when(~F.col("e.error").startswith("{"), F.col("e.error")), F.lit(DEFAULT_MESSAGE))
    return ok, bad.select("cursor", "method", F.col("b.code").alias("code"), message.alias("message"), F.coalesce("b.data", F.lit("{}")).alias("data"), F.col("e.error").alias("error"))


def classify_rpc_error(errors: DataFrame) -> DataFrame:
    """errors(cursor, method, error) with not_ready, summary, the details, and the range of blocks that the upstreams have."""
    e = errors.withColumn("e", F.from_json("error", _ERROR))
    causes = F.coalesce("e.data.cause", F.array().cast(f"array<{_CAUSE}>"))
    at_fault = F.filter(
        F.transform(causes, lambda c: F.when(c["code"] == UNAVAILABLE, F.struct(c["code"].alias("code"), c["details"].alias("details"))).when(c["cause"]["code"] == UNAVAILABLE, F.struct(c["cause"]["code"].alias("code"), c["cause"]["details"].alias("details")))),
        lambda c: c.isNotNull(),
    )
    e = e.withColumn("at_fault", at_fault)
    not_ready = F.coalesce(F.lower("e.message").contains(NOT_READY), F.lit(False)) | (F.size("at_fault") > 0)
    has = lambda name: F.filter(F.transform("at_fault", lambda c: c["details"][name]), lambda x: x.isNotNull())
    bound = lambda f, name: F.when(F.size(has(name)) > 0, f(has(name)))
    told = F.concat_ws(", ", F.concat(F.lit("method="), F.col("method")), F.concat(F.lit("code="), F.col("e.code")), F.concat(F.lit("message="), F.col("e.message")), F.concat(F.lit("cursor="), F.col("cursor")))
    return e.select(
        *errors.columns, F.col("e.code").alias("rpc_error_code"), F.col("e.message").alias("rpc_error_message"), not_ready.alias("not_ready"), F.concat(F.lit("rpc_response_error("), told, F.lit(")")).alias("summary"),
        *[F.col(f"e.data.details.{k}").alias(n) for k, n in _RENAMED.items()], F.when(F.size("at_fault") > 0, F.size("at_fault")).alias("not_ready_upstreams"),
        bound(F.array_min, "latestBlock").alias("min_latest_cursor"), bound(F.array_max, "latestBlock").alias("max_latest_cursor"),
        bound(F.array_min, "finalizedBlock").alias("min_finalized_cursor"), bound(F.array_max, "finalizedBlock").alias("max_finalized_cursor"),
    )


#: The order in which a cursor's entities are fetched; the first that fails stands for it.
ENTITY_ORDER = ("block", "transaction", "receipt", "log", "trace")


def parse_failures(raw: DataFrame, entity: str) -> DataFrame:
    """(cursor, entity, error_message) of payloads of the wrong shape or without a required key (one whose value is null is there)."""
    if entity in ("block", "transaction"):
        return failures_of(block_payloads(raw, whole=False, columns=()), {"block": entity})
    if entity in ("receipt", "log"):
        return failures_of(receipt_payloads(raw, ("logs",)), {entity: entity})
    shape = F.coalesce(F.ltrim("result").startswith("["), F.lit(False)) & F.from_json("result", "array<struct<a:string>>").isNotNull()
    return raw.where(~shape).select("cursor", F.lit(entity).alias("entity"), F.lit("wrong shape").alias("error_message"))


def failures_of(payloads: DataFrame, entities: dict[str, str]) -> DataFrame:
    """(cursor, entity, error_message) of parsed payloads: of each why_ column named, the rows that have a reason, under the entity given."""
    reasons = F.array(*[F.struct(F.lit(entity).alias("entity"), F.col(f"why_{own}").alias("error_message")) for own, entity in entities.items()])
    return payloads.select("cursor", F.inline(reasons)).where("error_message IS NOT NULL")


def capture_failures(rpc_errors: DataFrame, parse_errors: DataFrame | None = None) -> DataFrame:
    """(cursor, entity, stage, error_type, error_message, context) of failures.

    rpc_errors(cursor, entity, method, error): the first entity of a cursor that failed, in entity order, stands for the
    cursor at stage rpc. parse_errors(cursor, entity, error_message) all count, at stage processor, on cursors without an RPC failure.
    """
    rank = F.array_position(F.array(*map(F.lit, ENTITY_ORDER)), F.col("entity"))
    first = rpc_errors.groupBy("cursor").agg(F.min_by(F.struct("entity", "method", "error"), F.struct(F.when(rank > 0, rank).otherwise(99), "entity", "method")).alias("f")).select("cursor", "f.*")
    told = classify_rpc_error(first)
    context = F.to_json(F.struct(F.struct("method", "cursor").alias("request"), F.struct(F.col("rpc_error_code").alias("code"), F.col("rpc_error_message").alias("message")).alias("rpc_error"), F.col("not_ready").alias("expected")))
    out = told.select("cursor", "entity", F.lit("rpc").alias("stage"), F.lit("RpcError").alias("error_type"), F.coalesce("rpc_error_message", F.lit(DEFAULT_MESSAGE)).alias("error_message"), context.alias("context"))
    if parse_errors is None:
        return out
    more = parse_errors.join(first.select("cursor"), "cursor", "left_anti")
    return out.unionByName(more.select("cursor", "entity", F.lit("processor").alias("stage"), F.lit("ParseError").alias("error_type"), "error_message", F.lit("{}").alias("context")))
