"""The ingest plan: raw payloads to a bundle of entity DataFrames, with failures aside."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerframe.operators.decode import decode_token_transfers
from ledgerframe.operators.enrich import drop_failed_cursors, enrich_transactions, inject_block_context
from ledgerframe.operators.errors import capture_failures, failures_of, parse_failures
from ledgerframe.operators.identity import event_id, event_time
from ledgerframe.operators.parse import REQUIRED, block_contexts, block_payloads, block_rows, is_own_parser, log_rows, paired_blocks, parser_of, pruned_logs, receipt_payloads, receipt_rows, transaction_rows
from ledgerframe.plans.entities import resolve_entities, sink_entities
from ledgerframe.storage import cut

METHOD = {"block": "eth_getBlockByNumber", "transaction": "eth_getBlockByNumber", "receipt": "eth_getBlockReceipts", "log": "eth_getBlockReceipts", "trace": "debug_traceBlockByNumber"}
#: Which entity stands for a method that failed.
ENTITY_OF = {METHOD[e]: e for e in ("block", "receipt", "trace")}


#: Which raw method each entity comes from, and how rows of an entity follow from that method's parsed payloads.
_FROM_BLOCKS = {"block": block_rows, "transaction": transaction_rows}
_FROM_RECEIPTS = {"receipt": receipt_rows, "log": log_rows}


def needed_methods(requested: list[str]) -> list[str]:
    """The raw methods that a request needs of each cursor."""
    return sorted({METHOD[e] for e in resolve_entities(requested)})


def parsed_once(good: DataFrame, needed: list[str], check: bool, made: list[str] | None = None) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """(rows by entity, parse failures): each method's payloads are parsed in one pass and written once; sinks read columns of that.

    A method that only one branch reads is not written. Entities with a parser of the caller's are parsed from raw.
    """
    own = lambda e: good.where(F.col("method") == METHOD[e])
    rows, bad = {}, []
    for kinds, first, payloads in ((_FROM_BLOCKS, "block", lambda r: block_payloads(r, "transaction" in needed)), (_FROM_RECEIPTS, "receipt", receipt_payloads)):
        wanted = [e for e in kinds if e in needed]
        ours = [e for e in wanted if is_own_parser(e)]
        if ours and (check or len(needed) > 1):
            parsed = cut(payloads(own(first)), made)
            rows |= {e: kinds[e](parsed) for e in ours}
            bad.append(failures_of(parsed, {e: e for e in ours if e in REQUIRED}))
            wanted = [e for e in wanted if e not in ours]
        rows |= {e: parser_of(e)(own(e)) for e in wanted}
        bad += [parse_failures(own(e), e) for e in wanted if e in REQUIRED]
    if "trace" in needed:
        rows["trace"] = parser_of("trace")(own("trace"))
        bad.append(parse_failures(own("trace"), "trace"))
    return rows, reduce(DataFrame.unionByName, bad) if check and bad else None


#: What columns of a bundle are made of, besides the field of their name.
_MADE_OF = {
    "id": ("hash", "block_hash", "transaction_index", "transaction_hash", "log_index", "trace_id"), "event_timestamp_ms": ("timestamp", "block_timestamp"), "block_timestamp": ("timestamp",),
    "token_address": ("address",), "source_log_id": ("transaction_hash", "log_index"),
}
#: Log columns that transfers are decoded from, and the types of those that they only take over.
_DECODED, _TAKEN = ("topics", "data"), {"address": "string", "transaction_hash": "string", "transaction_index": "long", "block_hash": "string", "block_number": "long", "log_index": "long"}


def sources_of(columns: tuple[str, ...] | None, sinks: list[str]) -> tuple[str, ...] | None:
    """The parsed fields that the columns named of a bundle's entities are made of; None, for all, where columns is None."""
    if columns is None:
        return None
    found = {*columns, *(x for c in columns for x in _MADE_OF.get(c, ()))}
    found |= set(_DECODED) if "token_transfer" in sinks else set()
    # A block's hash and timestamp come to logs together, by its number.
    return tuple(sorted(found | ({"block_number", "timestamp"} if found & {"block_hash", "block_timestamp"} else set())))


def by_cursor(raw: DataFrame, needed: list[str], check: bool, made: list[str] | None = None, fields: tuple[str, ...] | None = None) -> DataFrame:
    """(cursor, blocks, contexts, receipts, why, failed): one row a cursor, all payloads of it parsed, written once.

    Transactions are paired with their receipts, and contexts has the blocks' numbers, hashes and timestamps, so what a cursor's
    rows need of each other is in the row: whatever follows needs no exchange. why lists (entity, error_message) of parse failures;
    failed tells whether the cursor has any failure. The exchange by cursor carries each payload once. Where fields are named, those alone are
    carried: transactions are paired only for a receipt's field, and logs, flat and pruned, stand for receipts.
    """
    good = raw.where("error IS NULL") if "error" in raw.columns else raw
    own = lambda e: good.where(F.col("method") == METHOD[e])
    whole = "transaction" in needed
    paired = whole and is_paired(fields)
    parts = []
    if "block" in needed:
        parts.append((block_payloads(own("block"), whole, fields, fields), ("block", "transaction") if whole else ("block",)))
    if "receipt" in needed:
        parsed = receipt_payloads(own("receipt"))
        if fields is not None:
            parsed = parsed.withColumn("logs", pruned_logs(fields))
            parsed = parsed if paired else parsed.drop("receipts")
        parts.append((parsed, tuple(e for e in ("receipt", "log") if e in needed)))
    none = F.array().cast("array<struct<entity:string,error_message:string>>")

    def told(rows: DataFrame, entities: tuple[str, ...]) -> DataFrame:
        reasons = F.array(*[F.struct(F.lit(e).alias("entity"), F.col(f"why_{e}").alias("error_message")) for e in entities if e in REQUIRED])
        why = F.filter(reasons, lambda r: r["error_message"].isNotNull()) if check else none
        return rows.select("cursor", *[c for c in ("b", "receipts", "logs") if c in rows.columns], why.alias("why"), F.lit(False).alias("rpc"))

    rows = [told(*p) for p in parts]
    if "trace" in needed and check:
        rows.append(parse_failures(own("trace"), "trace").select("cursor", F.array(F.struct("entity", "error_message")).alias("why"), F.lit(False).alias("rpc")))
    if "error" in raw.columns:
        rows.append(raw.where("error IS NOT NULL").select("cursor", none.alias("why"), F.lit(True).alias("rpc")))
    both = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), rows)
    lists = [F.collect_list("b").alias("blocks")] * ("b" in both.columns) + [F.flatten(F.collect_list(c)).alias(c) for c in ("receipts", "logs") if c in both.columns]
    grouped = both.groupBy("cursor").agg(*lists, F.flatten(F.collect_list("why")).alias("why"), F.bool_or("rpc").alias("rpc"))
    columns = []
    if "blocks" in grouped.columns:
        columns = [(paired_blocks("blocks", "receipts") if paired else F.col("blocks")).alias("blocks")]
        columns += [block_contexts("blocks").alias("contexts")] if has_contexts(fields) else []
    columns += [F.col(c) for c in ("receipts", "logs") if c in grouped.columns and not (c == "receipts" and fields is not None)]
    return cut(grouped.select("cursor", *columns, "why", (F.col("rpc") | (F.size("why") > 0)).alias("failed")), made)


def is_paired(fields: tuple[str, ...] | None) -> bool:
    """Whether any of the fields of a transaction comes of its receipt."""
    return fields is None or any(f.startswith("receipt_") for f in fields)


def has_contexts(fields: tuple[str, ...] | None) -> bool:
    """Whether any of the fields of a log comes of its block."""
    return fields is None or bool({"block_hash", "block_timestamp"} & set(fields))


def with_context(rows: DataFrame) -> DataFrame:
    """rows(contexts, ...) without contexts, with block_hash and block_timestamp of the context of their block_number; others keep theirs."""
    found = F.get(F.filter("contexts", lambda c: c["n"] == F.col("block_number")), F.lit(0))
    rows = rows.withColumn("contexts", found)
    stamp = F.when(F.col("contexts").isNotNull(), F.col("contexts.t"))
    hashes = {"block_hash": F.when(F.col("contexts").isNotNull(), F.col("contexts.h")).otherwise(F.col("block_hash"))} if "block_hash" in rows.columns else {}
    return rows.withColumns({**hashes, "block_timestamp": stamp}).drop("contexts")


def _within_cursors(raw: DataFrame, requested: list[str], check: bool, made: list[str] | None, columns: tuple[str, ...] | None) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """ingest by rows of whole cursors; only traces, whose parser takes raw rows, are joined with blocks and failures."""
    needed, sinks = resolve_entities(requested), sink_entities(requested)
    # Traces are joined with whole blocks.
    fields = sources_of(columns, sinks) if "trace" not in sinks else None
    errors = "error" in raw.columns
    wide = by_cursor(raw, needed, check and errors, made, fields)
    failures = cut(capture_failures(_rpc_errors(raw), wide.select("cursor", F.inline("why"))), made) if errors else None
    live = wide.where("NOT failed")
    rows = {}
    if "block" in needed:
        blocks = live.select("cursor", F.explode("blocks").alias("b"))
        rows["block"] = block_rows(blocks, fields)
        if "transaction" in needed:
            rows["transaction"] = transaction_rows(blocks, is_paired(fields), fields)
    if "log" in needed:
        rows["log"] = with_context(log_rows(live, ("contexts",), fields)) if has_contexts(fields) else log_rows(live, (), fields)
        if "token_transfer" in sinks:
            taken = {c: F.lit(None).cast(kind) for c, kind in _TAKEN.items() if c not in rows["log"].columns}
            rows["token_transfer"] = decode_token_transfers(rows["log"].withColumns(taken), columns)
    bundle = {}
    for e in sinks:
        if e == "trace":
            own = raw.where(F.col("method") == METHOD[e])
            traces = parser_of(e)(own.where("error IS NULL") if errors else own)
            traces = inject_block_context(traces, rows["block"])
            rows[e] = traces.join(wide.where("failed").select("cursor"), "cursor", "left_anti") if errors else traces
        bundle[e] = _told(rows[e], e, columns)
    return bundle, failures


def _told(rows: DataFrame, entity: str, columns: tuple[str, ...] | None) -> DataFrame:
    """rows of an entity with id and event time; where columns are named, cursor and those of them that the entity has."""
    out = rows.withColumns({"id": event_id(rows, entity), "event_timestamp_ms": event_time(rows, entity)[0]})
    return out if columns is None else out.select("cursor", *[c for c in out.columns if c in columns and c != "cursor"])


def _rpc_errors(raw: DataFrame) -> DataFrame:
    named = raw.where("error IS NOT NULL").withColumn("entity", F.when(F.col("method") == METHOD["receipt"], "receipt").when(F.col("method") == METHOD["trace"], "trace").otherwise("block"))
    return named.select("cursor", "entity", "method", "error")


def ingest(raw: DataFrame, requested: list[str], check: bool = True, made: list[str] | None = None, columns: tuple[str, ...] | None = None) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """(bundle, failures): a DataFrame per requested entity, and the failed cursors with why.

    Only the branches that the request needs enter the plan, and each method's JSON is parsed once: parsed payloads are written
    to the shared folder, a row a cursor, so a job runs while the plan is made and no branch needs an exchange after it. Where the
    caller has parsers of their own, payloads are written by method and joined. A cursor with any RPC or parse failure gives no row of
    any entity. Each id comes once. With check off, parse failures are not looked for (payloads known to be
    whole). Raw rows without an error column have no failures. Paths of what is written on the way are added to `made`.
    Where columns are named, rows have cursor and those alone, and of good payloads only what they are made of goes through the exchange; which rows
    there are, and what fails, is the same.
    """
    needed = resolve_entities(requested)
    if all(is_own_parser(e) for e in needed):
        return _within_cursors(raw, requested, check, made, columns)
    good = raw.where("error IS NULL") if "error" in raw.columns else raw
    rows, bad = parsed_once(good, needed, check and "error" in raw.columns, made)
    failures = None
    if "error" in raw.columns:
        failures = cut(capture_failures(_rpc_errors(raw), bad), made)
    if "log" in rows and "token_transfer" in [r.strip().lower() for r in requested]:
        rows["token_transfer"] = decode_token_transfers(rows["log"])
    if "transaction" in rows:
        rows["transaction"] = enrich_transactions(rows["transaction"], rows["receipt"])
    sinks = sink_entities(requested)
    for e in ("receipt", "log", "token_transfer", "trace"):
        if e in rows and "block" in rows and (e in sinks or e == "receipt"):
            rows[e] = inject_block_context(rows[e], rows["block"])
    bundle = {e: _told(rows[e], e, columns) for e in sinks}
    return drop_failed_cursors(bundle, None if failures is None or failures.isEmpty() else failures), failures
