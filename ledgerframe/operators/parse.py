"""Parsers: raw payload rows to entity rows. Input is raw(cursor, method, result, error, meta)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerframe.contracts import RECEIPT_FIELDS
from ledgerframe.functions.hexabi import hex_to_decimal_string as dec, hex_to_long as num

#: The public JSON-RPC field names, with what they become (l bigint, d decimal text, s as it is).
_BLOCK = {
    "number": "number:l", "hash": "hash", "parentHash": "parent_hash", "nonce": "nonce:l", "sha3Uncles": "sha3_uncles", "logsBloom": "logs_bloom", "transactionsRoot": "transactions_root",
    "stateRoot": "state_root", "receiptsRoot": "receipts_root", "miner": "miner", "difficulty": "difficulty:d", "totalDifficulty": "total_difficulty:d", "size": "size:l", "extraData": "extra_data",
    "gasLimit": "gas_limit:l", "gasUsed": "gas_used:l", "timestamp": "timestamp:l", "baseFeePerGas": "base_fee_per_gas:d", "withdrawalsRoot": "withdrawals_root", "blobGasUsed": "blob_gas_used:l", "excessBlobGas": "excess_blob_gas:l",
}
_TRANSACTION = {
    "hash": "hash", "from": "from_address", "to": "to_address", "nonce": "nonce:l", "value": "value:d", "gas": "gas:l", "gasPrice": "gas_price:d", "maxFeePerGas": "max_fee_per_gas:d",
    "maxPriorityFeePerGas": "max_priority_fee_per_gas:d", "maxFeePerBlobGas": "max_fee_per_blob_gas:d", "type": "transaction_type:l", "chainId": "chain_id:l", "v": "v:l", "r": "r", "s": "s", "input": "input",
}
_RECEIPT = {
    "transactionHash": "transaction_hash", "transactionIndex": "transaction_index:l", "blockHash": "block_hash", "blockNumber": "block_number:l", "from": "from_address", "to": "to_address",
    "cumulativeGasUsed": "cumulative_gas_used:l", "gasUsed": "gas_used:l", "contractAddress": "contract_address", "status": "status:l", "effectiveGasPrice": "effective_gas_price:d", "type": "transaction_type:l",
    "l1Fee": "l1_fee:d", "l1GasUsed": "l1_gas_used:l", "l1GasPrice": "l1_gas_price:d", "l1FeeScalar": "l1_fee_scalar", "blobGasPrice": "blob_gas_price:d", "blobGasUsed": "blob_gas_used:l",
}
_LOG = {"logIndex": "log_index:l", "transactionHash": "transaction_hash", "transactionIndex": "transaction_index:l", "blockHash": "block_hash", "blockNumber": "block_number:l", "address": "address", "data": "data"}
#: Keys of a block that count as zero when they are missing (an explicit null stays NULL).
_ZERO = ("difficulty", "totalDifficulty", "size", "gasLimit", "gasUsed", "timestamp")


def _schema(fields: dict[str, str], more: str = "") -> str:
    return "struct<" + ",".join([*(f"`{k}`:string" for k in fields), *([more] if more else [])]) + ">"


def _columns(source: str, fields: dict[str, str], change=None) -> list[Column]:
    out = []
    for key, spec in fields.items():
        name, _, kind = spec.partition(":")
        c = F.col(f"{source}.`{key}`")
        c = change(key, c) if change else c
        out.append((num(c) if kind == "l" else dec(c) if kind == "d" else c).alias(name))
    return out


#: Keys without which a payload can't be parsed, by entity.
REQUIRED = {
    "block": ("number", "hash", "parentHash"),
    "receipt": ("blockNumber", "blockHash", "transactionHash", "transactionIndex"),
    "log": ("logIndex", "transactionHash", "transactionIndex", "blockHash", "blockNumber", "address", "data", "topics"),
}
_LOGS = f"array<{_schema(_LOG, 'topics:array<string>,removed:boolean')}>"
_WRONG = "wrong shape"


def _has_null(row: Column, keys: tuple[str, ...]) -> Column:
    """Whether any of the keys of a parsed object is NULL: missing, or null in the payload."""
    out = F.lit(False)
    for k in keys:
        out = out | row[k].isNull()
    return out


def _missing(have: Column, keys: tuple[str, ...]) -> Column:
    """The keys that are not among those an object has, joined by commas; a key whose value is null is there."""
    return F.array_join(F.array_except(F.array(*map(F.lit, keys)), F.coalesce(have, F.array().cast("array<string>"))), ",")


def _why(starts: str, parsed: Column, missing: Column) -> Column:
    """Why a payload can't be parsed: its shape, or the keys it lacks; NULL if it can."""
    shape = ~F.coalesce(F.ltrim(F.col("result")).startswith(starts), F.lit(False)) | parsed.isNull()
    return F.when(shape, _WRONG).when(missing != "", F.concat(F.lit("missing "), missing))


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """rows with a column that is computed once a row: one element of an array is exploded.

    A projection would be computed again in every filter on what follows from it, since filters are pushed below projections.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _wanted(fields: dict[str, str], columns: tuple[str, ...] | None, always: tuple[str, ...] = ()) -> dict[str, str]:
    """The keys of which columns are made, and those that are read always; all where columns is None."""
    return {k: v for k, v in fields.items() if columns is None or k in always or v.partition(":")[0] in columns}


def block_payloads(raw: DataFrame, whole: bool, columns: tuple[str, ...] | None = None, transactions: tuple[str, ...] | None = None) -> DataFrame:
    """(cursor, b, why_block): block payloads parsed once; b holds the transactions as objects if whole, else as text.

    Keys that count as zero when missing are VARIANT, which tells a missing key from an explicit null. Where columns (of blocks) or
    transactions (their columns) are named, the other keys are skipped as the text is read.
    """
    keys = _wanted(_BLOCK, columns, REQUIRED["block"])
    fields = ",".join(f"`{k}`:{'variant' if k in _ZERO else 'string'}" for k in keys)
    one = "string"
    if whole:
        one = _schema(_wanted(_TRANSACTION, transactions, ("hash",)), "blobVersionedHashes:array<string>" if transactions is None or "blob_versioned_hashes" in transactions else "")
    lists = {"withdrawals": "string", "transactions": f"array<{one}>"}
    lists = {k: v for k, v in lists.items() if columns is None or k in columns or (k == "transactions" and (whole or "transaction_count" in columns))}
    more = "".join(f",{k}:{v}" for k, v in lists.items())
    rows = _once(raw.select("cursor", "result"), "b", F.from_json("result", f"struct<{fields}{more}>"))
    zero = {k: F.when(F.col(f"b.{k}").isNull(), "0x0").otherwise(F.try_variant_get(F.col(f"b.{k}"), "$", "string")) for k in _ZERO if k in keys}
    plain = F.struct(*[zero.get(k, F.col(f"b.{k}")).alias(k) for k in keys], *[f"b.{k}" for k in lists])
    rows = rows.select("cursor", "result", F.when(F.col("b").isNotNull(), plain).alias("b"))
    # The payload is read for its keys only where one of them came out NULL.
    missing = F.when(_has_null(F.col("b"), REQUIRED["block"]), _missing(F.json_object_keys("result"), REQUIRED["block"])).otherwise("")
    return rows.select("cursor", "b", _why("{", F.col("b"), missing).alias("why_block"))


def receipt_payloads(raw: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """(cursor, receipts, why_receipt, why_log): receipts payloads with their logs, parsed once; where columns (of receipts) are named, other keys are skipped."""
    keys = _wanted(_RECEIPT, columns, REQUIRED["receipt"])
    rows = _once(raw.select("cursor", "result"), "receipts", F.from_json("result", f"array<{_schema(keys, f'logs:{_LOGS}' if columns is None or 'logs' in columns else '')}>"))
    if columns is not None and "logs" not in columns:
        return rows.select("cursor", "receipts")
    keyed = {"receipt": "array<map<string,string>>", "log": "array<struct<logs:array<map<string,string>>>>"}
    logs = F.flatten(F.transform("receipts", lambda r: F.coalesce(r["logs"], F.array().cast(_LOGS))))

    def missing(entity: str, parsed: Column) -> Column:
        found = F.from_json("result", keyed[entity])
        objects = found if entity == "receipt" else F.flatten(F.transform(found, lambda r: F.coalesce(r["logs"], F.array().cast("array<map<string,string>>"))))
        each = F.transform(objects, lambda m: _missing(F.map_keys(m), REQUIRED[entity]))
        told = F.array_join(F.array_distinct(F.filter(each, lambda m: m != "")), ";")
        # The payload is read for its keys only where one of them came out NULL.
        return F.when(F.exists(parsed, lambda x: _has_null(x, REQUIRED[entity])), F.coalesce(told, F.lit(""))).otherwise("")

    why = {e: _why("[", F.col("receipts"), missing(e, x)) for e, x in (("receipt", F.col("receipts")), ("log", logs))}
    return rows.select("cursor", "receipts", *[c.alias(f"why_{e}") for e, c in why.items()])


def block_rows(payloads: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Block rows of block_payloads, one for each payload that is an object; cursor and the columns named, or all."""
    if columns is not None:
        made = {"transaction_count": F.coalesce(F.size("b.transactions"), F.lit(0)).cast("long"), "withdrawals": F.coalesce("b.withdrawals", F.lit("[]"))} if {"transaction_count", "withdrawals"} & set(columns) else {}
        return payloads.where("b IS NOT NULL").select("cursor", *_columns("b", _wanted(_BLOCK, columns)), *[c.alias(k) for k, c in made.items() if k in columns])
    return payloads.where("b IS NOT NULL").select(
        "cursor", F.lit("block").alias("type"), *_columns("b", _BLOCK), F.coalesce(F.size("b.transactions"), F.lit(0)).cast("long").alias("transaction_count"),
        F.coalesce("b.withdrawals", F.lit("[]")).alias("withdrawals"),
    )


def transaction_rows(payloads: DataFrame, paired: bool = False, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Transaction rows of block_payloads, whole; where each is paired with its receipt (see paired_blocks), with receipt_* columns too. With columns, cursor and those alone."""
    stamped = columns is None or "block_timestamp" in columns
    rows = payloads.select("cursor", "b.number", *["b.timestamp"] * stamped, F.col("b.hash").alias("block_hash"), F.posexplode("b.transactions").alias("i", "x"))
    t = "x.t" if paired else "x"
    made = [
        ("type", lambda: F.lit("transaction")), *[(spec.partition(":")[0], lambda k=k, spec=spec: _columns(t, {k: spec})[0]) for k, spec in _TRANSACTION.items()],
        ("block_hash", lambda: F.col("block_hash")), ("transaction_index", lambda: F.col("i").cast("long")), ("block_number", lambda: num(F.col("number"))),
        ("block_timestamp", lambda: num(F.col("timestamp"))), ("blob_versioned_hashes", lambda: F.coalesce(f"{t}.blobVersionedHashes", F.array().cast("array<string>"))),
        *[(spec.partition(":")[0], lambda k=k, spec=spec: _columns("x.r", {k: spec})[0]) for k, spec in (_PAIRED.items() if paired else ())],
    ]
    return rows.select("cursor", *[c().alias(name) for name, c in made if columns is None or name in columns])


#: Receipt fields that a transaction gains.
_PAIRED = {k: f"receipt_{v}" for k, v in _RECEIPT.items() if v.partition(":")[0] in RECEIPT_FIELDS}


def paired_blocks(blocks: str, receipts: str) -> Column:
    """The array of parsed blocks with each transaction as (t, r): itself and the last receipt of its hash among a cursor's receipts, or NULL."""
    one = lambda r, i: F.struct(r["transactionHash"].alias("k"), i.alias("i"), F.struct(*[r[k].alias(k) for k in _PAIRED]).alias("v"))
    entries = F.array_sort(F.filter(F.transform(receipts, one), lambda e: e["k"].isNotNull()))
    last = lambda s: F.filter(s, lambda e, i: F.coalesce(F.get(s, i + 1)["k"] != e["k"], F.lit(True)))
    by_hash = lambda s: F.map_from_entries(F.transform(last(s), lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v"))))
    pairs = lambda b, m: b.withField("transactions", F.transform(b["transactions"], lambda t: F.struct(t.alias("t"), F.try_element_at(m, t["hash"]).alias("r"))))
    # One element of an array binds what is computed once for a cursor.
    return F.flatten(F.transform(F.transform(F.array(entries), by_hash), lambda m: F.transform(blocks, lambda b: pairs(b, m))))


def block_contexts(blocks: str) -> Column:
    """(n, h, t) of parsed blocks that have a number: number, hash and timestamp; of blocks of one number that of the smallest hash comes first."""
    some = F.filter(blocks, lambda b: b["number"].isNotNull())
    return F.array_sort(F.transform(some, lambda b: F.struct(num(b["number"]).alias("n"), b["hash"].alias("h"), num(b["timestamp"]).alias("t"))))


def receipt_rows(payloads: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Receipt rows of receipt_payloads, with all columns or those named; arrival is the place in the payload."""
    rows = payloads.select("cursor", F.posexplode("receipts").alias("i", "r"))
    return rows.select("cursor", F.lit("receipt").alias("type"), *_columns("r", _wanted(_RECEIPT, columns)), F.col("i").cast("long").alias("arrival"))


def _flat_logs() -> Column:
    """The logs of all receipts of receipt_payloads."""
    return F.flatten(F.filter(F.col("receipts.logs"), lambda x: x.isNotNull()))


def pruned_logs(columns: tuple[str, ...]) -> Column:
    """The logs of a cursor's receipts of receipt_payloads, flat, with the keys of the columns named alone."""
    keys = [*_wanted(_LOG, columns), *[k for k in ("topics", "removed") if k in columns]]
    # A log that is null stays one: its row has NULLs.
    return F.transform(_flat_logs(), lambda x: F.struct(*[x[k].alias(k) for k in keys], F.lit(True).alias("own")))


def log_rows(payloads: DataFrame, keep: tuple[str, ...] = (), columns: tuple[str, ...] | None = None) -> DataFrame:
    """Log rows of receipt_payloads, with columns of the payloads that are to be kept; with columns, of payloads(logs) (see pruned_logs), with those alone."""
    if columns is not None:
        rows = payloads.select("cursor", *keep, F.explode("logs").alias("l"))
        made = {"topics": F.col("l.topics"), "removed": F.coalesce("l.removed", F.lit(False))}
        return rows.select("cursor", *keep, *_columns("l", _wanted(_LOG, columns)), *[c.alias(k) for k, c in made.items() if k in columns])
    rows = payloads.select("cursor", *keep, F.explode(_flat_logs()).alias("l"))
    return rows.select("cursor", *keep, F.lit("log").alias("type"), *_columns("l", _LOG), F.col("l.topics").alias("topics"), F.coalesce("l.removed", F.lit(False)).alias("removed"))


def parse_blocks(raw: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """cursor and the block fields, one row per raw row whose result is an object; with columns, those alone, and only their keys are read.

    transaction_count counts the transactions, whole or as hashes (0 if missing); withdrawals is JSON text ([] if missing).
    """
    return block_rows(block_payloads(raw, whole=False, columns=columns), columns)


def parse_transactions(raw: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """cursor and the transaction fields: a row per transaction of a full block; transaction_index is the place in the array.

    With columns (keys of a transaction itself), cursor and those alone, and only their keys are read.
    """
    if columns is None:
        return transaction_rows(block_payloads(raw, whole=True))
    rows = block_payloads(raw, True, (), columns).select("cursor", F.explode("b.transactions").alias("x"))
    return rows.select("cursor", *_columns("x", _wanted(_TRANSACTION, columns)))


def parse_receipts(raw: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """cursor and the receipt fields, a row per receipt; arrival is its place in the payload. With columns, those alone, and only their keys are read."""
    return receipt_rows(receipt_payloads(raw, columns), columns)


def parse_logs(raw: DataFrame) -> DataFrame:
    """cursor and the log fields, a row per log of each receipt; there is no block_timestamp yet."""
    return log_rows(receipt_payloads(raw, ("logs",)))


def trace_id(tx: Column, path: Column) -> Column:
    """{tx}_root for an empty path, else {tx}_ and the path's steps; NULL for a NULL transaction."""
    return F.when(F.size(path) > 0, F.concat(tx, F.lit("_"), F.array_join(path.cast("array<string>"), "_"))).otherwise(F.concat(tx, F.lit("_root")))


def parent_trace_id(tx: Column, path: Column) -> Column:
    return F.when(F.size(path) > 0, trace_id(tx, F.slice(path, F.lit(1), F.size(path) - 1)))


def parse_trace_block(raw: DataFrame) -> DataFrame:
    """cursor and the trace fields of flat traces; action and result may be null."""
    kind = (
        "array<struct<action:struct<`from`:string,`to`:string,value:string,input:string,callType:string,gas:string,rewardType:string>,result:struct<output:string,status:string,gasUsed:string>,"
        "traceAddress:array<bigint>,transactionHash:string,transactionPosition:bigint,type:string,error:string,subtraces:bigint>>"
    )
    t = raw.select("cursor", F.explode(F.from_json("result", kind)).alias("t")).withColumn("path", F.coalesce("t.traceAddress", F.array().cast("array<bigint>")))
    tx, path = F.col("t.transactionHash"), F.col("path")
    return t.select(
        "cursor", F.lit("trace").alias("type"), F.col("cursor").alias("block_number"), tx.alias("transaction_hash"), trace_id(tx, path).alias("trace_id"), parent_trace_id(tx, path).alias("parent_trace_id"),
        F.col("t.transactionPosition").alias("trace_index"), F.col("t.action.from").alias("from_address"), F.col("t.action.to").alias("to_address"), dec(F.col("t.action.value")).alias("value"),
        F.col("t.action.input").alias("input"), F.col("t.result.output").alias("output"), F.col("t.action.callType").alias("call_type"), F.col("t.type").alias("trace_type"), F.col("t.result.status").alias("status"),
        F.col("t.error").alias("error"), num(F.col("t.action.gas")).alias("gas"), num(F.col("t.result.gasUsed")).alias("gas_used"), F.size("path").cast("long").alias("depth"), F.col("t.subtraces").alias("subtraces"),
        F.col("t.action.rewardType").alias("reward_type"), path.alias("trace_address"), F.lit("parity").alias("trace_source"), F.lit("trace_block").alias("trace_method"),
    )


#: The public names of a call's fields.
_CALL = ("type", "from", "to", "value", "gas", "gasUsed", "input", "output", "error")
#: Levels of calls that one pass of the parser opens (the root is level 0); what is deeper goes round again.
LEVELS = 8
_FLAT = "array<struct<path:array<bigint>," + ",".join(f"`{k}`:string" for k in _CALL) + ",subtraces:bigint,more:array<string>>>"


def _call_schema(levels: int) -> str:
    return _schema(dict.fromkeys(_CALL, ""), "calls:array<string>" if levels == 0 else f"calls:array<{_call_schema(levels - 1)}>")


def _opened(call: str, path: str, levels: int) -> str:
    """SQL for the array of the rows of a call and the calls of so many levels below; `more` has the texts of what is deeper."""
    more = f"{call}.calls" if levels == 0 else "CAST(NULL AS array<string>)"
    fields = ", ".join(f"'{k}', {call}.`{k}`" for k in _CALL)
    own = f"array(named_struct('path', {path}, {fields}, 'subtraces', CAST(coalesce(size({call}.calls), 0) AS bigint), 'more', {more}))"
    if levels == 0:
        return own
    c, i = f"c{levels}", f"i{levels}"
    below = _opened(c, f"concat({path}, array(CAST({i} AS bigint)))", levels - 1)
    return f"concat({own}, coalesce(flatten(transform({call}.calls, ({c}, {i}) -> {below})), CAST(array() AS {_FLAT})))"


def _calls(text: str) -> str:
    """SQL for the rows of one pass over a call's JSON text, paths from that call on; a text that is no object gives a row of NULLs."""
    parsed = f"array(from_json({text}, '{_call_schema(LEVELS)}'))"
    return f"flatten(transform({parsed}, c -> {_opened('c', 'CAST(array() AS array<bigint>)', LEVELS)}))"


def _rounds(text: str) -> str:
    """SQL for the rows of a call of any depth: passes over its text, then over the texts that a pass has left, until none is left."""
    todo = "array<struct<path:array<bigint>,text:string>>"
    fields = ", ".join(f"'{k}', c.`{k}`" for k in (*_CALL, "subtraces", "more"))
    found = f"flatten(transform(s.todo, t -> transform({_calls('t.text')}, c -> named_struct('path', concat(t.path, c.path), {fields}))))"
    left = f"flatten(transform(f, c -> coalesce(transform(c.more, (x, i) -> named_struct('path', concat(c.path, array(CAST(i AS bigint))), 'text', x)), CAST(array() AS {todo}))))"
    # One element of an array binds what a pass has found.
    step = f"get(transform(array({found}), f -> named_struct('todo', {left}, 'rows', concat(s.rows, f))), 0)"
    start = f"named_struct('todo', CAST(array(named_struct('path', array(), 'text', {text})) AS {todo}), 'rows', CAST(array() AS {_FLAT}))"
    # A pass takes up LEVELS + 1 nested "calls" keys; an escaped key can't be counted, but then every opening brace can.
    keys = f"""CASE WHEN contains({text}, '\\\\u') THEN length({text}) - length(replace({text}, '{{', '')) ELSE (length({text}) - length(replace({text}, '"calls"', ''))) DIV 7 END"""
    return f"aggregate(sequence(0, CAST(({keys}) DIV {LEVELS + 1} AS int)), {start}, (s, k) -> CASE WHEN size(s.todo) = 0 THEN s ELSE {step} END, s -> s.rows)"


def flatten_call_tree(raw: DataFrame) -> DataFrame:
    """cursor and the trace fields of recursive call traces, a row per call; nothing runs while the plan is made.

    One parser serves trees of any depth: it opens LEVELS levels in one expression and leaves the texts of deeper calls, which go
    round again within the row, so raw is read once. Only trees with more "calls" keys than LEVELS can have any, and only those are
    looked at for it. Transactions without a result give no rows. JSON nested over 1,000 levels deep, about 495 calls, is malformed
    to Spark's reader, so such a payload gives no rows and counts as a parse failure.
    """
    tops = raw.select("cursor", F.explode(F.from_json("result", "array<struct<txHash:string,transactionHash:string,result:string>>")).alias("t"))
    tx = F.coalesce(F.nullif("t.txHash", F.lit("")), F.col("t.transactionHash"))
    text = F.col("t.result")
    empty = text.isin("{}", "[]", "null", "false", "0", '""')
    rows = tops.where(text.isNotNull() & ~empty).select("cursor", tx.alias("tx"), text.alias("text"))
    maybe = F.contains("text", F.lit("\\u")) | (F.char_length("text") - F.char_length(F.replace("text", F.lit('"calls"'), F.lit(""))) > len('"calls"') * LEVELS)
    flat = rows.select("cursor", "tx", F.explode(F.when(maybe, F.expr(_rounds("text"))).otherwise(F.expr(_calls("text")))).alias("c"))
    tx, path, none = F.col("tx"), F.col("c.path"), F.lit(None).cast("string")
    return flat.select(
        "cursor", F.lit("trace").alias("type"), F.col("cursor").alias("block_number"), tx.alias("transaction_hash"), trace_id(tx, path).alias("trace_id"), parent_trace_id(tx, path).alias("parent_trace_id"),
        F.lit(None).cast("long").alias("trace_index"), F.col("c.from").alias("from_address"), F.col("c.to").alias("to_address"), dec(F.col("c.value")).alias("value"), F.col("c.input").alias("input"),
        F.col("c.output").alias("output"), F.col("c.type").alias("call_type"), F.lit("call").alias("trace_type"), none.alias("status"), F.col("c.error").alias("error"), num(F.col("c.gas")).alias("gas"),
        num(F.col("c.gasUsed")).alias("gas_used"), F.size("c.path").cast("long").alias("depth"), F.col("c.subtraces").alias("subtraces"), none.alias("reward_type"), path.alias("trace_address"),
        F.lit("geth").alias("trace_source"), F.lit("debug_trace").alias("trace_method"),
    )


def parse_traces(raw: DataFrame, kind: str) -> DataFrame:
    """Traces by kind of payload: trace_block or debug_trace."""
    if kind not in ("trace_block", "debug_trace"):
        raise ValueError(f"unknown trace kind: {kind}")
    return parse_trace_block(raw) if kind == "trace_block" else flatten_call_tree(raw)


#: Log columns by either of their names.
_NAMES = {n: k for k, n in (("logIndex", "log_index"), ("transactionHash", "transaction_hash"), ("transactionIndex", "transaction_index"), ("blockHash", "block_hash"), ("blockNumber", "block_number"), ("blockTimestamp", "block_timestamp"), ("ingestTimestamp", "ingest_timestamp"))}


def coalesce_names(df: DataFrame) -> DataFrame:
    """Log rows whose columns may have camelCase names and numbers as text: snake_case names, numbers as BIGINT."""
    have = set(df.columns)
    out = {}
    for name, other in _NAMES.items():
        found = [F.col(c) for c in (name, other) if c in have]
        if found:
            c = F.coalesce(*found)
            out[name] = c if name.endswith("_hash") else c.try_cast("bigint")
    rest = [c for c in df.columns if c not in out and c not in _NAMES.values()]
    return df.select(*rest, *[c.alias(n) for n, c in out.items()])


_PARSERS = {"block": parse_blocks, "transaction": parse_transactions, "receipt": parse_receipts, "log": parse_logs, "trace": flatten_call_tree}
_OWN = dict(_PARSERS)


def register_parser(entity: str, parser) -> None:
    """Make parser (DataFrame to DataFrame) the one for an entity."""
    _PARSERS[entity.strip().lower()] = parser


def parser_of(entity: str):
    return _PARSERS[entity]


def is_own_parser(entity: str) -> bool:
    """Whether an entity still has the parser of this module."""
    return _PARSERS.get(entity) is _OWN.get(entity)
