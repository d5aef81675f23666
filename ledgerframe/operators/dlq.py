"""Dead letters: building, ids, retry and resolve transitions, replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerframe.functions.hexabi import let
from ledgerframe.operators.progress import latest_by_key

#: Characters of a text that a payload preview keeps; keys and items; nested levels that are previewed.
PREVIEW, KEYS, ITEMS, DEPTH = 512, 10, 3, 8
#: The fields that make a record's id, in the sorted order of their names.
_ID_FIELDS = ("chain", "cursor", "entity", "error_message", "error_type", "first_seen_at", "network", "pipeline", "stage")


#: Characters that a JSON text escapes by a letter.
_LETTERS = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\f": "\\f", "\b": "\\b"}
#: A text of printable ASCII without quotes and backslashes, which stands as it is.
_PLAIN = r"^[\x20\x21\x23-\x5B\x5D-\x7E]*$"


def json_text(text: Column) -> Column:
    """A text as a JSON string in ASCII: letters for the common escapes, \\uxxxx in lower-case hex for other controls and for all beyond
    ASCII, by UTF-16 unit, so two of them above U+FFFF; NULL is null."""
    unit = lambda x: F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(x), 4, "0")))

    def one(ch: Column) -> Column:
        code = F.ascii(ch)
        over = code - 0x10000
        pair = F.concat(unit(F.shiftright(over, 10) + 0xD800), unit(over.bitwiseAND(0x3FF) + 0xDC00))
        known = F.lit(None).cast("string")
        for k, v in _LETTERS.items():
            known = F.when(ch == k, v).otherwise(known)
        return F.coalesce(known, F.when((code >= 32) & (code < 127), ch).when(code > 0xFFFF, pair).otherwise(unit(code)))

    inside = F.when(text.rlike(_PLAIN), text).otherwise(F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), one), ""))
    return F.coalesce(F.concat(F.lit('"'), inside, F.lit('"')), F.lit("null"))


def dlq_id(df: DataFrame) -> Column:
    """The first 32 hex digits of SHA-256 over the compact JSON, sorted by name and in ASCII, of the nine identifying fields (NULLs as null)."""
    kinds = dict(df.dtypes)
    value = lambda c: json_text(F.col(c)) if kinds[c] == "string" else F.coalesce(F.col(c).cast("string"), F.lit("null"))
    fields = [x for i, c in enumerate(_ID_FIELDS) for x in (F.lit("," * (i > 0) + f'"{c}":'), value(c))]
    return F.substring(F.sha2(F.concat(F.lit("{"), *fields, F.lit("}")), 256), 1, 32)


def _quoted(text: Column) -> Column:
    """A text as a JSON string."""
    whole = F.to_json(F.struct(text.alias("x")))
    return F.substr(whole, F.lit(6), F.length(whole) - 6)


def _parts(payload: Column) -> Column:
    """The first entries of an object or array as (k, x): its key with a colon, or nothing, and the JSON text of its value.

    Values are read twice, as text, which keeps the order of keys inside them, and as VARIANT, which tells a text from what it looks like.
    """
    typed = lambda s, v: F.when(s.isNull(), "null").when(F.schema_of_variant(v) == "STRING", _quoted(s)).otherwise(s)
    entry = lambda k, s, v: F.struct(k.alias("k"), typed(s, v).alias("x"))
    pairs = F.zip_with(
        F.slice(F.map_entries(F.from_json(payload, "map<string,string>")), 1, KEYS), F.slice(F.map_values(F.from_json(payload, "map<string,variant>")), 1, KEYS),
        lambda e, v: entry(F.concat(_quoted(e["key"]), F.lit(":")), e["value"], v),
    )
    items = F.zip_with(F.slice(F.from_json(payload, "array<string>"), 1, ITEMS), F.slice(F.from_json(payload, "array<variant>"), 1, ITEMS), lambda s, v: entry(F.lit(""), s, v))
    return F.when(payload.startswith("{"), pairs).when(payload.startswith("["), items)


def _preview(payload: Column, depth: int) -> Column:
    """JSON text of a value with long texts cut, objects at ten keys and arrays at three items, down to `depth` levels."""

    def one(p: Column) -> Column:
        text = F.from_json(F.concat(F.lit('{"x":'), p, F.lit("}")), "struct<x:string>")["x"]
        short = F.when(F.coalesce(F.length(text), F.lit(0)) <= PREVIEW, p).otherwise(_quoted(F.concat(F.substring(text, 1, PREVIEW), F.lit("..."))))
        if depth == 0:
            return short
        inside = F.array_join(F.transform(_parts(p), lambda e: F.concat(e["k"], _preview(e["x"], depth - 1))), ",")
        return let(inside, lambda t: F.when(p.startswith("{"), F.concat(F.lit("{"), t, F.lit("}"))).when(p.startswith("["), F.concat(F.lit("["), t, F.lit("]"))).otherwise(short))

    return let(payload, one)


def summarize_payload(payload: Column, depth: int = DEPTH) -> Column:
    """JSON text {"type", "size", "preview"} of a payload given as JSON text; {} for NULL; a summary stays as it is.

    Values inside nested containers are previewed to `depth` levels; a text stays a text whatever it looks like.
    """
    p = F.trim(payload)
    keys = F.when(p.startswith("{"), F.map_keys(F.from_json(p, "map<string,string>")))
    summary = F.array_contains(keys, "type") & (F.size(F.array_except(keys, F.array(F.lit("type"), F.lit("size"), F.lit("preview")))) == 0)
    kind = F.when(p.startswith("{"), "dict").when(p.startswith("["), "list").when(p.startswith('"'), "str").when(p.isin("true", "false"), "bool").when(p.rlike("[.eE]"), "float").otherwise("int")
    size = F.when(p.startswith("{"), F.size(keys)).when(p.startswith("["), F.size(F.from_json(p, "array<string>"))).when(p.startswith('"'), F.length(F.from_json(F.concat(F.lit('{"x":'), p, F.lit("}")), "struct<x:string>")["x"]))
    preview = _preview(p, depth)
    shown = F.when(~preview.isin("{}", "[]", '""', "0", "false", "null"), F.concat(F.lit(',"preview":'), preview)).otherwise("")
    made = F.concat(F.lit('{"type":"'), kind, F.lit('"'), F.coalesce(F.concat(F.lit(',"size":'), size), F.lit("")), shown, F.lit("}"))
    return F.when(p.isNull() | (p == "null"), "{}").when(summary, p).otherwise(made)


def build_dlq(failures: DataFrame, now_ms: int, chain: str, network: str, pipeline: str, max_retry: int = 3) -> DataFrame:
    """Dead-letter rows of failures(cursor, entity, stage, error_type, error_message[, context, payload, ...]).

    Times default to now_ms; the key is {chain}_{entity}_{cursor or unknown}.
    """
    has = lambda name, other: F.coalesce(F.col(name), other) if name in failures.columns else other
    payload = summarize_payload(F.col("payload")) if "payload" in failures.columns else F.lit("{}")
    now = F.lit(now_ms).cast("bigint")
    df = failures.withColumns({
        "chain": F.lit(chain), "network": F.lit(network), "pipeline": F.lit(pipeline), "payload": payload, "context": has("context", F.lit("{}")), "retry_count": has("retry_count", F.lit(0)).cast("bigint"),
        "max_retry": has("max_retry", F.lit(max_retry)).cast("bigint"), "status": has("status", F.lit("pending")), "first_seen_at": has("first_seen_at", now).cast("bigint"), "last_attempt_at": has("last_attempt_at", now).cast("bigint"),
        "next_retry_at": has("next_retry_at", F.lit(None)).cast("bigint"), "ingest_timestamp": has("ingest_timestamp", now).cast("bigint"),
    })
    key = F.concat_ws("_", "chain", "entity", F.coalesce(F.col("cursor").cast("string"), F.lit("unknown")))
    return df.withColumns({"id": has("id", dlq_id(df)), "kafka_partition_key": key})


def next_retry_at(retry_count: Column, base_ms: int, now_ms: Column | int) -> Column:
    """now + base · 2^max(n−1, 0)."""
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    return (now + F.lit(base_ms) * F.pow(F.lit(2.0), F.greatest(retry_count - 1, F.lit(0)))).cast("bigint")


def _count(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint")


def should_retry(now_ms: int) -> Column:
    """Open records with retries left (missing counts are 0) that are due (NULL or 0: due now)."""
    due = F.coalesce(F.col("next_retry_at"), F.lit(0)) <= now_ms
    return F.coalesce(F.col("status").isin("pending", "retrying"), F.lit(False)) & (_count("retry_count") < _count("max_retry")) & due


def retry_delay_ms(now_ms: int) -> Column:
    return F.greatest(F.coalesce(F.col("next_retry_at"), F.lit(0)) - now_ms, F.lit(0)).cast("bigint")


def retry_transition(df: DataFrame, base_ms: int, now_ms: int) -> DataFrame:
    """The records after a failed retry: one more try; failed at the limit, else retrying with a new due time.

    Ids and first_seen_at stay. What the new failure says, in columns new_error_type, new_error_message, new_payload and
    new_context (which go), takes the place of the old; a missing payload or context keeps the old one.
    """
    n = _count("retry_count") + 1
    spent = n >= _count("max_retry")
    told = {}
    for name in ("error_type", "error_message", "payload", "context"):
        if f"new_{name}" in df.columns:
            new = F.col(f"new_{name}")
            new = F.when(new.isNotNull(), summarize_payload(new)) if name == "payload" else new
            told[name] = F.coalesce(new, F.col(name)) if name in df.columns else new
    return df.withColumns({
        **told, "retry_count": n, "max_retry": _count("max_retry"), "status": F.when(spent, "failed").otherwise("retrying"),
        "next_retry_at": F.when(~spent, next_retry_at(n, base_ms, now_ms)), "last_attempt_at": F.lit(now_ms).cast("bigint"), "ingest_timestamp": F.lit(now_ms).cast("bigint"),
    }).drop(*[f"new_{name}" for name in told])


def resolve_transition(df: DataFrame, now_ms: int) -> DataFrame:
    """The records after a retry that worked."""
    now = F.lit(now_ms).cast("bigint")
    return df.withColumns({"status": F.lit("resolved"), "next_retry_at": F.lit(None).cast("bigint"), "last_attempt_at": now, "ingest_timestamp": now})


def replay_filter(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Records equal in each given field (entity, status, stage, pipeline, chain); None asks for nothing."""
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def replay_cursors(log: DataFrame, order: str = "seq", most: int | None = None, **wanted: str | None) -> DataFrame:
    """The cursors to replay, ascending: latest state per id, filtered, distinct (NULL and 0 skipped), the first `most` in order of arrival."""
    latest = replay_filter(latest_by_key(log, ["id"], [order]), **wanted).where("cursor IS NOT NULL AND cursor <> 0")
    cursors = latest.groupBy("cursor").agg(F.min(order).alias("arrived"))
    if most is not None:
        cursors = cursors.orderBy("arrived", "cursor").limit(most)
    return cursors.select("cursor").orderBy("cursor")


def replay_cursor_records(log: DataFrame, cursors: DataFrame, order: str = "seq", **wanted: str | None) -> DataFrame:
    """(cursor, n_records, ids): the matching records of each replay cursor, ids sorted."""
    latest = replay_filter(latest_by_key(log, ["id"], [order]), **wanted)
    return latest.join(cursors, "cursor", "left_semi").groupBy("cursor").agg(F.count("*").alias("n_records"), F.array_sort(F.collect_list("id")).alias("ids"))


_ENTITIES = ("block", "transaction", "receipt", "log", "trace")
#: What a record says whose raw rows did not come again.
NO_PAYLOAD = "no payload for the cursor"


def _run_again(raw: DataFrame, cursors: DataFrame, run, methods: list[str]) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """(bundle, failures, whole): the raw rows of cursors ingested again; whole lists the cursors that have raw rows of all methods."""
    if "error" not in raw.columns:
        raw = raw.withColumn("error", F.lit(None).cast("string"))
    own = raw.join(cursors.select("cursor").distinct(), "cursor", "left_semi")
    bundle, failures = run(own)
    have = own.where(F.col("method").isin(methods)).groupBy("cursor").agg(F.count_distinct("method").alias("__n"))
    return bundle, failures, have.where(F.col("__n") == len(set(methods))).select("cursor")


def retry_job(log: DataFrame, raw: DataFrame, run, methods: list[str], base_ms: int, now_ms: int, order: str = "seq") -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """(bundle, states, gaps): the due records' cursors ingested again, the records' new states, and gap rows(cursor, status, error).

    run(raw rows of those cursors) gives (bundle, failures). A record whose cursor has raw rows of all methods and no failure is
    resolved; else it takes the cursor's last failure in entity order, or NO_PAYLOAD, and waits for its next try or fails.
    """
    due = latest_by_key(log, ["id"], [order]).where(should_retry(now_ms))
    bundle, failures, whole = _run_again(raw, due.where("cursor IS NOT NULL"), run, methods)
    rank = F.array_position(F.array(*map(F.lit, _ENTITIES)), F.col("entity"))
    last = failures.groupBy("cursor").agg(F.max_by(F.struct("error_type", "error_message", "context"), F.struct(rank, "stage", "error_message")).alias("__f"))
    both = due.join(last, "cursor", "left").join(whole.withColumn("__whole", F.lit(True)), "cursor", "left")
    bad = F.col("__f").isNotNull() | F.col("__whole").isNull()
    told = {
        "new_error_type": F.coalesce("__f.error_type", F.lit("RpcError")),
        "new_error_message": F.coalesce("__f.error_message", F.lit(NO_PAYLOAD)),
        "new_context": F.col("__f.context"),
    }
    again = retry_transition(both.where(bad).withColumns(told).drop("__f", "__whole"), base_ms, now_ms)
    fine = resolve_transition(both.where(~bad).drop("__f", "__whole"), now_ms)
    states = again.unionByName(fine, allowMissingColumns=True).select(*due.columns, *[c for c in ("error_type", "error_message", "context") if c not in due.columns])
    done = F.col("status") == "resolved"
    gaps = states.where("cursor IS NOT NULL").groupBy("cursor").agg(F.every(done).alias("done"), F.max(F.when(~done, F.col("error_message"))).alias("error"))
    return bundle, states, gaps.select("cursor", F.when(F.col("done"), "completed").otherwise("failed").alias("status"), "error")


def replay_job(log: DataFrame, raw: DataFrame, run, methods: list[str], now_ms: int, order: str = "seq", most: int | None = None, **wanted: str | None) -> tuple[dict[str, DataFrame], DataFrame]:
    """(the bundle of the replay, the resolved rows of the records whose replay worked).

    run(raw rows of the replay cursors) ingests them and gives (bundle, failures); a record is resolved only if its cursor has
    raw rows of all methods, those that run needs, and is not among the failures. Raw rows without an error column have no RPC errors.
    """
    cursors = replay_cursors(log, order, most, **wanted)
    own = replay_filter(latest_by_key(log, ["id"], [order]), **wanted).join(cursors, "cursor", "left_semi")
    bundle, failures, whole = _run_again(raw, cursors, run, methods)
    worked = own.join(whole, "cursor", "left_semi").join(failures.select("cursor"), "cursor", "left_anti").select(own.columns)
    return bundle, resolve_transition(worked, now_ms)


def inspect_dlq(df: DataFrame, n: int, order: str = "seq", **wanted: str | None) -> DataFrame:
    """The first n matching records with what their payload and context hold."""
    return replay_filter(df, **wanted).orderBy(order).limit(n).select(
        order, "id", "entity", "cursor", "stage", "status", "retry_count", F.get_json_object("payload", "$.type").alias("payload_type"), F.get_json_object("payload", "$.size").cast("bigint").alias("payload_size"),
        F.array_join(F.array_sort(F.map_keys(F.from_json("context", "map<string,string>"))), ",").alias("context_keys"),
    )
